"""Mixing sources to target weights: fixed-length blocks of words, multinomial counts per output shard.

The words of each source, documents in the order of their keys, are one sequence cut into *blocks* of ``BLOCK`` words.
The output has as many slots as the targets fill blocks, in shards of ``SHARD`` slots. Each shard draws how many of its
slots go to each source; the k-th slot of a source in the whole output takes the block ``pi(k mod n)`` of the source's n
blocks, where ``pi`` is a pseudorandom permutation of its own per source and pass (a Feistel cipher). So every block
is used as often as any other, give or take one. Slots meet the pieces of their block in an equi-join on (source, block).

Draws are multinomial in what is left after the whole parts of the expected counts, which are given at once; this
keeps means and takes most of the noise away. Sources are drawn in two steps, tiles of ``TILE`` sources, then sources
of a tile, so that a vector is bounded; the driver holds one number per tile. A source is used ``LIMIT`` times at most:
what a draw gives it beyond that is drawn again in further shards, among sources which have room.

* null texts and texts without words have size 0 and no pieces; a null source is a source, the last one
* rows with equal keys follow each other in any fixed order; each is taken by itself (``row`` tells them apart)
* very long texts are counted by Spark and never held; a piece is a span of words, not their text
* an empty table, or one without words, gives no slots; further columns of the input are ignored
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.words import mix as scramble
from streamlens.operators.ordered import MAX_ROWS, cut, running
from streamlens.session import pin

BLOCK = 64
SHARD = 4096
TILE = 1024
TASK_SLOTS = 100_000
LIMIT = 3
WEIGHTS = (5, 2, 1)
WORD = r"[^\x20\x09-\x0D]+"
ROUNDS = 4
SLOTS = "shard long, slot long, source string, pass long, block long"


def number(*of: object) -> int:
    """A 64-bit number for a seed and what it is used for."""
    return int.from_bytes(hashlib.blake2b(repr(of).encode(), digest_size=8).digest(), "little")


def permuted(k: np.ndarray, n: int, key: int) -> np.ndarray:
    """Images of ``k`` under a permutation of ``range(n)``: a Feistel cipher, walked until it lands inside."""
    half = max(1, (int(n - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    out = k.astype(np.uint64)
    todo = np.arange(len(out))
    while len(todo):
        left, right = out[todo] >> np.uint64(half), out[todo] & low
        for r in range(ROUNDS):
            with np.errstate(over="ignore"):
                left, right = right, left ^ (scramble(right + np.uint64(number(key, r))) & low)
        out[todo] = left << np.uint64(half) | right
        todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def shares(total: int, parts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """``total`` dealt by the weights ``parts``: the whole part of each expectation, the rest multinomial."""
    expected = total * (parts / parts.sum())
    sure = np.floor(expected + 1e-9).astype(np.int64)
    left = total - int(sure.sum())
    if left <= 0:
        return sure
    rest = np.maximum(expected - sure, 0)
    return sure + rng.multinomial(left, rest / rest.sum() if rest.sum() > 0 else parts / parts.sum())


def sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """``row`` (unique), ``key``, ``source``, ``size``: words per document."""
    words = F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")
    return pin(
        docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
                    F.col(source).cast("string").alias("source"), words.alias("size")),
        "mix-rows",
    )


def targets(rows: DataFrame, weights: Sequence[float] = WEIGHTS, limit: int = LIMIT, max_rows: int = MAX_ROWS) -> DataFrame:
    """Per source: ``i`` (its place), ``source_size``, ``weight``, ``target``.

    Weights repeat along the sources by code point, null last, and share all words; a target stops at ``limit`` times
    its source, the excess goes to the others by weight. So targets are ``min(limit * size, level * weight)``: along
    the sources by ``limit * size / weight``, the level that fits once all before are at their limit falls until it
    is no more above the next one's.
    """
    sums = pin(rows.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("_last", F.col("source").isNull()), "mix-sources")
    named = running(cut(sums, [], ["_last", "source"], max_rows), {"i": ("count", F.lit(1))}).result()
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("i") - 1) % len(weights) + 1).cast("int"))
    known = pin(
        named.withColumn("weight", weight).withColumn("i", F.col("i") - 1)
        .withColumn("_most", limit * F.col("source_size")).withColumn("_ratio", F.col("_most") / F.col("weight")),
        "mix-weights",
    )
    total = known.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    summed = running(
        cut(known, [], ["_ratio", "i"], max_rows), {"_full": ("sum", F.col("_most")), "_light": ("sum", F.col("weight"))}, strict=True
    ).result()
    level = (F.lit(total.words or 0) - F.col("_full")) / (F.lit(total.weight or 1) - F.col("_light"))
    found = summed.withColumn("_level", level).where("_level <= _ratio").agg(F.min_by("_level", F.struct("_ratio", "i")).alias("x")).first()
    reach = F.col("_most") if found.x is None else F.least(F.col("_most"), F.lit(found.x) * F.col("weight"))
    return pin(known.select("source", "i", "source_size", "weight", reach.cast("double").alias("target")), "mix-targets")


def pieces(rows: DataFrame, block: int = BLOCK, max_rows: int = MAX_ROWS) -> DataFrame:
    """The documents' spans in the blocks of their source: ``source``, ``block``, ``row``, ``key``, ``start``, ``words``.

    ``start`` is the place of the span's first word in its document.
    """
    full = rows.where("size > 0")
    placed = running(cut(full, ["source"], ["key", "row"], max_rows), {"_at": ("sum", F.col("size"))}, strict=True).result()
    first, last = F.floor(F.col("_at") / block), F.floor((F.col("_at") + F.col("size") - 1) / block)
    spans = placed.withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block") * block - F.col("_at"), F.lit(0))
    end = F.least((F.col("block") + 1) * block - F.col("_at"), F.col("size"))
    return spans.select("source", F.col("block").cast("long").alias("block"), "row", "key", start.cast("long").alias("start"),
                        (end - start).cast("long").alias("words"))


def _draw(spark, sources: DataFrame, slots: int, first_shard: int, shard: int, seed: int) -> DataFrame:
    """Counts ``(shard, i, n)`` above 0 of ``slots`` slots by the sources' ``share``."""
    tiled = sources.withColumn("tile", F.floor(F.col("i") / TILE)).groupBy("tile").agg(
        F.sort_array(F.collect_list(F.struct("i", "share"))).alias("members")  # lists of at most TILE
    )
    # added up in the order of the list, so that reruns round alike
    tiled = pin(tiled.withColumn("share", F.aggregate("members", F.lit(0.0), lambda a, m: a + m.share)), "mix-tiles")
    tiles = tiled.select("tile", "share").orderBy("tile").collect()
    names, parts = np.array([t.tile for t in tiles], np.int64), np.array([t.share for t in tiles], float)

    def by_tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for g in batch.column("id").to_pylist():
                here = min(shard, slots - (g - first_shard) * shard)
                n = shares(here, parts, np.random.default_rng([number(seed, "tiles"), g]))
                hit = np.flatnonzero(n)
                yield pa.RecordBatch.from_pydict({"shard": pa.array(np.full(len(hit), g)), "tile": pa.array(names[hit]), "n": pa.array(n[hit])})

    def by_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"shard": [], "i": [], "n": []}
            for g, tile, n, members in zip(*(batch.column(c).to_pylist() for c in ("shard", "tile", "n", "members")), strict=True):
                drawn = shares(n, np.array([m["share"] for m in members], float), np.random.default_rng([number(seed, "sources", tile), g]))
                hit = np.flatnonzero(drawn)
                out["shard"] += [g] * len(hit)
                out["i"] += [members[j]["i"] for j in hit]
                out["n"] += drawn[hit].tolist()
            yield pa.RecordBatch.from_pydict({c: pa.array(v, pa.int64()) for c, v in out.items()})

    shards = spark.range(first_shard, first_shard - (-slots // shard))
    drawn = shards.mapInArrow(by_tile, "shard long, tile long, n long").join(tiled.select("tile", "members"), "tile")
    return drawn.select("shard", "tile", "n", "members").mapInArrow(by_source, "shard long, i long, n long")


def draws(sources: DataFrame, slots: int, shard: int = SHARD, seed: int = 0, max_rows: int = MAX_ROWS) -> DataFrame:
    """Counts per shard and source, with the source's slots before: ``shard``, ``i``, ``n``, ``before``.

    ``sources``: ``i``, ``share`` and ``most``, the slots it may fill. Each round draws what the one before gave to
    full sources; it ends since shares are above 0 only for sources with room, and a round's draw fills whole parts.
    """
    spark, done, first = sources.sparkSession, None, 0
    room = sources.select("i", "share", "most", F.lit(0).cast("long").alias("used"))
    while slots > 0:
        drawn = pin(_draw(spark, room.where("share > 0 AND used < most"), slots, first, shard, seed), "mix-drawn")
        placed = running(cut(drawn, ["i"], ["shard"], max_rows), {"_sum": ("sum", F.col("n"))}, strict=True).result()
        limits = placed.join(room, "i").withColumn("before", F.col("_sum") + F.col("used"))
        fits = F.least(F.col("n"), F.greatest(F.col("most") - F.col("before"), F.lit(0)))
        kept = pin(limits.select("shard", "i", fits.alias("n"), "before").where("n > 0"), "mix-kept")
        done = kept if done is None else done.unionByName(kept)
        room = pin(
            room.join(kept.groupBy("i").agg(F.sum("n").alias("_new")), "i", "left")
            .select("i", "share", "most", (F.col("used") + F.coalesce("_new", F.lit(0))).alias("used")),
            "mix-room",
        )
        first += -(-slots // shard)
        slots -= kept.agg(F.sum("n")).first()[0] or 0
        if room.where("share > 0 AND used < most").isEmpty():
            break
    return done


def slots(counts: DataFrame, sources: DataFrame, seed: int = 0) -> DataFrame:
    """The slots that counts stand for: ``shard``, ``slot``, ``source``, ``pass``, ``block``.

    ``sources``: ``i``, ``source``, ``blocks``. Within a shard the slots of all sources are permuted.
    """
    inside = Window.partitionBy("shard")
    at = F.sum("n").over(inside.orderBy("i").rowsBetween(Window.unboundedPreceding, -1))
    counted = counts.withColumns({"_at": F.coalesce(at, F.lit(0)), "_all": F.sum("n").over(inside)})
    rows = counted.join(sources, "i").select("shard", "i", "n", "before", "_at", "_all", "blocks", "source")
    # a count stands for many slots: tasks are sized by slots, not by the bytes of counts
    tasks = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // TASK_SLOTS))
    rows = rows.repartition(tasks, "shard")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, i, n, before, start, whole, blocks, source in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                k = np.arange(before, before + n, dtype=np.int64)  # at most a shard
                turn, block = k // blocks, np.empty(n, np.int64)
                for t in np.unique(turn):
                    block[turn == t] = permuted(k[turn == t] % blocks, blocks, number(seed, "blocks", i, int(t)))
                place = permuted(np.arange(start, start + n), whole, number(seed, "slots", shard))
                yield pa.RecordBatch.from_pydict({
                    "shard": pa.array(np.full(n, shard)), "slot": pa.array(place), "source": pa.array([source] * n, pa.string()),
                    "pass": pa.array(turn), "block": pa.array(block),
                })

    return rows.mapInArrow(run, SLOTS)


class Mix:
    """A mix: ``rows`` (documents and sizes), ``targets`` (sources), ``pieces`` (spans in blocks), ``slots`` (the output's order)."""

    def __init__(self, docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
                 weights: Sequence[float] = WEIGHTS, block: int = BLOCK, shard: int = SHARD, limit: int = LIMIT, seed: int = 0,
                 max_rows: int = MAX_ROWS):
        self.rows = sized(docs, key, text, source)
        self.targets = targets(self.rows, weights, limit, max_rows)
        self.pieces = pieces(self.rows, block, max_rows)
        blocks = F.ceil(F.col("source_size") / block).cast("long")
        full = self.targets.where("source_size > 0").withColumn("blocks", blocks)
        # a source's last block is shorter, so its slots hold somewhat less than a block each
        share = F.col("target") * F.col("blocks") / F.col("source_size")
        sources = full.select("i", "source", "blocks", share.alias("share"))
        needed = sources.agg(F.ceil(F.sum(F.round("share", 6).cast("decimal(38,6)"))).cast("long")).first()[0] or 0
        if needed:
            counts = draws(sources.withColumn("most", F.col("blocks") * limit), needed, shard, seed, max_rows)
            self.slots = pin(slots(counts, sources, seed), "mix-slots")
        else:
            self.slots = docs.sparkSession.createDataFrame([], SLOTS)

    def order(self) -> DataFrame:
        """The mix: spans of documents by ``shard``, ``slot`` and ``block_start``, their place in the output."""
        here, there = self.slots, self.pieces.withColumnsRenamed({"source": "_source", "block": "_block"})
        same = here["source"].eqNullSafe(there["_source"]) & (here["block"] == there["_block"])
        return here.join(there, same).drop("_source", "_block")

    def texts(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """``shard``, ``slot``, ``source`` and the words of the slot, joined by one space. Keys must be unique and not null."""
        words = F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0))
        cut_ = self.pieces.join(docs.select(F.col(key).alias("key"), words.alias("_words")), "key").select(
            "source", "block", "row", "key", F.array_join(F.slice("_words", F.col("start").cast("int") + 1, F.col("words").cast("int")), " ").alias("part"),
        )
        packed = cut_.groupBy("source", "block").agg(F.sort_array(F.collect_list(F.struct("key", "row", "part"))).alias("parts"))
        named = packed.select(F.col("source").alias("_source"), F.col("block").alias("_block"), F.array_join("parts.part", " ").alias("text"))
        same = self.slots["source"].eqNullSafe(named["_source"]) & (self.slots["block"] == named["_block"])
        return self.slots.join(named, same).select("shard", "slot", "source", "text")

    def taken(self) -> DataFrame:
        """Per document: ``key``, ``source``, ``size``, ``source_size``, ``target``, ``taken``: its words in the mix, repeats counted.

        A block's spans meet the number of its slots, not the slots one by one.
        """
        uses = self.slots.groupBy("source", "block").agg(F.count("*").alias("uses"))
        uses = uses.withColumnsRenamed({"source": "_source", "block": "_block"})
        spans = self.pieces
        met = spans.join(uses, spans["source"].eqNullSafe(uses["_source"]) & (spans["block"] == uses["_block"]))
        words = met.groupBy("row").agg(F.sum(F.col("words") * F.col("uses")).alias("taken"))
        sources = self.targets.select(F.col("source").alias("_source"), "source_size", "target")
        known = self.rows.join(sources, self.rows["source"].eqNullSafe(sources["_source"]))
        return known.join(words, "row", "left").select(
            "key", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken")
        )
