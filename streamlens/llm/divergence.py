"""How the sources of a language differ: smoothed term shares per source, divergences of pairs, telling terms.

Identical texts of a language are collapsed first: one row per text with the number of its documents in each source.
Each text is cut into terms once; its counts and document frequencies enter the sums once per source, multiplied. A
term is kept in a language if at least ``LEAST`` of its documents hold it. With N occurrences of V kept terms in a
group, the share of a term that occurs c times is ``1 + floor(SCALE * (c + 1) / (N + V))``.

A pair's divergence sums ``floor((p - q)^2 / q)`` over all kept terms, yet only occurring ones are visited: terms that
neither source holds all add the same, those of one source are met with the other's share of absent terms, and
corrections come from terms that both hold. The terms of a language are dealt into blocks, its sources into tiles of
``TILE``; a task adds up one block for one pair of tiles in a small matrix, so nothing grows with a term's sources
squared. All arithmetic is in whole numbers.

* null text, language and source count as empty; a group without terms takes part with N = 0
* rows repeated under one key are documents of their own
* a very long text is cut into terms in windows of ``WINDOW`` bytes, a text at a time at most
* ties rank by name, in the order of UTF-8 bytes
* an empty table gives an empty result; further columns of the input are ignored
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.llm.words import LOWER, offsets, pieces
from streamlens.session import pin

LEAST = 3
SCALE = 1_000_000_000
TOP = 200
TILE = 256
WINDOW = 1 << 20
HELD = 400_000  # partial sums a task keeps before it hands them on
BLOCK_ROWS = 200_000
LIST = 1000  # sources of a text in one row
NAMED_GROUPS = 100_000  # groups that are broadcast
CODE = np.arange(256)
TERM = (CODE >= 128) | ((CODE >= 65) & (CODE <= 90)) | ((CODE >= 97) & (CODE <= 122))


def collapsed(docs: DataFrame, text: str, lang: str, source: str) -> DataFrame:
    """``lang``, ``text`` and ``sources``: the numbers of documents with this very text by source.

    Counts travel apart from the texts, of which each task sends a copy at most. A text of more than ``LIST`` sources
    comes in several rows.
    """
    empty = F.lit("")
    body = F.coalesce(F.col(text).cast("string"), empty)
    rows = docs.select(
        F.coalesce(F.col(lang).cast("string"), empty).alias("lang"), F.coalesce(F.col(source).cast("string"), empty).alias("source"),
        F.sha2(body, 256).alias("h"), body.alias("text"),
    )
    once = rows.groupBy("lang", "h").agg(F.first("text").alias("text"))
    by_source = rows.groupBy("lang", "h", "source").agg(F.count("*").alias("n"))
    # the number of sources decides in how many rows a text comes; most texts have one source
    numbered = by_source.withColumn("row", F.floor((F.row_number().over(Window.partitionBy("lang", "h").orderBy("source")) - 1) / LIST))
    lists = numbered.groupBy("lang", "h", "row").agg(F.collect_list(F.struct("source", "n")).alias("sources"))
    return once.join(lists, ["lang", "h"]).select("lang", "text", "sources")


def _boundary(data: np.ndarray, at: np.ndarray, end: int) -> int:
    """The first place from ``end`` on that is not inside a term."""
    if end >= len(data):
        return len(data)
    text_end = int(at[np.searchsorted(at, end)])
    while end < text_end:
        rest = np.flatnonzero(~TERM[data[end : min(end + WINDOW, text_end)]])
        if len(rest):
            return end + int(rest[0])
        end = min(end + WINDOW, text_end)
    return end


def terms(texts: pa.Array) -> pa.Table:
    """``text`` (position), ``term``, ``n``: the terms of each text and how often it holds them."""
    at = offsets(texts)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    at = at - at[0]
    parts, begin = [], 0
    while begin < len(data):
        end = _boundary(data, at, begin + WINDOW)
        here = LOWER[data[begin:end]]
        inside = np.concatenate(([False], TERM[here], [False]))
        edge = np.zeros(len(here) + 1, bool)
        edge[at[(at >= begin) & (at <= end)] - begin] = True
        start = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        stop = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        # the bytes of terms alone, one after the other
        size = stop - start
        ends = np.concatenate(([0], np.cumsum(size)))
        kept = here[TERM[here]]
        words = pa.StringArray.from_buffers(len(size), pa.py_buffer(ends.astype(np.int32).tobytes()), pa.py_buffer(kept.tobytes()))
        of = np.searchsorted(at, begin + start, "right") - 1
        found = pa.table({"text": of, "term": words, "n": np.ones(len(size), np.int64)})
        parts.append(_summed(found, ["text", "term"], ["n"]))
        begin = end
    if not parts:
        return pa.table({"text": pa.array([], pa.int64()), "term": pa.array([], pa.string()), "n": pa.array([], pa.int64())})
    return parts[0] if len(parts) == 1 else _summed(pa.concat_tables(parts), ["text", "term"], ["n"])


def _summed(rows: pa.Table, keys: list[str], values: list[str]) -> pa.Table:
    out = rows.group_by(keys, use_threads=False).aggregate([(v, "sum") for v in values])
    return out.rename_columns([c.removesuffix("_sum") for c in out.column_names]).select([*keys, *values])


def counted(texts: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``term``, ``count``, ``docs``: occurrences and documents, one row per group and term.

    Rows are dealt by (language, term): no key has more rows than the sources times the tasks before.
    """
    keys, values = ["lang", "source", "term"], ["count", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in pieces(batches, "text"):
            found = terms(batch.column("text"))
            lists = batch.column("sources")
            flat = lists.flatten()
            first = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
            of = found.column("text").to_numpy()
            many = first[of + 1] - first[of]
            row = np.repeat(np.arange(len(of)), many)
            entry = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[of], many)
            times = flat.field("n").to_numpy(zero_copy_only=False)[entry]
            held.append(_summed(pa.table({
                "lang": batch.column("lang").take(pa.array(of[row])), "source": flat.field("source").take(pa.array(entry)),
                "term": found.column("term").take(pa.array(row)), "count": found.column("n").to_numpy()[row] * times, "docs": times,
            }), keys, values))
            size += len(held[-1])
            if size > HELD:
                held = [_summed(pa.concat_tables(held), keys, values)]
                size = len(held[0])
                if size > HELD // 2:
                    yield from held[0].combine_chunks().to_batches()
                    held, size = [], 0
        if held:
            yield from _summed(pa.concat_tables(held), keys, values).combine_chunks().to_batches()

    rows = texts.mapInArrow(run, "lang string, source string, term string, count long, docs long")
    # a further sum on the way would see keys that hardly repeat; this one needs no other shuffle
    return rows.repartition("lang", "term").groupBy(*keys).agg(F.sum("count").alias("count"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kinds: Column) -> Column:
    """``1 + floor(SCALE * (count + 1) / (total + kinds))`` for counts of any size."""
    wide = "decimal(25,0)"
    whole = ((count + 1).cast(wide) * F.lit(SCALE).cast("decimal(10,0)")).cast("decimal(38,0)")
    return (F.lit(1).cast("long") + _div(whole, (total + kinds).cast(wide))).cast("long")


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def far(p: Column, q: Column) -> Column:
    """``floor((p - q)^2 / q)``; shares are at most ``SCALE + 1``, so a long holds the square."""
    return _div((p - q) * (p - q), q)


class Audit:
    """Shares of kept terms by language and source: ``groups`` and ``entries`` (stored tables)."""

    def __init__(self, docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", least: int = LEAST):
        empty = F.lit("")
        named = docs.select(F.coalesce(F.col(lang).cast("string"), empty).alias("lang"),
                            F.coalesce(F.col(source).cast("string"), empty).alias("source")).distinct()
        one = Window.partitionBy("lang", "term")
        whole = counted(collapsed(docs, text, lang, source)).withColumns({
            "all": F.sum("count").over(one), "in_docs": F.sum("docs").over(one),
            "first": (F.row_number().over(one.orderBy("source")) == 1).cast("long"),
        })
        kept = pin(whole.where(F.col("in_docs") >= least).select("lang", "term", "source", "count", "all", "first"), "kept-terms")
        kinds = kept.groupBy("lang").agg(F.sum("first").alias("kinds"), F.sum("count").alias("lang_total"), F.count("*").alias("entries"))
        totals = kept.groupBy("lang", "source").agg(F.sum("count").alias("total"))
        zero = F.lit(0).cast("long")
        groups = named.join(totals, ["lang", "source"], "left").join(kinds, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("total", "kinds", "lang_total", "entries")]
        )
        place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
        members = F.count("*").over(Window.partitionBy("lang"))
        absent = F.when(F.col("kinds") > 0, share(zero, F.col("total"), F.col("kinds")))
        self.groups = pin(groups.select("*", place.alias("i"), members.alias("members"), absent.alias("absent")), "groups")
        small = self.groups.count() <= NAMED_GROUPS
        of = self.groups.select("lang", "source", "total", "kinds", "lang_total", "i")
        self.entries = pin(
            kept.join(F.broadcast(of) if small else of, ["lang", "source"]).select(
                "lang", "source", "term", "i", share(F.col("count"), F.col("total"), F.col("kinds")).alias("p"),
                share(F.col("all"), F.col("lang_total"), F.col("kinds")).alias("q"),
            ),
            "entries",
        )

    def pairs(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (each other source), ``value``: the whole divergence."""
        tiles = F.ceil(F.col("members") / TILE).cast("long")
        blocks = F.greatest(F.ceil(2 * F.col("entries") / (tiles * BLOCK_ROWS)), F.lit(1)).cast("long")
        groups = self.groups.where("kinds > 0").withColumns({"tiles": tiles, "blocks": blocks})
        langs = groups.select("lang", "tiles", "blocks").distinct()
        tile = F.floor(F.col("i") / TILE).cast("long")
        there = F.explode(F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)).alias("there")

        def tiled(rows: DataFrame) -> DataFrame:
            """Each row to the pairs of tiles its own is in."""
            dealt = rows.select("*", tile.alias("tile"), there)
            return dealt.select("lang", "block", F.least("tile", "there").alias("a"), F.greatest("tile", "there").alias("b"), "term", "i", "p")

        block = F.pmod(F.xxhash64("term"), F.col("blocks"))
        rows = tiled(self.entries.join(langs, "lang").withColumn("block", block))
        each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block")
        heads = tiled(groups.select("lang", "i", "tiles", F.lit(None).cast("string").alias("term"), F.col("absent").alias("p"), each))
        parts = rows.unionByName(heads).groupBy("lang", "block", "a", "b").applyInArrow(_matrix, "lang string, i int, j int, value long")
        sums = parts.groupBy("lang", "i", "j").agg(F.sum("value").alias("part"))
        left = self.groups.select("lang", "source", "i", "kinds", F.col("absent").alias("p"))
        right = self.groups.select("lang", F.col("source").alias("item"), F.col("i").alias("j"), F.col("absent").alias("q"))
        both = left.join(right, "lang").where("i <> j").join(sums, ["lang", "i", "j"], "left")
        same = F.when(F.col("kinds") > 0, F.col("kinds") * far(F.col("p"), F.col("q"))).otherwise(F.lit(0))
        return both.select("lang", "source", "item", (same + F.coalesce("part", F.lit(0))).cast("long").alias("value"))

    def telling(self) -> DataFrame:
        """``lang``, ``source``, ``item`` (its terms with a share above the language's), ``value``."""
        above = self.entries.where("p > q")
        return above.select("lang", "source", F.col("term").alias("item"), far(F.col("p"), F.col("q")).alias("value"))

    def report(self, top: int = TOP) -> DataFrame:
        """Both parts ranked, of telling terms the first ``top`` of a group."""
        order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
        pairs = self.pairs().withColumn("rank", F.row_number().over(order))
        told = self.telling().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
        columns = ["lang", "source", "part", "item", "value", "rank"]
        return pairs.withColumn("part", F.lit("pair")).select(columns).unionByName(told.withColumn("part", F.lit("term")).select(columns))


def _far(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _matrix(group: pa.Table) -> pa.Table:
    """Sums over a block's terms for all pairs of two tiles, without what absent terms add.

    Rows without a term give the tiles' sources and their share of absent terms.
    """
    lang, a, b = (group.column(c)[0].as_py() for c in ("lang", "a", "b"))
    head = pc.is_null(group.column("term"))
    heads, rows = group.filter(head), group.filter(pc.invert(head))
    i = heads.column("i").to_numpy().astype(np.int64)
    order = np.argsort(i)
    i, absent = i[order], heads.column("p").to_numpy()[order]
    size = len(i)
    total = np.zeros((size, size), np.int64)
    both_absent = _far(absent[:, None], absent[None, :])
    at = np.searchsorted(i, rows.column("i").to_numpy())
    p = rows.column("p").to_numpy()
    # one source holds the term: equal shares of a source are met once
    kinds, many = np.unique(np.stack([at, p], axis=1), axis=0, return_counts=True) if len(p) else (np.zeros((0, 2), np.int64), np.zeros(0, np.int64))
    for begin in range(0, len(kinds), 4096):
        s, x, n = kinds[begin : begin + 4096, 0], kinds[begin : begin + 4096, 1][:, None], many[begin : begin + 4096][:, None]
        np.add.at(total, s, n * (_far(x, absent[None, :]) - both_absent[s]))
        np.add.at(total.T, s, n * (_far(absent[None, :], x) - both_absent.T[s]))
    # both hold it
    term = rows.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False) if len(p) else np.zeros(0, np.int64)
    order = np.argsort(term, kind="stable")
    term, at, p = term[order], at[order], p[order]
    begins = np.searchsorted(term, term, "left")
    many = np.searchsorted(term, term, "right") - begins
    begin = 0
    done = np.cumsum(many)
    while begin < len(term):
        stop = max(begin + 1, int(np.searchsorted(done, (done[begin - 1] if begin else 0) + 1_000_000, "right")))
        n = many[begin:stop]
        x = np.repeat(np.arange(begin, stop), n)
        y = np.arange(len(x)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begins[begin:stop], n)
        u, v = at[x], at[y]
        gain = _far(p[x], p[y]) - _far(p[x], absent[v]) - _far(absent[u], p[y]) + both_absent[u, v]
        np.add.at(total, (u, v), gain)
        begin = stop
    # a pair of tiles gives the pairs across them only; a tile with itself those inside
    tile = i // TILE
    x, y = np.nonzero((i[:, None] != i[None, :]) & ((tile[:, None] != tile[None, :]) | (a == b)))
    return pa.table({"lang": pa.array([lang] * len(x), pa.string()), "i": pa.array(i[x], pa.int32()), "j": pa.array(i[y], pa.int32()),
                     "value": pa.array(total[x, y])})
