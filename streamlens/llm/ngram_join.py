"""N-gram Jaccard join by MinHash banding, verified on full n-gram sets.

A document is the set of its runs of five words (A-Z in lower case; a shorter text is one run of all its words).
Documents with equal sets form a class and are joined once, through their smallest key. Band and row counts follow
from the wanted recall at the threshold. Classes meet in the buckets of their band hashes; a pair is verified in
the first band it shares, on the whole sets. A bucket of many or long members is cut into parts, and pairs of parts
are separate tasks' work; what leaves a task is counts of links and a spanning star, never all pairs.

Texts without words and null texts link to nothing; so do rows with a null key, which get no class. Rows with equal
keys count as one document when links are followed. An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.words import Hasher, mix, pieces, split, window_hash
from streamlens.session import pin

THRESHOLD = 0.8
RECALL = 0.999
HASHES = 64
SIZE = 5
PIECE = 1 << 19
PART_MEMBERS = 1024
PART_NGRAMS = 1 << 20
BROADCAST_KEYS = 1_000_000


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows per band: the most rows for which ``hashes`` give the recall at the threshold."""
    options = [(math.ceil(math.log(1 - recall) / math.log(1 - threshold**r)), r) for r in range(1, 17)]
    return max((o for o in options if o[0] * o[1] <= hashes), key=lambda o: o[1])


def ngram_sets(texts: pa.Array, hasher: Hasher, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct n-gram numbers of all texts, one text after another, and where each text begins."""
    words = split(texts, lower=True)
    h = hasher(words.data, words.start, words.end)
    grams, text = window_hash(h, words.first, size)
    count = np.diff(words.first)
    for i in np.flatnonzero((count > 0) & (count < size)).tolist():
        run = h[words.first[i] : words.first[i + 1]]
        grams = np.append(grams, window_hash(run, np.array([0, len(run)]), len(run))[0])
        text = np.append(text, i)
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    grams, text = grams[fresh], text[fresh]
    return grams, np.searchsorted(text, np.arange(len(count) + 1))


def fingerprints(grams: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Two 64-bit numbers per set."""
    out = np.zeros((2, len(first) - 1), np.int64)
    with np.errstate(over="ignore"):
        for k in range(2):
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams + np.uint64(k + 1)))))
            out[k] = (total[first[1:]] - total[first[:-1]]).view(np.int64)
    return out


def signatures(docs: DataFrame, bands: int, rows: int, size: int) -> DataFrame:
    """``key``, ``n`` (n-grams), fingerprints ``f1``, ``f2`` and one number per band, for each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(11)
        factor = mix(np.arange(1, bands * rows + 1, dtype=np.uint64)) | np.uint64(1)
        for batch in pieces(batches, "text", PIECE):
            grams, first = ngram_sets(batch.column("text"), hasher, size)
            n = np.diff(first)
            some = n > 0
            band = np.zeros((len(n), bands), np.uint64)
            with np.errstate(over="ignore"):
                for k in range(bands * rows):
                    if some.any():
                        least = np.minimum.reduceat(grams * factor[k], first[:-1][some])
                        band[some, k // rows] = mix(band[some, k // rows] ^ least)
            f = fingerprints(grams, first)
            flat = pa.array(band.view(np.int64).ravel())
            yield pa.RecordBatch.from_pydict({
                "key": batch.column("key"), "n": pa.array(n.astype(np.int64)), "f1": pa.array(f[0]), "f2": pa.array(f[1]),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1) * bands, pa.int32()), flat),
            })

    return docs.mapInArrow(run, "key long, n long, f1 long, f2 long, bands array<long>")


def whole_sets(docs: DataFrame, size: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(11)
        for batch in pieces(batches, "text", PIECE):
            grams, first = ngram_sets(batch.column("text"), hasher, size)
            f = fingerprints(grams, first)
            body = [grams[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.RecordBatch.from_pydict({"key": batch.column("key"), "f1": pa.array(f[0]), "f2": pa.array(f[1]), "grams": pa.array(body, pa.binary())})

    return docs.mapInArrow(run, "key long, f1 long, f2 long, grams binary")


def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many n-grams each two of the sets have in common."""
    m = len(sets)
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(m), [len(s) for s in sets])
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    number = np.cumsum(np.diff(flat, prepend=flat[:1]) != 0)
    common = np.bincount(number)[number] > 1
    number, owner = number[common], owner[common]
    out = np.zeros((m, m), np.float32)
    cuts = np.flatnonzero(np.diff(number, prepend=-1))
    for lo in range(0, len(cuts), 2048):  # 2048 n-grams at a time: a dense block of members by n-grams
        a = cuts[lo]
        b = cuts[lo + 2048] if lo + 2048 < len(cuts) else len(number)
        column = np.cumsum(np.diff(number[a:b], prepend=number[a]) != 0)
        block = np.zeros((m, column[-1] + 1), np.float32)
        block[owner[a:b], column] = 1
        out += block @ block.T
    return out


def links(nodes: np.ndarray, copies: np.ndarray, bands: np.ndarray, part: np.ndarray, band: int, cross: bool, sets: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """For the members of a bucket: linked documents of each, and the smallest node each can reach."""
    shared = shared_counts(sets)
    n = np.array([len(s) for s in sets], np.float32)
    linked = shared >= threshold * (n[:, None] + n[None, :] - shared) - 1e-4
    np.fill_diagonal(linked, False)
    linked &= nodes[:, None] != nodes[None, :]
    if cross:
        linked &= part[:, None] != part[None, :]
    for e in range(band):  # pairs that share an earlier band were counted there
        linked &= bands[:, e][:, None] != bands[:, e][None, :]
    reach = nodes.copy()
    while True:
        near = np.minimum(reach, np.where(linked, reach[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (near == reach).all():
            return linked @ copies, reach
        reach = near


def verify(members: DataFrame, threshold: float) -> DataFrame:
    """Rows (node, links, reach) from members grouped by ``band, h, i, j``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            group = pa.Table.from_batches(held)
            if len(group) < 2:
                return
            sets = [np.frombuffer(b.as_buffer(), np.uint64) for b in group.column("grams")]
            nodes = group.column("node").to_numpy()
            bands = np.array(group.column("bands").to_pylist(), np.int64)
            i, j = group.column("i")[0].as_py(), group.column("j")[0].as_py()
            n, reach = links(nodes, group.column("copies").to_numpy(), bands, group.column("part").to_numpy(), group.column("band")[0].as_py(), i != j, sets, threshold)
            hit = n > 0
            if hit.any():
                yield pa.RecordBatch.from_pydict({"node": pa.array(nodes[hit]), "links": pa.array(n[hit].astype(np.int64)), "reach": pa.array(reach[hit])})

        last = None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("band", "h", "i", "j")], axis=1)
            cuts = [0, *(np.flatnonzero((np.diff(keys, axis=0) != 0).any(axis=1)) + 1).tolist(), len(keys)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                here = tuple(keys[a].tolist())
                if here != last and held:
                    yield from flush()
                    held = []
                last = here
                held.append(batch.slice(a, b - a))
        if held:
            yield from flush()

    return members.mapInArrow(run, "node long, links long, reach long")


def components(edges: DataFrame, most: int = 64) -> DataFrame:
    """``node``, ``root``: the smallest node of each connected part of ``edges`` (node, other)."""
    both = pin(edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other"))).distinct(), "join-edges")
    labels = pin(both.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("root")), "join-labels")
    for _ in range(most):
        near = both.join(labels.withColumnRenamed("node", "other"), "other").groupBy("node").agg(F.min("root").alias("near"))
        step = labels.join(near, "node").select("node", F.least("root", "near").alias("next"), "root")
        jump = step.select(F.col("node").alias("next"), F.col("next").alias("far"))
        done = pin(step.join(jump, "next", "left").select("node", F.least("next", F.coalesce("far", "next")).alias("next"), "root"), "join-labels")
        labels = done.select("node", F.col("next").alias("root"))
        if done.where("next <> root").isEmpty():
            return labels
    raise RuntimeError(f"links are still being followed after {most} rounds")


def bounded(keys: DataFrame) -> DataFrame:
    """One column of numbers, broadcast while it has at most ``BROADCAST_KEYS`` rows (8 MB); beyond that Spark
    joins by shuffle. The rows of a join with it are the same either way."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD, recall: float = RECALL, size: int = SIZE) -> DataFrame:
    """One row per document: ``key``, ``class_id`` (smallest key among all it is linked to, directly or through
    others), ``n_links`` (other documents with a Jaccard similarity of ``threshold`` or more) and ``n_ngrams``."""
    bands, rows = banding(threshold, recall)
    texts = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    marked = pin(signatures(texts, bands, rows, size), "join-signatures")
    classes = pin(
        marked.where("n > 0 AND key IS NOT NULL").groupBy("f1", "f2", "n")
        .agg(F.min("key").alias("node"), F.count("*").alias("copies"), F.first("bands").alias("bands")),
        "join-classes",
    )
    slots = classes.select("node", "f1", "f2", "n", F.posexplode("bands").alias("band", "h"))
    full = slots.groupBy("band", "h").agg(F.count("*").alias("members"), F.sum("n").alias("ngrams")).where("members > 1")
    met = slots.select("node", "f1", "f2", "band", "h").join(full, ["band", "h"])
    near = pin(
        met.groupBy("node", "f1", "f2").agg(F.collect_list(F.struct("band", "h", "members", "ngrams")).alias("met"))
        .join(classes, ["node", "f1", "f2"]),
        "join-near",
    )
    # a bucket whose members all share an earlier band has nothing left to verify
    rows_ = near.select("node", "f1", "f2", "copies", "bands", F.explode("met").alias("m")).select("node", "f1", "f2", "copies", "bands", "m.*")
    told = [(F.min(F.col("bands")[e]) == F.max(F.col("bands")[e])) & (F.lit(e) < F.first("band")) for e in range(bands)]
    covered = told[0]
    for t in told[1:]:
        covered = covered | t
    open_ = rows_.groupBy("band", "h").agg(covered.alias("covered")).where("NOT covered").drop("covered")
    work = rows_.join(open_, ["band", "h"])
    parts = F.greatest(F.ceil(F.col("members") / PART_MEMBERS), F.ceil(F.col("ngrams") / PART_NGRAMS)).cast("int")
    work = work.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    spread = work.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "band", "h", F.least("part", "k").alias("i"), F.greatest("part", "k").alias("j"), "part", "node", "f1", "f2", "copies", "bands",
    )
    wanted = bounded(near.select(F.col("node").alias("key")))
    sets = pin(whole_sets(texts.join(wanted, "key", "left_semi"), size).dropDuplicates(["key", "f1", "f2"]).withColumnRenamed("key", "node"), "join-sets")
    found = pin(verify(
        spread.join(sets, ["node", "f1", "f2"]).repartition("band", "h", "i", "j").sortWithinPartitions("band", "h", "i", "j"), threshold,
    ), "join-links")
    root = components(found.where("node <> reach").select("node", F.col("reach").alias("other")))
    count = found.groupBy("node").agg(F.sum("links").alias("links"))
    summary = classes.select("f1", "f2", "n", "node", "copies").join(count, "node", "left").join(root, "node", "left")
    held = marked.select("key", "f1", "f2", "n").join(summary, ["f1", "f2", "n"], "left")
    no_words = (F.col("n") == 0) | F.col("key").isNull()
    return held.select(
        F.col("key").alias(key),
        F.when(no_words, F.col("key")).otherwise(F.coalesce("root", "node")).alias("class_id"),
        F.when(no_words, F.lit(0)).otherwise(F.col("copies") - 1 + F.coalesce("links", F.lit(0))).cast("long").alias("n_links"),
        F.col("n").alias("n_ngrams"),
    )
