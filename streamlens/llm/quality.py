"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Every word and every word ending has a fixed sparse ternary *index vector*. A *context vector* is the sum of the
index vectors that stood within two places of it in the labelled sample. A document is pooled into the mean and
spread of its context vectors, the mean of its index vectors and the likeness of neighbouring words. Words and
endings share ``BUCKETS`` hashed rows, so the tables have one size for any vocabulary. Pairs of words have index
vectors too: the length of their mean tells how often a text repeats its phrases. The network is trained in
numpy on the driver from at most ``SAMPLE`` labelled documents; its probabilities are calibrated by one temperature
fitted on a fifth of them that it was not trained on.

A null text counts as empty; a text without words has all features 0 and a score like any other. Without labelled
rows of both kinds the score is the share of good labels (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.llm.labelled import sample
from streamlens.llm.words import Hasher, Words, mix, pieces, split
from streamlens.session import pin

SAMPLE = 6_000
BUCKETS = 1 << 14
DIMS = 48
REACH = 2
CHUNK = 1024
WIDTH = 3 * DIMS + 7
PIECE = 1 << 19


def index_vectors() -> np.ndarray:
    """Sparse ternary rows: four entries of 1 or -1 each."""
    out = np.zeros((BUCKETS, DIMS), np.float32)
    h = mix(np.arange(1, BUCKETS + 1, dtype=np.uint64))
    for k in range(4):
        at = ((h >> np.uint64(12 * k)) % np.uint64(DIMS)).astype(np.int64)
        sign = np.where((h >> np.uint64(60 + k)) & np.uint64(1), 1, -1)
        out[np.arange(BUCKETS), at] += sign
    return out


def units(words: Words, hasher: Hasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Full hash of each word, its bucket, and the bucket of its last three bytes."""
    whole = hasher(words.data, words.start, words.end)
    ending = hasher(words.data, np.maximum(words.start, words.end - 3), words.end) ^ np.uint64(0x5DEECE66D)
    return whole, (whole % np.uint64(BUCKETS)).astype(np.int64), (mix(ending) % np.uint64(BUCKETS)).astype(np.int64)


def contexts(texts: pa.Array, hasher: Hasher, index: np.ndarray, table: np.ndarray) -> None:
    """Add to ``table`` the index vectors around each word and ending."""
    words = split(texts)
    if not len(words.start):
        return
    _, word, ending = units(words, hasher)
    own = index[word] + index[ending]
    text = words.text_of
    around = np.zeros_like(own)
    for k in range(1, REACH + 1):
        near = (text[k:] == text[:-k])[:, None]
        around[k:] += own[:-k] * near
        around[:-k] += own[k:] * near
    for bucket in (word, ending):
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=-1))
        table[bucket[order][cuts]] += np.add.reduceat(around[order], cuts, axis=0)


def pooled(texts: pa.Array, hasher: Hasher, index: np.ndarray, table: np.ndarray) -> np.ndarray:
    """One row of features per text."""
    words = split(texts)
    n = np.diff(words.first)
    out = np.zeros((len(n), WIDTH))
    if not len(words.start):
        return out
    whole, word, ending = units(words, hasher)
    vector = table[word] + table[ending]
    some = n > 0
    cuts = words.first[:-1][some]
    count = n[some][:, None]
    mean = np.add.reduceat(vector, cuts, axis=0) / count
    square = np.add.reduceat(vector * vector, cuts, axis=0) / count
    same = np.zeros((len(whole), 2))
    text = words.text_of
    near = text[1:] == text[:-1]
    same[1:, 0] = (whole[1:] == whole[:-1]) & near
    same[1:, 1] = np.einsum("ij,ij->i", vector[1:], vector[:-1]) * near
    out[some, :DIMS] = mean
    out[some, DIMS : 2 * DIMS] = np.sqrt(np.maximum(square - mean * mean, 0))
    out[some, 2 * DIMS : 3 * DIMS] = np.add.reduceat(index[word] + index[ending], cuts, axis=0) / count
    out[some, 3 * DIMS : 3 * DIMS + 2] = np.add.reduceat(same, cuts, axis=0) / count
    out[some, -1] = np.log1p(n[some])
    pair = np.zeros_like(vector)
    pair[1:] = index[(mix(whole[1:] * np.uint64(3) + whole[:-1]) % np.uint64(BUCKETS)).astype(np.int64)] * near[:, None]
    for k, rows in ((3 * DIMS + 2, index[word]), (3 * DIMS + 4, pair)):
        length = np.square(np.add.reduceat(rows, cuts, axis=0)).sum(axis=1) / 4
        out[some, k] = np.log(length / n[some] ** 2 + 1e-5)
        out[some, k + 1] = np.log(length / n[some] + 0.1)
    return out


@dataclass
class Network:
    shift: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def logit(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum(((x - self.shift) / self.scale) @ self.first + self.first_bias, 0)
        return hidden @ self.second + self.second_bias

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, steps: int = 400, rate: float = 0.01, decay: float = 1e-3) -> Network:
    """Adam on the mean log loss; then the temperature that fits the fifth left out."""
    width = x.shape[1]
    rng = np.random.default_rng(5)
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean() if len(y) else 0.5, 0.01, 0.99)
        return Network(np.zeros(width), np.ones(width), np.zeros((width, 1)), np.zeros(1), np.zeros(1), float(np.log(p / (1 - p))))
    out = np.arange(len(y)) % 5 == 4
    fit_x, fit_y = x[~out], y[~out]
    net = Network(fit_x.mean(0), fit_x.std(0) + 1e-6, rng.normal(0, (2 / width) ** 0.5, (width, hidden)), np.zeros(hidden), rng.normal(0, (1 / hidden) ** 0.5, hidden), 0.0)
    z = (fit_x - net.shift) / net.scale
    values = [net.first, net.first_bias, net.second, np.array([net.second_bias])]
    moment = [[np.zeros_like(v), np.zeros_like(v)] for v in values]
    for step in range(1, steps + 1):
        before = z @ values[0] + values[1]
        h = np.maximum(before, 0)
        p = 1 / (1 + np.exp(-np.clip(h @ values[2] + values[3][0], -40, 40)))
        e = (p - fit_y) / len(fit_y)
        back = np.outer(e, values[2]) * (before > 0)
        slopes = [z.T @ back + decay * values[0] / width, back.sum(0), h.T @ e + decay * values[2], np.array([e.sum()])]
        for v, g, m in zip(values, slopes, moment, strict=True):
            m[0] = 0.9 * m[0] + 0.1 * g
            m[1] = 0.999 * m[1] + 0.001 * g * g
            v -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
    net.second_bias = float(values[3][0])
    if out.any():
        logit, kept = net.logit(x[out]), y[out]

        def loss(t: float) -> float:
            return float(np.mean(np.logaddexp(0, logit / t) - kept * logit / t))

        net.temperature = float(min(np.exp(np.linspace(np.log(0.5), np.log(20), 200)), key=loss))
    return net


@dataclass
class Model:
    table: np.ndarray
    network: Network


def fit(docs: DataFrame, labels: DataFrame, at_most: int = SAMPLE) -> Model:
    """Learn from at most ``at_most`` labelled documents whose crc32(doc_id) mod 4 is not 2."""
    chosen = pin(sample(docs, labels, "quality", at_most, 4, 2), "quality-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, index, table = Hasher(3), index_vectors(), np.zeros((BUCKETS, DIMS), np.float32)
        for batch in pieces(batches, "text", PIECE):
            contexts(batch.column("text"), hasher, index, table)
        for k in range(0, BUCKETS, CHUNK):
            if table[k : k + CHUNK].any():
                yield pa.RecordBatch.from_pydict({"chunk": pa.array([k], pa.int32()), "body": pa.array([table[k : k + CHUNK].tobytes()])})

    def add(group: pa.Table) -> pa.Table:
        whole = sum(np.frombuffer(b.as_buffer(), np.float32).astype(float) for b in group.column("body"))
        return pa.table({"chunk": group.column("chunk").slice(0, 1), "body": pa.array([whole.astype(np.float32).tobytes()])})

    parts = chosen.mapInArrow(count, "chunk int, body binary").groupBy("chunk").applyInArrow(add, "chunk int, body binary")
    table = np.zeros((BUCKETS, DIMS), np.float32)
    for row in parts.collect():  # the table itself: BUCKETS * DIMS numbers, 3 MB
        table[row.chunk : row.chunk + CHUNK] = np.frombuffer(row.body, np.float32).reshape(-1, DIMS)
    table /= np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-6)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, index = Hasher(3), index_vectors()
        for batch in pieces(batches, "text", PIECE):
            rows = pooled(batch.column("text"), hasher, index, table)
            yield pa.RecordBatch.from_pydict({"at": batch.column("doc_id").cast(pa.string()), "label": batch.column("label"), "x": pa.array(list(rows), pa.list_(pa.float64()))})

    rows = chosen.mapInArrow(features, "at string, label int, x array<double>").orderBy(F.xxhash64("at"), "at").collect()  # at_most rows
    x = np.array([r.x for r in rows]).reshape(len(rows), WIDTH)
    return Model(table, train(x, np.array([r.label for r in rows], float)))


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.7, with_text: bool = True) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: label 1 likelier) and ``predicted`` (1 from ``threshold`` on)."""
    kept = [f for f in docs.schema.fields if f.name not in ("score", "predicted") and (with_text or f.name != text)]
    schema = T.StructType([*kept, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, index = Hasher(3), index_vectors()
        for batch in pieces(batches, text, PIECE):
            p = model.network.probability(pooled(batch.column(text), hasher, index, model.table))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=schema.names)

    return docs.mapInArrow(run, schema)
