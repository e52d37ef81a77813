"""Removal of repeated passages: windows of words that an earlier document has too.

Consecutive windows whose smallest word triple is the same one travel as one packed string to the shard of that
triple; there windows are sorted and compared word for word. A block sends each distinct string once with the
smallest document that has it, so a passage shared by any number of documents costs one string per block.

Documents with fewer words than a window are kept whole. A null text has no words; a null key counts as larger
than all others; rows with equal keys never remove words from each other. Windows are judged on the input.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.exchange import answer, ask, blocks, pack, settle, shards_for, unpack
from streamlens.llm.words import Hasher, Words, pieces, split, window_hash

WINDOW = 13
MINIMISER = 3
SHARD_BYTES = 3 << 20


class Runs(NamedTuple):
    """Super-k-mers of a block: ``text[s]`` are distinct strings, string s has ``size[s]`` windows and minimiser
    ``key[s]``; occurrence i is string ``of[i]`` in row ``row[i]`` from word ``word[i]`` of that row on."""

    text: list[bytes]
    key: np.ndarray
    size: np.ndarray
    of: np.ndarray
    row: np.ndarray
    word: np.ndarray


def joined(words: Words) -> tuple[bytes, np.ndarray]:
    """All words with one space after each, and where each begins."""
    size = words.end - words.start
    begin = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(begin[-1], 32, np.uint8)
    shift = np.repeat(begin[:-1] - words.start, size)
    if len(size):
        at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(words.start, size)
        out[at + shift] = words.data[at]
    return out.tobytes(), begin


def super_kmers(rows: pa.RecordBatch, window: int, hasher: Hasher) -> Runs:
    known: dict[bytes, int] = {}
    text: list[bytes] = []
    keys, sizes, ofs, at_row, at_word = [], [], [], [], []
    base = 0
    span = window - MINIMISER + 1
    for piece in pieces(iter([rows])):
        words = split(piece.column("text"))
        n = len(words.start) - window + 1
        if n > 0:
            grams = window_hash_all(hasher(words.data, words.start, words.end))
            least = grams[:n].copy()
            for k in range(1, span):
                np.minimum(least, grams[k : k + n], out=least)
            owner = words.text_of
            inside = owner[:n] == owner[window - 1 :]
            fresh = np.concatenate(([True], (least[1:] != least[:-1]) | ~inside[:-1] | (owner[1:n] != owner[: n - 1]))) & inside
            first = np.flatnonzero(fresh)
            if len(first):
                total = np.concatenate(([0], np.cumsum(inside)))
                count = np.diff(total[np.append(first, n)])
                flat, begin = joined(words)
                a, b = begin[first].tolist(), (begin[first + count + window - 1] - 1).tolist()
                for x, y, k, c in zip(a, b, least[first].tolist(), count.tolist(), strict=True):
                    s = flat[x:y]
                    i = known.get(s)
                    if i is None:
                        i = known[s] = len(text)
                        text.append(s)
                        keys.append(k)
                        sizes.append(c)
                    ofs.append(i)
                at_row.append(owner[first] + base)
                at_word.append(first - words.first[owner[first]])
        base += piece.num_rows
    whole = lambda x: np.concatenate(x) if x else np.zeros(0, np.int64)
    return Runs(text, np.array(keys, np.uint64), np.array(sizes, np.int64), np.array(ofs, np.int64), whole(at_row), whole(at_word))


def window_hash_all(words: np.ndarray) -> np.ndarray:
    """Numbers of all word triples, also of those that cross into the next text; windows inside a text use none of these."""
    return window_hash(words, np.array([0, len(words)]), MINIMISER)[0]


def by_shard(runs: Runs, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings in the order of their shards, and the shard of each."""
    shard = (runs.key % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    return order, shard[order]


def smallest_owner(window: int, hasher: Hasher, bodies: list) -> list[bytes]:
    """For each message of a shard the windows that a smaller document has, and that document."""
    batches = [unpack(b) for b in bodies]
    strings = pa.concat_arrays([b.column("text") for b in batches])
    doc = np.concatenate([b.column("doc").to_numpy() for b in batches])
    count = [len(b) for b in batches]
    words = split(strings)
    h, string = window_hash(hasher(words.data, words.start, words.end), words.first, window)
    per_string = np.maximum(np.diff(words.first) - window + 1, 0)
    first_window = np.concatenate(([0], np.cumsum(per_string)))
    start = words.first[string] + np.arange(len(h)) - first_window[string]
    a, b = words.start[start], words.end[start + window - 1]
    order = np.argsort(h, kind="stable")
    cuts = np.flatnonzero(np.concatenate(([True], np.diff(h[order]) != 0)))
    ends = np.append(cuts[1:], len(h))
    least = np.empty(len(h), np.int64)
    own = doc[string]
    least[order] = np.repeat(np.minimum.reduceat(own[order], cuts), ends - cuts) if len(h) else 0
    flat = words.data.tobytes()
    for x, y in zip(cuts[ends - cuts > 1].tolist(), ends[ends - cuts > 1].tolist(), strict=True):
        members = order[x:y]
        same = [flat[i:j] for i, j in zip(a[members].tolist(), b[members].tolist(), strict=True)]
        if same.count(same[0]) != len(same):  # equal numbers, other words
            best: dict[bytes, int] = {}
            for s, d in zip(same, own[members].tolist(), strict=True):
                best[s] = min(d, best.get(s, d))
            least[members] = [best[s] for s in same]
    out = []
    at = np.concatenate(([0], np.cumsum(count)))
    for i in range(len(batches)):
        lo, hi = first_window[at[i]], first_window[at[i + 1]]
        found = np.flatnonzero(least[lo:hi] < own[lo:hi])
        out.append(pack({"window": found.astype(np.uint32), "doc": least[lo:hi][found]}))
    return out


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``key``, ``n_words``, ``n_removed``, ``kept`` (the words left, joined by one space),
    ``kept_sha256``."""
    rows = docs.select(F.coalesce(F.col(key).cast("long"), F.lit(2**63 - 1)).alias("at"), F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    stored = blocks(rows, "at", "text", ("key",), label="substrings")
    shards = shards_for(stored, shard_bytes)
    hasher = Hasher(7)

    def send(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
        runs = super_kmers(batch, window, hasher)
        if not runs.text:
            return
        least = np.full(len(runs.text), 2**63 - 1)
        np.minimum.at(least, runs.of, batch.column("at").to_numpy()[runs.row])
        order, shard = by_shard(runs, shards)
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        for x, y in zip(cuts.tolist(), np.append(cuts[1:], len(shard)).tolist(), strict=True):
            part = order[x:y]
            yield int(shard[x]), pack({"text": pa.array([runs.text[i] for i in part.tolist()], pa.binary()), "doc": least[part]})

    def reply(_: int, blocks_: list[int], bodies: list) -> tuple[list[bytes], list[int]]:
        return smallest_owner(window, hasher, bodies), []

    def finish(_: int, batch: pa.RecordBatch, got: dict[int, bytes]) -> pa.RecordBatch:
        runs = super_kmers(batch, window, hasher)
        doc = batch.column("at").to_numpy()
        marks: list[np.ndarray] = []
        if runs.text:
            least = np.full(len(runs.text), 2**63 - 1)
            np.minimum.at(least, runs.of, doc[runs.row])
            order, shard = by_shard(runs, shards)
            place = np.empty(len(order), np.int64)
            begin = np.concatenate(([0], np.cumsum(runs.size[order])))
            place[order] = begin[:-1]
            best = np.repeat(least[order], runs.size[order])
            for s, body in got.items():
                reply_ = unpack(body)
                low = begin[np.searchsorted(shard, s)]
                best[low + reply_.column("window").to_numpy()] = reply_.column("doc").to_numpy()
            size = runs.size[runs.of]
            which = np.repeat(np.arange(len(runs.of)), size)
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            hit = best[place[runs.of[which]] + step] < doc[runs.row[which]]
            marks = [runs.row[which[hit]], runs.word[which[hit]] + step[hit]]
        n_words, removed, kept = [], [], []
        base = 0
        for piece in pieces(iter([batch])):
            words = split(piece.column("text"))
            change = np.zeros(len(words.start) + 1, np.int64)
            if marks:
                here = (marks[0] >= base) & (marks[0] < base + piece.num_rows)
                first = words.first[marks[0][here] - base] + marks[1][here]
                np.add.at(change, first, 1)
                np.add.at(change, first + window, -1)
            keep = np.cumsum(change[:-1]) == 0
            flat, begin = joined(Words(words.data, words.offsets, words.start[keep], words.end[keep], words.first))
            left = np.concatenate(([0], np.cumsum(keep)))[words.first]
            for i in range(piece.num_rows):
                kept.append(flat[begin[left[i]] : max(begin[left[i]], begin[left[i + 1]] - 1)])
            n_words.append(np.diff(words.first))
            removed.append(np.diff(words.first) - np.diff(left))
            base += piece.num_rows
        return pa.RecordBatch.from_pydict({
            key: batch.column("key"), "n_words": pa.array(np.concatenate(n_words), pa.int64()),
            "n_removed": pa.array(np.concatenate(removed), pa.int64()), "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept]),
        })

    answers = answer(ask(stored, send), reply)
    schema = f"`{key}` long, n_words long, n_removed long, kept string, kept_sha256 string"
    return settle(stored, answers, finish, schema)
