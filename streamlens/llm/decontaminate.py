"""Benchmark passages in documents: edit distance by a random walk into Hamming space, bit sampling, exact check.

Words are compared: A-Z (and Latin-1 capitals) in lower case, other ASCII signs than letters and digits are blanks.
In scripts that are written without blanks (Chinese, Japanese, Thai and others, ``LETTERS``) each letter is a word.

A window of words is embedded by a random walk: at step j it shows the word it stands on and moves on if bit j of that
word's number is set. After an edit the two walks soon run together again, so a small edit distance becomes a small
Hamming distance of what the walks show. Items fall in size classes c (4, 6, 8, 12, 16 …, the largest not above their
words). The walks of a class have 3c/2 steps, which pass over 3c/4 words on average: the window that is left of an item
wherever in its first quarter it is entered. Documents are entered at every c/4-th word, items at all. Each of
``c + 16`` tables reads ``READ`` steps of a walk (bit sampling); a window agrees with an item if one table's reading is the
same. With these numbers at least ``RECALL`` of the hits with all edits allowed are found by walks alone; ``tests/llm``
measures it for each length from 8 to 64. What agrees is compared by the exact word edit distance (bit-parallel, best
end in the window around it). A hit has at most ``EDITS`` edits per word of the item.

Beside the walks stands an exact lookup that makes recall whole: an item is cut into one part more than edits are
allowed, a hit leaves one part as it is, and runs of the parts' sizes are looked up (``exact=False`` leaves it out).
Items in which no edit is allowed (up to 4 words) have one part, and no walks.

The benchmark's distinct texts are numbered and collected in slices of at most ``ITEMS``, each slice a pass over the
documents, so what the driver and a task hold is bounded whatever the benchmark holds; equal items are searched once.
Items of fewer than ``least_words`` words, null items included, are not searched: single words are too common to mean
anything (default ``LEAST_WORDS``). Null and empty documents have no hits. Repeated rows give repeated decisions. Of
several places of equal distance in a text the first that was compared counts. Very long texts are runs of their own.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.words import Hasher, Words, mix, pieces, split, window_hash
from streamlens.operators.ordered import cut, running
from streamlens.session import pin

ITEMS = 1_000
EDITS = 0.2
RECALL = 0.95
READ = 4
LEAST_WORDS = 2
FACTORS = [np.uint64(x) for x in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]  # odd, one per step read
PIECE = 1 << 19
BROADCAST_DIGESTS = 100_000  # of 64 letters each


class Walk(NamedTuple):
    """Walks of a size class: how far apart documents are entered, the steps, and the steps that each table reads."""

    stride: int
    steps: int
    tables: list[list[int]]


def size_class(n: int) -> int:
    """The largest of 4, 6, 8, 12, 16, 24 … that is not above n."""
    power = 1 << (n.bit_length() - 1)
    return power + power // 2 if n >= power + power // 2 else power


def walk_of(size: int) -> Walk:
    rng = np.random.default_rng(size)
    steps = size + size // 2
    return Walk(max(1, size // 4), steps, [sorted(rng.choice(steps, READ, replace=False).tolist()) for _ in range(size + 16)])


#: Ranges of letters of scripts without blanks, and of their signs, which are blanks (first and last code point).
LETTERS = (
    (0x0E00, 0x0EFF), (0x0F00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19DF), (0x1A20, 0x1AAF), (0x3005, 0x3007), (0x3021, 0x3029),
    (0x3031, 0x3035), (0x3038, 0x30FA), (0x30FC, 0x312F), (0x31A0, 0x31BF), (0x31F0, 0x31FF), (0x3400, 0x9FFF), (0xA9E0, 0xA9FF),
    (0xAA60, 0xAADF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1B000, 0x1B16F), (0x20000, 0x3FFFF),
)
SIGNS = ((0x3000, 0x3003), (0x3008, 0x3020), (0x3030, 0x3030), (0x3036, 0x3037), (0x30FB, 0x30FB), (0xFF01, 0xFF0F), (0xFF1A, 0xFF20), (0xFF3B, 0xFF40), (0xFF5B, 0xFF65))
_PLAIN = np.array([b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)], np.uint8)


def plain_words(texts: pa.Array) -> Words:
    """Words of the texts in the form in which they are compared."""
    words = split(texts, lower=True)
    data = _PLAIN[words.data]
    capital = np.zeros(len(data), bool)
    capital[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    data[capital] += 0x20
    begin, end = _letters(data)
    offsets = words.offsets.astype(np.int64)
    plain = split(pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(data.tobytes())))
    if not len(begin):
        return plain
    cut = np.union1d(begin, end)
    at = np.searchsorted(plain.start, cut, "left") - 1
    cut = cut[(at >= 0) & (cut < plain.end[np.maximum(at, 0)])]
    start = np.sort(np.concatenate((plain.start, cut)))
    return Words(plain.data, plain.offsets, start, np.sort(np.concatenate((plain.end, cut))), np.searchsorted(start, plain.offsets))


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the letters of ``LETTERS`` begin and end in UTF-8 bytes; ``SIGNS`` become blanks."""
    begins, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for low, high, size in ((0xE0, 0xEF, 3), (0xF0, 0xF4, 4)):
        at = np.flatnonzero((data >= low) & (data <= high))
        code = data[at].astype(np.int64) - low
        for k in range(1, size):
            code = code << 6 | (data[at + k] & 0x3F)
        letter, sign = ((np.logical_or.reduce([(code >= a) & (code <= b) for a, b in ranges])) for ranges in (LETTERS, SIGNS))
        begins.append(at[letter])
        ends.append(at[letter] + size)
        for k in range(size):
            data[at[sign] + k] = 32
    return np.concatenate(begins), np.concatenate(ends)


def walk_hashes(numbers: np.ndarray, starts: np.ndarray, walk: Walk) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For a walk from each start: the number each table reads, and the place of the last step it reads.

    A zero ends a text: walks stay on it.
    """
    padded = np.append(numbers, np.uint64(0))
    at = starts.copy()
    read = [np.full(len(at), k + 1, np.uint64) for k in range(len(walk.tables))]
    last = [at] * len(walk.tables)
    readers: list[list[tuple[int, np.uint64]]] = [[] for _ in range(walk.steps)]
    for k, steps in enumerate(walk.tables):
        for j, factor in zip(steps, FACTORS, strict=True):
            readers[j].append((k, factor))
    bits, term = padded, np.empty(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(walk.steps):
            if j and j % 64 == 0:  # further bits of each word
                bits = np.where(padded == 0, np.uint64(0), mix(padded + np.uint64(j)))
            here = padded[at]
            for k, factor in readers[j]:
                np.multiply(here, factor, out=term)
                np.add(read[k], term, out=read[k])
                last[k] = at
            at = at + ((bits[at] >> np.uint64(j % 64)) & np.uint64(1)).astype(np.int64)
    return read, last


class Table(NamedTuple):
    """Numbers of one table over all items, sorted, with the item and offset of each, and a bitmap of their first bits."""

    number: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    bitmap: np.ndarray
    shift: np.uint64


class Index(NamedTuple):
    """``tables``: the walks of each size class of items; ``parts``: for each size of parts the table of their numbers."""

    key: list
    words: list[np.ndarray]
    masks: list[dict[int, int]]
    tables: list[tuple[Walk, list[Table]]]
    parts: list[tuple[int, Table]]


def table(number: np.ndarray, item: np.ndarray, offset: np.ndarray) -> Table:
    order = np.lexsort((offset, item, number))
    bits = len(number).bit_length() + 3
    shift = np.uint64(64 - bits)
    bitmap = np.zeros(1 << bits, bool)
    bitmap[(number >> shift).astype(np.int64)] = True
    return Table(number[order], item[order].astype(np.int32), offset[order].astype(np.int32), bitmap, shift)


def runs_of(numbers: np.ndarray, size: int) -> np.ndarray:
    """Numbers of all runs of ``size`` words."""
    return window_hash(numbers, np.array([0, len(numbers)]), size)[0]


def build(keys: list, texts: list[str | None], edits: float = EDITS, least_words: int = LEAST_WORDS, exact: bool = True) -> Index:
    hasher = Hasher(13)
    words = plain_words(pa.array(texts, pa.string()))
    numbers = hasher(words.data, words.start, words.end)
    own = [numbers[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
    masks = []
    for item in own:
        mask: dict[int, int] = {}
        for i, w in enumerate(item.tolist()):
            mask[w] = mask.get(w, 0) | 1 << i
        masks.append(mask)
    classes: dict[int, list[int]] = {}
    for i, item in enumerate(own):
        if int(edits * len(item)) and len(item) >= max(least_words, 4):
            classes.setdefault(size_class(len(item)), []).append(i)
    found = []
    for size, members in sorted(classes.items()):
        walk = walk_of(size)
        length = np.array([len(own[i]) for i in members])
        begin = np.cumsum(length + 1) - length - 1
        apart = np.concatenate([np.append(own[i], np.uint64(0)) for i in members])
        starts = np.flatnonzero(apart)
        which = np.searchsorted(begin, starts, "right") - 1
        read, last = walk_hashes(apart, starts, walk)
        made = []
        for number, end in zip(read, last, strict=True):
            whole = apart[end] != 0  # a reading of the item alone
            made.append(table(number[whole], np.array(members)[which[whole]], (starts - begin[which])[whole]))
        found.append((walk, made))
    parts: dict[int, list[tuple[int, int, int]]] = {}
    for i, item in enumerate(own):
        n = len(item)
        if n >= least_words and (exact or not int(edits * n)):
            count = min(int(edits * n) + 1, n)
            for a, b in ((n * k // count, n * (k + 1) // count) for k in range(count)):
                parts.setdefault(b - a, []).append((int(runs_of(item[a:b], b - a)[0]), i, a))
    parted = [(size, table(*(np.array(c, k) for c, k in zip(zip(*rows), (np.uint64, np.int64, np.int64))))) for size, rows in parts.items()]
    return Index(keys, own, masks, found, parted)


def candidates(numbers: np.ndarray, index: Index, row_of: np.ndarray, first: np.ndarray) -> set[tuple[int, int, int]]:
    """(row of the agreement, item, place of its first word) for each agreement of a table. The place can lie outside the row."""
    out: set[tuple[int, int, int]] = set()

    def agree(number: np.ndarray, known: Table, place: np.ndarray) -> None:
        maybe = np.flatnonzero(known.bitmap[(number >> known.shift).astype(np.int64)])
        lo = np.searchsorted(known.number, number[maybe], "left")
        hi = np.searchsorted(known.number, number[maybe], "right")
        at = maybe[hi > lo]
        at = place[at]
        for p, row, a, b in zip(at.tolist(), row_of[at].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
            out.update((row, i, p - o) for i, o in zip(known.item[a:b].tolist(), known.offset[a:b].tolist(), strict=True))

    every = np.arange(len(numbers))
    entry = every - first[row_of]
    for walk, made in index.tables:
        starts = every[(entry % walk.stride == 0) & (numbers != 0)]
        read, _ = walk_hashes(numbers, starts, walk)
        for number, known in zip(read, made, strict=True):
            agree(number, known, starts)
    for size, known in index.parts:
        agree(runs_of(numbers, size), known, every)
    return out


def best_match(mask: dict[int, int], n: int, text: list[int]) -> tuple[int, int]:
    """Least edit distance of an item of n words to any run of ``text``, and where the best run ends."""
    high, full = 1 << (n - 1), (1 << n) - 1
    up, down, distance = full, 0, n
    best, end = n, 0
    for k, w in enumerate(text):
        eq = mask.get(w, 0)
        x = eq | down
        d0 = (((eq & up) + up) ^ up) | x
        right, left = down | (full & ~(d0 | up)), up & d0
        if right & high:
            distance += 1
        elif left & high:
            distance -= 1
        right, left = (right << 1) & full, (left << 1) & full
        up, down = left | (full & ~(d0 | right)), right & d0
        if distance < best:
            best, end = distance, k + 1
    return best, end


class Hit(NamedTuple):
    row: int
    item: int
    distance: int
    start: int


def search(texts: pa.Array, index: Index, hasher: Hasher, edits: float) -> list[Hit]:
    """The best occurrence of each item in each text."""
    words = plain_words(texts)
    numbers = hasher(words.data, words.start, words.end)
    if not len(numbers):
        return []
    # A zero after each row stops the walks there, so rows do not depend on those beside them.
    row_of = words.text_of
    first = words.first + np.arange(len(words.first))
    apart = np.zeros(first[-1], np.uint64)
    apart[np.arange(len(numbers)) + row_of] = numbers
    found: dict[tuple[int, int], Hit] = {}
    tried: set[tuple[int, int, int]] = set()
    for row, item, place in sorted(candidates(apart, index, np.repeat(np.arange(len(first) - 1), np.diff(first)), first)):
        n = len(index.words[item])
        slack = int(edits * n)
        begin, end = int(first[row]), int(first[row + 1]) - 1
        step = max(slack, 1)
        rough = (place - begin) // step
        if (item, row, rough) in tried:
            continue
        tried.add((item, row, rough))
        a, b = max(begin, begin + rough * step - slack), min(end, begin + (rough + 1) * step + n + slack)
        run, mask = apart[a:b].tolist(), index.masks[item]
        if sum(map(mask.__contains__, run)) < n - slack:  # too few words of the item for so few edits
            continue
        distance, stop = best_match(mask, n, run)
        if distance <= slack and (known := found.get((row, item))) is None or distance <= slack and distance < known.distance:
            found[row, item] = Hit(row, item, distance, max(0, a - begin + stop - n))
    return list(found.values())


def _numbered(benchmark: DataFrame, item: str, text: str) -> tuple[DataFrame, DataFrame]:
    """Distinct texts ``(no, text)`` and the items ``(no, item)`` that have them. Equal texts share a number."""
    texts = benchmark.select(F.col(text).alias("text")).where("text IS NOT NULL").distinct()
    numbered = running(cut(pin(texts, "benchmark-texts"), [], ["text"]), {"no": ("count", F.lit(1))}).result()
    numbered = pin(numbered.select((F.col("no") - 1).cast("long").alias("no"), "text"), "benchmark")
    items = benchmark.select(F.col(item).alias("_item"), F.col(text).alias("text")).join(numbered, "text").select("no", "_item")
    return numbered, pin(items, "benchmark-items")


def _slices(numbered: DataFrame) -> Iterator[dict]:
    """The benchmark in slices of ``ITEMS`` texts, by their numbers."""
    for k in range(-(-numbered.count() // ITEMS)):
        rows = numbered.where((F.col("no") >= k * ITEMS) & (F.col("no") < (k + 1) * ITEMS)).collect()
        yield {"keys": [r.no for r in rows], "texts": [r.text for r in rows]}


def _found(docs: DataFrame, numbered: DataFrame, edits: float, least_words: int) -> DataFrame:
    """``key``, ``no``, ``distance``, ``similarity``, ``start_word``, ``item_words`` for rows ``key``, ``text``."""
    schema = f"key {docs.schema['key'].dataType.simpleString()}, no long, distance long, similarity double, start_word long, item_words long"
    out = docs.sparkSession.createDataFrame([], schema)
    for part in _slices(numbered):
        shared = docs.sparkSession.sparkContext.broadcast(part)  # at most ITEMS texts

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            hasher, held = Hasher(13), shared.value
            if "index" not in held:  # a worker keeps it for its later tasks
                held["index"] = build(held["keys"], held["texts"], edits, least_words)
            index = held["index"]
            for batch in pieces(batches, "text", PIECE):
                got = sorted(search(batch.column("text"), index, hasher, edits))
                if got:
                    size = np.array([len(index.words[h.item]) for h in got])
                    distance = np.array([h.distance for h in got])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("key").take(pa.array([h.row for h in got])), pa.array([index.key[h.item] for h in got], pa.int64()),
                            pa.array(distance, pa.int64()), pa.array(1 - distance / size), pa.array([h.start for h in got], pa.int64()),
                            pa.array(size, pa.int64()),
                        ],
                        names=["key", "no", "distance", "similarity", "start_word", "item_words"],
                    )

        out = out.unionByName(docs.mapInArrow(run, schema))
    return out


def hits(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text",
         edits: float = EDITS, least_words: int = LEAST_WORDS) -> DataFrame:
    """One row per document and item found in it: ``key``, ``item``, ``distance`` (words), ``similarity``,
    ``start_word`` (among the document's words as compared) and ``item_words``. Keys and items may be of any type."""
    numbered, items = _numbered(benchmark, item, item_text)
    found = _found(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), numbered, edits, least_words)
    return found.join(items, "no").select(
        F.col("key").alias(key), F.col("_item").alias(item), "distance", "similarity", "start_word", "item_words"
    )


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", item: str = "item_id", item_text: str = "text",
          edits: float = EDITS, least_words: int = LEAST_WORDS) -> DataFrame:
    """``docs`` without those that hold an item of the benchmark. A decision depends on the text alone, so texts with
    hits are left out by one anti-join, however many slices the benchmark has."""
    numbered, _ = _numbered(benchmark, item, item_text)
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    found = _found(docs.select(digest.alias("key"), F.col(text).alias("text")), numbered, edits, least_words)
    bad = pin(found.select(F.col("key").alias("_digest")).distinct(), "contaminated")
    if bad.count() <= BROADCAST_DIGESTS:
        bad = F.broadcast(bad)
    kept = docs.withColumn("_digest", digest).join(bad, "_digest", "left_anti")
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
