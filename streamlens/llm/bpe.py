"""BPE encoding and decoding with an index from pairs to their positions.

The new words of a run of texts are laid out as one chain of symbols. The index maps the rank of each adjacent
pair to all its positions; the lowest active rank is applied everywhere, and the lists of the pairs it makes
are updated. A word is encoded once per partition while it stays in the memo, which is emptied when it holds
``MEMO_WORDS`` words, so memory is bounded whatever the partition holds.

Nulls count as empty texts, empty texts give no ids, a text of any length is one row. Columns other than the
key and the text are kept by ``encode`` unless they clash with its results, which then win.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from streamlens.llm.words import pieces

MEMO_WORDS = 400_000
RUN_BYTES = 4 << 20


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    shown = {b: chr(b) for b in plain}
    for b in range(256):
        shown.setdefault(b, chr(256 + len(shown) - len(plain)))
    return [shown[b] for b in range(256)]


def distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.diff(x, prepend=-1) > 0]


class Vocabulary:
    """Ids, merges and text rules of a tokenizer file with word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.end = model["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = [""] * (1 + max([*self.ids.values(), *self.special.values()]))
        for text, i in (*self.ids.items(), *self.special.items()):
            self.token[i] = text
        parts = [(self.ids[a], self.ids[b], self.ids[a + b]) for a, b in (m.split(" ") if isinstance(m, str) else m for m in model["merges"])]
        self.left, self.right, self.made = (np.array(x, np.int64) for x in zip(*parts, strict=True))
        born = np.full(len(self.token), -1)
        born[self.made] = np.arange(len(parts))
        if len(set(self.made.tolist())) < len(parts) or (np.maximum(born[self.left], born[self.right]) >= np.arange(len(parts))).any():
            raise ValueError("merges must come after those that make their parts, and make each token once")
        key = self.left << 32 | self.right
        self.by_key = np.argsort(key)
        self.key = key[self.by_key]
        letters = byte_letters()
        self.inner = np.array([self.ids[x] for x in letters], np.int64)
        self.last = np.array([self.ids[x + self.end] for x in letters], np.int64)
        self.odd = re.compile("[\x1c-\x1f]")
        self.blank = regex.compile(r"\p{White_Space}+")
        self.cut = regex.compile("|".join(regex.escape(s) for s in self.special))
        self.word = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\p{White_Space}\p{L}\p{N}]+")

    def words(self, text: str) -> list[str]:
        """Parts between white space. Lower case is by letter, so a final sigma is not special."""
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return text.split() if not self.odd.search(text) else self.blank.split(text)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, -1 for pairs that are never merged."""
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where(self.key[at] == key, self.by_key[at], -1)

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids of each word as 32-bit little-endian numbers, by one pass over the ranks that are active in all of them.

        ``index`` maps a rank to the positions of its pair. A pair made by a merge has a higher rank than the
        merge (checked when the vocabulary is read), so each rank is applied once, to all its positions.
        """
        if not words:
            return []
        data = [w.encode() for w in words]
        ends = np.cumsum([len(d) for d in data])
        raw = np.frombuffer(b"".join(data), np.uint8)
        symbol = self.inner[raw]
        symbol[ends - 1] = self.last[raw[ends - 1]]
        n = len(symbol)
        after = np.arange(1, n + 1)
        after[ends - 1] = -1
        before = np.arange(-1, n - 1)
        before[ends[:-1]] = -1
        before[0] = -1
        index: dict[int, list[np.ndarray]] = {}
        active: list[int] = []

        def note(places: np.ndarray) -> None:
            """Add positions whose right neighbour or symbol is new to the lists of their pairs."""
            ranks = self.rank(symbol[places], symbol[after[places]])
            places, ranks = places[ranks >= 0], ranks[ranks >= 0]
            if not len(ranks):
                return
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(np.diff(ranks, prepend=-1))
            for k, a, b in zip(ranks[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ranks)], strict=True):
                if k not in index:
                    index[k] = []
                    heapq.heappush(active, k)
                index[k].append(places[a:b])

        note(np.flatnonzero(after >= 0))
        while active:
            k = heapq.heappop(active)
            left, right = self.left[k], self.right[k]
            lists = index.pop(k)
            at = lists[0] if len(lists) == 1 else distinct(np.concatenate(lists))
            at = at[(symbol[at] == left) & (after[at] >= 0)]
            at = at[symbol[after[at]] == right]
            if left == right and len(at) > 1:  # aaa: the leftmost pair wins
                taken, kept = -1, []
                for p in np.sort(at).tolist():
                    if p != taken:
                        kept.append(p)
                        taken = after[p]
                at = np.array(kept)
            if not len(at):
                continue
            gone = after[at]
            symbol[at], symbol[gone] = self.made[k], -1
            far = after[gone]
            after[at] = far
            before[far[far >= 0]] = at[far >= 0]
            ahead = before[at]
            note(distinct(np.concatenate((ahead[ahead >= 0], at[far >= 0]))))
        live = symbol >= 0
        flat = symbol[live].astype("<u4").tobytes()
        stops = (4 * np.cumsum(live)[ends - 1]).tolist()
        return [flat[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]

    def encode(self, texts: list[str | None], memo: dict[str, bytes]) -> list[np.ndarray]:
        """Ids of whole texts. Special tokens in a text are their own ids."""
        rows: list[list[list[str] | int]] = []
        new: dict[str, list[str]] = {}
        for text in texts:
            row: list[list[str] | int] = []
            at = 0
            for m in self.cut.finditer(text or ""):
                row += [self.words(text[at : m.start()]), self.special[m.group()]]
                at = m.end()
            row.append(self.words((text or "")[at:]))
            rows.append(row)
            for part in row:
                if isinstance(part, list):
                    new.update(dict.fromkeys((w for w in part if w not in memo), ()))
        for word in new:
            new[word] = self.word.findall(word)
        pieces = list(dict.fromkeys(p for found in new.values() for p in found))
        ids = dict(zip(pieces, self.encode_words(pieces), strict=True))
        for word, found in new.items():
            memo[word] = b"".join(map(ids.__getitem__, found))
        get = memo.__getitem__
        return [
            np.frombuffer(b"".join(b"".join(map(get, p)) if isinstance(p, list) else np.array([p], "<u4").tobytes() for p in row), "<u4")
            for row in rows
        ]

    def decode(self, ids: np.ndarray) -> str:
        """Tokens joined by a space, as a tokenizer without a decoder gives them; special tokens stay."""
        return " ".join(map(self.token.__getitem__, ids.tolist()))


ENCODED = "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string"


def encode(docs: DataFrame, vocabulary: str, text: str = "text", ids: bool = True) -> DataFrame:
    """``docs`` without its text, with the ids of the whole text and digests of the ids and of their decoding.

    ``vocabulary`` is the path of a tokenizer file; it is read on the driver and sent to the tasks (3 MB).
    """
    vocab = Vocabulary(vocabulary)
    wanted = [f for f in T.StructType.fromDDL(ENCODED).fields if ids or f.name != "ids"]
    names = {f.name for f in wanted}
    kept = [f for f in docs.schema.fields if f.name not in names | {text}]
    schema = T.StructType([*kept, *wanted])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict[str, bytes] = {}
        for batch in pieces(batches, text, RUN_BYTES):
            rows = vocab.encode(batch.column(text).to_pylist(), memo)
            out = {f.name: batch.column(f.name) for f in kept}
            out["n_tokens"] = pa.array([len(x) for x in rows], pa.int64())
            if ids:
                flat = np.concatenate(rows).astype(np.int32)
                ends = np.cumsum([0, *map(len, rows)])
                out["ids"] = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))
            out["ids_sha256"] = pa.array([hashlib.sha256(x.tobytes()).hexdigest() for x in rows])
            out["decoded_sha256"] = pa.array([hashlib.sha256(vocab.decode(x).encode()).hexdigest() for x in rows])
            yield pa.RecordBatch.from_pydict(out)
            if len(memo) > MEMO_WORDS:
                memo.clear()

    return docs.mapInArrow(run, schema)


def decode(encoded: DataFrame, vocabulary: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with a column ``decoded``: the tokens of ``ids`` joined by a space. Null ids give an empty text."""
    vocab = Vocabulary(vocabulary)
    kept = [f for f in encoded.schema.fields if f.name != "decoded"]
    schema = T.StructType([*kept, T.StructField("decoded", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {f.name: batch.column(f.name) for f in kept}
            out["decoded"] = pa.array([vocab.decode(np.array(x or [], np.int64)) for x in batch.column(ids).to_pylist()], pa.string())
            yield pa.RecordBatch.from_pydict(out)

    return encoded.mapInArrow(run, schema)
