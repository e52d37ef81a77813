"""Language-model scores from n-gram counts of the whole corpus, kept in Elias-Fano tries.

Counting and scoring are two rounds of questions (see ``exchange``). In the first, blocks send their distinct words
and shards answer with totals over the training documents and a number for each word. In the second, blocks send
their distinct word pairs; a shard builds the trie of its training pairs and answers with quantised probabilities.
A frequent first word is spread over several shards by its second word, so no shard grows with one word.

The model is interpolated: p(w | v) = a * n(v, w) / n(v) + (1 - a) * (c(w) + 1) / (N + V + 1). The weight a belongs
to the size class of n(v) and is the share n / (n + kinds) of that class, kinds being its distinct pairs. The end of
a document is a token, and also what stands before its first word.

Null texts have the end as their only token. Without training documents every token has probability 1 / 1.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.llm.elias_fano import Trie, decoded
from streamlens.llm.exchange import answer, ask, blocks, pack, settle, shards_for, totals, unpack
from streamlens.llm.words import Hasher, mix, pieces, split
from streamlens.session import pin

SHARD_BYTES = 5 << 20
BLOCK_BYTES = 4 << 20
CLASSES = 64
SPREAD = 64
END = np.uint64(0xE0D0F0A11D0C5)


def tokens(rows: pa.RecordBatch, hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of all tokens of a block, the end of each text included, and the row of each."""
    numbers, owner, base = [], [], 0
    for piece in pieces(iter([rows])):
        words = split(piece.column("text"), lower=True)
        h = hasher(words.data, words.start, words.end)
        n = np.diff(words.first)
        out = np.full(len(h) + len(n), END)
        row = np.repeat(np.arange(len(n)), n + 1)
        out[np.arange(len(h)) + words.text_of] = h
        numbers.append(out)
        owner.append(row + base)
        base += piece.num_rows
    return np.concatenate(numbers), np.concatenate(owner)


def by_shard(shard: np.ndarray, shards: int) -> tuple[np.ndarray, list[tuple[int, int, int]]]:
    """Items in the order of their shards, and where each shard's run begins and ends."""
    order = np.argsort(shard, kind="stable")
    cuts = np.searchsorted(shard[order], np.arange(shards + 1)).tolist()
    return order, [(s, a, b) for s, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a]


def size_class(count: np.ndarray) -> np.ndarray:
    return np.frexp(count.astype(float))[1]


class Block:
    """The distinct words and pairs of a block, and the order in which it asks for them."""

    def __init__(self, rows: pa.RecordBatch, hasher: Hasher, shards: int):
        self.shards = shards
        self.number, self.row = tokens(rows, hasher)
        self.train = rows.column("train").to_numpy(zero_copy_only=False)[self.row]
        self.words, self.word = np.unique(self.number, return_inverse=True)
        self.order, self.runs = by_shard((mix(self.words) % np.uint64(shards)).astype(np.int64), shards)

    def word_messages(self) -> Iterator[tuple[int, bytes]]:
        seen = np.bincount(self.word, self.train, len(self.words)).astype(np.int64)
        for s, a, b in self.runs:
            part = self.order[a:b]
            yield s, pack({"word": self.words[part], "count": seen[part]})

    def learn_words(self, got: dict[int, bytes], total: int) -> None:
        """Take the answers about words; list the pairs."""
        self.count = np.zeros(len(self.words), np.int64)
        self.id = np.zeros(len(self.words), np.int64)
        for s, a, b in self.runs:
            reply = unpack(got[s])
            self.count[self.order[a:b]] = reply.column("count").to_numpy()
            self.id[self.order[a:b]] = reply.column("id").to_numpy()
        end = int(np.searchsorted(self.words, END))
        first = np.diff(self.row, prepend=-1) != 0
        before = np.where(first, end, np.roll(self.word, 1))
        key, self.pair = np.unique(before * len(self.words) + self.word, return_inverse=True)
        self.left, self.right = key // len(self.words), key % len(self.words)
        wide = self.count[self.left] * self.shards * 8 > total
        salt = np.where(wide, 1 + self.id[self.right] % SPREAD, 0)
        shard = mix((self.id[self.left] * (SPREAD + 1) + salt).astype(np.uint64)) % np.uint64(self.shards)
        self.pair_order, self.pair_runs = by_shard(shard.astype(np.int64), self.shards)

    def pair_messages(self) -> Iterator[tuple[int, bytes]]:
        seen = np.bincount(self.pair, self.train, len(self.left)).astype(np.int64)
        for s, a, b in self.pair_runs:
            part = self.pair_order[a:b]
            run = self.left[part]
            cuts = np.flatnonzero(np.diff(run, prepend=-1))
            yield s, pack({
                "left": pa.array([self.id[run[cuts]]]), "n_left": pa.array([self.count[run[cuts]]]),
                "length": pa.array([np.diff(np.append(cuts, len(run))).astype(np.int32)]),
                "right": pa.array([self.id[self.right[part]]]), "count": pa.array([seen[part].astype(np.int32)]),
            })

    def pair_probability(self, got: dict[int, bytes]) -> np.ndarray:
        out = np.zeros(len(self.left))
        for s, a, b in self.pair_runs:
            out[self.pair_order[a:b]] = decoded(unpack(got[s]).column("code").to_numpy())
        return out


def count_words(shard: int, shards: int, bodies: list) -> tuple[list[bytes], list[int]]:
    """Totals and numbers of the words of a shard; totals of words, tokens and, by size class, both again."""
    batches = [unpack(b) for b in bodies]
    word = np.concatenate([b.column("word").to_numpy() for b in batches])
    count = np.concatenate([b.column("count").to_numpy() for b in batches])
    distinct, at = np.unique(word, return_inverse=True)
    total = np.bincount(at, count, len(distinct)).astype(np.int64)
    out, begin = [], 0
    for b in batches:
        part = at[begin : begin + len(b)]
        out.append(pack({"count": total[part], "id": part * shards + shard}))
        begin += len(b)
    tokens_in = np.bincount(size_class(total), total, CLASSES + 1).astype(np.int64)
    return out, [int((total > 0).sum()), int(total.sum()), len(distinct), *tokens_in.tolist()]


def answer_pairs(bodies: list) -> tuple[list[bytes], list[int]]:
    """The trie of a shard's training pairs, looked up for each message; totals: distinct pairs by size class."""
    left, n_left, right, count, sizes = [], [], [], [], []
    for body in bodies:
        b = unpack(body)
        column = lambda name, b=b: b.column(name)[0].values.to_numpy()
        length = column("length")
        left.append(np.repeat(column("left"), length))
        n_left.append(np.repeat(column("n_left"), length))
        right.append(column("right"))
        count.append(column("count"))
        sizes.append(len(right[-1]))
    left, n_left, right, count = (np.concatenate(x) for x in (left, n_left, right, count))
    universe = int(max(left.max(), right.max())) + 1
    seen = np.flatnonzero(count > 0)
    order = seen[np.lexsort((right[seen], left[seen]))]
    a, b = left[order], right[order]
    first = np.flatnonzero((np.diff(a, prepend=-1) != 0) | (np.diff(b, prepend=-1) != 0))
    total = np.add.reduceat(count[order].astype(np.int64), first) if len(first) else np.zeros(0, np.int64)
    n = n_left[order][first]
    trie = Trie(a[first], b[first], total / np.maximum(n, 1), universe)
    code = trie.lookup(left, right)
    out, begin = [], 0
    for size in sizes:
        out.append(pack({"code": code[begin : begin + size]}))
        begin += size
    return out, np.bincount(size_class(n), minlength=CLASSES + 1).tolist()


def score(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``key``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` (add-one word model),
    ``score`` (log10 probability). ``train`` tells which rows are learned from."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), train.alias("train"))
    stored = blocks(rows, "key", "text", ("train",), BLOCK_BYTES, "lm")
    shards = shards_for(stored, shard_bytes)
    hasher = Hasher(17)

    def reply_words(shard: int, _: list[int], bodies: list) -> tuple[list[bytes], list[int]]:
        return count_words(shard, shards, bodies)

    words = pin(answer(ask(stored, lambda batch: Block(batch, hasher, shards).word_messages()), reply_words), "lm-words")
    kinds, n_train, _, *class_tokens = totals(words) or [0] * (CLASSES + 4)

    def pairs(block: int, batch: pa.RecordBatch, got: dict[int, bytes]) -> pa.RecordBatch:
        own = Block(batch, hasher, shards)
        own.learn_words(got, n_train)
        sent = list(own.pair_messages())
        return pa.RecordBatch.from_pydict({
            "block": pa.array([block] * len(sent), pa.int64()), "shard": pa.array([s for s, _ in sent], pa.int32()),
            "body": pa.array([b for _, b in sent], pa.binary()),
        })

    asked = settle(stored, words, pairs, "block long, shard int, body binary")
    found = pin(answer(asked, lambda shard, blocks_, bodies: answer_pairs(bodies)), "lm-pairs")
    class_pairs = totals(found) or [0] * (CLASSES + 1)
    n, k = np.array(class_tokens, float), np.array(class_pairs, float)
    weight = np.where(n > 0, n / np.maximum(n + k, 1), 0.0)

    def finish(_: int, batch: pa.RecordBatch, got: dict[int, bytes]) -> pa.RecordBatch:
        own = Block(batch, hasher, shards)
        own.learn_words({s: b for s, b in got.items() if s < shards}, n_train)
        pair = own.pair_probability({s - shards: b for s, b in got.items() if s >= shards})
        plain = (own.count + 1) / (n_train + kinds + 1)
        a = np.where(own.count > 0, weight[size_class(own.count)], 0.0)[own.left]
        mixed = a * pair + (1 - a) * plain[own.right]
        docs_in = batch.num_rows
        return pa.RecordBatch.from_pydict({
            key: batch.column("key"), "n_tokens": pa.array(np.bincount(own.row, minlength=docs_in)),
            "n_known": pa.array(np.bincount(own.row, own.count[own.word] > 0, docs_in).astype(np.int64)),
            "train_tokens": pa.array([n_train] * docs_in, pa.int64()),
            "base_score": pa.array(np.bincount(own.row, np.log10(plain)[own.word], docs_in)),
            "score": pa.array(np.bincount(own.row, np.log10(mixed)[own.pair], docs_in)),
        })

    both = words.select("block", "shard", "body").unionByName(found.select("block", (F.col("shard") + shards).alias("shard"), "body"))
    kind = docs.schema[key].dataType.simpleString()
    return settle(stored, both, finish, f"`{key}` {kind}, n_tokens long, n_known long, train_tokens long, base_score double, score double")
