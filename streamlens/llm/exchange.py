"""Blocks of texts, and questions that blocks put to the shards of a key space.

Work that needs a total per key over the whole corpus (n-gram counts, first owners of windows) is done in
three steps. Rows are gathered into *blocks* of bounded bytes, kept compressed in the shared folder. Each block
sends one packed message per shard with its distinct keys, so a key costs one entry per block however often it
occurs: that is the pre-aggregation before the shuffle, and no key makes a task large. A shard answers each
message in the order of its keys, and the answers meet their block again.

A lost executor recomputes its messages from the stored blocks, which do not change.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.llm.words import offsets, pieces
from streamlens.session import pin

BLOCK_BYTES = 6 << 20
BLOCK = "block long, n_docs long, n_bytes long, body binary"


def pack(columns: dict[str, pa.Array | np.ndarray], level: int = 3) -> bytes:
    """Columns of one length as compressed Arrow bytes."""
    batch = pa.RecordBatch.from_pydict({k: v if isinstance(v, pa.Array) else pa.array(v) for k, v in columns.items()})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as writer:
        writer.write_batch(batch)
    return zstandard.ZstdCompressor(level=level).compress(sink.getvalue())


def unpack(body: bytes) -> pa.RecordBatch:
    data = zstandard.ZstdDecompressor().decompress(body)
    return pa.ipc.open_stream(data).read_next_batch()


def blocks(docs: DataFrame, key: str, text: str, more: tuple[str, ...] = (), limit: int = BLOCK_BYTES, label: str = "blocks") -> DataFrame:
    """The rows of ``docs`` as numbered blocks of about ``limit`` bytes of text, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()

        def block(number: int, held: list[pa.RecordBatch], size: int) -> pa.RecordBatch:
            whole = pa.Table.from_batches(held).combine_chunks()
            body = pack({n: whole.column(n).chunk(0) for n in whole.column_names})
            return pa.RecordBatch.from_pydict({
                "block": pa.array([task << 32 | number], pa.int64()), "n_docs": pa.array([len(whole)], pa.int64()),
                "n_bytes": pa.array([size], pa.int64()), "body": pa.array([body], pa.binary()),
            })

        number, held, size = 0, [], 0
        for piece in pieces(batches, text):
            held.append(piece)
            at = offsets(piece.column(text))
            size += int(at[-1] - at[0])
            if size >= limit:
                yield block(number, held, size)
                number, held, size = number + 1, [], 0
        if held:
            yield block(number, held, size)

    rows = docs.select(key, F.coalesce(F.col(text), F.lit("")).alias(text), *more)
    return pin(rows.mapInArrow(run, BLOCK), label)


def ask(stored: DataFrame, send: Callable[[pa.RecordBatch], Iterator[tuple[int, bytes]]]) -> DataFrame:
    """Messages ``(block, shard, body)``: what ``send`` gives for the rows of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, body in zip(batch.column("block").to_pylist(), batch.column("body"), strict=True):
                for shard, message in send(unpack(body.as_buffer())):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([block], pa.int64()), pa.array([shard], pa.int32()), pa.array([message], pa.binary())],
                        names=["block", "shard", "body"],
                    )

    return stored.select("block", "body").mapInArrow(run, "block long, shard int, body binary")


def answer(messages: DataFrame, reply: Callable[[int, list[int], list[bytes]], tuple[list[bytes], list[int]]]) -> DataFrame:
    """One answer to each message, and totals of the shard, the same in each row of it.

    ``reply`` gets the shard and all messages to it, ordered by block.
    """

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("block")
        blocks_ = group.column("block").to_pylist()
        bodies, totals = reply(group.column("shard")[0].as_py(), blocks_, [b.as_buffer() for b in group.column("body")])
        return pa.table({
            "block": group.column("block"), "shard": group.column("shard"), "body": pa.array(bodies, pa.binary()),
            "totals": pa.array([totals] * len(bodies), pa.list_(pa.int64())),
        })

    return messages.groupBy("shard").applyInArrow(run, "block long, shard int, body binary, totals array<long>")


def totals(answers: DataFrame) -> list[int]:
    """The shards' totals, added up."""
    once = answers.groupBy("shard").agg(F.first("totals").alias("totals"))
    rows = once.select(F.posexplode("totals").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n")).orderBy("at").collect()
    return [r.n for r in rows]


def settle(stored: DataFrame, answers: DataFrame, finish: Callable[[int, pa.RecordBatch, dict[int, bytes]], pa.RecordBatch], schema: str) -> DataFrame:
    """Rows that ``finish`` makes of a block's rows and the answers to its messages, by shard."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = unpack(left.column("body")[0].as_buffer())
        got = {s: b.as_buffer() for s, b in zip(right.column("shard").to_pylist(), right.column("body"), strict=True)}
        return pa.Table.from_batches([finish(left.column("block")[0].as_py(), rows, got)])

    sent = answers.select("block", "shard", "body")
    return stored.select("block", "body").groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(run, schema)


def shards_for(stored: DataFrame, bytes_each: int) -> int:
    """How many shards keep a shard near ``bytes_each`` bytes of text."""
    total = stored.agg(F.sum("n_bytes")).first()[0] or 0
    return max(1, -(-total // bytes_each))
