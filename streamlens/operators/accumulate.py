"""Aggregates of one's own, added up on the map side and merged in a tree.

An ``Accumulator`` is what a user writes: an empty state, rows added to a state (arrays at a time), two states merged,
a result. Each task adds its rows to one state per key and hands on only states. Those of one key are merged in steps of
at most ``WIDTH`` source tasks, so no task meets more than that of a key at once, however many rows it has.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.ordered import ARROW
from streamlens.session import pin

WIDTH = 64
HELD = 100_000  # keys whose states a task keeps before it hands them on


class Accumulator:
    """States and results are dicts with the names of ``state`` and ``out``. ``merge`` may not depend on order."""

    inputs: tuple[str, ...]
    state: T.StructType
    out: T.StructType

    def create(self) -> dict:
        raise NotImplementedError

    def add(self, state: dict, rows: dict[str, np.ndarray]) -> dict:
        raise NotImplementedError

    def merge(self, a: dict, b: dict) -> dict:
        raise NotImplementedError

    def result(self, state: dict) -> dict:
        raise NotImplementedError


class DecayedMean(Accumulator):
    """Mean of ``_x`` in which a row counts half for every ``half_life`` (µs) before the newest row ``_at``."""

    inputs = ("_x", "_at")
    state = T.StructType([T.StructField("newest", T.LongType()), T.StructField("total", T.DoubleType()), T.StructField("weight", T.DoubleType())])
    out = T.StructType([T.StructField("mean", T.DoubleType()), T.StructField("newest", T.LongType())])

    def __init__(self, half_life: float):
        self.half_life = half_life

    def create(self) -> dict:
        return {"newest": None, "total": 0.0, "weight": 0.0}

    def add(self, state: dict, rows: dict[str, np.ndarray]) -> dict:
        newest = int(rows["_at"].max())
        weight = np.exp2((rows["_at"] - newest) / self.half_life)
        return self.merge(state, {"newest": newest, "total": float((rows["_x"] * weight).sum()), "weight": float(weight.sum())})

    def merge(self, a: dict, b: dict) -> dict:
        if a["newest"] is None or b["newest"] is None:
            return b if a["newest"] is None else a
        newest = max(a["newest"], b["newest"])
        fade = [2.0 ** ((s["newest"] - newest) / self.half_life) for s in (a, b)]
        return {"newest": newest} | {n: a[n] * fade[0] + b[n] * fade[1] for n in ("total", "weight")}

    def result(self, state: dict) -> dict:
        return {"mean": state["total"] / state["weight"], "newest": state["newest"]}


def accumulate(df: DataFrame, keys: Sequence[str], acc: Accumulator) -> DataFrame:
    """One row per key with what ``acc`` makes of its rows. Rows with a null input are left out; null keys are a key."""
    keys = list(keys)
    rows = df.dropna(subset=list(acc.inputs)).select(*keys, *acc.inputs)
    key_fields = [df.schema[k] for k in keys]
    partial = T.StructType([*key_fields, T.StructField("_task", T.LongType()), *acc.state.fields])
    out = T.StructType([*key_fields, *acc.out.fields])
    names, inputs, held = acc.state.names, acc.inputs, HELD
    state_types = [ARROW[f.dataType] for f in acc.state]
    out_types = [ARROW[f.dataType] for f in acc.out]

    def batch_of(states: dict, kinds: list, columns: Sequence[str], types: Sequence[pa.DataType], task: int | None) -> pa.RecordBatch:
        arrays = [pa.array([k[i] for k in states], t) for i, t in enumerate(kinds)]
        if task is not None:
            arrays.append(pa.array([task] * len(states), pa.int64()))
        arrays += [pa.array([s[c] for s in states.values()], t) for c, t in zip(columns, types, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*keys, *(["_task"] if task is not None else []), *columns])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, states, kinds = TaskContext.get().partitionId(), {}, []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(k).type for k in keys]
            codes = [batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy() for k in keys]
            order = np.lexsort(codes) if codes else np.arange(batch.num_rows)
            new = np.any([c[order][1:] != c[order][:-1] for c in codes], axis=0) if codes else np.zeros(batch.num_rows - 1, bool)
            heads = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False)[order] for c in inputs}
            for head, tail in zip(heads, heads[1:]):
                name = tuple(batch.column(k)[int(order[head])].as_py() for k in keys)
                states[name] = acc.add(states.get(name) or acc.create(), {c: v[head:tail] for c, v in columns.items()})
            if len(states) > held:
                yield batch_of(states, kinds, names, state_types, task)
                states = {}
        if states:
            yield batch_of(states, kinds, names, state_types, task)

    def merged(last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            name, task, state = None, None, None

            def close() -> pa.RecordBatch:
                if last:
                    return batch_of({name: acc.result(state)}, kinds, acc_out, out_types, None)
                return batch_of({name: state}, kinds, names, state_types, task)

            kinds: list = []
            for batch in batches:
                kinds = [batch.schema.field(k).type for k in keys]
                closed = []
                for row in batch.to_pylist():
                    here, at = tuple(row[k] for k in keys), row["_task"]
                    if (here, at) != (name, task):
                        if state is not None:
                            closed.append(close())
                        name, task, state = here, at, {n: row[n] for n in names}
                    else:
                        state = acc.merge(state, {n: row[n] for n in names})
                if closed:
                    yield pa.Table.from_batches(closed).combine_chunks().to_batches()[0]
            if state is not None:
                yield close()

        return run

    acc_out = acc.out.names
    states = pin(rows.mapInArrow(added, partial), "accumulated")
    tasks = (states.agg(F.max("_task")).first()[0] or 0) + 1
    while True:
        # states of WIDTH neighbouring tasks meet; the order among them is fixed, so sums round alike in each run
        one = tasks <= WIDTH
        near = states.withColumns({"_from": F.col("_task"), "_task": F.floor(F.col("_task") / WIDTH).cast("long")})
        met = near.repartition(*keys, "_task").sortWithinPartitions(*keys, "_task", "_from").select(*partial.names)
        if one:
            return met.mapInArrow(merged(True), out)
        states = pin(met.mapInArrow(merged(False), partial), "accumulated")
        tasks = -(-tasks // WIDTH)
