"""State machines per key for live streams.

Each processor sorts the rows of a key within the micro-batch; across micro-batches rows count in
arrival order. The micro-batch size (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``) bounds what
a task holds.

Keys, ids, products and amounts keep the types they have in the stream (text keys, whole amounts). Rows without an id
are left out, as are rows without an amount; a count window counts the latter and sums the others, as its batch form.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from functools import partial
from itertools import islice
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo

from streamlens.operators.monitor import rise_timers
from streamlens.streaming.in_order import BUCKET, CHUNK, PACKED, as_batch, as_bytes, codes, dealt, pack, unpack

MICROS = 1_000_000
BUCKETS = 1024  # of keys; a state belongs to one number of them
PARTS = 16  # of a bucket's states


def _in_order(rows: Iterator[Row]) -> list[Row]:
    return sorted((r for r in rows if r["id"] is not None), key=lambda r: (r["at"], r["id"]))


class Typed(StatefulProcessor):
    """A processor whose schemas name the types of its stream, as ``{key}``; ``keyed`` sets them."""

    SCHEMA = ""
    types: dict[str, str] = {}

    def typed(self, schema: str) -> str:
        return schema.format(**self.types)

    def close(self) -> None:
        pass


class RisingAmount(Typed):
    """Previous amount and one event-time timer per client. Rows: key, id, at (µs), x."""

    SCHEMA = "key {key}, start_us BIGINT, alert_us BIGINT"

    def __init__(self, seconds: float):
        self.wait = int(seconds * MICROS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.amount = handle.getValueState("amount", self.typed("x {x}"))
        self.deadline = handle.getValueState("deadline", "at BIGINT")

    def _millis(self, deadline: int) -> int:
        return -(-deadline // 1000)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        batch = [r for r in _in_order(rows) if r["x"] is not None]
        if not batch:
            return
        before = self.amount.get()
        stored = self.deadline.get()
        old = stored[0] if stored else None
        x = [r["x"] for r in batch]
        at = np.array([r["at"] for r in batch], "int64")
        rise = np.array([b > a for a, b in zip([before[0] if before else 0, *x], x)])
        fired, new = rise_timers(at, rise, old, self.wait)
        self.amount.update((x[-1],))
        if new != old:
            if old is not None:
                self.handle.deleteTimer(self._millis(old))
            if new is None:
                self.deadline.clear()
            else:
                self.deadline.update((new,))
                self.handle.registerTimer(self._millis(new))
        for deadline in fired:
            yield Row(key=key[0], start_us=deadline - self.wait, alert_us=deadline)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.deadline.get()
        if stored is not None:
            self.deadline.clear()
            yield Row(key=key[0], start_us=stored[0] - self.wait, alert_us=stored[0])


class BaselineJump(Typed):
    """The last alerted value per client."""

    SCHEMA = "key {key}, id {id}, baseline {x}, x {x}"

    def __init__(self, threshold: float):
        self.threshold = threshold

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.base = handle.getValueState("base", self.typed("x {x}"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        stored = self.base.get()
        base = stored[0] if stored else None
        for r in _in_order(rows):
            if r["x"] is None:
                continue
            if base is None:
                base = type(r["x"])(0)
            if abs(r["x"] - base) > self.threshold:
                yield Row(key=key[0], id=r["id"], baseline=base, x=r["x"])
                base = r["x"]
        if base is not None:
            self.base.update((base,))


class CountWindow(Typed):
    """Rows and sum of the open count window per key."""

    SCHEMA = "key {key}, window_no BIGINT, total BIGINT"

    def __init__(self, size: int):
        self.size = size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", "no BIGINT, n BIGINT, total BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        no, n, total = self.open.get() or (0, 0, None)
        for r in _in_order(rows):
            n += 1
            if r["x"] is not None:
                total = (total or 0) + int(r["x"])
            if n == self.size:
                yield Row(key=key[0], window_no=no, total=total)
                no, n, total = no + 1, 0, None
        self.open.update((no, n, total))


class TimesNext(Typed):
    """``times`` start rows with anything between, then a following row directly after the last of them.

    Rows: key, id, at (µs), start, follows. ``seconds`` bounds the time from the first row to the following one,
    itself not included. State is the last ``times`` start rows; every start row may open a match.
    """

    SCHEMA = "key {key}, first_id {id}, last_id {id}, next_id {id}, first_us BIGINT, next_us BIGINT"

    def __init__(self, times: int, seconds: float | None = None):
        self.times = times
        self.span = None if seconds is None else int(seconds * MICROS)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.starts = handle.getListState("starts", self.typed("id {id}, at BIGINT"))
        self.fresh = handle.getValueState("fresh", "fresh BOOLEAN")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        starts = [(r[0], r[1]) for r in self.starts.get()]
        stored = self.fresh.get()
        fresh = bool(stored[0]) if stored else False  # whether the row before was a start row
        for r in _in_order(rows):
            if r["follows"] and fresh and len(starts) == self.times:
                (first, since), (last, _) = starts[0], starts[-1]
                if self.span is None or r["at"] < since + self.span:
                    yield Row(key=key[0], first_id=first, last_id=last, next_id=r["id"], first_us=since, next_us=r["at"])
            fresh = bool(r["start"])
            if fresh:
                starts = [*starts, (r["id"], r["at"])][-self.times:]
        if starts:
            self.starts.put(starts)
        self.fresh.update((fresh,))


class TopTransactions(Typed):
    """The largest amounts per client in a list state, written again whenever a batch arrives.

    With a time to live the list is dropped once the client was silent for that long.
    """

    SCHEMA = "key {key}, rank INT, id {id}, x {x}"

    def __init__(self, n: int = 3, ttl_ms: int | None = None):
        self.n, self.ttl = n, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.top = handle.getListState("top", self.typed("id {id}, x {x}"), self.ttl)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        kept = [(r[0], r[1]) for r in self.top.get()]
        for r in rows:
            if r["id"] is not None and r["x"] is not None:
                kept.append((r["id"], r["x"]))
                if len(kept) > 64 * self.n:
                    kept = sorted(kept, key=lambda v: (-v[1], v[0]))[: self.n]
        kept = sorted(kept, key=lambda v: (-v[1], v[0]))[: self.n]
        if kept:
            self.top.put(kept)
        for rank, (row_id, x) in enumerate(kept, start=1):
            yield Row(key=key[0], rank=rank, id=row_id, x=x)


class TopProducts(Typed):
    """Per client a map from product to its largest amount; the first n of it are emitted."""

    SCHEMA = "key {key}, rank INT, product {product}, x {x}"

    def __init__(self, n: int = 3):
        self.n = n

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.best = handle.getMapState("best", self.typed("product {product}"), self.typed("x {x}"))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        # A product outside the first n can only come back with a larger amount: keep n entries.
        best = {p[0]: v[0] for p, v in self.best.iterator()}
        known = dict(best)
        for r in rows:
            if r["x"] is not None and r["product"] is not None and (r["product"] not in best or r["x"] > best[r["product"]]):
                best[r["product"]] = r["x"]
                if len(best) > 64 * self.n:
                    best = dict(sorted(best.items(), key=lambda v: (-v[1], v[0]))[: self.n])
        top = sorted(best.items(), key=lambda v: (-v[1], v[0]))[: self.n]
        for product in known.keys() - dict(top).keys():
            self.best.removeKey((product,))
        for rank, (product, x) in enumerate(top, start=1):
            if known.get(product) != x:
                self.best.updateValue((product,), (x,))
            yield Row(key=key[0], rank=rank, product=product, x=x)


class IdleTotals(Typed):
    """Rows and sum of ``x`` per key, told once the key was silent for ``idle`` seconds of wall-clock time.

    Each batch with rows of a key moves its timer; state and timer are in the checkpoint, so a timer that was set
    before a restart fires after it. Use with ``time_mode="ProcessingTime"`` and a trigger that goes on: one that ends with
    the available data never ends here, as a timer may always be due.
    """

    SCHEMA = "key {key}, n BIGINT, total DOUBLE"

    def __init__(self, idle: float):
        self.idle_ms = int(idle * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getValueState("sums", "n BIGINT, total DOUBLE, timer BIGINT")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        n, total, timer = self.sums.get() or (0, 0.0, None)
        for r in rows:
            n += 1
            total += 0.0 if r["x"] is None else float(r["x"])
        due = timerValues.getCurrentProcessingTimeInMs() + self.idle_ms
        if timer is not None and timer != due:
            self.handle.deleteTimer(timer)
        if timer != due:
            self.handle.registerTimer(due)
        self.sums.update((n, total, due))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        stored = self.sums.get()
        if stored is not None and expiredTimerInfo.getExpiryTimeInMs() >= stored[2]:
            self.sums.clear()
            yield Row(key=key[0], n=stored[0], total=stored[1])


class Local:
    """The states of one key, held in memory while it is worked on: what a processor asks of a handle, of a value, a list
    and a map state. ``found`` is a dict by name, to be stored whole."""

    def __init__(self, name: str | None = None):
        self.name, self.found, self.timers, self.parts = name, {}, set(), []

    def getValueState(self, name: str, schema, ttl=None) -> Local:
        self.parts.append(Local(name))
        return self.parts[-1]

    getListState = getValueState

    def getMapState(self, name: str, key_schema, schema, ttl=None) -> Local:
        return self.getValueState(name, schema)

    def turn(self, found: dict, timers: set) -> None:
        self.found, self.timers = found, timers
        for part in self.parts:
            part.found = found

    def registerTimer(self, at: int) -> None:
        self.timers.add(at)

    def deleteTimer(self, at: int) -> None:
        self.timers.discard(at)

    def exists(self) -> bool:
        return self.name in self.found

    def clear(self) -> None:
        self.found.pop(self.name, None)

    def get(self):  # a value, or the rows of a list
        return self.found.get(self.name, None)

    def update(self, value: tuple) -> None:
        self.found[self.name] = value

    def put(self, rows: list) -> None:
        self.found[self.name] = list(rows)

    def getValue(self, key: tuple):
        return self.found.get(self.name, {}).get(key)

    def containsKey(self, key: tuple) -> bool:
        return key in self.found.get(self.name, {})

    def updateValue(self, key: tuple, value: tuple) -> None:
        self.found.setdefault(self.name, {})[key] = value

    def removeKey(self, key: tuple) -> None:
        self.found.get(self.name, {}).pop(key, None)

    def iterator(self) -> Iterator:
        return iter(list(self.found.get(self.name, {}).items()))


class LocalList(Local):
    def get(self):
        return iter(self.found.get(self.name, ()))


class Buckets(StatefulProcessor):
    """``inner`` for each key of a bucket of keys.

    States of a bucket's keys are stored in ``PARTS`` entries by their hash, of which a micro-batch reads and writes those
    it has keys of, once. One timer stands where the first of the keys' timers does.
    """

    def __init__(self, inner: Typed, kinds: pa.Schema, out: pa.Schema):
        self.inner, self.kinds, self.out = inner, kinds, out

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.states = handle.getMapState("states", "part INT", "states BINARY")
        self.marks = handle.getValueState("marks", "timer BIGINT, timers BINARY")
        self.local = Local()
        self.local.getListState = self._list
        self.inner.init(self.local)

    def _list(self, name: str, schema, ttl=None) -> Local:
        self.local.parts.append(LocalList(name))
        return self.local.parts[-1]

    def close(self) -> None:
        self.inner.close()

    def _rows(self, columns: list, a: int, z: int) -> Iterator[Row]:
        row = Row(*self.kinds.names)
        for begin in range(a, z, CHUNK):
            values = [c.slice(begin, min(CHUNK, z - begin)).to_pylist() for c in columns]
            yield from (row(*v) for v in zip(*values))

    def _frames(self, bucket: tuple, rows: Iterator[Row]) -> Iterator[pd.DataFrame]:
        while block := [r.asDict(True) for r in islice(rows, CHUNK)]:
            packed = as_bytes(pa.RecordBatch.from_pylist(block, schema=self.out))
            yield pd.DataFrame({BUCKET: [bucket[0]], PACKED: pd.Series([packed], dtype=object)})

    def _work(self, timers: dict, turns: dict[int, list[tuple[tuple, Callable]]]) -> Iterator[Row]:
        """The turns of keys, by part: each a key and what calls the processor for it."""
        for part, mine in turns.items():
            stored = self.states.getValue((part,))
            states = pickle.loads(stored[0]) if stored else {}
            for key, call in mine:
                self.local.turn(states.setdefault(key, {}), timers.setdefault(key, set()))
                yield from call()
                if not timers[key]:
                    del timers[key]
                if not states[key]:
                    del states[key]
            self.states.updateValue((part,), (pickle.dumps(states),))

    def _done(self, old: int | None, timers: dict) -> None:
        first = min((t for own in timers.values() for t in own), default=None)
        if old is not None and old != first:
            self.handle.deleteTimer(old)
        if first is not None and old != first:
            self.handle.registerTimer(first)
        self.marks.update((first, pickle.dumps(timers)))

    def _timers(self) -> tuple[int | None, dict]:
        timer, stored = self.marks.get() or (None, None)
        return timer, pickle.loads(stored) if stored else {}

    @staticmethod
    def _part(key: tuple) -> int:
        return crc32(repr(key).encode()) % PARTS

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        table = pa.Table.from_batches([as_batch(b, self.kinds) for frame in rows for b in frame[PACKED]], self.kinds)
        group = codes(table, ["key"])
        order = np.argsort(group, kind="stable")
        heads = np.flatnonzero(np.diff(group[order], prepend=-1)).tolist()
        columns = [c.combine_chunks() for c in table.take(pa.array(order)).columns]
        keys = columns[self.kinds.names.index("key")].take(pa.array(heads)).to_pylist()
        turns: dict[int, list] = {}
        for one, a, z in zip(keys, heads, [*heads[1:], len(table)]):
            call = partial(lambda k, a, z: self.inner.handleInputRows(k, self._rows(columns, a, z), timerValues), (one,), a, z)
            turns.setdefault(self._part((one,)), []).append(((one,), call))
        timer, timers = self._timers()
        yield from self._frames(key, self._work(timers, turns))
        if timers or timer is not None:
            self._done(timer, timers)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        _, timers = self._timers()
        now, called = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        turns: dict[int, list] = {}
        for one, own in timers.items():
            if due := sorted(t for t in own if t < now or t <= called):
                turns.setdefault(self._part(one), []).append((one, partial(self._expire, one, due, timerValues)))
        yield from self._frames(key, self._work(timers, turns))
        self._done(None, timers)  # the timer that called has been used up

    def _expire(self, key: tuple, due: list[int], timerValues) -> Iterator[Row]:
        for at in due:
            self.local.deleteTimer(at)
            yield from self.inner.handleExpiredTimer(key, timerValues, ExpiredTimerInfo(at))


def keyed(stream: DataFrame, processor: Typed, time_mode: str = "None",
          mode: str = "Append") -> DataFrame:
    """Run a processor per ``key`` of the stream.

    Keys are dealt to ``BUCKETS``, so that many keys with few rows each cost few accesses of state. States that expire, and
    timers of the wall clock, are kept key by key.
    """
    processor.types = dict(stream.dtypes)
    schema = T.StructType.fromDDL(processor.typed(processor.SCHEMA))
    if time_mode == "ProcessingTime" or getattr(processor, "ttl", None) is not None:
        return stream.groupBy("key").transformWithState(
            statefulProcessor=processor, outputStructType=schema, outputMode=mode, timeMode=time_mode,
        )
    packed = pack(dealt(stream, ["key"], BUCKETS), [BUCKET])
    given = packed.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=Buckets(processor, to_arrow_schema(stream.schema), to_arrow_schema(schema)),
        outputStructType=packed.schema, outputMode=mode, timeMode=time_mode,
    )
    return unpack(given, [BUCKET], schema).drop(BUCKET)
