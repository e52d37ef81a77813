"""Keyed state in event-time order: rows wait in state until the watermark has passed them.

A micro-batch brings rows of a key in any order, and later batches may bring older ones. ``in_order`` keeps them in a
map state by time and releases a slot when the watermark has passed its end: all its rows at once, sorted by
time and id, through the step of a ``Machine`` - the very one that the batch operator folds, so a stream gives the
batch's rows whatever the order of arrival and the cut into micro-batches.

A row that comes after its slot was released cannot be put in order any more. It is given back under ``late``, and a
machine may still take notice of it. One timer per bucket stands at the end of its oldest waiting slot, or where a
machine's own deadline falls due.

Keys share the rows that wait by buckets of their hash, so that a micro-batch costs a key no access of state, and a release
two. Few rows of a bucket wait as one Arrow batch beside its marks; more of them are sorted and stored in pieces of ``CHUNK``
rows, and what a release leaves of a piece is stored again. The watermark's delay bounds what waits; ``slot`` only how finely
it is released. Rows travel to a bucket, and emitted ones from it, as Arrow batches too (``pack``).
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import replace

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from streamlens.operators.ordered import Machine

CHUNK = 10_000  # rows of a stored piece, at most
HELD = 256  # rows of a bucket that wait beside its marks, at most
BUCKETS = 1024  # of keys; a state belongs to one number of them


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class InOrder(StatefulProcessor):
    """``machine`` over the rows of each key of a bucket in the order of ``at`` (µs), then ``ties``.

    ``due(state)`` is a time after which the end of the state's own wait may be told, or none; ``expire`` what it then
    emits, and the state after. ``notice(columns, state)`` is the state after late rows.
    """

    def __init__(self, machine: Machine, by: Sequence[str], keys: T.StructType, kinds: pa.Schema, out: pa.Schema, ties: Sequence[str],
                 slot_us: int, due: Callable | None, expire: Callable | None, notice: Callable | None):
        self.step, self.initial, self.inputs = machine.step, machine.initial, machine.inputs
        self.emits, self.by, self.kinds, self.out, self.keys = machine.out.names, tuple(by), kinds, out, tuple(keys.names)
        self.key_schema = ", ".join(["part INT", *([_ddl(keys)] if keys else [])])
        self.state_schema, self.names = "released BIGINT, " + _ddl(machine.state), machine.state.names
        self.ties, self.slot, self.due, self.expire, self.notice = tuple(ties), slot_us, due, expire, notice

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getMapState("waiting", "slot BIGINT, chunk BIGINT", "rows BINARY")
        # of each key the time up to which its rows were released, and the machine's state
        self.states = handle.getMapState("states", self.key_schema, self.state_schema)
        # of the bucket: pieces written so far, the time up to which rows were released, the time of the timer in ms,
        # pieces that wait, the few rows that wait as one, the open deadlines by key
        self.marks = handle.getValueState(
            "marks", "chunks BIGINT, done BIGINT, timer BIGINT, pieces BIGINT, held BINARY, deadlines BINARY")

    def close(self) -> None:
        pass

    def _state(self, key: tuple) -> tuple[int | None, dict]:
        stored = self.states.getValue((0, *key))
        return (stored[0], dict(zip(self.names, stored[1:]))) if stored else (None, dict(self.initial))

    def _keep(self, key: tuple, released: int | None, state: dict) -> None:
        self.states.updateValue((0, *key), (released, *[state[n] for n in self.names]))

    def _frame(self, group: tuple, told: dict[str, pa.Array], count: int) -> pd.DataFrame:
        columns = [told[f.name] if f.name in told else pa.nulls(count, f.type) for f in self.out]
        rows = as_bytes(pa.record_batch(columns, schema=self.out))
        return pd.DataFrame({c: pd.Series([v], dtype=object) for c, v in zip((*self.by, PACKED), (*group, rows))})

    def _given(self, group: tuple, found: list[tuple[tuple, dict[str, np.ndarray]]]) -> Iterator[pd.DataFrame]:
        counts = [len(f[self.emits[0]]) for _, f in found]
        if not sum(counts):
            return
        told = {n: [v for _, f in found for v in f[n].tolist()] for n in self.emits}
        for i, k in enumerate(self.keys):
            told[k] = [v for (key, _), n in zip(found, counts) for v in [key[i]] * n]
        told["late"] = [False] * sum(counts)
        arrays = {n: pa.array(v, self.out.field(n).type, from_pandas=True) for n, v in told.items()}
        yield self._frame(group, arrays, sum(counts))

    def _late(self, group: tuple, late: pa.Table) -> pd.DataFrame:
        told = {"late_" + n.lstrip("_"): late.column(n).combine_chunks() for n in ("at", *self.ties)}
        told |= {k: late.column(k).combine_chunks() for k in self.keys} | {"late": pa.array([True] * len(late))}
        return self._frame(group, told, len(late))

    def _by_key(self, rows: pa.Table) -> Iterator[tuple[tuple, dict[str, np.ndarray]]]:
        """Each key with its rows, in order."""
        rows = rows.append_column("_code", pa.array(codes(rows, self.keys)))
        rows = rows.sort_by([("_code", "ascending"), ("at", "ascending"), *[(t, "ascending") for t in self.ties]])
        heads = np.flatnonzero(np.diff(rows.column("_code").to_numpy(), prepend=-1))
        named = rows.select(self.keys).take(pa.array(heads)).to_pydict()
        keys = list(zip(*named.values())) if self.keys else [()]
        columns = {c: _values(rows.column(c)) for c in self.inputs}
        for key, a, z in zip(keys, heads, [*heads[1:], len(rows)]):
            yield key, {c: v[a:z] for c, v in columns.items()}

    def _timer(self, old: int | None, wanted: int | None) -> int | None:
        """Move the bucket's timer to ``wanted`` (µs)."""
        at = None if wanted is None else -(-wanted // 1000)
        if old is not None and old != at:
            self.handle.deleteTimer(old)
        if at is not None and old != at:
            self.handle.registerTimer(at)
        return at

    def _read(self, stored: bytes | None) -> pa.Table:
        return pa.Table.from_batches([as_batch(stored, self.kinds)] if stored else [], self.kinds)

    def _store(self, rows: pa.Table, chunks: int, pieces: int) -> tuple[int, int, bytes | None]:
        """Let ``rows`` wait; the pieces written and waiting afterwards, and the rows held beside the marks."""
        if not len(rows):
            return chunks, pieces, None
        if len(rows) <= HELD:
            return chunks, pieces, as_bytes(rows.combine_chunks().to_batches()[0])
        rows = rows.sort_by("at").combine_chunks()
        for begin in range(0, len(rows), CHUNK):
            part = rows.slice(begin, CHUNK).to_batches()[0]
            self.waiting.updateValue((part.column("at")[0].as_py() // self.slot, chunks), (as_bytes(part),))
            chunks, pieces = chunks + 1, pieces + 1
        return chunks, pieces, None

    def _behind(self, batch: pa.Table, done: int) -> np.ndarray:
        """Which rows come after their own key has been released beyond them."""
        at = batch.column("at").to_numpy()
        old = np.flatnonzero(at < done)
        late = np.zeros(len(at), bool)
        if len(old):
            some = batch.take(pa.array(old))
            numbers = codes(some, self.keys)
            for number in np.unique(numbers):
                mine = numbers == number
                first = int(mine.argmax())
                released, _ = self._state(tuple(some.column(k)[first].as_py() for k in self.keys))
                if released is not None:
                    late[old[mine]] = at[old[mine]] < released
        return late

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        batches = [as_batch(b, self.kinds) for frame in rows for b in frame[PACKED]]
        batch = pa.Table.from_batches(batches, self.kinds)
        chunks, done, timer, pieces, held, deadlines = self.marks.get() or (0, None, None, 0, None, None)
        if done is not None:
            behind = self._behind(batch, done)
            if behind.any():
                late = batch.filter(pa.array(behind))
                for one, columns in self._by_key(late) if self.notice else ():
                    released, state = self._state(one)
                    self._keep(one, released, self.notice(columns, state))
                yield self._late(key, late)
                batch = batch.filter(pa.array(~behind))
        if not len(batch):
            return
        first = (pc.min(batch.column("at")).as_py() // self.slot + 1) * self.slot
        if held:
            batch = pa.concat_tables([self._read(held), batch])
        chunks, pieces, held = self._store(batch, chunks, pieces)
        if timer is None or -(-first // 1000) < timer:
            timer = self._timer(timer, first)
        self.marks.update((chunks, done, timer, pieces, held, deadlines))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        chunks, done, timer, pieces, held, stored = self.marks.get() or (0, None, None, 0, None, None)
        deadlines = pickle.loads(stored) if stored else {}
        end = timerValues.getCurrentWatermarkInMs() * 1000 // self.slot  # slots before it have ended
        names = sorted(tuple(k) for k in self.waiting.keys()) if pieces else []
        ripe = [k for k in names if k[0] < end]
        rows, most = self._read(held), CHUNK
        # pieces in the order of their first slots; rows before the next piece go when many are in memory
        for piece in [*ripe, None]:
            if piece is None or len(rows) >= most:
                until = (end if piece is None else piece[0]) * self.slot
                early = pc.less(rows.column("at"), until)
                before, rows = rows.filter(early), rows.filter(pc.invert(early))
                most = max(CHUNK, 2 * len(rows))
                yield from self._given(key, self._release(before, until, deadlines))
            if piece is not None:
                rows = pa.concat_tables([rows, self._read(self.waiting.getValue(piece)[0])])
                self.waiting.removeKey(piece)
        slots = [k[0] for k in names if k[0] >= end]
        if len(rows):
            slots.append(pc.min(rows.column("at")).as_py() // self.slot)
        slots += [d // self.slot for d in deadlines.values()]
        done = max(done or end * self.slot, end * self.slot)
        # the timer that called has been used up
        timer = self._timer(None, (min(slots) + 1) * self.slot if slots else None)
        chunks, pieces, held = self._store(rows, chunks, pieces - len(ripe))
        self.marks.update((chunks, done, timer, pieces, held, pickle.dumps(deadlines) if deadlines else None))

    def _release(self, rows: pa.Table, until: int, deadlines: dict) -> list[tuple[tuple, dict[str, np.ndarray]]]:
        """What all rows before ``until`` (µs) and the deadlines before it give; ``deadlines`` are brought up to date."""
        found = []
        overdue = {k for k, d in deadlines.items() if d < until}
        for key, columns in self._by_key(rows) if len(rows) else ():
            overdue.discard(key)
            released, state = self._state(key)
            emitted, state = self.step(columns, state)
            found += [(key, emitted), *self._settled(key, released, state, until, deadlines)]
        for key in overdue:
            found += self._settled(key, *self._state(key), until, deadlines)
        return found

    def _settled(self, key: tuple, released: int | None, state: dict, until: int, deadlines: dict) -> Iterable[tuple[tuple, dict]]:
        """What the key's own deadline gives, if it lies before ``until``: no row up to it is to come."""
        found, deadline = [], self.due(state) if self.due else None
        if deadline is not None and deadline < until:
            emitted, state = self.expire(state)
            found.append((key, emitted))
            deadline = self.due(state)
        if deadline is not None:
            deadlines[key] = deadline
        else:
            deadlines.pop(key, None)
        self._keep(key, max(released or until, until), state)
        return found


BUCKET, PACKED = "bucket_of_keys", "packed_rows"


def as_bytes(batch: pa.RecordBatch) -> bytes:
    return batch.serialize().to_pybytes()


def as_batch(stored: bytes, kinds: pa.Schema) -> pa.RecordBatch:
    return pa.ipc.read_record_batch(pa.py_buffer(stored), kinds)


def _values(column: pa.ChunkedArray) -> np.ndarray:
    """A column as an array; whole numbers among nulls stay whole."""
    if column.null_count and pa.types.is_integer(column.type):
        return np.array(column.to_pylist(), object)
    return column.combine_chunks().to_numpy(zero_copy_only=False)


def codes(rows: pa.Table, keys: Sequence[str]) -> np.ndarray:
    """A number per row, the same for rows of the same keys; null is a key like others."""
    found = np.zeros(len(rows), "int64")
    for k in keys:
        encoded = rows.column(k).combine_chunks().dictionary_encode(null_encoding="encode")
        found = found * len(encoded.dictionary) + encoded.indices.to_numpy()
        found = np.unique(found, return_inverse=True)[1]
    return found


def dealt(rows: DataFrame, keys: Sequence[str], buckets: int) -> DataFrame:
    """``rows`` with the bucket of their keys; a negative zero is the other one, as when Spark groups."""
    real = [k for k in keys if isinstance(rows.schema[k].dataType, (T.DoubleType, T.FloatType))]
    same = rows.withColumns({k: F.col(k) + F.lit(0.0).cast(rows.schema[k].dataType) for k in real}) if real else rows
    return same.withColumn(BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def pack(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows as one Arrow batch per key and batch of input: ``keys`` and the other columns in ``PACKED``."""
    rest = [c for c in rows.columns if c not in keys]
    kinds = to_arrow_schema(T.StructType([rows.schema[c] for c in rest]))
    keys = list(keys)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            table = pa.Table.from_batches([batch])
            group = codes(table, keys)
            order = np.argsort(group, kind="stable")
            heads = np.flatnonzero(np.diff(group[order], prepend=-1))
            table = table.take(pa.array(order)).combine_chunks()
            data = table.select(rest).cast(kinds).to_batches()[0]
            blobs = [as_bytes(data.slice(a, z - a)) for a, z in zip(heads, [*heads[1:], len(data)])]
            named = table.select(keys).take(pa.array(heads))
            yield named.append_column(PACKED, pa.array(blobs, pa.binary())).combine_chunks().to_batches()[0]

    schema = T.StructType([*[rows.schema[k] for k in keys], T.StructField(PACKED, T.BinaryType())])
    return rows.select(*keys, *rest).mapInArrow(packed, schema)


def unpack(packed: DataFrame, keys: Sequence[str], schema: T.StructType) -> DataFrame:
    """The reverse of ``pack``: ``keys`` and the columns of ``schema``."""
    kinds = to_arrow_schema(schema)
    keys = list(keys)

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begin, waiting = 0, []
            for at, stored in enumerate(batch.column(PACKED)):
                waiting.append(as_batch(stored.as_py(), kinds))
                if at + 1 == len(batch) or sum(map(len, waiting)) >= CHUNK:
                    data = pa.Table.from_batches(waiting, kinds)
                    copies = np.repeat(np.arange(begin, at + 1), [len(w) for w in waiting])
                    named = pa.Table.from_batches([batch]).select(keys).take(pa.array(copies))
                    whole = pa.Table.from_arrays([*named.columns, *data.columns], [*keys, *kinds.names])
                    yield from whole.combine_chunks().to_batches()
                    begin, waiting = at + 1, []

    return packed.mapInArrow(unpacked, T.StructType([*[packed.schema[k] for k in keys], *schema.fields]))


def in_order(stream: DataFrame, machine: Machine, ties: Sequence[str] = (), slot: float = 60, due: Callable | None = None,
             expire: Callable | None = None, notice: Callable | None = None, needs: Sequence[str] = (),
             keys: Sequence[str] = ("key",), copies: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Run ``machine`` per ``keys`` of a stream with a watermark, in the order of ``at`` (µs, BIGINT) and ``ties``.

    Columns: the keys, what the machine emits, ``late`` and, of a late row, ``late_at`` and its ties (``late_row`` for
    ``_row``). Rows in which ``at`` or one of ``needs`` is null are left out. ``slot`` is in seconds. A machine with a
    deadline takes notice of it in its own step too, when a row comes after it. Keys are dealt to ``BUCKETS``; few large
    keys have a bucket each if ``copies`` is given: it gets their packed rows and may copy them to other keys.
    """
    columns = list(dict.fromkeys(["at", *ties, *machine.inputs]))
    rows = stream.dropna(subset=["at", *needs]).select(*keys, *columns)
    if copies:
        by, inside = list(keys), []
    else:
        by, inside = [BUCKET], list(keys)
        rows = dealt(rows, keys, BUCKETS)
    head = T.StructType([T.StructField(k, rows.schema[k].dataType) for k in inside])
    kinds = to_arrow_schema(T.StructType([rows.schema[c] for c in (*inside, *columns)]))
    late = [T.StructField("late_" + c.lstrip("_"), rows.schema[c].dataType) for c in ("at", *ties)]
    out = T.StructType([*head.fields, T.StructField("late", T.BooleanType()), *late, *machine.out.fields])
    plain = replace(machine, summary={}, carry=None, moves=None)  # columns cannot be sent to workers
    processor = InOrder(plain, by, head, kinds, to_arrow_schema(out), ties, int(slot * 1_000_000), due, expire, notice)
    packed = copies(pack(rows, by)) if copies else pack(rows, by)
    given = packed.groupBy(*by).transformWithStateInPandas(
        statefulProcessor=processor, outputMode="Append", timeMode="EventTime",
        outputStructType=T.StructType([*[packed.schema[k] for k in by], T.StructField(PACKED, T.BinaryType())]),
    )
    return unpack(given, by, out).select(*keys, *[f.name for f in out if f.name not in keys])


def rising_amounts(stream: DataFrame, machine: Machine, ties: Sequence[str], slot: float = 60) -> DataFrame:
    """``monitor.rise_machine`` live: a deadline fires once the watermark has passed it and no row cancelled it."""

    def expire(state: dict) -> tuple[dict[str, np.ndarray], dict]:
        return {"_deadline": np.array([state["deadline"]], "int64")}, state | {"deadline": None}

    return in_order(stream, machine, ties, slot, lambda state: state["deadline"], expire, needs=["_x", "_at"])


def count_windows(size: int) -> Machine:
    """Sum of each ``size`` consecutive rows ``_x`` of a key and the window's number; nulls count as rows only."""
    state = T.StructType([T.StructField(n, T.LongType()) for n in ("no", "n", "total")])
    out = T.StructType([T.StructField("window_no", T.LongType()), T.StructField("total", T.LongType())])

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        x = columns["_x"]
        if x.dtype.kind == "O":  # whole numbers among nulls
            known = np.array([v is not None for v in x], bool)
            x = np.array([0 if v is None else int(v) for v in x], "int64")
        else:
            known = ~np.isnan(x)
            x = np.where(known, x, 0)
        heads = np.concatenate([[0], np.arange(size - state["n"], len(x), size)])
        totals = [int(v) if k else None for v, k in zip(np.add.reduceat(x, heads).tolist(), np.logical_or.reduceat(known, heads))]
        if state["total"] is not None:
            totals[0] = state["total"] + (totals[0] or 0)
        whole = (state["n"] + len(x)) // size
        open_total = totals[whole] if whole < len(totals) else None
        return {"window_no": state["no"] + np.arange(whole), "total": np.array(totals[:whole], object)}, {
            "no": state["no"] + whole, "n": (state["n"] + len(x)) % size, "total": open_total}

    return Machine(("_x",), out, state, {"no": 0, "n": 0, "total": None}, step, lambda s: {})


def times_next(times: int, ids: T.DataType, span_us: int | None = None) -> Machine:
    """``times`` rows ``_start`` with anything between, then a row ``_follows`` directly after the last of them.

    ``span_us`` bounds the time from the first row to the following one, itself not included. The state is the last
    start rows and whether the row before was one.
    """
    lists = [T.StructField("ids", T.ArrayType(ids)), T.StructField("times", T.ArrayType(T.LongType()))]
    state = T.StructType([*lists, T.StructField("fresh", T.BooleanType())])
    named = [T.StructField(n, ids) for n in ("first_id", "last_id", "next_id")]
    out = T.StructType([*named, T.StructField("first_us", T.LongType()), T.StructField("next_us", T.LongType())])

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        held = len(state["ids"] or [])
        start = columns["_start"].astype(bool)
        row = np.concatenate([np.array(state["ids"] or [], columns["_row"].dtype), columns["_row"][start]])
        at = np.concatenate([np.array(state["times"] or [], "int64"), columns["_at"][start]])
        seen = held + np.cumsum(start)  # start rows up to and with each row
        before = np.concatenate([[bool(state["fresh"])], start[:-1]])
        last = np.where(start, seen - 1, seen) - 1  # the newest start row before each row
        hit = columns["_follows"].astype(bool) & before & (last + 1 >= times)
        hit = np.flatnonzero(hit)
        first = last[hit] + 1 - times
        if span_us is not None:
            near = columns["_at"][hit] < at[first] + span_us
            hit, first = hit[near], first[near]
        keep = slice(max(0, len(row) - times), None)
        return {
            "first_id": row[first], "last_id": row[last[hit]], "next_id": columns["_row"][hit], "first_us": at[first],
            "next_us": columns["_at"][hit],
        }, {"ids": row[keep].tolist(), "times": at[keep].tolist(), "fresh": bool(start[-1])}

    return Machine(("_row", "_at", "_start", "_follows"), out, state, {"ids": [], "times": [], "fresh": False}, step, lambda s: {})


SALTS = 32


def rule_in_force(ids: T.DataType, missing: str | None = "") -> Machine:
    """Rows ``_rule`` (null for events) and ``_row`` (null for rules) to events ``_id`` with the rule of their time."""
    out = T.StructType([T.StructField("_id", ids), T.StructField("rule", T.StringType())])
    state = T.StructType([T.StructField("set_at", T.LongType()), T.StructField("rule", T.StringType())])

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        is_rule = columns["_kind"] == 0
        place = np.maximum.accumulate(np.where(is_rule, np.arange(len(is_rule)), -1))
        old = missing if state["rule"] is None else state["rule"]
        rule = np.where(place >= 0, columns["_rule"][place], old)
        if place[-1] >= 0:
            state = {"set_at": int(columns["_at"][place[-1]]), "rule": columns["_rule"][place[-1]]}
        return {"_id": columns["_row"][~is_rule], "rule": rule[~is_rule]}, state

    return Machine(("_row", "_rule", "_kind", "_at"), out, state, {"set_at": None, "rule": None}, step, lambda s: {})


def rules_asof(events: DataFrame, rules: DataFrame, tier: str, ts: str, rule: str, row_id: str, delay: str,
               missing: str | None = "", salts: int = SALTS, slot: float = 60) -> DataFrame:
    """Two streams: each event with the newest rule of its tier that was set at or before it.

    Both are one stream of tagged rows with one watermark, so a rule may come up to ``delay`` after later events and
    still applies to them. A tier's events are dealt to ``salts`` keys by their id, its rules go to all of them: rules
    are few, and no state holds all events of a tier. Both travel packed, rules once per tier up to the copies. Rules wait in state until the watermark passes; then the newest
    one stays. Of rules set at one time the largest text counts. Columns: ``tier``, ``salt``, ``_id``, ``rule``
    and those of late rows (``in_order``): late events have no rule, a late rule applies from then on if none is newer.
    """
    ids = events.schema[row_id].dataType
    salt = F.pmod(F.xxhash64(row_id), F.lit(salts)).cast("int")
    tagged = events.select(
        F.col(tier).alias("tier"), salt.alias("salt"), F.col(ts).alias("ts"), F.col(row_id).alias("_row"),
        F.lit(None).cast("string").alias("_rule"), F.lit(1).alias("_kind"),
    )
    told = rules.where(F.col(rule).isNotNull()).select(
        F.col(tier).alias("tier"), F.lit(None).cast("int").alias("salt"), F.col(ts).alias("ts"), F.lit(None).cast(ids).alias("_row"),
        F.col(rule).cast("string").alias("_rule"), F.lit(0).alias("_kind"),
    )
    both = tagged.unionByName(told).withWatermark("ts", delay)
    us = F.unix_micros("ts")
    rows = both.select("tier", "salt", us.alias("at"), us.alias("_at"), "_row", "_rule", "_kind")

    def notice(columns: dict[str, np.ndarray], state: dict) -> dict:
        for at, text, kind in zip(columns["_at"], columns["_rule"], columns["_kind"]):
            if kind == 0 and (state["set_at"] is None or (int(at), text) > (state["set_at"], state["rule"])):
                state = {"set_at": int(at), "rule": text}
        return state

    def spread(packed: DataFrame) -> DataFrame:
        every = F.sequence(F.lit(0), F.lit(salts - 1))
        return packed.withColumn("salt", F.explode(F.when(F.col("salt").isNull(), every).otherwise(F.array("salt"))))

    return in_order(rows, rule_in_force(ids, missing), ["_kind", "_rule", "_row"], slot, notice=notice, keys=["tier", "salt"], copies=spread)
