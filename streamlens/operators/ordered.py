"""Ordered work over keys of any size.

A plain ``Window.partitionBy(key)`` puts all rows of a key into one task. That is the best plan
while every key is moderate, and the wrong one as soon as a single key holds a large share of the
table. The functions here take the plain plan when a check shows that no key is large. Otherwise
the rows of the large keys are range-partitioned by (key, order), so that such a key spans many
evenly sized chunks, and what must pass from chunk to chunk travels in a small carry table.

``cut`` decides and returns an ``Ordered``; ``running``, ``nearby`` and ``fold`` consume it.
``running_overall`` does the same for one order over all rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.chains import WIDTH, Moves, composed, handed_down
from streamlens.session import pin

MAX_ROWS = 1_000_000
MAX_CHUNKS = 20_000
BROADCAST_KEYS = 100_000
MIN_SLOTS, MAX_SLOTS = 64, 1_000_000
CHUNK = "_chunk"


@dataclass(frozen=True)
class Ordered:
    """Rows with a total order per key. ``split`` tells whether large keys were cut in chunks."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    split: bool
    max_rows: int

    def window(self, reverse: bool = False) -> WindowSpec:
        order = [F.col(c).desc() if reverse else F.col(c).asc() for c in self.order]
        return Window.partitionBy(*self.keys, CHUNK).orderBy(*order)

    def result(self) -> DataFrame:
        return self.df.drop(CHUNK)

    def select(self, *columns: str | Column) -> Ordered:
        return replace(self, df=self.df.select(*columns, CHUNK))

    def with_columns(self, columns: dict[str, Column]) -> Ordered:
        return replace(self, df=self.df.withColumns(columns))

    def where(self, condition: Column) -> Ordered:
        return replace(self, df=self.df.where(condition))


def _same_key(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    parts = [left[k].eqNullSafe(right["_key_" + k]) for k in keys]
    return reduce(lambda a, b: a & b, parts, F.lit(True))


def cut(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    max_rows: int = MAX_ROWS,
    sized_by: DataFrame | None = None,
) -> Ordered:
    """Prepare ``df`` for ordered work; ``order`` must be a total order within a key.

    One aggregation counts rows per key. If no key exceeds ``max_rows`` nothing is moved.
    ``sized_by`` is a cheaper relation with the same keys and rows to count instead.
    """
    keys, order = tuple(keys), tuple(order)
    whole = Ordered(df.withColumn(CHUNK, F.lit(0)), keys, order, False, max_rows)
    counted = df if sized_by is None else sized_by
    sizes = counted.groupBy(*keys).agg(F.count("*").alias("_rows"))
    large = sizes.where(F.col("_rows") > max_rows)
    if large.isEmpty():
        return whole

    large = pin(large, "large-keys")
    found = large.agg(F.sum("_rows").alias("rows"), F.count("*").alias("keys")).first()
    chunks = min(max(2, math.ceil(found.rows / max_rows)), MAX_CHUNKS)
    if keys:
        names = large.select(*[F.col(k).alias("_key_" + k) for k in keys])
        if found.keys <= BROADCAST_KEYS:
            names = F.broadcast(names)
        hot = df.join(names, _same_key(df, names, keys), "left_semi")
        cold = df.join(names, _same_key(df, names, keys), "left_anti")
    else:
        hot, cold = df, None
    # The chunk number must never be computed twice: a second sampling could cut elsewhere.
    ranged = hot.repartitionByRange(chunks, *keys, *order).withColumn(
        CHUNK, F.spark_partition_id() + 1
    )
    rows = pin(ranged, "chunks")
    if cold is not None:
        rows = rows.unionByName(cold.withColumn(CHUNK, F.lit(0)))
    return replace(whole, df=rows, split=True)


def _carry(o: Ordered, totals: Sequence[Column], before: Callable[[WindowSpec], list[Column]],
           reverse: bool) -> DataFrame:
    """Per (key, chunk): what the chunks before it (after it, if ``reverse``) hand over.

    One row per large key and chunk, so its size depends on the number of chunks, not of rows.
    """
    w = Window.partitionBy(*o.keys).orderBy(
        F.col(CHUNK).desc() if reverse else F.col(CHUNK).asc()
    )
    per_chunk = o.df.where(F.col(CHUNK) > 0).groupBy(*o.keys, CHUNK).agg(*totals)
    names = [F.col(k).alias("_key_" + k) for k in o.keys]
    return per_chunk.select(
        *names, F.col(CHUNK).alias("_of_chunk"), *before(w.rowsBetween(Window.unboundedPreceding, -1))
    )


Values = dict[str, tuple[str, Column]]


def _total(kind: str, value: Column, position: Column, reverse: bool = False) -> Column:
    """Aggregate of a group of rows which stands for them in a running value."""
    if kind == "last":
        return (F.min_by if reverse else F.max_by)(value, F.when(value.isNotNull(), position))
    return getattr(F, kind)(value)


def _over_totals(kind: str, value: Column, w: WindowSpec) -> Column:
    """The same over totals instead of rows."""
    if kind == "last":
        return F.last(value, ignorenulls=True).over(w)
    return getattr(F, "sum" if kind == "count" else kind)(value).over(w)


def _joined(kind: str, here: Column, there: Column) -> Column:
    """Running value within a group, continued from what came before the group."""
    if kind in ("sum", "count"):
        return here + F.coalesce(there, F.lit(0))
    if kind == "last":
        return F.coalesce(here, there)
    return (F.greatest if kind == "max" else F.least)(here, there)


def running(o: Ordered, values: Values, *, strict: bool = False, reverse: bool = False) -> Ordered:
    """Add running values per key: ``{"name": (kind, column)}``.

    Kinds are ``sum``, ``count``, ``max``, ``min`` and ``last`` (newest non-null value).
    ``strict`` leaves the current row out; ``reverse`` runs from the end, so that a strict reversed
    ``last`` is the next non-null value.
    """
    frame = o.window(reverse).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)

    def local(kind: str, value: Column) -> Column:
        if kind == "last":
            return F.last(value, ignorenulls=True).over(frame)
        result = getattr(F, kind)(value).over(frame)
        return F.coalesce(result, F.lit(0)) if kind == "sum" else result

    rows = o.df.withColumns({n: local(k, v) for n, (k, v) in values.items()})
    if not o.split:
        return replace(o, df=rows)

    position = F.struct(*o.order)
    carry = _carry(
        o,
        [_total(k, v, position, reverse).alias("_t_" + n) for n, (k, v) in values.items()],
        lambda w: [_over_totals(k, F.col("_t_" + n), w).alias("_c_" + n)
                   for n, (k, _) in values.items()],
        reverse,
    )
    out = rows.join(
        carry, _same_key(rows, carry, o.keys) & (rows[CHUNK] == carry["_of_chunk"]), "left"
    )
    done = out.withColumns(
        {n: _joined(k, F.col(n), F.col("_c_" + n)) for n, (k, _) in values.items()}
    )
    return replace(o, df=done.select(*rows.columns))


def running_overall(
    df: DataFrame,
    order: Sequence[str],
    values: Values,
    *,
    strict: bool = False,
    max_rows: int = MAX_ROWS,
    sized_by: DataFrame | None = None,
) -> DataFrame:
    """Running values over all rows in one order, whose first column is a timestamp.

    Time is cut into slots of equal length. Rows are scanned per slot in parallel, slot totals are
    added up in order, and each row continues from the total before its slot. The totals are one
    row per slot, at most ``MAX_SLOTS``. A slot in which rows crowd is itself cut by ``cut``.
    """
    ts = order[0]
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    counted = df if sized_by is None else sized_by
    seen = counted.agg(
        F.count("*").alias("rows"), F.min(us).alias("a"), F.max(us).alias("z")
    ).first()
    slots = min(max(MIN_SLOTS, math.ceil(4 * seen.rows / max_rows)), MAX_SLOTS)
    width = max(1, math.ceil(((seen.z or 0) - (seen.a or 0) + 1) / slots))
    slot = F.floor((us - F.lit(seen.a or 0)) / width)
    slotted = df.withColumn("_slot", slot)
    o = cut(slotted, ["_slot"], order, max_rows, counted.select(slot.alias("_slot")))
    rows = running(o, values, strict=strict).result()

    position = F.struct(*order)
    totals = slotted.groupBy("_slot").agg(
        *[_total(k, v, position).alias("_t_" + n) for n, (k, v) in values.items()]
    )
    before = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(
        F.col("_slot").alias("_of_slot"),
        *[_over_totals(k, F.col("_t_" + n), before).alias("_c_" + n)
          for n, (k, _) in values.items()],
    )
    out = rows.join(carry, rows["_slot"].eqNullSafe(carry["_of_slot"]), "left")
    done = out.withColumns(
        {n: _joined(k, F.col(n), F.col("_c_" + n)) for n, (k, _) in values.items()}
    )
    return done.select(*df.columns, *values)


def nearby(
    o: Ordered,
    values: dict[str, Callable[[WindowSpec], Column]],
    *,
    before: int = 0,
    after: int = 0,
) -> Ordered:
    """Add window values which look at most ``before`` rows back and ``after`` rows ahead.

    Each value is a function from the window (partition and order set) to a column. For large keys
    the rows are cut anew by exact position, and the rows at each edge are copied to the
    neighbouring piece, where they serve as context and are dropped afterwards.
    """
    if not o.split:
        return replace(o, df=o.df.withColumns({n: f(o.window()) for n, f in values.items()}))
    if max(before, after) >= o.max_rows:
        raise ValueError("before and after must be smaller than max_rows")

    columns = o.df.columns
    placed = running(o, {"_pos": ("count", F.lit(1))}).df
    place = (F.col("_pos") - 1) % o.max_rows
    piece = F.floor((F.col("_pos") - 1) / o.max_rows)
    copies = placed.withColumn("_own", piece).withColumn(
        "_piece",
        F.explode(
            F.array_compact(
                F.array(
                    piece,
                    F.when(place >= o.max_rows - before, piece + 1),
                    F.when((place < after) & (piece > 0), piece - 1),
                )
            )
        ),
    )
    w = Window.partitionBy(*o.keys, "_piece").orderBy(*o.order)
    out = copies.withColumns({n: f(w) for n, f in values.items()})
    return replace(o, df=out.where(F.col("_own") == F.col("_piece")).select(*columns, *values))


Columns = dict[str, np.ndarray]


@dataclass(frozen=True)
class Machine:
    """A state machine over the ordered rows of a key.

    ``step(columns, state)`` gets some consecutive rows as arrays and returns the emitted columns
    and the next state; ``finish(state)`` returns what the end of the key emits.

    For keys cut in chunks, ``carry(given, end, facts)`` may tell in which state a chunk will end
    if it starts from ``given``, when its last run ended in ``end``; ``facts`` are the ``summary``
    aggregates of its rows. ``moves`` tells all chunks' start states beforehand, from functions that are composed.
    A wrong answer of either costs another run of what follows, never a wrong row.
    """

    inputs: tuple[str, ...]
    out: T.StructType
    state: T.StructType
    initial: dict
    step: Callable[[Columns, dict], tuple[Columns, dict]]
    finish: Callable[[dict], Columns]
    summary: dict[str, Column] = field(default_factory=dict)
    carry: Callable[[dict, dict, dict], dict] | None = None
    moves: Moves | None = None


ARROW = {T.LongType(): pa.int64(), T.IntegerType(): pa.int32(), T.DoubleType(): pa.float64(),
         T.BooleanType(): pa.bool_(), T.StringType(): pa.string()}


def wide(df: DataFrame, column: str, other: T.DataType) -> T.DataType:
    """The type in which a machine handles a column: whole numbers as long, all else as ``other``."""
    return T.LongType() if isinstance(df.schema[column].dataType, T.IntegralType) else other


def _runner(m: Machine, group: list[str], chunked: bool):
    """Arrow function over rows sorted by group and order; state passes from batch to batch.

    A task holds one Arrow batch at a time, whatever the size of a key. In chunks, the start state
    is read from the rows, and each chunk also emits a closing row with its start and end state.
    """
    emits, names = m.out.names, m.state.names
    types = {f.name: ARROW[f.dataType] for f in m.out}
    types |= {p + f.name: ARROW[f.dataType] for f in m.state for p in ("_s_", "_e_")}
    types["_end"] = pa.bool_()
    inputs, step, finish, initial = m.inputs, m.step, m.finish, m.initial

    def run(batches):
        name = state = start = None
        ends_key = False
        key_types = None

        def row_columns():
            columns = [*group, *emits]
            if chunked:
                columns += ["_s_" + n for n in names] + ["_e_" + n for n in names] + ["_end"]
            return {c: [] for c in columns}

        def put(rows, emitted, closing=False):
            count = 1 if closing else len(emitted[emits[0]])
            for c, v in zip(group, name):
                rows[c].extend([v] * count)
            for c in emits:
                rows[c].extend([None] if closing else emitted[c].tolist())
            if chunked:
                for n in names:
                    rows["_s_" + n].extend([start[n]] * count)
                    rows["_e_" + n].extend([state[n] if closing else None] * count)
                rows["_end"].extend([closing] * count)

        def close(rows):
            if name is not None:
                if ends_key:
                    put(rows, finish(state))
                if chunked:
                    put(rows, None, closing=True)

        def record(rows):
            return pa.RecordBatch.from_pydict(
                {c: pa.array(v, key_types.get(c) or types[c]) for c, v in rows.items()}
            )

        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            key_types = {k: batch.schema.field(k).type for k in group}
            new = np.ones(size, bool)
            codes = [
                batch.column(k).dictionary_encode(null_encoding="encode").indices.to_numpy()
                for k in group
            ]
            new[1:] = np.any([c[1:] != c[:-1] for c in codes], axis=0) if codes else False
            heads = np.flatnonzero(new)
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in inputs}
            rows = row_columns()
            for head, tail in zip(heads, [*heads[1:], size]):
                here = tuple(batch.column(k)[int(head)].as_py() for k in group)
                if here != name:
                    close(rows)
                    name, ends_key = here, True
                    state = dict(initial)
                    if chunked:
                        state = {n: batch.column("_s_" + n)[int(head)].as_py() for n in names}
                        ends_key = batch.column("_last")[int(head)].as_py()
                    start = dict(state)
                emitted, state = step({c: v[head:tail] for c, v in columns.items()}, state)
                put(rows, emitted)
            yield record(rows)
        if name is not None:
            rows = row_columns()
            close(rows)
            yield record(rows)

    return run


def fold(o: Ordered, m: Machine) -> DataFrame:
    """Run a state machine over the rows of each key and return what it emits.

    Without large keys this is one pass. With them, a machine with ``moves`` takes one pass to learn what each chunk
    does to a state, and the functions of chunks are composed in a tree to give all start states; without it all chunks
    start from the initial state. After the chunks ran, one scan over the table of chunks, in which ``carry`` takes a
    state past chunks whose answer is known, gives the start states of the next round. Chunks that started from
    another state run again, until none did. The result is exact in any case: each chunk was last
    run from its true start state. Machines with ``moves``, and those that forget their past, need one or two rounds.
    """
    if o.split:
        return _fold_chunks(o, m)
    keys = [*o.keys]
    rows = o.df.select(*keys, *[c for c in o.order if c not in keys], *m.inputs)
    ordered = rows.repartition(*keys).sortWithinPartitions(*keys, *o.order)
    schema = T.StructType([o.df.schema[k] for k in keys] + m.out.fields)
    return ordered.select(*keys, *m.inputs).mapInArrow(_runner(m, keys, False), schema)


def _next_starts(m: Machine, group: list[str]):
    """Arrow function over the chunks of a key (one row each): those to run again, and from where."""
    names, facts, carry = m.state.names, tuple(m.summary), m.carry

    def scan(chunks: pa.Table) -> pa.Table:
        def same(a, b):
            return a == b or (a != a and b != b)

        rows, again, state = chunks.sort_by(CHUNK).to_pylist(), [], {}
        for i, row in enumerate(rows):
            end = {n: row["_e_" + n] for n in names}
            if i and not all(same(state[n], row["_s_" + n]) for n in names):
                start = {"_s_" + n: state[n] for n in names}
                again.append({c: row[c] for c in group} | {"_last": i + 1 == len(rows)} | start)
                if carry is not None:
                    end = carry(state, end, {n: row["_a_" + n] for n in facts})
            state = end
        known = [chunks.schema.field(c) for c in [*group, *["_s_" + n for n in names]]]
        known.insert(len(group), pa.field("_last", pa.bool_()))
        return pa.Table.from_pylist(again, pa.schema(known))

    return scan


def _functions(m: Machine, keys: list[str], before: list[str]):
    """Arrow function over the sorted rows of chunks: what each chunk does to the state, packed.

    A task holds the input columns of one chunk.
    """
    inputs, function = m.inputs, m.moves.function
    group = [*keys, "_index"]

    def run(batches):
        name, parts, given = None, [], {}

        def close():
            columns = {c: np.concatenate([p[c] for p in parts]) for c in inputs}
            body = function(columns, given).dump()
            return pa.RecordBatch.from_arrays(
                [*[pa.array([v], t) for v, t in zip(name, kinds)], pa.array([body], pa.binary())], names=[*group, "_steps"]
            )

        kinds = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(c).type for c in group]
            codes = [batch.column(c).dictionary_encode(null_encoding="encode").indices.to_numpy() for c in group]
            new = np.any([c[1:] != c[:-1] for c in codes], axis=0)
            heads = [0, *(np.flatnonzero(new) + 1), batch.num_rows]
            for head, tail in zip(heads, heads[1:]):
                here = tuple(batch.column(c)[int(head)].as_py() for c in group)
                if here != name:
                    if name is not None:
                        yield close()
                    name, parts = here, []
                    known = {c: batch.column("_b_" + c)[int(head)].as_py() for c in before}
                    given = known if here[-1] else {}
                part = batch.slice(head, tail - head)
                parts.append({c: part.column(c).to_numpy(zero_copy_only=False) for c in inputs})
        if name is not None:
            yield close()

    return run


def _foreseen(o: Ordered, m: Machine) -> DataFrame:
    """Start states of the chunks of large keys, from their functions: up the tree by composing, down by applying."""
    keys, moves = [*o.keys], m.moves
    group, before = [*keys, CHUNK], [*moves.context]
    hot = o.df.where(F.col(CHUNK) > 0)
    along = Window.partitionBy(*keys).orderBy(CHUNK)
    counted = hot.groupBy(*group).agg(F.count("*").alias("_rows"), *[c.alias("_x_" + n) for n, c in moves.context.items()])
    chunks = pin(
        counted.select(
            *group, (F.row_number().over(along) - 1).cast("long").alias("_index"), F.lead(CHUNK).over(along).isNull().alias("_last"),
            *[F.lag("_x_" + n).over(along).alias("_b_" + n) for n in before],
        ),
        "fold-chunks",
    )

    def to(left: DataFrame, right: DataFrame, *columns: str) -> DataFrame:
        """``right``'s further columns for the same key and ``columns`` pairs ``left = right``."""
        names = [F.col(k).alias("_key_" + k) for k in keys]
        rest = [c for c in right.columns if c not in keys]
        there = right.select(*names, *[F.col(c).alias("_r_" + c) for c in rest])
        on = _same_key(left, there, keys)
        for a in columns:
            here, _, other = a.partition("=")
            on = on & (left[here] == there["_r_" + (other or here)])
        return left.join(there, on).select(left["*"], *[there["_r_" + c].alias(c) for c in rest if c not in left.columns])

    source = hot.select(*group, *[c for c in o.order if c not in group], *[c for c in m.inputs if c not in o.order])
    rows = to(source, chunks, CHUNK).repartition(*group).sortWithinPartitions(*group, *o.order)
    key_fields = [o.df.schema[k] for k in keys]
    schema = T.StructType([*key_fields, T.StructField("_index", T.LongType()), T.StructField("_steps", T.BinaryType())])
    given = rows.select(*keys, "_index", *["_b_" + n for n in before], *m.inputs)
    levels = [pin(given.mapInArrow(_functions(m, keys, before), schema), "fold-functions")]
    count = (chunks.agg(F.max("_index")).first()[0] or 0) + 1
    while count > WIDTH:
        block = F.floor(F.col("_index") / WIDTH).alias("_block")
        levels.append(pin(levels[-1].groupBy(*keys, block).applyInArrow(composed(keys), schema), "fold-functions"))
        count = -(-count // WIDTH)

    kind = m.state[moves.state].dataType
    down = T.StructType([*key_fields, T.StructField("_index", T.LongType()), T.StructField("_state", kind)])
    initial = m.initial[moves.state]
    states = levels[-1].select(*keys).distinct().select(*keys, F.lit(0).cast("long").alias("_index"), F.lit(initial).cast(kind).alias("_state"))
    for functions in reversed(levels):
        dealt = functions.withColumn("_block", F.floor(F.col("_index") / WIDTH).cast("long"))
        first = to(dealt, states.withColumnRenamed("_index", "_of"), "_block=_of")
        states = first.groupBy(*keys, "_block").applyInArrow(handed_down(keys, ARROW[kind], initial), down)
    known = to(chunks, states, "_index")

    def start(name: str) -> Column:
        other = F.lit(m.initial[name])
        if name == moves.state:
            return F.col("_state")
        return F.when(F.col("_index") == 0, other).otherwise(F.col("_b_" + moves.given[name])) if name in moves.given else other

    return pin(
        known.select(*group, "_last", *[start(f.name).cast(f.dataType).alias("_s_" + f.name) for f in m.state]), "fold-foreseen"
    )


def _fold_chunks(o: Ordered, m: Machine) -> DataFrame:
    keys, names = [*o.keys], m.state.names
    group = [*keys, CHUNK]
    starts_as = ["_s_" + n for n in names]
    schema = T.StructType(
        [o.df.schema[k] for k in keys]
        + [T.StructField(CHUNK, T.IntegerType())]
        + m.out.fields
        + [T.StructField(p + f.name, f.dataType) for p in ("_s_", "_e_") for f in m.state]
        + [T.StructField("_end", T.BooleanType())]
    )

    def key_and_chunk(left: DataFrame, right: DataFrame) -> Column:
        return _same_key(left, right, keys) & (left[CHUNK] == right["_of_chunk"])

    def renamed(df: DataFrame, *more: str) -> DataFrame:
        return df.select(*[F.col(k).alias("_key_" + k) for k in keys], F.col(CHUNK).alias("_of_chunk"), *more)

    source = o.df.select(*group, *[c for c in o.order if c not in group],
                         *[c for c in m.inputs if c not in o.order])
    ahead = Window.partitionBy(*keys).orderBy(CHUNK)
    starts = (
        o.df.select(*group).distinct().select(
            *group,
            F.lead(CHUNK).over(ahead).isNull().alias("_last"),
            *[F.lit(m.initial[f.name]).cast(f.dataType).alias("_s_" + f.name) for f in m.state],
        )
    )
    if m.moves:
        starts = starts.where(F.col(CHUNK) == 0).unionByName(_foreseen(o, m))
    facts = None
    if m.summary:
        each = o.df.groupBy(*group).agg(*[c.alias("_a_" + n) for n, c in m.summary.items()])
        facts = renamed(pin(each, "fold-facts"), *["_a_" + n for n in m.summary])
    settled = None
    while True:
        todo = renamed(starts, "_last", *starts_as)
        rows = source.join(todo, key_and_chunk(source, todo), "inner")
        ordered = rows.repartition(*group).sortWithinPartitions(*group, *o.order)
        given = ordered.select(*group, "_last", *starts_as, *m.inputs)
        ran = pin(given.mapInArrow(_runner(m, group, True), schema), "fold")
        if settled is not None:
            redone = renamed(starts)
            kept = settled.join(redone, key_and_chunk(settled, redone), "left_anti")
            ran = pin(kept.unionByName(ran), "fold")
        settled = ran

        ends = settled.where("_end").select(*group, *starts_as, *["_e_" + n for n in names])
        if facts is not None:
            ends = ends.join(facts, key_and_chunk(ends, facts)).select(*ends.columns, *["_a_" + n for n in m.summary])
        scanned = ends.groupBy(*keys).applyInArrow(_next_starts(m, group), starts.schema)
        starts = pin(scanned, "fold-starts")
        if starts.isEmpty():
            return settled.where(~F.col("_end")).select(*keys, *m.out.names)
