"""Patterns over the event sequence of each key, found by looking at neighbours in that sequence.

``key`` is a column or several; without one (``None`` or ``[]``) all rows are one sequence.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.dedup import union_streams
from streamlens.operators.ordered import MAX_ROWS, Machine, Ordered, cut, fold, nearby, running, wide


def single(df: DataFrame, condition: Column) -> DataFrame:
    """A pattern of one event: every row which fulfils the condition."""
    return df.where(condition)


def chained(*steps: tuple[str, Column]) -> Column:
    """``where``/``or`` steps combined strictly from left to right, without precedence."""
    (_, result), *rest = steps
    for kind, condition in rest:
        result = (result | condition) if kind == "or" else (result & condition)
    return result


def _keys(key: str | Sequence[str] | None) -> list[str]:
    return [key] if isinstance(key, str) else list(key or [])


def _with_next(df: DataFrame, key: str | Sequence[str] | None, order: Sequence[str], following: Column,
               event: Sequence[str], max_rows: int) -> Ordered:
    """Each row with the one directly after it, and whether that one fulfils ``following``."""
    return nearby(
        cut(df, _keys(key), order, max_rows),
        {
            "_next": lambda w: F.lead(F.struct(*event)).over(w),
            "_follows": lambda w: F.lead(F.coalesce(following, F.lit(False)), 1, False).over(w),
        },
        after=1,
    )


def _times(starts: Ordered, key: str | Sequence[str] | None, times: int, event: Sequence[str]) -> DataFrame:
    """Matches from the start rows, which alone are looked at: the last is ``times - 1`` further."""
    found = nearby(
        starts,
        {
            "_last": lambda w: F.lead(F.struct(*event), times - 1).over(w),
            "_n": lambda w: F.lead("_next", times - 1).over(w),
            "_f": lambda w: F.lead("_follows", times - 1, False).over(w),
        },
        after=times - 1,
    ).result()
    return found.where("_f").select(
        *_keys(key), F.struct(*event).alias("first"), F.col("_last").alias("last"), F.col("_n").alias("next")
    )


def times_next(df: DataFrame, key: str | Sequence[str] | None, order: Sequence[str], start: Column, following: Column,
               times: int, event: Sequence[str], max_rows: int = MAX_ROWS) -> DataFrame:
    """``times`` rows fulfilling ``start`` with anything between, then ``following`` directly after.

    Every start row may open a match. One output row per match: the key, ``first``, ``last`` and
    ``next``, each a struct of the ``event`` columns.
    """
    starts = _with_next(df, key, order, following, event, max_rows).where(start)
    return _times(starts, key, times, event)


def times_range_next(df: DataFrame, key: str | Sequence[str] | None, order: Sequence[str], start: Column,
                     following: Column, least: int, most: int, event: Sequence[str],
                     max_rows: int = MAX_ROWS) -> DataFrame:
    """Matches of ``times_next`` for each count from ``least`` to ``most``, with the count."""
    starts = _with_next(df, key, order, following, event, max_rows).where(start)
    return union_streams(*[
        _times(starts, key, n, event).withColumn("times", F.lit(n)) for n in range(least, most + 1)
    ])


def within(matches: DataFrame, ts: str, interval: str) -> DataFrame:
    """Matches whose last event is less than ``interval`` after the first one."""
    return matches.where(
        F.col(f"next.{ts}") < F.col(f"first.{ts}") + F.expr(f"INTERVAL {interval}")
    )


def select_first(matches: DataFrame, key: str | Sequence[str] | None, columns: Sequence[str]) -> DataFrame:
    """The result function: columns of the first event of each match."""
    return matches.select(*_keys(key), *[F.col(f"first.{c}").alias(c) for c in columns])


def one_or_more_until(df: DataFrame, key: str | Sequence[str] | None, order: Sequence[str], loop: Column, until: Column,
                      out: str = "matches", max_rows: int = MAX_ROWS) -> DataFrame:
    """Loops over ``loop`` rows which end before the next ``until`` row of the key.

    A start row opens one match for every ``loop`` row from itself to the end of its stretch, so
    the matches grow with the square of a stretch. Each start row is given once instead, with the
    number of its matches and of its stretch: the k-th match has the first k loop rows from there.
    """
    stop = F.coalesce(until, F.lit(False))
    accepted = F.coalesce(loop, F.lit(False)) & ~stop
    o = cut(df.withColumns({"_in": accepted, "_stop": stop}), _keys(key), order, max_rows)
    o = running(o, {"stretch": ("sum", F.col("_stop").cast("int")),
                    "_seen": ("sum", F.col("_in").cast("int"))})
    o = running(
        o,
        {"_at_stop": ("last", F.when(F.col("_stop"), F.col("_seen"))), "_all": ("max", F.col("_seen"))},
        reverse=True,
    )
    found = o.result().where("_in")
    upto = F.coalesce("_at_stop", "_all")
    return found.withColumn(out, upto - F.col("_seen") + 1).drop(
        "_in", "_stop", "_seen", "_at_stop", "_all"
    )


def longest_loops(matches: DataFrame, key: str | Sequence[str] | None, order: Sequence[str], out: str = "matches") -> DataFrame:
    """Skip past the last event: per stretch only the loop which starts first, with its length."""
    first = F.min_by(F.struct(*[c for c in matches.columns if c not in (*_keys(key), "stretch")]),
                     F.struct(*order))
    return matches.groupBy(*_keys(key), "stretch").agg(first.alias("_m")).select(*_keys(key), "stretch", "_m.*") \
        .withColumnRenamed(out, "length")


def history_machine(id_kind: T.DataType, percent: int) -> Machine:
    """Rows ``_row``, ``_x`` to those accepted, each with the number and sum of the rows accepted before it.

    Each acceptance moves the bar, so acceptances are found one after the other, in growing blocks. A chunk whose
    largest value is not above the bar accepts nothing and hands the history on as it is.
    """
    history = T.StructType([T.StructField("matches", T.LongType()), T.StructField("total", T.LongType())])
    out = T.StructType([T.StructField("_id", id_kind), T.StructField("_hit", T.LongType()), *history])

    def bar(state: dict) -> int | None:
        return percent * state["total"] // (100 * state["matches"]) if state["matches"] else None

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        x = columns["_x"]
        n, total, at = state["matches"], state["total"], 0
        hits, counts, totals = [], [], []
        while at < len(x):
            limit, size = bar({"matches": n, "total": total}), 16
            while at < len(x):
                above = x[at:at + size] > limit if limit is not None else np.ones(1, bool)
                if above.any():
                    at += int(above.argmax())
                    hits.append(at)
                    counts.append(n)
                    totals.append(total)
                    n, total, at = n + 1, total + x[at].item(), at + 1
                    break
                at, size = at + size, size * 2
        found = np.array(hits, int)
        emitted = {"_id": columns["_row"][found], "_hit": x[found], "matches": np.array(counts, np.int64), "total": np.array(totals, np.int64)}
        return emitted, {"matches": n, "total": total}

    def finish(state: dict) -> dict[str, np.ndarray]:
        return {c: np.array([]) for c in out.names}

    def carry(given: dict, end: dict, facts: dict) -> dict:
        limit = bar(given)
        return given if limit is not None and facts["most"] <= limit else end

    return Machine(("_row", "_x"), out, history, {"matches": 0, "total": 0}, step, finish, {"most": F.max("_x")}, carry)


def above_history(df: DataFrame, key: str, value: str, row_id: str, order: Sequence[str], percent: int = 100,
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """A condition over earlier matches: rows whose value is above ``percent`` per cent of the mean of those accepted so far.

    ``value`` holds whole numbers. The first row of a key is accepted. Output: the key, ``row_id``, ``value``, and
    ``matches`` and ``total``, the number and sum of the rows accepted before. Rows without a value or id are left out;
    rows of equal order count in any order, so ``order`` should be unique. In a large key, chunks that accept nothing are
    passed over; those that do run again once their history is known, at most once per chunk that accepts.
    """
    id_kind = wide(df, row_id, T.StringType())
    rows = df.dropna(subset=[value, row_id]).select(
        key, *order, F.col(row_id).cast(id_kind).alias("_row"), F.col(value).cast("long").alias("_x")
    )
    hits = fold(cut(rows, [key], order, max_rows), history_machine(id_kind, percent))
    return hits.select(key, F.col("_id").alias(row_id), F.col("_hit").alias(value), "matches", "total")
