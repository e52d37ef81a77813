"""Transaction-risk and traffic monitoring jobs."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.functions.scalar import risk_tier
from streamlens.operators.chains import Moves, Steps, ends_of
from streamlens.operators.joins import rules_asof_join
from streamlens.operators.ordered import MAX_ROWS, Machine, cut, fold, nearby, running, wide
from streamlens.operators.ranking import top_n
from streamlens.operators.transform import is_large


def rise_timers(at: np.ndarray, rise: np.ndarray, deadline: int | None, wait: int):
    """Follow one timer over ordered rows; return the deadlines that fired and the open one.

    ``at`` is in increasing order. A rise without a timer sets one, a non-rise up to the deadline
    cancels it, and it fires at the first row past the deadline, which then counts without a timer.
    """
    count = len(at)
    position = np.arange(count)
    # next rise and next non-rise at or after each row
    up = np.minimum.accumulate(np.where(rise, position, count)[::-1])[::-1]
    down = np.minimum.accumulate(np.where(rise, count, position)[::-1])[::-1]
    fired, i = [], 0
    while i < count:
        if deadline is None:
            i = int(up[i])
            if i < count:
                deadline, i = int(at[i]) + wait, i + 1
            continue
        past = int(np.searchsorted(at, deadline, side="right"))
        stop = int(down[i])
        if stop < past:
            deadline, i = None, stop + 1
        elif past < count:
            fired.append(deadline)
            deadline, i = None, past
        else:
            break
    return fired, deadline


def rise_machine(kind: T.DataType, wait: int, order: Sequence[str] = ()) -> Machine:
    """Rows ``_x``, ``_at`` (µs) to the deadlines ``_deadline`` that fired ``wait`` after a rise without a fall.

    Without a timer, a row leads to the next rise and from there to the row after the fall that cancels it, or to the
    first row past its deadline; ``moves`` follows these successors through a whole chunk.
    """
    number = np.int64 if kind == T.LongType() else np.float64
    state = T.StructType([T.StructField("amount", kind), T.StructField("deadline", T.LongType())])
    out = T.StructType([T.StructField("_deadline", T.LongType())])

    def rises(x: np.ndarray, before) -> np.ndarray:
        return x > np.concatenate([np.array([before], number), x[:-1]])

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        x, at = columns["_x"], columns["_at"]
        fired, deadline = rise_timers(at, rises(x, state["amount"]), state["deadline"], wait)
        return {"_deadline": np.array(fired, "int64")}, {"amount": x[-1].item(), "deadline": deadline}

    def finish(state: dict) -> dict[str, np.ndarray]:
        left = [] if state["deadline"] is None else [state["deadline"]]
        return {"_deadline": np.array(left, "int64")}

    def function(columns: dict[str, np.ndarray], before: dict) -> Steps:
        x, at = columns["_x"], columns["_at"]
        count = len(at)
        rise = rises(x, before.get("last", 0))
        place = np.arange(count)
        up = np.minimum.accumulate(np.where(rise, place, count)[::-1])[::-1]
        down = np.append(np.minimum.accumulate(np.where(rise, count, place)[::-1])[::-1], count)
        start = np.minimum(up, count - 1)
        past = np.searchsorted(at, at[start] + wait, side="right")
        fall = down[start + 1]
        # places count and count + 1 end the way: without a timer, and with the one of ``start``
        after = np.where(up == count, count, np.where(fall < past, fall + 1, np.where(past < count, past, count + 1 + place)))
        last = ends_of(np.concatenate((after, np.arange(count, 2 * count + 1))))
        row = np.minimum(np.maximum(last - count - 1, 0), count - 1)
        end, none = at[start[row]] + wait, last <= count
        # a deadline in the chunk's first rising run is passed at its row, a later one is cancelled by the fall
        fall = int(down[0])
        run = int(min(fall + 1, np.searchsorted(at, at[0] + wait, side="right") + 1, count))
        cuts = np.unique(at[:run])
        row = np.minimum(np.searchsorted(at, np.concatenate((cuts[:1] - 1, cuts)), side="right"), count)
        row = np.where(row > fall, fall + 1, row)
        keep = row >= count if fall >= count else np.zeros(len(row), bool)
        return Steps(cuts, end[row], keep, none[row] & ~keep, None if none[0] else end[0].item()).merged()

    context = {"last": F.max_by("_x", F.struct(*order))} if order else {}
    return Machine(("_x", "_at"), out, state, {"amount": number(0).item(), "deadline": None}, step, finish,
                   moves=Moves("deadline", function, context, {"amount": "last"}) if order else None)


def rising_amount_alert(df: DataFrame, key: str, amount: str, ts: str, order: Sequence[str],
                        seconds: int = 5, max_rows: int = MAX_ROWS) -> DataFrame:
    """Clients whose amount did not fall for ``seconds`` after a rise: key, start and alert time.

    The amount before the first row counts as 0. A timer still open at the end of the data fires.
    Whole numbers stay whole. Rows without an amount are left out.
    """
    wait = seconds * 1_000_000
    kind = wide(df, amount, T.DoubleType())
    machine = rise_machine(kind, wait, order)
    rows = df.dropna(subset=[amount, ts]).select(
        key, *[c for c in order], F.col(amount).cast(kind).alias("_x"),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_at"),
    )
    alerts = fold(cut(rows, [key], order, max_rows), machine)
    fire = F.timestamp_micros("_deadline").cast("timestamp_ntz")
    return alerts.select(
        key,
        F.timestamp_micros(F.col("_deadline") - wait).cast("timestamp_ntz").alias("start_ts"),
        fire.alias("alert_ts"),
    )


def large_transaction_monitor(df: DataFrame, client: str, amount: str, transfer: str, ts: str,
                              max_amount: float = 50_000, max_transfer: float = 200_000) -> DataFrame:
    """Clients and days with one transaction over a limit, or whose other ones add up over it.

    Both findings come out of one aggregation per client and day over one scan. Rows without an
    amount are left out.
    """
    single = is_large(amount, transfer, max_amount, max_transfer)
    day = F.window(ts, "1 day").alias("day")
    sums = (
        df.dropna(subset=[amount, transfer])
        .withColumn("_single", single)
        .groupBy(client, day)
        .agg(
            F.max(F.col("_single").cast("int")).alias("_hit"),
            F.sum(F.when(~F.col("_single"), F.col(amount))).alias("_amount"),
            F.sum(F.when(~F.col("_single"), F.col(transfer))).alias("_transfer"),
        )
    )
    by_sum = F.coalesce(is_large("_amount", "_transfer", max_amount, max_transfer), F.lit(False))
    return sums.select(
        client, F.col("day.start").alias("day"),
        (F.col("_hit") == 1).alias("by_single"), by_sum.alias("by_sum"),
    ).where(F.col("by_single") | F.col("by_sum"))


def flagged_clients(monitored: DataFrame, client: str, name: str = "block_trade") -> DataFrame:
    """The members of the set all findings go to, each client once."""
    return monitored.select(F.lit(name).alias("set_name"), client).distinct()


def risk_tier_tag(df: DataFrame, rules: DataFrame, amount: str, name: str, ts: str,
                  order: Sequence[str], medium: float = 50_000, high: float = 100_000,
                  **join) -> DataFrame:
    """Tier of each row by amount, and its name prefixed by the tier's rule at that time."""
    tiered = df.withColumn("tier", risk_tier(F.col(amount), medium, high))
    tagged = rules_asof_join(tiered, rules, "tier", ts, "rule", order, **join)
    return tagged.withColumn("tagged_name", F.concat(F.col("rule"), F.col(name)))


def top_with_ttl(df: DataFrame, client: str, amount: str, ts: str, order: Sequence[str],
                 ttl: str = "10 seconds", n: int = 3, max_rows: int = MAX_ROWS) -> DataFrame:
    """The ``n`` largest amounts per client and activity session.

    Every row renews the client's stored list, so the list expires after a gap longer than ``ttl``.
    """
    rows = cut(df, [client], order, max_rows)
    rows = nearby(rows, {"_before": lambda w: F.lag(ts).over(w)}, before=1)
    expired = F.col("_before").isNull() | (F.col(ts) > F.col("_before") + F.expr(f"INTERVAL {ttl}"))
    sessions = running(rows, {"session": ("sum", expired.cast("int"))}).result().drop("_before")
    ties = [F.col(c).asc() for c in order]
    return top_n(sessions, [client, "session"], [F.col(amount).desc(), *ties], n)
