"""Ranking per key. Spark keeps only n rows per key and task before the shuffle (WindowGroupLimit)."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.chains import Moves, Steps, ends_of, first_outside
from streamlens.operators.ordered import MAX_ROWS, Machine, cut, fold, nearby, wide


def top_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
          out: str = "rank") -> DataFrame:
    """The first ``n`` rows per key; ``order`` should end in a unique column."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w)).where(F.col(out) <= n)


def latest_version(df: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """The newest row per key."""
    return top_n(df, [key], order, 1, "_rank").drop("_rank")


def top_transactions(df: DataFrame, client: str, amount: str, tie: Sequence[str],
                     n: int = 3) -> DataFrame:
    """The ``n`` largest amounts per client."""
    return top_n(df, [client], [F.col(amount).desc(), *[F.col(c).asc() for c in tie]], n)


def running_top(df: DataFrame, key: str, amount: str, row_id: str, order: Sequence[str], n: int = 3,
                out: str = "top", max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with the ``n`` largest amounts of its key up to and including it, ascending.

    Whole numbers stay whole. Rows without an amount or an id are left out.
    """
    names = [f"_top{i}" for i in range(n)]
    kind, id_kind = wide(df, amount, T.DoubleType()), wide(df, row_id, T.StringType())
    number = np.int64 if kind == T.LongType() else np.float64
    empty = -(2**63) if kind == T.LongType() else float("-inf")

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        x = columns["_x"]
        top = [state[c] for c in names]
        # the list changes only at a row above its smallest entry; such rows get rare quickly
        starts, lists, at = [0], [top], 0
        while at < len(x):
            above = x[at:at + 1024] > top[0]
            if not above.any():
                at += len(above)
                continue
            at += int(above.argmax())
            top = sorted([*top[1:], x[at].item()])
            starts.append(at)
            lists.append(top)
            at += 1
        spans = np.diff([*starts, len(x)])
        filled = np.repeat(np.array(lists, number), spans, axis=0)
        seen = np.minimum(n, state["_seen"] + 1 + np.arange(len(x)))
        emitted = {"_id": columns["_row"], **{c: filled[:, i] for i, c in enumerate(names)}, "_seen": seen}
        return emitted, {**dict(zip(names, top)), "_seen": min(n, state["_seen"] + len(x))}

    def finish(state: dict) -> dict[str, np.ndarray]:
        return {c: np.array([]) for c in ["_id", *names, "_seen"]}

    def carry(given: dict, end: dict, facts: dict) -> dict:
        # a chunk adds its own largest amounts, whatever it started from
        top = sorted([s[c] for s in (given, end) for c in names])[-n:]
        return {**dict(zip(names, top)), "_seen": min(n, given["_seen"] + end["_seen"])}

    tops = [*[T.StructField(c, kind) for c in names], T.StructField("_seen", T.LongType())]
    machine = Machine(
        ("_row", "_x"), T.StructType([T.StructField("_id", id_kind), *tops]), T.StructType(tops),
        {**{c: empty for c in names}, "_seen": 0}, step, finish, carry=carry,
    )
    rows = df.dropna(subset=[amount, row_id]).select(
        key, *order, F.col(row_id).cast(id_kind).alias("_row"), F.col(amount).cast(kind).alias("_x")
    )
    found = fold(cut(rows, [key], order, max_rows), machine)
    kept = F.slice(F.array(*names), (n - F.col("_seen") + 1).cast("int"), F.col("_seen").cast("int"))
    return found.select(key, F.col("_id").alias(row_id), kept.alias(out))


def top_products(df: DataFrame, client: str, product: str, amount: str, n: int = 3) -> DataFrame:
    """Per client the ``n`` products with the largest single amount, each product once."""
    best = df.groupBy(client, product).agg(F.max(amount).alias(amount))
    return top_n(best, [client], [F.col(amount).desc(), F.col(product).asc()], n)


def top_product_sums(df: DataFrame, client: str, product: str, amount: str, n: int = 3) -> DataFrame:
    """Per client the sum and the whole-number average over its top products."""
    return (
        top_products(df, client, product, amount, n)
        .groupBy(client)
        .agg(F.sum(amount).alias("total"),
             F.expr(f"sum({amount}) div count(*)").alias("average"))
    )


def top_product_names(df: DataFrame, client: str, product: str, amount: str, n: int = 3) -> DataFrame:
    """Per client the names of its top products, the largest amount last."""
    ranked = top_products(df, client, product, amount, n)
    pairs = F.sort_array(F.collect_list(F.struct((-F.col("rank")).alias("r"), F.col(product))))
    return ranked.groupBy(client).agg(
        F.transform(pairs, lambda p: p[product].cast("string")).alias("products")
    )


def has_rows(df: DataFrame) -> bool:
    """Whether there is any row; stops at the first one."""
    return not df.isEmpty()


def adjacent_jump(df: DataFrame, key: str, value: str, order: Sequence[str],
                  threshold: float = 100_000, max_rows: int = MAX_ROWS) -> DataFrame:
    """Rows whose value differs by more than ``threshold`` from the row just before of that key."""
    o = nearby(cut(df, [key], order, max_rows), {"previous": lambda w: F.lag(value).over(w)}, before=1)
    return o.result().where(F.abs(F.col(value) - F.col("previous")) > threshold)


def baseline_machine(kind: T.DataType, id_kind: T.DataType, threshold: float) -> Machine:
    """Rows ``_row``, ``_x`` to alerts ``_id``, ``baseline``, ``_hit``: values far from the last alerted one, at first 0.

    An alert at a row leads to the next row whose value is far from its own, so the alerts from any start are
    a way along successors; ``moves`` follows them through a whole chunk.
    """
    whole = kind == T.LongType()
    number = np.int64 if whole else np.float64
    limit = math.floor(min(threshold, 2**64)) if whole else threshold
    most, least = 2**63 - 1, -(2**63)
    out = T.StructType([T.StructField("_id", id_kind), T.StructField("baseline", kind), T.StructField("_hit", kind)])

    def jumps(x: np.ndarray, base: float) -> np.ndarray:
        if not whole:
            return np.abs(x - base) > limit
        return (x > min(base + limit, most)) | (x < max(base - limit, least))

    def step(columns: dict[str, np.ndarray], state: dict) -> tuple[dict[str, np.ndarray], dict]:
        x, base = columns["_x"], state["base"]
        at, hits, bases = 0, [], []
        while at < len(x):
            # search in growing blocks, so that a long quiet stretch is scanned once
            size = 16
            while at < len(x):
                far = jumps(x[at:at + size], base)
                if far.any():
                    at += int(far.argmax())
                    hits.append(at)
                    bases.append(base)
                    base, at = x[at].item(), at + 1
                    break
                at, size = at + size, size * 2
        found = np.array(hits, int)
        return {"_id": columns["_row"][found], "baseline": np.array(bases, number), "_hit": x[found]}, {
            "base": base}

    def finish(state: dict) -> dict[str, np.ndarray]:
        return {c: np.array([]) for c in ["_id", "baseline", "_hit"]}

    def plus(x: np.ndarray, by) -> np.ndarray:
        if not whole:
            return x + by
        by = int(max(min(by, most), least))
        return np.where(x > most - by, most, x + np.int64(min(by, most))) if by >= 0 else np.where(x < least - by, least, x + np.int64(by))

    def function(columns: dict[str, np.ndarray], before: dict) -> Steps:
        x = columns["_x"]
        count = len(x)
        place = np.arange(count)
        after = first_outside(x, plus(x, -limit), plus(x, limit))
        last = ends_of(np.where(after < count, after, place))
        # only values that are higher, or lower, than all before them can be the first to alert
        highs = np.flatnonzero(x > np.concatenate((x[:1] - 1, np.maximum.accumulate(x)[:-1])))
        lows = np.flatnonzero(x < np.concatenate((x[:1] + 1, np.minimum.accumulate(x)[:-1])))
        highs, lows = np.union1d(highs, [0]), np.union1d(lows, [0])
        above = plus(x[highs], -limit)  # a baseline below it alerts at this row or before
        below = plus(plus(x[lows], limit), 1) if whole else np.nextafter(x[lows] + limit, np.inf)  # from it on
        cuts = np.union1d(above, below)
        left = np.concatenate((cuts[:1] - 1, cuts))  # a state of each piece
        h, low = np.searchsorted(above, left, "right"), np.searchsorted(-below, -left, "left")
        first = np.minimum(np.append(highs, count)[h], np.append(lows, count)[low])
        keep = first == count
        outs = x[last[np.where(keep, 0, first)]]
        return Steps(cuts, outs, keep, np.zeros(len(outs), bool), None).merged()

    return Machine(
        ("_row", "_x"), out, T.StructType([T.StructField("base", kind)]), {"base": number(0).item()}, step, finish,
        moves=Moves("base", function),
    )


def baseline_jump(df: DataFrame, key: str, value: str, row_id: str, order: Sequence[str],
                  threshold: float = 100_000, max_rows: int = MAX_ROWS) -> DataFrame:
    """Rows whose value differs by more than ``threshold`` from the last alerted value.

    Only an alert moves the baseline, which starts at 0. Whole numbers stay whole. Rows without a
    value or an id are left out.
    """
    kind, id_kind = wide(df, value, T.DoubleType()), wide(df, row_id, T.StringType())
    machine = baseline_machine(kind, id_kind, threshold)
    rows = df.dropna(subset=[value, row_id]).select(
        key, *order, F.col(row_id).cast(id_kind).alias("_row"), F.col(value).cast(kind).alias("_x")
    )
    hits = fold(cut(rows, [key], order, max_rows), machine)
    return hits.select(key, F.col("_id").alias(row_id), "baseline", F.col("_hit").alias(value))
