"""Joins of two streams or tables, and the rule in force at the time of an event."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.operators.ordered import MAX_ROWS, cut, running
from streamlens.session import pin

RULES_PER_BUCKET = 50
BROADCAST_RULES = 100_000
UNITS = ("DAY", "HOUR", "MINUTE")


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str,
                columns: Sequence[Column]) -> DataFrame:
    """Inner join of rows with the same key in the same tumbling window. *Streams.*

    ``columns`` refer to the sides as ``l`` and ``r``. A key and window with very many rows on one
    side is split by Spark's skew join, as this is an ordinary equi-join.
    """
    lw = left.withColumn("_w", F.window(ts, size)).alias("l")
    rw = right.withColumn("_w", F.window(ts, size)).alias("r")
    same = (F.col(f"l.{key}") == F.col(f"r.{key}")) & (F.col("l._w") == F.col("r._w"))
    return lw.join(rw, same, "inner").select(*columns)


def inner_join(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    return left.join(right, left[left_key] == right[right_key], "inner")


def left_join(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Look up ``right``; Spark broadcasts it only when its size is below the session's limit."""
    return left.join(right, key, "left")


def connect_map(first: DataFrame, second: DataFrame, first_value: Column,
                second_value: Column, out: str = "value") -> DataFrame:
    """Two streams of different types mapped to one text column, tagged with their origin. *Streams.*"""
    a = first.select(F.lit(1).alias("source"), first_value.cast("string").alias(out))
    b = second.select(F.lit(2).alias("source"), second_value.cast("string").alias(out))
    return a.unionByName(b)


def connect_first(connected: DataFrame) -> DataFrame:
    """Only what came from the first stream. *Streams.*"""
    return connected.where(F.col("source") == 1)


def rules_asof_join(events: DataFrame, rules: DataFrame, tier: str, ts: str, rule: str,
                    order: Sequence[str], missing: str | None = "",
                    max_rows: int = MAX_ROWS, rules_per_bucket: int = RULES_PER_BUCKET) -> DataFrame:
    """Add the newest rule of the event's tier which was set at or before the event.

    Each tier and day that has events gets the rule it starts with and those set during it, so an event is
    compared with a handful of rules and needs no ordering. If some tier sets more than
    ``rules_per_bucket`` rules on a day, hours are taken instead, then minutes. If even a minute
    has more, events and rules are put in one time order per tier and the rule is carried forward.
    Of rules set at one time the largest text counts. A rule without tier or time never applies,
    and an event without tier or time has no rule. Times without events or rules cost nothing,
    however long they are.
    """
    known = F.col(rule).isNotNull() & F.col(tier).isNotNull() & F.col(ts).isNotNull()
    rules = rules.where(known).groupBy(tier, ts).agg(F.max(rule).alias(rule))
    rules = pin(rules, "rules")  # read several times
    bucket = F.explode(
        F.array(*[F.struct(F.lit(u).alias("unit"), F.date_trunc(u, ts).alias("at")) for u in UNITS])
    )
    found = (
        rules.select(F.col(tier).alias("tier"), bucket.alias("b"))
        .groupBy("tier", "b.unit", "b.at").agg(F.count("*").alias("n"))
        .groupBy("unit").agg(F.max("n").alias("busiest"))
        .collect()  # one row per unit
    )
    busiest = {r.unit: r.busiest for r in found}
    for unit in UNITS:
        if busiest.get(unit, 0) <= rules_per_bucket:
            return _by_bucket(events, rules, tier, ts, rule, missing, unit, max_rows)
    return _by_order(events, rules, tier, ts, rule, order, missing, max_rows)


def _by_bucket(events, rules, tier, ts, rule, missing, unit, max_rows):
    """Equi-join on tier and time bucket; which of the bucket's rules holds their spans decide.

    Only tiers and buckets that events have are asked for. One merge of their starts with the rules, in time order per
    tier, carries to each start the rule in force; large tiers are cut in chunks. So the table has a row per bucket of
    events and per rule set in one of them. It is broadcast if that is at most ``BROADCAST_RULES`` rows; otherwise
    Spark joins by shuffle and splits large tiers and buckets.
    """
    # rules and starts are compared as instants, whether events have a zone or not
    start = F.date_trunc(unit, ts).cast("timestamp")
    asked = events.where(F.col(tier).isNotNull() & F.col(ts).isNotNull())
    starts = pin(asked.select(F.col(tier).alias("_tier"), start.alias("_bucket")).distinct(), "rule-buckets")
    set_at = F.col(ts).cast("timestamp")
    text = rules.schema[rule].dataType
    marks = starts.select("_tier", F.col("_bucket").alias("_from"), F.lit(None).cast(text).alias("_rule"), F.lit(1).alias("_start"))
    both = marks.unionByName(
        rules.select(F.col(tier).alias("_tier"), set_at.alias("_from"), F.col(rule).alias("_rule"), F.lit(0).alias("_start"))
    )
    carried = running(cut(both, ["_tier"], ["_from", "_start"], max_rows), {rule: ("last", F.col("_rule"))}).result()
    first = carried.where("_start = 1").select("_tier", F.col("_from").alias("_bucket"), "_from", rule)
    inside = rules.select(
        F.col(tier).alias("_tier"), start.alias("_bucket"), set_at.alias("_from"), F.col(rule).alias(rule)
    ).where("_from > _bucket").join(starts, ["_tier", "_bucket"], "left_semi")
    ahead = Window.partitionBy("_tier", "_bucket").orderBy("_from")
    spans = pin(first.unionByName(inside).withColumn("_until", F.lead("_from").over(ahead)), "rule-spans").where(F.col(rule).isNotNull())
    if spans.count() <= BROADCAST_RULES:
        spans = F.broadcast(spans)
    at = F.col(ts).cast("timestamp")
    valid = (
        (F.col(tier) == F.col("_tier")) & (start == F.col("_bucket")) & (at >= F.col("_from"))
        & (F.col("_until").isNull() | (at < F.col("_until")))
    )
    out = events.join(spans, valid, "left").drop("_tier", "_bucket", "_from", "_until")
    return out if missing is None else out.withColumn(rule, F.coalesce(rule, F.lit(missing)))


def _by_order(events, rules, tier, ts, rule, order, missing, max_rows):
    extra = [c for c in events.columns if c not in (tier, ts)]
    marks = rules.select(
        tier, ts, *[F.lit(None).cast(events.schema[c].dataType).alias(c) for c in extra],
        F.col(rule).alias("_rule"), F.lit(0).alias("_kind"),
    )
    both = events.select(
        tier, ts, *extra, F.lit(None).cast("string").alias("_rule"), F.lit(1).alias("_kind")
    ).unionByName(marks)
    # a rule set at the very time of an event already applies to it
    sequence = [ts, "_kind", *[c for c in order if c != ts]]
    found = running(cut(both, [tier], sequence, max_rows), {rule: ("last", F.col("_rule"))})
    out = found.result().where(F.col("_kind") == 1).select(*events.columns, rule)
    return out if missing is None else out.withColumn(rule, F.coalesce(rule, F.lit(missing)))
