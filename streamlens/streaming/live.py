"""Live jobs which need more than one output, or a batch operator, per micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.operators.joins import rules_asof_join
from streamlens.operators.late import classify_late
from streamlens.operators.ranking import top_n
from streamlens.schemas import RULE


def rank_batches(path: str, keys: Sequence[str], order: Sequence[Column], n: int):
    """Batch writer: the first ``n`` rows per key.

    In append mode a window is emitted whole in one micro-batch, so ranking it there is exact and
    its rows need not be held in one state entry.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        ranked = top_n(batch, keys, order, n)
        ranked.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def _folder(path: str, batch_id: int) -> str:
    return f"{path}/batch={batch_id}"


def route_late(path: str, ts: str, arrival: Sequence[str], size: str, delay: str, lateness: str):
    """Batch writer: rows with their late class, exact across micro-batches.

    The largest event time so far is one row per batch under ``clock``, carried on from the batch before,
    of which a batch reads that one row; a repeated batch reads it again and so gives the same result.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            route(batch, batch_id)
        finally:
            batch.unpersist()

    def route(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        clock = None
        if batch_id > 0:
            before = spark.read.schema("seen TIMESTAMP_NTZ").parquet(_folder(f"{path}/clock", batch_id - 1))
            clock = before.select(F.col("seen").cast("string")).first().seen
        rows = batch.withColumn("_old", F.lit(False))
        if clock is not None:
            # the past as one row which arrived before all others
            first = batch.agg(F.min(arrival[0]).cast("string").alias("at")).first().at
            past = spark.range(1).select(
                F.lit(clock).cast("timestamp_ntz").alias(ts),
                F.lit(first).cast("timestamp_ntz").alias(arrival[0]),
                F.lit(True).alias("_old"),
            )
            rows = rows.unionByName(past, allowMissingColumns=True)
        # _new keeps the past row first among rows of the same arrival time
        rows = rows.withColumn("_new", F.when(F.col("_old"), 0).otherwise(1))
        order = [arrival[0], "_new", *arrival[1:]]
        marked = classify_late(rows, ts, order, size, delay, lateness)
        out = marked.where(~F.col("_old")).drop("_old", "_new")
        out.write.mode("overwrite").parquet(_folder(f"{path}/rows", batch_id))
        seen = F.greatest(F.max(ts), F.lit(clock).cast("timestamp_ntz"))
        batch.agg(seen.alias("seen")).write.mode("overwrite").parquet(_folder(f"{path}/clock", batch_id))

    return write


def tag_with_rules(path: str, rules_path: str, tier: str, ts: str, order: Sequence[str]):
    """Batch writer: each event with the rule in force, from the rules stored at that moment."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rules = batch.sparkSession.read.schema(RULE).parquet(rules_path)
        tagged = rules_asof_join(batch, rules, tier, ts, "rule", order)
        tagged.write.mode("overwrite").parquet(_folder(path, batch_id))

    return write
