"""Totals per key, running totals, and first or latest rows per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from streamlens.functions.scalar import byte_length, human_bytes
from streamlens.operators.ordered import MAX_ROWS, cut, running, running_overall


def reduce_by_key(df: DataFrame, keys: Sequence[str], value: str, out: str = "total") -> DataFrame:
    """Pairwise reduction by addition."""
    return df.groupBy(*keys).agg(F.sum(value).alias(out))


def aggregate_by(df: DataFrame, keys: Sequence[str | Column], aggs: dict[str, Column]) -> DataFrame:
    """Any accumulator made of built-in aggregates; Spark combines partial results per task."""
    return df.groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def words(df: DataFrame, text: str, pattern: str = r"\W+", out: str = "word") -> DataFrame:
    """One row per non-empty part of the text."""
    parts = df.select(F.explode(F.split(text, pattern)).alias(out))
    return parts.where(F.col(out) != "")


def running_sum_by_key(df: DataFrame, key: str, value: str, order: Sequence[str],
                       out: str = "running", max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with the sum of its key up to and including it."""
    return running(cut(df, [key], order, max_rows), {out: ("sum", F.col(value))}).result()


def running_pv(df: DataFrame, order: Sequence[str], out: str = "pv",
               max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with the number of rows so far."""
    return running_overall(df, order, {out: ("count", F.lit(1))}, max_rows=max_rows)


def first_seen(df: DataFrame, key: str, order: Sequence[str], out: str = "is_first") -> DataFrame:
    """Mark the first row of each key.

    The first position per key is found by a partial aggregation and joined back on the full
    position, so no task receives all rows of a key. Of rows delivered twice, one is marked.
    """
    first = df.groupBy(key).agg(F.min(F.struct(*order)).alias("_first")).select(
        key, *[F.col("_first." + c).alias(c) for c in order], F.lit(1).alias(out)
    )
    # equal positions are repeats of one row; the join has already put them together
    repeat = F.row_number().over(Window.partitionBy(key, *order).orderBy(F.lit(0)))
    marked = df.join(first, [key, *order], "left")
    return marked.withColumn(out, F.when(repeat == 1, F.coalesce(out, F.lit(0))).otherwise(0))


def running_uv(df: DataFrame, user: str, order: Sequence[str], out: str = "uv",
               max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with the number of distinct users so far."""
    marked = first_seen(df, user, order, "_new")
    counted = running_overall(
        marked, order, {out: ("sum", F.col("_new"))}, max_rows=max_rows, sized_by=df
    )
    return counted.drop("_new")


def running_volume(df: DataFrame, text: str, order: Sequence[str],
                   max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with the records and bytes so far, the bytes also as readable text."""
    values = {"records": ("count", F.lit(1)), "bytes": ("sum", byte_length(F.col(text)))}
    out = running_overall(df, order, values, max_rows=max_rows)
    return out.withColumn("volume", human_bytes(F.col("bytes")))


# The texts published with the totals.
COUNT_TEXT, SIZE_TEXT = "当前数据条数：", "当前收集的数据量:"


def volume_messages(volume: DataFrame) -> DataFrame:
    """Add the two texts to publish: records so far, and readable bytes so far."""
    return volume.withColumns({
        "count_message": F.concat(F.lit(COUNT_TEXT), F.col("records").cast("string")),
        "size_message": F.concat(F.lit(SIZE_TEXT), F.col("volume")),
    })


def record_count(df: DataFrame, out: str = "records") -> DataFrame:
    """Number of rows; on a stream, the checkpoint brings the count back after a restart."""
    return df.groupBy().agg(F.count("*").alias(out))


def keep_first_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The earliest row per key."""
    rest = [c for c in df.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)).alias("_first")
    return df.groupBy(*keys).agg(first).select(*keys, "_first.*")


def daily_client_totals(df: DataFrame, client: str, amount: str, transfer: str, ts: str) -> DataFrame:
    """Per client and day: both sums and the time of the last row."""
    day = F.window(ts, "1 day").alias("day")
    return (
        df.groupBy(client, day)
        .agg(F.sum(amount).alias("amount"), F.sum(transfer).alias("transfer"),
             F.max(ts).alias("last_ts"))
        .select(client, F.col("day.start").alias("day"), "amount", "transfer", "last_ts")
    )


def distinct_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys).distinct()


def max_over_groups(df: DataFrame, column: str, out: str) -> DataFrame:
    """Largest value among the distinct values of ``column``; the distinct step is not needed."""
    return df.agg(F.max(column).alias(out))


def rolling_extrema(df: DataFrame, key: str, value: str, order: Sequence[str],
                    max_rows: int = MAX_ROWS) -> DataFrame:
    """Each row with sum, smallest and largest value of its key so far."""
    x = F.col(value)
    values = {"run_sum": ("sum", x), "run_min": ("min", x), "run_max": ("max", x)}
    return running(cut(df, [key], order, max_rows), values).result()


def extreme_rows(df: DataFrame, key: str, value: str, columns: Sequence[str],
                 tie: Sequence[str]) -> DataFrame:
    """Per key the rows holding the smallest and the largest value; the earliest of equal ones."""
    row = F.struct(*columns)
    backwards = [-F.col(c).cast("bigint") for c in tie]
    return df.groupBy(key).agg(
        F.min_by(row, F.struct(value, *tie)).alias("min_row"),
        F.max_by(row, F.struct(F.col(value), *backwards)).alias("max_row"),
    )
