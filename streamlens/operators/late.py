"""Watermarks and late rows, replayed exactly over a stored log in its arrival order.

The watermark a row meets is the largest event time of all *earlier* arrivals, minus the allowed
disorder, minus one millisecond. A row is late when the last instant of its window is not after it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.operators.ordered import MAX_ROWS, cut, running, running_overall
from streamlens.session import pin

ON_TIME, LATE_REFIRE, SIDE_OUTPUT = "on_time", "late_refire", "side_output"



def with_event_time(df: DataFrame, ts: str, delay: str) -> DataFrame:
    """Declare the event time of a stream and how far out of order it may be. *Streams.*"""
    return df.withWatermark(ts, delay)


def with_ordered_time(df: DataFrame, ts: str) -> DataFrame:
    """Declare an event time which never goes back. *Streams.*"""
    return df.withWatermark(ts, "0 seconds")


def row_watermark(df: DataFrame, ts: str, arrival: Sequence[str], delay: str,
                  out: str = "watermark", after: bool = False,
                  max_rows: int = MAX_ROWS) -> DataFrame:
    """Add the watermark each row meets, or with ``after`` the one it leaves behind.

    ``arrival`` starts with the time of arrival. Null where no row came before.
    """
    newest = running_overall(
        df, arrival, {out: ("max", F.col(ts))}, strict=not after, max_rows=max_rows
    )
    return newest.withColumn(out, F.expr(f"{out} - INTERVAL {delay} - INTERVAL 1 MILLISECOND"))


def classify_late(df: DataFrame, ts: str, arrival: Sequence[str], size: str, delay: str,
                  lateness: str, out: str = "late_class", max_rows: int = MAX_ROWS) -> DataFrame:
    """Add the window of each row and its class: on time, late but accepted, or too late."""
    marked = row_watermark(df, ts, arrival, delay, "_wm", max_rows=max_rows)
    window = F.window(ts, size)
    last = F.expr("window_end - INTERVAL 1 MILLISECOND")
    closing = F.expr(f"window_end - INTERVAL 1 MILLISECOND + INTERVAL {lateness}")
    return (
        marked.withColumn("_w", window)
        .withColumns({"window_start": F.col("_w.start"), "window_end": F.col("_w.end")})
        .withColumn(
            out,
            F.when(F.col("_wm").isNull() | (last > F.col("_wm")), ON_TIME)
            .when(closing > F.col("_wm"), LATE_REFIRE)
            .otherwise(SIDE_OUTPUT),
        )
        .drop("_w", "_wm")
    )


def late_side_output(classified: DataFrame, out: str = "late_class") -> tuple[DataFrame, DataFrame]:
    """Main output and side output of classified rows."""
    late = F.col(out) == SIDE_OUTPUT
    return classified.where(~late), classified.where(late)


def late_refire(classified: DataFrame, keys: Sequence[str], arrival: Sequence[str],
                out: str = "n", max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per firing of a window: the first firing, then one for each late row accepted.

    Within a window all on-time rows arrive before the late ones, since the watermark only rises.
    """
    group = ["window_start", "window_end", *keys]
    accepted = classified.where(F.col("late_class") != SIDE_OUTPUT)
    # read three times below; the classification is not repeated
    accepted = pin(accepted.select(*group, *[c for c in arrival if c not in group], "late_class"), "late")
    counted = running(cut(accepted, group, arrival, max_rows), {out: ("count", F.lit(1))}).result()
    first = (
        accepted.where(F.col("late_class") == ON_TIME)
        .groupBy(*group)
        .agg(F.count("*").alias(out))
        .withColumn("firing", F.lit(ON_TIME))
    )
    again = counted.where(F.col("late_class") == LATE_REFIRE).select(
        *group, out, F.lit(LATE_REFIRE).alias("firing")
    )
    return first.unionByName(again)
