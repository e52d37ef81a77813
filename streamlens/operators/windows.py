"""Time windows, count windows and the traffic metrics built on them.

Windows are aligned to the epoch and half-open. The functions marked *streams* run unchanged on a
streaming DataFrame with a watermark.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.scalar import to_epoch_millis
from streamlens.operators.ordered import MAX_ROWS, cut, nearby, running
from streamlens.operators.ranking import top_n
from streamlens.session import pin


def windowed(df: DataFrame, ts: str, size: str, aggs: dict[str, Column],
             keys: Sequence[str] = (), slide: str | None = None) -> DataFrame:
    """Aggregates per window and key, then the window bounds as columns. *Streams.*"""
    window = F.window(ts, size, slide or size).alias("window")
    return (
        df.groupBy(window, *keys)
        .agg(*[a.alias(n) for n, a in aggs.items()])
        .select(F.col("window.start").alias("window_start"),
                F.col("window.end").alias("window_end"), *keys, *aggs)
    )


def windowed_count(df: DataFrame, ts: str, size: str, keys: Sequence[str] = (),
                   slide: str | None = None, out: str = "n") -> DataFrame:
    """Rows per window and key. *Streams.*"""
    return windowed(df, ts, size, {out: F.count("*")}, keys, slide)


def processing_time(df: DataFrame, out: str = "ts") -> DataFrame:
    """Add the time at which a row is processed, for windows over the wall clock. *Streams.*"""
    return df.withColumn(out, F.current_timestamp())


def sliding_count(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (),
                  out: str = "n") -> DataFrame:
    """Rows per sliding window and key, by way of panes.

    A sliding window copies each row into size / slide windows. Here rows are first counted per
    pane of length ``slide``; only the pane counts are copied and added up. ``size`` must be a
    multiple of ``slide``. For streams, use ``sliding_count_chained``.
    """
    pane = F.window(ts, slide)["start"].alias("_pane")
    panes = df.groupBy(pane, *keys).agg(F.count("*").alias("_n"))
    earliest = F.expr(f"_pane - INTERVAL {size} + INTERVAL {slide}")
    starts = F.sequence(earliest, F.col("_pane"), F.expr(f"INTERVAL {slide}"))
    copies = panes.select(F.explode(starts).alias("window_start"), *keys, "_n")
    counted = copies.groupBy("window_start", *keys).agg(F.sum("_n").alias(out))
    end = F.expr(f"window_start + INTERVAL {size}")
    return counted.select("window_start", end.alias("window_end"), *keys, out)


def sliding_count_chained(df: DataFrame, ts: str, size: str, slide: str, keys: Sequence[str] = (),
                          out: str = "n") -> DataFrame:
    """``sliding_count`` for streams: two aggregations in a row, the second over pane counts.

    *Streams*, in append mode. State grows with panes and windows; rows are not copied.
    """
    panes = df.groupBy(F.window(ts, slide).alias("_pane"), *keys).agg(F.count("*").alias("_n"))
    counted = panes.select(F.window_time("_pane").alias("_at"), *keys, "_n")
    return windowed(counted, "_at", size, {out: F.sum("_n")}, keys, slide)


def first_and_count(df: DataFrame, ts: str, size: str, key: str, columns: Sequence[str],
                    order: Sequence[str], out: str = "n") -> DataFrame:
    """Per window and key the first row and the number of rows. *Streams.*"""
    first = F.min_by(F.struct(*columns), F.struct(*order))
    found = windowed(df, ts, size, {"_first": first, out: F.count("*")}, [key])
    return found.select("window_start", "window_end", key, "_first.*", out)


def first_per_window(df: DataFrame, ts: str, size: str, key: str, columns: Sequence[str],
                     order: Sequence[str]) -> DataFrame:
    """Per window and key the first row. *Streams.*"""
    return first_and_count(df, ts, size, key, columns, order, "_n").drop("_n")


def count_window(df: DataFrame, key: str, order: Sequence[str], size: int,
                 aggs: dict[str, Column], max_rows: int = MAX_ROWS) -> DataFrame:
    """One row per ``size`` consecutive rows of a key; an incomplete tail gives none."""
    placed = running(cut(df, [key], order, max_rows), {"_pos": ("count", F.lit(1))}).result()
    number = F.floor((F.col("_pos") - 1) / size).alias("window_no")
    return (
        placed.groupBy(key, number)
        .agg(*[a.alias(n) for n, a in aggs.items()], F.count("*").alias("_rows"))
        .where(F.col("_rows") == size)
        .drop("_rows")
    )


def sliding_count_window(df: DataFrame, key: str, order: Sequence[str], size: int, slide: int,
                         value: str, out: str = "total", max_rows: int = MAX_ROWS) -> DataFrame:
    """After every ``slide`` rows of a key, the sum over its last ``size`` rows."""
    rows = cut(df, [key], order, max_rows)
    if slide > 1:
        rows = running(rows, {"_pos": ("count", F.lit(1))})
    summed = nearby(
        rows, {out: lambda w: F.sum(value).over(w.rowsBetween(1 - size, 0))}, before=size - 1
    ).result()
    return summed if slide == 1 else summed.where(F.col("_pos") % slide == 0).drop("_pos")


def windowed_pv(df: DataFrame, ts: str, size: str = "1 hour") -> DataFrame:
    """Page views per window. *Streams.*"""
    return windowed_count(df, ts, size, out="pv")


def cumulative_pv(df: DataFrame, ts: str, size: str = "1 hour") -> DataFrame:
    """Page views up to the end of each window.

    The running sum is over one row per window; many windows are cut into chunks.
    """
    counts = pin(windowed_pv(df, ts, size), "window-counts")
    o = cut(counts.withColumnRenamed("pv", "_pv"), [], ["window_start"])
    return running(o, {"pv": ("sum", F.col("_pv"))}).result().select(*counts.columns)


def windowed_uv(df: DataFrame, ts: str, user: str, size: str = "1 hour") -> DataFrame:
    """Distinct users per window, exact."""
    return windowed(df, ts, size, {"uv": F.count_distinct(user)})


def windowed_uv_approx(df: DataFrame, ts: str, user: str, size: str = "1 hour",
                       error: float = 0.02) -> DataFrame:
    """Distinct users per window from a HyperLogLog sketch; fixed memory per window. *Streams.*"""
    return windowed(df, ts, size, {"uv": F.approx_count_distinct(user, error)})


def windowed_uv_sketch(df: DataFrame, ts: str, user: str, size: str = "1 hour") -> DataFrame:
    """Mergeable sketch of the users per window; estimate with ``hll_sketch_estimate``."""
    return windowed(df, ts, size, {"sketch": F.hll_sketch_agg(user)})


def hot_items(df: DataFrame, ts: str, item: str, n: int = 3, size: str = "1 hour",
              slide: str = "5 minutes") -> DataFrame:
    """The ``n`` most frequent items per sliding window; equal counts in item order."""
    counts = sliding_count(df, ts, size, slide, [item], "views")
    return top_n(counts, ["window_start", "window_end"],
                 [F.col("views").desc(), F.col(item).asc()], n)


def hot_pages(df: DataFrame, ts: str, url: str, n: int = 3, size: str = "10 minutes",
              slide: str = "5 seconds") -> DataFrame:
    """Top pages: by default of the last ten minutes, every five seconds."""
    return hot_items(df, ts, url, n, size, slide)


def hot_categories(df: DataFrame, ts: str, category: str, n: int = 3, size: str = "1 hour",
                   slide: str = "5 minutes") -> DataFrame:
    """Top categories: by default of the last hour, every five minutes."""
    return hot_items(df, ts, category, n, size, slide)


def category_heat(df: DataFrame, ts: str, category: str, size: str = "1 hour",
                  slide: str = "5 minutes") -> DataFrame:
    """Count per category and sliding window, labelled with the window end."""
    return sliding_count(df, ts, size, slide, [category], "heat").select(
        category, "heat", F.col("window_end").alias("windowend")
    )


# The parts of the report text.
REPORT_END, REPORT_ITEM, REPORT_VIEWS = "窗口结束时间: ", "网址：", "     热度值："
REPORT_LINE = "---------------------------------"


def hot_report(ranked: DataFrame, item: str) -> DataFrame:
    """One text block per window from ranked rows (at most n of them per window)."""
    line = F.concat(F.lit(REPORT_ITEM), F.col(item).cast("string"), F.lit(REPORT_VIEWS),
                    F.col("views").cast("string"))
    lines = F.array_sort(F.collect_list(F.struct(F.col("rank"), line.alias("line"))))
    end = to_epoch_millis(F.col("window_end")).cast("string")
    body = F.array_join(F.transform(lines, lambda x: x["line"]), "\n")
    report = F.concat(F.lit(REPORT_END), end, F.lit(f"\n{REPORT_LINE}\n"), body,
                      F.lit(f"\n{REPORT_LINE}\n"))
    return ranked.groupBy("window_end").agg(report.alias("report"))
