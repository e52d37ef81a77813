"""Running a stream: settings, replay to the end of stored data, and reading what was written."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from streamlens.session import ROCKSDB, pin, scratch
from streamlens.sources.sinks import batch_files, write_batches, write_exactly_once

FLUSH_TIME = "2200-01-01 00:00:00"
GROUP_BYTES = 4 << 20  # of a row group in a log, so that the one file of a slice is read by several tasks


@dataclass(frozen=True)
class StreamJobConfig:
    """Recovery settings of a streaming job.

    State and progress live in ``checkpoint``; a restart from it continues without loss or
    repetition. ``changelog`` uploads only changed state at each commit. ``retain`` is the number
    of past commits kept.
    """

    checkpoint: str
    every: str = "5 seconds"
    changelog: bool = True
    retain: int = 100
    settings: dict[str, str] = field(default_factory=dict)

    def apply(self, spark: SparkSession) -> StreamJobConfig:
        rocksdb = "spark.sql.streaming.stateStore.rocksdb."
        for name, value in {
            "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
            rocksdb + "changelogCheckpointing.enabled": str(self.changelog).lower(),
            "spark.sql.streaming.minBatchesToRetain": str(self.retain),
            **self.settings,
        }.items():
            spark.conf.set(name, value)
        return self

    def trigger(self) -> dict[str, str]:
        return {"processingTime": self.every}


def run_with_restarts(start, attempts: int = 3, delay: float = 1) -> StreamingQuery:
    """Start a query and wait for it; ``delay`` seconds after a failure start it again from its checkpoint."""
    for attempt in range(attempts + 1):
        query = start()
        try:
            query.awaitTermination()
            return query
        except Exception:
            if attempt == attempts:
                raise
            time.sleep(delay)


def event_time(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Stored UTC times without a zone become the instants that watermarks need."""
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def plain_time(df: DataFrame) -> DataFrame:
    """The reverse, for comparison with batch results."""
    return df.select(
        *[F.col(n).cast("timestamp_ntz").alias(n) if t == "timestamp" else F.col(n)
          for n, t in df.dtypes]
    )


def flush_row(spark: SparkSession, schema: T.StructType, ts: str, **values) -> DataFrame:
    """One row far in the future, null but for its time and the given values."""
    known = {ts: FLUSH_TIME, **values}
    return spark.range(1).select(
        *[F.lit(known.get(f.name)).cast(f.dataType).alias(f.name) for f in schema]
    )


class EndOfInput:
    """Closes all windows of a replay: stored input ends, a stream does not.

    ``after`` adds an empty folder to a stream as a second source. When the stored input has been
    read, ``send`` puts a row far in the future there. It moves the watermark past every window;
    its own window never closes, and keys and joins see nulls. Apply filters before ``after``;
    ``values`` fills columns which a later filter looks at.
    """

    def __init__(self):
        self.rows: list[tuple[DataFrame, str]] = []

    def after(self, stream: DataFrame, ts: str = "ts", **values) -> DataFrame:
        spark = stream.sparkSession
        path = scratch(spark, "flush")
        row = flush_row(spark, stream.schema, ts, **values)
        row.limit(0).write.parquet(path)
        self.rows.append((row, path))
        return stream.unionByName(spark.readStream.schema(stream.schema).parquet(path))

    def send(self) -> None:
        for row, path in self.rows:
            row.write.mode("append").parquet(path)


def run_to_end(start: Callable[[], StreamingQuery], end: EndOfInput | None = None) -> None:
    """Read all stored input in micro-batches; with ``end``, close the windows afterwards."""
    start().awaitTermination()
    if end:
        end.send()
        start().awaitTermination()


def in_slices(stored: DataFrame, ts: str, rows: int) -> str | None:
    """Lay a stored table out as a log for streams: one file per slice of time, written one after
    the other, of about ``rows`` rows each. Rows without a time come first. None if one slice would do.

    The stream reads files in the order of their writing. The table is put in time order once, so
    each slice reads only its own files of that copy.
    """
    count = -(-stored.count() // rows)
    if count < 2:
        return None
    order = pin(stored.repartitionByRange(count, ts).sortWithinPartitions(ts), "log-order")
    cuts = order.agg(
        F.percentile_approx(F.unix_micros(F.col(ts).cast("timestamp")), [k / count for k in range(1, count)], 10_000)
    ).first()[0] or []
    at = [F.timestamp_micros(F.lit(c)).cast(stored.schema[ts].dataType) for c in sorted(set(cuts))]
    log = scratch(stored.sparkSession, "log")
    for k in range(len(at) + 1):
        part = order.where(F.col(ts) > at[k - 1]) if k else order
        if k < len(at):
            inside = F.col(ts) <= at[k]
            part = part.where(inside if k else inside | F.col(ts).isNull())
        part.coalesce(1).write.mode("append").option("parquet.block.size", GROUP_BYTES).parquet(log)
    return log


def replay(stream: DataFrame, label: str, end: EndOfInput | None = None) -> DataFrame:
    """Run an append-mode stream over all stored input and return what it wrote."""
    spark = stream.sparkSession
    out = scratch(spark, label)
    run_to_end(lambda: write_exactly_once(stream, out, out + "-checkpoint"), end)
    return spark.read.schema(stream.schema).parquet(out)


def replay_slices(slices: Iterable[DataFrame], path: str, start: Callable[[], StreamingQuery]) -> None:
    """Let stored data arrive in slices: after each one the query is started again from its
    checkpoint and takes what is new as one micro-batch."""
    for part in slices:
        part.write.mode("append").parquet(path)
        start().awaitTermination()


def replay_changes(stream: DataFrame, label: str, keys: Sequence[str]) -> DataFrame:
    """Run an update-mode stream over all stored input and return the newest row per key.

    Each micro-batch writes only changed rows, so the cost follows the changes, not the table.
    """
    spark = stream.sparkSession
    out = scratch(spark, label)
    run_to_end(lambda: write_batches(stream, batch_files(out), out + "-checkpoint", mode="update"))
    return newest_changes(spark, out, stream, keys)


def newest_changes(spark: SparkSession, path: str, like: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The current table behind a folder of change batches."""
    schema = ", ".join(f"`{n}` {t}" for n, t in like.dtypes)
    changes = spark.read.schema(f"{schema}, batch BIGINT").option("basePath", path).parquet(path)
    rest = [c for c in like.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), "batch").alias("_newest")
    out = changes.groupBy(*keys).agg(newest, F.lit(1).alias("_one"))
    return out.where(F.col("_newest").isNotNull()).select(*keys, "_newest.*")
