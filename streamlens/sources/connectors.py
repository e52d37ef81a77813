"""Kafka and JDBC. The options are built by plain functions, so they can be checked without a server."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def kafka_options(
    servers: str,
    topic: str,
    start: str | int = "latest",
    *,
    group: str | None = None,
    committed: bool = False,
    min_bytes: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of the Kafka source.

    ``start`` is ``latest``, ``earliest``, a JSON text with offsets per partition, or epoch
    milliseconds. ``committed`` reads only what transactional producers have committed. Positions
    are kept in the checkpoint, so nothing is committed back to the broker.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "failOnDataLoss": "true"}
    if isinstance(start, int):
        options["startingTimestamp"] = str(start)
    else:
        options["startingOffsets"] = start
    if group:
        options["kafka.group.id"] = group
    if committed:
        options["kafka.isolation.level"] = "read_committed"
    if min_bytes:
        options["kafka.fetch.min.bytes"] = str(min_bytes)
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_kafka(spark: SparkSession, servers: str, topic: str, start: str | int = "latest",
               **more) -> DataFrame:
    """Record values of a topic as text, column ``value``, with the broker's ``timestamp``."""
    options = kafka_options(servers, topic, start, **more)
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select(F.col("value").cast("string").alias("value"), "timestamp")


def kafka_records(df: DataFrame, ts: str | None = None, key: str | None = None,
                  dedup: Sequence[str] = ()) -> DataFrame:
    """Rows in the shape the Kafka sink takes: JSON ``value``, optional ``key`` and ``timestamp``.

    The sink may write a record twice after a failure. ``dedup`` names columns that tell rows apart;
    their digest is added to the value as ``dedup_id``, and ``once`` drops the repeats on reading.
    """
    mark = [F.sha2(F.to_json(F.struct(*dedup), {"ignoreNullFields": "false"}), 256).alias("dedup_id")] if dedup else []
    columns = [F.to_json(F.struct(*df.columns, *mark)).alias("value")]
    if key:
        columns.append(F.col(key).cast("string").alias("key"))
    if ts:
        columns.append(F.col(ts).cast("timestamp").alias("timestamp"))
    return df.select(*columns)


def once(records: DataFrame, delay: str = "1 hour") -> DataFrame:
    """Records of a topic written with ``dedup``, each once; ``dedup_id`` is kept.

    On a stream a repeat is known for ``delay`` of the broker's time, which bounds the state; it has
    to exceed the time a failed job takes to come back. A record without an id is never a repeat.
    """
    read = records.withColumn("dedup_id", F.get_json_object("value", "$.dedup_id"))
    marked = read.where("dedup_id IS NOT NULL")
    if records.isStreaming:
        marked = marked.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["dedup_id"])
        return marked.unionByName(read.where("dedup_id IS NULL").withWatermark("timestamp", delay))
    return marked.dropDuplicates(["dedup_id"]).unionByName(read.where("dedup_id IS NULL"))


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    """Durable writes: all replicas confirm, retries do not reorder or repeat within a session."""
    return {
        "kafka.bootstrap.servers": servers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
        "kafka.retries": "3",
    }


def write_kafka(df: DataFrame, servers: str, topic: str, checkpoint: str, **shape):
    """Start writing a stream to a topic."""
    return (
        kafka_records(df, **shape)
        .writeStream.format("kafka")
        .options(**kafka_sink_options(servers, topic))
        .option("checkpointLocation", checkpoint)
        .start()
    )


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 1,
    fetch_size: int = 10_000,
    **properties: str,
) -> dict[str, str]:
    """Options of a JDBC read, split into ranges of ``partition_column`` so that tasks share it."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size), **properties}
    if partition_column:
        if bounds is None:
            raise ValueError("partition_column needs bounds")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, url: str, table: str, **more) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **more)).load()


def account_line(df: DataFrame) -> DataFrame:
    """Account rows as one text column, fields separated by a comma."""
    return df.select(F.concat_ws(",", "fund_account", "open_date", "xz", "zt").alias("value"))


def write_jdbc(df: DataFrame, url: str, table: str, batch_size: int = 10_000, **properties: str):
    """Append a batch to a table in batched inserts."""
    (
        df.write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=str(batch_size), **properties)
        .mode("append")
        .save()
    )


def forget_batch(table: str, batch_id: int, column: str = "batch_id") -> str:
    """The statement that removes what an earlier attempt at a batch wrote."""
    return f"DELETE FROM {table} WHERE {column} = {int(batch_id)}"


def jdbc_batches(url: str, table: str, execute: Callable[[str], None], column: str = "batch_id",
                 **more) -> Callable[[DataFrame, int], None]:
    """Writer for ``sinks.write_batches`` into a table which has ``column`` for the batch id.

    ``execute`` runs and commits one statement on the database. A batch first removes the rows of its
    id, so one that comes again after a failure replaces what it wrote.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        execute(forget_batch(table, batch_id, column))
        write_jdbc(batch.withColumn(column, F.lit(batch_id).cast("long")), url, table, **more)

    return write


def lookup_dimension(df: DataFrame, dim: DataFrame, key: str, dim_key: str, values: list[str],
                     out: str = "label", separator: str = " -love- ") -> DataFrame:
    """Add the joined ``values`` of a dimension row, null parts left out.

    Spark sees the size of ``dim`` and broadcasts it only below its own threshold.
    """
    text = F.concat_ws(separator, *[F.col(v).cast("string") for v in values])
    found = dim.select(F.col(dim_key).alias(key), text.alias(out))
    return df.join(found, key, "left")
