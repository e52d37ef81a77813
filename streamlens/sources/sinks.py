"""Where results go: tables, files, search payloads, and stream sinks with exactly-once files."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def latest_value_table(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key: each later write replaces the earlier one."""
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*order)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(*keys, "_newest.*")


def distinct_set_table(df: DataFrame, key: str, member: str) -> DataFrame:
    """Members per set name, each once."""
    return df.select(key, member).distinct()


def search_payload(df: DataFrame, out: str = "payload") -> DataFrame:
    """One ``{"data": row}`` document per row."""
    return df.select(F.to_json(F.struct(F.struct(*df.columns).alias("data"))).alias(out))


def write_search_index(df: DataFrame, path: str, index: str, batch_id: int | None = None) -> None:
    """Bulk files for a search index: an action line followed by its document, as NDJSON.

    With a ``batch_id`` the documents lie in a folder of that batch, which a repeated batch replaces; without
    one each call adds documents.
    """
    action = F.to_json(F.struct(F.struct(F.lit(index).alias("_index")).alias("index")))
    lines = search_payload(df).select(F.concat_ws("\n", action, "payload").alias("value"))
    if batch_id is None:
        lines.write.mode("append").text(path)
    else:
        lines.write.mode("overwrite").text(f"{path}/batch={batch_id}")


def overwrite_table(df: DataFrame, table: str) -> None:
    """Replace the content of a table with ``df``, which may read the table itself.

    The rows are written first, in the table's own format, cast to its types; a failed write leaves
    the table as it was, and a reader never sees an emptied or half-written table. A table without
    partitions is then pointed to the new folder, which lies beside the old one; the old folder
    stays for readers that still use it. A partitioned table is replaced by a new one of the same
    definition under its name, with a folder beside the old one, which dropping the table leaves; if that name
    cannot be given, the old table gets it back. A table that does not exist is created.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        df.write.saveAsTable(table, format="parquet")
        return
    rows = df.select(*[F.col(f.name).cast(f.dataType) for f in spark.table(table).schema.fields])
    told = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE FORMATTED {table}").collect()}
    mark = uuid.uuid4().hex
    path = re.sub("-[0-9a-f]{32}$", "", told["Location"].rstrip("/")) + f"-{mark}"  # beside the first folder
    if "# Partition Information" not in told:
        rows.write.format(told["Provider"]).save(path)
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
        spark.catalog.refreshTable(table)
        return
    staged, old = f"{table}_new_{mark}", f"{table}_old_{mark}"
    # a folder of its own stays where it is when the table is renamed, and so do the folders of partitions
    spark.sql(f"CREATE TABLE {staged} LIKE {table} LOCATION '{path}'")
    try:
        rows.write.insertInto(staged)
    except BaseException:
        spark.sql(f"DROP TABLE {staged}")
        raise
    spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    try:
        spark.sql(f"ALTER TABLE {staged} RENAME TO {table}")
    except BaseException:
        spark.sql(f"ALTER TABLE {old} RENAME TO {table}")
        spark.sql(f"DROP TABLE {staged}")
        raise
    spark.sql(f"DROP TABLE {old}")


def write_exactly_once(df: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Stream to parquet files. The file log and the checkpoint together make each row appear once."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def write_source(df: DataFrame, fmt: str, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Stream into a registered data source, whose own commits make each row appear once."""
    return (
        df.writeStream.format(fmt)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or {"availableNow": True}))
        .start(path)
    )


def write_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
                  mode: str = "append", **trigger) -> StreamingQuery:
    """Stream through ``write(batch, batch_id)``.

    After a failure a batch comes again under the same id, so ``write`` must replace what it wrote
    for that id; ``batch_files`` does.
    """
    return (
        df.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode(mode)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def batch_files(path: str) -> Callable[[DataFrame, int], None]:
    """Writer for ``write_batches``: one folder per batch id, replaced when the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def route_writers(writers: dict[str, Callable[[DataFrame, int], None]],
                  route: str = "route") -> Callable[[DataFrame, int], None]:
    """Writer for ``write_batches``: each route of ``transform.split_route`` to its own writer.

    The batch is stored once and read by all writers. A row whose route has no writer fails the
    batch before anything is written, so that none is lost.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            unknown = batch.where(F.col(route).isNull() | ~F.col(route).isin(*writers)).select(route).first()
            if unknown is not None:
                raise ValueError(f"no writer for route {unknown[0]!r}")
            for name, target in writers.items():
                target(batch.where(F.col(route) == name).drop(route), batch_id)
        finally:
            batch.unpersist()

    return write


def console(df: DataFrame, label: str, checkpoint: str | None = None, **trigger) -> StreamingQuery:
    """Print each micro-batch, every row marked with ``label``."""
    writer = df.select(F.lit(label).alias("label"), "*").writeStream.format("console")
    if checkpoint:
        writer = writer.option("checkpointLocation", checkpoint)
    return writer.option("truncate", "false").trigger(**(trigger or {"availableNow": True})).start()
