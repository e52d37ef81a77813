"""Bounded and streaming reads of files and tables, and the parsers of raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streamlens import schemas
from streamlens.functions.scalar import field, from_epoch, to_long

CORRUPT = "_corrupt"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per line, column ``value``."""
    return spark.read.text(path)


def read_events(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Stored events: parquet, or CSV when a schema is given for a ``.csv`` path."""
    if path.endswith(".csv"):
        return spark.read.schema(schema or schemas.USER_BEHAVIOR).csv(path)
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A table or view of the session catalog."""
    return spark.table(name)


def parse_behavior_csv(df: DataFrame, unit: str, line: str = "value") -> DataFrame:
    """``user,item,category,behavior,time`` lines to typed columns plus ``ts``.

    A line which does not fit keeps its text in ``_corrupt`` and has null fields.
    """
    schema = f"{schemas.USER_BEHAVIOR}, {CORRUPT} STRING"
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    parsed = df.withColumn("_r", F.from_csv(F.col(line), schema, options))
    return parsed.select(
        *[c for c in df.columns if c != line], "_r.*"
    ).withColumn("ts", from_epoch(F.col("timestamp"), unit))


def parse_json(df: DataFrame, schema: str, text: str = "value") -> DataFrame:
    """JSON text to the columns of ``schema``; other columns are kept."""
    parsed = df.withColumn("_r", F.from_json(F.col(text), schema))
    return parsed.select(*[c for c in df.columns if c != text], "_r.*")


def parse_kv(df: DataFrame, separator: str = "-", text: str = "value") -> DataFrame:
    """``key-number`` text to ``key`` and ``n``; text without both parts is dropped."""
    value = F.col(text)
    return (
        df.withColumns({"key": field(value, separator, 0), "n": to_long(field(value, separator, 1))})
        .where(value.contains(separator) & F.col("n").isNotNull())
        .drop(text)
    )


def parse_rule(df: DataFrame, text: str = "value") -> DataFrame:
    """``tier:rule`` text to ``tier`` and ``rule``; text without a colon is dropped."""
    value = F.col(text)
    return (
        df.where(value.contains(":"))
        .withColumns({"tier": field(value, ":", 0), "rule": field(value, ":", 1)})
        .drop(text)
    )


def json_number(text: Column, path: str) -> Column:
    """A number inside JSON text, such as ``$.k``."""
    return F.get_json_object(text, path).cast("bigint")


def stream_files(
    spark: SparkSession, path: str, schema: str, fmt: str = "parquet", **options: str
) -> DataFrame:
    """Files of a folder as a stream. ``maxFilesPerTrigger`` bounds a micro-batch."""
    return spark.readStream.format(fmt).schema(schema).options(**options).load(path)


def read_rules_stream(spark: SparkSession, path: str, **options: str) -> DataFrame:
    """Rules as a second stream: text files with one ``tier:rule`` per line."""
    return parse_rule(spark.readStream.options(**options).text(path))
