"""Bounded samples of labelled rows, for the models that learn from labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(key: str, by: int) -> Column:
    """crc32 of the key written as text, modulo ``by``. A null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(by))


def sample(docs: DataFrame, labels: DataFrame, label: str, at_most: int, by: int, left_out: int, key: str = "doc_id") -> DataFrame:
    """``key``, ``text`` and ``label`` of at most ``at_most`` labelled documents that are not held out.

    The choice follows a hash of the key, so it is the same in each run. Rows without label or key are not used;
    of several labels of a document the largest counts.
    """
    ids = (
        labels.where(F.col(label).isNotNull() & F.col(key).isNotNull() & (remainder(key, by) != left_out))
        .groupBy(key).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64(key), key).limit(at_most)
    )
    # at most ``at_most`` rows of two numbers
    return docs.select(key, "text").join(F.broadcast(ids), key)
