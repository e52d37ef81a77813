"""Unions and duplicate removal."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def union_streams(*dfs: DataFrame) -> DataFrame:
    """All rows of all inputs, duplicates kept. *Streams.*"""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def dedup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Each key once. *Streams*, with the keys held in checkpointed state."""
    return df.select(*keys).dropDuplicates()


def dedup_recent(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key within the watermark delay; state is bounded, a key may return later."""
    return df.dropDuplicatesWithinWatermark(list(keys))
