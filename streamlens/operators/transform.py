"""Projections, filters and routing. None of them moves rows between tasks except ``redistribute``."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two group keys.
EVEN_KEY, ODD_KEY = "偶数", "()"


def map_square(df: DataFrame, column: str, out: str = "square") -> DataFrame:
    return df.withColumn(out, F.col(column) * F.col(column))


def flat_map_square_double(df: DataFrame, column: str, out: str = "n") -> DataFrame:
    """Two rows per row: the square and the double."""
    x = F.col(column)
    return df.withColumn(out, F.explode(F.array(x * x, x * 2)))


def filter_even(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) % 2 == 0)


def filter_behavior(df: DataFrame, value: str, column: str = "behavior") -> DataFrame:
    return df.where(F.col(column) == value)


def filter_line_contains(df: DataFrame, text: str, column: str = "value") -> DataFrame:
    """Rows whose raw line contains ``text`` anywhere."""
    return df.where(F.col(column).contains(text))


def is_large(amount: str, transfer: str, max_amount: float, max_transfer: float) -> Column:
    return (F.col(amount) > max_amount) | (F.col(transfer) > max_transfer)


def filter_large(
    df: DataFrame,
    amount: str = "transaction_amount",
    transfer: str = "transfer_accounts",
    max_amount: float = 50_000,
    max_transfer: float = 200_000,
) -> DataFrame:
    """Rows above one of the limits; a value equal to the limit is not above it."""
    return df.where(is_large(amount, transfer, max_amount, max_transfer))


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def split_route(df: DataFrame, routes: dict[str, Column], otherwise: str,
                out: str = "route") -> DataFrame:
    """Name the side output of each row: the first route whose condition holds.

    Downstream branches filter on ``route``; the source is read once if they are aggregated
    together, and rows of the main stream are not changed.
    """
    chain = reduce(
        lambda acc, item: acc.when(item[1], item[0]) if acc is not None else F.when(item[1], item[0]),
        routes.items(),
        None,
    )
    return df.withColumn(out, chain.otherwise(otherwise))


def format_alert(df: DataFrame, prefix: str, key: str, suffix: str, out: str = "message") -> DataFrame:
    return df.withColumn(out, F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(suffix)))


def record_json(df: DataFrame, columns: Sequence[str], out: str = "json") -> DataFrame:
    return df.withColumn(out, F.to_json(F.struct(*columns)))


def redistribute(df: DataFrame, partitions: int) -> DataFrame:
    """Spread rows evenly over ``partitions`` tasks; the rows themselves stay as they are."""
    return df.repartition(partitions)


def parity_key(column: str) -> Column:
    """Even numbers share one text key; odd numbers share the unit value."""
    return F.when(F.col(column) % 2 == 0, EVEN_KEY).otherwise(ODD_KEY)
