"""Exact distinct users per window as bitmaps that can be merged: hours into days without reading the events again.

A dictionary gives each user a number, for good. The users of a window are bitmaps of the numbers, one per bucket of
32,768 of them; windows are merged bucket by bucket, and a count is the sum of the buckets' bits. A bitmap is 4 KB
whatever it holds, so this pays where windows see a fair part of the users; ``windowed_uv_sketch`` estimates where not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlens.operators.ordered import MAX_ROWS, cut, running
from streamlens.session import pin


def user_numbers(df: DataFrame, user: str, known: DataFrame | None = None, max_rows: int = MAX_ROWS) -> DataFrame:
    """``user``, ``no``: the dictionary ``known`` and, behind its numbers, the new users of ``df``. Null is no user.

    Numbers never change, so bitmaps stored earlier can be merged with later ones. New users are numbered in their
    order, in chunks if they are many.
    """
    new = df.where(F.col(user).isNotNull()).select(user).distinct()
    last = 0
    if known is not None:
        new = new.join(known, user, "left_anti")
        last = known.agg(F.max("no")).first()[0] or 0
    placed = running(cut(pin(new, "new-users"), [], [user], max_rows), {"no": ("count", F.lit(1))}).result()
    numbered = placed.select(user, (F.col("no") + last).cast("long").alias("no"))
    return pin(numbered if known is None else known.select(user, "no").unionByName(numbered), "user-numbers")


def window_bitmaps(df: DataFrame, ts: str, user: str, numbers: DataFrame, size: str = "1 hour") -> DataFrame:
    """``window_start``, ``window_end``, ``bucket``, ``users`` (bitmap). Users without a number are left out.

    A user counts once per window before numbers are joined, so a user with very many rows is a few rows there.
    """
    seen = df.select(F.window(ts, size).alias("window"), user).distinct()
    placed = seen.join(numbers, user)
    bits = F.bitmap_construct_agg(F.bitmap_bit_position("no"))
    return placed.groupBy("window", F.bitmap_bucket_number("no").alias("bucket")).agg(bits.alias("users")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "bucket", "users"
    )


def rolled_up(bitmaps: DataFrame, size: str) -> DataFrame:
    """Bitmaps of wider windows, which must hold whole narrower ones."""
    wide = F.window("window_start", size).alias("window")
    return bitmaps.groupBy(wide, "bucket").agg(F.bitmap_or_agg("users").alias("users")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "bucket", "users"
    )


def users_counted(bitmaps: DataFrame) -> DataFrame:
    """``window_start``, ``window_end``, ``uv``: exact distinct users."""
    return bitmaps.groupBy("window_start", "window_end").agg(F.sum(F.bitmap_count("users")).alias("uv"))
