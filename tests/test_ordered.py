"""The split path must give the same rows as the plain window path, with hot keys and null keys."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from streamlens.operators.ordered import cut, nearby, running, running_overall


@pytest.fixture(scope="module")
def rows(spark):
    # key 0 holds half of all rows; one key is null; ts has ties
    return spark.range(900).select(
        F.when(F.col("id") % 2 == 0, 0).when(F.col("id") % 9 == 1, None)
        .otherwise(F.col("id") % 7).alias("k"),
        (F.col("id") * 37 % 101).alias("ts"),
        F.col("id"),
        F.when(F.col("id") % 3 == 0, (F.col("id") * 13 % 50)).alias("x"),
    )


def sorted_rows(df):
    return sorted(map(tuple, df.collect()), key=lambda r: tuple((v is None, v) for v in r))


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("reverse", [False, True])
def test_running_split_equals_plain(rows, keys, strict, reverse):
    order = ["ts", "id"]
    values = {
        "s": ("sum", F.col("x")),
        "n": ("count", F.col("x")),
        "hi": ("max", F.col("x")),
        "lo": ("min", F.col("x")),
        "new": ("last", F.struct("id", "x")),
        "newx": ("last", F.col("x")),
    }
    plain = running(cut(rows, keys, order), values, strict=strict, reverse=reverse)
    small = cut(rows, keys, order, max_rows=60)
    assert small.split and not plain.split
    split = running(small, values, strict=strict, reverse=reverse)
    assert sorted_rows(split.result()) == sorted_rows(plain.result())


@pytest.mark.parametrize("keys", [["k"], []])
def test_nearby_split_equals_plain(rows, keys):
    order = ["ts", "id"]
    values = {
        "prev": lambda w: F.lag("id").over(w),
        "next2": lambda w: F.lead("id", 2).over(w),
        "last5": lambda w: F.sum("x").over(w.rowsBetween(-4, 0)),
        "n5": lambda w: F.count("*").over(w.rowsBetween(-4, 0)),
    }
    plain = nearby(cut(rows, keys, order), values, before=4, after=2)
    split = nearby(cut(rows, keys, order, max_rows=50), values, before=4, after=2)
    assert split.split
    assert sorted_rows(split.result()) == sorted_rows(plain.result())


def test_no_chunk_is_large(rows):
    o = cut(rows, ["k"], ["ts", "id"], max_rows=60)
    largest = o.df.groupBy("k", "_chunk").count().agg(F.max("count")).first()[0]
    assert largest <= 2 * 60
    assert o.df.count() == 900


@pytest.mark.parametrize("strict", [False, True])
@pytest.mark.parametrize("max_rows", [1_000_000, 30])
def test_overall_equals_one_window(rows, strict, max_rows):
    crowded = rows.withColumn("at", F.timestamp_seconds(F.when(F.col("ts") < 40, 3).otherwise(F.col("ts"))))
    values = {"s": ("sum", F.col("x")), "n": ("count", F.lit(1)), "hi": ("max", F.col("x")),
              "new": ("last", F.struct("id", "x"))}
    w = Window.orderBy("at", "id").rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
    want = crowded.withColumns({
        "s": F.coalesce(F.sum("x").over(w), F.lit(0)), "n": F.count("*").over(w),
        "hi": F.max("x").over(w), "new": F.last(F.struct("id", "x"), ignorenulls=True).over(w),
    })
    got = running_overall(crowded, ["at", "id"], values, strict=strict, max_rows=max_rows)
    assert sorted_rows(got) == sorted_rows(want)
