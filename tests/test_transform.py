from pyspark.sql import functions as F

from helpers import numbers, rows
from streamlens.operators import aggregates, dedup, joins, transform


def values(df, column):
    return sorted(r[column] for r in df.collect())


def test_square_and_flat_map(spark):
    n = numbers(spark, 1, 6)
    assert values(transform.map_square(n, "n"), "square") == [1, 4, 9, 16, 25, 36]
    flat = values(transform.flat_map_square_double(n, "n", "m"), "m")
    assert flat == sorted([t * t for t in range(1, 7)] + [2 * t for t in range(1, 7)])


def test_filter_even_and_parity(spark):
    assert values(transform.filter_even(numbers(spark, 1, 6), "n"), "n") == [2, 4, 6]
    groups = numbers(spark, 1, 8).groupBy(transform.parity_key("n").alias("g")).count()
    assert rows(groups) == [("()", 4), ("偶数", 4)]


def test_large_filter_limits_are_exclusive(spark):
    df = spark.createDataFrame(
        [(50000, 200000), (50001, 0), (0, 200001)], "transaction_amount long, transfer_accounts long"
    )
    assert rows(transform.filter_large(df)) == [(0, 200001), (50001, 0)]


def test_line_filter_looks_at_the_whole_line(spark):
    df = spark.createDataFrame([("1,2,3,pv,9",), ("1,2,3,buy,9",), ("1,pv,3,buy,9",)], "value string")
    assert transform.filter_line_contains(df, "pv").count() == 2


def test_routes_keep_all_rows(spark):
    df = numbers(spark, 1, 10)
    routed = transform.split_route(
        df, {"big": F.col("n") > 8, "even": F.col("n") % 2 == 0}, otherwise="rest"
    )
    assert rows(routed.groupBy("route").count()) == [("big", 2), ("even", 4), ("rest", 4)]


def test_drop_missing(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (1, None)], "a long, b long")
    assert transform.drop_missing(df, ["a", "b"]).count() == 1


def test_union_connect_shuffle(spark):
    assert dedup.union_streams(numbers(spark, 1, 5), numbers(spark, 6, 10)).count() == 10
    letters = spark.createDataFrame([(c,) for c in "abcde"], "c string")
    both = joins.connect_map(numbers(spark, 1, 5), letters, F.col("n"), F.col("c"))
    assert both.count() == 10
    assert values(joins.connect_first(both), "value") == ["1", "2", "3", "4", "5"]
    assert values(transform.redistribute(numbers(spark, 1, 10), 3), "n") == list(range(1, 11))


def test_running_sum_per_key(spark):
    df = spark.createDataFrame([(c, 1, i) for i, c in enumerate("abcdeface")], "k string, v long, i long")
    out = aggregates.running_sum_by_key(df, "k", "v", ["i"])
    assert out.count() == 9
    final = {r.k: r.top for r in out.groupBy("k").agg(F.max("running").alias("top")).collect()}
    assert final == {"a": 2, "b": 1, "c": 2, "d": 1, "e": 2, "f": 1}


def test_empty_input(spark):
    empty = numbers(spark, 1, 0)
    timed = empty.withColumn("ts", F.timestamp_seconds("n"))
    assert aggregates.running_pv(timed, ["ts", "n"]).count() == 0
    assert aggregates.record_count(empty).first().records == 0


def test_extreme_rows_take_the_earliest(spark):
    df = spark.createDataFrame([(1, 1, 5), (1, 2, 5), (1, 3, 9), (1, 4, 9)], "k long, i long, x long")
    found = aggregates.extreme_rows(df, "k", "x", ["i", "x"], ["i"]).first()
    assert tuple(found.min_row) == (1, 5) and tuple(found.max_row) == (3, 9)


def test_running_uv_split(spark):
    df = spark.range(500).select(
        "id", F.timestamp_seconds(F.least("id", F.lit(350))).alias("ts"),
        F.when(F.col("id") < 300, 1).otherwise(F.col("id") % 90).alias("u"),
    )
    whole = rows(aggregates.running_uv(df, "u", ["ts", "id"]))
    assert rows(aggregates.running_uv(df, "u", ["ts", "id"], max_rows=40)) == whole
