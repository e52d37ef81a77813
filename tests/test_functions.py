from datetime import datetime

import pytest
from pyspark.sql import functions as F

from streamlens.functions import scalar as S


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


@pytest.mark.parametrize("size, text", [
    (0, "0B"), (1023, "1023B"), (1024, "1.00KB"), (1536, "1.50KB"), (1048576, "1.00MB"),
    (1073741823, "1024.00MB"), (1073741824, "1.00GB"), (1099511627776, "1.00TB"),
    (5 * 1125899906842624, "5120.00TB"), (-5, "-5B"),
])
def test_human_bytes(spark, size, text):
    assert value(spark, S.human_bytes(F.lit(size).cast("bigint"))) == text


@pytest.mark.parametrize("amount, tier", [
    (50000, "regular-trading"), (50001, "medium-risk"), (100000, "medium-risk"), (100001, "high-risk"),
])
def test_risk_tier(spark, amount, tier):
    assert value(spark, S.risk_tier(F.lit(amount))) == tier


def test_run_window(spark):
    span = S.run_window(F.lit("20210612"))
    got = spark.range(1).select(*[c.alias(n) for n, c in span.items()]).first()
    assert got.execute_day == "20210611"
    assert got.start_time == datetime(2021, 6, 11, 9, 30)
    assert got.end_time == datetime(2021, 6, 12, 8, 0)
    assert value(spark, S.month_start(F.lit("20210611"))) == "20210601"


def test_text(spark):
    assert value(spark, S.field(F.lit("a-1"), "-", 1)) == "1"
    assert value(spark, S.field(F.lit("a"), "-", 1)) == ""
    assert value(spark, S.tokens(F.lit(" nihao  shijie, zaijian! "))) == ["nihao", "shijie", "zaijian"]
    assert value(spark, S.tokens(F.lit("ab, cd"), r"\w+")) == [", "]
    assert value(spark, S.to_long(F.lit("x1"))) is None
    assert value(spark, S.byte_length(F.lit("é偶"))) == 5


def test_epoch(spark):
    ms = F.lit(1623401174665).cast("bigint")
    assert value(spark, S.to_epoch_millis(S.from_epoch(ms, "ms"))) == 1623401174665
    seconds = S.from_epoch(F.lit(1511658000).cast("bigint"), "s")
    assert value(spark, S.to_epoch_millis(seconds)) == 1511658000000
    with pytest.raises(ValueError):
        S.from_epoch(ms, "us")


def test_arrays_and_maps(spark):
    a = F.array(*[F.lit(x) for x in (5, 1, 4, 2)])
    assert value(spark, S.smallest(a, 3)) == [1, 2, 4]
    assert value(spark, S.largest(a, 2)) == [5, 4]
    assert value(spark, S.without_first(a)) == [1, 4, 2]
    m = F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(2))
    assert value(spark, S.map_put(m, F.lit("a"), F.lit(9))) == {"a": 9, "b": 2}
    assert value(spark, S.map_remove(m, F.lit("a"))) == {"b": 2}
