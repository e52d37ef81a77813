from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from helpers import rows
from streamlens.plans import etl

HOLDINGS = (
    "client_id string, prod_code string, busi_date string, current_amount decimal(20,2), "
    "correct_amount decimal(20,2)"
)


def holdings(spark, day):
    from decimal import Decimal as D

    return spark.createDataFrame(
        [("c1", "S1", day, D(5), D(0)), ("c1", "S1", day, D(7), D(0)), ("c2", "S1", day, D(5), D(-5)),
         ("c3", "S1", "20210601", D(5), D(0)), ("c4", "S2", day, D(1), D(0))], HOLDINGS)


def inputs(spark, day="20210611"):
    return dict(
        notices=spark.createDataFrame(
            [(1, 10, 99, "x提示及停复牌公告y"), (1, 11, 99, "other"), (2, 10, 1, "提示及停复牌公告"),
             (1, 12, 99, "提示及停复牌公告"), (1, 13, 99, "提示及停复牌公告")],
            "innercode long, interbulletinid long, category int, infotitle string"),
        securities=spark.createDataFrame([(1, "S1"), (2, "S2")], "innercode long, secucode string"),
        bulletins=spark.createDataFrame(
            [(10, datetime(2021, 6, 11, 9, 30)), (11, datetime(2021, 6, 11, 12)),
             (12, datetime(2021, 6, 12, 8, 0, 1)), (13, datetime(2021, 6, 12, 8))],
            "id long, bulletindate timestamp_ntz"),
        names=spark.createDataFrame(
            [(1, "old", 1, date(2020, 1, 1)), (1, "new", 1, date(2021, 1, 1)), (1, "short", 2, date(2022, 1, 1))],
            "innercode long, disclname string, infotype int, effectivedate date"),
        holdings=holdings(spark, day),
        contacts=spark.createDataFrame(
            [("c1", None, "home")], "client_id string, mobile_tel string, home_tel string"),
        clients=spark.createDataFrame([("c9", "name")], "client_id string, client_name string"),
    )


def test_daily_notices(spark):
    out = etl.daily_notices("20210612", **inputs(spark))
    got = rows(out.select("client_id", "client_name", "client_phone_num", "fund_name",
                          F.col("publish_date").cast("string")))
    assert got == [("c1", None, "home", "new", "2021-06-11 09:30:00"),
                   ("c1", None, "home", "new", "2021-06-12 08:00:00")]
    text = out.where("publish_date < timestamp_ntz'2021-06-12'").first().message
    assert text.startswith("尊敬的投资者您好！您持有的new（基金代码：S1）") and "2021年06月11日开市起" in text


@pytest.mark.parametrize("day, used", [
    ("20210611", "20210611"), ("20210605", "20210611"), ("20210630", "20210611"), ("20210711", None)])
def test_partition_in_use(spark, day, used):
    found = etl.latest_partition_fallback(holdings(spark, "20210611"), F.lit(day))
    assert found.first().used_date == used


def test_fallback_day_is_used_for_positions(spark):
    got = etl.held_positions(holdings(spark, "20210611"), F.lit("20210615"))
    assert rows(got) == [("c1", "S1"), ("c4", "S2")]
