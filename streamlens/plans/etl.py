"""The daily job: risk notices to holders of funds with a suspension bulletin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlens.functions.scalar import day_text, first_known, month_start, run_window
from streamlens.operators.ranking import latest_version

# The parts of the message text.
GREETING = "尊敬的投资者您好！您持有的"
CODE_OPEN, CODE_CLOSE = "（基金代码：", "）"
NOTICE = (
    "目前二级市场交易价格较基金份额参考净值的溢价幅度较高。"
    "根据交易所公告，为了保护基金份额持有人利益，"
)
WILL, YEAR, MONTH, DAY = "将于", "年", "月", "日"
SUSPENDED, RESUMED = "开市起至当日10:30停牌，自", "10:30起复牌。"
CLOSING = "敬请您关注相关风险提示公告，注意投资风险。"


def newest_names(names: DataFrame) -> DataFrame:
    """Per fund the name in force, from its versions of info type 1."""
    kept = names.where(F.col("infotype") == 1)
    return latest_version(kept, "innercode", [F.col("effectivedate").desc(), F.col("disclname")])


def filtered_bulletins(notices: DataFrame, securities: DataFrame, bulletins: DataFrame,
                       names: DataFrame, start: Column, end: Column, category: int = 99,
                       title: str = "%提示及停复牌公告%") -> DataFrame:
    """Bulletins of the wanted category and title in the span, both ends included."""
    wanted = notices.where((F.col("category") == category) & F.col("infotitle").like(title))
    dated = bulletins.where((F.col("bulletindate") >= start) & (F.col("bulletindate") <= end))
    return (
        wanted.join(dated, wanted["interbulletinid"] == dated["id"])
        .join(securities, "innercode")
        .join(newest_names(names), "innercode")
        .select("secucode", "disclname", "bulletindate")
    )


def latest_partition_fallback(holdings: DataFrame, day: Column, column: str = "busi_date") -> DataFrame:
    """One row: ``day`` if there are rows for it, else the newest day after the month's first."""
    date = F.col(column)
    # both cases lie in the month so far: only its partitions are read
    return holdings.where(date >= month_start(day)).agg(
        F.coalesce(
            F.max(F.when(date == day, date)), F.max(F.when(date > month_start(day), date))
        ).alias("used_date")
    )


def held_positions(holdings: DataFrame, day: Column, column: str = "busi_date") -> DataFrame:
    """Clients and products with a position on the day in use.

    The day stays inside the plan as a one-row relation, so a table partitioned by it is pruned.
    """
    used = latest_partition_fallback(holdings, day, column)
    return (
        holdings.join(F.broadcast(used), F.col(column) == F.col("used_date"))
        .where(F.col("current_amount") + F.col("correct_amount") != 0)
        .select("client_id", "prod_code")
        .distinct()
    )


def message(name: str, code: str, date: str, closing: str = CLOSING) -> Column:
    """The notice sent to a holder; ``closing`` may name whom to ask."""
    when = [
        F.date_format(date, "yyyy"), F.lit(YEAR), F.date_format(date, "MM"), F.lit(MONTH),
        F.date_format(date, "dd"), F.lit(DAY),
    ]
    return F.concat(
        F.lit(GREETING), F.col(name), F.lit(CODE_OPEN), F.col(code), F.lit(CODE_CLOSE),
        F.lit(NOTICE), F.col(name), F.lit(WILL), *when, F.lit(SUSPENDED), *when, F.lit(RESUMED),
        F.lit(closing),
    )


def risk_notices(bulletins: DataFrame, positions: DataFrame, contacts: DataFrame,
                 clients: DataFrame, run_day: Column, closing: str = CLOSING) -> DataFrame:
    """One notice per holder and bulletin, with the client's phone number and name if known."""
    return (
        bulletins.join(positions, bulletins["secucode"] == positions["prod_code"])
        .join(contacts, "client_id", "left")
        .join(clients, "client_id", "left")
        .select(
            run_day.alias("update_date"),
            "client_id",
            "client_name",
            first_known(F.col("mobile_tel"), F.col("home_tel")).alias("client_phone_num"),
            F.col("bulletindate").alias("publish_date"),
            F.col("secucode").alias("fund_code"),
            F.col("disclname").alias("fund_name"),
            message("disclname", "secucode", "bulletindate", closing).alias("message"),
        )
    )


def daily_notices(run_day: str, notices: DataFrame, securities: DataFrame, bulletins: DataFrame,
                  names: DataFrame, holdings: DataFrame, contacts: DataFrame,
                  clients: DataFrame) -> DataFrame:
    """The whole job for one ``yyyyMMdd`` run day."""
    span = run_window(F.lit(run_day))
    found = filtered_bulletins(notices, securities, bulletins, names, span["start_time"],
                               span["end_time"])
    positions = held_positions(holdings, span["execute_day"])
    return risk_notices(found, positions, contacts, clients, F.lit(run_day))


def today() -> Column:
    """Run day from the clock; jobs that must be repeatable pass the day instead."""
    return day_text(F.current_timestamp())
