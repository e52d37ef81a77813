"""Joins, connected streams, rules in force, and the daily job."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlens.functions.scalar import cents, day_text
from streamlens.operators import joins
from streamlens.plans import etl
from streamlens.plans.metrics import E, events
from streamlens.plans.registry import query, table


def join_columns():
    return [
        F.concat_ws("|", F.col("l.user_id"), F.col("r.user_id")).alias("ids"),
        F.concat_ws("|", F.col("l.event_id"), F.col("r.event_id")).alias("names"),
        (F.col("l.c") + F.col("r.c")).alias("amount"),
        (F.col("l.k") + F.col("r.k")).alias("transfer"),
    ]


WINDOW_JOIN_SQL = f"""
SELECT l.user_id || '|' || r.user_id AS ids, l.event_id || '|' || r.event_id AS names,
       l.c + r.c AS amount, l.k + r.k AS transfer
FROM ({E}) l JOIN ({E}) r ON l.user_id = r.user_id AND date_trunc('day', l.ts) = date_trunc('day', r.ts)
WHERE l.event_type = 'click' AND r.event_type = 'purchase'
"""


@query(WINDOW_JOIN_SQL)
def window_join(spark, folder):
    rows = events(spark, folder)
    clicks, bought = (rows.where(F.col("event_type") == t) for t in ("click", "purchase"))
    return joins.window_join(clicks, bought, "user_id", "ts", "1 day", join_columns())


@query("""
SELECT o_orderkey, c_custkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey
""")
def inner_join(spark, folder):
    orders, customers = table(spark, folder, "orders"), table(spark, folder, "customer")
    joined = joins.inner_join(orders, customers, "o_custkey", "c_custkey")
    return joined.select("o_orderkey", "c_custkey", "c_name")


@query("""
SELECT s_suppkey, n_name, r_name FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey AND n_regionkey < 3
LEFT JOIN region ON n_regionkey = r_regionkey
""")
def left_join(spark, folder):
    suppliers = table(spark, folder, "supplier").withColumnRenamed("s_nationkey", "n_nationkey")
    nations = table(spark, folder, "nation").where("n_regionkey < 3")
    regions = table(spark, folder, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    named = joins.left_join(joins.left_join(suppliers, nations, "n_nationkey"), regions, "n_regionkey")
    return named.select("s_suppkey", "n_name", "r_name")


IMPLICIT_SQL = """
SELECT o_orderkey, l_partkey, c_name, n_name FROM orders, lineitem, customer, nation
WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
  AND l_returnflag = 'R' AND n_regionkey = 1
"""


@query(IMPLICIT_SQL)
def implicit_join(spark, folder):
    for name in ("orders", "lineitem", "customer", "nation"):
        table(spark, folder, name).createOrReplaceTempView(f"streamlens_{name}")
    return spark.sql("""
        SELECT o_orderkey, l_partkey, c_name, n_name
        FROM streamlens_orders, streamlens_lineitem, streamlens_customer, streamlens_nation
        WHERE l_orderkey = o_orderkey AND o_custkey = c_custkey AND c_nationkey = n_nationkey
          AND l_returnflag = 'R' AND n_regionkey = 1
    """)


def rules(spark, folder):
    """Rules made of the errors: each sets the rule of a tier from its time on."""
    errors = events(spark, folder).where("event_type = 'error'")
    tier = F.element_at(
        F.array(F.lit("high-risk"), F.lit("medium-risk"), F.lit("regular-trading")),
        (F.col("event_id") % 3 + 1).cast("int"),
    )
    return errors.select(
        "ts", tier.alias("tier"), F.concat(F.lit("rule "), F.col("event_id")).alias("rule")
    )


R = f"""
SELECT ts, CASE event_id % 3 WHEN 0 THEN 'high-risk' WHEN 1 THEN 'medium-risk' ELSE 'regular-trading' END
           AS tier, 'rule ' || event_id AS rule
FROM ({E}) WHERE event_type = 'error'
"""
TIERED = f"""
SELECT *, CASE WHEN c > 10000 THEN 'high-risk' WHEN c > 5000 THEN 'medium-risk'
               ELSE 'regular-trading' END AS tier FROM ({E})
"""
ASOF_SQL = f"""
SELECT t.event_id, t.tier, coalesce(r.rule, '') AS rule
FROM ({TIERED}) t ASOF LEFT JOIN ({R}) r ON t.tier = r.tier AND t.ts >= r.ts
"""


def tiered(spark, folder):
    tier = F.when(F.col("c") > 10_000, "high-risk").when(F.col("c") > 5_000, "medium-risk")
    rows = events(spark, folder).select("event_id", "ts", "c")
    return rows.withColumn("tier", tier.otherwise("regular-trading"))


@query(ASOF_SQL)
def rules_asof_join(spark, folder):
    found = joins.rules_asof_join(
        tiered(spark, folder), rules(spark, folder), "tier", "ts", "rule", ["ts", "event_id"]
    )
    return found.select("event_id", "tier", "rule")


DAILY_RULES_SQL = f"""
SELECT t.event_id, t.tier, coalesce(r.rule, '') AS rule
FROM ({TIERED}) t ASOF LEFT JOIN (SELECT date_trunc('day', ts)::TIMESTAMP AS ts, tier, min(rule) AS rule
                                  FROM ({R}) GROUP BY ALL) r
  ON t.tier = r.tier AND t.ts >= r.ts
"""


@query(DAILY_RULES_SQL)
def rules_asof_join_few(spark, folder):
    daily = rules(spark, folder).groupBy(F.window("ts", "1 day")["start"].alias("ts"), "tier").agg(
        F.min("rule").alias("rule")
    )
    found = joins.rules_asof_join(
        tiered(spark, folder), daily, "tier", "ts", "rule", ["ts", "event_id"]
    )
    return found.select("event_id", "tier", "rule")


CONNECT_SQL = """
SELECT 1 AS source, CAST(event_id AS VARCHAR) AS value FROM events
UNION ALL SELECT 2, p_name FROM part
"""


def connected(spark, folder):
    return joins.connect_map(
        events(spark, folder), table(spark, folder, "part"), F.col("event_id"), F.col("p_name")
    )


@query(CONNECT_SQL)
def connect_map(spark, folder):
    return connected(spark, folder)


@query(f"SELECT * FROM ({CONNECT_SQL}) WHERE source = 1")
def connect_first(spark, folder):
    return joins.connect_first(connected(spark, folder))


# ---- the daily job, on driver tables: bulletins are orders, funds are parts, holders are customers

def etl_tables(spark, folder):
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    parts, customers = table(spark, folder, "part"), table(spark, folder, "customer")
    price = cents(F.col("l_extendedprice"))
    sold = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return {
        "notices": sold.select(
            F.col("l_partkey").alias("innercode"), F.col("l_orderkey").alias("interbulletinid"),
            F.when(F.col("l_returnflag") == "R", 99).otherwise(1).alias("category"),
            F.concat(F.lit("title "), "o_orderpriority").alias("infotitle"),
        ).distinct(),
        "securities": parts.select(
            F.col("p_partkey").alias("innercode"), F.concat(F.lit("P"), "p_partkey").alias("secucode")
        ),
        "bulletins": orders.select(
            F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("bulletindate")
        ),
        "names": parts.select(
            F.col("p_partkey").alias("innercode"), F.col("p_name").alias("disclname"),
            F.lit(1).alias("infotype"), F.col("p_size").alias("effectivedate"),
        ).unionByName(parts.select(
            F.col("p_partkey").alias("innercode"), F.col("p_brand").alias("disclname"),
            (F.col("p_size") % 3).alias("infotype"), F.lit(25).alias("effectivedate"),
        )),
        "holdings": sold.select(
            F.col("o_custkey").cast("string").alias("client_id"),
            F.concat(F.lit("P"), "l_partkey").alias("prod_code"),
            day_text(F.col("o_orderdate")).alias("busi_date"),
            price.alias("current_amount"),
            F.when(F.col("l_linenumber") == 1, -price).otherwise(0).alias("correct_amount"),
        ),
        "contacts": customers.where("c_acctbal > 0").select(
            F.col("c_custkey").cast("string").alias("client_id"),
            F.when(F.col("c_nationkey") < 12, F.col("c_mktsegment")).alias("mobile_tel"),
            F.col("c_name").alias("home_tel"),
        ),
        "clients": customers.select(
            F.col("c_custkey").cast("string").alias("client_id"), F.col("c_name").alias("client_name")
        ),
    }


ETL_WITH = """
WITH sold AS (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS price
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
notices AS (SELECT DISTINCT l_partkey AS innercode, l_orderkey AS interbulletinid,
                   CASE WHEN l_returnflag = 'R' THEN 99 ELSE 1 END AS category,
                   'title ' || o_orderpriority AS infotitle FROM sold),
securities AS (SELECT p_partkey AS innercode, 'P' || p_partkey AS secucode FROM part),
bulletins AS (SELECT o_orderkey AS id, o_orderdate AS bulletindate FROM orders),
names AS (SELECT p_partkey AS innercode, p_name AS disclname, 1 AS infotype, p_size AS effectivedate FROM part
          UNION ALL SELECT p_partkey, p_brand, p_size % 3, 25 FROM part),
holdings AS (SELECT CAST(o_custkey AS VARCHAR) AS client_id, 'P' || l_partkey AS prod_code,
                    strftime(o_orderdate, '%Y%m%d') AS busi_date, price AS current_amount,
                    CASE WHEN l_linenumber = 1 THEN -price ELSE 0 END AS correct_amount FROM sold),
contacts AS (SELECT CAST(c_custkey AS VARCHAR) AS client_id,
                    CASE WHEN c_nationkey < 12 THEN c_mktsegment END AS mobile_tel, c_name AS home_tel
             FROM customer WHERE c_acctbal > 0),
clients AS (SELECT CAST(c_custkey AS VARCHAR) AS client_id, c_name AS client_name FROM customer)
"""
BULLETINS_SQL = """
SELECT a.secucode, c.disclname, b.bulletindate
FROM notices t, securities a, bulletins b,
     (SELECT innercode, disclname FROM names WHERE infotype = 1
      QUALIFY row_number() OVER (PARTITION BY innercode ORDER BY effectivedate DESC, disclname) = 1) c
WHERE t.category = 99 AND t.infotitle LIKE '%-%' AND t.innercode = a.innercode
  AND t.interbulletinid = b.id AND t.innercode = c.innercode
  AND b.bulletindate >= TIMESTAMP '{start}' AND b.bulletindate <= TIMESTAMP '{end}'
"""
USED_SQL = """
SELECT coalesce(max(busi_date) FILTER (busi_date = '{day}'),
                max(busi_date) FILTER (busi_date > '{month}')) AS used_date FROM holdings
"""


@query(ETL_WITH + BULLETINS_SQL.format(start="1995-01-01 09:30:00", end="1996-12-31 08:00:00"))
def filtered_bulletins(spark, folder):
    t = etl_tables(spark, folder)
    return etl.filtered_bulletins(
        t["notices"], t["securities"], t["bulletins"], t["names"],
        F.lit("1995-01-01 09:30:00").cast("timestamp_ntz"),
        F.lit("1996-12-31 08:00:00").cast("timestamp_ntz"), title="%-%",
    )


@query(ETL_WITH + "SELECT * FROM (" + USED_SQL.format(day="19960611", month="19960601") + ")"
       + " UNION ALL SELECT * FROM (" + USED_SQL.format(day="19960631", month="19960601") + ")")
def latest_partition_fallback(spark, folder):
    holdings = etl_tables(spark, folder)["holdings"]
    present, absent = (
        etl.latest_partition_fallback(holdings, F.lit(day)) for day in ("19960611", "19960631")
    )
    return present.unionByName(absent)


NOTICE_SQL = f"""
SELECT '{{run}}' AS update_date, s.client_id, ct.client_name,
       CASE WHEN co.mobile_tel IS NOT NULL THEN co.mobile_tel ELSE co.home_tel END AS client_phone_num,
       r.bulletindate AS publish_date, r.secucode AS fund_code, r.disclname AS fund_name,
       '尊敬的投资者您好！您持有的' || r.disclname || '（基金代码：' || r.secucode || '）' ||
       '目前二级市场交易价格较基金份额参考净值的溢价幅度较高。根据交易所公告，为了保护基金份额持有人利益，' || r.disclname || '将于' || strftime(r.bulletindate, '%Y年%m月%d日') ||
       '开市起至当日10:30停牌，自' || strftime(r.bulletindate, '%Y年%m月%d日') ||
       '10:30起复牌。敬请您关注相关风险提示公告，注意投资风险。如有疑问可咨询财通证券客服电话95336。' AS message
FROM ({{bulletins}}) r
JOIN (SELECT client_id, prod_code FROM holdings, ({{used}}) u
      WHERE busi_date = u.used_date AND current_amount + correct_amount <> 0
      GROUP BY client_id, prod_code) s ON r.secucode = s.prod_code
LEFT JOIN contacts co ON s.client_id = co.client_id
LEFT JOIN clients ct ON s.client_id = ct.client_id
"""


@query(ETL_WITH + NOTICE_SQL.format(
    run="20990101", bulletins=BULLETINS_SQL.format(start="1995-01-01 00:00:00", end="1999-12-31 08:00:00"),
    used=USED_SQL.format(day="19960631", month="19960601")))
def risk_notice_etl(spark, folder):
    t = etl_tables(spark, folder)
    found = etl.filtered_bulletins(
        t["notices"], t["securities"], t["bulletins"], t["names"],
        F.lit("1995-01-01 00:00:00").cast("timestamp_ntz"),
        F.lit("1999-12-31 08:00:00").cast("timestamp_ntz"), title="%-%",
    )
    positions = etl.held_positions(t["holdings"], F.lit("19960631"))
    # fixed value: the end of the message, with whom to ask
    closing = "敬请您关注相关风险提示公告，注意投资风险。如有疑问可咨询财通证券客服电话95336。"
    return etl.risk_notices(found, positions, t["contacts"], t["clients"], F.lit("20990101"), closing)
