"""Traffic metrics: totals, running values, windows, hot items, ranking per key."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlens import schemas
from streamlens.functions.scalar import cents
from streamlens.operators import accumulate, aggregates, bitmaps, ranking, windows
from streamlens.plans.registry import query, table
from streamlens.session import pin
from streamlens.sources.files import json_number, read_events

ORDER = ["ts", "event_id"]


def events(spark, folder):
    """Events with the value in cents (``c``) and the number in the properties (``k``)."""
    rows = read_events(spark, f"{folder}/events.parquet", schemas.EVENT)
    return rows.select(
        "event_id", "ts", "user_id", "event_type", cents(F.col("value")).alias("c"),
        json_number(F.col("props"), "$.k").alias("k"),
    )


def views(spark, folder):
    return events(spark, folder).where(F.col("event_type") == "view")


def purchases(spark, folder):
    """Lines as transactions: client, product, amount in cents and a unique number.

    Order and line number do not identify a line, so the number is built from all its columns.
    """
    lines, orders = table(spark, folder, "lineitem"), table(spark, folder, "orders")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("client"), F.col("l_partkey").alias("product"),
        cents(F.col("l_extendedprice")).alias("amount"),
    )


E = """
SELECT event_id, ts, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS c,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
"""
V = f"SELECT * FROM ({E}) WHERE event_type = 'view'"
P = """
SELECT o_custkey AS client, l_partkey AS product, CAST(round(l_extendedprice * 100) AS BIGINT) AS amount
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
"""


# ---- totals and running values


@query(f"""
SELECT event_id, user_id, c,
       CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS running
FROM ({E})
""")
def running_sum_by_key(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    return aggregates.running_sum_by_key(rows, "user_id", "c", ORDER).drop("ts")


@query(f"SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pv FROM ({V})")
def total_pv_running(spark, folder):
    return aggregates.running_pv(views(spark, folder).select("event_id", "ts"), ORDER).drop("ts")


@query(f"SELECT count(*) AS pv, count(DISTINCT user_id) AS uv FROM ({V})")
def total_pv_uv(spark, folder):
    return aggregates.aggregate_by(
        views(spark, folder), [], {"pv": F.count("*"), "uv": F.count_distinct("user_id")}
    )


@query(f"""
WITH f AS (SELECT event_id, ts, CASE WHEN row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1
                                THEN 1 ELSE 0 END AS is_first FROM ({V}))
SELECT event_id, CAST(sum(is_first) OVER (ORDER BY ts, event_id) AS BIGINT) AS uv FROM f
""")
def total_uv_running(spark, folder):
    rows = views(spark, folder).select("event_id", "ts", "user_id")
    return aggregates.running_uv(rows, "user_id", ORDER).select("event_id", "uv")


VOLUME_SQL = """
WITH b AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS records,
                  CAST(sum(octet_length(encode(props))) OVER (ORDER BY ts, event_id) AS BIGINT) AS bytes
           FROM events)
SELECT *, CASE WHEN bytes >= 1073741824 THEN printf('%.2f', bytes / 1073741824.0::DOUBLE) || 'GB'
               WHEN bytes >= 1048576 THEN printf('%.2f', bytes / 1048576.0::DOUBLE) || 'MB'
               WHEN bytes >= 1024 THEN printf('%.2f', bytes / 1024.0::DOUBLE) || 'KB'
               ELSE CAST(bytes AS VARCHAR) || 'B' END AS volume FROM b
"""
MESSAGES_SQL = f"""
SELECT event_id, records, bytes, '当前数据条数：' || records AS count_message,
       '当前收集的数据量:' || volume AS size_message FROM ({VOLUME_SQL})
"""


@query(MESSAGES_SQL)
def traffic_volume_monitor(spark, folder):
    rows = read_events(spark, f"{folder}/events.parquet", schemas.EVENT)
    volume = aggregates.running_volume(rows.select("event_id", "ts", "props"), "props", ORDER)
    messages = aggregates.volume_messages(volume)
    return messages.select("event_id", "records", "bytes", "count_message", "size_message")


@query("SELECT count(*) AS records FROM events")
def record_count(spark, folder):
    return aggregates.record_count(events(spark, folder))


@query(f"SELECT user_id, event_type, CAST(sum(c) AS BIGINT) AS total FROM ({E}) GROUP BY ALL")
def reduce_by_key(spark, folder):
    return aggregates.reduce_by_key(events(spark, folder), ["user_id", "event_type"], "c")


@query("""
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) = 1
""")
def keep_first_by_key(spark, folder):
    rows = events(spark, folder).withColumn("day", F.window("ts", "1 day")["start"])
    kept = rows.select("user_id", "day", "event_id", "ts", "event_type")
    return aggregates.keep_first_by_key(kept, ["user_id", "day"], ORDER).drop("ts")


@query(f"""
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, CAST(sum(c) AS BIGINT) AS amount,
       CAST(sum(k) AS BIGINT) AS transfer, max(ts) AS last_ts
FROM ({E}) GROUP BY ALL
""")
def daily_client_totals(spark, folder):
    return aggregates.daily_client_totals(events(spark, folder), "user_id", "c", "k", "ts")


@query(r"""
SELECT time_bucket(INTERVAL '6 hours', ts) AS window_start,
       time_bucket(INTERVAL '6 hours', ts) + INTERVAL '6 hours' AS window_end, event_type,
       count(*) AS n, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total,
       max(value) AS largest
FROM events GROUP BY ALL
""")
def custom_aggregate(spark, folder):
    rows = read_events(spark, f"{folder}/events.parquet", schemas.EVENT)
    aggs = {"n": F.count("*"), "total": F.sum(cents(F.col("value"))), "largest": F.max("value")}
    return windows.windowed(rows, "ts", "6 hours", aggs, ["event_type"])


DECAYED_SQL = f"""
SELECT user_id, round(sum(c * w) / sum(w), 3) AS mean, any_value(newest) AS newest FROM (
  SELECT user_id, c, max(ts) OVER (PARTITION BY user_id) AS newest,
         pow(2.0, (epoch_us(ts) - epoch_us(max(ts) OVER (PARTITION BY user_id))) / 86400000000.0) AS w
  FROM ({E}) WHERE c IS NOT NULL) GROUP BY user_id
"""


@query(DECAYED_SQL)
def decayed_mean(spark, folder):
    """Mean value per user, a day halving what a row counts."""
    rows = events(spark, folder).select(
        "user_id", F.col("c").cast("double").alias("_x"), F.unix_micros(F.col("ts").cast("timestamp")).alias("_at")
    )
    found = accumulate.accumulate(rows, ["user_id"], accumulate.DecayedMean(86_400_000_000))
    return found.select("user_id", F.round("mean", 3).alias("mean"), F.timestamp_micros("newest").cast("timestamp_ntz").alias("newest"))


TOP_PRODUCTS = f"""
SELECT client, product, amount,
       CAST(row_number() OVER (PARTITION BY client ORDER BY amount DESC, product) AS INTEGER) AS rank
FROM (SELECT client, product, max(amount) AS amount FROM ({P}) GROUP BY ALL) QUALIFY rank <= 3
"""


@query(f"""
SELECT client, CAST(sum(amount) AS BIGINT) AS total, CAST(sum(amount) // count(*) AS BIGINT) AS average
FROM ({TOP_PRODUCTS}) GROUP BY client
""")
def top3_sum_and_average(spark, folder):
    return ranking.top_product_sums(purchases(spark, folder), "client", "product", "amount")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_quantity <> 0")
def group_by_distinct(spark, folder):
    lines = table(spark, folder, "lineitem").where("l_quantity <> 0")
    return aggregates.distinct_groups(lines, ["l_partkey", "l_suppkey"])


@query("""
SELECT max(d) AS newest FROM (SELECT strftime(o_orderdate, '%Y%m%d') AS d FROM orders
                              WHERE o_orderdate > TIMESTAMP '1995-01-01' GROUP BY 1)
""")
def max_over_subquery(spark, folder):
    orders = table(spark, folder, "orders").where("o_orderdate > timestamp_ntz'1995-01-01'")
    days = orders.select(F.date_format("o_orderdate", "yyyyMMdd").alias("d"))
    return aggregates.max_over_groups(days, "d", "newest")


@query(f"""
SELECT event_id, CAST(sum(c) OVER w AS BIGINT) AS run_sum, min(c) OVER w AS run_min,
       max(c) OVER w AS run_max
FROM ({E}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
""")
def rolling_extrema(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    return aggregates.rolling_extrema(rows, "user_id", "c", ORDER).drop("ts", "user_id", "c")


@query(f"""
SELECT user_id, lo.event_id AS min_id, lo.c AS min_c, hi.event_id AS max_id, hi.c AS max_c FROM
  (SELECT * FROM ({E}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY c, event_id) = 1) lo
  JOIN (SELECT * FROM ({E}) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_id) = 1) hi
  USING (user_id)
""")
def min_by_max_by(spark, folder):
    rows = aggregates.extreme_rows(events(spark, folder), "user_id", "c", ["event_id", "c"], ["event_id"])
    return rows.select(
        "user_id", F.col("min_row.event_id").alias("min_id"), F.col("min_row.c").alias("min_c"),
        F.col("max_row.event_id").alias("max_id"), F.col("max_row.c").alias("max_c"),
    )


# ---- windows


@query("""
SELECT time_bucket(INTERVAL '5 seconds', ts) AS window_start,
       time_bucket(INTERVAL '5 seconds', ts) + INTERVAL '5 seconds' AS window_end, count(*) AS n
FROM events GROUP BY ALL
""")
def tumbling_count(spark, folder):
    return windows.windowed_count(events(spark, folder), "ts", "5 seconds")


def sliding_sql(source: str, size: str, slide: str, keys: str, out: str) -> str:
    """Counts per sliding window: each row is copied to the starts of its windows."""
    return f"""
SELECT s AS window_start, s + INTERVAL '{size}' AS window_end, {keys}count(*) AS {out}
FROM (SELECT *, unnest(generate_series(time_bucket(INTERVAL '{slide}', ts) - INTERVAL '{size}'
              + INTERVAL '{slide}', time_bucket(INTERVAL '{slide}', ts), INTERVAL '{slide}')) AS s
      FROM ({source}))
GROUP BY ALL
"""


@query(sliding_sql(E, "5 seconds", "1 second", "", "n"))
def sliding_count(spark, folder):
    return windows.sliding_count(events(spark, folder), "ts", "5 seconds", "1 second")


@query(f"""
SELECT time_bucket(INTERVAL '8 hours', ts) AS window_start,
       time_bucket(INTERVAL '8 hours', ts) + INTERVAL '8 hours' AS window_end, user_id,
       arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type, count(*) AS n
FROM ({E}) GROUP BY 1, 2, 3
""")
def tumbling_event_count(spark, folder):
    return windows.first_and_count(
        events(spark, folder), "ts", "8 hours", "user_id", ["event_id", "event_type"], ["event_id"]
    )


COUNT_WINDOW_SQL = f"""
SELECT user_id, no AS window_no, CAST(sum(c) AS BIGINT) AS total FROM (
  SELECT *, CAST((row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 3 AS BIGINT) AS no
  FROM ({E})) GROUP BY user_id, no HAVING count(*) = 3
"""


@query(COUNT_WINDOW_SQL)
def count_window(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    return windows.count_window(rows, "user_id", ORDER, 3, {"total": F.sum("c")})


@query(f"""
SELECT event_id, CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
FROM ({E})
""")
def sliding_count_window(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    return windows.sliding_count_window(rows, "user_id", ORDER, 5, 1, "c").select("event_id", "total")


@query(f"""
SELECT event_id, total FROM (
  SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         CAST(sum(c) OVER (PARTITION BY user_id ORDER BY ts, event_id
                           ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS BIGINT) AS total
  FROM ({E})) WHERE rn % 2 = 0
""")
def sliding_count_window_every_2(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    return windows.sliding_count_window(rows, "user_id", ORDER, 5, 2, "c").select("event_id", "total")


HOURLY = "time_bucket(INTERVAL '1 hour', ts) AS window_start, " \
         "time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end"
PV_SQL = f"SELECT {HOURLY}, count(*) AS pv FROM ({V}) GROUP BY ALL"
UV_SQL = f"SELECT {HOURLY}, count(DISTINCT user_id) AS uv FROM ({V}) GROUP BY ALL"


@query(PV_SQL)
def windowed_pv(spark, folder):
    return windows.windowed_pv(views(spark, folder), "ts")


@query(f"""
SELECT window_start, window_end, CAST(sum(pv) OVER (ORDER BY window_start) AS BIGINT) AS pv FROM ({PV_SQL})
""")
def cumulative_pv(spark, folder):
    return windows.cumulative_pv(views(spark, folder), "ts")


@query(UV_SQL)
def windowed_uv(spark, folder):
    return windows.windowed_uv(views(spark, folder), "ts", "user_id")


@query(UV_SQL)
def windowed_uv_bitmap(spark, folder):
    rows = views(spark, folder)
    return bitmaps.users_counted(bitmaps.window_bitmaps(rows, "ts", "user_id", bitmaps.user_numbers(rows, "user_id")))


@query(f"""
SELECT time_bucket(INTERVAL '1 day', ts) AS window_start, time_bucket(INTERVAL '1 day', ts) + INTERVAL '1 day' AS window_end,
       count(DISTINCT user_id) AS uv FROM ({V}) GROUP BY ALL
""")
def daily_uv_bitmap(spark, folder):
    """Days from the stored bitmaps of hours."""
    rows = views(spark, folder)
    hours = bitmaps.window_bitmaps(rows, "ts", "user_id", bitmaps.user_numbers(rows, "user_id"))
    return bitmaps.users_counted(bitmaps.rolled_up(pin(hours, "hour-bitmaps"), "1 day"))


@query()
def windowed_uv_approx(spark, folder):
    return windows.windowed_uv_approx(views(spark, folder), "ts", "user_id")


@query()
def windowed_uv_sketch(spark, folder):
    sketches = windows.windowed_uv_sketch(views(spark, folder), "ts", "user_id")
    return sketches.select("window_start", "window_end", F.hll_sketch_estimate("sketch").alias("uv"))


BOUND_SQL = f"SELECT window_start, window_end, uv, true AS within_bound FROM ({UV_SQL})"


def against_exact(rows, estimated, error=0.1):
    """The exact count of each window, and whether the estimate of it is at most ``error`` off."""
    exact = windows.windowed_uv(rows, "ts", "user_id")
    near = F.abs(F.col("estimate") - F.col("uv")) <= F.greatest(F.lit(1.0), F.col("uv") * error)
    both = exact.join(estimated, ["window_start", "window_end"], "left")
    return both.select("window_start", "window_end", "uv", F.coalesce(near, F.lit(False)).alias("within_bound"))


@query(BOUND_SQL)
def windowed_uv_approx_bound(spark, folder):
    rows = views(spark, folder)
    return against_exact(rows, windows.windowed_uv_approx(rows, "ts", "user_id").withColumnRenamed("uv", "estimate"))


@query(BOUND_SQL)
def windowed_uv_sketch_bound(spark, folder):
    rows = views(spark, folder)
    estimate = F.hll_sketch_estimate("sketch").alias("estimate")
    return against_exact(rows, windows.windowed_uv_sketch(rows, "ts", "user_id").select("window_start", "window_end", estimate))


def hot_sql(item: str, size: str, slide: str) -> str:
    counted = sliding_sql(V, size, slide, f"{item}, ", "views")
    return f"""
SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY views DESC, {item}) AS INTEGER) AS rank
FROM ({counted}) QUALIFY rank <= 3
"""


@query(hot_sql("user_id", "10 minutes", "5 seconds"), name="hot_pages_every_5s")
def hot_pages_every_5s(spark, folder):
    return windows.hot_pages(views(spark, folder), "ts", "user_id")


@query(hot_sql("k", "1 hour", "5 minutes"))
def hot_pages(spark, folder):
    return windows.hot_pages(views(spark, folder), "ts", "k", 3, "1 hour", "5 minutes")


@query(hot_sql("k", "6 hours", "30 minutes"))
def hot_categories(spark, folder):
    return windows.hot_categories(views(spark, folder), "ts", "k", 3, "6 hours", "30 minutes")


@query(f"""
SELECT window_end, '窗口结束时间: ' || epoch_us(window_end) // 1000 || chr(10) || repeat('-', 33) || chr(10)
       || string_agg('网址：' || k || '     热度值：' || views, chr(10) ORDER BY rank)
       || chr(10) || repeat('-', 33) || chr(10) AS report
FROM ({hot_sql("k", "1 hour", "5 minutes")}) GROUP BY window_end
""")
def hot_report(spark, folder):
    return windows.hot_report(hot_pages(spark, folder), "k")


HEAT_SQL = f"""
SELECT k, heat, window_end AS windowend FROM ({sliding_sql(V, "1 hour", "5 minutes", "k, ", "heat")})
"""


@query(HEAT_SQL)
def category_heat(spark, folder):
    return windows.category_heat(views(spark, folder), "ts", "k")


@query(f"""
SELECT {HOURLY}, k, arg_min(event_id, (ts, event_id)) AS event_id, arg_min(user_id, (ts, event_id)) AS user_id
FROM ({V}) GROUP BY 1, 2, 3
""")
def first_per_window(spark, folder):
    return windows.first_per_window(
        views(spark, folder), "ts", "1 hour", "k", ["event_id", "user_id"], ORDER
    )


@query(f"""
SELECT {HOURLY}, event_type, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts,
       count(DISTINCT user_id) AS users FROM ({E}) GROUP BY 1, 2, 3
""")
def window_apply(spark, folder):
    aggs = {"n": F.count("*"), "first_ts": F.min("ts"), "last_ts": F.max("ts"),
            "users": F.count_distinct("user_id")}
    return windows.windowed(events(spark, folder), "ts", "1 hour", aggs, ["event_type"])


@query(f"""
SELECT event_type, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
       CAST(sum(c) AS BIGINT) AS total FROM ({E}) GROUP BY ALL
""")
def incremental_then_decorate(spark, folder):
    sums = windows.windowed(events(spark, folder), "ts", "1 hour", {"total": F.sum("c")}, ["event_type"])
    return sums.select("event_type", "window_end", "total")


# ---- ranking


@query("""
SELECT user_id, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) = 1
""")
def latest_version(spark, folder):
    newest = ranking.latest_version(
        events(spark, folder), "user_id", [F.col("ts").desc(), F.col("event_id")]
    )
    return newest.select("user_id", "event_id", "event_type")


TOP_TRANSACTIONS_SQL = f"""
SELECT user_id, event_id, c,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY c DESC, event_id) AS INTEGER) AS rank
FROM ({E}) QUALIFY rank <= 3
"""


@query(TOP_TRANSACTIONS_SQL)
def top3_transactions(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id", "c")
    return ranking.top_transactions(rows, "user_id", "c", ["event_id"])


@query(f"""
SELECT user_id, event_id, array_to_string(list_reverse(list_sort(c, 'DESC')[1:3]), ',') AS top FROM (
  SELECT user_id, event_id, list(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS c FROM ({E}))
""")
def top3_transactions_running(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id", "ts", "c")
    running = ranking.running_top(rows, "user_id", "c", "event_id", ORDER)
    cents_text = F.transform("top", lambda v: v.cast("bigint").cast("string"))
    return running.select("user_id", "event_id", F.array_join(cents_text, ",").alias("top"))


@query(TOP_PRODUCTS)
def top3_products_map(spark, folder):
    return ranking.top_products(purchases(spark, folder), "client", "product", "amount")


@query(f"""
SELECT client, string_agg(CAST(product AS VARCHAR), ',' ORDER BY rank DESC) AS products
FROM ({TOP_PRODUCTS}) GROUP BY client
""")
def top3_products_list(spark, folder):
    names = ranking.top_product_names(purchases(spark, folder), "client", "product", "amount")
    return names.select("client", F.array_join("products", ",").alias("products"))


@query(f"""
SELECT window_start, event_type, user_id, n, CAST(row_number() OVER (
         PARTITION BY window_start, event_type ORDER BY n DESC, user_id) AS INTEGER) AS rank
FROM (SELECT date_trunc('day', ts)::TIMESTAMP AS window_start, event_type, user_id, count(*) AS n
      FROM ({E}) GROUP BY ALL) QUALIFY rank <= 3
""")
def topn_per_window(spark, folder):
    counts = windows.windowed_count(events(spark, folder), "ts", "1 day", ["event_type", "user_id"])
    ranked = ranking.top_n(counts, ["window_start", "event_type"], [F.col("n").desc(), F.col("user_id")], 3)
    return ranked.drop("window_end")


@query("""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10
""")
def sort_limit(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)


@query(f"""
SELECT event_id, c, previous FROM (
  SELECT event_id, c, lag(c) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS previous FROM ({E}))
WHERE abs(c - previous) > 10000
""")
def adjacent_jump(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "user_id", "c")
    jumps = ranking.adjacent_jump(rows, "user_id", "c", ORDER, 10_000)
    return jumps.select("event_id", "c", "previous")


BASELINE_SQL = f"""
WITH RECURSIVE o AS (
  SELECT user_id, event_id, c::DOUBLE AS x, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
  FROM ({E})),
walk AS (
  SELECT user_id, event_id, x, rn, 0::DOUBLE AS baseline, abs(x) > 10000 AS hit FROM o WHERE rn = 1
  UNION ALL
  SELECT o.user_id, o.event_id, o.x, o.rn, CASE WHEN w.hit THEN w.x ELSE w.baseline END,
         abs(o.x - CASE WHEN w.hit THEN w.x ELSE w.baseline END) > 10000
  FROM walk w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1)
SELECT user_id, event_id, baseline, x AS amount FROM walk WHERE hit
"""


@query(BASELINE_SQL)
def baseline_jump(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id", "ts", F.col("c").cast("double").alias("amount"))
    return ranking.baseline_jump(rows, "user_id", "amount", "event_id", ORDER, 10_000)
