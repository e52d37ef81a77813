"""Sources, parsing, projections, filters, routing, set operations and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlens import schemas
from streamlens.functions import scalar as S
from streamlens.operators import aggregates, dedup, transform
from streamlens.plans.registry import query, table
from streamlens.session import scratch
from streamlens.sources import connectors, files, sinks
from streamlens.streaming.jobs import replay


def _events(spark, folder):
    return files.read_events(spark, f"{folder}/events.parquet", schemas.EVENT)


def _lines(spark, folder):
    """Events as ``user,item,category,behavior,time`` text, times in epoch milliseconds."""
    k = files.json_number(F.col("props"), "$.k")
    return _events(spark, folder).select(
        "event_id",
        F.concat_ws(
            ",", "user_id", "event_id", k, "event_type", S.to_epoch_millis(F.col("ts"))
        ).alias("value"),
    )


# ---- sources and parsing


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def read_events(spark, folder):
    return _events(spark, folder)


@query("""
SELECT event_id, user_id AS "userID", event_id AS "itemID",
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS "categoryID", event_type AS behavior,
       epoch_us(ts) // 1000 AS timestamp, date_trunc('milliseconds', ts) AS ts
FROM events
""")
def parse_behavior_csv(spark, folder):
    parsed = files.parse_behavior_csv(_lines(spark, folder), unit="ms")
    return parsed.where(F.col(files.CORRUPT).isNull()).drop(files.CORRUPT).withColumn(
        "ts", F.col("ts").cast("timestamp_ntz")
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def parse_json(spark, folder):
    return files.parse_json(_events(spark, folder).select("event_id", "props"), "k BIGINT", "props")


@query("""
SELECT o_orderkey, split_part(o_orderpriority, '-', 2) AS key,
       CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS n
FROM orders WHERE contains(o_orderpriority, '-')
""")
def parse_kv(spark, folder):
    # priorities read "1-URGENT": turned round they are key-number texts
    p = F.col("o_orderpriority")
    text = F.when(
        p.contains("-"), F.concat_ws("-", S.field(p, "-", 1), S.field(p, "-", 0))
    ).otherwise(p)
    return files.parse_kv(table(spark, folder, "orders").select("o_orderkey", text.alias("value")))


@query("""
SELECT c_custkey, c_nationkey, n_name || ' -love- ' || CAST(n_regionkey AS VARCHAR) AS label
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""")
def lookup_dimension(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, folder, "nation")
    return connectors.lookup_dimension(
        customers, nations, "c_nationkey", "n_nationkey", ["n_name", "n_regionkey"]
    )


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def read_table(spark, folder):
    table(spark, folder, "supplier").createOrReplaceTempView("streamlens_supplier")
    return files.read_table(spark, "streamlens_supplier").select(
        "s_suppkey", "s_name", "s_nationkey", "s_acctbal"
    )


@query("""
SELECT split_part(p_type, ' ', 1) AS tier, p_name AS rule FROM part
""")
def read_rules_stream(spark, folder):
    path = scratch(spark, "rules")
    parts = table(spark, folder, "part")
    parts.select(
        F.concat_ws(":", S.field(F.col("p_type"), " ", 0), "p_name").alias("value")
    ).write.text(path)
    return replay(files.read_rules_stream(spark, path), "rules-read")


@query("""
SELECT CAST(to_json({'event_id': event_id, 'event_type': event_type, 'user_id': user_id}) AS VARCHAR)
           AS value,
       CAST(user_id AS VARCHAR) AS key, ts AS timestamp
FROM events
""")
def kafka_records(spark, folder):
    events = _events(spark, folder).select("event_id", "event_type", "user_id", "ts")
    records = connectors.kafka_records(events, ts="ts", key="user_id")
    return records.select(
        F.to_json(F.from_json("value", "event_id BIGINT, event_type STRING, user_id BIGINT"))
        .alias("value"),
        "key", F.col("timestamp").cast("timestamp_ntz").alias("timestamp"),
    )


@query("""
SELECT concat_ws(',', c_name, strftime(DATE '2024-01-01', '%Y%m%d'), c_mktsegment,
                 CAST(c_nationkey AS VARCHAR)) AS value FROM customer
""")
def account_line(spark, folder):
    accounts = table(spark, folder, "customer").select(
        F.col("c_name").alias("fund_account"), F.lit("20240101").alias("open_date"),
        F.col("c_mktsegment").alias("xz"), F.col("c_nationkey").cast("string").alias("zt"),
    )
    return connectors.account_line(accounts)


# ---- tables written by sinks


LATEST_SQL = """
SELECT user_id, event_id, ts, event_type, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


@query(LATEST_SQL)
def latest_value_table(spark, folder):
    events = _events(spark, folder).select("user_id", "event_id", "ts", "event_type", "value")
    return sinks.latest_value_table(events, ["user_id"], ["ts", "event_id"])


@query("SELECT DISTINCT event_type, user_id FROM events")
def distinct_set_table(spark, folder):
    return sinks.distinct_set_table(_events(spark, folder), "event_type", "user_id")


@query("""
SELECT '{"data":{"event_id":' || event_id || ',"event_type":"' || event_type || '"}}' AS payload
FROM events
""")
def search_index_payload(spark, folder):
    return sinks.search_payload(_events(spark, folder).select("event_id", "event_type"))


@query("""
SELECT '{"index":{"_index":"parts"}}' AS value FROM part
UNION ALL SELECT '{"data":{"p_partkey":' || p_partkey || '}}' FROM part
""")
def write_search_index(spark, folder):
    path = scratch(spark, "index")
    sinks.write_search_index(table(spark, folder, "part").select("p_partkey"), path, "parts")
    return files.read_lines(spark, path)


@query("SELECT c_custkey, c_name FROM customer")
def overwrite_table(spark, folder):
    customers = table(spark, folder, "customer").select("c_custkey", "c_name")
    name = "streamlens_customers"
    sinks.overwrite_table(customers.where("c_acctbal < 0"), name)
    sinks.overwrite_table(customers, name)
    return spark.table(name)


# ---- projections, filters, routing


@query("SELECT p_partkey, p_size, p_size * p_size AS square FROM part")
def map_square(spark, folder):
    return transform.map_square(table(spark, folder, "part").select("p_partkey", "p_size"), "p_size")


@query("""
SELECT p_partkey, p_size * p_size AS n FROM part
UNION ALL SELECT p_partkey, p_size * 2 FROM part
""")
def flat_map_square_double(spark, folder):
    parts = table(spark, folder, "part")
    return transform.flat_map_square_double(parts, "p_size").select("p_partkey", "n")


@query("SELECT event_id, user_id FROM events WHERE event_id % 2 = 0")
def filter_even(spark, folder):
    return transform.filter_even(_events(spark, folder).select("event_id", "user_id"), "event_id")


@query("SELECT event_id, user_id FROM events WHERE event_type = 'view'")
def filter_behavior(spark, folder):
    views = transform.filter_behavior(_events(spark, folder), "view", "event_type")
    return views.select("event_id", "user_id")


@query("SELECT doc_id FROM documents WHERE contains(text, 'view')")
def filter_line_contains(spark, folder):
    return transform.filter_line_contains(table(spark, folder, "documents"), "view", "text").select(
        "doc_id"
    )


@query("""
SELECT l_orderkey, l_partkey, l_extendedprice, l_quantity FROM lineitem
WHERE l_extendedprice > 50000 OR l_quantity > 45
""")
def filter_large(spark, folder):
    rows = transform.filter_large(
        table(spark, folder, "lineitem"), "l_extendedprice", "l_quantity", 50_000, 45
    )
    return rows.select("l_orderkey", "l_partkey", "l_extendedprice", "l_quantity")


@query("""
SELECT l_orderkey, l_partkey, o_totalprice, l_extendedprice
FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey AND o_orderstatus = 'F'
WHERE o_totalprice IS NOT NULL AND l_extendedprice IS NOT NULL
""")
def drop_missing_amounts(spark, folder):
    finished = transform.filter_behavior(table(spark, folder, "orders"), "F", "o_orderstatus")
    lines = table(spark, folder, "lineitem")
    joined = lines.join(finished, F.col("l_orderkey") == F.col("o_orderkey"), "left").select(
        "l_orderkey", "l_partkey", "o_totalprice", "l_extendedprice"
    )
    return transform.drop_missing(joined, ["o_totalprice", "l_extendedprice"])


@query("""
SELECT CASE WHEN value > 200 THEN 'single' ELSE 'calculate' END AS route, count(*) AS n,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents
FROM events GROUP BY ALL
""")
def split_route(spark, folder):
    routed = transform.split_route(
        _events(spark, folder), {"single": F.col("value") > 200}, otherwise="calculate"
    )
    return routed.groupBy("route").agg(
        F.count("*").alias("n"), F.sum(S.cents(F.col("value"))).alias("cents")
    )


@query("""
SELECT event_id, '注意当前客户id：' || user_id || ' 的客户出现了疑似洗钱的行为' AS message FROM events
""")
def format_alert(spark, folder):
    events = _events(spark, folder).select("event_id", "user_id")
    return transform.format_alert(
        events, "注意当前客户id：", "user_id", " 的客户出现了疑似洗钱的行为"
    ).select("event_id", "message")


@query("""
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS json
FROM events
""")
def project_record(spark, folder):
    events = _events(spark, folder)
    return transform.record_json(events, ["user_id", "event_type"]).select("event_id", "json")


@query("SELECT event_id, ts, user_id FROM events")
def redistribute(spark, folder):
    return transform.redistribute(_events(spark, folder).select("event_id", "ts", "user_id"), 16)


@query("""
SELECT CASE WHEN p_size % 2 = 0 THEN '偶数' ELSE '()' END AS parity, count(*) AS n,
       CAST(sum(p_size) AS BIGINT) AS total FROM part GROUP BY ALL
""")
def parity_key(spark, folder):
    return table(spark, folder, "part").groupBy(transform.parity_key("p_size").alias("parity")).agg(
        F.count("*").alias("n"), F.sum("p_size").alias("total")
    )


# ---- set operations


@query("""
SELECT event_id, user_id FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id FROM events WHERE event_type = 'click'
UNION ALL SELECT event_id, user_id FROM events
""")
def union_streams(spark, folder):
    events = _events(spark, folder)
    parts = [events.where(F.col("event_type") == t) for t in ("view", "click")]
    return dedup.union_streams(*parts, events).select("event_id", "user_id")


@query("""
SELECT DISTINCT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events
""")
def dedup_keys(spark, folder):
    events = _events(spark, folder).withColumn("k", files.json_number(F.col("props"), "$.k"))
    return dedup.dedup_keys(events, ["user_id", "k"])


# ---- scalar functions


@query("""
SELECT event_id, split_part(props, ':', 1) AS head, split_part(props, ':', 2) AS tail,
       split_part(props, ':', 3) AS missing FROM events
""")
def split_fields(spark, folder):
    p = F.col("props")
    parts = {name: S.field(p, ":", i) for i, name in enumerate(["head", "tail", "missing"])}
    return _events(spark, folder).select("event_id", *[c.alias(n) for n, c in parts.items()])


@query(r"""
SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[^a-zA-Z0-9_]+')) AS word FROM documents)
WHERE word <> '' GROUP BY word
""")
def word_count(spark, folder):
    words = aggregates.words(table(spark, folder, "documents"), "text")
    return words.groupBy("word").agg(F.count("*").alias("n"))


@query(r"""
SELECT separator, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[a-zA-Z0-9_]+')) AS separator FROM documents)
WHERE separator <> '' GROUP BY separator
""")
def separator_count(spark, folder):
    parts = aggregates.words(table(spark, folder, "documents"), "text", r"\w+", "separator")
    return parts.groupBy("separator").agg(F.count("*").alias("n"))


@query("""
SELECT o_orderkey, TRY_CAST(split_part(o_orderpriority, '-', 1) AS BIGINT) AS level,
       coalesce(TRY_CAST(o_orderstatus AS BIGINT), -1) AS not_a_number, CAST(o_custkey AS VARCHAR) AS cust
FROM orders
""")
def try_casts(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey",
        S.to_long(S.field(F.col("o_orderpriority"), "-", 0)).alias("level"),
        S.first_known(S.to_long(F.col("o_orderstatus")), F.lit(-1)).alias("not_a_number"),
        F.col("o_custkey").cast("string").alias("cust"),
    )


@query("SELECT p_partkey, p_name FROM part WHERE p_name LIKE '%ring%' OR contains(p_type, 'STEEL')")
def like_and_contains(spark, folder):
    parts = table(spark, folder, "part").where(
        F.col("p_name").like("%ring%") | F.col("p_type").contains("STEEL")
    )
    return parts.select("p_partkey", "p_name")


@query("""
WITH s AS (SELECT o_orderkey, CAST(round(o_totalprice * o_totalprice) AS BIGINT) AS size FROM orders)
SELECT o_orderkey, size,
  CASE WHEN size >= 1099511627776 THEN printf('%.2f', size / 1099511627776.0::DOUBLE) || 'TB'
       WHEN size >= 1073741824 THEN printf('%.2f', size / 1073741824.0::DOUBLE) || 'GB'
       WHEN size >= 1048576 THEN printf('%.2f', size / 1048576.0::DOUBLE) || 'MB'
       WHEN size >= 1024 THEN printf('%.2f', size / 1024.0::DOUBLE) || 'KB'
       ELSE CAST(size AS VARCHAR) || 'B' END AS volume
FROM s
""")
def human_bytes(spark, folder):
    size = F.round(F.col("o_totalprice") * F.col("o_totalprice")).cast("bigint")
    orders = table(spark, folder, "orders").select("o_orderkey", size.alias("size"))
    return orders.withColumn("volume", S.human_bytes(F.col("size")))


@query("SELECT doc_id, octet_length(encode(text)) AS bytes FROM documents")
def byte_length(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", S.byte_length(F.col("text")).cast("bigint").alias("bytes")
    )


@query("""
SELECT d.doc_id, coalesce(l.quality, -1) AS quality
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def first_known(spark, folder):
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    joined = docs.select("doc_id").join(labels, "doc_id", "left")
    return joined.select("doc_id", S.first_known(F.col("quality"), F.lit(-1)).alias("quality"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y') || '年' || strftime(o_orderdate, '%m') || '月' ||
       strftime(o_orderdate, '%d') || '日' AS said, strftime(o_orderdate, '%Y%m%d') AS day
FROM orders
""")
def date_texts(spark, folder):
    d = "o_orderdate"
    said = F.concat(F.date_format(d, "yyyy"), F.lit("年"), F.date_format(d, "MM"), F.lit("月"),
                    F.date_format(d, "dd"), F.lit("日"))
    return table(spark, folder, "orders").select(
        "o_orderkey", said.alias("said"), S.day_text(F.col(d)).alias("day")
    )


@query("""
SELECT o_orderkey, strftime(o_orderdate - INTERVAL 1 DAY, '%Y%m%d') AS execute_day,
       date_trunc('day', o_orderdate) - INTERVAL 1 DAY + INTERVAL '9 hours 30 minutes' AS start_time,
       date_trunc('day', o_orderdate) + INTERVAL '8 hours' AS end_time,
       strftime(o_orderdate, '%Y%m') || '01' AS month_first
FROM orders
""")
def run_window(spark, folder):
    day = S.day_text(F.col("o_orderdate"))
    spans = S.run_window(day)
    return table(spark, folder, "orders").select(
        "o_orderkey", *[c.alias(n) for n, c in spans.items()], S.month_start(day).alias("month_first")
    )


@query("""
WITH c AS (SELECT event_id, CAST(round(value * 100) AS BIGINT) AS c FROM events)
SELECT event_id, abs(c - 5000) AS distance, greatest(c, 5000) AS larger, c + 1 AS more,
       c // 100 AS whole FROM c
""")
def arithmetic(spark, folder):
    c = S.cents(F.col("value"))
    return _events(spark, folder).select(
        "event_id", F.abs(c - 5000).alias("distance"), F.greatest(c, F.lit(5000)).alias("larger"),
        (c + 1).alias("more"), F.expr("cast(round(value * 100) as bigint) div 100").alias("whole"),
    )


@query("""
SELECT event_id, epoch_us(ts) // 1000 AS millis, date_trunc('milliseconds', ts) AS again FROM events
""")
def epoch_millis(spark, folder):
    millis = S.to_epoch_millis(F.col("ts"))
    return _events(spark, folder).select(
        "event_id", millis.alias("millis"),
        S.from_epoch(millis, "ms").cast("timestamp_ntz").alias("again"),
    )


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       '{"k":' || json_extract_string(props, '$.k') || '}' AS again FROM events
""")
def json_round_trip(spark, folder):
    parsed = F.from_json("props", "k BIGINT")
    return _events(spark, folder).select(
        "event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("again")
    )


@query("""
SELECT event_id, CASE WHEN value > 100 THEN 'high-risk' WHEN value > 50 THEN 'medium-risk'
                      ELSE 'regular-trading' END AS tier FROM events
""")
def risk_tier(spark, folder):
    return _events(spark, folder).select(
        "event_id", S.risk_tier(F.col("value"), 50, 100).alias("tier")
    )


@query("""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(text, '[^a-zA-Z0-9_]+'), lambda x: x <> '') AS a
           FROM documents)
SELECT doc_id, CAST(len(a) AS BIGINT) AS n,
       array_to_string(list_sort(a)[1:3], ' ') AS low, array_to_string(list_reverse_sort(a)[1:3], ' ') AS high,
       CAST(len(a[2:]) AS BIGINT) AS rest
FROM w
""")
def array_functions(spark, folder):
    a = S.tokens(F.col("text"))
    return table(spark, folder, "documents").select(
        "doc_id", F.size(a).cast("bigint").alias("n"),
        F.array_join(S.smallest(a, 3), " ").alias("low"),
        F.array_join(S.largest(a, 3), " ").alias("high"),
        F.size(S.without_first(a)).cast("bigint").alias("rest"),
    )


@query("""
SELECT event_id, user_id AS old, CASE WHEN event_type = 'view' THEN value END AS got,
       event_type = 'view' AS has_view, CAST(2 AS INTEGER) AS entries, CAST(1 AS INTEGER) AS after_remove
FROM events
""")
def map_functions(spark, folder):
    m = F.create_map(F.col("event_type"), F.lit(0.0), F.lit("user"), F.col("user_id").cast("double"))
    changed = S.map_put(m, F.col("event_type"), F.col("value"))
    return _events(spark, folder).select(
        "event_id", changed["user"].cast("bigint").alias("old"), changed["view"].alias("got"),
        F.map_contains_key(changed, "view").alias("has_view"),
        F.size(F.map_values(changed)).alias("entries"),
        F.size(S.map_remove(changed, F.col("event_type"))).alias("after_remove"),
    )


@query("""
SELECT l_orderkey, l_partkey FROM lineitem WHERE l_discount + l_tax <> 0
""")
def nonzero_sum(spark, folder):
    lines = table(spark, folder, "lineitem").where(F.col("l_discount") + F.col("l_tax") != 0)
    return lines.select("l_orderkey", "l_partkey")
