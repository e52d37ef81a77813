"""Late data, patterns and monitoring, replayed over the stored events."""

from __future__ import annotations

from pyspark.sql import functions as F

from streamlens.operators import late, monitor, patterns
from streamlens.plans.metrics import E, ORDER, events
from streamlens.plans.registry import query
from streamlens.plans.relations import R, rules

# ---- late data: the events arrive up to an hour after their time, in a fixed disorder

ARRIVAL = ["arrival", "event_id"]
L = f"SELECT *, ts + to_seconds(event_id * 7919 % 3600) AS arrival FROM ({E})"


def arrivals(spark, folder):
    late_by = F.make_dt_interval(secs=(F.col("event_id") * 7919 % 3600).cast("decimal(18,6)"))
    return events(spark, folder).withColumn("arrival", F.col("ts") + late_by)


WATERMARK_SQL = f"""
SELECT event_id, max(ts) OVER (ORDER BY arrival, event_id) - INTERVAL '3 seconds'
                 - INTERVAL '1 millisecond' AS watermark FROM ({L})
"""


@query(WATERMARK_SQL)
def punctuated_watermark(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "ts", "arrival")
    return late.row_watermark(rows, "ts", ARRIVAL, "3 SECONDS", after=True).select(
        "event_id", "watermark"
    )


CLASS_SQL = f"""
SELECT event_id, user_id, arrival, time_bucket(INTERVAL '1 hour', ts) AS window_start, window_end,
       CASE WHEN wm IS NULL OR window_end - INTERVAL '1 millisecond' > wm THEN 'on_time'
            WHEN window_end - INTERVAL '1 millisecond' + INTERVAL '10 minutes' > wm THEN 'late_refire'
            ELSE 'side_output' END AS late_class
FROM (SELECT *, time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end,
             max(ts) OVER (ORDER BY arrival, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
             - INTERVAL '10 minutes' - INTERVAL '1 millisecond' AS wm FROM ({L}))
"""


def classified(spark, folder):
    rows = arrivals(spark, folder).select("event_id", "user_id", "ts", "arrival")
    return late.classify_late(rows, "ts", ARRIVAL, "1 hour", "10 MINUTES", "10 MINUTES")


@query(f"SELECT event_id, window_start, window_end, late_class FROM ({CLASS_SQL})")
def late_classes(spark, folder):
    return classified(spark, folder).select("event_id", "window_start", "window_end", "late_class")


@query(f"SELECT event_id, user_id, window_start FROM ({CLASS_SQL}) WHERE late_class = 'side_output'")
def late_side_output(spark, folder):
    _, side = late.late_side_output(classified(spark, folder))
    return side.select("event_id", "user_id", "window_start")


REFIRE_SQL = f"""
WITH c AS (SELECT * FROM ({CLASS_SQL}) WHERE late_class <> 'side_output')
SELECT window_start, window_end, count(*) AS n, 'on_time' AS firing FROM c
WHERE late_class = 'on_time' GROUP BY ALL
UNION ALL
SELECT window_start, window_end, n, late_class FROM (
  SELECT *, row_number() OVER (PARTITION BY window_start ORDER BY arrival, event_id) AS n FROM c)
WHERE late_class = 'late_refire'
"""


@query(REFIRE_SQL)
def late_refire(spark, folder):
    return late.late_refire(classified(spark, folder), [], ARRIVAL)


# ---- patterns, per user in time order


@query(f"SELECT event_id, user_id FROM ({E}) WHERE event_type = 'view' AND k >= 50")
def pattern_single(spark, folder):
    found = patterns.single(events(spark, folder), (F.col("event_type") == "view") & (F.col("k") >= 50))
    return found.select("event_id", "user_id")


@query(f"""
SELECT event_id, ((event_type = 'view' AND k = 30) OR event_type = 'click') AND k = 40 AS left_to_right,
       (event_type = 'view' AND k = 30) OR (event_type = 'click' AND k = 40) AS grouped FROM ({E})
""")
def pattern_combined_conditions(spark, folder):
    view, click = F.col("event_type") == "view", F.col("event_type") == "click"
    in_turn = patterns.chained(("where", view), ("where", F.col("k") == 30), ("or", click),
                               ("where", F.col("k") == 40))
    grouped = (view & (F.col("k") == 30)) | (click & (F.col("k") == 40))
    return events(spark, folder).select(
        "event_id", in_turn.alias("left_to_right"), grouped.alias("grouped")
    )


@query(f"SELECT event_id FROM ({E}) WHERE event_type IN ('view', 'signup') AND k > 30")
def pattern_iterative_condition(spark, folder):
    kinds = F.col("event_type").isin("view", "signup")
    return patterns.single(events(spark, folder), kinds & (F.col("k") > 30)).select("event_id")


@query(f"""
WITH RECURSIVE r AS (
  SELECT user_id, event_id, c, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM ({E}) WHERE c IS NOT NULL
), walk(user_id, event_id, c, i, accepted, matches, total) AS (
  SELECT user_id, event_id, c, i, true, CAST(0 AS BIGINT), CAST(0 AS BIGINT) FROM r WHERE i = 1
  UNION ALL
  SELECT n.user_id, n.event_id, n.c, n.i,
         100 * n.c * (w.matches + CAST(w.accepted AS BIGINT)) > 150 * (w.total + CASE WHEN w.accepted THEN w.c ELSE 0 END),
         w.matches + CAST(w.accepted AS BIGINT), w.total + CASE WHEN w.accepted THEN w.c ELSE 0 END
  FROM walk w JOIN r n ON n.user_id = w.user_id AND n.i = w.i + 1
)
SELECT user_id, event_id, c, matches, total FROM walk WHERE accepted
""")
def pattern_history_condition(spark, folder):
    """Events worth more than one and a half times the mean of those accepted before."""
    return patterns.above_history(events(spark, folder), "user_id", "c", "event_id", ORDER, 150)


def times_sql(times: int) -> str:
    return f"""
WITH a AS (SELECT *, lead(event_id) OVER w AS next_id, lead(event_type) OVER w AS next_type,
                  lead(ts) OVER w AS next_ts FROM ({E}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
v AS (SELECT user_id, event_id AS first_id, ts AS first_ts, lead(event_id, {times - 1}) OVER w AS last_id,
             lead(next_id, {times - 1}) OVER w AS next_id, lead(next_type, {times - 1}) OVER w AS next_type,
             lead(next_ts, {times - 1}) OVER w AS next_ts
      FROM a WHERE event_type = 'view' WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))
SELECT user_id, first_id, last_id, next_id, first_ts, next_ts FROM v WHERE next_type = 'purchase'
"""


def sequence(spark, folder):
    return events(spark, folder).select("event_id", "ts", "user_id", "event_type", "k")


def view_view_purchase(spark, folder):
    return patterns.times_next(
        sequence(spark, folder), "user_id", ORDER, F.col("event_type") == "view",
        F.col("event_type") == "purchase", 2, ["event_id", "ts"],
    )


def match_ids(matches, *more):
    return matches.select(
        "user_id", F.col("first.event_id").alias("first_id"), F.col("last.event_id").alias("last_id"),
        F.col("next.event_id").alias("next_id"), *more,
    )


@query(f"SELECT user_id, first_id, last_id, next_id FROM ({times_sql(2)})")
def pattern_times_next(spark, folder):
    return match_ids(view_view_purchase(spark, folder))


@query(" UNION ALL ".join(
    f"SELECT user_id, first_id, last_id, next_id, CAST({n} AS INTEGER) AS times FROM ({times_sql(n)})"
    for n in (1, 2, 3)))
def pattern_times_range(spark, folder):
    found = patterns.times_range_next(
        sequence(spark, folder), "user_id", ORDER, F.col("event_type") == "view",
        F.col("event_type") == "purchase", 1, 3, ["event_id", "ts"],
    )
    return match_ids(found, "times")


@query(f"""
SELECT user_id, first_id, last_id, next_id FROM ({times_sql(2)})
WHERE next_ts - first_ts < INTERVAL '2 days'
""")
def pattern_within(spark, folder):
    return match_ids(patterns.within(view_view_purchase(spark, folder), "ts", "2 DAYS"))


@query(f"SELECT user_id, first_id AS event_id, first_ts AS ts FROM ({times_sql(2)})")
def pattern_select(spark, folder):
    return patterns.select_first(view_view_purchase(spark, folder), "user_id", ["event_id", "ts"])


LOOP_SQL = f"""
SELECT event_id, user_id, ts, CAST(stretch AS BIGINT) AS stretch, row_number() OVER (
         PARTITION BY user_id, stretch ORDER BY ts DESC, event_id DESC) AS matches
FROM (SELECT *, sum(CASE WHEN k > 90 THEN 1 ELSE 0 END) OVER (
                  PARTITION BY user_id ORDER BY ts, event_id) AS stretch FROM ({E}))
WHERE event_type = 'view' AND k <= 90
"""


def loops(spark, folder):
    return patterns.one_or_more_until(
        sequence(spark, folder), "user_id", ORDER, F.col("event_type") == "view", F.col("k") > 90
    ).select("event_id", "user_id", "ts", "stretch", "matches")


@query(f"SELECT event_id, user_id, stretch, matches FROM ({LOOP_SQL})")
def pattern_one_or_more_until(spark, folder):
    return loops(spark, folder).drop("ts")


@query(f"""
SELECT user_id, stretch, event_id, matches AS length FROM ({LOOP_SQL})
QUALIFY row_number() OVER (PARTITION BY user_id, stretch ORDER BY ts, event_id) = 1
""")
def pattern_skip_past_last(spark, folder):
    longest = patterns.longest_loops(loops(spark, folder), "user_id", ORDER)
    return longest.select("user_id", "stretch", "event_id", "length")


# ---- monitoring


RISING_SQL = f"""
WITH RECURSIVE o AS (
  SELECT user_id, c, epoch_us(ts) AS us, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn,
         c > lag(c, 1, 0) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rise FROM ({E})),
walk AS (
  SELECT user_id, rn, NULL::BIGINT AS fired, CASE WHEN rise THEN us + 43200000000 END AS deadline
  FROM o WHERE rn = 1
  UNION ALL
  SELECT o.user_id, o.rn, CASE WHEN w.deadline < o.us THEN w.deadline END,
         CASE WHEN w.deadline >= o.us THEN CASE WHEN o.rise THEN w.deadline END
              WHEN o.rise THEN o.us + 43200000000 END
  FROM walk w JOIN o ON o.user_id = w.user_id AND o.rn = w.rn + 1),
ends AS (SELECT user_id, deadline FROM walk QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rn DESC) = 1),
fires AS (SELECT user_id, fired FROM walk WHERE fired IS NOT NULL
          UNION ALL SELECT user_id, deadline FROM ends WHERE deadline IS NOT NULL)
SELECT user_id, make_timestamp(fired - 43200000000) AS start_ts, make_timestamp(fired) AS alert_ts FROM fires
"""


@query(RISING_SQL)
def rising_amount_alert(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id", "ts", "c")
    return monitor.rising_amount_alert(rows, "user_id", "c", "ts", ORDER, seconds=12 * 3600)


MONITOR_SQL = f"""
SELECT user_id, CAST(date_trunc('day', ts) AS TIMESTAMP) AS day, bool_or(c > 20000 OR k > 98) AS by_single,
       coalesce(sum(c) FILTER (NOT (c > 20000 OR k > 98)) > 20000
                OR sum(k) FILTER (NOT (c > 20000 OR k > 98)) > 98, false) AS by_sum
FROM ({E}) GROUP BY 1, 2 HAVING by_single OR by_sum
"""


def monitored(spark, folder):
    return monitor.large_transaction_monitor(events(spark, folder), "user_id", "c", "k", "ts", 20_000, 98)


@query(MONITOR_SQL)
def large_transaction_monitor(spark, folder):
    return monitored(spark, folder)


FLAGGED_SQL = f"SELECT DISTINCT 'block_trade' AS set_name, user_id FROM ({MONITOR_SQL})"


@query(FLAGGED_SQL)
def flagged_clients(spark, folder):
    return monitor.flagged_clients(monitored(spark, folder), "user_id")


@query(f"""
SELECT t.event_id, t.tier, coalesce(r.rule, '') || t.event_type AS tagged_name
FROM (SELECT *, CASE WHEN c > 10000 THEN 'high-risk' WHEN c > 5000 THEN 'medium-risk'
                     ELSE 'regular-trading' END AS tier FROM ({E})) t
ASOF LEFT JOIN ({R}) r ON t.tier = r.tier AND t.ts >= r.ts
""")
def risk_tier_tag(spark, folder):
    rows = events(spark, folder).select("event_id", "ts", "event_type", "c")
    tagged = monitor.risk_tier_tag(
        rows, rules(spark, folder), "c", "event_type", "ts", ORDER, 5_000, 10_000
    )
    return tagged.select("event_id", "tier", "tagged_name")


@query(f"""
WITH s AS (SELECT *, CASE WHEN ts > lag(ts) OVER w + INTERVAL '10 hours' OR lag(ts) OVER w IS NULL
                          THEN 1 ELSE 0 END AS opens FROM ({E})
           WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
n AS (SELECT *, CAST(sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS session FROM s)
SELECT user_id, session, event_id, c, CAST(row_number() OVER (
         PARTITION BY user_id, session ORDER BY c DESC, ts, event_id) AS INTEGER) AS rank
FROM n QUALIFY rank <= 3
""")
def top3_with_ttl(spark, folder):
    rows = events(spark, folder).select("user_id", "event_id", "ts", "c")
    return monitor.top_with_ttl(rows, "user_id", "c", "ts", ORDER, ttl="10 HOURS").drop("ts")
