"""The same jobs on streams: stored events are read as a stream to their end, and the rows written
must equal those of the batch query."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens import schemas
from streamlens.functions.scalar import cents
from streamlens.operators import aggregates, dedup, joins, late, monitor, ranking, windows
from streamlens.plans import metrics as M
from streamlens.plans import relations, risk
from streamlens.plans.basic import LATEST_SQL
from streamlens.plans.registry import query, table
from streamlens.session import scratch
from streamlens.sources import committed, sinks
from streamlens.sources.files import json_number, stream_files
from streamlens.streaming import in_order, live, state
from streamlens.streaming.jobs import (
    FLUSH_TIME, EndOfInput, event_time, flush_row, in_slices, newest_changes, plain_time, replay, replay_changes,
    replay_slices, run_to_end,
)

DELAY = "1 hour"
# rows of a micro-batch; bounds what a task holds of a key in one of them
SLICE_ROWS = 2_000_000


def raw(spark, folder):
    """The stored events as a log in time order, ``SLICE_ROWS`` rows per micro-batch.

    Results of a replay then do not depend on how the rows lie in files: no row comes behind the
    watermark, and keyed state sees its rows in order.
    """
    log = in_slices(table(spark, folder, "events"), "ts", SLICE_ROWS)
    if log:
        return stream_files(spark, log, schemas.EVENT, maxFilesPerTrigger="1")
    # one micro-batch; a pattern, since a stream takes a single file only by way of one
    return stream_files(spark, f"{folder}/events.parque[t]", schemas.EVENT)


def events(spark, folder):
    """The columns of ``metrics.events`` as a stream, times as instants."""
    return event_time(
        raw(spark, folder).select(
            "event_id", "ts", "user_id", "event_type", cents(F.col("value")).alias("c"),
            json_number(F.col("props"), "$.k").alias("k"),
        )
    )


def views(spark, folder):
    return events(spark, folder).where(F.col("event_type") == "view")


def timed(stream, end, **values):
    """Stream with its watermark, which ``end`` will close."""
    return late.with_event_time(end.after(stream, "ts", **values), "ts", DELAY)


def arriving(spark, folder, slices=4):
    """Events by arrival, cut into a few slices of time, then a flush row."""
    rows = risk.arrivals(spark, folder)
    us = F.unix_micros(F.col("arrival").cast("timestamp"))
    ends = rows.agg(F.min(us).alias("a"), F.max(us).alias("z")).first()
    step = (ends.z - ends.a) // slices
    at = [F.timestamp_micros(F.lit(ends.a + i * step)).cast("timestamp_ntz") for i in range(slices)]
    for i in range(slices):
        part = rows.where(F.col("arrival") >= at[i])
        yield part if i == slices - 1 else part.where(F.col("arrival") < at[i + 1])
    yield flush_row(spark, rows.schema, "ts", arrival=FLUSH_TIME)


ARRIVING = f"{schemas.CENT_EVENT}, arrival TIMESTAMP_NTZ"


def arrived(spark, path):
    return event_time(stream_files(spark, path, ARRIVING).drop("arrival"))


# ---- sinks


@query("SELECT event_id, ts, user_id, event_type, value, props FROM events")
def write_exactly_once(spark, folder):
    return replay(raw(spark, folder), "copy")


@query("""
SELECT event_id, user_id, event_type, CAST(round(value * 100) AS BIGINT) AS c FROM events WHERE event_id >= 100
""")
def committed_files_stream(spark, folder):
    """Through a source and sink of one's own: a stream into committed files, those as a stream into others."""
    committed.register(spark)
    first, second = scratch(spark, "committed"), scratch(spark, "committed")
    rows = events(spark, folder).select("event_id", "user_id", "event_type", "c")

    def copied(stream, path):
        sinks.write_source(stream, "committed", path, path + "-checkpoint").awaitTermination()

    def stored(reader, path):
        return reader.format("committed").schema(rows.schema).load(path)

    copied(rows, first)
    copied(stored(spark.readStream, first), second)
    return stored(spark.read, second).where("event_id >= 100")


@query(LATEST_SQL)
def latest_value_table_stream(spark, folder):
    rows = raw(spark, folder).select("user_id", "event_id", "ts", "event_type", "value")
    newest = sinks.latest_value_table(rows, ["user_id"], ["ts", "event_id"])
    return replay_changes(newest, "latest", ["user_id"])


@query("SELECT DISTINCT event_type, user_id FROM events")
def distinct_set_table_stream(spark, folder):
    return replay(dedup.dedup_keys(raw(spark, folder), ["event_type", "user_id"]), "set")


# ---- several streams


@query(relations.WINDOW_JOIN_SQL)
def window_join_stream(spark, folder):
    end = EndOfInput()
    sides = [
        timed(events(spark, folder).where(F.col("event_type") == t), end) for t in ("click", "purchase")
    ]
    joined = joins.window_join(*sides, "user_id", "ts", "1 day", relations.join_columns())
    return replay(joined, "window-join", end)


@query(relations.CONNECT_SQL)
def connect_map_stream(spark, folder):
    parts = table(spark, folder, "part")
    schema = ", ".join(f"{n} {t}" for n, t in parts.dtypes)
    names = stream_files(spark, f"{folder}/part.parque[t]", schema)
    both = joins.connect_map(events(spark, folder), names, F.col("event_id"), F.col("p_name"))
    return replay(both, "connect")


@query("""
SELECT event_id, user_id FROM events WHERE event_type = 'view'
UNION ALL SELECT event_id, user_id FROM events
""")
def union_streams_stream(spark, folder):
    both = dedup.union_streams(views(spark, folder), events(spark, folder))
    return replay(both.select("event_id", "user_id"), "union")


@query(relations.ASOF_SQL)
def rules_asof_join_stream(spark, folder):
    rules_path, out = scratch(spark, "rules"), scratch(spark, "tagged")
    relations.rules(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")).write.parquet(rules_path)
    tier = F.when(F.col("c") > 10_000, "high-risk").when(F.col("c") > 5_000, "medium-risk")
    rows = events(spark, folder).select("event_id", "ts", "c").withColumn(
        "tier", tier.otherwise("regular-trading")
    )
    write = live.tag_with_rules(out, rules_path, "tier", "ts", ["ts", "event_id"])
    sinks.write_batches(rows, write, out + "-checkpoint").awaitTermination()
    return spark.read.parquet(out).select("event_id", "tier", "rule")


# ---- totals


@query(f"SELECT user_id, CAST(sum(c) AS BIGINT) AS running FROM ({M.E}) GROUP BY user_id")
def running_sum_by_key_stream(spark, folder):
    sums = aggregates.reduce_by_key(events(spark, folder), ["user_id"], "c", "running")
    return replay_changes(sums, "running", ["user_id"])


@query("SELECT count(*) AS records FROM events")
def record_count_stream(spark, folder):
    counted = aggregates.record_count(events(spark, folder))
    return replay_changes(counted, "records", [])


@query("""
SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, event_id, event_type FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY ts, event_id) = 1
""")
def keep_first_by_key_stream(spark, folder):
    end = EndOfInput()
    rows = timed(events(spark, folder), end)
    first = windows.first_per_window(
        rows, "ts", "1 day", "user_id", ["event_id", "event_type"], M.ORDER
    )
    out = first.select("user_id", F.col("window_start").alias("day"), "event_id", "event_type")
    return plain_time(replay(out, "first", end))


@query(f"""
SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS day, CAST(sum(c) AS BIGINT) AS amount,
       CAST(sum(k) AS BIGINT) AS transfer, max(ts) AS last_ts FROM ({M.E}) GROUP BY ALL
""")
def daily_client_totals_stream(spark, folder):
    end = EndOfInput()
    totals = aggregates.daily_client_totals(timed(events(spark, folder), end), "user_id", "c", "k", "ts")
    return plain_time(replay(totals, "daily", end))


# ---- windows


TUMBLING_SQL = """
SELECT time_bucket(INTERVAL '1 hour', ts) AS window_start,
       time_bucket(INTERVAL '1 hour', ts) + INTERVAL '1 hour' AS window_end, count(*) AS n
FROM events GROUP BY ALL
"""


@query(TUMBLING_SQL)
def tumbling_count_stream(spark, folder):
    end = EndOfInput()
    counted = windows.windowed_count(timed(events(spark, folder), end), "ts", "1 hour")
    return plain_time(replay(counted, "tumbling", end))


@query(TUMBLING_SQL)
def out_of_order_count_stream(spark, folder):
    """Rows arrive up to an hour late, over several micro-batches; the watermark waits for them."""
    path, out = scratch(spark, "arriving"), scratch(spark, "disorder")

    def counted():
        rows = late.with_event_time(arrived(spark, path), "ts", DELAY)
        return windows.windowed_count(rows, "ts", "1 hour")

    def start():
        return sinks.write_exactly_once(counted(), out, out + "-checkpoint")

    replay_slices(arriving(spark, folder), path, start)
    return plain_time(spark.read.schema(counted().schema).parquet(out))


@query(TUMBLING_SQL)
def ordered_time_count_stream(spark, folder):
    """Rows in time order: the watermark follows without delay."""
    end = EndOfInput()
    rows = late.with_ordered_time(end.after(events(spark, folder)), "ts")
    return plain_time(replay(windows.windowed_count(rows, "ts", "1 hour"), "ordered", end))


@query(M.sliding_sql(M.E, "1 hour", "10 minutes", "", "n"))
def sliding_count_stream(spark, folder):
    end = EndOfInput()
    counted = windows.sliding_count_chained(timed(events(spark, folder), end), "ts", "1 hour", "10 minutes")
    return plain_time(replay(counted, "sliding", end))


@query(f"""
SELECT time_bucket(INTERVAL '8 hours', ts) AS window_start,
       time_bucket(INTERVAL '8 hours', ts) + INTERVAL '8 hours' AS window_end, user_id,
       arg_min(event_id, event_id) AS event_id, arg_min(event_type, event_id) AS event_type, count(*) AS n
FROM ({M.E}) GROUP BY 1, 2, 3
""")
def tumbling_event_count_stream(spark, folder):
    end = EndOfInput()
    counted = windows.first_and_count(
        timed(events(spark, folder), end), "ts", "8 hours", "user_id", ["event_id", "event_type"], ["event_id"]
    )
    return plain_time(replay(counted, "event-count", end))


@query(M.PV_SQL)
def windowed_pv_stream(spark, folder):
    end = EndOfInput()
    return plain_time(replay(windows.windowed_pv(timed(views(spark, folder), end), "ts"), "pv", end))


@query(M.UV_SQL)
def windowed_uv_stream(spark, folder):
    end = EndOfInput()
    hour = timed(views(spark, folder), end).select(F.window("ts", "1 hour").alias("window"), "user_id")
    users = hour.dropDuplicates(["window", "user_id"])
    counted = users.groupBy("window").agg(F.count("user_id").alias("uv")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "uv"
    )
    return plain_time(replay(counted, "uv", end))


def hot_stream(spark, folder, size, slide):
    end, out = EndOfInput(), scratch(spark, "hot")
    counts = windows.sliding_count_chained(
        timed(views(spark, folder), end), "ts", size, slide, ["k"], "views"
    )
    write = live.rank_batches(
        out, ["window_start", "window_end"], [F.col("views").desc(), F.col("k")], 3
    )
    run_to_end(lambda: sinks.write_batches(counts, write, out + "-checkpoint"), end)
    rows = spark.read.parquet(out).drop("batch")
    return plain_time(rows)


@query(M.hot_sql("k", "1 hour", "5 minutes"))
def hot_pages_stream(spark, folder):
    return hot_stream(spark, folder, "1 hour", "5 minutes")


@query(M.hot_sql("k", "6 hours", "30 minutes"))
def hot_categories_stream(spark, folder):
    return hot_stream(spark, folder, "6 hours", "30 minutes")


@query(M.HEAT_SQL)
def category_heat_stream(spark, folder):
    end = EndOfInput()
    counted = windows.sliding_count_chained(
        timed(views(spark, folder), end), "ts", "1 hour", "5 minutes", ["k"], "heat"
    )
    out = counted.select("k", "heat", F.col("window_end").alias("windowend"))
    return plain_time(replay(out, "heat", end))


# ---- keyed state


def machine_rows(stream, x):
    return stream.select(
        F.col("user_id").alias("key"), F.col("event_id").alias("id"),
        F.unix_micros("ts").alias("at"), x.alias("x"),
    )


@query(M.COUNT_WINDOW_SQL)
def count_window_stream(spark, folder):
    rows = machine_rows(events(spark, folder), F.col("c").cast("double"))
    out = replay(state.keyed(rows, state.CountWindow(3)), "count-window")
    return out.withColumnRenamed("key", "user_id")


@query(M.TOP_TRANSACTIONS_SQL)
def top3_transactions_stream(spark, folder):
    rows = machine_rows(events(spark, folder), F.col("c").cast("double"))
    out = replay_changes(state.keyed(rows, state.TopTransactions(3), mode="Update"), "top", ["key", "rank"])
    return out.select(
        F.col("key").alias("user_id"), F.col("id").alias("event_id"),
        F.col("x").cast("bigint").alias("c"), "rank",
    )


@query(f"""
SELECT user_id, k AS product, c AS amount,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY c DESC, k) AS INTEGER) AS rank
FROM (SELECT user_id, k, max(c) AS c FROM ({M.E}) GROUP BY ALL) QUALIFY rank <= 3
""")
def top3_products_stream(spark, folder):
    rows = events(spark, folder).select(
        F.col("user_id").alias("key"), F.col("k").alias("product"), F.col("c").alias("x")
    )
    out = replay_changes(state.keyed(rows, state.TopProducts(3), mode="Update"), "products", ["key", "rank"])
    return out.select(
        F.col("key").alias("user_id"), "product", F.col("x").alias("amount"), "rank"
    )


@query(M.BASELINE_SQL)
def baseline_jump_stream(spark, folder):
    rows = machine_rows(events(spark, folder), F.col("c").cast("double"))
    out = replay(state.keyed(rows, state.BaselineJump(10_000)), "baseline")
    return out.select(
        F.col("key").alias("user_id"), F.col("id").alias("event_id"), "baseline", F.col("x").alias("amount")
    )


@query(risk.RISING_SQL)
def rising_amount_alert_stream(spark, folder):
    end = EndOfInput()
    rows = machine_rows(timed(events(spark, folder), end).select("user_id", "event_id", "ts", "c"),
                        F.col("c").cast("double"))
    alerts = replay(state.keyed(rows, state.RisingAmount(12 * 3600), "EventTime"), "rising", end)
    return alerts.select(
        F.col("key").alias("user_id"),
        F.timestamp_micros("start_us").cast("timestamp_ntz").alias("start_ts"),
        F.timestamp_micros("alert_us").cast("timestamp_ntz").alias("alert_ts"),
    )


# ---- keyed state in event-time order, from rows that arrive up to an hour late


def unordered(spark, folder, label, job):
    """What ``job`` gives for events that arrive out of order, in several micro-batches; none of them is late."""
    path, out = scratch(spark, "arriving"), scratch(spark, label)

    def rows():
        found = late.with_event_time(arrived(spark, path), "ts", DELAY)
        return job(found.select(
            F.col("user_id").alias("key"), F.unix_micros("ts").alias("at"), F.unix_micros("ts").alias("_at"),
            F.col("event_id").alias("_row"), F.col("c").alias("_x"), "event_type",
        ))

    def start():
        return sinks.write_exactly_once(rows(), out, out + "-checkpoint")

    replay_slices(arriving(spark, folder), path, start)
    start().awaitTermination()  # timers fire behind the last row's watermark
    return spark.read.schema(rows().schema).parquet(out).where("NOT late")


@query(M.BASELINE_SQL)
def baseline_jump_unordered_stream(spark, folder):
    machine = ranking.baseline_machine(T.DoubleType(), T.LongType(), 10_000)

    def job(rows):
        return in_order.in_order(rows.withColumn("_x", F.col("_x").cast("double")), machine, ["_row"], needs=["_row", "_x"])

    out = unordered(spark, folder, "baseline", job)
    return out.select(F.col("key").alias("user_id"), F.col("_id").alias("event_id"), "baseline", F.col("_hit").alias("amount"))


@query(risk.RISING_SQL)
def rising_amount_unordered_stream(spark, folder):
    wait = 12 * 3600 * 1_000_000
    machine = monitor.rise_machine(T.LongType(), wait)
    out = unordered(spark, folder, "rising", lambda rows: in_order.rising_amounts(rows, machine, ["_row"]))
    return out.select(
        F.col("key").alias("user_id"),
        F.timestamp_micros(F.col("_deadline") - wait).cast("timestamp_ntz").alias("start_ts"),
        F.timestamp_micros("_deadline").cast("timestamp_ntz").alias("alert_ts"),
    )


@query(M.COUNT_WINDOW_SQL)
def count_window_unordered_stream(spark, folder):
    out = unordered(spark, folder, "count-window",
                    lambda rows: in_order.in_order(rows, in_order.count_windows(3), ["_row"], needs=["_row"]))
    return out.select(F.col("key").alias("user_id"), "window_no", "total")


@query(f"SELECT user_id, first_id, last_id, next_id FROM ({risk.times_sql(2)})")
def pattern_times_unordered_stream(spark, folder):
    """Two views, then a purchase directly after the second."""
    def job(rows):
        kind = F.col("event_type")
        marked = rows.withColumns({"_start": kind == "view", "_follows": kind == "purchase"})
        return in_order.in_order(marked, in_order.times_next(2, T.LongType()), ["_row"], needs=["_row", "_start"])

    out = unordered(spark, folder, "pattern", job)
    return out.select(F.col("key").alias("user_id"), "first_id", "last_id", "next_id")


@query(relations.ASOF_SQL)
def rules_live_stream(spark, folder):
    """Events and rules are two streams; both arrive up to an hour late, in turn."""
    events_at, rules_at, out = (scratch(spark, label) for label in ("arriving", "rules", "tagged"))
    tier = F.element_at(F.array(*map(F.lit, ("high-risk", "medium-risk", "regular-trading"))), (F.col("event_id") % 3 + 1).cast("int"))

    def tagged():
        by_value = F.when(F.col("c") > 10_000, "high-risk").when(F.col("c") > 5_000, "medium-risk").otherwise("regular-trading")
        rows = arrived(spark, events_at).withColumn("tier", by_value)
        rules = event_time(stream_files(spark, rules_at, "ts TIMESTAMP_NTZ, tier STRING, rule STRING"))
        return in_order.rules_asof(rows, rules, "tier", "ts", "rule", "event_id", DELAY)

    def start():
        return sinks.write_exactly_once(tagged(), out, out + "-checkpoint")

    spark.createDataFrame([], "ts TIMESTAMP_NTZ, tier STRING, rule STRING").write.parquet(rules_at)
    for part in arriving(spark, folder):
        told = part.where("event_type = 'error'")
        told.select("ts", tier.alias("tier"), F.concat(F.lit("rule "), F.col("event_id")).alias("rule")).write.mode("append").parquet(rules_at)
        part.write.mode("append").parquet(events_at)
        start().awaitTermination()
    start().awaitTermination()
    found = spark.read.schema(tagged().schema).parquet(out).where("NOT late")
    return found.select(F.col("_id").alias("event_id"), "tier", "rule")


# ---- patterns


def live_matches(spark, folder, seconds=None):
    """Two views, then a purchase directly after the second."""
    rows = events(spark, folder).select(
        F.col("user_id").alias("key"), F.col("event_id").alias("id"), F.unix_micros("ts").alias("at"),
        (F.col("event_type") == "view").alias("start"), (F.col("event_type") == "purchase").alias("follows"),
    )
    out = replay(state.keyed(rows, state.TimesNext(2, seconds)), "pattern")
    return out.select(F.col("key").alias("user_id"), "first_id", "last_id", "next_id")


@query(f"SELECT user_id, first_id, last_id, next_id FROM ({risk.times_sql(2)})")
def pattern_times_next_stream(spark, folder):
    return live_matches(spark, folder)


@query(f"""
SELECT user_id, first_id, last_id, next_id FROM ({risk.times_sql(2)})
WHERE next_ts - first_ts < INTERVAL '2 days'
""")
def pattern_within_stream(spark, folder):
    return live_matches(spark, folder, 2 * 86_400)


# ---- monitoring and late data


@query(risk.MONITOR_SQL)
def large_transaction_monitor_stream(spark, folder):
    end = EndOfInput()
    found = monitor.large_transaction_monitor(
        timed(events(spark, folder), end, c=0, k=0), "user_id", "c", "k", "ts", 20_000, 98
    )
    return plain_time(replay(found, "monitor", end))


@query(risk.FLAGGED_SQL)
def flagged_clients_stream(spark, folder):
    end = EndOfInput()
    found = monitor.large_transaction_monitor(
        timed(events(spark, folder), end, c=0, k=0), "user_id", "c", "k", "ts", 20_000, 98
    )
    return replay(monitor.flagged_clients(found, "user_id"), "flagged", end)


@query(TUMBLING_SQL)
def late_refire_stream(spark, folder):
    """Each late row gives its window again; the newest row per window is the final count."""
    path, out = scratch(spark, "arriving"), scratch(spark, "refire")

    def counted():
        rows = late.with_event_time(arrived(spark, path), "ts", DELAY)
        return windows.windowed_count(rows, "ts", "1 hour")

    def start():
        return sinks.write_batches(counted(), sinks.batch_files(out), out + "-checkpoint", "update")

    replay_slices(arriving(spark, folder), path, start)
    newest = newest_changes(spark, out, counted(), ["window_start", "window_end"])
    return plain_time(newest.where(F.col("window_start") < F.lit(FLUSH_TIME)))


@query(f"SELECT event_id, window_start, window_end, late_class FROM ({risk.CLASS_SQL})")
def late_classes_stream(spark, folder):
    path, out = scratch(spark, "arriving"), scratch(spark, "late")
    write = live.route_late(out, "ts", risk.ARRIVAL, "1 hour", "10 MINUTES", "10 MINUTES")

    def start():
        rows = stream_files(spark, path, ARRIVING).select("event_id", "user_id", "ts", "arrival")
        return sinks.write_batches(rows.where("event_id IS NOT NULL"), write, out + "-checkpoint")

    replay_slices(arriving(spark, folder), path, start)
    return spark.read.parquet(f"{out}/rows").select(
        "event_id", "window_start", "window_end", "late_class"
    )
