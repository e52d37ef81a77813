import glob
import time
from datetime import datetime, timedelta

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from helpers import rows
from streamlens.operators import aggregates, dedup, late, windows
from streamlens.sources import sinks
from streamlens.sources.files import read_rules_stream, stream_files
from streamlens.streaming import jobs, live, state
from streamlens.streaming.jobs import (
    StreamJobConfig, event_time, newest_changes, replay_slices, run_with_restarts,
)

T0 = datetime(2024, 1, 1)
SCHEMA = "ts TIMESTAMP_NTZ, k BIGINT, id BIGINT"


def part(spark, items):
    data = [(T0 + timedelta(seconds=t), k, i) for t, k, i in items]
    return spark.createDataFrame(data, SCHEMA).coalesce(1)


def flush(spark):
    return spark.createDataFrame([(datetime(2200, 1, 1), None, None)], SCHEMA)


def test_restart_counts_each_row_once(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def counted():
        return aggregates.record_count(stream_files(spark, path, "id BIGINT"))

    def start():
        return sinks.write_batches(counted(), sinks.batch_files(out), out + "-c", "update")

    replay_slices([spark.range(10), spark.range(5), spark.range(7)], path, start)
    assert newest_changes(spark, out, counted(), []).first().records == 22


def test_files_are_written_once_across_restarts(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def start():
        return sinks.write_exactly_once(stream_files(spark, path, "id BIGINT"), out, out + "-c")

    replay_slices([spark.range(10), spark.range(10, 20)], path, start)
    start().awaitTermination()
    assert rows(spark.read.parquet(out)) == rows(spark.range(20))


def test_failed_query_starts_again(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(6).write.parquet(path)
    failures = []

    def write(batch, batch_id):
        if not failures:
            failures.append(batch_id)
            raise RuntimeError("lost")
        sinks.batch_files(out)(batch, batch_id)

    begun = time.time()
    run_with_restarts(
        lambda: sinks.write_batches(stream_files(spark, path, "id BIGINT"), write, out + "-c"), delay=2
    )
    assert time.time() - begun > 2
    assert failures == [0] and spark.read.parquet(out).count() == 6


def test_watermark_drops_what_is_too_late(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def start():
        stream = late.with_event_time(event_time(stream_files(spark, path, SCHEMA)), "ts", "2 seconds")
        return sinks.write_exactly_once(windows.windowed_count(stream, "ts", "10 seconds"), out, out + "-c")

    slices = [part(spark, [(1, 1, 1), (15, 1, 2)]), part(spark, [(2, 1, 3), (16, 1, 4)]), flush(spark)]
    replay_slices(slices, path, start)
    got = rows(spark.read.parquet(out).select(F.col("window_start").cast("string"), "n"))
    assert got == [("2024-01-01 00:00:00", 1), ("2024-01-01 00:00:10", 2)]


def test_panes_over_batches_equal_batch(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    items = [(t * 7 % 40 + 40 * (t // 40), t % 3, t) for t in range(160)]

    def counted():
        stream = late.with_event_time(event_time(stream_files(spark, path, SCHEMA)), "ts", "60 seconds")
        return windows.sliding_count_chained(stream, "ts", "20 seconds", "5 seconds", ["k"])

    def start():
        return sinks.write_exactly_once(counted(), out, out + "-c")

    slices = [part(spark, items[i:i + 40]) for i in range(0, 160, 40)]
    replay_slices([*slices, flush(spark)], path, start)
    want = windows.sliding_count(event_time(part(spark, items)), "ts", "20 seconds", "5 seconds", ["k"])
    assert rows(spark.read.parquet(out)) == rows(want)


def test_late_rows_are_kept_apart(spark, tmp_path):
    """The watermark goes on across micro-batches, and no row is lost."""
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    write = live.route_late(out, "ts", ["seen", "id"], "10 seconds", "2 SECONDS", "5 SECONDS")

    def start():
        stream = stream_files(spark, path, SCHEMA)
        seen = F.timestamp_seconds("id").cast("timestamp_ntz")
        return sinks.write_batches(stream.withColumn("seen", seen), write, out + "-c")

    slices = [part(spark, [(1, 1, 1), (13, 1, 2)]), part(spark, [(2, 1, 3), (18, 1, 4), (3, 1, 5)])]
    replay_slices(slices, path, start)
    got = {r.id: r.late_class for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {1: "on_time", 2: "on_time", 3: "late_refire", 4: "on_time", 5: "side_output"}


def test_rules_stream(spark, tmp_path):
    (tmp_path / "r.txt").write_text("high-risk:call\nnothing\nmedium-risk:mail\n")
    query = sinks.write_exactly_once(
        read_rules_stream(spark, str(tmp_path)), str(tmp_path / "o"), str(tmp_path / "c")
    )
    query.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "o"))) == [("high-risk", "call"), ("medium-risk", "mail")]


def test_recent_dedup_lets_a_key_return(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def start():
        stream = late.with_event_time(event_time(stream_files(spark, path, SCHEMA)), "ts", "2 seconds")
        return sinks.write_exactly_once(dedup.dedup_recent(stream, ["k"]), out, out + "-c")

    replay_slices(
        [part(spark, [(1, 7, 1), (2, 7, 2)]), part(spark, [(60, 8, 3)]), part(spark, [(61, 7, 4)])], path, start
    )
    assert sorted(r.id for r in spark.read.parquet(out).collect()) in ([1, 3, 4], [2, 3, 4])


def machine(spark, tmp_path, slices, processor, mode="Append", time_mode="None"):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def keyed():
        stream = late.with_event_time(event_time(stream_files(spark, path, SCHEMA)), "ts", "0 seconds")
        rows_ = stream.select(
            F.col("k").alias("key"), "id", F.unix_micros("ts").alias("at"), F.col("id").cast("double").alias("x")
        )
        return state.keyed(rows_, processor, time_mode, mode)

    def start():
        if mode == "Update":
            return sinks.write_batches(keyed(), sinks.batch_files(out), out + "-c", "update")
        return sinks.write_exactly_once(keyed(), out, out + "-c")

    replay_slices(slices, path, start)
    if mode == "Update":
        return newest_changes(spark, out, keyed(), ["key", "rank"])
    return spark.read.schema(keyed().schema).parquet(out)


def test_count_window_goes_on_after_a_restart(spark, tmp_path):
    slices = [part(spark, [(i, 1, i) for i in (1, 2)]), part(spark, [(i, 1, i) for i in (3, 4, 5, 6, 7)])]
    assert rows(machine(spark, tmp_path, slices, state.CountWindow(3))) == [(1, 0, 6), (1, 1, 15)]


def test_top_list_over_batches(spark, tmp_path):
    slices = [part(spark, [(i, 1, i) for i in (5, 9, 1)]), part(spark, [(10, 1, 7), (11, 2, 3)])]
    out = machine(spark, tmp_path, slices, state.TopTransactions(3), "Update")
    assert rows(out) == [(1, 1, 9, 9.0), (1, 2, 7, 7.0), (1, 3, 5, 5.0), (2, 1, 3, 3.0)]


def test_rising_timer_fires_and_is_cancelled(spark, tmp_path):
    # x is the id: client 1 rises and stays silent, client 2 falls in time, in the next batch
    slices = [part(spark, [(0, 1, 5), (0, 2, 5)]), part(spark, [(3, 2, 4)]), flush(spark)]
    out = machine(spark, tmp_path, slices, state.RisingAmount(5), time_mode="EventTime")
    assert [(r.key, r.alert_us - r.start_us) for r in out.collect()] == [(1, 5_000_000)]


def test_time_to_live_drops_the_list(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    part(spark, [(1, 1, 9)]).write.mode("append").parquet(path)
    rows_ = stream_files(spark, path, SCHEMA).select(
        F.col("k").alias("key"), "id", F.col("id").cast("double").alias("x")
    )
    kept = state.keyed(rows_, state.TopTransactions(3, ttl_ms=3000), "ProcessingTime", "Update")
    query = sinks.write_batches(kept, sinks.batch_files(out), out + "-c", "update", processingTime="1 second")

    def wait_for(row_id):
        end = time.time() + 90
        while time.time() < end:
            assert query.exception() is None
            try:
                found = spark.read.parquet(out).where(F.col("id") == row_id).select("batch").collect()
            except Exception:
                found = []
            if found:
                batch = found[0].batch
                return rows(spark.read.parquet(out).where(F.col("batch") == batch).select("rank", "id"))
            time.sleep(0.5)
        pytest.fail("no output in time")

    try:
        assert wait_for(9) == [(1, 9)]
        time.sleep(6)
        part(spark, [(2, 1, 4)]).write.mode("append").parquet(path)
        assert wait_for(4) == [(1, 4)]
    finally:
        query.stop()


def test_wall_clock_windows_count_all_rows(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(12).write.parquet(path)
    clocked = windows.processing_time(stream_files(spark, path, "id BIGINT"))
    counted = windows.windowed_count(clocked, "ts", "5 seconds")
    sinks.write_batches(counted, sinks.batch_files(out), out + "-c", "update").awaitTermination()
    assert spark.read.parquet(out).agg(F.sum("n")).first()[0] == 12


def test_job_settings(spark, tmp_path):
    config = StreamJobConfig(str(tmp_path), every="1 second", retain=7).apply(spark)
    assert spark.conf.get("spark.sql.streaming.minBatchesToRetain") == "7"
    assert config.trigger() == {"processingTime": "1 second"}
    spark.conf.unset("spark.sql.streaming.minBatchesToRetain")


SECOND = 1_000_000
BIG = 9_007_199_254_740_993
NULLS = [
    ("c", "a", 1, 5), ("c", "b", 2 * SECOND, BIG), ("c", "n", 3 * SECOND, None), ("c", None, 4 * SECOND, 7),
    ("c", "d", 5 * SECOND, 6),
]


@pytest.mark.parametrize("processor, mode, want", [
    (state.CountWindow(2), "Append", [("c", 0, BIG + 5), ("c", 1, 6)]),
    (state.BaselineJump(3), "Append", [("c", "a", 0, 5), ("c", "b", 5, BIG), ("c", "d", BIG, 6)]),
    (state.TopTransactions(2), "Update", [("c", 1, "b", BIG), ("c", 2, "d", 6)]),
    (state.TopProducts(2), "Update", [("c", 1, "b", BIG), ("c", 2, "d", 6)]),
    # the row after a deadline fires it and, as a rise, sets the next; the null at 3 s cancels nothing
    (state.RisingAmount(1), "Append", [("c", 1, SECOND + 1), ("c", 2 * SECOND, 3 * SECOND)]),
])
def test_text_keys_whole_amounts_and_nulls(spark, tmp_path, processor, mode, want):
    path, out, schema = str(tmp_path / "in"), str(tmp_path / "out"), "key string, id string, at bigint, x bigint"
    spark.createDataFrame(NULLS, schema).coalesce(1).write.parquet(path)
    stream = stream_files(spark, path, schema).withColumns({"product": F.col("id"), "ts": F.timestamp_micros("at")})
    time_mode = "EventTime" if isinstance(processor, state.RisingAmount) else "None"
    found = state.keyed(stream.withWatermark("ts", "0 seconds"), processor, time_mode, mode)
    sinks.write_batches(found, sinks.batch_files(out), out + "-c", mode.lower()).awaitTermination()
    assert rows(spark.read.parquet(out).select(*found.columns)) == want


def test_many_keys_share_entries_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "BUCKETS", 2, raising=False)
    monkeypatch.setattr(state, "PARTS", 3, raising=False)
    rows = spark.range(400).selectExpr("concat('k', id % 200) AS key", "id", "id AS at", "id AS x")
    rows.write.parquet(f"{tmp_path}/in")
    stream = stream_files(spark, f"{tmp_path}/in", "key string, id long, at long, x long")
    query = sinks.write_exactly_once(state.keyed(stream, state.CountWindow(3)), f"{tmp_path}/out", f"{tmp_path}/c")
    query.awaitTermination()
    # an entry per key would be 200
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 20
    spark.range(1).selectExpr("'k7' AS key", "9L AS id", "500L AS at", "100L AS x").write.mode("append").parquet(f"{tmp_path}/in")
    sinks.write_exactly_once(state.keyed(stream, state.CountWindow(3)), f"{tmp_path}/out", f"{tmp_path}/c").awaitTermination()
    assert [tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("k7", 0, 7 + 207 + 100)]


def test_a_slice_of_a_log_is_read_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(jobs, "GROUP_BYTES", 64 << 10, raising=False)
    stored = spark.range(200_000).select(F.timestamp_micros(F.col("id") * 1000).alias("ts"), F.rand(1).alias("x"))
    log = jobs.in_slices(stored, "ts", 100_000)
    files = sorted(glob.glob(f"{log}/*.parquet"))
    assert len(files) == 2 and all(pq.ParquetFile(f).metadata.num_row_groups > 1 for f in files)
    assert spark.read.parquet(log).count() == 200_000
