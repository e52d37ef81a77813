"""Keyed state in event-time order: arrival order and batches do not matter, late rows are given back."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators.monitor import rise_machine
from streamlens.operators.ranking import baseline_machine
from streamlens.sources import sinks
from streamlens.sources.files import stream_files
from streamlens.streaming import in_order
from streamlens.streaming.jobs import replay_slices
from test_machines import alerts_by_loop, jumps_by_loop

ROW = "at double, key string, _row string, _x bigint"


def disordered(seed, keys=("a", "b"), count=60, delay=10.0):
    """Rows in the order of arrival, each at most ``delay`` after its time."""
    rng = random.Random(seed)
    rows = [(t + 0.5 * k, key, f"{key}{t:03d}", rng.randrange(100)) for k, key in enumerate(keys) for t in range(count)]
    return [r for _, r in sorted((r[0] + rng.random() * delay, r) for r in rows)]


def run(spark, folder, batches, job, delay="10 seconds"):
    path, out = f"{folder}/in", f"{folder}/out"

    def rows():
        stream = stream_files(spark, path, ROW).withColumn("ts", F.timestamp_micros((F.col("at") * 1e6).cast("long")))
        return job(stream.withWatermark("ts", delay).withColumns({"at": F.unix_micros("ts"), "_at": F.unix_micros("ts")}))

    def start():
        return sinks.write_exactly_once(rows(), out, out + "-c")

    parts = [spark.createDataFrame(b, ROW).coalesce(1) for b in [*batches, [(1e9, None, None, None)]]]
    replay_slices(parts, path, start)
    start().awaitTermination()
    return spark.read.schema(rows().schema).parquet(out).collect()


@pytest.mark.parametrize("slot, chunk", [(2, 10_000), (7, 3)])
def test_eight_batches_in_any_order(spark, tmp_path, monkeypatch, slot, chunk):
    monkeypatch.setattr(in_order, "CHUNK", chunk)
    rows = disordered(slot)
    batches = [rows[i::1][k : k + 15] for i, k in ((0, k) for k in range(0, len(rows), 15))]
    machine = baseline_machine(T.LongType(), T.StringType(), 20)
    got = run(spark, tmp_path, batches, lambda s: in_order.in_order(s, machine, ["_row"], slot, needs=["_row", "_x"]))
    assert len(batches) == 8 and not any(r.late for r in got)
    want = [(k, *hit) for k in "ab" for hit in jumps_by_loop([(r[2], r[3]) for r in sorted(rows) if r[1] == k], 20)]
    assert sorted((r.key, r._id, r.baseline, r._hit) for r in got) == want


def test_deadlines_fire_behind_the_watermark(spark, tmp_path):
    rows = disordered(5)
    machine = rise_machine(T.LongType(), 3_000_000)
    got = run(spark, tmp_path, [rows[:40], rows[40:80], rows[80:]], lambda s: in_order.rising_amounts(s, machine, ["_row"], 1))
    want = [(k, int(d * 1e6)) for k in "ab" for d in alerts_by_loop([(r[0], r[3]) for r in sorted(rows) if r[1] == k], 3)]
    assert sorted((r.key, r._deadline) for r in got) == sorted(want)


def test_rows_behind_a_released_slot_are_given_back(spark, tmp_path):
    machine = baseline_machine(T.LongType(), T.StringType(), 5)
    batches = [[(1.0, "a", "one", 10), (50.0, "a", "two", 30)], [(2.0, "a", "late", 99), (45.0, "a", "mid", 0), (51.0, None, "nokey", 7)]]
    got = run(spark, tmp_path, batches, lambda s: in_order.in_order(s, machine, ["_row"], 2, needs=["_row", "_x"]))
    assert [(r.late_row, r.late_at) for r in got if r.late] == [("late", 2_000_000)]
    assert sorted((r.key or "", r._id, r.baseline) for r in got if not r.late) == [
        ("", "nokey", 0), ("a", "mid", 10), ("a", "one", 0), ("a", "two", 0)]


@pytest.mark.parametrize("fails", [False, True])
def test_rules_between_event_batches_and_a_repeated_batch(spark, tmp_path, fails):
    """Rules come after events they apply to; a batch that failed after it was written comes again."""
    events_at, rules_at, out = (str(tmp_path / n) for n in ("events", "rules", "out"))
    left = [2] if fails else []

    def stamped(path, schema):
        return stream_files(spark, path, schema).withColumn("ts", F.timestamp_seconds("ts"))

    def write(batch, batch_id):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        if batch_id in left:
            left.remove(batch_id)
            raise RuntimeError("lost after the write")

    def start():
        tagged = in_order.rules_asof(
            stamped(events_at, "ts long, tier string, id string"), stamped(rules_at, "ts long, tier string, rule string"),
            "tier", "ts", "rule", "id", "30 seconds", salts=4, slot=1)
        return sinks.write_batches(tagged, write, out + "-c")

    def arrive(events, rules):
        spark.createDataFrame(rules, "ts long, tier string, rule string").write.mode("append").parquet(rules_at)
        spark.createDataFrame(events, "ts long, tier string, id string").write.mode("append").parquet(events_at)
        try:
            start().awaitTermination()
        except Exception as error:
            assert "lost after the write" in str(error)
            start().awaitTermination()

    events = [(t, "hot" if t % 3 else "cold", f"e{t}") for t in range(90)]
    arrive(events[:30], [(0, "hot", "h0")])
    arrive(events[30:60], [(20, "hot", "h20"), (20, "hot", "h20 first")])  # up to 40 seconds after events they apply to
    arrive(events[60:], [(55, "cold", "c55"), (70, "hot", "h70")])
    arrive([(200, "hot", "e200"), (5, "hot", "late")], [(10, "hot", "too old")])
    arrive([(10_000, "none", "end")], [])
    start().awaitTermination()
    got = spark.read.parquet(out).collect()
    rules = {"hot": [(0, "h0"), (20, "h20 first"), (70, "h70")], "cold": [(55, "c55")]}
    want = {f"e{t}": max([r for r in rules[tier] if r[0] <= t], default=(0, ""))[1] for t, tier, _ in [*events, (200, "hot", "")]}
    on_time = {r._id: r.rule for r in got if not r.late}
    assert on_time == want and len([r for r in got if not r.late]) == len(want)
    assert {r.late_row for r in got if r.late and r.late_row} == {"late"}
    assert {r.salt for r in got if r.tier == "hot"} == {0, 1, 2, 3}


@pytest.mark.parametrize("held, chunk", [(0, 3), (20, 10_000)])
def test_keys_that_share_a_bucket(spark, tmp_path, monkeypatch, held, chunk):
    for name, value in {"HELD": held, "CHUNK": chunk, "BUCKETS": 1}.items():
        monkeypatch.setattr(in_order, name, value)
    rows = disordered(11, keys=("a", "b", "c"))
    machine = rise_machine(T.LongType(), 3_000_000)
    # the second batch brings the first row of a quiet key behind what the bucket has released: it is not late
    batches = [rows[:90], [*rows[90:], (1.0, "quiet", "quiet000", 7)]]
    got = run(spark, tmp_path, batches, lambda s: in_order.rising_amounts(s, machine, ["_row"], 1))
    assert not any(r.late for r in got)
    by = {k: [(r[0], r[3]) for r in sorted(rows) if r[1] == k] for k in "abc"} | {"quiet": [(1.0, 7)]}
    assert sorted((r.key, r._deadline) for r in got) == sorted((k, int(d * 1e6)) for k, of in by.items() for d in alerts_by_loop(of, 3))


def test_rows_in_slots_of_their_own_share_entries_of_state(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(in_order, "BUCKETS", 4, raising=False)
    rows = [(100.0 * t, f"k{k}", f"{k} {t}", t) for t in range(20) for k in range(50)]
    spark.createDataFrame(rows, ROW).write.parquet(f"{tmp_path}/in")
    stream = stream_files(spark, f"{tmp_path}/in", ROW).withColumn("ts", F.timestamp_micros((F.col("at") * 1e6).cast("long")))
    timed = stream.withWatermark("ts", "1 day").withColumns({"at": F.unix_micros("ts"), "_at": F.unix_micros("ts")})
    machine = baseline_machine(T.LongType(), T.StringType(), 5)
    job = in_order.in_order(timed, machine, ["_row"], 2, needs=["_row", "_x"])
    query = sinks.write_exactly_once(job, f"{tmp_path}/out", f"{tmp_path}/c")
    query.awaitTermination()
    # an entry per key and slot would be 1,000
    assert query.lastProgress["stateOperators"][0]["numRowsTotal"] <= 50


def test_count_windows_keep_whole_amounts_among_nulls(spark, tmp_path):
    big = 2**60 + 1
    batches = [[(1.0, "a", "one", big), (2.0, "a", "two", None), (3.0, "a", "three", 2), (4.0, "a", "four", None)]]
    got = run(spark, tmp_path, batches, lambda s: in_order.in_order(s, in_order.count_windows(2), ["_row"], 60, needs=["_row"]))
    assert sorted((r.window_no, r.total) for r in got if r.key == "a") == [(0, big), (1, 2)]
