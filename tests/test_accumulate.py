"""Accumulators, bitmaps of users, and totals flushed on the wall clock."""

import sys
import time

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators import accumulate, bitmaps, windows
from streamlens.sources import sinks
from streamlens.sources.files import stream_files
from streamlens.streaming import state

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # the accumulator below is the user's own code


class Longest(accumulate.Accumulator):
    """The longest text and how often it came, the first by name of equal length."""

    inputs = ("_t",)
    state = T.StructType([T.StructField("text", T.StringType()), T.StructField("n", T.LongType())])
    out = state

    def create(self):
        return {"text": None, "n": 0}

    def add(self, state, rows):
        for t in rows["_t"]:
            state = self.merge(state, {"text": t, "n": 1})
        return state

    def merge(self, a, b):
        if a["text"] is None or b["text"] is None:
            return b if a["text"] is None else a
        if a["text"] == b["text"]:
            return {"text": a["text"], "n": a["n"] + b["n"]}
        return min(a, b, key=lambda s: (-len(s["text"]), s["text"]))

    def result(self, state):
        return state


@pytest.mark.parametrize("width, held", [(64, 100_000), (2, 3)])
def test_own_accumulator_and_a_hot_key_over_many_tasks(spark, monkeypatch, width, held):
    monkeypatch.setattr(accumulate, "WIDTH", width)
    monkeypatch.setattr(accumulate, "HELD", held)
    kept, pin = [], accumulate.pin
    monkeypatch.setattr(accumulate, "pin", lambda df, label: kept.append(pin(df, label)) or kept[-1])
    rows = spark.range(0, 3000, 1, 9).selectExpr(
        "CASE WHEN id % 3 > 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL ELSE concat('k', id % 11) END AS k",
        "CASE WHEN id % 50 = 1 THEN NULL ELSE repeat(chr(97 + cast(id % 5 AS int)), cast(1 + id % 13 AS int)) END AS _t")
    got = {r.k: (r.text, r.n) for r in accumulate.accumulate(rows, ["k"], Longest()).collect()}
    want = {}
    for r in rows.collect():
        if r._t is not None:
            old = want.get(r.k)
            want[r.k] = (r._t, 1) if old is None or (-len(r._t), r._t) < (-len(old[0]), old[0]) else (old[0], old[1] + (old[0] == r._t))
    assert got == want and None in got
    # the hot key left every task as states, not as rows
    first = kept[0].where("k = 'hot'")
    assert first.select("_task").distinct().count() == 9 and first.count() < 9 * 20
    assert len(kept) == (1 if width == 64 else 4)


def test_accumulate_without_keys_and_rows(spark):
    rows = spark.range(100).select(F.col("id").cast("double").alias("_x"), F.lit(5).cast("long").alias("_at"))
    mean = accumulate.DecayedMean(1000)
    assert [r["mean"] for r in accumulate.accumulate(rows, [], mean).collect()] == [49.5]
    assert accumulate.accumulate(rows.limit(0), [], mean).count() == 0


def test_merge_does_not_depend_on_order():
    mean, rng = accumulate.DecayedMean(7.0), np.random.default_rng(1)
    x, at = rng.normal(size=50), rng.integers(0, 100, 50)
    whole = mean.add(mean.create(), {"_x": x, "_at": at})
    parts = [mean.add(mean.create(), {"_x": x[i::5], "_at": at[i::5]}) for i in (3, 0, 4, 1, 2)]
    total = mean.create()
    for p in parts:
        total = mean.merge(total, p)
    assert mean.result(total)["mean"] == pytest.approx(mean.result(whole)["mean"])


@pytest.mark.parametrize("max_rows", [1_000_000, 7])
def test_bitmaps_of_later_days_merge_with_earlier_ones(spark, max_rows):
    rows = spark.range(4000).selectExpr(
        "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 60) AS ts",
        "CASE WHEN id % 9 = 0 THEN NULL ELSE concat('u', id * id % 1013) END AS user")
    first, later = rows.where("ts < '2024-01-02 05:00'"), rows.where("ts >= '2024-01-02 05:00'")
    numbers = bitmaps.user_numbers(first, "user", max_rows=max_rows)
    more = bitmaps.user_numbers(later, "user", numbers, max_rows)
    assert more.join(numbers, ["user", "no"]).count() == numbers.count()
    assert sorted(r.no for r in more.collect()) == list(range(1, rows.select("user").where("user IS NOT NULL").distinct().count() + 1))
    hours = bitmaps.window_bitmaps(first, "ts", "user", numbers).unionByName(bitmaps.window_bitmaps(later, "ts", "user", more))
    for size, found in (("1 hour", hours), ("1 day", bitmaps.rolled_up(hours, "1 day"))):
        want = windows.windowed_uv(rows, "ts", "user", size)
        assert sorted(map(tuple, bitmaps.users_counted(found).collect())) == sorted(map(tuple, want.collect()))


def test_idle_keys_are_flushed_on_the_wall_clock_across_a_restart(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")

    def run_until(done, rows):
        spark.createDataFrame(rows, "key string, x double").coalesce(1).write.mode("append").parquet(path)
        told = state.keyed(stream_files(spark, path, "key STRING, x DOUBLE"), state.IdleTotals(2), "ProcessingTime")
        query = sinks.write_batches(told, sinks.batch_files(out), out + "-c", processingTime="500 milliseconds")
        end = time.time() + 60
        while time.time() < end and query.isActive and not done(query):
            time.sleep(0.2)
        query.stop()

    def found():
        return sorted((r.key, r.n, r.total) for r in spark.read.schema("key STRING, n BIGINT, total DOUBLE").parquet(out).collect())

    # the first run sets timers, and stops right after the batch
    run_until(lambda q: any(p.numInputRows for p in q.recentProgress), [("a", 1.0), ("a", None), ("b", 5.0)])
    time.sleep(3)
    want = [("a", 2, 1.0), ("b", 1, 5.0), ("c", 1, 1.0)]
    run_until(lambda q: len(q.recentProgress) > 1 and len(found()) >= 3, [("c", 1.0)])  # another run, from the checkpoint
    assert found() == want
