"""State machines against plain loops, whole and in chunks."""

from datetime import timezone

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from streamlens.operators import chains
from streamlens.operators.monitor import rise_machine, rise_timers, rising_amount_alert
from streamlens.operators.patterns import above_history
from streamlens.operators.ranking import baseline_jump, baseline_machine, running_top


def alerts_by_loop(rows, wait):
    """rows: (at, x) in order."""
    fired, deadline, before = [], None, 0.0
    for at, x in rows:
        if deadline is not None and at > deadline:
            fired.append(deadline)
            deadline = None
        if x > before:
            deadline = at + wait if deadline is None else deadline
        else:
            deadline = None
        before = x
    return fired + ([deadline] if deadline is not None else [])


def jumps_by_loop(rows, threshold):
    base, out = 0.0, []
    for i, x in rows:
        if abs(x - base) > threshold:
            out.append((i, base, x))
            base = x
    return out


@pytest.fixture(scope="module")
def rows(spark):
    # key 0 holds half of the rows; key 2 only rises
    noise = (F.col("id") * 7919 % 1009).cast("double")
    return spark.range(1200).select(
        F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id") % 5).alias("k"),
        F.col("id"),
        F.timestamp_micros(F.col("id") * 1_000_000).cast("timestamp_ntz").alias("ts"),
        F.when(F.col("id") % 10 == 3, F.col("id").cast("double")).otherwise(noise).alias("x"),
    )


def by_key(rows, *columns):
    found = {}
    for r in rows.orderBy("ts", "id").collect():
        found.setdefault(r.k, []).append(tuple(r[c] for c in columns))
    return found


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_rising_amount(rows, max_rows):
    got = rising_amount_alert(rows, "k", "x", "ts", ["ts", "id"], seconds=7, max_rows=max_rows)
    got = sorted((r.k, r.alert_ts.timestamp()) for r in got.collect())
    want = by_key(rows.withColumn("at", F.unix_micros(F.col("ts").cast("timestamp"))), "at", "x")
    from datetime import datetime, timedelta

    epoch = datetime(1970, 1, 1)
    want = sorted(
        (k, (epoch + timedelta(microseconds=d)).timestamp())
        for k, v in want.items() for d in alerts_by_loop(v, 7_000_000)
    )
    assert got == want and len(got) > 50


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_baseline_jump(rows, max_rows):
    got = baseline_jump(rows, "k", "x", "id", ["ts", "id"], 400, max_rows)
    got = sorted((r.k, r.id, r.baseline, r.x) for r in got.collect())
    want = sorted((k, *hit) for k, v in by_key(rows, "id", "x").items() for hit in jumps_by_loop(v, 400))
    assert got == want and len(got) > 50


def test_timer_limits():
    at = np.array([0, 5, 10], "int64")
    falls_at_deadline = rise_timers(at, np.array([True, False, False]), None, 5)
    assert falls_at_deadline == ([], None)
    assert rise_timers(at, np.array([True, False, False]), None, 4) == ([4], None)
    assert rise_timers(at, np.array([True, True, True]), None, 5) == ([5], 15)
    assert rise_timers(np.array([], "int64"), np.array([], bool), 3, 5) == ([], 3)


@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_running_top(rows, max_rows):
    got = running_top(rows, "k", "x", "id", ["ts", "id"], 3, max_rows=max_rows)
    got = {(r.k, r.id): r.top for r in got.collect()}
    want = {}
    for k, v in by_key(rows, "id", "x").items():
        seen = []
        for i, x in v:
            seen = sorted([*seen, x])[-3:]
            want[k, i] = seen
    assert got == want


def accepted_by_loop(values, percent):
    matches, total, out = 0, 0, []
    for i, x in values:
        if not matches or 100 * x * matches > percent * total:
            out.append((i, x, matches, total))
            matches, total = matches + 1, total + x
    return out


@pytest.mark.parametrize("percent", [50, 100, 180])
@pytest.mark.parametrize("max_rows", [1_000_000, 50])
def test_above_history(rows, max_rows, percent):
    whole = rows.withColumn("x", F.round("x").cast("long"))
    got = above_history(whole, "k", "x", "id", ["ts", "id"], percent, max_rows)
    got = sorted((r.k, r.id, r.x, r.matches, r.total) for r in got.collect())
    want = sorted((k, *hit) for k, v in by_key(whole, "id", "x").items() for hit in accepted_by_loop(v, percent))
    assert got == want and len(got) > 5


def test_chunks_that_accept_nothing_are_passed_over(spark, monkeypatch):
    """One key of 50 chunks, accepted rows in the first and in one later chunk."""
    rounds = rounds_of(monkeypatch)
    df = spark.range(2000).selectExpr("1 AS k", "id", "CASE WHEN id = 1200 THEN 9000 ELSE 1000 + id % 7 END AS x")
    got = above_history(df, "k", "x", "id", ["id"], 150, 40).collect()
    assert [(r.id, r.matches) for r in sorted(got)] == [(0, 0), (1200, 1)] and rounds() <= 4


def written_by(monkeypatch):
    """Labels of the tables a fold writes: ``fold`` per run over rows, ``fold-starts`` per round."""
    from streamlens.operators import ordered

    written, pin = [], ordered.pin
    monkeypatch.setattr(ordered, "pin", lambda df, label: written.append(label) or pin(df, label))
    return written


def rounds_of(monkeypatch):
    written = written_by(monkeypatch)
    return lambda: written.count("fold-starts")


SHAPES = {"falling": "100000 - id", "quiet": "CASE WHEN id = 3 THEN 900 ELSE 600 + id % 200 END", "rising": "id"}


def one_key(spark, shape):
    return spark.range(1000).selectExpr("0 AS k", "id", "timestamp_micros(id * 1000000) AS ts", f"{SHAPES[shape]} AS x")


@pytest.mark.parametrize("shape", SHAPES)
def test_running_top_settles_in_two_rounds(spark, monkeypatch, shape):
    rounds = rounds_of(monkeypatch)
    rows = one_key(spark, shape)
    got = {r.id: r.top for r in running_top(rows, "k", "x", "id", ["ts", "id"], 3, max_rows=20).collect()}
    seen = []
    for r in rows.orderBy("id").collect():
        seen = sorted([*seen, r.x])[-3:]
        assert got[r.id] == seen
    assert len(got) == 1000 and rounds() <= 2


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("threshold", [0, 37, 400])
def test_baseline_of_fifty_chunks(spark, monkeypatch, shape, threshold):
    written = written_by(monkeypatch)
    rows = one_key(spark, shape)
    got = baseline_jump(rows, "k", "x", "id", ["ts", "id"], threshold, 20)
    got = sorted((r.id, r.baseline, r.x) for r in got.collect())
    assert got == jumps_by_loop([(r.id, r.x) for r in rows.orderBy("id").collect()], threshold)
    # one pass to learn the functions, one run; two levels of functions of 8 chunks each
    assert written.count("fold") == 1 and written.count("fold-functions") == 2


@pytest.mark.parametrize("shape", SHAPES)
@pytest.mark.parametrize("seconds", [0, 3, 33, 5000])
def test_rising_amount_of_fifty_chunks(spark, monkeypatch, shape, seconds):
    written = written_by(monkeypatch)
    rows = one_key(spark, shape)
    got = rising_amount_alert(rows, "k", "x", "ts", ["ts", "id"], seconds, 20)
    got = sorted(int(r.alert_ts.replace(tzinfo=timezone.utc).timestamp()) for r in got.collect())
    assert got == alerts_by_loop([(r.id, r.x) for r in rows.orderBy("id").collect()], seconds)
    assert written.count("fold") == 1 and written.count("fold-functions") == 2


@pytest.mark.parametrize("seed", range(6))
def test_first_outside_and_functions_against_loops(seed):
    rng = np.random.default_rng(seed)
    whole = seed % 2 == 0
    kind = T.LongType() if whole else T.DoubleType()
    for n in (1, 2, 3, 7, 40, 129):
        x = rng.integers(-30, 30, n) if whole else np.round(rng.normal(0, 20, n), 2)
        low, high = x - 9, x + 9
        want = [next((j for j in range(i + 1, n) if x[j] > high[i] or x[j] < low[i]), n) for i in range(n)]
        assert chains.first_outside(x, low, high).tolist() == want
        jump = baseline_machine(kind, T.LongType(), 9)
        at = np.sort(rng.integers(0, 3 * n, n))
        rise = rise_machine(kind, 5, ["id"])
        for first in (0, n // 3):
            parts = [slice(0, first), slice(first, n)] if first else [slice(0, n)]
            f = g = None
            before = {}
            for part in parts:
                rows = {"_row": np.arange(n)[part], "_x": x[part], "_at": at[part]}
                one, two = jump.moves.function(rows, {}), rise.moves.function(rows, before)
                f, g = (one, two) if f is None else (f.then(one), g.then(two))
                before = {"last": x[part][-1].item()}
            f, g = chains.Steps.load(f.dump()), chains.Steps.load(g.dump())
            rows = {"_row": np.arange(n), "_x": x, "_at": at}
            for base in range(-60, 60):
                assert f(base) == jump.step(rows, {"base": base})[1]["base"]
            # an open deadline is never more than the wait after the first row
            for deadline in [None, *range(-3, int(at[0]) + 6)]:
                state = {"amount": 0, "deadline": deadline}
                assert g(deadline) == rise.step(rows, state)[1]["deadline"]


def test_too_large_a_function_only_costs_rounds(spark, monkeypatch):
    monkeypatch.setattr(chains, "MOST_PIECES", 1)
    rows = one_key(spark, "rising")
    got = baseline_jump(rows, "k", "x", "id", ["ts", "id"], 400, 100)
    assert sorted(r.id for r in got.collect()) == [401, 802]


@pytest.mark.parametrize("max_rows", [1_000_000, 2])
def test_whole_amounts_text_ids_and_nulls(spark, max_rows):
    big = 9_007_199_254_740_993
    rows = spark.createDataFrame(
        [("c", "a", 1, 5), ("c", "b", 2, big), ("c", "n", 3, None), ("c", None, 4, 7), ("c", "d", 5, big + 1)],
        "k string, id string, at int, x bigint",
    ).withColumn("ts", F.timestamp_seconds("at"))
    top = {r.id: r.top for r in running_top(rows, "k", "x", "id", ["at"], 2, max_rows=max_rows).collect()}
    assert top == {"a": [5], "b": [5, big], "d": [big, big + 1]}
    jumps = sorted((r.id, r.baseline, r.x) for r in baseline_jump(rows, "k", "x", "id", ["at"], 0, max_rows).collect())
    assert jumps == [("a", 0, 5), ("b", 5, big), ("d", big, big + 1)]
    # rises at 1, 2 and 5; the null at 3 counts for nothing, the fall at 4 ends the first timer
    assert rising_amount_alert(rows, "k", "x", "ts", ["at"], 10, max_rows).count() == 1
