from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from helpers import rows
from streamlens.operators import late, monitor, patterns, ranking, windows
from streamlens.operators.joins import rules_asof_join, window_join

T0 = datetime(2024, 1, 1)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def log(spark, items, schema):
    return spark.createDataFrame([(at(t), *rest) for t, *rest in items], f"ts timestamp_ntz, {schema}")


def test_windows_are_half_open(spark):
    df = log(spark, [(0, 1), (4.999, 2), (5, 3)], "id long")
    got = rows(windows.windowed_count(df, "ts", "5 seconds").select("window_start", "n"))
    assert got == [(at(0), 2), (at(5), 1)]


def test_sliding_count_equals_copying(spark):
    df = spark.range(200).select(
        F.timestamp_seconds(F.col("id") * 7 % 90).cast("timestamp_ntz").alias("ts"),
        (F.col("id") % 3).alias("k"),
    )
    panes = windows.sliding_count(df, "ts", "10 seconds", "2 seconds", ["k"])
    copied = windows.windowed_count(df, "ts", "10 seconds", ["k"], "2 seconds")
    assert rows(panes) == rows(copied)


def test_count_window_gives_no_tail(spark):
    items = [("a", 1), ("a", 2), ("a", 3), ("a", 4), ("b", 1)]
    df = spark.createDataFrame([(k, n, i) for i, (k, n) in enumerate(items)], "k string, n long, i long")
    out = windows.count_window(df, "k", ["i"], 3, {"total": F.sum("n")})
    assert rows(out) == [("a", 0, 6)]


@pytest.mark.parametrize("max_rows", [1_000_000, 20])
def test_count_windows_of_a_large_key(spark, max_rows):
    df = spark.range(200).select(F.lit(1).alias("k"), "id", F.col("id").alias("n"))
    out = windows.count_window(df, "k", ["id"], 3, {"total": F.sum("n")}, max_rows)
    assert rows(out) == sorted(
        [(1, i, 9 * i + 3) for i in range(66)], key=lambda r: tuple((False, str(v)) for v in r)
    )
    last = windows.sliding_count_window(df, "k", ["id"], 5, 2, "n", max_rows=max_rows)
    got = {r.id: r.total for r in last.collect()}
    assert got == {i: sum(range(max(0, i - 4), i + 1)) for i in range(1, 200, 2)}


def test_top_n_ties_go_by_item(spark):
    df = log(spark, [(0, "b"), (1, "a"), (2, "c"), (3, "c"), (4, "d")], "url string")
    top = windows.hot_pages(df, "ts", "url", 3, "1 hour", "1 hour")
    assert [(r.url, r.views) for r in top.orderBy("rank").collect()] == [("c", 2), ("a", 1), ("b", 1)]
    report = windows.hot_report(top, "url").first().report
    assert report.split("\n") == [
        "窗口结束时间: 1704070800000", "-" * 33, "网址：c     热度值：2", "网址：a     热度值：1",
        "网址：b     热度值：1", "-" * 33, ""]


def test_adjacent_jump(spark):
    df = spark.createDataFrame([(1, i, x) for i, x in enumerate([0, 100000, 200001])], "k long, i long, x long")
    assert [r.i for r in ranking.adjacent_jump(df, "k", "x", ["i"], 100_000).collect()] == [2]


def test_top_products_and_average(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "a", 9), (1, "b", 7), (1, "c", 1), (1, "d", 3)], "c long, p string, x long"
    )
    assert ranking.top_product_names(df, "c", "p", "x").first().products == ["d", "b", "a"]
    got = ranking.top_product_sums(df, "c", "p", "x").first()
    assert (got.total, got.average) == (19, 6)


# ---- late data


def test_late_limits(spark):
    """Window [0, 10) s, disorder 2 s, lateness 5 s; the watermark is max - 2 s - 1 ms."""
    def class_after(seen):
        df = log(spark, [(seen, at(0), "x"), (9, at(1), "y")], "arrival timestamp_ntz, id string")
        out = late.classify_late(df, "ts", ["arrival"], "10 seconds", "2 SECONDS", "5 SECONDS")
        return out.where("id = 'y'").first().late_class

    assert class_after(11.999) == "on_time"
    assert class_after(12) == "late_refire"
    assert class_after(16.999) == "late_refire"
    assert class_after(17) == "side_output"


@pytest.mark.parametrize("max_rows", [1_000_000, 30])
def test_refires_count_up(spark, max_rows):
    df = spark.range(300).select(
        F.timestamp_seconds(F.col("id") - F.col("id") * 37 % 20).cast("timestamp_ntz").alias("ts"),
        # arrivals crowd in one instant
        F.timestamp_seconds(F.when(F.col("id") < 200, 5).otherwise(F.col("id"))).alias("seen"), "id",
    )
    marked = late.classify_late(df, "ts", ["seen", "id"], "10 seconds", "2 SECONDS", "6 SECONDS", max_rows=max_rows)
    firings = late.late_refire(marked, [], ["seen", "id"], max_rows=max_rows).collect()
    largest, expected = None, {}
    out = []
    for i in range(300):
        t = i - i * 37 % 20
        start = t // 10 * 10
        mark = None if largest is None else largest * 1000 - 2001
        if mark is None or start * 1000 + 9999 > mark:
            kind = "on_time"
        elif start * 1000 + 15999 > mark:
            kind = "late_refire"
        else:
            kind = None
        if kind:
            expected.setdefault(start, [0, 0])
            expected[start][0] += 1
            if kind == "late_refire":
                out.append((start, expected[start][0], kind))
            else:
                expected[start][1] = expected[start][0]
        largest = t if largest is None else max(largest, t)
    out += [(s, n[1], "on_time") for s, n in expected.items() if n[1]]
    epoch = datetime(1970, 1, 1)
    got = sorted((round((r.window_start - epoch).total_seconds()), r.n, r.firing) for r in firings)
    assert got == sorted(out) and any(k == "late_refire" for _, _, k in out)


# ---- patterns


def seq(spark, text, gap=1):
    return log(spark, [(i * gap, 1, i, c) for i, c in enumerate(text)], "k long, i long, e string")


def matches(spark, text, **options):
    found = patterns.times_next(
        seq(spark, text), "k", ["ts", "i"], F.col("e") == "A", F.col("e") == "B",
        options.get("times", 2), ["i", "ts"], options.get("max_rows", 1_000_000),
    )
    return sorted((r.first.i, r.last.i, r.next.i) for r in found.collect())


def test_times_then_directly_next(spark):
    assert matches(spark, "AxAB") == [(0, 2, 3)]
    assert matches(spark, "AAxB") == []
    assert matches(spark, "AAAB") == [(1, 2, 3)]
    assert matches(spark, "AB", times=1) == [(0, 0, 1)]


def test_times_in_chunks(spark):
    text = "AxABAABxAxAB" * 20
    assert matches(spark, text, max_rows=17) == matches(spark, text)
    assert matches(spark, text, times=3, max_rows=17) == matches(spark, text, times=3)


@pytest.mark.parametrize("max_rows", [1_000_000, 7])
def test_patterns_without_a_key(spark, max_rows):
    df = seq(spark, "AxABAABxAxAB")
    condition = (F.col("e") == "A", F.col("e") == "B")
    keyed = patterns.times_next(df, "k", ["ts", "i"], *condition, 2, ["i", "ts"], max_rows)
    free = patterns.times_next(df, None, ["ts", "i"], *condition, 2, ["i", "ts"], max_rows)
    assert free.columns == ["first", "last", "next"]
    assert sorted(r.first.i for r in free.collect()) == sorted(r.first.i for r in keyed.collect()) != []
    loops = patterns.one_or_more_until(df, None, ["ts", "i"], *condition, max_rows=max_rows)
    assert patterns.longest_loops(loops, None, ["ts", "i"]).count() == 3


def test_within_is_strict(spark):
    found = patterns.times_next(
        seq(spark, "AAB"), "k", ["ts", "i"], F.col("e") == "A", F.col("e") == "B", 2, ["i", "ts"]
    )
    assert patterns.within(found, "ts", "2 SECONDS").count() == 0
    assert patterns.within(found, "ts", "3 SECONDS").count() == 1


@pytest.mark.parametrize("max_rows", [1_000_000, 7])
def test_loops_stop(spark, max_rows):
    text = "AxAASAAxxSxA" * 5
    df = seq(spark, text)
    got = patterns.one_or_more_until(
        df, "k", ["ts", "i"], F.col("e") == "A", F.col("e") == "S", max_rows=max_rows
    )
    want, stretch = {}, 0
    for i, c in enumerate(text):
        if c == "S":
            stretch += 1
        elif c == "A":
            rest = text[i:].split("S")[0]
            want[i] = (stretch, rest.count("A"))
    assert {r.i: (r.stretch, r.matches) for r in got.collect()} == want
    longest = patterns.longest_loops(got, "k", ["ts", "i"])
    assert longest.count() == len({s for s, _ in want.values()})


def test_chained_conditions_have_no_precedence(spark):
    df = spark.createDataFrame([("pv", 3), ("uv", 4), ("pv", 4), ("uv", 3)], "b string, c long")
    pv, uv = F.col("b") == "pv", F.col("b") == "uv"
    rule = patterns.chained(("where", pv), ("where", F.col("c") == 3), ("or", uv), ("where", F.col("c") == 4))
    assert rows(df.where(rule)) == [("uv", 4)]


# ---- joins and sessions


@pytest.mark.parametrize("limits", [{}, {"rules_per_bucket": 1}, {"rules_per_bucket": 0}, {"rules_per_bucket": 0, "max_rows": 40}])
def test_rule_in_force(spark, limits):
    events = spark.range(200).select(
        F.timestamp_seconds("id").cast("timestamp_ntz").alias("ts"), "id",
        F.when(F.col("id") % 4 == 0, "b").otherwise("a").alias("tier"),
    )
    rules = spark.createDataFrame(
        [(datetime(1970, 1, 1, 0, 0, 10), "a", "r1"), (datetime(1970, 1, 1, 0, 1, 0), "a", "r2"),
         (datetime(1970, 1, 1, 0, 1, 0), "a", "r0"), (datetime(1970, 1, 1, 0, 0, 40), "b", "s1")],
        "ts timestamp_ntz, tier string, rule string",
    )
    out = rules_asof_join(events, rules, "tier", "ts", "rule", ["ts", "id"], **limits)
    got = {r.id: r.rule for r in out.collect()}
    assert len(got) == 200

    def rule(i):
        if i % 4 == 0:
            return "s1" if i >= 40 else ""
        return "" if i < 10 else "r1" if i < 60 else "r2"

    assert got == {i: rule(i) for i in range(200)}


def test_no_rules_and_no_events(spark):
    events = log(spark, [(1, 1, "a")], "id long, tier string")
    rules = log(spark, [(0, "a", "r")], "tier string, rule string")
    for e, r, want in [(events, rules.limit(0), [""]), (events.limit(0), rules, []), (events, rules, ["r"])]:
        out = rules_asof_join(e, r, "tier", "ts", "rule", ["ts", "id"])
        assert [x.rule for x in out.collect()] == want


def test_window_join_stays_in_the_window(spark):
    left = log(spark, [(0, 1, "a"), (4, 1, "b"), (6, 1, "c")], "k long, n string")
    right = log(spark, [(3, 1, "x"), (5, 1, "y"), (5, None, "z")], "k long, n string")
    out = window_join(left, right, "k", "ts", "5 seconds",
                      [F.concat_ws("|", F.col("l.n"), F.col("r.n")).alias("n")])
    assert rows(out) == [("a|x",), ("b|x",), ("c|y",)]


@pytest.mark.parametrize("max_rows", [1_000_000, 10])
def test_silence_longer_than_ttl_starts_anew(spark, max_rows):
    times = [0, 10, 20, 31, 41, 60] + list(range(100, 150))
    df = log(spark, [(t, 1, i, float(t)) for i, t in enumerate(times)], "k long, i long, x double")
    out = monitor.top_with_ttl(df, "k", "x", "ts", ["ts", "i"], max_rows=max_rows)
    got = {}
    for r in out.orderBy("session", "rank").collect():
        got.setdefault(r.session, []).append(r.x)
    assert got == {1: [20, 10, 0], 2: [41, 31], 3: [60], 4: [149, 148, 147]}


def test_has_rows(spark):
    assert ranking.has_rows(spark.range(3)) and not ranking.has_rows(spark.range(0))


def test_monitor_limits(spark):
    df = log(spark, [(0, 1, 50000, 0), (0, 2, 50001, 0), (0, 3, 30000, 0), (1, 3, 20001, 0),
                     (0, 4, None, 300000), (0, 5, 1, 200000), (0, 6, 1, 200001)],
             "k long, a long, t long")
    out = monitor.large_transaction_monitor(df, "k", "a", "t", "ts")
    assert rows(out.select("k", "by_single", "by_sum")) == [
        (2, True, False), (3, False, True), (6, True, False)]
