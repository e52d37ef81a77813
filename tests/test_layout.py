"""Replays give the batch rows however the stored events lie in files, over many micro-batches."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from streamlens.operators import aggregates, joins
from streamlens.plans import catalog, twins
from test_entry import TABLES, normal

STREAMS = (
    "tumbling_count_stream count_window_stream baseline_jump_stream rising_amount_alert_stream window_join_stream "
    "windowed_uv_stream keep_first_by_key_stream sliding_count_stream hot_pages_stream large_transaction_monitor_stream "
    "pattern_times_next_stream pattern_within_stream"
).split()


@pytest.fixture(scope="module")
def shuffled(spark, tmp_path_factory):
    """The small tables; events in eight files without any order."""
    folder = tmp_path_factory.mktemp("shuffled")
    for name in TABLES:
        if name != "events":
            os.symlink(f"{SF_SMALL}/{name}.parquet", folder / f"{name}.parquet")
    rows = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    rows.repartition(8).write.parquet(str(folder / "events.parquet"))
    return str(folder)


@pytest.mark.parametrize("name", STREAMS)
def test_stream_over_slices_equals_sql(spark, shuffled, monkeypatch, name):
    monkeypatch.setattr(twins, "SLICE_ROWS", 250)
    got = catalog.queries()[name](spark, shuffled).toPandas()
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    want = con.execute(catalog.oracle_sql()[name]).df()
    assert normal(got) == normal(want)


def test_a_row_delivered_twice_is_one_new_user(spark):
    rows = spark.createDataFrame([(1, 5), (1, 5), (2, 6)], "user int, at int")
    last = max(r.uv for r in aggregates.running_uv(rows, "user", ["at"]).collect())
    assert last == 2


@pytest.mark.parametrize("per_bucket", [50, 0])
def test_rules_without_tier_or_time_never_apply(spark, per_bucket):
    rules = spark.sql("""
        SELECT * FROM VALUES ('a', TIMESTAMP_NTZ'1970-01-01 00:00:01', 'old'), (NULL, TIMESTAMP_NTZ'2024-01-01', 'no tier'),
        ('a', NULL, 'no time'), ('a', TIMESTAMP_NTZ'2024-01-02 00:00:30', 'new') AS t(tier, ts, rule)""")
    events = spark.sql("""
        SELECT * FROM VALUES (1, 'a', TIMESTAMP_NTZ'2024-01-02 00:00:10'), (2, 'a', TIMESTAMP_NTZ'2024-01-02 00:00:40'),
        (3, NULL, TIMESTAMP_NTZ'2024-01-02'), (4, 'a', NULL) AS t(id, tier, ts)""")
    got = joins.rules_asof_join(events, rules, "tier", "ts", "rule", ["ts", "id"], rules_per_bucket=per_bucket)
    assert {r.id: r.rule for r in got.collect()} == {1: "old", 2: "new", 3: "", 4: ""}


@pytest.mark.parametrize("per_bucket", [50, 1, 0])
def test_one_event_far_away_costs_nothing(spark, monkeypatch, per_bucket):
    # three rules a minute, so that minutes are the buckets; one event of 1970 and one of 2200
    rules = spark.range(100).selectExpr(
        "'a' AS tier", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id * 20) AS ts", "concat('rule ', lpad(id, 3, '0')) AS rule")
    far = "VALUES (1, 'a', TIMESTAMP_NTZ'1970-01-01 00:00:01'), (2, 'a', TIMESTAMP_NTZ'2200-01-01'), (3, 'a', TIMESTAMP_NTZ'2024-01-01 00:10:30')"
    events = spark.sql(f"SELECT * FROM {far} AS t(id, tier, ts)")
    kept, pin = {}, joins.pin
    monkeypatch.setattr(joins, "pin", lambda df, label: kept.setdefault(label, pin(df, label)))
    monkeypatch.setattr(joins, "RULES_PER_BUCKET", per_bucket)
    got = joins.rules_asof_join(events, rules, "tier", "ts", "rule", ["ts", "id"], rules_per_bucket=max(per_bucket, 3) if per_bucket else 0)
    assert {r.id: r.rule for r in got.collect()} == {1: "", 2: "rule 099", 3: "rule 031"}
    if "rule-spans" in kept:
        assert kept["rule-buckets"].count() == 3 and kept["rule-spans"].count() <= 3 + 100


@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_rules_of_many_buckets_and_large_tiers(spark, kind):
    rules = spark.range(400).selectExpr(
        "concat('t', id % 3) AS tier", f"cast(timestamp_micros(id * 7919 % 400 * 3600000000) AS {kind}) AS ts", "concat('r', id) AS rule")
    events = spark.range(900).selectExpr(
        "id", "concat('t', id % 4) AS tier", f"cast(timestamp_micros(id * 104729 % 900 * 1800000000) AS {kind}) AS ts")
    found = []
    for per_bucket, max_rows in ((50, 1_000_000), (50, 40), (0, 1_000_000), (2, 40)):
        out = joins.rules_asof_join(events, rules, "tier", "ts", "rule", ["ts", "id"], rules_per_bucket=per_bucket, max_rows=max_rows)
        found.append(sorted((r.id, r.rule) for r in out.collect()))
    by = {}
    for r in rules.collect():
        by.setdefault(r.tier, []).append((r.ts, r.rule))
    want = []
    for e in events.collect():
        before = [x for x in by.get(e.tier, []) if x[0] <= e.ts]
        want.append((e.id, max(before)[1] if before else ""))
    assert all(f == sorted(want) for f in found)
