"""What the physical plans must look like."""

import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from streamlens.operators import late, windows
from streamlens.plans import catalog

QUERIES = catalog.queries()
MACHINES = {"baseline_jump", "rising_amount_alert", "top3_transactions_running", "pattern_history_condition"}
OWN_CODE = {"decayed_mean"}  # an accumulator is Python of the user's own; it runs in Arrow batches
BATCH = sorted(n for n in QUERIES if not n.endswith("_stream") and n not in ("write_exactly_once",))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_python_and_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    if name not in MACHINES | OWN_CODE:
        assert not re.search(r"Python|MapInArrow|MapInPandas", text)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(QUERIES["windowed_pv"](spark, SF_SMALL))
    assert "EqualTo(event_type,view)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert set(c.split(":")[0] for c in schema.split(",")) == {"ts", "event_type"}


def test_top_n_is_limited_before_the_shuffle(spark):
    assert plan(QUERIES["hot_pages"](spark, SF_SMALL)).count("WindowGroupLimit") == 2


def test_sliding_counts_expand_panes_not_rows(spark, events):
    text = plan(windows.sliding_count(events, "ts", "1 hour", "5 minutes", ["user_id"]))
    # the innermost aggregation (printed last) comes before the copies
    assert text.index("Generate explode") < text.rindex("HashAggregate")


def test_keyed_windows_share_one_shuffle(spark):
    assert plan(QUERIES["pattern_times_next"](spark, SF_SMALL)).count("Exchange hashpartitioning") == 1
    assert plan(QUERIES["top3_with_ttl"](spark, SF_SMALL)).count("Exchange hashpartitioning") <= 2


def test_large_global_order_is_not_one_task(spark, events):
    rows = events.withColumn("arrival", F.col("ts"))
    marked = late.row_watermark(rows, "ts", ["arrival", "event_id"], "3 SECONDS", max_rows=100)
    windows_over = re.findall(r"Exchange (\w+)[^\n]*\n", plan(marked.select("event_id", "watermark")))
    assert any(kind.startswith("hashpartitioning") for kind in windows_over)
