"""The driver contract on the smallest tables: every query against its SQL."""

import math

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from conftest import SF_SMALL
from streamlens.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL = catalog.oracle_sql()
QUERIES = catalog.queries()
WITHOUT_SQL = {"windowed_uv_approx", "windowed_uv_sketch"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_SMALL}/{name}.parquet'")
    return con


def normal(frame):
    def text(v):
        if v is None or (not isinstance(v, (list, tuple)) and pd.isna(v)):
            return "-"
        if isinstance(v, float):
            return f"{v:.9g}" if not math.isclose(v, round(v)) else str(int(round(v)))
        return v.isoformat() if isinstance(v, pd.Timestamp) else str(v)

    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(text, r)) for r in frame.itertuples(index=False))


def test_only_sketches_have_no_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL


def test_entry_registers_the_catalog():
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(SQL) <= set(__spark_entry__.oracle_sql())


def test_flagship(spark):
    assert __spark_entry__.entry(spark).columns == ["window_start", "window_end", "k", "views", "rank"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normal(got) == normal(want)


@pytest.mark.parametrize("name", sorted(WITHOUT_SQL))
def test_estimates_are_close(spark, name):
    exact = QUERIES["windowed_uv"](spark, SF_SMALL).withColumnRenamed("uv", "exact")
    both = QUERIES[name](spark, SF_SMALL).join(exact, ["window_start", "window_end"], "full")
    far = both.where("uv IS NULL OR exact IS NULL OR abs(uv - exact) > 0.1 * exact + 1")
    assert far.count() == 0
