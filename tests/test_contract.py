"""Driver contract: entry() runs, every query has a name match in the
oracle (except the model outputs), and Spark equals DuckDB at sf0.001."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from pricewh.plans.catalog import QUERIES
from pricewh.plans.oracle import ORACLE

SF = "/root/testdata/sf0.001"
NO_ORACLE = {"gbt_forecast", "gbt_metrics", "model_leaderboard"}
TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["asset_id", "interval_type", "period", "count", "high", "low", "average"]


def test_every_query_has_oracle_but_models():
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE
    assert set(E.oracle_sql()) <= set(E.queries()) and set(QUERIES) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    return v.item() if hasattr(v, "item") else v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_spark_equals_duckdb(spark, duck, name):
    s = QUERIES[name](spark, SF).toPandas()
    d = duck.execute(ORACLE[name]).df()
    assert sorted(s.columns) == sorted(d.columns)
    assert len(s) == len(d)
    assert _rows(s) == _rows(d)


@pytest.mark.parametrize("name", ["ingest_wide", "bars_in_range", "load_new_bars", "coverage_report",
                                  "scd2_history", "forecast_view"])
def test_results_do_not_depend_on_session_zone(spark, duck, name):
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
        s = QUERIES[name](spark, SF).toPandas()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert _rows(s) == _rows(duck.execute(ORACLE[name]).df())
