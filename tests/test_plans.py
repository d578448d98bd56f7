"""Plan shape: filters reach the scan, asset-level operators never funnel
everything through one partition, top-N uses a partial group limit."""

from pricewh.operators import catalogue as C
from pricewh.operators import forecast as M
from pricewh.operators import quant as Q
from pricewh.operators import reads as RD
from pricewh.operators import rollups as R
from pricewh.sources import fixtures as X

SF = "/root/testdata/sf0.01"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_single_partition_exchange_in_asset_operators(spark):
    bars = X.daily_bars(spark, SF)
    stored = X.to_stored(bars)
    for df in [R.monthly_rollup(stored), R.coverage_report(bars), Q.daily_returns(bars),
               Q.rsi_series(bars), Q.return_histogram(bars), M.return_features(bars),
               M.chrono_split(M.return_features(bars)), C.scd2_history(X.asset_changes(spark, SF)),
               RD.recent_bars(stored)]:
        assert "SinglePartition" not in _plan(df)


def test_range_filter_reaches_orders_scan(spark):
    df = RD.bars_in_range(X.stored_bars(spark, SF), "1996-01-01", "1997-01-01")
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in p


def test_scan_reads_only_needed_columns(spark):
    p = _plan(R.yearly_counts(X.daily_bars(spark, SF)))
    # counting bars needs neither prices nor order keys: both are pruned
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in p
    assert "o_totalprice" not in p and "o_orderpriority" not in p


def test_top_n_plans_group_limit(spark):
    opt = RD.recent_bars(X.stored_bars(spark, SF), 5)._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt


def test_payload_request_window_reaches_scan(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    stored = X.stored_bars(spark, SF)
    req = spark.createDataFrame([("automobile_stock_01", "yfinance", dt.datetime(1996, 1, 1), dt.datetime(1996, 4, 1))],
                                "assetId string, dataSourceId string, start timestamp_ntz, end timestamp_ntz")
    p = _plan(RD.bars_payload(stored, req))
    # the plan text truncates long filter lists, so check the lower bound and the upper's prefix
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00)" in p and "LessThan(o_orderdate," in p
