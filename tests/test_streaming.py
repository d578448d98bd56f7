"""Streaming ingestion of landed CSV files is idempotent across runs."""

import os

from pricewh.sources.sinks import read_bars
from pricewh.streaming.ingest import start_bar_ingest

HEADER = "Date,symbol,Open,High,Low,Close,Volume\n"


def test_stream_loads_new_files_once(spark, tmpdir_fresh):
    landed = os.path.join(tmpdir_fresh, "landed")
    os.makedirs(landed)
    table, ckpt = os.path.join(tmpdir_fresh, "bars"), os.path.join(tmpdir_fresh, "ckpt")
    with open(os.path.join(landed, "a.csv"), "w") as f:
        f.write(HEADER + "2024-01-02,AAPL,1,2,0.5,1.5,100\n2024-01-03,AAPL,2,3,1,2.5,200\n")
    q = start_bar_ingest(spark, landed, table, ckpt)
    q.awaitTermination(120)
    assert sum(q.stored_counts) == 2
    # a replayed day arrives again with a new one: only the new one is stored
    with open(os.path.join(landed, "b.csv"), "w") as f:
        f.write(HEADER + "2024-01-03,AAPL,2,3,1,2.5,200\n2024-01-04,AAPL,3,4,2,3.5,300\n")
    q = start_bar_ingest(spark, landed, table, ckpt)
    q.awaitTermination(120)
    assert sum(q.stored_counts) == 1
    bars = read_bars(spark, table)
    assert bars.count() == 3
    assert {r.meta.asset_id for r in bars.collect()} == {"aapl_stock_01"}


def test_stream_refreshes_touched_month_rollups(spark, tmpdir_fresh):
    from pyspark.sql import functions as F

    from pricewh.operators.rollups import flatten_rollups, monthly_rollup
    landed = os.path.join(tmpdir_fresh, "landed")
    os.makedirs(landed)
    table, ckpt = os.path.join(tmpdir_fresh, "bars"), os.path.join(tmpdir_fresh, "ckpt")
    rollups = os.path.join(tmpdir_fresh, "rollups")
    with open(os.path.join(landed, "a.csv"), "w") as f:
        f.write(HEADER + "2024-01-02,AAPL,1,2,0.5,1.5,100\n2024-02-03,AAPL,2,3,1,2.5,200\n"
                         "2024-01-05,MSFT,5,6,4,5.5,10\n")
    start_bar_ingest(spark, landed, table, ckpt, rollup_path=rollups).awaitTermination(120)
    with open(os.path.join(landed, "b.csv"), "w") as f:
        f.write(HEADER + "2024-02-10,AAPL,3,4,2,4.5,300\n")
    start_bar_ingest(spark, landed, table, ckpt, rollup_path=rollups).awaitTermination(120)
    got = spark.read.parquet(rollups).select("asset_id", "interval_type", "period", "stats")
    want = monthly_rollup(read_bars(spark, table).drop("period"))
    assert sorted(map(tuple, flatten_rollups(got).collect())) == sorted(map(tuple, flatten_rollups(want).collect()))
    feb = flatten_rollups(got).filter((F.col("asset_id") == "aapl_stock_01") & (F.col("period") == "2024-02")).first()
    assert (feb["count"], feb.high, feb.low, feb.average) == (2, 4.5, 2.5, 3.5)


def test_stream_of_json_replies(spark, tmpdir_fresh):
    import json
    landed = os.path.join(tmpdir_fresh, "landed")
    os.makedirs(landed)
    table, ckpt = os.path.join(tmpdir_fresh, "bars"), os.path.join(tmpdir_fresh, "ckpt")
    series = {"2024-01-02": {"1. open": "1", "2. high": "2", "3. low": "0.5", "4. close": "1.5", "5. volume": "10"},
              "2024-01-03": {"1. open": "2", "2. high": "3", "3. low": "1", "4. close": "2.5", "5. volume": "20"}}
    with open(os.path.join(landed, "r.json"), "w") as f:
        f.write(json.dumps({"symbol": "IBM", "payload": json.dumps({"Time Series (Daily)": series})}) + "\n")
        f.write(json.dumps({"symbol": "IBM", "payload": json.dumps({"Note": "limit"})}) + "\n")
    q = start_bar_ingest(spark, landed, table, ckpt, provider="alphavantage", fmt="json_replies")
    q.awaitTermination(120)
    assert sum(q.stored_counts) == 2
    got = sorted((r.meta.asset_id, r.meta.data_source_id, r.indicators["close"]) for r in read_bars(spark, table).collect())
    assert got == [("ibm_stock_01", "alphavantage", 1.5), ("ibm_stock_01", "alphavantage", 2.5)]
