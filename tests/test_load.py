"""Idempotent bar loading (S6), upsert (S7): the original 1-of-2 and
empty-batch facts, plus in-batch duplicates and re-runs (Q1, Q2, Q18)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from pricewh.sources import fixtures as X
from pricewh.sources import sinks as S
from pricewh.operators import rollups as R


def _bars(spark, rows, ingest="j1", sysdate="2026-01-01 00:00:00"):
    flat = spark.createDataFrame(rows, "asset_id string, business_date timestamp_ntz, open double, "
                                       "close double, volume double")
    return X.to_stored(flat, "yfinance", ingest, sysdate)


D1, D2 = dt.datetime(2026, 5, 1), dt.datetime(2026, 5, 2)


def test_one_of_two_is_new(spark):
    existing = _bars(spark, [("btc_crypto", D1, 1.0, 1.0, 1.0)])
    incoming = _bars(spark, [("btc_crypto", D1, 1.0, 1.0, 1.0), ("btc_crypto", D2, 2.0, 2.0, 2.0)])
    new = S.new_bars(incoming, existing).collect()
    assert [r.business_date for r in new] == [D2]


def test_empty_batch_stores_nothing(spark):
    existing = _bars(spark, [("btc_crypto", D1, 1.0, 1.0, 1.0)])
    assert S.new_bars(existing.limit(0), existing).count() == 0


def test_key_is_per_asset_and_in_batch_copies_collapse(spark):
    existing = _bars(spark, [("a", D1, 1.0, 1.0, 1.0)])
    batch = _bars(spark, [("b", D1, 5.0, 5.0, 5.0), ("b", D2, 6.0, 6.0, 6.0)]).unionByName(
        _bars(spark, [("b", D2, 7.0, 7.0, 7.0)], ingest="j2", sysdate="2026-01-02 00:00:00"))
    got = sorted((r.meta.asset_id, r.business_date, r.indicators["close"], r.ingest_id)
                 for r in S.new_bars(batch, existing).collect())
    # other assets' dates do not block; the newest copy of (b, D2) wins
    assert got == [("b", D1, 5.0, "j1"), ("b", D2, 7.0, "j2")]


def test_append_is_idempotent_on_rerun(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "bars")
    batch = _bars(spark, [("a", D1, 1.0, 1.0, 1.0), ("a", D2, 2.0, 2.0, 2.0)])
    assert S.append_new_bars(spark, batch, path) == 2
    assert S.append_new_bars(spark, batch, path) == 0
    more = _bars(spark, [("a", dt.datetime(2026, 6, 1), 3.0, 3.0, 3.0)])
    assert S.append_new_bars(spark, more.unionByName(batch), path) == 1
    stored = S.read_bars(spark, path)
    assert stored.count() == 3
    assert sorted(r.period for r in stored.select("period").distinct().collect()) == ["2026-05", "2026-06"]


def test_load_counts_on_derived_batches(spark):
    sf = "/root/testdata/sf0.01"
    stored = X.stored_bars(spark, sf)
    existing = stored.filter(F.col("business_date") < F.lit("1999-07-01").cast("timestamp_ntz"))
    incoming = stored.filter(F.col("business_date") >= F.lit("1999-01-01").cast("timestamp_ntz"))
    assert existing.count() == 5797 and incoming.count() == 3396
    assert S.new_bars(incoming, existing).count() == 2740


def test_upsert_replaces_matches_inserts_rest_and_drops_null_keys(spark):
    t = spark.createDataFrame([("a", "2024-01", "1_month", 1), ("a", "2024-02", "1_month", 2)],
                              "asset_id string, period string, interval_type string, v int")
    s = spark.createDataFrame([("a", "2024-02", "1_month", 20), ("a", "2024-03", "1_month", 30),
                               ("a", None, "1_month", 99)],
                              "asset_id string, period string, interval_type string, v int")
    got = sorted(tuple(r) for r in S.upsert(t, s).collect())
    assert got == [("a", "2024-01", "1_month", 1), ("a", "2024-02", "1_month", 20), ("a", "2024-03", "1_month", 30)]


def test_upsert_of_overlapping_rollups_equals_full_rollup(spark):
    stored = X.stored_bars(spark, "/root/testdata/sf0.001")
    cut = F.lit("1999-07-01").cast("timestamp_ntz")
    a = R.monthly_rollup(stored.filter(F.col("business_date") < cut))
    b = R.monthly_rollup(stored.filter(F.col("business_date") >= F.lit("1999-01-01").cast("timestamp_ntz")))
    up = R.flatten_rollups(S.upsert(a, b))
    full = R.flatten_rollups(R.monthly_rollup(stored))
    assert up.exceptAll(full).count() == 0 and full.exceptAll(up).count() == 0


def test_overwrite_replaces_result_table(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "totals")
    df = spark.createDataFrame([("a", 2024, 3)], "asset_id string, business_date_year int, cnt long")
    S.overwrite(df, path)
    S.overwrite(df.union(df.withColumn("asset_id", F.lit("b"))), path)
    assert sorted(r.asset_id for r in spark.read.parquet(path).collect()) == ["a", "b"]


def test_failing_read_fails_the_load_and_stores_nothing(spark, tmpdir_fresh, monkeypatch):
    path = os.path.join(tmpdir_fresh, "bars")
    batch = _bars(spark, [("a", D1, 1.0, 1.0, 1.0)])
    assert S.append_new_bars(spark, batch, path) == 1

    def broken(*_):
        raise OSError("store is away")
    with monkeypatch.context() as m:
        m.setattr(S, "read_bars", broken)
        with pytest.raises(OSError):
            S.append_new_bars(spark, batch, path)
    assert S.append_new_bars(spark, batch, path) == 0
    assert S.read_bars(spark, path).count() == 1


def test_existence_is_asked_of_the_file_system(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "bars")
    assert not S.table_exists(spark, path)
    os.makedirs(path)
    assert not S.table_exists(spark, path)          # an empty folder is a new table
    S.append_new_bars(spark, _bars(spark, [("a", D1, 1.0, 1.0, 1.0)]), path)
    assert S.table_exists(spark, path) and S.table_exists(spark, "file://" + path)


def test_one_month_is_written_by_several_tasks(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "bars")
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        rows = spark.range(60_000).select(F.concat(F.lit("a"), F.col("id").cast("string")).alias("asset_id"),
                                          F.lit(D1).cast("timestamp_ntz").alias("business_date"),
                                          *[F.rand(k).alias(c) for k, c in enumerate(("open", "close", "volume"))])
        S.write_bars(X.to_stored(rows, "yfinance", "j", "2026-01-01 00:00:00"), path)
    finally:
        spark.conf.set(key, before)
    folder = os.path.join(path, "period=2026-05")
    assert len([f for f in os.listdir(folder) if f.endswith(".parquet")]) > 1
    assert S.read_bars(spark, path).count() == 60_000


def test_upsert_takes_one_stated_row_of_equal_keys(spark):
    kind = "asset_id string, period string, interval_type string, v int, w string"
    t = spark.createDataFrame([("a", "2024-01", "1_month", 1, "x")], kind)
    s = spark.createDataFrame([("a", "2024-01", "1_month", v, w) for v, w in ((5, "z"), (9, "a"), (9, "b"), (7, "c"))], kind)
    assert [tuple(r) for r in S.upsert(t, s).collect()] == [("a", "2024-01", "1_month", 9, "b")]
