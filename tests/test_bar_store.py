"""Loads into bucketed, sorted tables."""

import datetime as dt
import re
import uuid

import pytest
from pyspark.sql import functions as F

from pricewh.sources import bar_store as B
from pricewh.sources import fixtures as X

T0 = dt.datetime(2024, 1, 1)


def _bars(spark, keys, close=1.0):
    df = spark.createDataFrame([(a, T0 + dt.timedelta(days=d), close) for a, d in keys],
                               "asset_id string, business_date timestamp_ntz, close double")
    return X.to_stored(df.withColumns({"open": F.col("close"), "volume": F.lit(1.0)}))


@pytest.fixture
def store(spark):
    s = B.BarStore(spark, f"bars_{uuid.uuid4().hex[:10]}", 4)
    yield s
    s.drop()


def _keys(df):
    return sorted((r.meta.asset_id, (r.business_date - T0).days) for r in df.collect())


def test_overlapping_batches_and_a_replay(spark, store):
    one, two = [("a", d) for d in range(6)] + [("b", 1)], [("a", d) for d in range(4, 9)] + [("a", 8), ("c", 0)]
    assert store.append(_bars(spark, one), "one") == 7
    assert store.append(_bars(spark, two), "two") == 4                 # overlap and a copy inside the batch
    assert store.append(_bars(spark, two), "two") == 4                 # a replay tells the same and stores nothing
    assert store.append(_bars(spark, two), "again") == 0               # so does the same data under another name
    assert _keys(store.bars()) == sorted(set(one) | set(two))
    assert store.append(_bars(spark, []), "none") == 0


def test_stored_side_is_neither_exchanged_nor_sorted(spark, store):
    store.append(_bars(spark, [(f"a{k}", d) for k in range(30) for d in range(20)]), "one")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.legacy.bucketedTableScan.outputOrdering", "true")
    try:
        df = store.unseen(_bars(spark, [(f"a{k}", d) for k in range(5) for d in range(15, 25)]))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 25
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.legacy.bucketedTableScan.outputOrdering")
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if "FileScan parquet" in line)
    depth = re.search(r"[A-Za-z(*]", lines[at]).start()
    above = []                                                     # operators between the stored scan and the join
    for line in reversed(lines[:at]):
        d = re.search(r"[A-Za-z(*]", line).start()
        if d < depth:
            depth = d
            above.append(line)
            if "Join" in line:
                break
    assert "Bucketed: true" in plan and "Join" in above[-1]
    assert not any("Exchange" in x or " Sort " in x for x in above[:-1]), "\n".join(above)


def test_compaction_keeps_all_bars(spark, store, monkeypatch):
    monkeypatch.setattr(B, "MOST_FILES", 2)
    for i in range(4):
        store.append(_bars(spark, [(f"a{k}", 10 * i + d) for k in range(4) for d in range(8)]), f"b{i}")
        assert store.files_a_bucket() <= 2
    assert len(_keys(store.bars())) == 4 * 4 * 8 == len(set(_keys(store.bars())))
    # a compaction that died between writing and renaming is finished, one that died writing is dropped
    store._write(spark.table(store.name), f"{store.name}_compacted")
    store.recover()
    assert len(_keys(store.bars())) == 128 and not spark.catalog.tableExists(f"{store.name}_compacted")
    store._write(spark.table(store.name).limit(5), f"{store.name}_compacted")
    store.recover()
    assert len(_keys(store.bars())) == 128 and not spark.catalog.tableExists(f"{store.name}_compacted")


def test_hot_asset_fills_all_buckets(spark, store):
    store.append(_bars(spark, [("hot", d) for d in range(300)]), "one")
    spread = spark.table(store.name).groupBy(F.input_file_name()).count().collect()
    assert len(spread) == 4 and max(r["count"] for r in spread) < 150


def test_names_and_buckets_are_checked(spark):
    for name, buckets in (("no name", 4), ("x", 3), ("x", 0)):
        with pytest.raises(ValueError):
            B.BarStore(spark, name, buckets)
