"""The stored catalogue: open part apart, batches applied once, pages by prefix counts."""

import datetime as dt
import os
import re

import pytest

from pricewh.operators import catalogue as C
from pricewh.operators import history_store as H
from pricewh.sources import ledger
from pyspark.sql import functions as F

from test_catalogue import T0, _key, _log, _rows, fold


def _changes(n_assets, days, start=0):
    return [(f"a{k:03d}", T0 + dt.timedelta(days=d), 1000 * d + k, "delete" if (k * 7 + d) % 5 == 0 else "save", f"S{k}", f"v{d}")
            for k in range(n_assets) for d in range(start, start + days) if (k + d) % 3]


def _files(df):
    return {f.split("/versions/")[1].split("/part-")[0] for f in df.inputFiles()}


def test_batches_apply_once_and_read_only_open_versions(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "h")
    rows = _changes(20, 4) + _changes(25, 3, 4) + _changes(5, 2, 8)
    H.write_history(C.scd2_history(_log(spark, rows[:len(_changes(20, 4))])), path)
    one, two = _changes(25, 3, 4), _changes(5, 2, 8)
    closed = {f: os.path.getmtime(f) for f in _closed(path)}
    assert H.apply_batch(spark, path, _log(spark, one), "one") is True
    assert H.apply_batch(spark, path, _log(spark, one), "one") is False
    assert H.apply_batch(spark, path, _log(spark, two), "two") is True
    assert _rows(H.versions(spark, path)) == sorted(_key(r) for r in fold(rows))
    assert all(os.path.getmtime(f) == t for f, t in closed.items())       # closed history is never rewritten
    assert {r.batch for r in ledger.read(spark, f"{path}/ledger").collect()} == {"base", "one", "two"}
    with pytest.raises(ValueError):
        H.write_history(C.scd2_history(_log(spark, rows)), path)


def _closed(path):
    return [os.path.join(d, f) for d, _, names in os.walk(f"{path}/versions/part=closed") for f in names if f.endswith(".parquet")]


def test_a_batch_that_died_before_its_ledger_row_is_repeated(spark, tmpdir_fresh, monkeypatch):
    path = os.path.join(tmpdir_fresh, "h")
    H.write_history(C.scd2_history(_log(spark, _changes(6, 3))), path)
    before = _rows(H.versions(spark, path))

    def dies(*a, **k):
        raise RuntimeError("lost before the write")

    with monkeypatch.context() as m:
        m.setattr(H, "_write", dies)
        with pytest.raises(RuntimeError):
            H.apply_batch(spark, path, _log(spark, _changes(6, 2, 3)), "b")
    assert _rows(H.versions(spark, path)) == before
    assert H.apply_batch(spark, path, _log(spark, _changes(6, 2, 3)), "b")
    assert _rows(H.versions(spark, path)) == sorted(_key(r) for r in fold(_changes(6, 3) + _changes(6, 2, 3)))


def test_live_reads_prune_to_the_open_part(spark, tmpdir_fresh):
    path = os.path.join(tmpdir_fresh, "h")
    H.write_history(C.scd2_history(_log(spark, _changes(10, 4))), path)
    live = C.current_asset(H.open_versions(spark, path))
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*part", plan)
    assert _rows(live) == _rows(C.current_asset(H.versions(spark, path)))


@pytest.mark.parametrize("partitions", [1, 4])
def test_pages_by_prefix_counts(spark, tmpdir_fresh, partitions):
    rows = [(f"a{k:04d}", T0, k, "save", f"S{k}", "x") for k in range(300)] + [("a0007", T0 + dt.timedelta(1), 900, "delete", None, None)]
    h = C.scd2_history(_log(spark, rows)).withColumn("asset_class", F.lit("stock"))
    path = os.path.join(tmpdir_fresh, "p")
    H.write_pages(h, path, partitions)
    want = sorted(f"a{k:04d}" for k in range(300) if k != 7)
    for offset, limit in ((0, 5), (5, 3), (140, 160), (297, 20), (298, 1), (299, 5), (0, 1000)):
        assert [r.asset_id for r in H.page(spark, path, offset, limit).collect()] == want[offset:offset + limit]
    for bad in ((-1, 5), (0, 0)):
        with pytest.raises(ValueError):
            H.page(spark, path, *bad)
    if partitions > 1:
        # a deep page opens only the ranges that it lies in
        deep = H.page(spark, path, 290, 3)._jdf.queryExecution()
        assert re.search(r"PartitionFilters: \[[^\]]*_chunk", deep.executedPlan().toString())
    H.write_pages(h.filter("false"), path, partitions)
    assert H.page(spark, path, 0, 5).count() == 0


def test_names_in_the_ledger_are_plain(spark, tmpdir_fresh):
    with pytest.raises(ValueError):
        ledger.commit(spark, os.path.join(tmpdir_fresh, "l"), "x' OR 1=1", "s", 0)
    ledger.commit(spark, os.path.join(tmpdir_fresh, "l"), "b-1", "s", 4)
    assert ledger.rows_of(spark, os.path.join(tmpdir_fresh, "l"), "b-1", "s") == 4
    assert ledger.rows_of(spark, os.path.join(tmpdir_fresh, "l"), "b-1", "other") is None
