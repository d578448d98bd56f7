"""Versioned catalogue: the original SCD2 facts, the quirks Q3/Q4, and a
property test of the set operator against a sequential fold of the
save/delete rules (also for any cut of the log and incremental batches)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pricewh.operators import catalogue as C

SCHEMA = "asset_id string, change_ts timestamp_ntz, seq bigint, op string, symbol string, attr string"


def _log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def fold(rows, skip_unchanged=False):
    """The original rules applied one change at a time."""
    out, live, life = [], {}, {}
    for a, ts, seq, op, sym, attr in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        cur = live.get(a)
        if op == "save" and skip_unchanged and cur is not None and (cur["symbol"], cur["attr"]) == (sym, attr):
            continue
        if op == "save":
            if cur is not None:
                cur["valid_to"] = ts
            row = dict(asset_id=a, life=life.get(a, 0), version=cur["version"] + 1 if cur else 1,
                       valid_from=ts, valid_to=None, is_deleted=False, seq=seq, symbol=sym, attr=attr)
            out.append(row)
            live[a] = row
        elif cur is not None:
            cur["valid_to"] = ts
            out.append(dict(cur, version=cur["version"] + 1, valid_from=ts, valid_to=None,
                            is_deleted=True, seq=seq))
            live[a] = None
            life[a] = life.get(a, 0) + 1
    return out


def _key(r):
    return (r["asset_id"], r["life"], r["version"], r["valid_from"], r["valid_to"], r["is_deleted"],
            r["seq"], r["symbol"], r["attr"])


def _rows(df):
    return sorted(_key(r.asDict()) for r in df.collect())


T0 = dt.datetime(2024, 1, 1)


def test_new_asset_is_version_one_open(spark):
    h = C.scd2_history(_log(spark, [("test_stock_01", T0, 1, "save", "TEST", "x")])).first()
    assert (h.version, h.is_deleted, h.valid_to, h.valid_from) == (1, False, None, T0)


def test_save_existing_bumps_version_and_closes_previous(spark):
    t1 = T0 + dt.timedelta(hours=1)
    h = C.scd2_history(_log(spark, [("a", T0, 1, "save", "TEST", "x"), ("a", t1, 2, "save", "TEST-UPDATED", "y")]))
    got = {r.version: r for r in h.collect()}
    assert got[1].valid_to == t1 and got[2].valid_to is None and got[2].symbol == "TEST-UPDATED"


def test_delete_inserts_open_tombstone_copy(spark):
    t1 = T0 + dt.timedelta(days=1)
    h = C.scd2_history(_log(spark, [("a", T0, 1, "save", "S", "x"), ("a", t1, 2, "delete", None, None)]))
    got = {r.version: r for r in h.collect()}
    assert got[1].valid_to == t1
    tomb = got[2]
    assert (tomb.is_deleted, tomb.valid_to, tomb.symbol, tomb.attr) == (True, None, "S", "x")
    assert C.current_asset(h).count() == 0


def test_delete_without_live_version_is_noop_and_save_restarts_at_one(spark):
    rows = [("a", T0, 1, "delete", None, None),
            ("a", T0 + dt.timedelta(days=1), 2, "save", "S", "x"),
            ("a", T0 + dt.timedelta(days=2), 3, "delete", None, None),
            ("a", T0 + dt.timedelta(days=3), 4, "delete", None, None),
            ("a", T0 + dt.timedelta(days=4), 5, "save", "S2", "y")]
    h = sorted(((r.life, r.version, r.is_deleted, r.valid_to is None) for r in
                C.scd2_history(_log(spark, rows)).collect()))
    # Q3: after a delete the next save starts over at version 1 in a new life
    assert h == [(0, 1, False, False), (0, 2, True, True), (1, 1, False, True)]


def test_paging_and_sources(spark):
    from pricewh.operators.catalogue import active_assets, data_source_detail, data_sources
    import pytest
    from pyspark.sql import functions as F
    rows = [(f"a{i}", T0, i, "save", f"S{i}", "x") for i in range(5)]
    h = C.scd2_history(_log(spark, rows)).withColumn(
        "asset_class", F.lit("stock")).withColumn("attributes", F.create_map(F.lit("source"), F.lit("yfinance")))
    assert [r.asset_id for r in active_assets(h, 1, 2).collect()] == ["a1", "a2"]
    with pytest.raises(ValueError):
        active_assets(h, 0, 0)
    with pytest.raises(ValueError):
        active_assets(h, -1, 5)
    assert [r.data_source_id for r in data_sources(h).collect()] == ["yfinance"]
    req = spark.createDataFrame([("yfinance",), ("nope",)], "s string")
    got = data_source_detail(h, req).collect()
    assert [(r.dataSourceId, r.description) for r in got] == [("yfinance", "Data integration for Yfinance")]


change = st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 5), st.integers(0, 23),
                   st.sampled_from(["save", "save", "delete"]), st.sampled_from(["x", "y", "z"]))


def _to_rows(changes):
    return [(a, T0 + dt.timedelta(days=d, hours=h), i, op, None if op == "delete" else a.upper(),
             None if op == "delete" else attr)
            for i, (a, d, h, op, attr) in enumerate(changes)]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25))
def test_set_operator_equals_sequential_fold(spark, changes):
    rows = _to_rows(changes)
    assert _rows(C.scd2_history(_log(spark, rows))) == sorted(_key(r) for r in fold(rows))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25), st.integers(1, 5))
def test_apply_batch_equals_one_pass(spark, changes, cut_day):
    rows = _to_rows(changes)
    cut = T0 + dt.timedelta(days=cut_day)
    old = [r for r in rows if r[1] < cut]
    new = [r for r in rows if r[1] >= cut]
    hist = C.scd2_history(_log(spark, old))
    applied = C.scd2_apply(hist, _log(spark, new))
    assert _rows(applied) == sorted(_key(r) for r in fold(rows))


def test_apply_chain_on_stored_tables(spark, tmpdir_fresh):
    import os
    import pytest
    from pricewh.sources.sinks import materialize
    rows = _to_rows([("a", d, 1, op, "x") for d, op in enumerate(["save", "save", "delete", "save", "save"])])
    base = materialize(C.scd2_history(_log(spark, rows[:2])), os.path.join(tmpdir_fresh, "v0"))
    v1 = C.scd2_apply_stored(spark, os.path.join(tmpdir_fresh, "v0"), _log(spark, rows[2:4]),
                             os.path.join(tmpdir_fresh, "v1"))
    v2 = C.scd2_apply_stored(spark, os.path.join(tmpdir_fresh, "v1"), _log(spark, rows[4:]),
                             os.path.join(tmpdir_fresh, "v2"))
    assert base.count() == 2 and v1.count() == 4
    assert _rows(v2) == sorted(_key(r) for r in fold(rows))
    with pytest.raises(ValueError):
        C.scd2_apply_stored(spark, os.path.join(tmpdir_fresh, "v2"), _log(spark, rows[4:]),
                            os.path.join(tmpdir_fresh, "v2"))
    # without a path the table lands under the session's checkpoint folder
    m = materialize(C.scd2_history(_log(spark, rows[:1])))
    assert m.count() == 1
    from pricewh.session import checkpoint_dir
    assert checkpoint_dir(spark).replace("file:", "") in m.inputFiles()[0]


def _cut_anywhere(spark, rows, cuts):
    """The log as runs that end behind the given places of its order."""
    ordered = sorted(rows, key=lambda r: (r[0], r[1], r[2]))
    return spark.createDataFrame([(*r, sum(c <= i for c in cuts), i) for i, r in enumerate(ordered)],
                                 SCHEMA + ", _chunk int, _id bigint")


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25), st.lists(st.integers(0, 25), max_size=12), st.booleans())
def test_any_cut_of_the_log_gives_the_fold(spark, changes, cuts, skip):
    """Summaries of runs merge to the same history wherever the log is cut, inside equal times too."""
    rows = _to_rows(changes)
    runs = _cut_anywhere(spark, rows, cuts)
    got = C._scan(C.drop_unchanged_saves(runs) if skip else runs, seeded=False).drop("_seed")
    assert _rows(got) == sorted(_key(r) for r in fold(rows, skip))


def test_partitions_agree(spark):
    rows = _to_rows([("a", d % 3, (7 * d) % 24, op, "x") for d, op in
                     enumerate(["save", "delete", "save", "save", "delete", "delete", "save"])])
    want = sorted(_key(r) for r in fold(rows))
    for partitions in (None, 1, 3, 7):
        assert _rows(C.scd2_history(_log(spark, rows), partitions=partitions)) == want


def test_one_asset_with_a_third_of_the_log_in_one_hour_spreads(spark):
    from pyspark.sql import functions as F
    log = spark.range(0, 12_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("a"), (F.col("id") % 900).cast("string"))).alias("asset_id"),
        (F.lit(T0) + F.make_dt_interval(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40))).alias("change_ts"),
        F.col("id").alias("seq"), F.when(F.col("id") % 5 == 4, "delete").otherwise("save").alias("op"),
        F.lit("S").alias("symbol"), F.col("id").cast("string").alias("attr"))
    runs = C._runs(log, 12)
    sizes = [r["count"] for r in runs.groupBy("_chunk").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2000
    assert runs.filter("asset_id = 'hot'").select("_chunk").distinct().count() >= 4
    rows = [tuple(r) for r in log.collect()]
    assert _rows(C._scan(runs, seeded=False).drop("_seed")) == sorted(_key(r) for r in fold(rows))


def test_the_log_is_sorted_once_and_joined_without_a_shuffle(spark):
    rows = _to_rows([(a, d, 1, "save", "x") for a in "abcd" for d in range(3)])
    runs = C._runs(_log(spark, rows), 3)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = C._scan(runs, seeded=False)._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
        assert _rows(C._scan(runs, seeded=False).drop("_seed")) == sorted(_key(r) for r in fold(rows))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    of_cut = {r.asset_id for r in C._of_cut_assets(runs).collect()}
    cut = {r.asset_id for r in runs.groupBy("asset_id").agg({"_chunk": "min"}).collect()
           if runs.filter(runs.asset_id == r.asset_id).select("_chunk").distinct().count() > 1}
    assert of_cut == cut


def test_tasks_of_the_scan_grow_in_number_not_in_size(spark, monkeypatch):
    rows = _to_rows([(a, d, 1, "save", "x") for a in "abcd" for d in range(6)])
    monkeypatch.setattr(C, "ROWS", 4)
    runs = C._runs(_log(spark, rows), 3)
    assert C._dealt(runs).rdd.getNumPartitions() == 7
    assert _rows(C._scan(runs, seeded=False).drop("_seed")) == sorted(_key(r) for r in fold(rows))


def test_null_assets_are_one_asset_and_null_times_fail(spark):
    import pytest
    rows = [(None, T0 + dt.timedelta(hours=i), i, op, "S", "x") for i, op in enumerate(["save", "delete", "delete", "save"])]
    got = sorted(((r.life, r.version, r.is_deleted) for r in C.scd2_history(_log(spark, rows), partitions=3).collect()))
    assert got == [(0, 1, False), (0, 2, True), (1, 1, False)]
    part = C.scd2_apply(C.scd2_history(_log(spark, rows[:2])), _log(spark, rows[2:]))
    assert sorted((r.life, r.version, r.is_deleted) for r in part.collect()) == got
    with pytest.raises(Exception, match="no change_ts"):
        C.scd2_history(_log(spark, rows + [("a", None, 9, "save", "S", "x")]))


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(change, min_size=1, max_size=25), st.integers(1, 5))
def test_skip_unchanged_equals_fold(spark, changes, cut_day):
    rows = _to_rows(changes)
    want = sorted(_key(r) for r in fold(rows, skip_unchanged=True))
    assert _rows(C.scd2_history(_log(spark, rows), skip_unchanged=True)) == want
    cut = T0 + dt.timedelta(days=cut_day)
    hist = C.scd2_history(_log(spark, [r for r in rows if r[1] < cut]), skip_unchanged=True)
    applied = C.scd2_apply(hist, _log(spark, [r for r in rows if r[1] >= cut]), skip_unchanged=True)
    assert _rows(applied) == want


def test_skip_unchanged_compares_maps_by_content(spark):
    from pyspark.sql import functions as F
    log = spark.createDataFrame(
        [("a", T0, 1, "save", {"source": "x", "currency": "USD"}),
         ("a", T0 + dt.timedelta(days=1), 2, "save", {"currency": "USD", "source": "x"}),
         ("a", T0 + dt.timedelta(days=2), 3, "save", {"currency": "USD", "source": "y"})],
        "asset_id string, change_ts timestamp_ntz, seq bigint, op string, attributes map<string,string>")
    h = C.scd2_history(log, skip_unchanged=True).orderBy("version").collect()
    assert [(r.version, r.seq) for r in h] == [(1, 1), (2, 3)]
    assert C.scd2_history(log).count() == 3


def test_apply_rejects_late_changes(spark):
    import pytest
    rows = _to_rows([("a", 2, 0, "save", "x"), ("a", 3, 0, "save", "y")])
    hist = C.scd2_history(_log(spark, rows))
    late = _to_rows([("a", 1, 0, "save", "z")])
    with pytest.raises(Exception, match="not later than the stored history"):
        C.scd2_apply(hist, _log(spark, late)).collect()
