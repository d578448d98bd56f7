"""Reads, rollups and quant operators against pandas / numpy formulas of
the original tools, on hand-made rows and on derived bars."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from pricewh.operators import quant as Q
from pricewh.operators import reads as RD
from pricewh.operators import rollups as R
from pricewh.sources import fixtures as X

SF = "/root/testdata/sf0.01"
D0 = dt.datetime(2024, 1, 1)


def _flat(spark, rows):
    return spark.createDataFrame(rows, "asset_id string, business_date timestamp_ntz, open double, "
                                       "close double, volume double")


def test_rollup_price_coalesce_and_count_includes_priceless(spark):
    rows = [(D0, {"close": 10.0, "price_usd": 99.0}), (D0 + dt.timedelta(days=1), {"price_usd": 20.0}),
            (D0 + dt.timedelta(days=2), {"yield_percent": 3.0}), (D0 + dt.timedelta(days=3), {"volume": 5.0})]
    df = spark.createDataFrame([(d, ("x", "src"), m) for d, m in rows],
                               "business_date timestamp_ntz, meta struct<asset_id:string,data_source_id:string>, "
                               "indicators map<string,double>")
    r = R.monthly_rollup(df).first()
    assert (r.period, r.interval_type) == ("2024-01", "1_month")
    assert (r.stats["count"], r.stats["high"], r.stats["low"], r.stats["average"]) == (4, 20.0, 3.0, 11.0)


def test_rollup_rounds_half_even(spark):
    df = X.to_stored(_flat(spark, [("x", D0, 0.0, 1.00005, 1.0), ("x", D0 + dt.timedelta(days=1), 0.0, 1.00015, 1.0)]))
    r = R.monthly_rollup(df).first()
    assert (r.stats["low"], r.stats["high"], r.stats["average"]) == (1.0, 1.0002, 1.0001)


def test_coverage_floors_days_like_timedelta(spark):
    rows = [("x", D0, 1.0, 1.0, 1.0), ("x", D0 + dt.timedelta(days=730, hours=23), 1.0, 1.0, 1.0)]
    r = R.coverage_report(_flat(spark, rows)).first()
    assert (r.oldest_date, r.newest_date, r.total_trading_days_stored) == ("2024-01-01", "2025-12-31", 2)
    assert r.years_of_history == round(730 / 365.25, 2)


def test_recent_bars_is_per_asset_top_n_with_group_limit(spark):
    stored = X.stored_bars(spark, SF)
    t = RD.recent_bars(stored, 30)
    assert "WindowGroupLimit" in t._jdf.queryExecution().executedPlan().toString() or \
        "WindowGroupLimit" in t._jdf.queryExecution().optimizedPlan().toString()
    got = t.groupBy("asset_id").count().collect()
    assert len(got) == 5 and all(r["count"] == 30 for r in got)
    with pytest.raises(ValueError):
        RD.recent_bars(stored, 0)


def test_range_end_is_exclusive_and_dates_strict(spark):
    stored = X.to_stored(_flat(spark, [("x", D0 + dt.timedelta(days=i), 1.0, 1.0, 1.0) for i in range(5)]))
    got = RD.bars_in_range(stored, "2024-01-02", "2024-01-04", ordered=True).collect()
    assert [r.business_date.day for r in got] == [3, 2]
    with pytest.raises(ValueError):
        RD.bars_in_range(stored, "2024/01/02", "2024-01-04")


def test_payload_attributes_default_for_empty_request(spark):
    stored = X.to_stored(_flat(spark, [("x", D0, 1.0, 2.0, 3.0)]))
    req = spark.createDataFrame([("x", "yfinance", D0, D0 + dt.timedelta(days=1)),
                                 ("x", "other", D0, D0 + dt.timedelta(days=1))],
                                "assetId string, dataSourceId string, start timestamp_ntz, end timestamp_ntz")
    got = {r.datasourceId: r for r in RD.bars_payload(stored, req).collect()}
    assert got["yfinance"].attributes == ["open", "close", "volume"]
    assert got["yfinance"]["values"] == {"open": 1.0, "close": 2.0, "volume": 3.0}
    assert got["other"].attributes == ["open", "high", "low", "close", "volume"] and got["other"].businessDate is None
    assert "attributes" not in RD.bars_payload(stored, req, include_attributes=False).columns


def _pdf(df, cols):
    return df.select(*cols).toPandas()


def test_rsi_latest_matches_pandas_rolling_formula(spark):
    bars = X.daily_bars(spark, SF)
    ours = {r.asset_id: r.current_rsi for r in Q.rsi_latest(bars, 14).collect()}
    p = _pdf(bars, ["asset_id", "business_date", "close"])
    for a, g in p.groupby("asset_id"):
        g = g.sort_values("business_date", ascending=False).head(42).sort_values("business_date")
        delta = g["close"].diff()
        gain = delta.where(delta > 0, 0).rolling(window=14).mean()
        loss = (-delta.where(delta < 0, 0)).rolling(window=14).mean()
        rsi = (100 - 100 / (1 + gain / loss)).iloc[-1]
        assert ours[a] == pytest.approx(round(rsi, 2), abs=0.011)


def test_rsi_edge_cases(spark):
    flat = [("up", D0 + dt.timedelta(days=i), 1.0, float(i + 1), 1.0) for i in range(16)]
    flat += [("flat", D0 + dt.timedelta(days=i), 1.0, 5.0, 1.0) for i in range(16)]
    flat += [("short", D0 + dt.timedelta(days=i), 1.0, 5.0, 1.0) for i in range(14)]
    got = {r.asset_id: r for r in Q.rsi_latest(_flat(spark, flat), 14).collect()}
    assert got["up"].current_rsi == 100.0 and got["up"].market_condition.startswith("Overbought")
    assert got["flat"].current_rsi is None and got["flat"].market_condition == "Neutral"
    assert "short" not in got


def test_histogram_matches_numpy(spark):
    bars = X.daily_bars(spark, SF)
    h = Q.return_histogram(bars, 365).toPandas()
    r = Q.daily_returns(bars, 365).toPandas()
    for a, g in r.groupby("asset_id"):
        counts, edges = np.histogram(g["daily_return"].to_numpy(), bins=50)
        ours = h[h.asset_id == a].sort_values("bin")
        assert ours["frequency"].tolist() == counts.tolist()
        assert np.allclose(ours["bin_low"].to_numpy(), edges[:-1])


def test_histogram_constant_series_and_zero_close(spark):
    rows = [("c", D0 + dt.timedelta(days=i), 1.0, 2.0, 1.0) for i in range(4)]
    rows += [("z", D0, 1.0, 0.0, 1.0), ("z", D0 + dt.timedelta(days=1), 1.0, 3.0, 1.0),
             ("z", D0 + dt.timedelta(days=2), 1.0, 6.0, 1.0)]
    h = Q.return_histogram(_flat(spark, rows), 365).toPandas()
    c = h[h.asset_id == "c"]
    counts, edges = np.histogram(np.zeros(3), bins=50)
    assert c.sort_values("bin")["frequency"].tolist() == counts.tolist()
    # a zero close gives an undefined change, which is dropped, not an error
    assert h[h.asset_id == "z"]["frequency"].sum() == 1


def test_correlation_matches_pandas_and_is_per_pair(spark):
    bars = X.daily_bars(spark, SF)
    pairs = Q.benchmark_pairs(bars)
    ours = {(r.asset_id_1, r.asset_id_2): r for r in Q.asset_correlation(bars, pairs, 365).collect()}
    p = _pdf(bars, ["asset_id", "business_date", "close"])
    for (a, b), r in ours.items():
        d1 = p[p.asset_id == a].nlargest(365, "business_date")[["business_date", "close"]]
        d2 = p[p.asset_id == b].nlargest(365, "business_date")[["business_date", "close"]]
        m = pd.merge(d1, d2, on="business_date").sort_values("business_date")
        c = m["close_x"].pct_change().corr(m["close_y"].pct_change())
        assert r.overlapping_trading_days == len(m)
        assert r.correlation_coefficient == pytest.approx(round(c, 4), abs=1e-4)


def test_zero_variance_correlation_is_null_and_negative_band(spark):
    rows = [(a, D0 + dt.timedelta(days=i), 1.0, c, 1.0) for i in range(5)
            for a, c in (("a", 5.0), ("b", float(i + 1)))]
    pairs = Q.pairs_from_list(spark, [("a", "b")])
    r = Q.asset_correlation(_flat(spark, rows), pairs, 365).first()
    assert r.correlation_coefficient is None and r.interpretation == "Negatively Correlated"


def test_growth_since_first_shared_day(spark):
    rows = [("a", D0 + dt.timedelta(days=i), 1.0, 10.0 * (i + 1), 1.0) for i in range(3)]
    rows += [("b", D0 + dt.timedelta(days=i), 1.0, 4.0, 1.0) for i in range(1, 3)]
    g = Q.pair_growth(_flat(spark, rows), Q.pairs_from_list(spark, [("a", "b")]), 90).orderBy("date").collect()
    assert [r.date for r in g] == ["2024-01-02", "2024-01-03"]
    assert [r.growth1 for r in g] == [0.0, 50.0] and [r.growth2 for r in g] == [0.0, 0.0]


def test_intraday_bars_rollup_and_coverage(spark):
    bars = X.intraday_bars(spark, SF)
    cov = {r.asset_id: r for r in R.coverage_report(bars).collect()}
    ev = spark.read.parquet(SF + "/events.parquet")
    assert set(cov) == {r.event_type + "_usd_crypto_01" for r in ev.select("event_type").distinct().collect()}
    total = sum(r.total_trading_days_stored for r in cov.values())
    assert total == bars.count()
    roll = R.flatten_rollups(R.monthly_rollup(X.to_stored(bars))).collect()
    assert sum(r["count"] for r in roll) == total
    assert all(r.low <= r.average <= r.high for r in roll)


def test_aligned_pairs_with_hot_asset_on_both_sides(spark):
    rows = [(a, D0 + dt.timedelta(days=d), 1.0, float(10 * i + d + 1), 1.0)
            for i, a in enumerate("abcdef") for d in range(12) if (d + i) % 5]
    flat = _flat(spark, rows)
    pairs = [("a", x) for x in "bcdef"] + [(x, "a") for x in "bcd"] + [("b", "c"), ("a", "b")]
    got = Q.aligned_pairs(flat, Q.pairs_from_list(spark, pairs), 8).toPandas()
    p = pd.DataFrame(rows, columns=["asset_id", "business_date", "open", "close", "volume"])
    p = p.sort_values("business_date").groupby("asset_id").tail(8)
    want = []
    for a1, a2 in set(pairs):
        m = pd.merge(p[p.asset_id == a1], p[p.asset_id == a2], on="business_date")
        want += [(a1, a2, d.date(), x, y) for d, x, y in zip(m.business_date, m.close_x, m.close_y)]
    assert sorted(map(tuple, got[["asset_id_1", "asset_id_2", "date", "price1", "price2"]].values.tolist())) \
        == sorted(want)


def test_correlation_many_pairs_share_a_benchmark(spark):
    bars = X.daily_bars(spark, SF, by="nation")
    pairs = Q.benchmark_pairs(bars)
    ours = {(r.asset_id_1, r.asset_id_2): r for r in Q.asset_correlation(bars, pairs, 365).collect()}
    assert len(ours) == 24
    p = bars.select("asset_id", "business_date", "close").toPandas()
    bench = min(p.asset_id)
    d1 = p[p.asset_id == bench].nlargest(365, "business_date")
    for (a, b), r in ours.items():
        assert a == bench
        d2 = p[p.asset_id == b].nlargest(365, "business_date")
        m = pd.merge(d1, d2, on="business_date").sort_values("business_date")
        c = m["close_x"].pct_change().corr(m["close_y"].pct_change())
        assert r.overlapping_trading_days == len(m)
        if np.isnan(c):
            assert r.correlation_coefficient is None
        else:
            assert r.correlation_coefficient == pytest.approx(round(c, 4), abs=1e-4)


def test_pairs_run_no_job_while_planning(spark):
    bars = X.daily_bars(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan-only", "no job may run while the plan is built")
    df = Q.asset_correlation(bars, Q.benchmark_pairs(bars), 365)
    assert not tracker.getJobIdsForGroup("plan-only")
    spark.sparkContext.setJobGroup("run", "")
    assert "date" not in [f.name for f in df.schema] and df.count() == 4
    assert "CartesianProduct" not in df._jdf.queryExecution().executedPlan().toString()


def test_large_and_infinite_prices_spoil_no_other_asset(spark):
    inf, nan = float("inf"), float("nan")
    rows = [("big", D0, 1.0, 1e31, 1.0), ("big", D0 + dt.timedelta(days=1), 1.0, 3e31, 1.0),
            ("inf", D0, 1.0, inf, 1.0), ("nan", D0, 1.0, nan, 1.0), ("nan", D0 + dt.timedelta(days=1), 1.0, 4.0, 1.0),
            ("ok", D0, 1.0, 2.00005, 1.0)]
    got = {r.asset_id: r.stats for r in R.monthly_rollup(X.to_stored(_flat(spark, rows))).collect()}
    assert got["big"].high == 3e31 and got["big"].average == 2e31
    assert got["inf"].high == inf
    assert (got["nan"]["count"], got["nan"].average) == (2, 4.0)
    assert got["ok"].average == round(2.00005, 4)
