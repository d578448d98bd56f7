"""Features, splits and models (rows-only in the driver check)."""

import math

from pyspark.sql import functions as F

from pricewh.operators import forecast as M
from pricewh.sources import fixtures as X

SF = "/root/testdata/sf0.001"


def test_split_sizes_per_asset(spark):
    f = M.return_features(X.daily_bars(spark, SF))
    s = M.chrono_split_rows(f).groupBy("asset_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "train").alias("tr")).collect()
    for r in s:
        assert r.tr == int(r.n * 0.8)
    p = M.chrono_split(f).groupBy("asset_id").agg(F.min("train_rank").alias("lo"),
                                                  F.max("train_rank").alias("hi")).collect()
    assert all(r.lo == 0.0 and r.hi == 1.0 for r in p)


def test_features_drop_first_row_and_zero_previous_close(spark):
    import datetime as dt
    d0 = dt.datetime(2024, 1, 1)
    rows = [("a", d0 + dt.timedelta(days=i), 1.0, c, 1.0) for i, c in enumerate([2.0, 0.0, 3.0, 4.0])]
    flat = spark.createDataFrame(rows, "asset_id string, business_date timestamp_ntz, open double, close double, volume double")
    got = M.return_features(flat).orderBy("bdate").collect()
    # row 0: no lags; row 2: previous close is 0 -> no label
    assert [r.bdate.day for r in got] == [2, 4]
    assert got[0].ma_7d_close == 2.0 and got[1].ma_7d_close == (2.0 + 0.0 + 3.0) / 3


def test_gbt_forecast_and_metrics(spark):
    f = M.return_features(X.daily_bars(spark, SF))
    out = M.gbt_forecast(f)
    n_test = M.chrono_split(f).filter("split = 'test'").count()
    rows = out.collect()
    assert len(rows) == n_test
    r = rows[0]
    assert (r.bdate - r.feature_date).days == 1
    assert math.isclose(r.predicted_price_usd,
                        f.filter((F.col("asset_id") == r.asset_id) & (F.to_date("bdate") == F.lit(r.feature_date)))
                        .first().prev_close * (1 + r.prediction))
    m = M.gbt_metrics(f).first()
    assert all(math.isfinite(x) for x in (m.rmse, m.mae, m.r2))


def test_one_fit_serves_forecast_and_metrics_and_nothing_stays_cached(spark):
    f = M.return_features(X.daily_bars(spark, SF))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    _, scored = M.train_gbt(f)
    assert M.gbt_forecast(f, scored=scored).count() == scored.count() and M.gbt_metrics(f, scored=scored).count() == 1
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_models_do_not_depend_on_the_input_layout(spark):
    f = M.return_features(X.daily_bars(spark, SF))
    boards = [{r.model: (r.rmse, r.r2) for r in M.model_leaderboard(f.repartition(n, "bdate")).collect()} for n in (1, 4, 8)]
    for other in boards[1:]:
        for model, (rmse, r2) in boards[0].items():
            assert math.isclose(other[model][0], rmse, rel_tol=1e-9) and math.isclose(other[model][1], r2, rel_tol=1e-9)


def test_leaderboard_orders_by_rmse(spark):
    lb = M.model_leaderboard(M.return_features(X.daily_bars(spark, SF))).collect()
    assert [r.model for r in lb] and len(lb) == 3
    assert [r.rmse for r in lb] == sorted(r.rmse for r in lb)


def test_forecast_view_labels(spark):
    import datetime as dt
    p = spark.createDataFrame(
        [("a", dt.date(2024, 1, d), 1.0, 10.456, 0.01234) for d in (1, 9, 10, 11, 12)] +
        [("a", dt.date(2023, 12, 1), 1.0, None, None)],
        "asset_id string, bdate date, target_open double, predicted_price_usd double, prediction double")
    got = {r.target_date: r for r in M.forecast_view(p, "2024-01-10", 5).collect()}
    assert set(got) == {"2024-01-01", "2024-01-09", "2024-01-10", "2024-01-11", "2024-01-12"}
    assert got["2024-01-10"].timeline_context == "Today's Open (Current Context)"
    assert got["2024-01-11"].timeline_context == "Tomorrow's Forecast"
    assert got["2024-01-09"].timeline_context == "Historical Backtest Prediction"
    assert got["2024-01-12"].timeline_context == "Future Forecast"
    assert got["2024-01-12"].predicted_return_percentage == 1.23 and got["2024-01-12"].predicted_price_usd == 10.46


def test_one_pass_metrics_equal_evaluator(spark):
    from pyspark.ml.evaluation import RegressionEvaluator
    f = M.return_features(X.daily_bars(spark, SF))
    _, pred = M.train_gbt(f)
    ours = M._metrics(pred)
    for m in ("rmse", "mae", "r2"):
        ref = RegressionEvaluator(labelCol=M.LABEL, predictionCol="prediction", metricName=m).evaluate(pred)
        assert math.isclose(ours[m], ref, rel_tol=1e-9, abs_tol=1e-12)
