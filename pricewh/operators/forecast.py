"""Stationary features, chronological splits, regression models and the
forecast view (W1-W4, M1-M8).

One cross-asset model is trained on every asset's history at once; the
feature windows are per asset and bounded (lag 1, previous 7 rows), the
split ranks are per asset, and training is ``pyspark.ml`` (distributed
tree aggregation), never a driver loop over assets.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.functions.columns import (LABEL_FUTURE, LABEL_PAST, LABEL_TODAY,
                                       LABEL_TOMORROW, iso_date)
from pricewh.operators import windows as W
from pricewh.operators.reads import latest_n
from pricewh.session import checkpoint_dir
from pricewh.sources.sinks import materialize

FEATURES = ["prev_close", "prev_volume", "ma_7d_close", "yesterday_trend"]
LABEL = "target_return"
TRAIN_FRACTION = 0.8


def return_features(bars: DataFrame) -> DataFrame:
    """Lagged open/close/volume, mean close of the previous
    7 rows (partial frames allowed), rows with any NULL/NaN dropped, then
    yesterday's trend and the open-vs-previous-close return (rows whose
    previous close is 0 have no label and are dropped).

    The windows run per asset and range of dates with the 7 preceding rows
    copied in (``windows.with_lookback``), so no task holds a whole asset."""
    x = W.with_lookback(bars.select("asset_id", F.col("business_date").alias("bdate"),
                                    F.col("open").alias("target_open"), "close", "volume"),
                        "asset_id", "bdate", 7)
    w = W.by_chunk("asset_id")
    df = (x.withColumn("prev_open", F.lag("target_open").over(w))
           .withColumn("prev_close", F.lag("close").over(w))
           .withColumn("prev_volume", F.lag("volume").over(w))
           .withColumn("ma_7d_close", F.avg("close").over(w.rowsBetween(-7, -1)))
           .filter(~F.col("_halo")))
    df = W.drop_internal(df).dropna()
    return (df.withColumn("yesterday_trend", F.col("prev_close") - F.col("prev_open"))
              .withColumn(LABEL, F.try_divide(F.col("target_open") - F.col("prev_close"), F.col("prev_close")))
              .filter(F.col(LABEL).isNotNull()))


def chrono_split(features: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Per asset ``percent_rank`` by date; train when <= fraction.

    The rank comes from places in a range-partitioned order
    (``windows.ranked``), not from a window over the whole asset."""
    r = W.ranked(features, "asset_id", "bdate")
    pr = F.when(F.col("_n") == 1, F.lit(0.0)).otherwise(
        (F.col("_g") - 1).cast("double") / (F.col("_n") - 1).cast("double"))
    return W.drop_internal(r.withColumn("train_rank", pr)
                           .withColumn("split", F.when(F.col("train_rank") <= fraction, "train")
                                       .otherwise("test")))


def chrono_split_rows(features: DataFrame, fraction: float = TRAIN_FRACTION) -> DataFrame:
    """Per asset row number by date; the first int(fraction * n) rows
    train, the rest test."""
    r = W.ranked(features, "asset_id", "bdate")
    return W.drop_internal(
        r.withColumn("row_num", F.col("_g"))
         .withColumn("train_size", (F.col("_n") * F.lit(fraction)).cast("bigint"))
         .withColumn("split", F.when(F.col("row_num") <= F.col("train_size"), "train").otherwise("test")))


def _assemble(df: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


# Tasks of a training round: a fixed number, never derived from the data.
# Learners seed their sampling by partition, so rows must lie in the same
# partitions whatever the layout of the input.  Set it once for a cluster.
TRAIN_PARTITIONS = 8


def _persisted_split(split_df: DataFrame):
    """(training rows, test rows, the persisted frame behind both).

    Each row's partition and its place there are functions of the row alone,
    so a seeded fit gives the same model however the input is partitioned.
    """
    frame = (_assemble(split_df)
             .repartition(TRAIN_PARTITIONS, F.xxhash64("asset_id", "bdate"))
             .sortWithinPartitions("asset_id", "bdate").persist(StorageLevel.MEMORY_AND_DISK))
    return frame.filter(F.col("split") == "train"), frame.filter(F.col("split") == "test"), frame


def _gbt(seed: int = 42):
    from pyspark.ml.regression import GBTRegressor
    # checkpointInterval: every 10 boosting rounds the running predictions
    # are checkpointed (reliably, in the shared checkpoint folder), so a
    # lost executor late in training does not replay every earlier round.
    return GBTRegressor(featuresCol="features", labelCol=LABEL, maxIter=20, maxDepth=5, seed=seed,
                        checkpointInterval=10)


def train_gbt(features: DataFrame, seed: int = 42):
    """M3-M4: fit one GBT on all assets' training rows; returns the model and
    the scored test rows, written as a table in the shared folder.  Forecast
    and metrics can both be taken from one fit; nothing stays cached."""
    checkpoint_dir(features.sparkSession)
    train, test, cached = _persisted_split(chrono_split(features))
    model = _gbt(seed).fit(train)
    scored = materialize(model.transform(test).drop("features"), name="gbt-scored")
    cached.unpersist()
    return model, scored


def gbt_forecast(features: DataFrame, seed: int = 42, scored: DataFrame | None = None) -> DataFrame:
    """M6: test-row predictions turned into prices, stored one calendar day
    after the feature date (weekends not skipped); ``feature_date`` keeps
    the bar date the prediction was made for.  ``scored`` of an earlier
    ``train_gbt`` saves the fit."""
    pred = train_gbt(features, seed)[1] if scored is None else scored
    return pred.select(
        "asset_id",
        F.date_add(F.col("bdate"), 1).alias("bdate"),
        "target_open",
        (F.col("prev_close") * (F.lit(1.0) + F.col("prediction"))).alias("predicted_price_usd"),
        "prediction",
        F.to_date("bdate").alias("feature_date"),
    )


def prediction_metrics(pred: DataFrame) -> DataFrame:
    """RMSE, MAE and R² in one aggregate pass over the scored rows
    (R² = 1 - SSerr / SStot = 1 - mean(err²) / var_pop(label))."""
    err = F.col("prediction") - F.col(LABEL)
    return pred.agg(F.sqrt(F.avg(err * err)).alias("rmse"), F.avg(F.abs(err)).alias("mae"),
                    (F.lit(1.0) - F.try_divide(F.avg(err * err), F.var_pop(LABEL))).alias("r2"))


def _metrics(pred: DataFrame) -> dict:
    return prediction_metrics(pred).first().asDict()


def model_rows(split_df: DataFrame) -> DataFrame:
    """M3: what the learners see: key, split, label and the assembled vector as an array."""
    from pyspark.ml.functions import vector_to_array
    return _assemble(split_df).select("asset_id", "bdate", "split", F.col(LABEL).alias("label"),
                                      vector_to_array("features").alias("features"))


def gbt_metrics(features: DataFrame, seed: int = 42, scored: DataFrame | None = None) -> DataFrame:
    """M5: RMSE, MAE and R² of the GBT on the test rows (one row)."""
    m = _metrics(train_gbt(features, seed)[1] if scored is None else scored)
    spark = features.sparkSession
    return spark.createDataFrame([(float(m["rmse"]), float(m["mae"]), float(m["r2"]))],
                                 "rmse double, mae double, r2 double")


def model_leaderboard(features: DataFrame, seed: int = 42) -> DataFrame:
    """M7: linear regression, random forest and GBT on the row-count split,
    with RMSE and R², best (lowest RMSE) first."""
    from pyspark.ml.regression import LinearRegression, RandomForestRegressor
    checkpoint_dir(features.sparkSession)
    train, test, cached = _persisted_split(chrono_split_rows(features))
    models = [
        ("Linear Regression", LinearRegression(featuresCol="features", labelCol=LABEL, maxIter=10)),
        ("Random Forest", RandomForestRegressor(featuresCol="features", labelCol=LABEL,
                                                numTrees=50, maxDepth=5, seed=seed)),
        ("Gradient Boosted Trees", _gbt(seed)),
    ]
    rows = []
    for name, est in models:
        pred = est.fit(train).transform(test)
        m = _metrics(pred)
        rows.append((name, float(m["rmse"]), float(m["r2"])))
    cached.unpersist()
    rows.sort(key=lambda r: r[1])
    spark: SparkSession = features.sparkSession
    return spark.createDataFrame([(i + 1, *r) for i, r in enumerate(rows)],
                                 "rank int, model string, rmse double, r2 double")


def forecast_view(predictions: DataFrame, as_of, n: int = 5) -> DataFrame:
    """M8 + T3: newest n predictions per asset, labelled against ``as_of``
    (today / tomorrow / past / later), return in percent and price rounded
    to 2 places, missing values as 0."""
    t = latest_n(predictions, n, "asset_id", "bdate")
    d = F.to_date(F.col("bdate"))
    a = F.lit(str(as_of)).cast("date")
    label = (F.when(d == a, LABEL_TODAY).when(d == F.date_add(a, 1), LABEL_TOMORROW)
             .when(d < a, LABEL_PAST).otherwise(LABEL_FUTURE))
    return t.select("asset_id", "rank", iso_date(d).alias("target_date"),
                    label.alias("timeline_context"),
                    F.round(F.coalesce(F.col("prediction"), F.lit(0.0)) * 100, 2).alias("predicted_return_percentage"),
                    F.round(F.coalesce(F.col("predicted_price_usd"), F.lit(0.0)), 2).alias("predicted_price_usd"))
