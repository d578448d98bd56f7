"""Aggregations over bars: monthly rollup (A1), yearly counts (A2),
coverage (A3).  All are hash aggregates with a map-side partial step, so a
hot asset is combined locally before the shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.functions.columns import MONTH_INTERVAL, price_of

# Averages are summed in fixed point so the result does not depend on how
# rows are spread over partitions (floating sums do); 8 places is far below
# the 4 places the rollup keeps.
AVG_SCALE = 8
# Prices up to this size fit the fixed-point sum; a month with a larger (or
# infinite) price falls back to a floating average.
FIXED_MOST = 1e22


def monthly_rollup(stored: DataFrame) -> DataFrame:
    """Per asset and ``yyyy-MM`` of business_date: count of bars, and the
    high, low and average of the first non-null of close / price_usd /
    yield_percent, rounded half-even to 4 places, nested in ``stats``.  NaN
    prices count as none.

    ``count`` counts every bar, also those without any price.
    """
    return finished(partial_rollup(stored))


#: How each column of a partial rollup adds up over parts of the bars.
ADDS_UP = {"n": F.sum, "hi": F.max, "lo": F.min, "n_price": F.sum, "n_large": F.sum, "float_sum": F.sum, "fx": F.sum}


def partial_rollup(stored: DataFrame) -> DataFrame:
    """A month's statistics per asset in a form that merges: counts, extremes and sums, not averages."""
    price = price_of("indicators")
    small = F.abs(F.col("price")) <= F.lit(FIXED_MOST)
    return (stored
            .select(F.col("meta.asset_id").alias("asset_id"),
                    F.date_format("business_date", "yyyy-MM").alias("period"),
                    F.when(~F.isnan(price), price).alias("price"))
            .groupBy("asset_id", "period")
            .agg(F.count(F.lit(1)).alias("n"),
                 F.max("price").alias("hi"),
                 F.min("price").alias("lo"),
                 F.sum(F.when(F.col("price").isNotNull(), 1).otherwise(0)).alias("n_price"),
                 F.count_if(~small).alias("n_large"),
                 F.sum("price").alias("float_sum"),
                 F.sum(F.when(small, F.round(F.col("price") * F.lit(10.0 ** AVG_SCALE)).try_cast("decimal(38,0)")))
                 .cast("decimal(38,0)").alias("fx")))


def merged(partials: DataFrame) -> DataFrame:
    """One partial rollup a month and asset from any number of them.  The merge is exact: it gives what the
    bars behind them give at once (but for the floating sum, which only months with prices above
    ``FIXED_MOST`` use)."""
    return (partials.groupBy("asset_id", "period")
            .agg(*[add(c).cast(partials.schema[c].dataType).alias(c) for c, add in ADDS_UP.items()]))


def finished(partials: DataFrame) -> DataFrame:
    """Rollups from merged partial ones."""
    n_price = F.col("n_price").cast("double")
    avg = (F.when(F.col("n_large") > 0, F.try_divide(F.col("float_sum"), n_price))
           .otherwise(F.try_divide(F.col("fx").cast("double"), n_price) / F.lit(10.0 ** AVG_SCALE)))
    g = partials.withColumn("avg", F.when(F.col("n_price") > 0, avg))
    return g.select(
        "asset_id",
        F.lit(MONTH_INTERVAL).alias("interval_type"),
        "period",
        F.struct(F.col("n").alias("count"),
                 _places("hi").alias("high"),
                 _places("lo").alias("low"),
                 _places("avg").alias("average")).alias("stats"),
    )


def _places(name: str):
    """Half-even to 4 places; a value too large to have any stays as it is."""
    c = F.col(name)
    return F.when(F.abs(c) <= F.lit(FIXED_MOST), F.bround(c, 4)).otherwise(c)


def flatten_rollups(r: DataFrame, *extra: str) -> DataFrame:
    return r.select("asset_id", "interval_type", "period", *extra,
                    F.col("stats.count").alias("count"), F.col("stats.high").alias("high"),
                    F.col("stats.low").alias("low"), F.col("stats.average").alias("average"))


def yearly_counts(bars: DataFrame) -> DataFrame:
    """Bars per asset and calendar year (``asset_id`` column expected)."""
    return (bars.groupBy("asset_id", F.year("business_date").cast("bigint").alias("business_date_year"))
            .agg(F.count(F.lit(1)).alias("cnt")))


def coverage_report(bars: DataFrame) -> DataFrame:
    """Oldest and newest bar, bar count, whole days / 365.25 rounded to 2.

    Whole days come from the timestamp difference (not ``datediff``) so a
    time-of-day part is floored like Python's ``timedelta.days``.
    """
    g = (bars.groupBy("asset_id")
         .agg(F.min("business_date").alias("oldest"), F.max("business_date").alias("newest"),
              F.count(F.lit(1)).alias("total_trading_days_stored")))
    days = F.expr("extract(DAY FROM newest - oldest)").cast("bigint")
    return g.select(
        "asset_id",
        F.date_format("oldest", "yyyy-MM-dd").alias("oldest_date"),
        F.date_format("newest", "yyyy-MM-dd").alias("newest_date"),
        "total_trading_days_stored",
        F.round(days / F.lit(365.25), 2).alias("years_of_history"),
    )
