"""Returns, RSI, pair correlation and growth, return histograms
(W5-W8, A5, A6, C1, C4).

Inputs are flat bars ``asset_id, business_date, close, ...``.  Pair
operators take an explicit pairs table ``asset_id_1, asset_id_2`` and join
each requested pair's series on the calendar day, so the output grows with
the requested pairs, never with all pairs of assets sharing a day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pricewh.functions.columns import (correlation_label, iso_date, pct_change,
                                       rsi_label)
from pricewh.operators import windows as W
from pricewh.operators.reads import latest_n

HIST_BINS = 50


def _by_asset():
    return Window.partitionBy("asset_id").orderBy("business_date")


def daily_returns(bars: DataFrame, n: int = 365) -> DataFrame:
    """Per asset, newest n bars oldest-first, close-to-close change x100,
    first bar (no predecessor) and undefined changes dropped."""
    t = latest_n(bars.select("asset_id", "business_date", "close"), n, "asset_id", "business_date")
    r = pct_change("close", F.lag("close").over(_by_asset())) * F.lit(100.0)
    return (t.withColumn("daily_return", r).filter(F.col("daily_return").isNotNull())
            .select("asset_id", "business_date", "close", "daily_return"))


def _rsi_cols(df: DataFrame, periods: int, w=None) -> DataFrame:
    if periods < 1:
        raise ValueError("periods must be >= 1")
    w = _by_asset() if w is None else w
    delta = F.col("close") - F.lag("close").over(w)
    df = df.withColumn("_delta", delta)
    gain = F.when(F.col("_delta") > 0, F.col("_delta")).otherwise(F.lit(0.0))
    loss = F.when(F.col("_delta") < 0, -F.col("_delta")).otherwise(F.lit(0.0))
    frame = w.rowsBetween(-(periods - 1), 0)
    df = (df.withColumn("_avg_gain", F.avg(gain).over(frame))
            .withColumn("_avg_loss", F.avg(loss).over(frame))
            .withColumn("_k", F.count(F.lit(1)).over(frame)))
    ag, al = F.col("_avg_gain"), F.col("_avg_loss")
    rsi = (F.when(F.col("_k") < periods, F.lit(None))
           .when((al == 0) & (ag == 0), F.lit(None))
           .when(al == 0, F.lit(100.0))
           .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + ag / al)))
    return df.withColumn("rsi", rsi.cast("double")).withColumn("_full", F.col("_k") >= periods)


def rsi_series(bars: DataFrame, periods: int = 14) -> DataFrame:
    """W8 over the whole history: simple rolling means of gains and losses
    over ``periods`` rows; rows without a full frame are left out.  Runs per
    asset and range of dates with the ``periods`` preceding bars copied in
    (``windows.with_lookback``), so no task holds a whole asset."""
    x = W.with_lookback(bars.select("asset_id", "business_date", "close"), "asset_id", "business_date", periods)
    df = _rsi_cols(x, periods, W.by_chunk("asset_id")).filter(~F.col("_halo"))
    return (df.filter("_full")
            .select("asset_id", "business_date", "close", "rsi",
                    rsi_label("rsi").alias("market_condition")))


def rsi_latest(bars: DataFrame, periods: int = 14) -> DataFrame:
    """W8 as the tool reports it: RSI at the newest bar from the newest
    3 x periods bars; assets with fewer than periods + 1 bars are omitted."""
    t = latest_n(bars.select("asset_id", "business_date", "close"), 3 * periods, "asset_id", "business_date")
    t = t.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("asset_id")))
    df = _rsi_cols(t, periods).filter((F.col("rank") == 1) & (F.col("_n") >= periods + 1))
    return df.select("asset_id", F.round("rsi", 2).alias("current_rsi"),
                     rsi_label("rsi").alias("market_condition"))


def pairs_from_list(spark: SparkSession, pairs: list[tuple[str, str]]) -> DataFrame:
    return spark.createDataFrame(pairs, "asset_id_1 string, asset_id_2 string")


def benchmark_pairs(bars: DataFrame, benchmark: str | None = None) -> DataFrame:
    """Every asset paired with one benchmark asset (default: smallest id, a
    scalar subquery of the same plan).  Linear in the number of assets."""
    ids = bars.select("asset_id").distinct()
    one = F.lit(benchmark) if benchmark is not None else bars.agg(F.min("asset_id")).scalar()
    return (ids.withColumn("asset_id_1", one).filter(F.col("asset_id") != F.col("asset_id_1"))
            .select("asset_id_1", F.col("asset_id").alias("asset_id_2")))


def aligned_pairs(bars: DataFrame, pairs: DataFrame, n: int) -> DataFrame:
    """Each pair's newest-n closes (taken per asset first) inner-joined
    on the UTC calendar day.

    An asset's newest-n series is packed into one row (a map of at most n
    days), so each side of the pair list needs one join that adds one row a
    pair, and days are matched inside the row.  An asset that sits in very
    many pairs (a benchmark) makes a skewed sort-merge join, whose pair side
    Spark splits (``spark.sql.adaptive.skewJoin``): no count of partners is
    needed beforehand and none is capped."""
    recent = (latest_n(bars.select("asset_id", "business_date", "close"), n, "asset_id", "business_date")
              .groupBy("asset_id", F.to_date("business_date").alias("date")).agg(F.collect_list(
                  F.struct("close")).alias("closes"))
              .groupBy("asset_id").agg(F.map_from_entries(F.collect_list(F.struct("date", "closes"))).alias("days")))
    side = {s: recent.select(F.col("asset_id").alias(f"asset_id_{s}"), F.col("days").alias(f"days{s}")) for s in (1, 2)}
    both = (pairs.select("asset_id_1", "asset_id_2").distinct()
            .join(side[2], "asset_id_2").join(side[1], "asset_id_1"))
    return (both.select("asset_id_1", "asset_id_2", F.explode("days1").alias("date", "closes1"), "days2")
            .withColumn("closes2", F.try_element_at("days2", "date")).filter("closes2 IS NOT NULL")
            .select("asset_id_1", "asset_id_2", "date", F.explode("closes1").alias("c1"), "closes2")
            .select("asset_id_1", "asset_id_2", "date", F.col("c1.close").alias("price1"),
                    F.explode("closes2").alias("c2"))
            .select("asset_id_1", "asset_id_2", "date", "price1", F.col("c2.close").alias("price2")))


def _by_pair():
    return Window.partitionBy("asset_id_1", "asset_id_2").orderBy("date")


def asset_correlation(bars: DataFrame, pairs: DataFrame, n: int = 365) -> DataFrame:
    """A5 + W5: Pearson correlation of day-over-day changes of the *joined*
    series.  Undefined (too few rows, zero variance) is NULL, which falls
    into the last band, as the original's NaN does."""
    j = aligned_pairs(bars, pairs, n)
    w = _by_pair()
    j = (j.withColumn("r1", pct_change("price1", F.lag("price1").over(w)))
          .withColumn("r2", pct_change("price2", F.lag("price2").over(w))))
    both = F.col("r1").isNotNull() & F.col("r2").isNotNull()
    x, y = F.when(both, F.col("r1")), F.when(both, F.col("r2"))
    g = (j.groupBy("asset_id_1", "asset_id_2")
         .agg(F.count(F.lit(1)).alias("overlapping_trading_days"),
              F.try_divide(F.covar_samp(x, y), F.stddev_samp(x) * F.stddev_samp(y)).alias("corr")))
    return g.select("asset_id_1", "asset_id_2", "overlapping_trading_days",
                    F.round("corr", 4).alias("correlation_coefficient"),
                    correlation_label("corr").alias("interpretation"))


def pair_growth(bars: DataFrame, pairs: DataFrame, n: int = 90) -> DataFrame:
    """C1 + W7: growth in percent of both closes since the first shared day."""
    j = aligned_pairs(bars, pairs, n)
    first = _by_pair().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    g1 = pct_change("price1", F.first("price1").over(first)) * F.lit(100.0)
    g2 = pct_change("price2", F.first("price2").over(first)) * F.lit(100.0)
    return j.select("asset_id_1", "asset_id_2", iso_date("date").alias("date"),
                    "price1", "price2", g1.alias("growth1"), g2.alias("growth2"))


def return_histogram(bars: DataFrame, n: int = 365, bins: int = HIST_BINS) -> DataFrame:
    """A6 + C4: equal-width histogram of each asset's daily returns.

    Bin edges are ``lo + i * (hi - lo) / bins`` with the last edge = hi;
    the last bin is closed; a constant series uses [x - 0.5, x + 0.5].
    Bin assignment reproduces numpy's (scale, floor, then correct against
    the edges).  All ``bins`` bins are returned, empty ones with 0.
    """
    r = daily_returns(bars, n)
    st = (r.groupBy("asset_id").agg(F.min("daily_return").alias("mn"), F.max("daily_return").alias("mx"))
          .select("asset_id",
                  F.when(F.col("mn") == F.col("mx"), F.col("mn") - 0.5).otherwise(F.col("mn")).alias("lo"),
                  F.when(F.col("mn") == F.col("mx"), F.col("mx") + 0.5).otherwise(F.col("mx")).alias("hi")))
    st = st.withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))

    def edge(i):
        return F.when(i >= bins, F.col("hi")).otherwise(i.cast("double") * F.col("step") + F.col("lo"))

    x = F.col("daily_return")
    i0 = F.least(F.floor((x - F.col("lo")) * (F.lit(float(bins)) / (F.col("hi") - F.col("lo")))).cast("int"),
                 F.lit(bins - 1))
    c = r.select("asset_id", "daily_return").join(st, "asset_id").withColumn("_i", i0)
    c = c.withColumn("_i", F.when(x < edge(F.col("_i")), F.col("_i") - 1).otherwise(F.col("_i")))
    c = c.withColumn("_i", F.when((x >= edge(F.col("_i") + 1)) & (F.col("_i") != bins - 1), F.col("_i") + 1)
                     .otherwise(F.col("_i")))
    counts = c.groupBy("asset_id", F.col("_i").alias("bin")).agg(F.count(F.lit(1)).alias("frequency"))
    grid = st.select("asset_id", "lo", "hi", "step",
                     F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (grid.join(counts, ["asset_id", "bin"], "left")
            .select("asset_id", F.col("bin").cast("bigint").alias("bin"),
                    edge(F.col("bin")).alias("bin_low"), edge(F.col("bin") + 1).alias("bin_high"),
                    F.coalesce(F.col("frequency"), F.lit(0)).alias("frequency")))
