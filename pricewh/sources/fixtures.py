"""Inputs derived from the supplied tables.

The original application reads vendor APIs and a document store; here the same shapes
are derived, with Spark, from the TPC-H-like tables so that every query's
work grows with the data.  The matching DuckDB SQL lives in
``pricewh.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.functions.columns import (DEFAULT_CURRENCY, DESCRIPTION_PREFIX, PROVIDER_ALT,
                                       PROVIDER_DEFAULT, VENDOR_SERIES_KEY,
                                       canonical_asset_id, trunc_hour)
from pricewh.sources.tables import table

FIXTURE_INGEST_ID = "job_etl_fixture"
FIXTURE_SYSTEM_DATE = "2026-01-01 00:00:00"


def daily_bars(spark: SparkSession, sf_dir: str, by: str = "segment") -> DataFrame:
    """Flat daily bars: one asset per market segment, nation or customer, or
    (``all``) per customer and per segment: assets grow with the data, and
    the segments are hot ones among them.

    open/close are the first/last order price of the day by order key and
    volume the number of orders.  ``min_by``/``max_by`` are partial
    aggregates, so a hot (asset, day) is combined map-side before the
    shuffle and no join back to ``orders`` is needed.
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    if by == "segment":
        c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
        sym = F.col("c_mktsegment")
    elif by == "nation":
        c = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
        sym = F.concat(F.lit("N"), F.col("c_nationkey").cast("string"))
    elif by == "customer":
        return _day_bars(o, F.concat(F.lit("C"), F.col("o_custkey").cast("string")))
    elif by == "all":
        return daily_bars(spark, sf_dir).unionByName(daily_bars(spark, sf_dir, "customer"))
    else:
        raise ValueError(f"unknown asset key {by!r}")
    return _day_bars(o.join(c, o.o_custkey == c.c_custkey), sym)


def _day_bars(orders: DataFrame, sym: Column) -> DataFrame:
    return (orders
            .groupBy(canonical_asset_id(sym).alias("asset_id"),
                     F.col("o_orderdate").alias("business_date"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly bars from ``events``: one crypto pair per event type."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "event_type", "value")
    return (e.groupBy(F.concat(F.col("event_type"), F.lit("_usd_crypto_01")).alias("asset_id"),
                      trunc_hour("ts").alias("business_date"))
            .agg(F.min_by("value", "event_id").alias("open"),
                 F.max_by("value", "event_id").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def to_stored(flat: DataFrame, provider: str = PROVIDER_DEFAULT,
              ingest_id: str = FIXTURE_INGEST_ID,
              system_date: str = FIXTURE_SYSTEM_DATE) -> DataFrame:
    """Flat bars -> stored bar documents (meta struct + indicator map)."""
    return flat.select(
        F.col("business_date"),
        F.lit(system_date).cast("timestamp_ntz").alias("system_date"),
        F.struct(F.col("asset_id"), F.lit(provider).alias("data_source_id")).alias("meta"),
        F.create_map(F.lit("open"), F.col("open"), F.lit("close"), F.col("close"),
                     F.lit("volume"), F.col("volume")).alias("indicators"),
        F.lit(ingest_id).alias("ingest_id"),
        F.lit(0).alias("quality_flags"),
        F.col("business_date").alias("timestamp"),
    )


def stored_bars(spark: SparkSession, sf_dir: str, by: str = "segment") -> DataFrame:
    return to_stored(daily_bars(spark, sf_dir, by))


def asset_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue change log: one change per order of a customer-asset.

    Low-priority orders are deletes, the rest saves.  ``seq`` (the order
    key) breaks ties between changes on the same day.
    """
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_orderdate", "o_orderpriority")
    sym = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    source = (F.when(F.col("o_orderstatus") == "F", F.lit(PROVIDER_DEFAULT))
              .when(F.col("o_orderstatus") == "O", F.lit(PROVIDER_ALT))
              .otherwise(F.lit("landed_files")))
    return o.select(
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("asset_id"),
        F.col("o_orderdate").alias("change_ts"),
        F.col("o_orderkey").alias("seq"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("delete"))
         .otherwise(F.lit("save")).alias("op"),
        sym.alias("symbol"),
        F.lit("stock").alias("asset_class"),
        F.concat(F.lit(DESCRIPTION_PREFIX), sym).alias("description"),
        F.create_map(F.lit("source"), source,
                     F.lit("currency"), F.lit(DEFAULT_CURRENCY)).alias("attributes"),
        F.col("o_orderstatus").alias("attr"),
    )


def _segment_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars keyed by the raw segment name (the vendor 'symbol')."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = table(spark, sf_dir, "customer", "c_custkey", "c_mktsegment")
    return (o.join(c, o.o_custkey == c.c_custkey)
            .groupBy(F.col("c_mktsegment").alias("segment"),
                     F.col("o_orderdate").alias("day"))
            .agg(F.min_by("o_totalprice", "o_orderkey").alias("open"),
                 F.max_by("o_totalprice", "o_orderkey").alias("close"),
                 F.count(F.lit(1)).cast("double").alias("volume")))


def _num_text(c: Column) -> Column:
    return c.cast("string")


def landed_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed wide OHLCV text files for many symbols.

    Each segment is listed three times: as a stock (``X``, plain date), as a
    crypto pair (``X-USD``, naive date-time) and as an index (``^X``, date
    with a -05:00 offset).  Days with a single order on the 13th carry dirt:
    the crypto row a ``NaN`` close, the index row a non-numeric open.
    """
    d = _segment_days(spark, sf_dir)
    dirty = (F.dayofmonth("day") == 13) & (F.col("volume") == 1.0)
    day = F.date_format("day", "yyyy-MM-dd")
    hi = _num_text(F.greatest("open", "close"))
    lo = _num_text(F.least("open", "close"))
    stock = d.select(day.alias("Date"), F.col("segment").alias("symbol"),
                     _num_text(F.col("open")).alias("Open"), hi.alias("High"), lo.alias("Low"),
                     _num_text(F.col("close")).alias("Close"), _num_text(F.col("volume")).alias("Volume"))
    crypto = d.select(F.concat(day, F.lit(" 00:00:00")).alias("Date"),
                      F.concat(F.col("segment"), F.lit("-USD")).alias("symbol"),
                      _num_text(F.col("open")).alias("Open"), hi.alias("High"), lo.alias("Low"),
                      F.when(dirty, F.lit("NaN")).otherwise(_num_text(F.col("close"))).alias("Close"),
                      _num_text(F.col("volume")).alias("Volume"))
    index = d.select(F.concat(day, F.lit(" 00:00:00-05:00")).alias("Date"),
                     F.concat(F.lit("^"), F.col("segment")).alias("symbol"),
                     F.when(dirty, F.lit("n/a")).otherwise(_num_text(F.col("open"))).alias("Open"),
                     hi.alias("High"), lo.alias("Low"),
                     _num_text(F.col("close")).alias("Close"), _num_text(F.col("volume")).alias("Volume"))
    return stock.unionByName(crypto).unionByName(index)


def landed_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed vendor JSON: one payload per (symbol, month), like paged replies.

    A page holds at most 31 days, so building it never gathers an unbounded
    group.  Each symbol also has one rate-limit reply without a series.
    """
    d = _segment_days(spark, sf_dir)
    hi = _num_text(F.greatest("open", "close"))
    lo = _num_text(F.least("open", "close"))
    fields = F.create_map(F.lit("1. open"), _num_text(F.col("open")),
                          F.lit("2. high"), hi, F.lit("3. low"), lo,
                          F.lit("4. close"), _num_text(F.col("close")),
                          F.lit("5. volume"), _num_text(F.col("volume")))
    pages = (d.select(F.col("segment").alias("symbol"),
                      F.date_format("day", "yyyy-MM").alias("page"),
                      F.struct(F.date_format("day", "yyyy-MM-dd").alias("k"), fields.alias("v")).alias("e"))
             .groupBy("symbol", "page")
             .agg(F.map_from_entries(F.collect_list("e")).alias("series"))
             .select("symbol", F.to_json(F.struct(F.col("series").alias(VENDOR_SERIES_KEY))).alias("payload")))
    limited = (d.select(F.col("segment").alias("symbol")).distinct()
               .select("symbol", F.lit('{"Note": "API call frequency limit reached"}').alias("payload")))
    return pages.unionByName(limited)


def symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vendor symbols covering the three asset classes."""
    seg = table(spark, sf_dir, "customer", "c_mktsegment").distinct()
    s = F.col("c_mktsegment")
    return (seg.select(s.alias("symbol"))
            .unionByName(seg.select(F.concat(s, F.lit("-USD")).alias("symbol")))
            .unionByName(seg.select(F.concat(F.lit("^"), s).alias("symbol"))))


def synthetic_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prediction table shaped like the forecast job's output, from bars."""
    b = daily_bars(spark, sf_dir, "all")
    return b.select(
        "asset_id",
        F.date_add(F.col("business_date"), 1).alias("bdate"),
        F.col("open").alias("target_open"),
        F.col("close").alias("predicted_price_usd"),
        F.try_divide(F.col("close") - F.col("open"), F.col("open")).alias("prediction"),
    )
