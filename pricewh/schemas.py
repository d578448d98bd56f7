"""Explicit schemas (no inference at read time)."""

from pyspark.sql import types as T

META = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("data_source_id", T.StringType(), True),
])

INDICATORS = T.MapType(T.StringType(), T.DoubleType(), True)

# Stored price bar (the canonical, nested form).
BARS = T.StructType([
    T.StructField("business_date", T.TimestampNTZType(), False),
    T.StructField("system_date", T.TimestampNTZType(), True),
    T.StructField("meta", META, False),
    T.StructField("indicators", INDICATORS, True),
    T.StructField("ingest_id", T.StringType(), True),
    T.StructField("quality_flags", T.IntegerType(), True),
    T.StructField("timestamp", T.TimestampNTZType(), True),
])

# Flat working form used by the quantitative operators.
FLAT_BARS = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("business_date", T.TimestampNTZType(), False),
    T.StructField("open", T.DoubleType(), True),
    T.StructField("close", T.DoubleType(), True),
    T.StructField("volume", T.DoubleType(), True),
])

# Change log feeding the versioned catalogue.
ASSET_CHANGES = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("change_ts", T.TimestampNTZType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("op", T.StringType(), False),
])

ROLLUP_STATS = T.StructType([
    T.StructField("count", T.LongType(), False),
    T.StructField("high", T.DoubleType(), True),
    T.StructField("low", T.DoubleType(), True),
    T.StructField("average", T.DoubleType(), True),
])

PREDICTIONS = T.StructType([
    T.StructField("asset_id", T.StringType(), False),
    T.StructField("bdate", T.DateType(), False),
    T.StructField("target_open", T.DoubleType(), True),
    T.StructField("predicted_price_usd", T.DoubleType(), True),
    T.StructField("prediction", T.DoubleType(), True),
])

# Landed vendor files: wide OHLCV text, one row per (symbol, day).
LANDED_WIDE = T.StructType([
    T.StructField("Date", T.StringType(), True),
    T.StructField("symbol", T.StringType(), True),
    T.StructField("Open", T.StringType(), True),
    T.StructField("High", T.StringType(), True),
    T.StructField("Low", T.StringType(), True),
    T.StructField("Close", T.StringType(), True),
    T.StructField("Volume", T.StringType(), True),
])
