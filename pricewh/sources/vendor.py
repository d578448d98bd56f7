"""Landed vendor files -> canonical bars.

The original application calls vendor APIs one symbol at a time and maps rows in a
Python loop.  Here the landed replies of many symbols are read at once and
mapped with column expressions; bad rows are flagged, not raised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricewh.functions.columns import (DEFAULT_CURRENCY, DESCRIPTION_PREFIX,
                                       PROVIDER_ALT, PROVIDER_DEFAULT, PROVIDERS,
                                       VENDOR_FIELDS, VENDOR_SERIES_KEY, asset_class,
                                       canonical_asset_id, vendor_symbol)

# Wall clock part, and zone offset behind a time of day (Z, +hh, +hhmm, +hh:mm).
_WALL = r"^(\d{4}-\d{1,2}-\d{1,2}(?:[ T]\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?)?)"
_OFFSET = r"(Z|[+-]\d{2}(?::?\d{2})?)$"
_STAMP = _WALL + r"(?:(?<=:\d{2}|\.\d{1,9}) ?(?:Z|[+-]\d{2}(?::?\d{2})?))?$"


def business_ts(text) -> Column:
    """Vendor date text -> UTC ``timestamp_ntz``.

    Text with a zone offset is an instant and is shifted to UTC; naive text
    is taken as UTC already.  Only wall-clock values are handled, so no
    session zone or daylight change plays a part.  Other text, zone names
    included, gives NULL.
    """
    s = F.trim(text if isinstance(text, Column) else F.col(text))
    wall = F.regexp_extract(s, _WALL, 1).try_cast("timestamp_ntz")
    off = F.regexp_replace(F.regexp_extract(s, _OFFSET, 1), ":", "")
    minutes = (F.coalesce(F.substring(off, 2, 2).try_cast("int"), F.lit(0)) * 60
               + F.coalesce(F.substring(off, 4, 2).try_cast("int"), F.lit(0)))
    minutes = F.when(off.startswith("-"), -minutes).otherwise(minutes)
    shifted = wall - F.make_dt_interval(F.lit(0), F.lit(0), minutes)
    timed = s.contains(":")
    return F.when(s.rlike(_STAMP), F.when(timed & (off != ""), shifted).otherwise(wall))


def _num(c: Column) -> Column:
    return c.cast("string").try_cast("double")


def _not_finite(name: str) -> Column:
    return F.isnan(F.col(name)) | (F.abs(F.col(name)) == F.lit(float("inf")))


def parse_wide(landed: DataFrame) -> DataFrame:
    """Typed, flagged rows of a wide OHLCV file (``Date, symbol, Open,
    Close, Volume`` as text or numbers).  ``valid`` rows have a date and
    three numbers; NaN and infinite numbers are kept as NULL and counted in
    ``nan_values``."""
    o, c, v = _num(F.col("Open")), _num(F.col("Close")), _num(F.col("Volume"))
    df = landed.select("symbol", business_ts(F.col("Date").cast("string")).alias("business_date"),
                       o.alias("open"), c.alias("close"), v.alias("volume"))
    nan = [_not_finite(x) for x in ("open", "close", "volume")]
    valid = (F.col("business_date").isNotNull() & F.col("open").isNotNull()
             & F.col("close").isNotNull() & F.col("volume").isNotNull() & F.col("symbol").isNotNull())
    nn = sum((F.coalesce(x, F.lit(False)).cast("int") for x in nan), F.lit(0))
    return df.select(
        "symbol", "business_date",
        *[F.when(_not_finite(x), F.lit(None).cast("double")).otherwise(F.col(x)).alias(x)
          for x in ("open", "close", "volume")],
        valid.alias("valid"), nn.alias("nan_values"))


def shape_bars(parsed: DataFrame, provider: str, ingest_id: str, system_date: str,
               provider_col: str | None = None) -> DataFrame:
    """Valid parsed rows -> stored bar documents (P1, P4-P6), of one provider or that of ``provider_col``.

    ``system_date`` is one value for the whole job; ``quality_flags`` is 1
    when a NaN number was replaced by NULL, else 0.
    """
    return parsed.filter("valid").select(
        F.col("business_date"),
        F.lit(system_date).cast("timestamp_ntz").alias("system_date"),
        F.struct(canonical_asset_id("symbol").alias("asset_id"),
                 (F.col(provider_col) if provider_col else F.lit(provider)).alias("data_source_id")).alias("meta"),
        F.create_map(F.lit("open"), F.col("open"), F.lit("close"), F.col("close"),
                     F.lit("volume"), F.col("volume")).alias("indicators"),
        F.lit(ingest_id).alias("ingest_id"),
        F.when(F.col("nan_values") > 0, 1).otherwise(0).alias("quality_flags"),
        F.col("business_date").alias("timestamp"),
    )


def ingest_wide(landed: DataFrame, provider: str = PROVIDER_DEFAULT, ingest_id: str = "job_etl",
                system_date: str = "1970-01-01 00:00:00") -> DataFrame:
    """Wide vendor rows for many symbols -> stored bars."""
    return shape_bars(parse_wide(landed), provider, ingest_id, system_date)


_SERIES = f"struct<`{VENDOR_SERIES_KEY}`: map<string, map<string, string>>>"


def json_to_wide(raw: DataFrame) -> DataFrame:
    """S3: ``symbol, payload`` JSON replies -> wide rows.

    A reply without the series object yields no rows (see ``json_errors``).
    """
    parsed = raw.select("symbol", F.from_json("payload", _SERIES).getField(VENDOR_SERIES_KEY).alias("s"))
    day = parsed.select("symbol", F.explode("s").alias("Date", "f"))
    return day.select("Date", "symbol",
                      *[F.col("f").getItem(k).alias(name) for k, name in VENDOR_FIELDS.items()])


def failed_replies(raw: DataFrame) -> DataFrame:
    """One row (symbol) for each reply that carried no series."""
    return raw.filter(F.from_json("payload", _SERIES).getField(VENDOR_SERIES_KEY).isNull()).select("symbol")


def json_errors(raw: DataFrame) -> DataFrame:
    """Replies per symbol that carried no series (rate limit, bad symbol)."""
    s = F.from_json("payload", _SERIES).getField(VENDOR_SERIES_KEY)
    return (raw.groupBy("symbol")
            .agg(F.count_if(s.isNull()).alias("errors"), F.count(F.lit(1)).alias("replies")))


def ingest_json(raw: DataFrame, provider: str = PROVIDER_ALT, ingest_id: str = "job_etl",
                system_date: str = "1970-01-01 00:00:00") -> DataFrame:
    return ingest_wide(json_to_wide(raw), provider, ingest_id, system_date)


def route_symbols(symbols: DataFrame, alt_symbols=()) -> DataFrame:
    """Provider per symbol, the alternative provider for listed symbols.

    A routing table (``symbol, provider``) may be given instead of a list;
    an unknown provider fails the job when the rows are evaluated.
    """
    if isinstance(alt_symbols, DataFrame):
        routed = (symbols.join(alt_symbols.select("symbol", F.col("provider").alias("_p")), "symbol", "left")
                  .withColumn("provider", F.coalesce(F.lower("_p"), F.lit(PROVIDER_DEFAULT))).drop("_p"))
    else:
        alt = list(alt_symbols)
        p = F.when(F.col("symbol").isin(alt), F.lit(PROVIDER_ALT)) if alt else None
        routed = symbols.withColumn("provider", p.otherwise(F.lit(PROVIDER_DEFAULT)) if alt
                                    else F.lit(PROVIDER_DEFAULT))
    ok = F.col("provider").isin(list(PROVIDERS))
    return routed.withColumn(
        "provider",
        F.when(ok, F.col("provider")).otherwise(
            F.raise_error(F.concat(F.lit("Unknown data provider: "), F.col("provider")))))


def canonical_assets(symbols: DataFrame, provider="provider") -> DataFrame:
    """Catalogue row per symbol (id, upper symbol, class,
    description, vendor symbol, attributes {source, currency})."""
    src = F.col(provider) if isinstance(provider, str) and provider in symbols.columns else F.lit(provider)
    up = F.upper("symbol")
    return symbols.select(
        canonical_asset_id("symbol").alias("asset_id"),
        up.alias("symbol"),
        asset_class("symbol").alias("asset_class"),
        F.concat(F.lit(DESCRIPTION_PREFIX), up).alias("description"),
        vendor_symbol("symbol").alias("vendor_symbol"),
        F.create_map(F.lit("source"), src, F.lit("currency"), F.lit(DEFAULT_CURRENCY)).alias("attributes"),
    )


def ingest_stats(parsed: DataFrame, stored_new: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Per symbol fetched / transformed / skipped / NaN / stored / errors.

    ``stored_new`` is the output of the loader (rows actually appended).
    All counts are partial aggregates joined on small per-symbol rows.
    """
    per = (parsed.groupBy("symbol")
           .agg(F.count(F.lit(1)).alias("fetched"),
                F.count_if("valid").alias("transformed"),
                F.count_if(~F.col("valid")).alias("skipped"),
                F.sum(F.when(F.col("valid"), F.col("nan_values")).otherwise(0)).cast("bigint").alias("nan_values"))
           .withColumn("asset_id", canonical_asset_id("symbol")))
    st = stored_new.groupBy(F.col("meta.asset_id").alias("asset_id")).agg(F.count(F.lit(1)).alias("stored"))
    out = per.join(st, "asset_id", "left").withColumn("stored", F.coalesce("stored", F.lit(0)))
    if errors is not None:
        out = (out.join(errors.select("symbol", "errors"), "symbol", "full")
               .withColumn("asset_id", canonical_asset_id("symbol")))
        for c in ("fetched", "transformed", "skipped", "nan_values", "stored", "errors"):
            out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0)).cast("bigint"))
    else:
        out = out.withColumn("errors", F.when(F.col("fetched") == 0, 1).otherwise(0).cast("bigint"))
    return out.select("symbol", "asset_id", "fetched", "transformed", "skipped", "nan_values", "stored", "errors")
