"""Point, range and latest-N reads over bars and rollups (F5, F6, T1-T4,
P11, C2, C3).

Latest-N per asset is ``row_number() <= n`` over a per-asset window; Spark
plans it as a partial ``WindowGroupLimit`` before the shuffle, so every
task ships at most n rows per asset, whatever the asset's size.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewh.functions.columns import (DEFAULT_ATTRIBUTES, MONTH_INTERVAL, iso_date, iso_datetime,
                                       ntz_lit)


def _check_n(n: int) -> None:
    if not isinstance(n, int) or n < 1:
        raise ValueError(f"n must be >= 1, got {n!r}")


def latest_n(df: DataFrame, n: int, key: str | Column, order: str, name: str = "rank") -> DataFrame:
    """Keep each key's n rows with the largest ``order``; ``rank`` 1 = newest."""
    _check_n(n)
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return df.withColumn(name, F.row_number().over(w)).filter(F.col(name) <= n)


def recent_bars(stored: DataFrame, n: int = 30) -> DataFrame:
    """T1 + P11: newest n bars per asset, ISO date, the whole indicator map, flags."""
    t = latest_n(stored, n, F.col("meta.asset_id"), "business_date")
    return t.select(F.col("meta.asset_id").alias("asset_id"), "rank",
                    iso_datetime("business_date").alias("business_date"), "indicators",
                    F.coalesce(F.col("quality_flags"), F.lit(0)).alias("quality_flags"))


def recent_rollups(rollups: DataFrame, n: int = 12) -> DataFrame:
    """Newest n monthly rollups per asset."""
    r = rollups.filter(F.col("interval_type") == MONTH_INTERVAL)
    return latest_n(r, n, "asset_id", "period")


def _day(v) -> Column:
    if isinstance(v, (_dt.date, _dt.datetime)):
        v = v.strftime("%Y-%m-%d")
    d = _dt.datetime.strptime(v, "%Y-%m-%d")   # strict, like the API (400 otherwise)
    return ntz_lit(d)


def bars_in_range(stored: DataFrame, start, end, asset_ids=None, source: str | None = None,
                  ordered: bool = False) -> DataFrame:
    """bars with start <= business_date < end (end exclusive).

    Filters are plain column predicates, so they reach the parquet scan
    (and, for derived bars, are pushed below the aggregation).
    """
    cond = (F.col("business_date") >= _day(start)) & (F.col("business_date") < _day(end))
    if asset_ids is not None:
        cond &= F.col("meta.asset_id").isin(list(asset_ids))
    if source is not None:
        cond &= F.col("meta.data_source_id") == source
    out = stored.filter(cond)
    if ordered:
        out = out.orderBy(F.col("meta.asset_id"), F.col("business_date").desc())
    return out


def bars_payload(stored: DataFrame, requests: DataFrame, include_attributes: bool = True) -> DataFrame:
    """one row per record of each request, shaped like the API reply.

    ``requests`` holds ``assetId, dataSourceId, start, end`` (timestamps).
    ``values`` is the record's whole indicator map (empty where it has
    none).  ``attributes`` (an array; left out without ``include_attributes``)
    lists the keys of the newest record's indicators, or the default list
    when the request found nothing (one row with NULL fields).
    A request is joined once for each month it covers, on (asset, source,
    month), so a short request meets only bars of its months; the newest
    record per request comes from a partial ``max_by`` aggregate.
    """
    req = requests.select("assetId", F.col("dataSourceId").alias("datasourceId"), "start", "end")
    # The requests' overall window (two scalars) is pushed into the bar scan,
    # so only bars some request can match are read and shuffled.
    lo, hi = req.agg(F.min("start"), F.max("end")).first()
    b = stored
    if lo is not None:
        b = b.filter((F.col("business_date") >= ntz_lit(lo)) & (F.col("business_date") < ntz_lit(hi)))
    b = b.select(F.col("meta.asset_id").alias("assetId"),
                 F.col("meta.data_source_id").alias("datasourceId"),
                 "business_date", F.coalesce("indicators", F.expr("cast(map() as map<string,double>)")).alias("indicators"),
                 F.trunc(F.to_date("business_date"), "month").alias("_month"))
    last = F.to_date(F.col("end") - F.expr("interval 1 microsecond"))
    by_month = req.filter(F.col("start") < F.col("end")).withColumn("_month", F.explode(F.sequence(
        F.trunc(F.to_date("start"), "month"), F.trunc(last, "month"), F.expr("interval 1 month"))))
    rec = (by_month.join(b, ["assetId", "datasourceId", "_month"]).drop("_month")
           .filter((F.col("business_date") >= F.col("start")) & (F.col("business_date") < F.col("end"))))
    keys = ["assetId", "datasourceId", "start", "end"]
    attrs = (rec.groupBy(*keys)
             .agg(F.map_keys(F.max_by("indicators", "business_date")).alias("attributes")))
    empty = (req.join(attrs, keys, "left_anti")
             .select(*keys, F.lit(None).cast("timestamp_ntz").alias("business_date"),
                     F.lit(None).cast("map<string,double>").alias("indicators"),
                     F.array(*[F.lit(a) for a in DEFAULT_ATTRIBUTES]).alias("attributes")))
    full = rec.join(attrs, keys).select(*keys, "business_date", "indicators", "attributes")
    out = full.unionByName(empty)
    return out.select("assetId", "datasourceId", iso_date("business_date").alias("businessDate"),
                      F.col("indicators").alias("values"), *(["attributes"] if include_attributes else []))


def price_series(rollups: DataFrame, n: int = 6) -> DataFrame:
    """Newest n monthly averages per asset, NULL periods removed,
    ``pos`` 1 = oldest of the shown months."""
    r = recent_rollups(rollups, n).filter(F.col("period").isNotNull())
    w = Window.partitionBy("asset_id").orderBy("period")
    return r.select("asset_id", "period", F.col("stats.average").alias("average")) \
            .withColumn("pos", F.row_number().over(w))


def volume_series(stored: DataFrame, n: int = 60) -> DataFrame:
    """Newest n closes and volumes per asset, ``pos`` 1 = oldest."""
    t = latest_n(stored, n, F.col("meta.asset_id"), "business_date")
    w = Window.partitionBy("asset_id").orderBy("business_date")
    m = F.col("indicators")
    return (t.select(F.col("meta.asset_id").alias("asset_id"), "business_date",
                     m.getItem("close").alias("close"), m.getItem("volume").alias("volume"))
            .withColumn("pos", F.row_number().over(w))
            .withColumn("business_date", iso_date("business_date")))
