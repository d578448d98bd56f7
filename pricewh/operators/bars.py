"""Views over stored bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten_bars(stored: DataFrame) -> DataFrame:
    """meta.asset_id and indicators.open/close/volume as plain columns.

    A missing map key yields NULL.  Only the referenced nested fields are
    read from parquet (nested schema pruning).
    """
    m = F.col("indicators")
    return stored.select(
        F.col("meta.asset_id").alias("asset_id"),
        F.col("meta.data_source_id").alias("data_source_id"),
        F.col("business_date"),
        m.getItem("open").alias("open"),
        m.getItem("close").alias("close"),
        m.getItem("volume").alias("volume"),
        F.col("ingest_id"),
        F.coalesce(F.col("quality_flags"), F.lit(0)).alias("quality_flags"),
    )
