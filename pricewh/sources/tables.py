"""Readers for the supplied parquet tables (column-pruned at the scan)."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Scan ``{sf_dir}/{name}.parquet`` reading only ``columns``.

    Selecting right after the scan keeps ``ReadSchema`` narrow; filters put
    on the result are pushed into the parquet reader by Catalyst.
    """
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df
