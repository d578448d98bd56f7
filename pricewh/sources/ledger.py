"""A table of committed steps, so that a job that runs again changes nothing twice.

A step is named by (batch, step).  Its row is written after its data, so a job
that dies in between repeats the step; steps therefore write in ways that
repeating does not double (anti-join append, dynamic partition overwrite).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pricewh.sources.sinks import table_exists

SCHEMA = "batch string, step string, rows bigint"


def read(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCHEMA).parquet(path) if table_exists(spark, path) else spark.createDataFrame([], SCHEMA)


def rows_of(spark: SparkSession, path: str, batch: str, step: str) -> int | None:
    """Rows that a committed step wrote, or None if it has not been committed."""
    found = read(spark, path).filter(f"batch = '{_plain(batch)}' AND step = '{_plain(step)}'").agg({"rows": "max"}).first()
    return found[0]


def commit(spark: SparkSession, path: str, batch: str, step: str, rows: int) -> None:
    spark.createDataFrame([(_plain(batch), _plain(step), rows)], SCHEMA).coalesce(1).write.mode("append").parquet(path)


def _plain(name: str) -> str:
    if not name or not all(ch.isalnum() or ch in "-_." for ch in name):
        raise ValueError(f"batch and step names are letters, digits, '-', '_' and '.': {name!r}")
    return name
