"""From landed replies to stored bars, catalogue and a report of what happened, as one job.

``run`` takes a batch of landed files: wide rows and JSON replies of many
symbols.  Each step is named in a ledger, and a batch that runs again, whole
or from where it died, leaves the same tables.

Steps, in order:

1. ``land``: parse and flag all rows once into a table of the batch.  Counts
   of the job are observed in that very write; counts per symbol are an
   aggregate of what was written.
2. ``append``: unseen bars into the bar store (``bar_store``).
3. ``catalogue``: a catalogue change for each symbol that has no version yet, or
   another one than the live (``history_store``).
4. ``report``: per symbol fetched, transformed, skipped, NaN, stored, and replies
   with errors.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pricewh.functions.columns import PROVIDER_ALT, PROVIDER_DEFAULT, canonical_asset_id
from pricewh.operators import history_store as H
from pricewh.operators.catalogue import current_asset, scd2_history
from pricewh.sources import ledger, vendor
from pricewh.sources.bar_store import BarStore
from pricewh.sources.sinks import table_exists


@dataclass
class Warehouse:
    """Where a job's tables lie: ``path`` in the shared store, bars in the catalogue table ``bars``."""
    spark: SparkSession
    path: str
    bars: BarStore

    def report(self) -> DataFrame:
        """Counts per batch and symbol."""
        return self.spark.read.parquet(f"{self.path}/report")

    def assets(self) -> DataFrame:
        return H.versions(self.spark, f"{self.path}/assets")

    def observed(self) -> DataFrame:
        """Counts of each batch as they were observed while it was written."""
        return ledger.read(self.spark, f"{self.path}/ledger")


def parsed_replies(wide: DataFrame, replies: DataFrame) -> DataFrame:
    """One row for each landed row or failed reply: symbol, provider, parsed columns, ``failed``."""
    rows = (vendor.parse_wide(wide).withColumn("provider", F.lit(PROVIDER_DEFAULT))
            .unionByName(vendor.parse_wide(vendor.json_to_wide(replies)).withColumn("provider", F.lit(PROVIDER_ALT)))
            .withColumn("failed", F.lit(False)))
    failed = vendor.failed_replies(replies).withColumns({"provider": F.lit(PROVIDER_ALT), "failed": F.lit(True)})
    return rows.unionByName(failed, allowMissingColumns=True)


def run(house: Warehouse, wide: DataFrame, replies: DataFrame, batch: str, ingest_id: str, system_date: str) -> DataFrame:
    """Ingest one batch; the report's rows of it.  ``system_date`` also dates the batch's catalogue changes."""
    spark, log, landed_at = house.spark, f"{house.path}/ledger", f"{house.path}/landed/{batch}"
    if ledger.rows_of(spark, log, batch, "land") is None:
        seen = Observation(f"land-{batch}")
        counted = parsed_replies(wide, replies).observe(
            seen, F.count_if(~F.col("failed")).alias("fetched"), F.count_if("valid").alias("transformed"),
            F.count_if("failed").alias("errors"))
        counted.write.mode("overwrite").parquet(landed_at)
        for step in ("transformed", "errors"):
            ledger.commit(spark, log, batch, step, seen.get[step])
        ledger.commit(spark, log, batch, "land", seen.get["fetched"])
    landed = spark.read.parquet(landed_at)

    bars = vendor.shape_bars(landed, PROVIDER_DEFAULT, ingest_id, system_date, provider_col="provider")
    house.bars.append(bars, batch)
    _save_assets(house, landed, batch, system_date)
    if ledger.rows_of(spark, log, batch, "report") is None:
        report = _report(landed, house.bars.bars().filter(F.col("ingest_id") == ingest_id), batch)
        (report.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch").parquet(f"{house.path}/report"))
        ledger.commit(spark, log, batch, "report", 0)
    return house.report().filter(F.col("batch") == batch)


def _save_assets(house: Warehouse, landed: DataFrame, batch: str, system_date: str) -> None:
    """A save for each symbol whose catalogue row is new or differs from the live one."""
    spark, path = house.spark, f"{house.path}/assets"
    symbols = landed.groupBy("symbol").agg(F.max("provider").alias("provider")).filter("symbol IS NOT NULL")
    rows = vendor.canonical_assets(symbols, "provider").select(
        "asset_id", F.lit(system_date).cast("timestamp_ntz").alias("change_ts"), F.lit(0).cast("bigint").alias("seq"),
        F.lit("save").alias("op"), "symbol", "asset_class", "description", "attributes")
    if not table_exists(spark, f"{path}/ledger"):
        H.write_history(scd2_history(rows), path)
        return
    live = current_asset(H.open_versions(spark, path)).select(
        "asset_id", F.col("symbol").alias("_s"), F.col("attributes")["source"].alias("_p"))
    changed = (rows.join(live, "asset_id", "left")
               .filter(~(F.col("symbol").eqNullSafe(F.col("_s")) & F.col("attributes")["source"].eqNullSafe(F.col("_p"))))
               .drop("_s", "_p"))
    H.apply_batch(spark, path, changed, batch)


def _report(landed: DataFrame, stored: DataFrame, batch: str) -> DataFrame:
    per = landed.groupBy("symbol").agg(
        F.count_if(~F.col("failed")).alias("fetched"), F.count_if("valid").alias("transformed"),
        F.count_if(~F.col("failed") & ~F.col("valid")).alias("skipped"),
        F.sum(F.when(F.col("valid"), F.col("nan_values")).otherwise(0)).cast("bigint").alias("nan_values"),
        F.count_if("failed").alias("errors"))
    kept = stored.groupBy(F.col("meta.asset_id").alias("asset_id")).agg(F.count(F.lit(1)).alias("stored"))
    return (per.withColumn("asset_id", canonical_asset_id("symbol")).join(kept, "asset_id", "left")
            .select(F.lit(batch).alias("batch"), "symbol", "asset_id", "fetched", "transformed", "skipped", "nan_values",
                    F.coalesce("stored", F.lit(0)).cast("bigint").alias("stored"), "errors"))
