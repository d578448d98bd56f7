"""The catalogue on disk: open versions apart from closed ones, and pages by prefix counts.

A history table is partitioned by ``part`` (``open`` or ``closed``) and, among closed rows, by the
batch that closed them.  Reads of live assets prune to the open part.  Applying
a batch reads the open part alone (an asset's newest row is always open) and
writes, in one job with dynamic partition overwrite, the new open part and the
rows that the batch closed; closed history is neither read nor rewritten, and
applying a batch that the ledger knows does nothing.

A page of live assets comes from a table laid out in id order and partitioned
by range: the counts of the ranges say which of them a page lies in, and only
those directories are opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.functions.columns import check_page
from pricewh.operators.catalogue import live, scd2_apply
from pricewh.operators.windows import laid_out
from pricewh.sources import ledger
from pricewh.sources.sinks import drop_table, materialize

BASE = "base"
_PLACE = (1 << 33) - 1            # the part of a row number that counts within its partition


def _write(history: DataFrame, path: str, batch: str) -> None:
    is_open = F.col("valid_to").isNull()
    (history.withColumns({"part": F.when(is_open, F.lit("open")).otherwise(F.lit("closed")),
                          "closed_by": F.when(is_open, F.lit("-")).otherwise(F.lit(batch))})
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("part", "closed_by").parquet(f"{path}/versions"))


def write_history(history: DataFrame, path: str) -> None:
    """Store a whole history as a new table."""
    if ledger.rows_of(history.sparkSession, f"{path}/ledger", BASE, "apply") is not None:
        raise ValueError(f"{path} holds a history already")
    _write(history, path, BASE)
    ledger.commit(history.sparkSession, f"{path}/ledger", BASE, "apply", 0)


def versions(spark: SparkSession, path: str) -> DataFrame:
    """All versions of a stored history."""
    return spark.read.parquet(f"{path}/versions").drop("part", "closed_by")


def open_versions(spark: SparkSession, path: str) -> DataFrame:
    """Live versions and tombstones: only the open part is read."""
    return spark.read.parquet(f"{path}/versions").filter("part = 'open'").drop("part", "closed_by")


def apply_batch(spark: SparkSession, path: str, changes: DataFrame, batch: str) -> bool:
    """V3 on the stored table; False if the batch has been applied before."""
    if ledger.rows_of(spark, f"{path}/ledger", batch, "apply") is not None:
        return False
    history = open_versions(spark, path)
    # written apart first: the job that replaces the open part must not read it
    applied = materialize(scd2_apply(history, changes).select(*history.columns), name="scd2-batch")
    _write(applied, path, batch)
    ledger.commit(spark, f"{path}/ledger", batch, "apply", 0)
    drop_table(applied)
    return True


def write_pages(history: DataFrame, path: str, partitions: int | None = None) -> None:
    """Lay out live assets in id order for ``page``; replaces the table at ``path``."""
    laid = laid_out(live(history).select("asset_id", "symbol", "asset_class"), "asset_id", [], "pages", partitions)
    laid.write.mode("overwrite").partitionBy("_chunk").parquet(f"{path}/rows")
    laid.groupBy("_chunk").count().coalesce(1).write.mode("overwrite").parquet(f"{path}/counts")
    drop_table(laid)


def page(spark: SparkSession, path: str, offset: int = 0, limit: int = 20) -> DataFrame:
    """F2, T4: one page of live assets in id order (id, symbol, class).

    The counts, one row a range, go to the driver.  Rows are taken by their
    number, so a page at any offset costs the ranges it touches.
    """
    check_page(offset, limit)
    before, parts, wanted = 0, [], F.lit(False)
    for r in sorted(spark.read.parquet(f"{path}/counts").collect()):
        low, high = max(offset - before, 0), min(offset + limit - before, r["count"])
        if low < high:
            parts.append(r["_chunk"])
            place = F.col("_id").bitwiseAND(F.lit(_PLACE))
            wanted = wanted | ((F.col("_chunk") == r["_chunk"]) & (place >= low) & (place < high))
        before += r["count"]
    rows = spark.read.schema("asset_id string, symbol string, asset_class string, _id bigint, _chunk int").parquet(f"{path}/rows")
    return (rows.filter(F.col("_chunk").isin(parts)).filter(wanted).orderBy("_id")
            .select("asset_id", "symbol", "asset_class"))
