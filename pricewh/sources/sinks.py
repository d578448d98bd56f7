"""Loading and writing.

Tables are parquet paths.  Bars are laid out partitioned by month with rows
sorted by asset and date inside files, so date filters prune directories
and asset filters skip row groups.  A job never overwrites a path it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.functions.columns import ntz_lit
from pricewh.session import scratch_path

BAR_KEY = ["asset_id", "business_date"]
ROLLUP_KEY = ["asset_id", "period", "interval_type"]


def dedup_bars(incoming: DataFrame) -> DataFrame:
    """One bar per (asset, business_date): the newest ``system_date`` wins,
    then the larger ``ingest_id`` and prices (deterministic).

    ``max_by`` is a partial aggregate, so a key with many copies is folded
    map-side and no task ever holds all copies of a hot key.
    """
    cols = incoming.columns
    order = F.struct(F.col("system_date"), F.col("ingest_id"),
                     F.col("indicators").getItem("close"), F.col("indicators").getItem("open"),
                     F.col("indicators").getItem("volume"))
    return (incoming.withColumn("asset_id", F.col("meta.asset_id"))
            .groupBy(*BAR_KEY)
            .agg(F.max_by(F.struct(*cols), order).alias("_b"))
            .select("_b.*"))


def new_bars(incoming: DataFrame, existing: DataFrame, prune: bool = True) -> DataFrame:
    """S6 + J2: incoming bars whose (asset, business_date) is not stored yet.

    Only the key columns of ``existing`` are read.  With ``prune`` the
    batch's date range (two scalars) is pushed into the scan of
    ``existing`` (directory pruning when it has a ``period`` column), so an
    incremental load touches the recent part of the table, not all of it.
    """
    inc = dedup_bars(incoming)
    ex = existing.select(F.col("meta.asset_id").alias("asset_id"), "business_date",
                         *(["period"] if "period" in existing.columns else []))
    if prune:
        # same range as the deduplicated batch, without running the dedup
        lo, hi = incoming.agg(F.min("business_date"), F.max("business_date")).first()
        if lo is None:
            return inc.limit(0)
        ex = ex.filter((F.col("business_date") >= ntz_lit(lo)) & (F.col("business_date") <= ntz_lit(hi)))
        if "period" in ex.columns:
            ex = ex.filter(F.col("period").between(lo.strftime("%Y-%m"), hi.strftime("%Y-%m")))
    return (inc.withColumn("asset_id", F.col("meta.asset_id"))
            .join(ex.select(*BAR_KEY), BAR_KEY, "left_anti")
            .drop("asset_id"))


def write_bars(df: DataFrame, path: str, mode: str = "append") -> None:
    """Write bars by month.  The rebalance hint gathers a month's rows into
    files of the advisory size and splits a large month over several tasks."""
    (df.withColumn("period", F.date_format("business_date", "yyyy-MM"))
       .hint("rebalance", "period")
       .sortWithinPartitions(F.col("meta.asset_id"), "business_date")
       .write.mode(mode).partitionBy("period").parquet(path))


def read_bars(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` holds a table: asked of the path's own file system, so
    a path without a scheme means the default one, not the driver's disk.  A
    missing path and a folder without visible entries are new tables; any
    other failure of the file system is raised."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return False
    return any(not s.getPath().getName().startswith(("_", ".")) for s in fs.listStatus(p))


def append_new_bars(spark: SparkSession, incoming: DataFrame, path: str) -> int:
    """Append the unseen bars of ``incoming`` to the table at ``path`` and
    return how many were stored."""
    existing = read_bars(spark, path) if table_exists(spark, path) else None
    new = new_bars(incoming, existing) if existing is not None else dedup_bars(incoming).drop("asset_id")
    batch = materialize(new, name="load-batch")     # the join runs once; its rows are counted from footers
    n = batch.count()
    if n:
        write_bars(batch, path)
    drop_table(batch)
    return n


def upsert(target: DataFrame, src: DataFrame, keys=ROLLUP_KEY) -> DataFrame:
    """S7 + J3: replace target rows whose key is in ``src``, insert the rest.

    Source rows with a NULL key are dropped (they cannot match a key).  Of
    source rows with equal keys the one whose other columns are largest, in
    column order, is taken.
    """
    others = [c for c in src.columns if c not in keys]
    s = (src.dropna(subset=list(keys)).groupBy(*keys).agg(F.max(F.struct(*others)).alias("_s"))
         .select(*keys, *[F.col("_s").getField(c).alias(c) for c in others]))
    return target.join(s.select(*keys), list(keys), "left_anti").unionByName(s)


def overwrite(df: DataFrame, path: str) -> None:
    """Replace a result table (the path must not be an input)."""
    df.write.mode("overwrite").parquet(path)


def materialize(df: DataFrame, path: str | None = None, name: str = "table", codec: str | None = None) -> DataFrame:
    """Write ``df`` as a table and return it read back: a lineage cut that
    survives executor loss.  Without ``path`` the table goes under the
    shared checkpoint folder (``spark.checkpoint.dir``), never a machine-local
    temporary folder on a cluster.  ``codec``: its compression, if not the session's."""
    import uuid
    spark = df.sparkSession
    path = path or scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.mode("errorifexists").parquet(path, compression=codec)
    return spark.read.parquet(path)


def drop_table(df: DataFrame) -> None:
    """Delete a table made by ``materialize`` under the shared folder."""
    spark = df.sparkSession
    base = scratch_path(spark, "")
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if base.rstrip("/").split(":", 1)[-1].lstrip("/") in folder:
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def refresh_rollups(spark: SparkSession, bars_path: str, touched: DataFrame, rollup_path: str) -> None:
    """S7 on disk: recompute the monthly rollups of the touched months and
    replace exactly those month partitions of the rollup table (dynamic
    partition overwrite).

    ``touched`` holds ``period`` values (``yyyy-MM``).  Each touched month
    is recomputed for *all* assets from the bar table, which makes
    replacing the whole month partition an exact upsert keyed by
    (asset_id, period, interval_type).  The distinct months are a
    calendar-bounded handful (12 per year of data), so they are listed on
    the driver and pushed as a partition filter: only those month
    directories are scanned.  The job reads the bar table and writes the
    rollup table, never the path it reads.
    """
    from pricewh.operators.rollups import monthly_rollup
    months = [r.period for r in touched.select("period").distinct().collect() if r.period is not None]
    if not months:
        return
    bars = read_bars(spark, bars_path).filter(F.col("period").isin(months))
    r = monthly_rollup(bars.drop("period"))
    (r.hint("rebalance", "period").write.mode("overwrite")
      .option("partitionOverwriteMode", "dynamic")
      .partitionBy("period").parquet(rollup_path))
