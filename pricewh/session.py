"""Session construction and lineage helpers."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings that make plans scale: AQE re-plans joins and coalesces small
# shuffle partitions at run time, splits skewed sort-merge partitions, and
# the session zone is pinned so date formatting never depends on the host.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # buckets of one sorted file are read as sorted (sources/bar_store.py)
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


# Suggested settings for a large cluster (100 TB class inputs).  Start with
# many shuffle partitions and let AQE coalesce them to ~256 MB each; split
# scans at 256 MB; split skewed sort-merge partitions (5x the median and over
# 512 MB).  spark.checkpoint.dir must name a shared file system.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(master: str | None = None, app: str = "pricewh",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_FALLBACK: dict[int, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and intermediate tables.

    On a cluster this is whatever ``spark.checkpoint.dir`` names (a shared
    file system), or the checkpoint folder already set on the context.
    Only when neither exists and the master is local (tests) is a local
    folder made; it is set on the SparkContext, since the core config cannot
    change at run time.  On any other master a missing setting is an error:
    executors do not see each other's folders.
    """
    sc = spark.sparkContext
    cur = sc._jsc.sc().getCheckpointDir()
    d = (spark.conf.get("spark.checkpoint.dir", None) or _LOCAL_FALLBACK.get(id(sc))
         or (cur.get() if cur.isDefined() else None))
    if not d:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {sc.master!r}")
        d = _LOCAL_FALLBACK.setdefault(id(sc), tempfile.mkdtemp(prefix="pricewh-ckpt-"))
    if not cur.isDefined():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for intermediate tables."""
    return os.path.join(checkpoint_dir(spark), "tables", name)
