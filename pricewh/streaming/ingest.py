"""Continuous ingestion of landed vendor files (Structured Streaming).

The batch loader (``sources.sinks.append_new_bars``) is idempotent: it only
appends bars whose (asset, business_date) is not stored yet.  Run per
micro-batch through ``foreachBatch`` it gives an exactly-once table even
when a batch is replayed after a failure, because a replay finds its rows
already stored.  The stream's own progress lives in ``checkpoint`` (a
shared folder on a cluster).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from pricewh.functions.columns import PROVIDER_DEFAULT
from pricewh.schemas import LANDED_WIDE
from pyspark.sql import functions as F

from pricewh.sources.sinks import append_new_bars, refresh_rollups
from pricewh.sources.vendor import ingest_wide, json_to_wide


def landed_stream(spark: SparkSession, landed_dir: str, fmt: str = "csv") -> DataFrame:
    """Landed files as a stream: wide OHLCV (``csv``/``parquet``) or vendor
    JSON replies (``json_replies``: JSON lines with ``symbol``, ``payload``)."""
    if fmt == "json_replies":
        return spark.readStream.schema("symbol string, payload string").json(landed_dir)
    r = spark.readStream.schema(LANDED_WIDE)
    if fmt == "csv":
        r = r.option("header", "true")
    return r.format(fmt).load(landed_dir)


def start_bar_ingest(spark: SparkSession, landed_dir: str, table_path: str, checkpoint: str,
                     provider: str = PROVIDER_DEFAULT, fmt: str = "csv",
                     available_now: bool = True, rollup_path: str | None = None) -> StreamingQuery:
    """Start loading new landed files into the bar table at ``table_path``.

    Each micro-batch gets its own ``ingest_id`` and one ``system_date``.
    With ``rollup_path`` the monthly rollups of the months the batch
    touched are recomputed and their partitions replaced (idempotent too).
    ``available_now`` processes what has landed and stops (scheduled
    runs); otherwise the query keeps polling.
    """
    stored: list[int] = []

    def load(batch: DataFrame, batch_id: int) -> None:
        now = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None).strftime("%Y-%m-%d %H:%M:%S")
        wide = json_to_wide(batch) if fmt == "json_replies" else batch
        bars = ingest_wide(wide, provider, f"job_stream_{batch_id:08d}", now)
        stored.append(append_new_bars(batch.sparkSession, bars, table_path))
        if rollup_path is not None:
            touched = bars.select(F.date_format("business_date", "yyyy-MM").alias("period"))
            refresh_rollups(batch.sparkSession, table_path, touched, rollup_path)

    w = (landed_stream(spark, landed_dir, fmt).writeStream
         .foreachBatch(load).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    q = w.start()
    q.stored_counts = stored  # per-batch counts, for callers and tests
    return q
