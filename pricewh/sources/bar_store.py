"""Bars in bucketed, sorted tables: loads that neither move nor sort what is stored.

A bar table is a catalogue table, bucketed by a bar's key (asset and time) and
sorted by it within a bucket.  The stored side of the load's anti-join is read
in its buckets' layout, so only the incoming batch is exchanged and sorted.
Keying buckets by asset *and* time spreads a hot asset over all of them.

Spark relies on the files' order where a bucket is one file and the session
says so (``spark.sql.legacy.bucketedTableScan.outputOrdering``, set by
``build_session``); else it sorts within buckets, which moves nothing either.
Every append adds one sorted file a bucket.  ``compact`` rewrites the table
with one file a bucket; ``append`` does so when a bucket holds more than
``MOST_FILES``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.sources import ledger
from pricewh.sources.sinks import BAR_KEY, dedup_bars, drop_table, materialize, scratch_path

#: Buckets of a new table: a power of two.  With 100 TB of bars take some 100,000, for files of 1 GB.
BUCKETS = 8
MOST_FILES = 4


class BarStore:
    """A bucketed bar table ``name`` in the session's catalogue, with a ledger of its batches."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = BUCKETS):
        if not name.isidentifier() or buckets < 1 or buckets & (buckets - 1):
            raise ValueError("a store needs a plain name and a power of two of buckets")
        self.spark, self.name, self.buckets = spark, name, buckets
        self.ledger = scratch_path(spark, f"ledger-{name}")

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def bars(self) -> DataFrame:
        """All stored bars."""
        return self.spark.table(self.name).drop(BAR_KEY[0])

    def unseen(self, incoming: DataFrame) -> DataFrame:
        """Incoming bars, one a key, whose key is not stored.

        The batch is dealt to as many partitions as there are buckets, by the
        same keys: the stored keys are then read without exchange.
        """
        new = dedup_bars(incoming).withColumn(BAR_KEY[0], F.col("meta.asset_id"))
        if not self.exists():
            return new
        return (new.repartition(self.buckets, *BAR_KEY)
                .join(self.spark.table(self.name).select(*BAR_KEY), BAR_KEY, "left_anti"))

    def append(self, incoming: DataFrame, batch: str) -> int:
        """Store the unseen bars of a batch; how many they were, now or when the batch came first."""
        before = ledger.rows_of(self.spark, self.ledger, batch, "append")
        if before is not None:
            return before
        found = materialize(self.unseen(incoming), name="append")   # the join reads the table, the write changes it
        n = found.count()
        if n:
            self._write(found, self.name)
        ledger.commit(self.spark, self.ledger, batch, "append", n)
        drop_table(found)
        if n and self.files_a_bucket() > MOST_FILES:
            self.compact()
        return n

    def files_a_bucket(self) -> int:
        """Files of the bucket that has most of them."""
        return (self.spark.table(self.name).select(F.input_file_name().alias("f")).distinct()
                .groupBy(F.regexp_extract("f", r"_(\d{5})\.", 1)).count().agg(F.max("count")).first()[0] or 0)

    def compact(self) -> None:
        """One file a bucket.  Written under a new name, which then takes the old one's place; if the job dies
        between, ``recover`` finishes it."""
        fresh = f"{self.name}_compacted"
        self.spark.sql(f"DROP TABLE IF EXISTS {fresh}")
        # read as plain files: a bucketed scan makes Spark leave the repartitioning out, and then not use the buckets
        where = self.spark.sql(f"DESCRIBE FORMATTED {self.name}").filter("col_name = 'Location'").first()["data_type"]
        self._write(self.spark.read.schema(self.spark.table(self.name).schema).parquet(where), fresh)
        self.recover()

    def recover(self) -> None:
        """Finish a compaction whose table is whole but not yet in place."""
        fresh = f"{self.name}_compacted"
        if not self.spark.catalog.tableExists(fresh):
            return
        if self.exists() and self.spark.table(fresh).count() != self.spark.table(self.name).count():
            self.spark.sql(f"DROP TABLE {fresh}")             # it died while writing
            return
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        self.spark.sql(f"ALTER TABLE {fresh} RENAME TO {self.name}")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _write(self, bars: DataFrame, name: str) -> None:
        """One file a bucket: rows are dealt by the buckets' own keys."""
        (bars.repartition(self.buckets, *BAR_KEY).write.mode("append").format("parquet")
         .bucketBy(self.buckets, *BAR_KEY).sortBy(*BAR_KEY).saveAsTable(name))
