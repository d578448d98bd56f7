"""Monthly rollups kept as mergeable state: late bars change a month without reading its bars again.

The table holds partial rollups (``rollups.partial_rollup``), those of each
batch in a folder of its own: ``gen=<n>/batch=<name>``.  Applying a batch reads
nothing that is stored.  A batch counts once the ledger names it, so one that
died half way is written over when it comes again, and one that is committed
changes nothing.  ``compact`` merges the committed batches into the next
generation.  Bars must be new ones, as the load finds them (``BarStore.unseen``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.operators.rollups import finished, merged, partial_rollup
from pricewh.sources import ledger

#: Where a compaction puts what it merged.
BASE = "compacted"


class RollupState:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.ledger = spark, f"{path}/state", f"{path}/ledger"

    def apply(self, new_bars: DataFrame, batch: str) -> None:
        """Add the bars of a batch.  A batch without bars is committed too."""
        if batch == BASE:
            raise ValueError(f"{BASE!r} is no name for a batch")
        if ledger.rows_of(self.spark, self.ledger, batch, "apply") is not None:
            return
        gen = self._generation()
        partial_rollup(new_bars).write.mode("overwrite").parquet(self._folder(gen, batch))
        ledger.commit(self.spark, self.ledger, batch, "apply", gen)

    def partials(self) -> DataFrame:
        """Merged partial rollups of the committed batches: one scan and one aggregate with a map-side step."""
        gen = self._generation()
        names = self._committed(gen) + ([BASE] if gen else [])
        if not names:
            return merged(self.spark.createDataFrame([], _SCHEMA))
        return merged(self.spark.read.schema(_SCHEMA).parquet(*[self._folder(gen, name) for name in names]))

    def rollups(self) -> DataFrame:
        return finished(self.partials())

    def compact(self) -> None:
        """Merge the committed batches into one folder of the next generation.  Until the ledger names that
        generation the present one is read; a compaction that died is written over by the next."""
        gen = self._generation()
        self.partials().write.mode("overwrite").parquet(self._folder(gen + 1, BASE))
        ledger.commit(self.spark, self.ledger, BASE, "compact", gen + 1)

    def _generation(self) -> int:
        return ledger.rows_of(self.spark, self.ledger, BASE, "compact") or 0

    def _committed(self, gen: int) -> list[str]:
        """Batches of a generation: as many as came since the last compaction."""
        own = ledger.read(self.spark, self.ledger).filter((F.col("step") == "apply") & (F.col("rows") == gen))
        return sorted(r.batch for r in own.select("batch").distinct().collect())

    def _folder(self, gen: int, batch: str) -> str:
        return f"{self.path}/gen={gen}/batch={batch}"


_SCHEMA = ("asset_id string, period string, n bigint, hi double, lo double, n_price bigint, n_large bigint, "
           "float_sum double, fx decimal(38,0)")
