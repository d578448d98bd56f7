"""Ordered per-key computations that never put one key's rows in one task.

A per-key window (``partitionBy(asset)``) sends all of an asset's rows to
one task.  Here rows are laid out once, range-partitioned by (key, order)
from a sample of the data, sorted, numbered and written as a table; a range
partition is a *chunk*.  A hot key, or a hot (key, order) value, covers as
many chunks as its rows fill, and a chunk holds many small keys whole.

* ``ranked`` gives every row its 1-based rank ``_g`` within its key and the
  key's row count ``_n``: its place in the chunk plus a prefix sum over the
  chunk summaries (one row per key and chunk; all but the keys that cross a
  chunk's edge have a single one).
* ``with_lookback`` adds, for each chunk that a key enters from an earlier
  one, copies of the ``lookback`` rows that precede it (``_halo`` = true).
  A window over (key, chunk) ordered by ``_g`` then sees exactly the
  neighbours that a per-key window would see for frames reaching at most
  ``lookback`` rows back; afterwards the halo rows are dropped.

The input is evaluated once, when the table is written; everything after
that reads the table.  Rows with a null order value are kept and come first
in their key, as in Spark's own windows; rows of a null key are one key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewh.sources.sinks import materialize

INTERNAL = ("_chunk", "_id", "_g", "_cn", "_lo", "_off", "_n", "_halo")


def _hashable(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return False
    if isinstance(t, T.ArrayType):
        return _hashable(t.elementType)
    return not isinstance(t, T.StructType) or all(_hashable(f.dataType) for f in t.fields)


def laid_out(df: DataFrame, key: str, order: list[str], name: str = "ordered", partitions: int | None = None) -> DataFrame:
    """``df`` as a stored table in (key, order) order, with ``_chunk`` (the
    range partition) and ``_id`` (consecutive within a chunk, ascending over
    chunks).

    Rows of one order value go by a hash of the row, so they spread over
    chunks too; only rows that agree in every column stay together.  The
    layout is a function of the rows, not of attempts or input partitions
    that supply them: a retried task repeats it.  ``partitions`` fixes the
    number of chunks; by default AQE sizes them.
    """
    tie = F.xxhash64(*[c for c in df.columns if _hashable(df.schema[c].dataType)])
    by = [key, *order, "_tie"]
    spread = df.withColumn("_tie", tie)
    spread = spread.repartitionByRange(partitions, *by) if partitions else spread.repartitionByRange(*by)
    return materialize(spread.sortWithinPartitions(*by)
                       .select(*df.columns, F.spark_partition_id().alias("_chunk"),
                               F.monotonically_increasing_id().alias("_id")), name=f"laid-out-{name}")


def on_keys(left: DataFrame, right: DataFrame, *keys: str, how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match; the keys come from the left."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = [left[k].eqNullSafe(other[f"_r_{k}"]) for k in keys]
    joined = left.join(other, cond, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{k}" for k in keys])


def chunk_summaries(rows: DataFrame, key: str) -> DataFrame:
    """One row per key and chunk of a laid-out table: ``_cn`` rows from
    ``_lo`` on, after ``_off`` rows of the key in earlier chunks, of ``_n``."""
    s = rows.groupBy(key, "_chunk").agg(F.count(F.lit(1)).alias("_cn"), F.min("_id").alias("_lo"))
    by_key = Window.partitionBy(key)
    before = by_key.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    return (s.withColumn("_off", F.coalesce(F.sum("_cn").over(before), F.lit(0)))
             .withColumn("_n", F.sum("_cn").over(by_key)))


def _ranked(df: DataFrame, key: str, order: str, partitions: int | None):
    rows = laid_out(df, key, [order], partitions=partitions)
    s = chunk_summaries(rows, key)
    return on_keys(rows, s, key, "_chunk").withColumn("_g", F.col("_id") - F.col("_lo") + 1 + F.col("_off")), s


def ranked(df: DataFrame, key: str, order: str, partitions: int | None = None) -> DataFrame:
    """Add ``_g`` (rank in key) and ``_n`` (rows of the key), with the
    chunk's ``_chunk``, ``_cn``, ``_lo`` and ``_off``."""
    return _ranked(df, key, order, partitions)[0]


def with_lookback(df: DataFrame, key: str, order: str, lookback: int,
                  partitions: int | None = None) -> DataFrame:
    """Rows of ``df`` plus halo copies; see the module docstring.

    Window over ``by_chunk(key)`` and keep ``~_halo`` rows afterwards.  Only
    the last ``lookback`` rows of a key in a chunk it leaves are joined, to
    the ranks that later chunks ask for: at most ``lookback`` a chunk.
    """
    if lookback < 1:
        raise ValueError("lookback must be >= 1")
    r, s = _ranked(df, key, order, partitions)
    cols = list(r.columns)
    goes_on = F.col("_off") + F.col("_cn") < F.col("_n")
    tails = r.filter(goes_on & (F.col("_id") >= F.col("_lo") + F.col("_cn") - lookback)).drop("_chunk")
    need = (s.filter(F.col("_off") > 0)
            .select(key, F.col("_chunk").alias("_target"),
                    F.explode(F.sequence(F.greatest(F.col("_off") - lookback + 1, F.lit(1)),
                                         F.col("_off"))).alias("_g")))
    halo = (on_keys(tails, need, key, "_g")
            .withColumn("_chunk", F.col("_target")).drop("_target")
            .withColumn("_halo", F.lit(True)))
    return r.withColumn("_halo", F.lit(False)).unionByName(halo.select(*cols, "_halo"))


def by_chunk(key: str | Column) -> Window:
    return Window.partitionBy(key, "_chunk").orderBy("_g")


def drop_internal(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in INTERNAL if c in df.columns])
