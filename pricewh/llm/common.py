"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import hashlib
import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricewh.sources.sinks import materialize

#: The white space that line keys, words and shingles are cut at: space, tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
#: Python's ``str.translate`` table that lower-cases A-Z only.
LOWER_AZ = {ord(u): low for u, low in zip(string.ascii_uppercase, string.ascii_lowercase, strict=True)}

#: Bounds on an Arrow batch between Spark and Python, so that very long texts never meet in one batch.
BATCH_ROWS, BATCH_BYTES = 1000, 2 << 20


def lower_az(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small in this session, unless the user has already made them smaller."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS),
                      ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key)
        digits = int("".join(ch for ch in now if ch.isdigit()) or 0)
        if digits <= 0 or digits > most:
            spark.conf.set(key, str(most))


#: Whether the shuffle files of a query go when it has ended, and not when the driver next collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Jobs that end in here leave no shuffle files behind.  A DataFrame that is returned lazily is not one of them."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stored(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` under ``spark.checkpoint.dir`` and read it back: a lineage cut that outlives executors."""
    return materialize(df, name=f"llm-{name}", codec=codec)


def drop_stored(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that no later plan reads."""
    jvm = df.sparkSession.sparkContext._jvm
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        if "/tables/llm-" in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def sha256_hex(text: str | bytes) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()
