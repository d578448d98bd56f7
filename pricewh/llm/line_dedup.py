"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z lower-cased.  Keys of at least
``MIN_CHARS`` code points are hashed to 128 bits.  Documents come in batches of ascending id.  The
hashes of all earlier batches stand in sorted runs: a sort-merge join of a batch's hashes with the
runs tells known lines from new ones, and the new ones become a run of their own.  When ``fanout``
runs stand on one level they are merged into one run of the next level, so a batch meets few runs.

A run is a table (h, holder) with the smallest document id that holds the line.  Nothing of it comes
to the driver.  Within a batch hashes are folded by an aggregation with a map-side part, so a line
that a third of all documents hold is one row a task there; the last join, which marks the lines to
drop, is a sort-merge join that Spark splits at such a line.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricewh.llm.common import ASCII_SPACE, bound_batches, drop_stored, stored

MIN_CHARS, BATCHES, FANOUT = 10, 4, 2


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", batches: int = BATCHES,
                fanout: int = FANOUT) -> DataFrame:
    """doc_id, text (lines that stay, joined by \\n), n_lines (before), n_dropped, row (the given row).

    Keys in at least two documents lose their lines in all documents but the one with the smallest
    id; there all of them stay.  Shorter keys always stay.  A null or empty text is one empty line.
    Rows that repeat an id are the same document.  A row without id passes unchanged and holds no
    lines for others.  An empty table gives no rows.
    """
    bound_batches(docs.sparkSession)
    keys = stored(line_hashes(docs, id_col, text_col), "line-hashes")
    edges = keys.agg(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)])).first()[0] or []
    edges = sorted(set(edges))
    runs, repeated = SortedRuns(fanout), []
    for low, high in zip([None, *edges], [*edges, None]):
        batch = keys
        if low is not None:
            batch = batch.filter(F.col("doc_id") > low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= high)
        repeated.append(runs.add(batch))
    holders = reduce(DataFrame.unionByName, repeated).groupBy("h").agg(F.min("holder").alias("holder"))
    drops = (keys.join(holders, "h").filter(F.col("doc_id") > F.col("holder"))
             .groupBy(F.col("doc_id").alias("_drop_id")).agg(F.collect_set("h").alias("drops")))
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.struct(*docs.columns).alias("row"))
    return _rebuild(rows.join(drops, F.col("doc_id") == F.col("_drop_id"), "left").drop("_drop_id"))


class SortedRuns:
    """Runs (h, holder) by level.  Batches must come in ascending order of document ids."""

    def __init__(self, fanout: int = FANOUT):
        self.fanout = fanout
        self.levels: list[list[DataFrame]] = []

    def add(self, batch: DataFrame) -> DataFrame:
        """Join a batch (h, doc_id) with the runs and add its new hashes as a run.

        Returns (h, holder) of the batch's hashes whose lines some document of the batch loses.
        """
        mine = batch.groupBy("h").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
        known = self._known()
        if known is not None:
            mine = mine.join(known, "h", "left")
        else:
            mine = mine.withColumn("holder", F.lit(None).cast(dict(batch.dtypes)["doc_id"]))
        met = stored(mine, "line-batch")
        self._push(0, stored(met.filter("holder IS NULL").select("h", F.col("first").alias("holder"))
                             .sortWithinPartitions("h"), "line-run"))
        return (met.select("h", F.coalesce("holder", "first").alias("holder"), "last")
                .filter("holder < last").drop("last"))

    def _known(self) -> DataFrame | None:
        runs = [r for level in self.levels for r in level]
        return reduce(DataFrame.unionByName, runs) if runs else None

    def _push(self, k: int, run: DataFrame) -> None:
        while len(self.levels) <= k:
            self.levels.append([])
        self.levels[k].append(run)
        if len(self.levels[k]) >= self.fanout:
            old, self.levels[k] = self.levels[k], []
            merged = reduce(DataFrame.unionByName, old).repartition("h").sortWithinPartitions("h")
            self._push(k + 1, stored(merged, "line-run"))
            for r in old:
                drop_stored(r)


def key_of(line: str) -> bytes:
    return line.strip(ASCII_SPACE).encode().lower()     # of bytes, lower() changes A-Z only


def line_hashes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, h): the different hashes of each row's long enough keys; rows without id give none."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, hashes = [], []
            for doc_id, text in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist()):
                found = {h for line in (text or "").split("\n") if (h := hash_of(line)) is not None}
                ids += [doc_id] * len(found)
                hashes += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, b.column("doc_id").type), pa.array(hashes, pa.binary())],
                                             names=["doc_id", "h"])

    picked = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).filter("doc_id IS NOT NULL")
    return picked.mapInArrow(run, f"doc_id {kind}, h binary")


def hash_of(line: str) -> bytes | None:
    """Hash of a line's key; none if the key is too short."""
    key = key_of(line)
    if len(key) < MIN_CHARS or not key.isascii() and len(key.decode()) < MIN_CHARS:
        return None
    return xxhash.xxh3_128_digest(key)


def _rebuild(rows: DataFrame) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, lines, dropped = [], [], []
            for text, drops in zip(b.column("text").to_pylist(), b.column("drops").to_pylist()):
                all_lines = (text or "").split("\n")
                stay = all_lines
                if drops:
                    gone = set(drops)
                    stay = [line for line in all_lines if hash_of(line) not in gone]
                texts.append("\n".join(stay))
                lines.append(len(all_lines))
                dropped.append(len(all_lines) - len(stay))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(texts, pa.string()), pa.array(lines, pa.int64()),
                 pa.array(dropped, pa.int64()), b.column("row")], names=["doc_id", "text", "n_lines", "n_dropped", "row"])

    schema = rows.select("doc_id", "text", F.lit(0).cast("bigint").alias("n_lines"),
                         F.lit(0).cast("bigint").alias("n_dropped"), "row").schema
    return rows.mapInArrow(run, schema)
