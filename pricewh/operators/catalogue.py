"""Versioned asset catalogue (SCD type 2): V1-V3, F1-F4.

The original application saves or deletes one asset at a time.  Here a whole change
log ``(asset_id, change_ts, seq, op, payload...)`` is turned into the
version history in one job, with these rules:

* a ``save`` closes the live version and opens version + 1;
* a ``delete`` closes the live version and opens a tombstone copy of it
  (``is_deleted``, version + 1) that stays open; it is a no-op when nothing
  is live (previous change missing or a delete);
* after a tombstone the next save starts a new *life* at version 1, so
  ``(asset_id, life, version)`` is unique.

Skew: one asset may own a large share of the log, and of one hour of it, so
no window is keyed by asset alone over raw rows.  The log is laid out once in
(asset, time) order (``windows.laid_out``) and cut wherever its range
partitions end.  A run of one asset's changes, however it is cut, has a small
summary, and summaries of neighbouring runs merge from left to right:

* how many changes and deletes in it take effect, leaving out a *leading*
  delete, of which only the run before can tell whether it does;
* where in it the last effective delete is;
* its first time, and its last change with payload.

Prefix merges over an asset's summaries give each run its offsets; rows then
need nothing but their own run.  Only an asset that crosses the end of a
partition has more than one run, so summaries are made for those assets alone:
at most two for each partition.  They are broadcast, and the log is shuffled
once.  A change without a time cannot be placed and fails the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pricewh.functions.columns import SOURCE_DESCRIPTION_PREFIX, capitalize, check_page
from pricewh.operators.windows import laid_out, on_keys
from pricewh.sources.sinks import materialize

KEYS = ("asset_id", "change_ts", "seq", "op")
_BEFORE = (Window.unboundedPreceding, -1)
#: Rows of the log that a task scans, or one run: what a task sorts does not grow with the log.
ROWS = 100_000


def _payload(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in KEYS and not c.startswith("_")]


def _runs(changes: DataFrame, partitions: int | None) -> DataFrame:
    """The log as a stored table in (asset, time, seq) order with ``_chunk`` and ``_id``."""
    placed = F.coalesce("change_ts", F.raise_error(F.concat(
        F.lit("a change has no change_ts: asset "), F.coalesce("asset_id", F.lit("NULL")))).cast("timestamp_ntz"))
    return laid_out(changes.withColumn("change_ts", placed), "asset_id", ["change_ts", "seq"], "changes", partitions)


def _of_cut_assets(changes: DataFrame) -> DataFrame:
    """The changes of assets with more than one run: an asset goes on in the next partition, so it is the first or
    the last of every partition that it lies in."""
    ends = changes.groupBy("_chunk").agg(F.min_by("asset_id", "_id").alias("_a"), F.max_by("asset_id", "_id").alias("_z"))
    cut = (ends.select("_chunk", F.explode(F.array("_a", "_z")).alias("asset_id")).distinct()
           .groupBy("asset_id").count().filter("count > 1").select("asset_id"))
    return on_keys(changes, F.broadcast(cut), "asset_id", how="left_semi")


def _dealt(changes: DataFrame) -> DataFrame:
    """Whole runs in partitions of about ``ROWS`` rows; the rows of a stored table are counted from its footers."""
    return changes.repartition(max(2, 1 + changes.count() // ROWS), "asset_id", "_chunk")


def _in_runs(changes: DataFrame, row: Column) -> DataFrame:
    """What a run's rows know of the rows before them in the run; ``row``: a change with its payload."""
    wl = Window.partitionBy("asset_id", "_chunk").orderBy("_id")
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_del = F.col("op") == "delete"
    df = (changes.withColumn("_lr", F.row_number().over(wl))
                 .withColumn("_prev", F.lag(row).over(wl))
                 .withColumn("_next", F.lead("change_ts").over(wl)))
    lead_del = (F.col("_lr") == 1) & is_del & ~F.col("_seed")       # effective iff the run before ends in a save
    base = F.when(lead_del, False).otherwise(
        ~is_del | F.col("_seed") | (F.col("_prev").getField("op") == "save"))
    df = df.withColumn("_fd", lead_del).withColumn("_b", base)
    bd = (F.col("_b") & is_del)
    return (df.withColumn("_c", F.sum(F.col("_b").cast("int")).over(upto))
              .withColumn("_cd", F.sum(bd.cast("int")).over(upto))
              .withColumn("_ldr", F.max(F.when(bd, F.col("_c"))).over(upto))
              .withColumn("_ldr_prev", F.max(F.when(bd, F.col("_c"))).over(wl.rowsBetween(*_BEFORE)))
              .withColumn("_has_fd", F.first("_fd").over(upto))
              .withColumn("_first_ts", F.first("change_ts").over(upto)))


def _scan(changes: DataFrame, seeded: bool) -> DataFrame:
    """History of a log that is cut into runs: ``_chunk`` numbers them in order, ``_id`` the rows.

    Inside a run everything is known except whether a leading delete is
    effective: that depends on the last raw change before the run (a delete
    only counts after a save).  Each run's summary leaves that row out and
    flags it; the merge over an asset's summaries resolves the flag and turns
    the counters into offsets.  A save's ``valid_to`` is the next raw change
    (a change after a save is always effective), so no look-ahead over
    effective rows is needed.
    """
    payload = _payload(changes)
    df = changes if seeded else changes.withColumn("_seed", F.lit(False))
    wa = Window.partitionBy("asset_id").orderBy("_chunk")
    row = F.struct(F.col("op"), *[F.col(c) for c in payload])
    is_del = F.col("op") == "delete"

    # a run's summary is at its last row; merged per asset
    s = (_in_runs(_of_cut_assets(df), row).filter(F.col("_next").isNull())
         .select("asset_id", "_chunk", row.alias("_last"), F.col("_has_fd"), F.col("_c").alias("_n0"),
                 F.col("_cd").alias("_nd0"), F.col("_ldr").alias("_ldr0"), "_first_ts"))
    prev_last = F.lag("_last").over(wa)
    s = (s.withColumn("_prev_b", prev_last)
          .withColumn("_h", F.col("_has_fd") & F.coalesce(prev_last.getField("op") == "save", F.lit(False))))
    hi = F.col("_h").cast("int")
    s = (s.withColumn("_n", F.col("_n0") + hi)
          .withColumn("_nd", F.col("_nd0") + hi)
          .withColumn("_ldr_b", F.when(F.col("_ldr0").isNotNull(), F.col("_ldr0") + hi)
                      .when(F.col("_h"), F.lit(1)))
          .withColumn("_next_ts", F.lead("_first_ts").over(wa)))
    s = (s.withColumn("_off", F.coalesce(F.sum("_n").over(wa.rowsBetween(*_BEFORE)), F.lit(0)))
          .withColumn("_doff", F.coalesce(F.sum("_nd").over(wa.rowsBetween(*_BEFORE)), F.lit(0))))
    s = s.withColumn("_pdr", F.max(F.col("_off") + F.col("_ldr_b")).over(wa.rowsBetween(*_BEFORE)))
    s = s.select("asset_id", "_chunk", "_prev_b", "_h", "_off", "_doff", "_next_ts", "_pdr")
    # an asset of one run has no summary: nothing comes before
    df = (on_keys(_in_runs(_dealt(df), row), F.broadcast(s), "asset_id", "_chunk", how="left")
          .withColumns({"_h": F.coalesce("_h", F.lit(False)), "_off": F.coalesce("_off", F.lit(0)),
                        "_doff": F.coalesce("_doff", F.lit(0))}))

    fd, h, bd = F.col("_fd"), F.col("_h"), F.col("_b") & is_del
    shift = (h & ~fd).cast("int")             # an effective leading delete precedes this row
    eff = F.col("_b") | (fd & h)
    r = F.when(fd, F.lit(1)).otherwise(F.col("_c") + shift)
    dels_before = F.when(fd, F.lit(0)).otherwise(F.col("_cd") - bd.cast("int") + shift)
    local_last = F.when(fd, F.lit(None)).otherwise(
        F.coalesce(F.col("_ldr_prev") + shift, F.when(h, F.lit(1))))
    last_del = F.coalesce(F.col("_off") + local_last, F.col("_pdr"), F.lit(0))
    prev = F.when(F.col("_lr") == 1, F.col("_prev_b")).otherwise(F.col("_prev"))
    tomb = is_del & ~F.col("_seed")
    nxt = F.coalesce(F.col("_next"), F.col("_next_ts"))
    return df.filter(eff).select(
        "asset_id",
        (F.col("_doff") + dels_before).cast("bigint").alias("life"),
        (F.col("_off") + r - last_del).cast("bigint").alias("version"),
        F.col("change_ts").alias("valid_from"),
        F.when(is_del, F.lit(None)).otherwise(nxt).alias("valid_to"),
        is_del.alias("is_deleted"), "seq", "_seed",
        *[F.when(tomb, prev.getField(c)).otherwise(F.col(c)).alias(c) for c in payload])


def _comparable(df: DataFrame, payload: list[str]):
    """Payload as a comparable value (maps as sorted entry arrays)."""
    from pyspark.sql.types import MapType
    types = {f.name: f.dataType for f in df.schema.fields}
    return F.struct(*[(F.array_sort(F.map_entries(F.col(c))) if isinstance(types[c], MapType) else F.col(c)).alias(c)
                      for c in payload])


def drop_unchanged_saves(changes: DataFrame) -> DataFrame:
    """Q4 option, on a log that is cut into runs: drop saves whose payload equals the live version's.

    A save is such a no-op exactly when the previous raw change is a save
    with the same payload (a chain of equal saves all match the live one;
    after a delete nothing is live).  Dropping them leaves every other
    row's previous raw change a save as before, so the scan over the rest
    gives the history without those versions.  The previous change of a
    run's first row comes from the run before it, as in the scan.
    """
    payload = [c for c in _payload(changes)]
    df = changes.withColumn("_cmp", _comparable(changes, payload))
    wl = Window.partitionBy("asset_id", "_chunk").orderBy("_id")
    wa = Window.partitionBy("asset_id").orderBy("_chunk")
    s = (_of_cut_assets(df).groupBy("asset_id", "_chunk").agg(F.max_by(F.struct("op", "_cmp"), "_id").alias("_l"))
         .withColumn("_pb", F.lag("_l").over(wa)).select("asset_id", "_chunk", "_pb"))
    df = (df.withColumn("_pop", F.lag("op").over(wl)).withColumn("_pcmp", F.lag("_cmp").over(wl))
            .withColumn("_lr", F.row_number().over(wl)))
    df = on_keys(df, F.broadcast(s), "asset_id", "_chunk", how="left")
    first = F.col("_lr") == 1
    pop = F.when(first, F.col("_pb").getField("op")).otherwise(F.col("_pop"))
    pcmp = F.when(first, F.col("_pb").getField("_cmp")).otherwise(F.col("_pcmp"))
    noop = (F.col("op") == "save") & (pop == "save") & F.col("_cmp").eqNullSafe(pcmp)
    if "_seed" in changes.columns:
        noop = noop & ~F.col("_seed")
    return df.filter(~noop).select(*changes.columns)


def scd2_history(changes: DataFrame, skip_unchanged: bool = False, partitions: int | None = None) -> DataFrame:
    """Version history for every asset in a change log (V1 + V2).

    ``skip_unchanged`` (off by default, like the original) makes a save
    that repeats the live version's payload a no-op (Q4).  ``partitions``
    fixes the number of runs' partitions; by default AQE sizes them.
    Changes of a null asset id are one asset's."""
    runs = _runs(changes, partitions)
    return _scan(drop_unchanged_saves(runs) if skip_unchanged else runs, seeded=False).drop("_seed")


def scd2_apply(history: DataFrame, batch: DataFrame, skip_unchanged: bool = False,
               partitions: int | None = None) -> DataFrame:
    """Apply a batch of later changes to a stored history (V3).

    Each touched asset's newest stored row seeds the scan: an open live
    version as a save (its ``valid_to`` gets closed), a tombstone as an
    already effective delete.  Only the newest row per asset is reread;
    rows of untouched assets and closed rows pass through unchanged.
    A change that is not later than its asset's newest stored change fails
    the job (that case needs a rebuild from the full log).
    """
    payload = _payload(batch)
    touched = batch.select("asset_id").distinct()
    # an asset's newest row, live or tombstone, is open
    hist_t = on_keys(history.filter(F.col("valid_to").isNull()), touched, "asset_id", how="left_semi")
    newest = (hist_t.groupBy("asset_id")
              .agg(F.max_by(F.struct("life", "version", "is_deleted", "valid_from", "seq", *payload),
                            F.struct("life", "version")).alias("n"))
              .select("asset_id", "n.*"))
    # a table: seeds, the test of late changes, offsets and replaced rows all read it
    newest = materialize(newest, name="scd2-newest")
    seeds = newest.select(
        "asset_id", F.col("valid_from").alias("change_ts"), "seq",
        F.when(F.col("is_deleted"), "delete").otherwise("save").alias("op"),
        *payload, F.lit(True).alias("_seed"))
    # Changes must come after the asset's newest stored change; a late one
    # would need a rebuild from the full log, so it fails the job instead
    # of giving a wrong history.
    last = newest.select("asset_id", F.struct(F.col("valid_from"), F.col("seq")).alias("_last"))
    late = F.struct(F.col("change_ts"), F.col("seq")) <= F.col("_last")
    batch = (on_keys(batch, last, "asset_id", how="left")
             .withColumn("change_ts", F.when(late, F.raise_error(F.concat(
                 F.lit("scd2_apply: change not later than the stored history for asset "),
                 F.coalesce("asset_id", F.lit("NULL"))))).otherwise(F.col("change_ts")).cast("timestamp_ntz"))
             .drop("_last"))
    runs = _runs(batch.withColumn("_seed", F.lit(False)).unionByName(seeds), partitions)
    scan = _scan(drop_unchanged_saves(runs) if skip_unchanged else runs, seeded=True)
    base = newest.select("asset_id", F.col("life").alias("_bl"), F.col("version").alias("_bv"))
    new = (on_keys(scan, base, "asset_id", how="left")
           .withColumn("version", F.when(F.col("life") == 0, F.col("version") + F.coalesce(F.col("_bv"), F.lit(1)) - 1)
                       .otherwise(F.col("version")))
           .withColumn("life", F.col("life") + F.coalesce(F.col("_bl"), F.lit(0)))
           .filter(~(F.col("_seed") & F.col("is_deleted")))
           .drop("_seed", "_bl", "_bv"))
    replaced = newest.filter(~F.col("is_deleted")).select("asset_id", "life", "version")
    kept = on_keys(history, replaced, "asset_id", "life", "version", how="left_anti")
    return kept.unionByName(new.select(*history.columns))


def scd2_apply_stored(spark, history_path: str, batch: DataFrame, out_path: str) -> DataFrame:
    """V3 on stored tables: read the history at ``history_path``, apply
    ``batch`` and write the new history to ``out_path`` (a new path; a job
    never overwrites what it reads).  Returns the written table, so a chain
    of batches keeps a short lineage."""
    if history_path.rstrip("/") == out_path.rstrip("/"):
        raise ValueError("out_path must differ from history_path")
    return materialize(scd2_apply(spark.read.parquet(history_path), batch), out_path)


def live(history: DataFrame) -> DataFrame:
    """Open, not deleted versions (one per live asset)."""
    return history.filter(F.col("valid_to").isNull() & ~F.col("is_deleted"))


def current_asset(history: DataFrame, asset_ids: DataFrame | None = None) -> DataFrame:
    """latest live version of each requested asset (all when None)."""
    cur = live(history)
    return cur if asset_ids is None else cur.join(asset_ids.select("asset_id"), "asset_id", "left_semi")


def active_assets(history: DataFrame, offset: int = 0, limit: int = 20) -> DataFrame:
    """F2 + P12: one page of live assets ordered by id (id, symbol, class).

    Plans as a top-(offset+limit) sort: each task keeps only its best
    offset+limit rows before the final merge.
    """
    check_page(offset, limit)
    return (live(history).select("asset_id", "symbol", "asset_class")
            .orderBy("asset_id").offset(offset).limit(limit))


def _source(history: DataFrame):
    return F.col("attributes").getItem("source")


def data_sources(history: DataFrame, offset: int = 0, limit: int = 20) -> DataFrame:
    """distinct sources of live assets, ordered by name, one page."""
    check_page(offset, limit)
    return (live(history).select(_source(history).alias("data_source_id"))
            .where(F.col("data_source_id").isNotNull()).distinct()
            .orderBy("data_source_id").offset(offset).limit(limit))


def data_source_detail(history: DataFrame, source_ids: DataFrame) -> DataFrame:
    """requested sources that back a live asset, with a description."""
    used = live(history).select(_source(history).alias("dataSourceId")).distinct()
    req = source_ids.select(F.col(source_ids.columns[0]).alias("dataSourceId")).distinct()
    return (req.join(used, "dataSourceId", "left_semi")
            .select("dataSourceId",
                    F.concat(F.lit(SOURCE_DESCRIPTION_PREFIX), capitalize("dataSourceId")).alias("description")))
