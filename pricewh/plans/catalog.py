"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query derives its inputs from the supplied tables, applies one
operator to all assets and returns flat, presentation-shaped rows (dates
as ISO text, like the original application's JSON replies; integers as bigint), so
results compare value by value with the DuckDB SQL in
``pricewh.plans.oracle``.  Nested results (maps, structs) are flattened.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pricewh.functions.columns import PROVIDER_ALT, PROVIDER_DEFAULT, iso_date, iso_datetime
from pricewh.operators import bars as B
from pricewh.operators import catalogue as C
from pricewh.operators import forecast as M
from pricewh.operators import history_store as H
from pricewh.operators import quant as Q
from pricewh.operators import reads as RD
from pricewh.operators import rollups as R
from pricewh.operators.rollup_state import RollupState
from pricewh.session import scratch_path
from pricewh.sources import fixtures as X
from pricewh.sources import ingest_job as J
from pricewh.sources import sinks as S
from pricewh.sources import vendor as V
from pricewh.sources.bar_store import BarStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed parameters of the registered queries.
LOAD_EXISTING_BEFORE = "1999-07-01"     # stored table holds bars before this day
LOAD_BATCH_FROM = "1999-01-01"          # incoming batch starts here (overlap)
REPLAY_MONTH = "1999-07"                # this month arrives twice in the batch
REPLAY_INGEST_ID = "job_etl_replay"
REPLAY_SYSTEM_DATE = "2026-01-02 00:00:00"
STALE_COUNT = 1000                      # added to the counts of the stored rollups
SCD2_SPLIT = "1998-01-01"               # history before, batch from here
PAGE_OFFSET = 75
RANGE_START, RANGE_END = "1996-01-01", "1997-01-01"
PAYLOAD_START, PAYLOAD_END = "1996-01-01", "1996-04-01"
ALT_ROUTED = ["BUILDING-USD", "^MACHINERY"]
FORECAST_AS_OF = "2001-08-01"


def _bigints(df: DataFrame) -> DataFrame:
    cols = [F.col(f.name).cast("bigint").alias(f.name)
            if isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)) else F.col(f.name)
            for f in df.schema.fields]
    return df.select(*cols)


def query(name: str):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf):
            return _bigints(fn(spark, sf))
        QUERIES[name] = run
        return run
    return deco


def _flat_stored(stored: DataFrame, stamp=iso_date) -> DataFrame:
    f = B.flatten_bars(stored)
    return f.withColumn("business_date", stamp("business_date"))


def _before(df, day):
    return df.filter(F.col("business_date") < F.lit(day).cast("timestamp_ntz"))


def _from(df, day):
    return df.filter(F.col("business_date") >= F.lit(day).cast("timestamp_ntz"))


# -- sources, loading ---------------------------------------------------------

@query("bars")
def q_bars(spark, sf):
    return _flat_stored(X.stored_bars(spark, sf))


@query("ingest_wide")
def q_ingest_wide(spark, sf):
    b = V.ingest_wide(X.landed_wide(spark, sf), PROVIDER_DEFAULT, X.FIXTURE_INGEST_ID, X.FIXTURE_SYSTEM_DATE)
    return _flat_stored(b, iso_datetime)


@query("ingest_json")
def q_ingest_json(spark, sf):
    b = V.ingest_json(X.landed_json(spark, sf), PROVIDER_ALT, X.FIXTURE_INGEST_ID, X.FIXTURE_SYSTEM_DATE)
    return _flat_stored(b, iso_datetime)


@query("route_symbols")
def q_route_symbols(spark, sf):
    return V.route_symbols(X.symbols(spark, sf), ALT_ROUTED)


@query("canonical_assets")
def q_canonical_assets(spark, sf):
    a = V.canonical_assets(V.route_symbols(X.symbols(spark, sf), ALT_ROUTED), "provider")
    return a.select("asset_id", "symbol", "asset_class", "description", "vendor_symbol",
                    F.col("attributes").getItem("source").alias("source"),
                    F.col("attributes").getItem("currency").alias("currency"))


@query("ingest_stats")
def q_ingest_stats(spark, sf):
    landed = X.landed_wide(spark, sf)
    parsed = V.parse_wide(landed)
    incoming = V.shape_bars(parsed, PROVIDER_DEFAULT, X.FIXTURE_INGEST_ID, X.FIXTURE_SYSTEM_DATE)
    existing = _before(X.stored_bars(spark, sf), LOAD_EXISTING_BEFORE)
    return V.ingest_stats(parsed, S.new_bars(incoming, existing))


@query("reply_errors")
def q_reply_errors(spark, sf):
    return V.json_errors(X.landed_json(spark, sf))


def _load_batch(spark, sf):
    stored = X.stored_bars(spark, sf)
    batch = _from(stored, LOAD_BATCH_FROM)
    replay = (batch.filter(F.date_format("business_date", "yyyy-MM") == REPLAY_MONTH)
              .withColumn("ingest_id", F.lit(REPLAY_INGEST_ID))
              .withColumn("system_date", F.lit(REPLAY_SYSTEM_DATE).cast("timestamp_ntz")))
    return _before(stored, LOAD_EXISTING_BEFORE), batch.unionByName(replay)


@query("load_new_bars")
def q_load_new_bars(spark, sf):
    existing, incoming = _load_batch(spark, sf)
    return _flat_stored(S.new_bars(incoming, existing))


@query("append_load")
def q_append_load(spark, sf):
    """S6 on disk, one asset a customer beside the hot ones: a batch that overlaps what is stored, loaded twice."""
    stored = X.stored_bars(spark, sf, "all")
    store = BarStore(spark, f"bars_{uuid.uuid4().hex[:12]}")
    store.append(_before(stored, LOAD_EXISTING_BEFORE), "existing")
    for _ in range(2):
        store.append(_from(stored, LOAD_BATCH_FROM), "batch")
    return _flat_stored(store.bars())


@query("ingest_job")
def q_ingest_job(spark, sf):
    """Landed wide rows and JSON replies to stored bars, catalogue and report; the batch is run twice."""
    name = uuid.uuid4().hex[:12]
    house = J.Warehouse(spark, scratch_path(spark, f"job-{name}"), BarStore(spark, f"job_bars_{name}"))
    wide = X.landed_wide(spark, sf).filter(F.col("symbol").rlike(r"^\^|-USD$"))
    for _ in range(2):
        report = J.run(house, wide, X.landed_json(spark, sf), "day-1", X.FIXTURE_INGEST_ID, X.FIXTURE_SYSTEM_DATE)
    assets = house.assets().select("asset_id", "version", F.col("attributes")["source"].alias("source"))
    return report.drop("batch").join(assets, "asset_id")


@query("upsert_rollups")
def q_upsert_rollups(spark, sf):
    stored = X.stored_bars(spark, sf)
    # a stale target: its counts are off, so rows that are not replaced show
    target = R.monthly_rollup(_before(stored, LOAD_EXISTING_BEFORE))
    target = target.withColumn("stats", F.col("stats").withField("count", F.col("stats.count") + STALE_COUNT))
    src = R.monthly_rollup(_from(stored, LOAD_BATCH_FROM))
    return R.flatten_rollups(S.upsert(target, src))


@query("rollup_state")
def q_rollup_state(spark, sf):
    # bars that come late, a batch twice, and a compaction between
    stored = X.stored_bars(spark, sf, "all")
    late = F.pmod(F.xxhash64("meta.asset_id", "business_date"), F.lit(5)) == 0
    early = _before(stored, LOAD_EXISTING_BEFORE)
    state = RollupState(spark, scratch_path(spark, f"rollup-state-{uuid.uuid4().hex[:12]}"))
    state.apply(early.filter(~late), "early")
    state.apply(_from(stored, LOAD_EXISTING_BEFORE), "rest")
    state.compact()
    state.apply(early.filter(late), "late")
    state.apply(early.filter(late), "late")
    return R.flatten_rollups(state.rollups())


# -- reads ----------------------------------------------------------------------

@query("recent_bars")
def q_recent_bars(spark, sf):
    r = RD.recent_bars(_mixed_prices(X.stored_bars(spark, sf, "all")), 30)
    return r.select("asset_id", "rank", "business_date", "quality_flags",
                    F.explode_outer("indicators").alias("indicator", "value"))


def _mixed_prices(stored):
    """Some bars with other indicators, and some without a map."""
    day, m = F.dayofmonth("business_date"), F.col("indicators")
    return stored.withColumn(
        "indicators",
        F.when(day == 7, F.create_map(F.lit("price_usd"), m["close"], F.lit("high"), m["open"]))
         .when(day == 8, F.create_map(F.lit("yield_percent"), m["close"]))
         .when(day != 9, m))


@query("recent_rollups")
def q_recent_rollups(spark, sf):
    r = RD.recent_rollups(R.monthly_rollup(X.stored_bars(spark, sf, "all")), 12)
    return R.flatten_rollups(r, "rank")


@query("bars_in_range")
def q_bars_in_range(spark, sf):
    return _flat_stored(RD.bars_in_range(X.stored_bars(spark, sf), RANGE_START, RANGE_END,
                                         source=PROVIDER_DEFAULT))


@query("bars_payload")
def q_bars_payload(spark, sf):
    stored = _mixed_prices(X.stored_bars(spark, sf, "all"))
    ids = stored.select(F.col("meta.asset_id").alias("assetId")).distinct()
    s, e = (F.lit(x).cast("timestamp_ntz") for x in (PAYLOAD_START, PAYLOAD_END))
    req = (ids.select("assetId", F.lit(PROVIDER_DEFAULT).alias("dataSourceId"), s.alias("start"), e.alias("end"))
           .unionByName(ids.select("assetId", F.lit(PROVIDER_ALT).alias("dataSourceId"),
                                   s.alias("start"), e.alias("end"))))
    p = RD.bars_payload(stored, req)
    return p.select("assetId", "datasourceId", "businessDate", F.array_join("attributes", ",").alias("attributes"),
                    F.explode_outer("values").alias("indicator", "value"))


# -- catalogue ------------------------------------------------------------------

def _history(spark, sf):
    return C.scd2_history(X.asset_changes(spark, sf))


def _flat_history(h: DataFrame) -> DataFrame:
    return h.select("asset_id", "life", "version",
                    iso_datetime("valid_from").alias("valid_from"),
                    iso_datetime("valid_to").alias("valid_to"),
                    "is_deleted", "seq", "symbol", "asset_class", "description",
                    F.col("attributes").getItem("source").alias("source"),
                    F.col("attributes").getItem("currency").alias("currency"), "attr")


@query("scd2_history")
def q_scd2_history(spark, sf):
    return _flat_history(_history(spark, sf))


@query("scd2_apply")
def q_scd2_apply(spark, sf):
    ch = X.asset_changes(spark, sf)
    cut = F.lit(SCD2_SPLIT).cast("timestamp_ntz")
    # the stored history is a table (written once, under the shared folder)
    old = S.materialize(C.scd2_history(ch.filter(F.col("change_ts") < cut)), name="scd2-history")
    return _flat_history(C.scd2_apply(old, ch.filter(F.col("change_ts") >= cut)))


@query("scd2_apply_stored")
def q_scd2_apply_stored(spark, sf):
    """V3 on disk; the batch arrives twice."""
    path = scratch_path(spark, f"history-{uuid.uuid4().hex[:12]}")
    ch = X.asset_changes(spark, sf)
    cut = F.lit(SCD2_SPLIT).cast("timestamp_ntz")
    H.write_history(C.scd2_history(ch.filter(F.col("change_ts") < cut)), path)
    for _ in range(2):
        H.apply_batch(spark, path, ch.filter(F.col("change_ts") >= cut), "later")
    return _flat_history(H.versions(spark, path))


@query("catalogue_page")
def q_catalogue_page(spark, sf):
    """A page deep in the catalogue, from the open versions of a stored history."""
    path = scratch_path(spark, f"history-{uuid.uuid4().hex[:12]}")
    H.write_history(_history(spark, sf), path)
    H.write_pages(H.open_versions(spark, path), path + "-pages", partitions=8)
    return H.page(spark, path + "-pages", PAGE_OFFSET, 50)


@query("active_assets")
def q_active_assets(spark, sf):
    return C.active_assets(_history(spark, sf), offset=20, limit=50)


@query("current_asset")
def q_current_asset(spark, sf):
    return _flat_history(C.current_asset(_history(spark, sf)))


@query("data_sources")
def q_data_sources(spark, sf):
    return C.data_sources(_history(spark, sf), 0, 20)


@query("data_source_detail")
def q_data_source_detail(spark, sf):
    h = _history(spark, sf)
    asked = h.select(F.col("attributes").getItem("source").alias("source_id")).distinct()
    return C.data_source_detail(h, asked)


# -- aggregations -----------------------------------------------------------------

@query("monthly_rollup")
def q_monthly_rollup(spark, sf):
    return R.flatten_rollups(R.monthly_rollup(X.stored_bars(spark, sf)))


@query("yearly_counts")
def q_yearly_counts(spark, sf):
    return R.yearly_counts(B.flatten_bars(X.stored_bars(spark, sf, "all")))


@query("coverage_report")
def q_coverage_report(spark, sf):
    return R.coverage_report(X.daily_bars(spark, sf, "all"))


# -- quant and chart series -----------------------------------------------------------

@query("daily_returns")
def q_daily_returns(spark, sf):
    return Q.daily_returns(X.daily_bars(spark, sf, "all"), 365).withColumn("business_date", iso_date("business_date"))


@query("rsi_series")
def q_rsi_series(spark, sf):
    r = Q.rsi_series(X.daily_bars(spark, sf, "all"), 14)
    return r.select("asset_id", iso_date("business_date").alias("business_date"), "close",
                    F.round("rsi", 6).alias("rsi"), "market_condition")


@query("rsi_latest")
def q_rsi_latest(spark, sf):
    return Q.rsi_latest(X.daily_bars(spark, sf, "all"), 14)


@query("asset_correlation")
def q_asset_correlation(spark, sf):
    b = X.daily_bars(spark, sf, "all")
    return Q.asset_correlation(b, Q.benchmark_pairs(b), 365)


@query("pair_growth")
def q_pair_growth(spark, sf):
    b = X.daily_bars(spark, sf, "all")
    return Q.pair_growth(b, Q.benchmark_pairs(b), 90)


@query("return_histogram")
def q_return_histogram(spark, sf):
    return Q.return_histogram(X.daily_bars(spark, sf, "all"), 365)


@query("price_series")
def q_price_series(spark, sf):
    return RD.price_series(R.monthly_rollup(X.stored_bars(spark, sf, "all")), 6)


@query("volume_series")
def q_volume_series(spark, sf):
    return RD.volume_series(X.stored_bars(spark, sf, "all"), 60)


# -- features, models, forecasts ------------------------------------------------------

def _features(spark, sf, by="segment"):
    return M.return_features(X.daily_bars(spark, sf, by))


@query("return_features")
def q_return_features(spark, sf):
    f = _features(spark, sf, "all")
    return f.select("asset_id", iso_date("bdate").alias("bdate"), "target_open", "close", "volume",
                    "prev_open", "prev_close", "prev_volume", F.round("ma_7d_close", 6).alias("ma_7d_close"),
                    "yesterday_trend", "target_return")


@query("chrono_split")
def q_chrono_split(spark, sf):
    s = M.chrono_split(_features(spark, sf, "all"))
    return s.select("asset_id", iso_date("bdate").alias("bdate"), "train_rank", "split")


@query("chrono_split_rows")
def q_chrono_split_rows(spark, sf):
    s = M.chrono_split_rows(_features(spark, sf, "all"))
    return s.select("asset_id", iso_date("bdate").alias("bdate"), "row_num", "train_size", "split")


@query("model_rows")
def q_model_rows(spark, sf):
    r = M.model_rows(M.chrono_split(_features(spark, sf, "all")))
    return r.select("asset_id", iso_date("bdate").alias("bdate"), "split", "label",
                    *[F.round(F.col("features")[i], 6).alias(c) for i, c in enumerate(M.FEATURES)])


@query("prediction_metrics")
def q_prediction_metrics(spark, sf):
    # the last day's trend as the prediction of the next return
    f = _features(spark, sf, "all").withColumn("prediction", F.col("yesterday_trend") / F.col("prev_close"))
    m = M.prediction_metrics(f)
    return m.select(*[F.round(c, 8).alias(c) for c in ("rmse", "mae", "r2")])


@query("gbt_forecast")
def q_gbt_forecast(spark, sf):
    f = M.gbt_forecast(_features(spark, sf))
    return f.select("asset_id", iso_date("bdate").alias("bdate"), "target_open", "predicted_price_usd",
                    "prediction", iso_date("feature_date").alias("feature_date"))


@query("gbt_metrics")
def q_gbt_metrics(spark, sf):
    return M.gbt_metrics(_features(spark, sf))


@query("model_leaderboard")
def q_model_leaderboard(spark, sf):
    return M.model_leaderboard(_features(spark, sf))


@query("forecast_view")
def q_forecast_view(spark, sf):
    return M.forecast_view(X.synthetic_predictions(spark, sf), FORECAST_AS_OF, 5)
