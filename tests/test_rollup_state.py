"""Rollup state: batches in any order, replays, compaction and crashes give what all bars give at once."""

import itertools
import uuid

import pytest
from pyspark.sql import functions as F

from pricewh.operators import rollup_state
from pricewh.operators import rollups as R
from pricewh.operators.rollup_state import RollupState
from pricewh.sources import fixtures as X
from pricewh.session import scratch_path

SF = "/root/testdata/sf0.001"


def _state(spark):
    return RollupState(spark, scratch_path(spark, f"rollup-state-{uuid.uuid4().hex[:8]}"))


def _rows(rollups):
    return sorted(map(tuple, R.flatten_rollups(rollups).collect()), key=repr)


@pytest.fixture(scope="module")
def bars(spark):
    awkward = X.to_stored(spark.createDataFrame(
        [("a", "2024-01-01", 1.0, c, 1.0) for c in (None, float("nan"), 0.1, 0.2, 0.3, -0.0)]
        + [("b", "2024-01-02", 1.0, 1e300, 1.0), ("b", "2024-01-03", 1.0, 2.0, 1.0), (None, "2024-01-03", 1.0, 2.0, 1.0),
           ("a", None, 1.0, 7.0, 1.0)],
        "asset_id string, d string, open double, close double, volume double")
        .select("asset_id", F.col("d").cast("timestamp_ntz").alias("business_date"), "open", "close", "volume"))
    return X.stored_bars(spark, SF).unionByName(awkward, allowMissingColumns=True)


def test_any_order_of_batches_equals_recomputation(spark, bars):
    dealt = bars.withColumn("k", F.pmod(F.xxhash64("business_date", "meta.asset_id"), F.lit(3)))
    parts = [dealt.filter(F.col("k") == k).drop("k") for k in range(3)]
    want = _rows(R.monthly_rollup(bars))
    for order in list(itertools.permutations(range(3)))[::2]:
        state = _state(spark)
        for k in order:
            state.apply(parts[k], f"part-{k}")
        assert _rows(state.rollups()) == want


def test_replays_and_compactions_change_nothing(spark, bars):
    early = F.col("business_date") < F.lit("1996-01-01").cast("timestamp_ntz")
    state, want = _state(spark), _rows(R.monthly_rollup(bars))
    assert state.rollups().count() == 0                         # nothing applied yet
    state.apply(bars.filter(early), "one")
    state.apply(bars.filter(early), "one")
    state.compact()
    state.apply(bars.filter(early), "one")                      # a batch of an older generation
    state.apply(bars.filter(F.coalesce(~early, F.lit(True))), "two")
    state.apply(bars.limit(0), "none")
    assert _rows(state.rollups()) == want
    state.compact()
    state.compact()
    assert _rows(state.rollups()) == want


def test_a_batch_that_died_counts_once(spark, bars, monkeypatch):
    state = _state(spark)
    commit = rollup_state.ledger.commit

    def dies(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(rollup_state.ledger, "commit", dies)
    with pytest.raises(RuntimeError):
        state.apply(bars, "one")
    assert state.rollups().count() == 0
    monkeypatch.setattr(rollup_state.ledger, "commit", commit)
    state.compact()                                             # leaves what is not committed behind
    state.apply(bars, "one")
    assert _rows(state.rollups()) == _rows(R.monthly_rollup(bars))


def test_a_batch_reads_nothing_that_is_stored(spark, bars):
    state = _state(spark)
    state.apply(bars, "one")
    plan = R.partial_rollup(bars)._jdf.queryExecution().toString()
    assert "rollup-state" not in plan
    with pytest.raises(ValueError):
        state.apply(bars, rollup_state.BASE)
