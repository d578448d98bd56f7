"""One job from landed replies to bars, catalogue and report; run twice, or after it died, it changes nothing twice."""

import os
import uuid

import pytest

from pricewh.sources import ingest_job as J
from pricewh.sources.bar_store import BarStore

OK = ('{"Time Series (Daily)": {"2024-01-03": {"1. open": "10", "2. high": "12", "3. low": "9", "4. close": "11", '
      '"5. volume": "100"}, "2024-01-04": {"1. open": "x", "4. close": "1", "5. volume": "1"}}}')


@pytest.fixture
def house(spark, tmpdir_fresh):
    bars = BarStore(spark, f"job_{uuid.uuid4().hex[:10]}", 2)
    yield J.Warehouse(spark, os.path.join(tmpdir_fresh, "house"), bars)
    bars.drop()


def _inputs(spark, day="2024-01-02"):
    wide = spark.createDataFrame([(day, "AAPL", "1", "2", "3"), (day, "BTC-USD", "1", "NaN", "3"), ("n/a", "AAPL", "1", "2", "3")],
                                 "Date string, symbol string, Open string, Close string, Volume string")
    replies = spark.createDataFrame([("IBM", OK), ("IBM", '{"Note": "limit"}'), ("MSFT", '{"Note": "limit"}')],
                                    "symbol string, payload string")
    return wide, replies


def _state(house):
    bars = sorted((r.meta.asset_id, r.meta.data_source_id, str(r.business_date), r.ingest_id, r.quality_flags)
                  for r in house.bars.bars().collect())
    assets = sorted((r.asset_id, r.version, r.attributes["source"], r.valid_to is None) for r in house.assets().collect())
    report = sorted(tuple(r) for r in house.report().select(
        "batch", "symbol", "fetched", "transformed", "skipped", "nan_values", "stored", "errors").collect())
    return bars, assets, report


REPORT = [("b1", "AAPL", 2, 1, 1, 0, 1, 0), ("b1", "BTC-USD", 1, 1, 0, 1, 1, 0), ("b1", "IBM", 2, 1, 1, 0, 1, 1),
          ("b1", "MSFT", 0, 0, 0, 0, 0, 1)]


def test_one_batch_twice_and_the_next_one(spark, house):
    wide, replies = _inputs(spark)
    J.run(house, wide, replies, "b1", "job-1", "2024-01-05 00:00:00")
    first = _state(house)
    assert first[2] == REPORT and [b[0] for b in first[0]] == ["aapl_stock_01", "btc_usd_crypto_01", "ibm_stock_01"]
    assert [a[:3] for a in first[1]] == [("aapl_stock_01", 1, "yfinance"), ("btc_usd_crypto_01", 1, "yfinance"),
                                         ("ibm_stock_01", 1, "alphavantage"), ("msft_stock_01", 1, "alphavantage")]
    again = J.run(house, wide, replies, "b1", "job-1", "2024-01-05 00:00:00")
    assert again.count() == 4 and _state(house) == first
    observed = {r.step: r.rows for r in house.observed().collect() if r.batch == "b1"}
    assert (observed["land"], observed["transformed"], observed["errors"]) == (5, 3, 2)
    J.run(house, _inputs(spark, "2024-01-09")[0], replies, "b2", "job-2", "2024-01-10 00:00:00")
    bars, assets, report = _state(house)
    assert len(bars) == 5 and len(assets) == 4                      # IBM's bar is known, no catalogue row changed
    assert [r for r in report if r[0] == "b2"][2] == ("b2", "IBM", 2, 1, 1, 0, 0, 1)


@pytest.mark.parametrize("step", ["append", "_save_assets", "_report"])
def test_a_job_that_died_is_finished_by_running_it_again(spark, house, monkeypatch, step):
    wide, replies = _inputs(spark)

    def dies(*a, **k):
        raise RuntimeError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(*((BarStore, "append") if step == "append" else (J, step)), dies)
        with pytest.raises(RuntimeError):
            J.run(house, wide, replies, "b1", "job-1", "2024-01-05 00:00:00")
    J.run(house, wide, replies, "b1", "job-1", "2024-01-05 00:00:00")
    assert _state(house)[2] == REPORT and len(_state(house)[0]) == 3
