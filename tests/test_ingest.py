"""Canonical ids, vendor parsing, routing (facts from the original tests
plus the quirks Q8, Q14 and zone handling)."""

import datetime as dt

import pytest

from pricewh.functions.columns import capitalize
from pricewh.sources import vendor as V


def _sym(spark, *syms):
    return spark.createDataFrame([(s,) for s in syms], "symbol string")


def test_canonical_ids_for_the_three_classes(spark):
    rows = V.canonical_assets(_sym(spark, "AAPL", "BTC-USD", "^GSPC"), "yfinance").collect()
    got = {r.symbol: r for r in rows}
    assert got["AAPL"].asset_id == "aapl_stock_01"
    assert got["BTC-USD"].asset_id == "btc_usd_crypto_01"
    assert got["^GSPC"].asset_id == "gspc_index_01"
    assert got["BTC-USD"].asset_class == "crypto" and got["^GSPC"].asset_class == "index"
    assert got["AAPL"].description == "Daily market data for AAPL"
    assert got["AAPL"].attributes == {"source": "yfinance", "currency": "USD"}
    assert got["BTC-USD"].vendor_symbol == "BTC" and got["^GSPC"].vendor_symbol == "GSPC"


def test_any_hyphen_is_crypto(spark):
    # Q14: a share class like BRK-B is classed as crypto, as in the original
    r = V.canonical_assets(_sym(spark, "brk-b"), "yfinance").first()
    assert (r.asset_id, r.symbol, r.asset_class) == ("brk_b_crypto_01", "BRK-B", "crypto")


def test_capitalize_is_not_initcap(spark):
    r = spark.createDataFrame([("alpha vantage",)], "s string").select(capitalize("s").alias("c")).first()
    assert r.c == "Alpha vantage"


def _wide(spark, rows):
    return spark.createDataFrame(rows, "Date string, symbol string, Open string, High string, Low string, "
                                       "Close string, Volume string")


def test_three_day_frame_maps_to_bars(spark):
    rows = [(f"2026-05-0{d}", "AAPL", str(149.0 + d), None, None, str(149.5 + d), str(900 + 100 * d))
            for d in (1, 2, 3)]
    bars = V.ingest_wide(_wide(spark, rows), "yfinance", "job_123", "2026-05-04 00:00:00")
    got = bars.orderBy("business_date").collect()
    assert len(got) == 3
    first = got[0]
    assert first.meta.asset_id == "aapl_stock_01" and first.meta.data_source_id == "yfinance"
    assert first.indicators == {"open": 150.0, "close": 150.5, "volume": 1000.0}
    assert first.ingest_id == "job_123" and first.quality_flags == 0
    assert first.business_date == dt.datetime(2026, 5, 1) and first.timestamp == first.business_date


def test_bad_rows_skipped_nan_nulled_and_zones_normalised(spark):
    rows = [
        ("2024-03-08", "X", "1", None, None, "2", "3"),                       # clean
        ("2024-03-09", "X", "abc", None, None, "2", "3"),                     # non-numeric -> skipped
        ("2024-03-10", "X", None, None, None, "2", "3"),                      # NULL -> skipped
        ("2024-03-11", "X", "1", None, None, "NaN", "3"),                     # NaN -> NULL, flagged
        ("2024-03-12 00:00:00", "X", "1", None, None, "2", "3"),             # naive = UTC
        ("2024-03-13 00:00:00-05:00", "X", "1", None, None, "2", "3"),       # offset -> UTC
        ("not a date", "X", "1", None, None, "2", "3"),                       # skipped
    ]
    parsed = V.parse_wide(_wide(spark, rows))
    bars = V.shape_bars(parsed, "yfinance", "j", "2024-04-01 00:00:00")
    got = {r.business_date: r for r in bars.collect()}
    assert len(got) == 4
    assert got[dt.datetime(2024, 3, 11)].indicators["close"] is None
    assert got[dt.datetime(2024, 3, 11)].quality_flags == 1
    assert dt.datetime(2024, 3, 12) in got
    assert dt.datetime(2024, 3, 13, 5, 0) in got
    stats = V.ingest_stats(parsed, bars.limit(0)).first()
    assert (stats.fetched, stats.transformed, stats.skipped, stats.nan_values) == (7, 4, 3, 1)


def test_zone_conversion_ignores_session_zone(spark):
    rows = [("2024-03-10 00:00:00-05:00", "X", "1", None, None, "2", "3"),
            ("2024-03-10", "X", "1", None, None, "2", "3")]
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = sorted(r.business_date for r in V.ingest_wide(_wide(spark, rows)).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 10, 5, 0)]


def test_json_reply_without_series_gives_no_bars_and_an_error(spark):
    ok = ('{"Time Series (Daily)": {"2024-01-03": {"1. open": "10", "2. high": "12", "3. low": "9", '
          '"4. close": "11", "5. volume": "100"}, "2024-01-02": {"1. open": "9", "2. high": "10", '
          '"3. low": "8", "4. close": "10", "5. volume": "90"}}}')
    raw = spark.createDataFrame([("IBM", ok), ("IBM", '{"Note": "limit"}'), ("MSFT", '{"Note": "limit"}')],
                                "symbol string, payload string")
    bars = V.ingest_json(raw, "alphavantage", "j", "2024-01-05 00:00:00")
    got = sorted((r.business_date, r.indicators["close"]) for r in bars.collect())
    assert got == [(dt.datetime(2024, 1, 2), 10.0), (dt.datetime(2024, 1, 3), 11.0)]
    err = {r.symbol: r.errors for r in V.json_errors(raw).collect()}
    assert err == {"IBM": 1, "MSFT": 1}


def test_routing_list_table_and_unknown_provider(spark):
    s = _sym(spark, "AAPL", "IBM")
    got = {r.symbol: r.provider for r in V.route_symbols(s, ["IBM"]).collect()}
    assert got == {"AAPL": "yfinance", "IBM": "alphavantage"}
    assert {r.provider for r in V.route_symbols(s).collect()} == {"yfinance"}
    table = spark.createDataFrame([("IBM", "Bloomberg")], "symbol string, provider string")
    with pytest.raises(Exception, match="Unknown data provider"):
        V.route_symbols(s, table).collect()


def test_stats_with_reply_errors(spark):
    ok = ('{"Time Series (Daily)": {"2024-01-03": {"1. open": "10", "2. high": "12", "3. low": "9", '
          '"4. close": "11", "5. volume": "100"}}}')
    raw = spark.createDataFrame([("IBM", ok), ("IBM", '{"Note": "x"}'), ("MSFT", '{"Note": "x"}')],
                                "symbol string, payload string")
    parsed = V.parse_wide(V.json_to_wide(raw))
    bars = V.shape_bars(parsed, "alphavantage", "j", "2024-01-05 00:00:00")
    got = {r.symbol: r for r in V.ingest_stats(parsed, bars, V.json_errors(raw)).collect()}
    assert (got["IBM"].fetched, got["IBM"].transformed, got["IBM"].stored, got["IBM"].errors) == (1, 1, 1, 1)
    assert (got["MSFT"].fetched, got["MSFT"].stored, got["MSFT"].errors, got["MSFT"].asset_id) == (0, 0, 1, "msft_stock_01")


def test_daylight_gaps_folds_and_short_offsets_in_any_session_zone(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from pricewh.sources import vendor as V
    want = {"2024-03-10 02:30:00": dt.datetime(2024, 3, 10, 2, 30), "2024-11-03 06:30:00Z": dt.datetime(2024, 11, 3, 6, 30),
            "2024-11-03T01:30:00": dt.datetime(2024, 11, 3, 1, 30), "2024-05-01 00:00:00+05": dt.datetime(2024, 4, 30, 19),
            "2024-05-01 00:00:00-0530": dt.datetime(2024, 5, 1, 5, 30), "2024-05-01 00:00:00.25+05:30":
            dt.datetime(2024, 4, 30, 18, 30, 0, 250000), "2024-03-10": dt.datetime(2024, 3, 10),
            "2024-05-01 00:00:00 Europe/Paris": None, "2024-05-01 00:00:00 CET": None, "n/a": None, "2024-13-01": None,
            "2024-05-01Z": None, "": None}
    df = spark.createDataFrame([(k,) for k in want], "t string").select("t", V.business_ts("t").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York", "Europe/Berlin"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert {r.t: r.ts for r in df.collect()} == want, zone
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_infinite_numbers_count_as_nan(spark):
    from pricewh.sources import vendor as V
    df = spark.createDataFrame([("2024-01-01", "X", "1", "Infinity", "-Infinity")],
                               "Date string, symbol string, Open string, Close string, Volume string")
    r = V.parse_wide(df).first()
    assert r.valid and r.nan_values == 2 and r.close is None and r.volume is None and r.open == 1.0
