"""Column expressions shared by the operators (all JVM-side, codegen'd)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that results must reproduce exactly.
# ---------------------------------------------------------------------------
ASSET_CLASS_CRYPTO = "crypto"          # symbol contains '-'
ASSET_CLASS_INDEX = "index"            # symbol contains '^'
ASSET_CLASS_STOCK = "stock"            # anything else
ASSET_ID_SUFFIX = "_01"
DESCRIPTION_PREFIX = "Daily market data for "
SOURCE_DESCRIPTION_PREFIX = "Data integration for "
DEFAULT_CURRENCY = "USD"
MONTH_INTERVAL = "1_month"
PRICE_KEYS = ("close", "price_usd", "yield_percent")   # first non-null wins
DEFAULT_ATTRIBUTES = ("open", "high", "low", "close", "volume")
VENDOR_FIELDS = {"1. open": "Open", "2. high": "High", "3. low": "Low",
                 "4. close": "Close", "5. volume": "Volume"}
VENDOR_SERIES_KEY = "Time Series (Daily)"
PROVIDER_DEFAULT = "yfinance"
PROVIDER_ALT = "alphavantage"
PROVIDERS = (PROVIDER_DEFAULT, PROVIDER_ALT)
CORRELATION_BANDS = ((0.7, "Highly Correlated"), (0.3, "Moderately Correlated"),
                     (-0.3, "Uncorrelated"))
CORRELATION_ELSE = "Negatively Correlated"
RSI_OVERBOUGHT = (70.0, "Overbought (Bearish Signal)")
RSI_OVERSOLD = (30.0, "Oversold (Bullish Signal)")
RSI_NEUTRAL = "Neutral"
LABEL_TODAY = "Today's Open (Current Context)"
LABEL_TOMORROW = "Tomorrow's Forecast"
LABEL_PAST = "Historical Backtest Prediction"
LABEL_FUTURE = "Future Forecast"
# ---------------------------------------------------------------------------


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def asset_class(symbol) -> Column:
    s = col_(symbol)
    return (F.when(s.contains("-"), F.lit(ASSET_CLASS_CRYPTO))
            .when(s.contains("^"), F.lit(ASSET_CLASS_INDEX))
            .otherwise(F.lit(ASSET_CLASS_STOCK)))


def clean_symbol(symbol) -> Column:
    s = F.lower(col_(symbol))
    return F.replace(F.replace(s, F.lit("-"), F.lit("_")), F.lit("^"), F.lit(""))


def canonical_asset_id(symbol) -> Column:
    """lower, '-' -> '_', drop '^', then '_{class}_01'."""
    return F.concat(clean_symbol(symbol), F.lit("_"), asset_class(symbol),
                    F.lit(ASSET_ID_SUFFIX))


def vendor_symbol(symbol) -> Column:
    """Symbol as sent to the JSON vendor: part before '-', no '^'."""
    return F.replace(F.split(col_(symbol), "-").getItem(0), F.lit("^"), F.lit(""))


def capitalize(s) -> Column:
    """Python str.capitalize: first character upper, the rest lower."""
    c = col_(s)
    return F.concat(F.upper(c.substr(1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def price_of(indicators) -> Column:
    """First non-null of close, price_usd, yield_percent in the indicator map."""
    m = col_(indicators)
    return F.coalesce(*[m.getItem(k) for k in PRICE_KEYS])


def pct_change(cur, prev) -> Column:
    """cur / prev - 1; NULL (not an error) when prev is 0 or NULL."""
    return F.try_divide(col_(cur), col_(prev)) - F.lit(1.0)


def ntz_lit(v) -> Column:
    """A ``timestamp_ntz`` literal that does not depend on any time zone.

    ``F.lit(datetime)`` makes a zoned TIMESTAMP from the Python process
    zone; going through text keeps the wall-clock value as it is.
    """
    text = v.isoformat(sep=" ") if hasattr(v, "isoformat") else str(v)
    return F.lit(text).cast("timestamp_ntz")


def trunc_hour(ts) -> Column:
    """Hour of a ``timestamp_ntz`` without the session zone (``date_trunc``
    on NTZ goes through a zoned timestamp)."""
    return F.to_timestamp_ntz(F.date_format(col_(ts), "yyyy-MM-dd HH:00:00"))


def iso_date(ts) -> Column:
    return F.date_format(col_(ts), "yyyy-MM-dd")


def iso_datetime(ts) -> Column:
    """Python datetime.isoformat() for a naive value (micros only if non-zero)."""
    t = col_(ts)
    return F.when(F.date_format(t, "SSSSSS") == F.lit("000000"),
                  F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")) \
        .otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def correlation_label(r) -> Column:
    r = col_(r)
    (t1, l1), (t2, l2), (t3, l3) = CORRELATION_BANDS
    return (F.when(r > t1, l1).when(r > t2, l2).when(r > t3, l3)
            .otherwise(F.lit(CORRELATION_ELSE)))


def rsi_label(r) -> Column:
    r = col_(r)
    return (F.when(r >= RSI_OVERBOUGHT[0], RSI_OVERBOUGHT[1])
            .when(r <= RSI_OVERSOLD[0], RSI_OVERSOLD[1])
            .otherwise(F.lit(RSI_NEUTRAL)))


def check_page(offset: int, limit: int) -> None:
    if not isinstance(limit, int) or limit < 1:
        raise ValueError(f"limit must be >= 1, got {limit!r}")
    if not isinstance(offset, int) or offset < 0:
        raise ValueError(f"offset must be >= 0, got {offset!r}")
