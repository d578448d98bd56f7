"""DuckDB SQL for each registered query (same inputs, same column names).

Written independently of the Spark operators, in the plainest form:
windows keyed by asset, all pairs spelled out, no skew handling.
"""

from __future__ import annotations

CANON = ("replace(replace(lower({s}), '-', '_'), '^', '') || '_' || "
         "CASE WHEN contains({s}, '-') THEN 'crypto' WHEN contains({s}, '^') THEN 'index' "
         "ELSE 'stock' END || '_01'")
ISO_DT = "strftime({c}, '%Y-%m-%dT%H:%M:%S')"
ISO_D = "strftime({c}, '%Y-%m-%d')"

BARS = f"""
bars AS (
  SELECT {CANON.format(s='c_mktsegment')} AS asset_id,
         o_orderdate AS business_date,
         min_by(o_totalprice, o_orderkey) AS open,
         max_by(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2)"""

BARS_ALL = f"""
bars AS (
  SELECT asset_id, business_date, min_by(o_totalprice, o_orderkey) AS open, max_by(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM (SELECT {CANON.format(s='c_mktsegment')} AS asset_id, o_orderdate AS business_date, o_totalprice, o_orderkey
        FROM orders JOIN customer ON o_custkey = c_custkey
        UNION ALL
        SELECT 'c' || CAST(o_custkey AS VARCHAR) || '_stock_01', o_orderdate, o_totalprice, o_orderkey FROM orders)
  GROUP BY 1, 2)"""

# Bars as (key, value) rows: day 7 holds other keys, day 8 one, day 9 none.
INDICATORS = """
ind AS (
  SELECT asset_id, business_date, 'open' AS indicator, open AS value, 1 AS pos FROM bars WHERE day(business_date) NOT IN (7, 8, 9)
  UNION ALL SELECT asset_id, business_date, 'close', close, 2 FROM bars WHERE day(business_date) NOT IN (7, 8, 9)
  UNION ALL SELECT asset_id, business_date, 'volume', volume, 3 FROM bars WHERE day(business_date) NOT IN (7, 8, 9)
  UNION ALL SELECT asset_id, business_date, 'price_usd', close, 1 FROM bars WHERE day(business_date) = 7
  UNION ALL SELECT asset_id, business_date, 'high', open, 2 FROM bars WHERE day(business_date) = 7
  UNION ALL SELECT asset_id, business_date, 'yield_percent', close, 1 FROM bars WHERE day(business_date) = 8
  UNION ALL SELECT asset_id, business_date, NULL, NULL, 1 FROM bars WHERE day(business_date) = 9)"""

SEGDAYS = """
segdays AS (
  SELECT c_mktsegment AS segment, o_orderdate AS day,
         min_by(o_totalprice, o_orderkey) AS open,
         max_by(o_totalprice, o_orderkey) AS close,
         CAST(count(*) AS DOUBLE) AS volume
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2)"""

ROLLUP = """
rollup AS (
  SELECT asset_id, '1_month' AS interval_type, period, n AS count,
         round_even(hi, 4) AS high, round_even(lo, 4) AS low,
         round_even(CASE WHEN n_price > 0 THEN (CAST(fx AS DOUBLE) / CAST(n_price AS DOUBLE)) / 1e8 END, 4) AS average
  FROM (SELECT asset_id, strftime(business_date, '%Y-%m') AS period, count(*) AS n,
               max(close) AS hi, min(close) AS lo, count(close) AS n_price,
               sum(CAST(round(close * 1e8) AS DECIMAL(38,0))) AS fx
        FROM bars GROUP BY 1, 2))"""

FLAT = ("asset_id, '{src}' AS data_source_id, {date} AS business_date, open, close, volume, "
        "{ingest} AS ingest_id, CAST({flags} AS BIGINT) AS quality_flags")

HISTORY = """
ch AS (
  SELECT 'cust_' || CAST(o_custkey AS VARCHAR) AS asset_id, o_orderdate AS change_ts, o_orderkey AS seq,
         CASE WHEN o_orderpriority = '5-LOW' THEN 'delete' ELSE 'save' END AS op,
         'C' || CAST(o_custkey AS VARCHAR) AS symbol, 'stock' AS asset_class,
         'Daily market data for C' || CAST(o_custkey AS VARCHAR) AS description,
         CASE o_orderstatus WHEN 'F' THEN 'yfinance' WHEN 'O' THEN 'alphavantage' ELSE 'landed_files' END AS source,
         'USD' AS currency, o_orderstatus AS attr
  FROM orders),
lagged AS (
  SELECT *, lag(op) OVER w AS prev_op, lag(source) OVER w AS prev_source, lag(attr) OVER w AS prev_attr
  FROM ch WINDOW w AS (PARTITION BY asset_id ORDER BY change_ts, seq)),
eff AS (
  SELECT asset_id, change_ts, seq, op = 'delete' AS is_deleted, symbol, asset_class, description, currency,
         CASE WHEN op = 'delete' THEN prev_source ELSE source END AS source,
         CASE WHEN op = 'delete' THEN prev_attr ELSE attr END AS attr
  FROM lagged WHERE op = 'save' OR prev_op = 'save'),
lives AS (
  SELECT *, CAST(coalesce(sum(CAST(is_deleted AS BIGINT)) OVER (PARTITION BY asset_id ORDER BY change_ts, seq
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS life
  FROM eff),
hist AS (
  SELECT asset_id, life,
         row_number() OVER (PARTITION BY asset_id, life ORDER BY change_ts, seq) AS version,
         change_ts AS valid_from,
         CASE WHEN is_deleted THEN NULL
              ELSE lead(change_ts) OVER (PARTITION BY asset_id, life ORDER BY change_ts, seq) END AS valid_to,
         is_deleted, seq, symbol, asset_class, description, source, currency, attr
  FROM lives),
live AS (SELECT * FROM hist WHERE valid_to IS NULL AND NOT is_deleted)"""

FLAT_HIST = (f"asset_id, life, version, {ISO_DT.format(c='valid_from')} AS valid_from, "
             f"{ISO_DT.format(c='valid_to')} AS valid_to, is_deleted, seq, symbol, asset_class, description, "
             "source, currency, attr")

RECENT = """
recent AS (
  SELECT asset_id, CAST(business_date AS DATE) AS date, close
  FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date DESC) AS rk FROM bars)
  WHERE rk <= {n}),
ids AS (SELECT DISTINCT asset_id FROM bars),
pairs AS (SELECT (SELECT min(asset_id) FROM ids) AS asset_id_1, asset_id AS asset_id_2
          FROM ids WHERE asset_id <> (SELECT min(asset_id) FROM ids)),
joined AS (
  SELECT p.asset_id_1, p.asset_id_2, a.date, a.close AS price1, b.close AS price2
  FROM pairs p JOIN recent a ON a.asset_id = p.asset_id_1
               JOIN recent b ON b.asset_id = p.asset_id_2 AND b.date = a.date)"""

RETURNS = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date DESC) AS rk FROM bars),
returns AS (
  SELECT asset_id, business_date, close, daily_return FROM (
    SELECT asset_id, business_date, close,
           (close / NULLIF(lag(close) OVER (PARTITION BY asset_id ORDER BY business_date), 0) - 1) * 100 AS daily_return
    FROM ranked WHERE rk <= 365)
  WHERE daily_return IS NOT NULL)"""

RSI = """
rsi_d AS (
  SELECT *, close - lag(close) OVER (PARTITION BY asset_id ORDER BY business_date) AS delta FROM {src}),
rsi_a AS (
  SELECT *, avg(CASE WHEN delta > 0 THEN delta ELSE 0.0 END) OVER f AS ag,
            avg(CASE WHEN delta < 0 THEN -delta ELSE 0.0 END) OVER f AS al,
            count(*) OVER f AS k
  FROM rsi_d WINDOW f AS (PARTITION BY asset_id ORDER BY business_date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
rsi AS (
  SELECT *, CASE WHEN k < 14 THEN NULL WHEN al = 0 AND ag = 0 THEN NULL WHEN al = 0 THEN 100.0
                 ELSE 100.0 - 100.0 / (1.0 + ag / al) END AS rsi
  FROM rsi_a)"""

RSI_LABEL = ("CASE WHEN rsi >= 70 THEN 'Overbought (Bearish Signal)' "
             "WHEN rsi <= 30 THEN 'Oversold (Bullish Signal)' ELSE 'Neutral' END")

FEATURES = """
feat0 AS (
  SELECT asset_id, business_date AS bdate, open AS target_open, close, volume,
         lag(open) OVER w AS prev_open, lag(close) OVER w AS prev_close, lag(volume) OVER w AS prev_volume,
         avg(close) OVER (PARTITION BY asset_id ORDER BY business_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
           AS ma_7d_close
  FROM bars WINDOW w AS (PARTITION BY asset_id ORDER BY business_date)),
feat AS (
  SELECT *, prev_close - prev_open AS yesterday_trend,
         (target_open - prev_close) / NULLIF(prev_close, 0) AS target_return
  FROM feat0
  WHERE prev_open IS NOT NULL AND prev_close IS NOT NULL AND prev_volume IS NOT NULL
    AND ma_7d_close IS NOT NULL AND target_open IS NOT NULL AND close IS NOT NULL AND volume IS NOT NULL
    AND (target_open - prev_close) / NULLIF(prev_close, 0) IS NOT NULL)"""

ORACLE: dict[str, str] = {}

ORACLE["bars"] = f"""
WITH {BARS}
SELECT {FLAT.format(src='yfinance', date=ISO_D.format(c='business_date'), ingest="'job_etl_fixture'", flags=0)}
FROM bars"""

# bars before the first day, and the batch's from it on, each stored once: all bars
ORACLE["append_load"] = ORACLE["bars"].replace(BARS, BARS_ALL)

_WIDE_ROWS = f"""
WITH {SEGDAYS},
wide AS (
  SELECT {CANON.format(s='segment')} AS asset_id, day AS business_date, open, close, volume, 0 AS flags
  FROM segdays
  UNION ALL
  SELECT {CANON.format(s="segment || '-USD'")}, day,
         open, CASE WHEN dayofmonth(day) = 13 AND volume = 1 THEN NULL ELSE close END, volume,
         CASE WHEN dayofmonth(day) = 13 AND volume = 1 THEN 1 ELSE 0 END
  FROM segdays
  UNION ALL
  SELECT {CANON.format(s="'^' || segment")}, day + INTERVAL 5 HOUR, open, close, volume, 0
  FROM segdays WHERE NOT (dayofmonth(day) = 13 AND volume = 1))"""

ORACLE["ingest_wide"] = f"""{_WIDE_ROWS}
SELECT {FLAT.format(src='yfinance', date=ISO_DT.format(c='business_date'), ingest="'job_etl_fixture'", flags='flags')}
FROM wide"""

ORACLE["ingest_json"] = f"""
WITH {SEGDAYS}
SELECT {CANON.format(s='segment')} AS asset_id, 'alphavantage' AS data_source_id,
       {ISO_DT.format(c='day')} AS business_date, open, close, volume,
       'job_etl_fixture' AS ingest_id, CAST(0 AS BIGINT) AS quality_flags
FROM segdays"""

_SYMBOLS = """
segs AS (SELECT DISTINCT c_mktsegment AS s FROM customer),
syms AS (SELECT s AS symbol FROM segs UNION ALL SELECT s || '-USD' FROM segs UNION ALL SELECT '^' || s FROM segs),
routed AS (SELECT symbol, CASE WHEN symbol IN ('BUILDING-USD', '^MACHINERY') THEN 'alphavantage'
                               ELSE 'yfinance' END AS provider FROM syms)"""

ORACLE["route_symbols"] = f"""
WITH {_SYMBOLS}
SELECT symbol, provider FROM routed"""

ORACLE["canonical_assets"] = f"""
WITH {_SYMBOLS}
SELECT {CANON.format(s='symbol')} AS asset_id, upper(symbol) AS symbol,
       CASE WHEN contains(symbol, '-') THEN 'crypto' WHEN contains(symbol, '^') THEN 'index' ELSE 'stock' END
         AS asset_class,
       'Daily market data for ' || upper(symbol) AS description,
       replace(split_part(symbol, '-', 1), '^', '') AS vendor_symbol,
       provider AS source, 'USD' AS currency
FROM routed"""

ORACLE["ingest_stats"] = f"""
WITH {SEGDAYS},
per AS (
  SELECT segment AS symbol, count(*) AS fetched, count(*) AS transformed, CAST(0 AS BIGINT) AS skipped,
         CAST(0 AS BIGINT) AS nan_values, count(*) FILTER (WHERE day >= TIMESTAMP '1999-07-01') AS stored
  FROM segdays GROUP BY 1
  UNION ALL
  SELECT segment || '-USD', count(*), count(*), 0,
         count(*) FILTER (WHERE dayofmonth(day) = 13 AND volume = 1), count(*)
  FROM segdays GROUP BY segment
  UNION ALL
  SELECT '^' || segment, count(*), count(*) FILTER (WHERE NOT (dayofmonth(day) = 13 AND volume = 1)),
         count(*) FILTER (WHERE dayofmonth(day) = 13 AND volume = 1), 0,
         count(*) FILTER (WHERE NOT (dayofmonth(day) = 13 AND volume = 1))
  FROM segdays GROUP BY segment)
SELECT symbol, {CANON.format(s='symbol')} AS asset_id, CAST(fetched AS BIGINT) AS fetched,
       CAST(transformed AS BIGINT) AS transformed, CAST(skipped AS BIGINT) AS skipped,
       CAST(nan_values AS BIGINT) AS nan_values, CAST(stored AS BIGINT) AS stored, CAST(0 AS BIGINT) AS errors
FROM per"""

# stocks come by replies, one of them without a series; the others by wide rows; nothing was stored before
ORACLE["ingest_job"] = f"""
WITH {SEGDAYS},
n AS (SELECT segment, count(*) AS days, count(*) FILTER (WHERE dayofmonth(day) = 13 AND volume = 1) AS dirty
      FROM segdays GROUP BY 1),
per AS (
  SELECT segment AS symbol, days AS fetched, 0 AS skipped, 0 AS nans, 1 AS errors, 'alphavantage' AS source FROM n
  UNION ALL SELECT segment || '-USD', days, 0, dirty, 0, 'yfinance' FROM n
  UNION ALL SELECT '^' || segment, days, dirty, 0, 0, 'yfinance' FROM n)
SELECT symbol, {CANON.format(s='symbol')} AS asset_id, CAST(fetched AS BIGINT) AS fetched,
       CAST(fetched - skipped AS BIGINT) AS transformed, CAST(skipped AS BIGINT) AS skipped,
       CAST(nans AS BIGINT) AS nan_values, CAST(fetched - skipped AS BIGINT) AS stored, CAST(errors AS BIGINT) AS errors,
       CAST(1 AS BIGINT) AS version, source
FROM per"""

ORACLE["reply_errors"] = f"""
WITH {SEGDAYS}
SELECT segment AS symbol, CAST(1 AS BIGINT) AS errors, count(DISTINCT strftime(day, '%Y-%m')) + 1 AS replies
FROM segdays GROUP BY 1"""

ORACLE["load_new_bars"] = f"""
WITH {BARS}
SELECT {FLAT.format(src='yfinance', date=ISO_D.format(c='business_date'),
                    ingest="CASE WHEN strftime(business_date, '%Y-%m') = '1999-07' THEN 'job_etl_replay' "
                           "ELSE 'job_etl_fixture' END", flags=0)}
FROM bars WHERE business_date >= TIMESTAMP '1999-07-01'"""

ORACLE["monthly_rollup"] = f"""
WITH {BARS}, {ROLLUP}
SELECT * FROM rollup"""

ORACLE["rollup_state"] = f"""
WITH {BARS_ALL}, {ROLLUP}
SELECT * FROM rollup"""

# months from 1999-01 come from the source, earlier ones keep the stale target
ORACLE["upsert_rollups"] = f"""
WITH {BARS}, {ROLLUP}
SELECT asset_id, interval_type, period, CASE WHEN period < '1999-01' THEN count + 1000 ELSE count END AS count,
       high, low, average
FROM rollup"""

ORACLE["recent_bars"] = f"""
WITH {BARS_ALL}, {INDICATORS}
SELECT asset_id, rank, {ISO_DT.format(c='business_date')} AS business_date, CAST(0 AS BIGINT) AS quality_flags,
       indicator, value
FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date DESC) AS rank FROM bars)
JOIN ind USING (asset_id, business_date)
WHERE rank <= 30"""

ORACLE["recent_rollups"] = f"""
WITH {BARS_ALL}, {ROLLUP}
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY period DESC) AS rank FROM rollup)
WHERE rank <= 12"""

ORACLE["bars_in_range"] = f"""
WITH {BARS}
SELECT {FLAT.format(src='yfinance', date=ISO_D.format(c='business_date'), ingest="'job_etl_fixture'", flags=0)}
FROM bars WHERE business_date >= TIMESTAMP '1996-01-01' AND business_date < TIMESTAMP '1997-01-01'"""

ORACLE["bars_payload"] = f"""
WITH {BARS_ALL}, {INDICATORS},
req AS (SELECT DISTINCT asset_id AS assetId, v.src AS datasourceId
        FROM bars, (VALUES ('yfinance'), ('alphavantage')) v(src)),
rec AS (
  SELECT asset_id AS assetId, 'yfinance' AS datasourceId, business_date, indicator, value, pos
  FROM ind WHERE business_date >= TIMESTAMP '1996-01-01' AND business_date < TIMESTAMP '1996-04-01'),
att AS (SELECT assetId, coalesce(string_agg(indicator, ',' ORDER BY pos), '') AS attributes
        FROM rec JOIN (SELECT assetId, max(business_date) AS business_date FROM rec GROUP BY 1) USING (assetId, business_date)
        GROUP BY 1)
SELECT assetId, datasourceId, {ISO_D.format(c='business_date')} AS businessDate, attributes, indicator, value
FROM rec JOIN att USING (assetId)
UNION ALL
SELECT assetId, datasourceId, NULL, 'open,high,low,close,volume', NULL, NULL
FROM req WHERE NOT EXISTS (SELECT 1 FROM rec WHERE rec.assetId = req.assetId AND rec.datasourceId = req.datasourceId)"""

ORACLE["scd2_history"] = f"""
WITH {HISTORY}
SELECT {FLAT_HIST} FROM hist"""

ORACLE["scd2_apply"] = ORACLE["scd2_history"]
ORACLE["scd2_apply_stored"] = ORACLE["scd2_history"]

ORACLE["current_asset"] = f"""
WITH {HISTORY}
SELECT {FLAT_HIST} FROM live"""

ORACLE["active_assets"] = f"""
WITH {HISTORY}
SELECT asset_id, symbol, asset_class FROM live ORDER BY asset_id LIMIT 50 OFFSET 20"""

ORACLE["catalogue_page"] = ORACLE["active_assets"].replace("OFFSET 20", "OFFSET 75")

ORACLE["data_sources"] = f"""
WITH {HISTORY}
SELECT DISTINCT source AS data_source_id FROM live WHERE source IS NOT NULL ORDER BY 1 LIMIT 20"""

ORACLE["data_source_detail"] = f"""
WITH {HISTORY}
SELECT DISTINCT source AS dataSourceId,
       'Data integration for ' || upper(substr(source, 1, 1)) || lower(substr(source, 2)) AS description
FROM hist WHERE source IN (SELECT source FROM live)"""

ORACLE["yearly_counts"] = f"""
WITH {BARS_ALL}
SELECT asset_id, CAST(year(business_date) AS BIGINT) AS business_date_year, count(*) AS cnt
FROM bars GROUP BY 1, 2"""

ORACLE["coverage_report"] = f"""
WITH {BARS_ALL}
SELECT asset_id, strftime(min(business_date), '%Y-%m-%d') AS oldest_date,
       strftime(max(business_date), '%Y-%m-%d') AS newest_date,
       count(*) AS total_trading_days_stored,
       round(CAST(floor(epoch(max(business_date) - min(business_date)) / 86400) AS BIGINT) / 365.25, 2)
         AS years_of_history
FROM bars GROUP BY 1"""

ORACLE["daily_returns"] = f"""
WITH {BARS_ALL}, {RETURNS}
SELECT asset_id, {ISO_D.format(c='business_date')} AS business_date, close, daily_return FROM returns"""

ORACLE["rsi_series"] = f"""
WITH {BARS_ALL}, {RSI.format(src='bars')}
SELECT asset_id, {ISO_D.format(c='business_date')} AS business_date, close, round(rsi, 6) AS rsi,
       {RSI_LABEL} AS market_condition
FROM rsi WHERE k >= 14"""

ORACLE["rsi_latest"] = f"""
WITH {BARS_ALL},
last42 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date DESC) AS rk,
                                  count(*) OVER (PARTITION BY asset_id) AS n FROM bars) WHERE rk <= 42),
{RSI.format(src='last42')}
SELECT asset_id, round(rsi, 2) AS current_rsi, {RSI_LABEL} AS market_condition
FROM rsi WHERE rk = 1 AND least(n, 42) >= 15"""

ORACLE["asset_correlation"] = f"""
WITH {BARS_ALL}, {RECENT.format(n=365)},
r AS (SELECT *, price1 / NULLIF(lag(price1) OVER w, 0) - 1 AS r1, price2 / NULLIF(lag(price2) OVER w, 0) - 1 AS r2
      FROM joined WINDOW w AS (PARTITION BY asset_id_1, asset_id_2 ORDER BY date)),
g AS (SELECT asset_id_1, asset_id_2, count(*) AS overlapping_trading_days,
             covar_samp(CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN r1 END,
                        CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN r2 END) AS cv,
             stddev_samp(CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN r1 END) AS s1,
             stddev_samp(CASE WHEN r1 IS NOT NULL AND r2 IS NOT NULL THEN r2 END) AS s2
      FROM r GROUP BY 1, 2),
c AS (SELECT *, CASE WHEN s1 * s2 = 0 THEN NULL ELSE cv / (s1 * s2) END AS corr FROM g)
SELECT asset_id_1, asset_id_2, overlapping_trading_days, round(corr, 4) AS correlation_coefficient,
       CASE WHEN corr > 0.7 THEN 'Highly Correlated' WHEN corr > 0.3 THEN 'Moderately Correlated'
            WHEN corr > -0.3 THEN 'Uncorrelated' ELSE 'Negatively Correlated' END AS interpretation
FROM c"""

ORACLE["pair_growth"] = f"""
WITH {BARS_ALL}, {RECENT.format(n=90)}
SELECT asset_id_1, asset_id_2, {ISO_D.format(c='date')} AS date, price1, price2,
       (price1 / NULLIF(first_value(price1) OVER w, 0) - 1) * 100 AS growth1,
       (price2 / NULLIF(first_value(price2) OVER w, 0) - 1) * 100 AS growth2
FROM joined WINDOW w AS (PARTITION BY asset_id_1, asset_id_2 ORDER BY date
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

_EDGE = "(CASE WHEN {i} >= 50 THEN hi ELSE CAST({i} AS DOUBLE) * step + lo END)"
ORACLE["return_histogram"] = f"""
WITH {BARS_ALL}, {RETURNS},
st AS (SELECT asset_id, CASE WHEN mn = mx THEN mn - 0.5 ELSE mn END AS lo,
                        CASE WHEN mn = mx THEN mx + 0.5 ELSE mx END AS hi
       FROM (SELECT asset_id, min(daily_return) AS mn, max(daily_return) AS mx FROM returns GROUP BY 1)),
st2 AS (SELECT *, (hi - lo) / 50.0 AS step FROM st),
c0 AS (SELECT r.asset_id, r.daily_return AS x, lo, hi, step,
              least(CAST(floor((r.daily_return - lo) * (50.0 / (hi - lo))) AS INTEGER), 49) AS i0
       FROM returns r JOIN st2 USING (asset_id)),
c1 AS (SELECT *, CASE WHEN x < {_EDGE.format(i='i0')} THEN i0 - 1 ELSE i0 END AS i1 FROM c0),
c2 AS (SELECT *, CASE WHEN x >= {_EDGE.format(i='(i1 + 1)')} AND i1 <> 49 THEN i1 + 1 ELSE i1 END AS i2 FROM c1),
counts AS (SELECT asset_id, CAST(i2 AS BIGINT) AS bin, count(*) AS frequency FROM c2 GROUP BY 1, 2),
grid AS (SELECT asset_id, lo, hi, step, CAST(b AS BIGINT) AS bin FROM st2, range(0, 50) t(b))
SELECT g.asset_id, g.bin, {_EDGE.format(i='g.bin')} AS bin_low, {_EDGE.format(i='(g.bin + 1)')} AS bin_high,
       coalesce(c.frequency, 0) AS frequency
FROM grid g LEFT JOIN counts c ON c.asset_id = g.asset_id AND c.bin = g.bin"""

ORACLE["price_series"] = f"""
WITH {BARS_ALL}, {ROLLUP},
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY period DESC) AS rk FROM rollup)
        WHERE rk <= 6 AND period IS NOT NULL)
SELECT asset_id, period, average, row_number() OVER (PARTITION BY asset_id ORDER BY period) AS pos FROM top"""

ORACLE["volume_series"] = f"""
WITH {BARS_ALL},
top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY business_date DESC) AS rk
                       FROM bars) WHERE rk <= 60)
SELECT asset_id, {ISO_D.format(c='business_date')} AS business_date, close, volume,
       row_number() OVER (PARTITION BY asset_id ORDER BY business_date) AS pos
FROM top"""

ORACLE["return_features"] = f"""
WITH {BARS_ALL}, {FEATURES}
SELECT asset_id, {ISO_D.format(c='bdate')} AS bdate, target_open, close, volume, prev_open, prev_close,
       prev_volume, round(ma_7d_close, 6) AS ma_7d_close, yesterday_trend, target_return
FROM feat"""

ORACLE["chrono_split"] = f"""
WITH {BARS_ALL}, {FEATURES}
SELECT asset_id, {ISO_D.format(c='bdate')} AS bdate, train_rank,
       CASE WHEN train_rank <= 0.8 THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, percent_rank() OVER (PARTITION BY asset_id ORDER BY bdate) AS train_rank FROM feat)"""

ORACLE["chrono_split_rows"] = f"""
WITH {BARS_ALL}, {FEATURES},
s AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY bdate) AS row_num,
             CAST(floor(count(*) OVER (PARTITION BY asset_id) * 0.8) AS BIGINT) AS train_size FROM feat)
SELECT asset_id, {ISO_D.format(c='bdate')} AS bdate, row_num, train_size,
       CASE WHEN row_num <= train_size THEN 'train' ELSE 'test' END AS split
FROM s"""

ORACLE["model_rows"] = f"""
WITH {BARS_ALL}, {FEATURES}
SELECT asset_id, {ISO_D.format(c='bdate')} AS bdate, CASE WHEN train_rank <= 0.8 THEN 'train' ELSE 'test' END AS split,
       target_return AS label, round(prev_close, 6) AS prev_close, round(prev_volume, 6) AS prev_volume, round(ma_7d_close, 6) AS ma_7d_close, round(yesterday_trend, 6) AS yesterday_trend
FROM (SELECT *, percent_rank() OVER (PARTITION BY asset_id ORDER BY bdate) AS train_rank FROM feat)"""

ORACLE["prediction_metrics"] = f"""
WITH {BARS_ALL}, {FEATURES},
e AS (SELECT target_return, yesterday_trend / prev_close - target_return AS e FROM feat)
SELECT round(sqrt(avg(e * e)), 8) AS rmse, round(avg(abs(e)), 8) AS mae,
       round(1.0 - avg(e * e) / var_pop(target_return), 8) AS r2
FROM e"""

ORACLE["forecast_view"] = f"""
WITH {BARS_ALL},
p AS (SELECT asset_id, CAST(business_date AS DATE) + 1 AS bdate, open AS target_open,
             close AS predicted_price_usd, (close - open) / NULLIF(open, 0) AS prediction FROM bars),
t AS (SELECT *, row_number() OVER (PARTITION BY asset_id ORDER BY bdate DESC) AS rank FROM p)
SELECT asset_id, rank, {ISO_D.format(c='bdate')} AS target_date,
       CASE WHEN bdate = DATE '2001-08-01' THEN 'Today''s Open (Current Context)'
            WHEN bdate = DATE '2001-08-02' THEN 'Tomorrow''s Forecast'
            WHEN bdate < DATE '2001-08-01' THEN 'Historical Backtest Prediction'
            ELSE 'Future Forecast' END AS timeline_context,
       round(coalesce(prediction, 0.0) * 100, 2) AS predicted_return_percentage,
       round(coalesce(predicted_price_usd, 0.0), 2) AS predicted_price_usd
FROM t WHERE rank <= 5"""
