"""DuckDB statements equivalent to each registered query.

Written independently of the Spark plans: selections use ``row_number``
windows instead of grouped struct maxima, the as-of join is DuckDB's
``ASOF LEFT JOIN``, and the calendar has literal closed days instead of
rules.  Views ``part lineitem orders events`` are assumed.
"""

from __future__ import annotations

PRICE_HISTORY = """
li AS (
  SELECT CAST(l_partkey AS VARCHAR) AS ticker, CAST(l_shipdate AS DATE) AS day,
         l_extendedprice, l_quantity,
         row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey, l_linenumber, l_quantity, l_extendedprice) AS rn_first,
         row_number() OVER (PARTITION BY l_partkey, CAST(l_shipdate AS DATE)
                            ORDER BY l_orderkey DESC, l_linenumber DESC, l_quantity DESC,
                                     l_extendedprice DESC) AS rn_last
  FROM lineitem
),
price_history AS (
  SELECT ticker, day,
         max(CASE WHEN rn_first = 1 THEN l_extendedprice END) AS open,
         max(l_extendedprice) AS high,
         min(l_extendedprice) AS low,
         max(CASE WHEN rn_last = 1 THEN l_extendedprice END) AS close,
         sum(l_quantity) AS volume
  FROM li GROUP BY ticker, day
),
daily AS (
  SELECT h.ticker, 'yahoo_finance' AS source,
         CAST(strftime(h.day, '%Y%m%d') AS INTEGER) AS date_key,
         h.open AS stock_open, h.high AS stock_high, h.low AS stock_low, h.close AS stock_close,
         CAST(trunc(h.volume) AS BIGINT) AS volume
  FROM price_history h
  JOIN (SELECT CAST(p_partkey AS VARCHAR) AS ticker FROM part) t ON h.ticker = t.ticker
  WHERE h.day >= DATE '1995-01-01' AND h.day < DATE '2001-12-31'
)"""

FILINGS = """
facts AS (
  SELECT CAST(l_partkey AS VARCHAR) AS cik_num,
         l_returnflag || l_linestatus AS concept,
         CASE substr(o_orderpriority, 1, 1)
              WHEN '1' THEN '10-K' WHEN '2' THEN '10-Q' WHEN '3' THEN '8-K'
              WHEN '4' THEN '10-Q/A' WHEN '5' THEN 'S-1' END AS form,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS period_end,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS filed,
         l_quantity * 1e6 AS val,
         row_number() OVER (PARTITION BY l_partkey, l_returnflag || l_linestatus
                            ORDER BY o_orderdate, l_shipdate, l_orderkey, l_linenumber,
                                     l_quantity, l_extendedprice) - 1 AS pos
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
facts_p AS (
  SELECT CASE WHEN length(cik_num) >= 10 THEN cik_num ELSE lpad(cik_num, 10, '0') END AS cik,
         concept, form, period_end, filed, val, pos,
         CASE concept WHEN 'AF' THEN 1 WHEN 'AO' THEN 2 WHEN 'NF' THEN 3
                      WHEN 'NO' THEN 4 WHEN 'RF' THEN 5 WHEN 'RO' THEN 6 END AS prio
  FROM facts
),
choice AS (
  SELECT cik, coalesce(min(CASE WHEN form = '10-Q' THEN prio END),
                       min(CASE WHEN form = '10-K' THEN prio END)) AS chosen
  FROM facts_p WHERE prio IS NOT NULL GROUP BY cik
),
cand AS (
  SELECT f.cik,
         CAST(replace(f.period_end, '-', '') AS INTEGER) AS dk,
         CASE WHEN f.filed IS NULL OR f.filed = '' THEN 0
              ELSE CAST(replace(f.filed, '-', '') AS INTEGER) END AS fk,
         f.pos, CAST(trunc(f.val) AS BIGINT) AS shares
  FROM facts_p f JOIN choice c ON f.cik = c.cik AND f.prio = c.chosen
  WHERE f.form IN ('10-Q', '10-K') AND f.val IS NOT NULL
),
ranked AS (
  SELECT *, row_number() OVER (
           PARTITION BY cik, CASE WHEN dk < 19980101 THEN 0 ELSE dk END
           ORDER BY dk DESC, fk DESC, pos ASC) AS rn
  FROM cand WHERE dk <= 19991231
),
selected AS (SELECT cik, dk AS date_key, shares AS shares_outstanding FROM ranked WHERE rn = 1),
cikmap AS (
  SELECT ticker, CASE WHEN length(s) >= 10 THEN s ELSE lpad(s, 10, '0') END AS cik
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS ticker, CAST(p_partkey AS VARCHAR) AS s,
               row_number() OVER (PARTITION BY CAST(p_partkey AS VARCHAR) ORDER BY p_partkey DESC) AS rn
        FROM part) WHERE rn = 1
),
shares AS (
  SELECT t.ticker, m.cik, s.date_key, s.shares_outstanding
  FROM (SELECT CAST(p_partkey AS VARCHAR) AS ticker FROM part) t
  JOIN cikmap m ON t.ticker = m.ticker
  JOIN selected s ON s.cik = m.cik
)"""

EXTENDED = f"""
WITH {PRICE_HISTORY.strip()},
{FILINGS.strip()},
extended AS (
  SELECT d.ticker, d.source, d.date_key, d.stock_open, d.stock_high, d.stock_low, d.stock_close,
         d.volume, f.shares_outstanding AS edgar_shares_outstanding,
         d.stock_close * f.shares_outstanding AS market_cap,
         f.date_key AS edgar_10q_date_key, f.cik AS edgar_cik
  FROM daily d ASOF LEFT JOIN shares f ON d.ticker = f.ticker AND d.date_key >= f.date_key
)"""

# The same over the whole build's date range (prices and filings share it).
BUILT = EXTENDED.replace("h.day < DATE '2001-12-31'", "h.day < DATE '2024-12-31'").replace("dk < 19980101", "dk < 19950101").replace(
    "dk <= 19991231", "dk <= 20241231")

# The weekdays on which the exchange stayed closed, as published, for the
# years that the testdata cover (orders 1995-2001, events 2024).
CLOSED = """
closed AS (SELECT CAST(s AS DATE) AS h FROM (VALUES
  ('1995-01-02'), ('1995-02-20'), ('1995-04-14'), ('1995-05-29'), ('1995-07-04'), ('1995-09-04'), ('1995-11-23'), ('1995-12-25'),
  ('1996-01-01'), ('1996-02-19'), ('1996-04-05'), ('1996-05-27'), ('1996-07-04'), ('1996-09-02'), ('1996-11-28'), ('1996-12-25'),
  ('1997-01-01'), ('1997-02-17'), ('1997-03-28'), ('1997-05-26'), ('1997-07-04'), ('1997-09-01'), ('1997-11-27'), ('1997-12-25'),
  ('1998-01-01'), ('1998-01-19'), ('1998-02-16'), ('1998-04-10'), ('1998-05-25'), ('1998-07-03'), ('1998-09-07'), ('1998-11-26'), ('1998-12-25'),
  ('1999-01-01'), ('1999-01-18'), ('1999-02-15'), ('1999-04-02'), ('1999-05-31'), ('1999-07-05'), ('1999-09-06'), ('1999-11-25'), ('1999-12-24'),
  ('2000-01-17'), ('2000-02-21'), ('2000-04-21'), ('2000-05-29'), ('2000-07-04'), ('2000-09-04'), ('2000-11-23'), ('2000-12-25'),
  ('2001-01-01'), ('2001-01-15'), ('2001-02-19'), ('2001-04-13'), ('2001-05-28'), ('2001-07-04'), ('2001-09-03'),
  ('2001-09-11'), ('2001-09-12'), ('2001-09-13'), ('2001-09-14'), ('2001-11-22'), ('2001-12-25'),
  ('2024-01-01'), ('2024-01-15'), ('2024-02-19'), ('2024-03-29'), ('2024-05-27'), ('2024-06-19'), ('2024-07-04'), ('2024-09-02'),
  ('2024-11-28'), ('2024-12-25')) v(s))"""

_CALENDAR_OF_BOUNDS = f"""
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
{CLOSED.strip()},
calendar AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key,
         lower(dayname(d)) AS day_of_week,
         (isodow(d) <= 5 AND d NOT IN (SELECT h FROM closed)) AS nasdaq_open
  FROM days
)"""

CALENDAR = f"""
bounds AS (SELECT CAST(min(o_orderdate) AS DATE) AS lo, CAST(max(o_orderdate) AS DATE) AS hi FROM orders),
{_CALENDAR_OF_BOUNDS.strip()}"""

EVENT_CALENDAR = f"""
bounds AS (SELECT make_date(year(min(ts)), 1, 1) AS lo, make_date(year(max(ts)), 12, 31) AS hi FROM events),
{_CALENDAR_OF_BOUNDS.strip()}"""

PAIRS = """
pairs AS (
  SELECT DISTINCT event_type AS currency, 'U' || CAST(user_id % 5 AS VARCHAR) AS transaction_currency
  FROM events
  UNION ALL SELECT 'XAU', 'XAG'
)"""

EVENT_EXTENDED = """
q AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ticker, event_type AS source,
         CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         value AS stock_open, value AS stock_high, value AS stock_low, value AS stock_close,
         event_id AS volume
  FROM events
),
d AS (
  SELECT ticker, source, date_key, stock_open, stock_high, stock_low, stock_close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, date_key
        ORDER BY source NULLS FIRST, stock_open NULLS FIRST, stock_high NULLS FIRST,
                 stock_low NULLS FIRST, stock_close NULLS FIRST, volume NULLS FIRST) AS rn
    FROM q) WHERE rn = 1
),
f AS (
  SELECT 'U' || CAST(user_id AS VARCHAR) AS ticker, lpad(CAST(user_id AS VARCHAR), 10, '0') AS cik,
         CAST(strftime(CAST(ts AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         count(*) AS shares_outstanding
  FROM events WHERE event_type = 'signup' GROUP BY ALL
)"""

CIK_MAP = """
SELECT ticker, CASE WHEN length(s) >= 10 THEN s ELSE lpad(s, 10, '0') END AS cik
FROM (
  SELECT p_name AS ticker,
         CAST(p_partkey + CASE WHEN p_partkey % 7 = 0 THEN 10000000000 ELSE 0 END AS VARCHAR) AS s,
         row_number() OVER (PARTITION BY p_name ORDER BY p_partkey DESC) AS rn
  FROM part) WHERE rn = 1"""

ORDER_EXTENDED = """
q AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker, o_orderpriority AS source,
         CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         o_totalprice AS stock_open, o_totalprice AS stock_high, o_totalprice AS stock_low,
         o_totalprice AS stock_close, o_orderkey AS volume
  FROM orders
),
d AS (
  SELECT ticker, source, date_key, stock_open, stock_high, stock_low, stock_close, volume FROM (
    SELECT *, row_number() OVER (PARTITION BY ticker, date_key
        ORDER BY source NULLS FIRST, stock_open NULLS FIRST, stock_high NULLS FIRST,
                 stock_low NULLS FIRST, stock_close NULLS FIRST, volume NULLS FIRST) AS rn
    FROM q) WHERE rn = 1
),
f AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS ticker,
         CASE WHEN length(CAST(o_custkey AS VARCHAR)) >= 10 THEN CAST(o_custkey AS VARCHAR)
              ELSE lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS cik,
         CAST(strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS INTEGER) AS date_key,
         count(*) AS shares_outstanding
  FROM orders WHERE o_orderstatus = 'F' GROUP BY ALL
)"""

ASOF_SELECT = """
SELECT d.ticker, d.source, d.date_key, d.stock_open, d.stock_high, d.stock_low, d.stock_close,
       d.volume, f.shares_outstanding AS edgar_shares_outstanding,
       d.stock_close * f.shares_outstanding AS market_cap,
       f.date_key AS edgar_10q_date_key, f.cik AS edgar_cik
FROM d ASOF LEFT JOIN f ON d.ticker = f.ticker AND d.date_key >= f.date_key"""

FX = f"""
{PAIRS.strip()},
fx AS (
  SELECT event_type || 'U' || CAST(user_id % 5 AS VARCHAR) || '=X' AS symbol,
         CAST(ts AS DATE) AS day, value,
         row_number() OVER (PARTITION BY event_type || 'U' || CAST(user_id % 5 AS VARCHAR), CAST(ts AS DATE)
                            ORDER BY ts DESC, event_id DESC) AS rn
  FROM events
)"""

FX_RATES = """
SELECT p.currency, p.transaction_currency,
       CAST(strftime(fx.day, '%Y%m%d') AS INTEGER) AS date_key,
       CAST(1.0 AS DOUBLE) AS currency_unit, fx.value AS transaction_currency_rate
FROM pairs p JOIN fx ON fx.symbol = p.currency || p.transaction_currency || '=X' AND fx.rn = 1
WHERE fx.day >= DATE '2024-01-01' AND fx.day < DATE '2024-12-31'"""

ORACLE_SQL: dict[str, str] = {
    "asof_market_cap": EXTENDED + "\nSELECT * FROM extended",
    "asof_market_cap_monthly": EXTENDED + "\nSELECT * FROM extended",
    "asof_market_cap_bucketed": EXTENDED + "\nSELECT * FROM extended",
    "asof_hot_ticker": """WITH ticks AS (
  SELECT CASE WHEN user_id % 2 = 0 THEN 'EVERY' ELSE 'U' || CAST(user_id AS VARCHAR) END AS ticker, ts, event_id, event_type, value
  FROM events
),
bought AS (
  SELECT * FROM ticks WHERE event_type = 'purchase'
  QUALIFY row_number() OVER (PARTITION BY ticker, ts ORDER BY value DESC, event_id DESC) = 1
)
SELECT t.ticker, CAST(t.ts AS VARCHAR) AS ts, t.event_id, CAST(b.ts AS VARCHAR) AS purchase_ts, b.value AS paid, b.event_id AS purchase_id
FROM ticks t ASOF LEFT JOIN bought b ON t.ticker = b.ticker AND t.ts >= b.ts""",
    "built_extended": BUILT + "\nSELECT * FROM extended",
    "missing_filings": EXTENDED + "\nSELECT * FROM extended WHERE edgar_shares_outstanding IS NULL",
    "shares_outstanding": f"WITH {FILINGS.strip()}\nSELECT * FROM shares",
    "shares_outstanding_json": f"WITH {FILINGS.strip()}\nSELECT * FROM shares",
    "daily_prices": f"WITH {PRICE_HISTORY.strip()}\nSELECT * FROM daily",
    "daily_prices_repeated": f"""WITH {PRICE_HISTORY.strip()}
SELECT daily.* FROM daily
UNION ALL
SELECT daily.* FROM daily JOIN part ON daily.ticker = CAST(p_partkey AS VARCHAR) AND p_size % 2 = 0""",
    "daily_prices_csv": f"WITH {PRICE_HISTORY.strip()}\nSELECT * FROM daily",
    "daily_fx": f"WITH {FX.strip()}{FX_RATES}",
    "daily_fx_csv": f"""WITH {FX.strip()}{FX_RATES}
  AND p.transaction_currency <> 'U4' AND day(fx.day) NOT IN (13, 17, 21)""",
    "fx_rejects": f"""WITH {FX.strip()}
SELECT symbol || '.csv' AS file,
       CASE WHEN symbol LIKE '%U4=X' THEN '2024-01-02,7' WHEN day(day) = 21 THEN '2024-01-21'
            WHEN day(day) = 13 THEN CASE WHEN length(symbol) % 2 = 0 THEN 'n/a,2024-01-13' ELSE '2024-01-13,n/a' END
            ELSE CASE WHEN length(symbol) % 2 = 0 THEN '1.5,soon' ELSE 'soon,1.5' END END AS value,
       CASE WHEN symbol LIKE '%U4=X' THEN 'no header with Date, Close' WHEN day(day) = 21 THEN 'too few fields'
            WHEN day(day) = 13 THEN 'unreadable rate' ELSE 'unreadable day' END AS reason
FROM fx WHERE rn = 1 AND (symbol LIKE '%U4=X' OR day(day) IN (13, 17, 21))
UNION ALL
SELECT DISTINCT symbol || '.csv', 'Date,Last', 'no header with Date, Close' FROM fx WHERE symbol LIKE '%U4=X'""",
    "currency_pairs": f"WITH {PAIRS.strip()}\nSELECT * FROM pairs",
    "cik_map": CIK_MAP,
    "cik_map_json": CIK_MAP,
    "asset_dimension": """
SELECT row_number() OVER (ORDER BY p_name NULLS FIRST) - 1 AS asset_id,
       p_name AS ticker, 'equity' AS asset_class
FROM part""",
    "trading_calendar": f"WITH {CALENDAR.strip()}\nSELECT * FROM calendar",
    "trading_calendar_event_years": f"WITH {EVENT_CALENDAR.strip()}\nSELECT * FROM calendar",
    "open_days": f"WITH {CALENDAR.strip()}\nSELECT * FROM calendar WHERE nasdaq_open",
    "latest_per_key": f"""WITH {EVENT_EXTENDED.strip()}
SELECT d.ticker, d.source, d.date_key, d.stock_open, d.stock_high, d.stock_low, d.stock_close,
       d.volume, f.shares_outstanding AS edgar_shares_outstanding,
       d.stock_close * f.shares_outstanding AS market_cap,
       f.date_key AS edgar_10q_date_key, f.cik AS edgar_cik
FROM d ASOF LEFT JOIN f ON d.ticker = f.ticker AND d.date_key >= f.date_key""",
    "latest_per_customer": f"WITH {ORDER_EXTENDED.strip()}{ASOF_SELECT}",
    "coverage_report": EXTENDED + f""",
{CALENDAR.strip()}
SELECT 'equity_table_extended' AS "table", count(*) AS total_rows,
       count(*) FILTER (WHERE edgar_shares_outstanding IS NULL) AS flagged_rows
FROM extended
UNION ALL
SELECT 'date_table', count(*), count(*) FILTER (WHERE nasdaq_open) FROM calendar""",
}
