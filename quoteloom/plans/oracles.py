"""The same questions as :mod:`quoteloom.plans.acceptance`, asked in DuckDB SQL."""

from __future__ import annotations

_BARS = """
bars AS (
  SELECT 'U' || user_id AS symbol, CAST(ts AS DATE) AS date,
         arg_min(value, ts) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, ts) AS close, count(*) AS volume
  FROM events GROUP BY user_id, CAST(ts AS DATE)
)"""

_WORKLIST = (
    _BARS
    + """,
marks AS (
  SELECT symbol, max(date) AS last_date FROM bars WHERE date < DATE '2024-01-15' GROUP BY symbol
),
worklist AS (
  SELECT k.symbol, coalesce(m.last_date + 1, DATE '2024-01-01') AS start_date
  FROM (SELECT DISTINCT 'U' || user_id AS symbol FROM events) k
  LEFT JOIN marks m ON k.symbol = m.symbol
)"""
)

_QUOTE_COLUMNS = """b.symbol, b.date, b.open, b.high, b.low, b.close, b.volume,
       CAST(0 AS DOUBLE) AS dividends, CAST(0 AS DOUBLE) AS stock_splits"""

_FETCHED = f"""WITH {_WORKLIST}
SELECT {_QUOTE_COLUMNS}
FROM bars b JOIN worklist w ON b.symbol = w.symbol
WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25'"""

_REFUSED = """
refused AS (
  SELECT DISTINCT b.symbol FROM bars b JOIN worklist w ON b.symbol = w.symbol
  WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25' AND b.low < 0.25
)"""

_MERGED = f"""WITH {_BARS}
SELECT symbol, date, open, high, low,
       CASE WHEN date >= DATE '2024-01-13' THEN close + 1 ELSE close END AS close, volume
FROM bars"""

_LINES = """
lines AS (
  SELECT l_orderkey, l_linenumber, l_partkey,
         nullif(l_quantity, 50) AS l_quantity, nullif(l_discount, 0) AS l_discount
  FROM lineitem
)"""

_ALL_BARS = f"WITH {_BARS} SELECT * FROM bars"
_LATER_BARS = f"WITH {_BARS} SELECT * FROM bars WHERE date >= DATE '2024-01-13'"

_TWO_BATCHES = f"""WITH {_BARS}
SELECT {_QUOTE_COLUMNS},
       CASE WHEN b.date >= DATE '2024-01-13' THEN TIMESTAMP '2024-01-25 06:00:00'
            ELSE TIMESTAMP '2024-01-15 06:00:00' END AS import_time
FROM bars b WHERE b.date < DATE '2024-01-25'"""

_RANGES = f"""{_BARS},
ranges AS (
  SELECT symbol, DATE '2024-01-01' + CAST(lo AS INTEGER) AS start_date, DATE '2024-01-01' + CAST(hi AS INTEGER) AS end_date
  FROM (SELECT DISTINCT 'U' || user_id AS symbol, user_id AS n FROM events) k,
    LATERAL (VALUES (n % 5, n % 5 + 6), (3, 8), (20 - n % 3, NULL)) r(lo, hi)
)"""

_IN_RANGE = "b.date >= r.start_date AND (r.end_date IS NULL OR b.date < r.end_date)"

ORACLES: dict[str, str] = {
    "q_fetch_ranged": _FETCHED,
    "q_fetch_split": _FETCHED,
    "q_datasource": _FETCHED,
    "q_fetch_open_ended": f"""WITH {_WORKLIST}
SELECT {_QUOTE_COLUMNS}
FROM bars b JOIN worklist w ON b.symbol = w.symbol WHERE b.date >= w.start_date""",
    "q_fetch_period": f"""WITH {_BARS}
SELECT {_QUOTE_COLUMNS}
FROM bars b
WHERE b.date >= DATE '2024-02-15' - INTERVAL 1 MONTH AND b.date < DATE '2024-02-15'""",
    "q_fetch_isolate": f"""WITH {_WORKLIST}, {_REFUSED}
SELECT {_QUOTE_COLUMNS}
FROM bars b JOIN worklist w ON b.symbol = w.symbol
WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25'
  AND b.symbol NOT IN (SELECT symbol FROM refused)""",
    "q_fetch_routed": f"""WITH {_WORKLIST}, {_REFUSED}
SELECT {_QUOTE_COLUMNS}, CAST(NULL AS VARCHAR) AS error
FROM bars b JOIN worklist w ON b.symbol = w.symbol
WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25'
  AND b.symbol NOT IN (SELECT symbol FROM refused)
UNION ALL
SELECT symbol, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, symbol || ': Low below 0.25'
FROM refused""",
    "q_fetch_errors": f"""WITH {_WORKLIST}, {_REFUSED}
SELECT symbol, symbol || ': Low below 0.25' AS error FROM refused""",
    "q_worklist_distribute": f"WITH {_WORKLIST} SELECT symbol, start_date FROM worklist",
    "q_high_water_mark": f"WITH {_WORKLIST} SELECT symbol, last_date FROM marks",
    "q_advance_marks": f"""WITH {_BARS}
SELECT symbol, max(date) AS last_date FROM bars WHERE date < DATE '2024-01-25' GROUP BY symbol""",
    "q_worklist": f"WITH {_WORKLIST} SELECT symbol, start_date FROM worklist",
    "q_range_predicate": f"""WITH {_WORKLIST}
SELECT b.* FROM bars b JOIN worklist w ON b.symbol = w.symbol
WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25'""",
    "q_interval_worklist": f"""WITH {_BARS},
loaded AS (
  SELECT symbol, date AS lo, date + 1 AS hi FROM bars
  WHERE volume > 1 AND day(date) % 3 <> 0 AND date < DATE '2024-01-25'
),
pieces AS (
  SELECT symbol, lo, hi FROM loaded
  UNION ALL SELECT DISTINCT symbol, DATE '2024-01-25', DATE '2024-01-25' FROM bars
),
gaps AS (
  SELECT symbol, lo AS end_date, coalesce(max(hi) OVER (
      PARTITION BY symbol ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    DATE '2024-01-01') AS start_date
  FROM pieces
)
SELECT symbol, start_date, end_date FROM gaps WHERE start_date < end_date""",
    "q_pipeline_gaps": f"""WITH {_BARS},
refused AS (
  SELECT DISTINCT symbol, (date - DATE '2024-01-01') // 8 AS piece FROM bars
  WHERE date < DATE '2024-01-25' AND low < 0.25
)
SELECT {_QUOTE_COLUMNS},
       CASE WHEN r.symbol IS NULL THEN TIMESTAMP '2024-01-15 06:00:00'
            ELSE TIMESTAMP '2024-01-25 06:00:00' END AS import_time
FROM bars b LEFT JOIN refused r ON b.symbol = r.symbol AND (b.date - DATE '2024-01-01') // 8 = r.piece
WHERE b.date < DATE '2024-01-25'""",
    "q_range_join": f"""WITH {_RANGES}
SELECT b.*, r.start_date, r.end_date FROM bars b JOIN ranges r ON b.symbol = r.symbol AND {_IN_RANGE}""",
    "q_range_ends": f"""WITH {_RANGES}
SELECT b.* FROM bars b
WHERE EXISTS (SELECT 1 FROM ranges r WHERE b.symbol = r.symbol AND {_IN_RANGE})""",
    "q_jdbc_slices": f"""WITH {_BARS}
SELECT symbol, CASE WHEN volume > 1 THEN DATE '2024-01-13' ELSE date END AS date, close, volume FROM bars""",
    "q_jdbc_append_once": _ALL_BARS,
    "q_merge_upsert": _MERGED,
    "q_merge_table": _MERGED,
    "q_merge_partitions": _MERGED,
    "q_merge_bucketed": _MERGED,
    "q_dedup_key": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
             l_returnflag, l_linestatus, l_shipdate) AS r
  FROM lineitem)
WHERE r = 1""",
    "q_project_fixed": f"""WITH {_BARS}
SELECT symbol, date AS "Date", open AS "Open", high AS "High", low AS "Low", close AS "Close",
       volume AS "Volume", CAST(0 AS DOUBLE) AS "Dividends", CAST(0 AS DOUBLE) AS "Stock Splits"
FROM bars""",
    "q_project_narrow": f"WITH {_BARS} SELECT symbol, date, open, close FROM bars",
    "q_rename": f"WITH {_BARS} SELECT {_QUOTE_COLUMNS} FROM bars b",
    "q_lineage": f"""WITH {_BARS}
SELECT *, TIMESTAMP '2024-01-25 06:00:00' AS import_time, 'events' AS feed FROM bars""",
    "q_contract_cast": f"""WITH {_BARS}
SELECT date, CAST(open AS REAL) AS open, CAST(high AS REAL) AS high, CAST(low AS REAL) AS low,
       CAST(close AS REAL) AS close, CAST(volume * 600000000 AS INTEGER) AS volume, symbol
FROM bars WHERE volume * 600000000 <= 2147483647""",
    "q_contract_rejects": f"""WITH {_BARS}
SELECT symbol, date, volume * 600000000 AS volume, 'volume: not IntegerType' AS violation
FROM bars WHERE volume * 600000000 > 2147483647""",
    "q_contract_nulls": f"""WITH {_LINES}
SELECT *, CASE WHEN l_quantity IS NULL AND l_discount IS NULL
                 THEN 'l_quantity: missing; l_discount: missing'
               WHEN l_quantity IS NULL THEN 'l_quantity: missing'
               ELSE 'l_discount: missing' END AS violations
FROM lines WHERE l_quantity IS NULL OR l_discount IS NULL""",
    "q_null_audit": f"""WITH {_LINES}
SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(*) - count(l_orderkey) AS n_null FROM lines
UNION ALL SELECT 'l_linenumber', count(*), count(*) - count(l_linenumber) FROM lines
UNION ALL SELECT 'l_partkey', count(*), count(*) - count(l_partkey) FROM lines
UNION ALL SELECT 'l_quantity', count(*), count(*) - count(l_quantity) FROM lines
UNION ALL SELECT 'l_discount', count(*), count(*) - count(l_discount) FROM lines""",
    "q_incomplete_rows": f"""WITH {_LINES}
SELECT * FROM lines WHERE l_quantity IS NULL OR l_discount IS NULL""",
    "q_cast_string": "SELECT event_id, CAST(value AS VARCHAR) AS value FROM events",
    "q_limit": f"WITH {_BARS} SELECT * FROM bars ORDER BY date, symbol LIMIT 550",
    "q_tz_date": """
SELECT event_id, CAST((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/New_York' AS DATE) AS local_date
FROM events""",
    "q_format_ts": "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text FROM events",
    "q_format_date": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS date_text FROM events",
    "q_stamp_ms": """
SELECT event_id, left(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 23) AS ts_text FROM events""",
    "q_parse_date": """
SELECT o_orderkey, text, CAST(try_strptime(text, '%Y-%m-%d') AS DATE) AS order_date
FROM (
  SELECT o_orderkey,
         CASE WHEN o_orderstatus = 'P' THEN 'about ' ELSE '' END
           || strftime(o_orderdate, '%Y-%m-%d') AS text
  FROM orders)""",
    "q_count": "SELECT count(*) AS n_rows FROM lineitem",
    "q_table_count": "SELECT count(*) AS n_rows FROM lineitem",
    "q_dedup_exact": "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
    "q_duplicate_report": """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "q_flatten": f"""WITH {_BARS}
SELECT symbol, date, 'open' AS measure, open AS value FROM bars
UNION ALL SELECT symbol, date, 'high', high FROM bars
UNION ALL SELECT symbol, date, 'low', low FROM bars
UNION ALL SELECT symbol, date, 'close', close FROM bars
UNION ALL SELECT symbol, date, 'volume', CAST(volume AS DOUBLE) FROM bars""",
    "q_empty_typed": f"""WITH {_BARS},
loaded AS (SELECT symbol, max(date) AS last_date FROM bars GROUP BY symbol)
SELECT count(*) AS n_rows, CAST(10 AS INTEGER) AS n_columns
FROM bars b JOIN loaded k ON b.symbol = k.symbol WHERE b.date > k.last_date""",
    "q_reconcile": f"""WITH {_LINES}
SELECT count(*) AS rows_in,
       count(*) FILTER (WHERE l_quantity IS NOT NULL AND l_discount IS NOT NULL) AS rows_written,
       count(*) FILTER (WHERE l_quantity IS NULL OR l_discount IS NULL) AS rows_rejected,
       true AS balanced
FROM lines""",
    "q_inline_rows": """
SELECT o.o_orderpriority, o.o_orderkey, r.priority_rank
FROM orders o LEFT JOIN (
  VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('4-NOT SPECIFIED', 4), ('5-LOW', 5)
) r(o_orderpriority, priority_rank) ON o.o_orderpriority = r.o_orderpriority""",
    "q_dict_records": """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       json_extract_string(props, '$.note') AS note
FROM events""",
    "q_csv_seed": "SELECT * FROM customer",
    "q_infer_names": """
SELECT * REPLACE (CAST(c_custkey AS VARCHAR) AS c_custkey),
       (SELECT CASE WHEN max(c_custkey) < 2147483648 THEN 'int' ELSE 'bigint' END
        FROM customer) AS custkey_type
FROM customer""",
    "q_table_scan": "SELECT * FROM orders",
    "q_sql_scan": "SELECT * FROM customer",
    "q_table_create": f"""WITH {_BARS}
SELECT column_name, n.n_rows, n_null, column_type
FROM (SELECT count(*) AS n_rows, count(*) - count(symbol) AS symbol, count(*) - count(date) AS date,
             count(*) - count(open) AS open, count(*) - count(high) AS high,
             count(*) - count(low) AS low, count(*) - count(close) AS close,
             count(*) - count(volume) AS volume FROM bars)
     UNPIVOT (n_null FOR column_name IN (symbol, date, open, high, low, close, volume)) n
JOIN (VALUES ('symbol', 'string'), ('date', 'date'), ('open', 'double'), ('high', 'double'),
             ('low', 'double'), ('close', 'double'), ('volume', 'bigint')
     ) t(name, column_type) ON t.name = n.column_name""",
    "q_table_partitioned": f"""WITH {_BARS}
SELECT 'date=' || date AS partition, count(*) AS n_rows FROM bars GROUP BY date""",
    "q_write_overwrite": _LATER_BARS,
    "q_jdbc_stage": _LATER_BARS,
    "q_write_replace": f"""WITH {_BARS}
SELECT symbol, date, open, high, low, close FROM bars WHERE date >= DATE '2024-01-13'""",
    "q_write_append": _ALL_BARS,
    "q_jdbc_append": _ALL_BARS,
    "q_write_partitions": f"""WITH {_BARS}
SELECT symbol, date, open, high, low,
       CASE WHEN date >= DATE '2024-01-15' THEN close + 1 ELSE close END AS close, volume
FROM bars""",
    "q_jdbc_query": f"WITH {_WORKLIST} SELECT symbol, start_date FROM worklist",
    "q_pipeline_raw": f"""WITH {_WORKLIST}
SELECT {_QUOTE_COLUMNS}, TIMESTAMP '2024-01-25 06:00:00' AS import_time
FROM bars b JOIN worklist w ON b.symbol = w.symbol
WHERE b.date >= w.start_date AND b.date < DATE '2024-01-25'""",
    "q_pipeline_merge": _TWO_BATCHES,
    "q_pipeline_publish": _TWO_BATCHES,
    "q_pipeline_incremental": f"""WITH {_BARS},
newest AS (SELECT max(symbol) AS symbol FROM bars),
first_round AS (
  SELECT symbol, max(date) AS last_date FROM bars
  WHERE date < DATE '2024-01-15' AND symbol <> (SELECT symbol FROM newest) GROUP BY symbol
)
SELECT {_QUOTE_COLUMNS},
       CASE WHEN b.date < DATE '2024-01-15' AND f.symbol IS NOT NULL
            THEN TIMESTAMP '2024-01-15 06:00:00'
            ELSE TIMESTAMP '2024-01-25 06:00:00' END AS import_time
FROM bars b LEFT JOIN first_round f ON b.symbol = f.symbol
WHERE b.date < DATE '2024-01-25'""",
}
