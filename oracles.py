"""DuckDB SQL for the registered queries, written against the raw tables.

Each statement is assembled from common table expressions: the derived quotes
and listing, the cleansed tables, the indicators, and the query on top.
"""

from __future__ import annotations

AS_OF = "DATE '2000-06-30'"

CTES = {
    "px": """
        SELECT CAST(l_shipdate AS DATE) AS td, CAST(l_suppkey AS VARCHAR) AS code,
               l_extendedprice AS p, l_quantity AS q,
               (l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey AS seq
        FROM lineitem""",
    "bars": """
        SELECT td, code, arg_min(p, seq) AS open, max(p) AS high, min(p) AS low, arg_max(p, seq) AS close,
               CAST(sum(CAST(q AS DECIMAL(18,2))) AS DOUBLE) AS volume,
               CAST(sum(CAST(p * q AS DECIMAL(18,2))) AS DOUBLE) AS turnover_value
        FROM px GROUP BY td, code""",
    "factored": """
        SELECT *, CASE WHEN CAST(code AS INTEGER) % 10 = 0 AND td < DATE '1998-01-01'
                       THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS f
        FROM bars""",
    "bronze": """
        SELECT strftime(td, '%Y-%m-%d') AS "Date", code AS "Code", open AS "Open", high AS "High", low AS "Low",
               close AS "Close", volume AS "Volume", turnover_value AS "TurnoverValue", f AS "AdjustmentFactor",
               open * f AS "AdjustmentOpen", high * f AS "AdjustmentHigh", low * f AS "AdjustmentLow",
               CASE WHEN day(td) = 13 THEN NULL WHEN day(td) = 14 THEN 0.0::DOUBLE
                    ELSE close * f END AS "AdjustmentClose",
               CASE WHEN day(td) = 15 THEN NULL ELSE volume / f END AS "AdjustmentVolume"
        FROM factored""",
    "renamed": """
        SELECT CAST("Date" AS DATE) AS trade_date, "Code" AS code, "AdjustmentOpen" AS open,
               "AdjustmentHigh" AS high, "AdjustmentLow" AS low, "AdjustmentClose" AS close,
               "AdjustmentVolume" AS volume, "TurnoverValue" AS turnover_value,
               "AdjustmentFactor" AS adjustment_factor, "Open" AS raw_open, "High" AS raw_high,
               "Low" AS raw_low, "Close" AS raw_close, "Volume" AS raw_volume
        FROM bronze""",
    "silver": "SELECT * FROM renamed WHERE close IS NOT NULL AND close > 0 AND volume IS NOT NULL AND volume >= 0",
    "listing": """
        SELECT '2000-06-30' AS "Date", CAST(s_suppkey AS VARCHAR) AS "Code", s_name AS "CompanyName",
               s_name AS "CompanyNameEnglish", CAST(n_nationkey AS VARCHAR) AS "Sector17Code",
               n_name AS "Sector17CodeName", CAST(n_nationkey AS VARCHAR) AS "Sector33Code",
               n_name AS "Sector33CodeName",
               CASE WHEN s_acctbal >= 5000 THEN 'Large' ELSE 'Small' END AS "ScaleCategory",
               CAST(r_regionkey AS VARCHAR) AS "MarketCode", r_name AS "MarketCodeName"
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "old_listing": """
        SELECT * REPLACE ('1999-06-30' AS "Date", "CompanyName" || ' (old)' AS "CompanyName") FROM listing""",
    "snapshots": "SELECT * FROM listing UNION ALL SELECT * FROM old_listing",
    "master": """
        SELECT "Code" AS code, "CompanyName" AS company_name, "CompanyNameEnglish" AS company_name_en,
               "Sector17Code" AS sector17_code, "Sector17CodeName" AS sector17_name,
               "Sector33Code" AS sector33_code, "Sector33CodeName" AS sector33_name,
               "ScaleCategory" AS scale_category, "MarketCode" AS market_code, "MarketCodeName" AS market_name
        FROM snapshots s
        WHERE "Date" = (SELECT max("Date") FROM snapshots n WHERE n."Code" = s."Code")""",
    "steps": """
        SELECT trade_date, code, open, high, low, close, volume, turnover_value,
               avg(close) OVER (w ROWS 4 PRECEDING) AS ma5,
               avg(close) OVER (w ROWS 24 PRECEDING) AS ma25,
               avg(close) OVER (w ROWS 74 PRECEDING) AS ma75,
               (close / nullif(lag(close, 1) OVER w, 0) - 1) * 100 AS return_1d,
               (close / nullif(lag(close, 5) OVER w, 0) - 1) * 100 AS return_5d,
               (close / nullif(lag(close, 21) OVER w, 0) - 1) * 100 AS return_21d,
               avg(volume) OVER (w ROWS 4 PRECEDING) AS volume_ma5,
               max(high) OVER (w ROWS 251 PRECEDING) AS high_52w,
               min(low) OVER (w ROWS 251 PRECEDING) AS low_52w
        FROM silver WINDOW w AS (PARTITION BY code ORDER BY trade_date)""",
    "metrics": """
        SELECT *, stddev_samp(return_1d) OVER (PARTITION BY code ORDER BY trade_date ROWS 19 PRECEDING)
                    AS volatility_20d,
               (close / nullif(high_52w, 0) - 1) * 100 AS dist_from_high_52w,
               (close / nullif(low_52w, 0) - 1) * 100 AS dist_from_low_52w
        FROM steps""",
    "stocks": """
        SELECT m.*, company_name, sector17_name, sector33_name, market_name, scale_category
        FROM metrics m LEFT JOIN master USING (code)""",
    "sectors": """
        SELECT trade_date, sector17_name, count(code) AS stock_count, avg(return_1d) AS avg_return_1d,
               avg(return_5d) AS avg_return_5d, sum(turnover_value) AS total_turnover,
               avg(volatility_20d) AS avg_volatility
        FROM stocks GROUP BY trade_date, sector17_name""",
    "latest": "SELECT * FROM stocks WHERE trade_date = (SELECT max(trade_date) FROM stocks)",
    # The batch that the merge queries apply: the bars of the last month before
    # the as-of day with restated closes, and the bars after it.
    "batch": f"""
        SELECT * REPLACE (CASE WHEN CAST("Date" AS DATE) <= {AS_OF} THEN "AdjustmentClose" + 1
                               ELSE "AdjustmentClose" END AS "AdjustmentClose")
        FROM bronze WHERE CAST("Date" AS DATE) >= DATE '2000-06-01'""",
    "loaded": f"""SELECT * FROM bronze WHERE CAST("Date" AS DATE) <= {AS_OF}""",
    "spoilt": """
        SELECT * FROM renamed UNION ALL SELECT * FROM renamed WHERE day(trade_date) = 16""",
    "broken": """
        SELECT * REPLACE (
            CASE WHEN day(trade_date) <> 3 THEN trade_date END AS trade_date,
            CASE WHEN day(trade_date) <> 4 THEN code END AS code,
            CASE WHEN day(trade_date) = 5 THEN low - 1 ELSE high END AS high,
            CASE WHEN day(trade_date) = 6 THEN -volume ELSE volume END AS volume)
        FROM spoilt""",
    "broken_range": f"SELECT * FROM broken WHERE trade_date BETWEEN DATE '1999-07-01' AND {AS_OF}",
}

METRIC_COLUMNS = (
    "ma5 ma25 ma75 return_1d return_5d return_21d volatility_20d volume_ma5 high_52w low_52w "
    "dist_from_high_52w dist_from_low_52w"
).split()
PRICES = "trade_date, code, open, high, low, close, volume, turnover_value"
ATTRIBUTES = "company_name, sector17_name, sector33_name, market_name, scale_category"


def rounded(columns, digits: int | None = None) -> str:
    """Averages of prices at 8 places, percentages at 6, as the Spark side does."""
    places = {c: digits if digits is not None else (8 if c.startswith(("ma", "volume_ma")) else 6) for c in columns}
    return ", ".join(f"round({c}, {n}) AS {c}" for c, n in places.items())


def checks(source: str, table: str, stamp: str) -> str:
    """Quality log rows of one source."""
    tests = [
        *[(f"not_null:{c}", f"count(*) FILTER ({c} IS NULL)", "|| ' nulls / ' || row_count || ' rows'")
          for c in ("trade_date", "code", "close", "volume")],
        ("close_positive", "count(*) FILTER (close <= 0)", "|| ' records with close<=0'"),
        ("high_gte_low", "count(*) FILTER (high < low)", "|| ' records where high < low'"),
        ("no_duplicates", f"count(*) - (SELECT count(*) FROM (SELECT DISTINCT trade_date, code FROM {source}))",
         "|| ' duplicate (trade_date, code) combinations'"),
        ("volume_non_negative", "count(*) FILTER (volume < 0)", "|| ' records with volume<0'"),
    ]
    rows = [
        f"""SELECT TIMESTAMP '{stamp}' AS checked_at, '{table}' AS table_name, '{name}' AS check_name,
                   failed_count = 0 AS passed, failed_count {text} AS detail, row_count, failed_count, {i} AS pos
            FROM (SELECT count(*) AS row_count, {count} AS failed_count FROM {source})"""
        for i, (name, count, text) in enumerate(tests)
    ]
    return " UNION ALL ".join(rows)


LOG = f"""
    SELECT * FROM ({checks('spoilt', 'bronze_renamed', '2000-06-30 07:00:00')})
    UNION ALL SELECT * FROM ({checks('silver', 'silver_quotes', '2000-06-29 07:00:00')})
    UNION ALL SELECT * FROM ({checks('silver', 'silver_quotes', '2000-06-27 07:00:00')})"""
CHECK_COLUMNS = "checked_at, table_name, check_name, passed, detail, row_count, failed_count"

def merged(columns: list[str]) -> str:
    """Update-or-insert spelled as a full outer join."""
    picked = ", ".join(f'CASE WHEN b."Code" IS NOT NULL THEN b."{c}" ELSE l."{c}" END AS "{c}"' for c in columns)
    return f"""SELECT {picked} FROM loaded l FULL OUTER JOIN batch b
               ON l."Date" = b."Date" AND l."Code" = b."Code" """


BRONZE_COLUMNS = (
    "Date Code Open High Low Close Volume TurnoverValue AdjustmentFactor AdjustmentOpen AdjustmentHigh "
    "AdjustmentLow AdjustmentClose AdjustmentVolume"
).split()
LISTING_COLUMNS = (
    "Date Code CompanyName CompanyNameEnglish Sector17Code Sector17CodeName Sector33Code Sector33CodeName "
    "ScaleCategory MarketCode MarketCodeName"
).split()

QUERIES = {
    "bronze_quotes": "SELECT *, '2000-07-01' AS _ingestion_date FROM bronze",
    "bronze_listing": "SELECT *, '2000-07-01' AS _ingestion_date FROM snapshots",
    "load_month_ranges": """
        SELECT CAST(greatest(month, a) AS DATE) AS date_from, CAST(least(last_day(month), b) AS DATE) AS date_to,
               strftime(greatest(month, a), '%Y%m%d') AS request_from,
               strftime(least(last_day(month), b), '%Y%m%d') AS request_to
        FROM (SELECT a, b, CAST(unnest(generate_series(date_trunc('month', a), b, INTERVAL 1 MONTH)) AS DATE) AS month
              FROM (SELECT min(td) AS a, max(td) AS b FROM bars))""",
    "load_increment": f"""
        SELECT date_from, date_to, date_from > date_to AS up_to_date,
               strftime(date_from, '%Y%m%d') AS request_from, strftime(date_to, '%Y%m%d') AS request_to
        FROM (SELECT CAST("Date" AS DATE) + 1 AS date_from, {AS_OF} + 29 AS date_to
              FROM (SELECT max("Date") AS "Date" FROM loaded))""",
    "high_water_mark": 'SELECT max("Date") AS max_date FROM bronze',
    "silver_quotes": "SELECT * FROM silver",
    "silver_quotes_range": "SELECT * FROM silver WHERE trade_date BETWEEN DATE '1999-07-01' AND DATE '2000-06-30'",
    "silver_listing": "SELECT * FROM master",
    "upsert_quotes": merged(BRONZE_COLUMNS),
    "upsert_silver": """
        WITH l AS (SELECT * FROM silver WHERE trade_date <= DATE '2000-06-30'),
        b AS (SELECT * REPLACE (CASE WHEN trade_date <= DATE '2000-06-30' THEN close + 1 ELSE close END AS close)
              FROM renamed WHERE trade_date >= DATE '2000-06-01'),
        ok AS (SELECT * FROM b WHERE close > 0 AND volume >= 0)
        SELECT * FROM ok UNION ALL
        SELECT * FROM l WHERE (trade_date, code) NOT IN (SELECT (trade_date, code) FROM ok)""",
    "upsert_listing": """
        SELECT * FROM old_listing WHERE ("ScaleCategory" = 'Large' OR "MarketCode" = '0')
          AND "Code" NOT IN (SELECT "Code" FROM listing WHERE "MarketCode" <> '0')
        UNION ALL SELECT * FROM listing WHERE "MarketCode" <> '0'""",
    "moving_averages": f"SELECT trade_date, code, {rounded(['ma5', 'ma25', 'ma75'])} FROM steps",
    "returns": f"SELECT trade_date, code, {rounded(['return_1d', 'return_5d', 'return_21d'])} FROM steps",
    "volatility": f"SELECT trade_date, code, {rounded(['volatility_20d'])} FROM metrics",
    "volume_average": f"SELECT trade_date, code, {rounded(['volume_ma5'])} FROM steps",
    "yearly_range": f"""SELECT trade_date, code, high_52w, low_52w,
        {rounded(['dist_from_high_52w', 'dist_from_low_52w'])} FROM metrics""",
    "stock_metrics": f"SELECT {PRICES}, {rounded(METRIC_COLUMNS)} FROM metrics",
    "metrics_refresh": f"""SELECT {PRICES}, {rounded(METRIC_COLUMNS)} FROM metrics
        WHERE trade_date >= (SELECT min(trade_date) FROM silver s
                             WHERE s.code = metrics.code AND s.trade_date >= {AS_OF})""",
    "stock_with_unlisted": f"""SELECT {PRICES}, {rounded(METRIC_COLUMNS)}, {', '.join(
        f"CASE WHEN scale_category = 'Large' THEN {c.strip()} END AS {c.strip()}" for c in ATTRIBUTES.split(','))} FROM stocks""",
    "stock_with_master": f"SELECT {PRICES}, {rounded(METRIC_COLUMNS)}, {ATTRIBUTES} FROM stocks",
    "sector_summary": f"""SELECT trade_date, sector17_name, stock_count, round(total_turnover, 2) AS total_turnover,
        {rounded(['avg_return_1d', 'avg_return_5d', 'avg_volatility'], 6)} FROM sectors""",
    "quality_checks": f"SELECT {CHECK_COLUMNS} FROM ({checks('silver', 'silver_quotes', '2000-06-30 07:00:00')})",
    "quality_checks_failing": f"SELECT {CHECK_COLUMNS} FROM ({checks('spoilt', 'bronze_renamed', '2000-06-30 07:00:00')})",
    "quality_report": f"""
        SELECT table_name, bool_and(passed) AS passed,
               '=== DQ Report [' || table_name || ']: '
               || CASE WHEN bool_and(passed) THEN 'PASSED' ELSE 'FAILED' END || ' ===' || chr(10)
               || string_agg('  ' || CASE WHEN passed THEN '✅' ELSE '❌' END || ' ' || check_name || ': ' || detail,
                             chr(10) ORDER BY pos) AS summary
        FROM ({checks('spoilt', 'bronze_renamed', '2000-06-30 07:00:00')}) GROUP BY table_name""",
    "quality_summary": f"""
        SELECT table_name, check_name, CASE WHEN passed THEN '✅ PASS' ELSE '❌ FAIL' END AS status, detail, checked_at
        FROM ({LOG}) WHERE checked_at BETWEEN {AS_OF} - 1 AND {AS_OF} + INTERVAL '23:59:59.999999'""",
    "newest_quality_rows": f"""
        SELECT {CHECK_COLUMNS} FROM ({LOG}) ORDER BY checked_at DESC, table_name, check_name LIMIT 20""",
    "daily_ingest_counts": """
        SELECT "Date" AS trade_date, count(*) AS record_count, count(DISTINCT "Code") AS stock_count
        FROM bronze GROUP BY "Date" ORDER BY "Date" DESC LIMIT 30""",
    "bronze_stats": """
        SELECT max("Date") AS last_loaded_date, count(DISTINCT "Date") AS loaded_days,
               count(DISTINCT "Code") AS stock_count, count(*) AS total_records FROM bronze""",
    "silver_stats": """
        SELECT max(trade_date) AS last_date, count(DISTINCT trade_date) AS trading_days,
               count(DISTINCT code) AS stock_count, count(*) AS total_records FROM silver""",
    "calendar_gaps": f"""
        SELECT cal_date, CASE WHEN dayofweek(cal_date) IN (0, 6) THEN 'Weekend'
                              WHEN td IS NULL THEN '⚠️ Missing (possible holiday)' ELSE 'OK' END AS status
        FROM (SELECT CAST(unnest(generate_series({AS_OF} - 45, {AS_OF} - 1, INTERVAL 1 DAY)) AS DATE) AS cal_date)
        LEFT JOIN (SELECT DISTINCT td FROM bars) ON cal_date = td""",
    # Reaches past the last loaded day, so weekdays are missing.
    "calendar_gaps_at_end": """
        SELECT cal_date, CASE WHEN dayofweek(cal_date) IN (0, 6) THEN 'Weekend'
                              WHEN td IS NULL THEN '⚠️ Missing (possible holiday)' ELSE 'OK' END AS status
        FROM (SELECT CAST(unnest(generate_series(DATE '2001-11-25' - 45, DATE '2001-11-25' - 1, INTERVAL 1 DAY)) AS DATE)
                     AS cal_date)
        LEFT JOIN (SELECT DISTINCT td FROM bars) ON cal_date = td""",
    "top_turnover": f"""
        SELECT trade_date, code, company_name, sector17_name, close,
               {rounded(['return_1d', 'return_5d', 'ma5', 'ma25', 'volatility_20d'])}
        FROM latest ORDER BY turnover_value DESC, code LIMIT 30""",
    "ma_deviation_movers": f"""
        SELECT code, company_name, sector17_name, close, round((close / nullif(ma25, 0) - 1) * 100, 2) AS pct_above_ma25,
               volume, {rounded(['ma25', 'return_1d', 'return_5d', 'volatility_20d'])}
        FROM latest ORDER BY abs(return_1d) DESC NULLS LAST, code LIMIT 50""",
    "top_turnover_3": f"""
        SELECT trade_date, code, company_name, sector17_name, close,
               {rounded(['return_1d', 'return_5d', 'ma5', 'ma25', 'volatility_20d'])}
        FROM latest ORDER BY turnover_value DESC, code LIMIT 3""",
    "ma_deviation_movers_3": f"""
        SELECT code, company_name, sector17_name, close, round((close / nullif(ma25, 0) - 1) * 100, 2) AS pct_above_ma25,
               volume, {rounded(['ma25', 'return_1d', 'return_5d', 'volatility_20d'])}
        FROM latest ORDER BY abs(return_1d) DESC NULLS LAST, code LIMIT 3""",
    "volatility_vs_return_3": """
        SELECT code, company_name, sector17_name, round(return_5d, 2) AS return_5d,
               round(volatility_20d, 2) AS volatility_20d, round(turnover_value / 1e6, 1) AS turnover_m_jpy
        FROM latest WHERE return_5d IS NOT NULL AND volatility_20d IS NOT NULL
          AND turnover_value > 1 ORDER BY turnover_value DESC, code LIMIT 3""",
    "metrics_between": f"""SELECT {PRICES}, {rounded(METRIC_COLUMNS)} FROM metrics
        WHERE trade_date BETWEEN DATE '1999-07-01' AND {AS_OF}""",
    "sector_recent": """
        SELECT sector17_name, round(avg(avg_return_1d), 3) AS avg_daily_return,
               round(avg(avg_return_5d), 3) AS avg_5d_return,
               round(sum(total_turnover) / 1e9, 1) AS total_turnover_b_jpy,
               round(avg(avg_volatility), 3) AS avg_volatility
        FROM sectors WHERE trade_date >= (SELECT max(trade_date) FROM sectors) - 7 GROUP BY sector17_name""",
    "gainers_losers": f"""
        SELECT rank_type, code, company_name, close, volume, {rounded(['return_1d'])} FROM (
          (SELECT 'TOP' AS rank_type, * FROM latest WHERE return_1d IS NOT NULL
           ORDER BY return_1d DESC, code LIMIT 10)
          UNION ALL
          (SELECT 'BOTTOM' AS rank_type, * FROM latest WHERE return_1d IS NOT NULL
           ORDER BY return_1d ASC, code LIMIT 10))""",
    "market_kpis": """
        SELECT max(trade_date) AS latest_date, count(DISTINCT code) AS total_stocks,
               round(avg(return_1d), 3) AS market_avg_return_1d,
               count(CASE WHEN return_1d > 0 THEN 1 END) AS advancing_stocks,
               count(CASE WHEN return_1d < 0 THEN 1 END) AS declining_stocks,
               round(sum(turnover_value) / 1e12, 2) AS total_turnover_t_jpy
        FROM latest""",
    "market_kpis_on_day": f"""
        SELECT max(trade_date) AS latest_date, count(DISTINCT code) AS total_stocks,
               round(avg(return_1d), 3) AS market_avg_return_1d,
               count(CASE WHEN return_1d > 0 THEN 1 END) AS advancing_stocks,
               count(CASE WHEN return_1d < 0 THEN 1 END) AS declining_stocks,
               round(sum(turnover_value) / 1e12, 2) AS total_turnover_t_jpy
        FROM stocks WHERE trade_date = {AS_OF}""",
    "sector_latest": """
        SELECT sector17_name, round(avg_return_1d, 3) AS return_1d, round(avg_return_5d, 3) AS return_5d,
               round(total_turnover / 1e9, 1) AS turnover_b_jpy
        FROM sectors WHERE trade_date = (SELECT max(trade_date) FROM sectors)""",
    "stock_series": f"""
        SELECT trade_date, code, company_name, close, volume, {rounded(['ma5', 'ma25', 'ma75'])}
        FROM stocks WHERE code = '0' AND trade_date BETWEEN {AS_OF} - 365 AND {AS_OF}""",
    "return_ranking": """
        SELECT row_number() OVER (ORDER BY return_1d DESC, code) AS rank, code, company_name, sector17_name,
               round(close, 0) AS close, round(return_1d, 2) AS return_1d_pct, round(volume / 1e6, 1) AS volume_m,
               round(volatility_20d, 2) AS volatility_20d
        FROM latest WHERE return_1d IS NOT NULL ORDER BY return_1d DESC, code LIMIT 20""",
    "volatility_vs_return": f"""
        SELECT code, company_name, sector17_name, round(return_5d, 2) AS return_5d,
               round(volatility_20d, 2) AS volatility_20d, round(turnover_value / 1e6, 1) AS turnover_m_jpy
        FROM stocks WHERE trade_date = {AS_OF} AND return_5d IS NOT NULL AND volatility_20d IS NOT NULL
          AND turnover_value > 1e6 ORDER BY turnover_value DESC, code LIMIT 500""",
    "market_turnover": f"""
        SELECT trade_date, market_name, round(sum(turnover_value) / 1e12, 3) AS total_turnover_t_jpy
        FROM stocks WHERE trade_date BETWEEN {AS_OF} - 90 AND {AS_OF} GROUP BY trade_date, market_name""",
    "curated_view": f"""
        SELECT trade_date, code, company_name, sector17_name AS sector, market_name AS market, scale_category,
               close, open, high, low, volume, turnover_value, {rounded(METRIC_COLUMNS)}
        FROM stocks WHERE trade_date BETWEEN {AS_OF} - 730 AND {AS_OF}""",
}


# Further ways to the same results: stored tables, merged counts, SQL functions.
QUERIES |= {
    "quality_checks_broken": f"SELECT {CHECK_COLUMNS} FROM ({checks('broken', 'bronze_renamed', '2000-06-30 07:00:00')})",
    "quality_of_profile": f"SELECT {CHECK_COLUMNS} FROM ({checks('broken', 'bronze_renamed', '2000-06-30 07:00:00')})",
    "quality_checks_range": f"SELECT {CHECK_COLUMNS} FROM ({checks('broken_range', 'bronze_renamed', '2000-06-30 07:00:00')})",
    "ingest_counts_merged": QUERIES["daily_ingest_counts"],
    "bronze_stats_merged": QUERIES["bronze_stats"],
    "landed_arrays": QUERIES["bronze_quotes"],
    "stored_quotes": QUERIES["upsert_silver"],
    "stored_listing": QUERIES["upsert_listing"],
    "stored_quality_log": QUERIES["quality_summary"],
    "sql_return_ranking": QUERIES["return_ranking"],
    "sql_top_turnover": QUERIES["top_turnover_3"],
    "sql_gainers_losers": QUERIES["gainers_losers"],
    "sql_market_kpis": QUERIES["market_kpis_on_day"],
    "sql_stock_series": QUERIES["stock_series"],
    "sql_sector_recent": QUERIES["sector_recent"],
}


def statement(body: str) -> str:
    """The query with every table expression in front; unused ones cost nothing."""
    ctes = ",\n".join(f"{name} AS ({sql})" for name, sql in CTES.items())
    body = body.strip()
    if body.startswith("WITH "):
        return f"WITH {ctes},\n{body[len('WITH '):]}"
    return f"WITH {ctes}\n{body}"


def all_statements() -> dict[str, str]:
    return {name: statement(sql) for name, sql in QUERIES.items()}
