"""The reports as SQL table functions.

``register_reports`` lets SQL users write ``SELECT * FROM return_ranking(20)`` or
``stock_series(code => '1301', as_of => DATE '2024-06-28')``. Spark expands such a
function into the query around it, so filters and the chosen day prune the stored
tables as in a hand-written query. Arguments are values, never text of the query.
Without ``as_of`` a report is about the newest day of its table.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from quotewright.plans.reports import BOTTOM, MIN_TURNOVER, TOP
from quotewright.sources.catalog import TableNames

# name -> (parameters, returned columns, which table, body). ``top`` limits by rank, as LIMIT
# takes no parameter; Spark sorts for the first ranks only.
_FUNCTIONS = {
    "return_ranking": (
        "top INT DEFAULT 20, as_of DATE DEFAULT NULL",
        "rank BIGINT, code STRING, company_name STRING, sector17_name STRING, close DOUBLE, return_1d_pct DOUBLE, volume_m DOUBLE, volatility_20d DOUBLE",
        "stocks",
        """SELECT CAST(place AS BIGINT), code, company_name, sector17_name, round(close, 0), round(return_1d, 2),
                  round(volume / 1e6D, 1), round(volatility_20d, 2)
           FROM (SELECT *, row_number() OVER (ORDER BY return_1d DESC NULLS LAST, code) AS place FROM {table}
                 WHERE {day} AND return_1d IS NOT NULL)
           WHERE place <= top""",
    ),
    "top_turnover": (
        "top INT DEFAULT 30, as_of DATE DEFAULT NULL",
        "trade_date DATE, code STRING, company_name STRING, sector17_name STRING, close DOUBLE, return_1d DOUBLE, return_5d DOUBLE, ma5 DOUBLE, ma25 DOUBLE, volatility_20d DOUBLE",
        "stocks",
        """SELECT trade_date, code, company_name, sector17_name, close, return_1d, return_5d, ma5, ma25, volatility_20d
           FROM (SELECT *, row_number() OVER (ORDER BY turnover_value DESC NULLS LAST, code) AS place FROM {table} WHERE {day})
           WHERE place <= top""",
    ),
    "ma_deviation_movers": (
        "top INT DEFAULT 50, as_of DATE DEFAULT NULL",
        "code STRING, company_name STRING, sector17_name STRING, close DOUBLE, ma25 DOUBLE, pct_above_ma25 DOUBLE, return_1d DOUBLE, return_5d DOUBLE, volatility_20d DOUBLE, volume DOUBLE",
        "stocks",
        """SELECT code, company_name, sector17_name, close, ma25, round((try_divide(close, ma25) - 1) * 100, 2), return_1d, return_5d,
                  volatility_20d, volume
           FROM (SELECT *, row_number() OVER (ORDER BY abs(return_1d) DESC NULLS LAST, code) AS place FROM {table} WHERE {day})
           WHERE place <= top""",
    ),
    "gainers_losers": (
        "top INT DEFAULT 10, as_of DATE DEFAULT NULL",
        "rank_type STRING, code STRING, company_name STRING, close DOUBLE, return_1d DOUBLE, volume DOUBLE",
        "stocks",
        f"""SELECT '{TOP}', code, company_name, close, return_1d, volume
           FROM (SELECT *, row_number() OVER (ORDER BY return_1d DESC, code) AS place FROM {{table}} WHERE {{day}} AND return_1d IS NOT NULL)
           WHERE place <= top
           UNION ALL
           SELECT '{BOTTOM}', code, company_name, close, return_1d, volume
           FROM (SELECT *, row_number() OVER (ORDER BY return_1d, code) AS place FROM {{table}} WHERE {{day}} AND return_1d IS NOT NULL)
           WHERE place <= top""",
    ),
    "volatility_vs_return": (
        f"min_turnover DOUBLE DEFAULT {MIN_TURNOVER:.0f}D, top INT DEFAULT 500, as_of DATE DEFAULT NULL",
        "code STRING, company_name STRING, sector17_name STRING, return_5d DOUBLE, volatility_20d DOUBLE, turnover_m_jpy DOUBLE",
        "stocks",
        """SELECT code, company_name, sector17_name, round(return_5d, 2), round(volatility_20d, 2), round(turnover_value / 1e6D, 1)
           FROM (SELECT *, row_number() OVER (ORDER BY turnover_value DESC, code) AS place FROM {table}
                 WHERE {day} AND return_5d IS NOT NULL AND volatility_20d IS NOT NULL AND turnover_value > min_turnover)
           WHERE place <= top""",
    ),
    "market_kpis": (
        "as_of DATE DEFAULT NULL",
        "latest_date DATE, total_stocks BIGINT, market_avg_return_1d DOUBLE, advancing_stocks BIGINT, declining_stocks BIGINT, total_turnover_t_jpy DOUBLE",
        "stocks",
        """SELECT max(trade_date), count(DISTINCT code), round(avg(return_1d), 3), count_if(return_1d > 0), count_if(return_1d < 0),
                  round(sum(turnover_value) / 1e12D, 2)
           FROM {table} WHERE {day}""",
    ),
    "stock_series": (
        "stock STRING, as_of DATE DEFAULT NULL, days INT DEFAULT 365",
        "trade_date DATE, code STRING, company_name STRING, close DOUBLE, ma5 DOUBLE, ma25 DOUBLE, ma75 DOUBLE, volume DOUBLE",
        "stocks",
        """SELECT trade_date, code, company_name, close, ma5, ma25, ma75, volume FROM {table} WHERE code = stock AND {since}""",
    ),
    "market_turnover": (
        "as_of DATE DEFAULT NULL, days INT DEFAULT 90",
        "trade_date DATE, market_name STRING, total_turnover_t_jpy DOUBLE",
        "stocks",
        """SELECT trade_date, market_name, round(sum(turnover_value) / 1e12D, 3) FROM {table} WHERE {since} GROUP BY trade_date, market_name""",
    ),
    "curated_stocks": (
        "as_of DATE DEFAULT NULL, days INT DEFAULT 730",
        "trade_date DATE, code STRING, company_name STRING, sector STRING, market STRING, scale_category STRING, close DOUBLE, open DOUBLE, high DOUBLE, low DOUBLE, volume DOUBLE, turnover_value DOUBLE, ma5 DOUBLE, ma25 DOUBLE, ma75 DOUBLE, return_1d DOUBLE, return_5d DOUBLE, return_21d DOUBLE, volatility_20d DOUBLE, high_52w DOUBLE, low_52w DOUBLE, dist_from_high_52w DOUBLE, dist_from_low_52w DOUBLE, volume_ma5 DOUBLE",
        "stocks",
        """SELECT trade_date, code, company_name, sector17_name, market_name, scale_category, close, open, high, low, volume, turnover_value,
                  ma5, ma25, ma75, return_1d, return_5d, return_21d, volatility_20d, high_52w, low_52w, dist_from_high_52w, dist_from_low_52w, volume_ma5
           FROM {table} WHERE {since}""",
    ),
    "sector_latest": (
        "as_of DATE DEFAULT NULL",
        "sector17_name STRING, return_1d DOUBLE, return_5d DOUBLE, turnover_b_jpy DOUBLE",
        "sectors",
        """SELECT sector17_name, round(avg_return_1d, 3), round(avg_return_5d, 3), round(total_turnover / 1e9D, 1) FROM {table} WHERE {day}""",
    ),
    "sector_recent": (
        "as_of DATE DEFAULT NULL, days INT DEFAULT 7",
        "sector17_name STRING, avg_daily_return DOUBLE, avg_5d_return DOUBLE, total_turnover_b_jpy DOUBLE, avg_volatility DOUBLE",
        "sectors",
        """SELECT sector17_name, round(avg(avg_return_1d), 3), round(avg(avg_return_5d), 3), round(sum(total_turnover) / 1e9D, 1), round(avg(avg_volatility), 3)
           FROM {table} WHERE {since} GROUP BY sector17_name""",
    ),
}
NAMES = tuple(_FUNCTIONS)


def register_reports(spark: SparkSession, names: TableNames = TableNames(), prefix: str = "", temporary: bool = False) -> list[str]:
    """Create the functions; returns their names.

    They are kept in the current schema, from which SQL calls them without a schema's name, or
    only for this session if ``temporary``. A temporary function may also stand on temporary views.
    """
    for name, (parameters, columns, kind, body) in _FUNCTIONS.items():
        table = getattr(names, kind)
        newest = f"coalesce(as_of, (SELECT max(trade_date) FROM {table}))"
        since = f"trade_date >= date_add({newest}, -days) AND trade_date <= {newest}"
        text = body.format(table=table, day=f"trade_date = {newest}", since=since)
        scope = "TEMPORARY " if temporary else ""
        spark.sql(f"CREATE OR REPLACE {scope}FUNCTION {prefix}{name}({parameters}) RETURNS TABLE({columns}) RETURN {text}")
    return [f"{prefix}{name}" for name in _FUNCTIONS]
