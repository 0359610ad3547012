"""Monitoring and dashboard reports.

Every report takes the table it reads and returns a sorted DataFrame. Reports
about "the latest day" compare the date with a scalar subquery, which Spark
turns into a partition filter on a date-partitioned table. Ties in a ranking go
to the smaller code.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotewright.functions import percent_change
from quotewright.operators.calendar import day

# Labels and default sizes of the reports.
TOP, BOTTOM = "TOP", "BOTTOM"
PASS, FAIL = "✅ PASS", "❌ FAIL"
TRILLION, BILLION, MILLION = 1e12, 1e9, 1e6
MIN_TURNOVER = 1e8


def on_day(df: DataFrame, as_of: date | str | None = None, column: str = "trade_date") -> DataFrame:
    """Rows of the given day, by default of the table's newest one."""
    newest = df.agg(F.max(column)).scalar() if as_of is None else day(as_of)
    return df.filter(F.col(column) == newest)


def _down(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).desc_nulls_last()


def _window(column: str, as_of: date | str | None, days: int) -> Column:
    """From ``days`` before ``as_of`` to its end; works for dates and timestamps."""
    last = day(as_of)
    return (F.col(column) >= F.date_add(last, -days)) & (F.col(column) < F.date_add(last, 1))


# -- loads ---------------------------------------------------------------


def daily_ingest_counts(bronze: DataFrame, days: int = 30) -> DataFrame:
    """Records and distinct codes of the newest loaded days.

    The newest days are found first from the date column alone; the distinct
    count then exchanges codes of those days only, not of the whole history.
    """
    newest = bronze.select("Date").distinct().orderBy(_down("Date")).limit(days)
    oldest_shown = newest.agg(F.min("Date")).scalar()
    return (
        bronze.filter(F.col("Date") >= oldest_shown)
        .groupBy(F.col("Date").alias("trade_date"))
        .agg(F.count(F.lit(1)).alias("record_count"), F.countDistinct("Code").alias("stock_count"))
        .orderBy(_down("trade_date"))
        .limit(days)
    )


def bronze_stats(bronze: DataFrame) -> DataFrame:
    """Newest day, loaded days, codes and records of the raw table.

    Days and codes are reduced apart. As distinct counts of one aggregate they would expand
    every row, and the newest of the days, which are text, would have all of these sorted.
    """
    by_day = bronze.groupBy("Date").agg(F.count(F.lit(1)).alias("records"))
    codes = bronze.select("Code").distinct().agg(F.count("Code").alias("n"))
    totals = by_day.agg(
        F.max("Date").alias("last_loaded_date"),
        F.count("Date").alias("loaded_days"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"),
    )
    return totals.select("last_loaded_date", "loaded_days", F.coalesce(codes.scalar(), F.lit(0)).alias("stock_count"), "total_records")


def silver_stats(quotes: DataFrame) -> DataFrame:
    """The same figures for the cleansed table."""
    return quotes.agg(
        F.max("trade_date").alias("last_date"),
        F.countDistinct("trade_date").alias("trading_days"),
        F.countDistinct("code").alias("stock_count"),
        F.count(F.lit(1)).alias("total_records"),
    )


# -- quality log ---------------------------------------------------------


def quality_summary(quality_log: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Check results logged since the day before ``as_of``."""
    return (
        quality_log.filter(_window("checked_at", as_of, 1))
        .select(
            "table_name",
            "check_name",
            F.when(F.col("passed"), PASS).otherwise(FAIL).alias("status"),
            "detail",
            "checked_at",
        )
        .orderBy(_down("checked_at"), "table_name", "check_name")
    )


def newest_quality_rows(quality_log: DataFrame, rows: int = 20) -> DataFrame:
    return quality_log.orderBy(_down("checked_at"), "table_name", "check_name").limit(rows)


# -- stocks --------------------------------------------------------------


def top_turnover(stocks: DataFrame, rows: int = 30, as_of: date | str | None = None) -> DataFrame:
    """Main indicators of the most traded instruments of the latest day."""
    return (
        on_day(stocks, as_of)
        .orderBy(_down("turnover_value"), "code")
        .limit(rows)
        .select(
            "trade_date", "code", "company_name", "sector17_name", "close",
            "return_1d", "return_5d", "ma5", "ma25", "volatility_20d",
        )
    )


def ma_deviation_movers(stocks: DataFrame, rows: int = 50, as_of: date | str | None = None) -> DataFrame:
    """Largest one-day movers with their distance from the 25-row average."""
    deviation = F.round(percent_change("close", "ma25"), 2).alias("pct_above_ma25")
    return (
        on_day(stocks, as_of)
        .orderBy(_down(F.abs("return_1d")), "code")
        .limit(rows)
        .select(
            "code", "company_name", "sector17_name", "close", "ma25", deviation,
            "return_1d", "return_5d", "volatility_20d", "volume",
        )
    )


def gainers_losers(stocks: DataFrame, rows: int = 10, as_of: date | str | None = None) -> DataFrame:
    """Best and worst one-day returns of the latest day, labelled."""
    moved = on_day(stocks, as_of).filter(F.col("return_1d").isNotNull())

    def branch(label: str, order: Column) -> DataFrame:
        picked = moved.orderBy(order, "code").limit(rows)
        return picked.select(
            F.lit(label).alias("rank_type"), "code", "company_name", "close", "return_1d", "volume"
        )

    return branch(TOP, _down("return_1d")).unionByName(branch(BOTTOM, F.col("return_1d").asc_nulls_last()))


def market_kpis(stocks: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """One row of market-wide figures for the latest day."""
    return on_day(stocks, as_of).agg(
        F.max("trade_date").alias("latest_date"),
        F.countDistinct("code").alias("total_stocks"),
        F.round(F.avg("return_1d"), 3).alias("market_avg_return_1d"),
        F.count_if(F.col("return_1d") > 0).alias("advancing_stocks"),
        F.count_if(F.col("return_1d") < 0).alias("declining_stocks"),
        F.round(F.sum("turnover_value") / TRILLION, 2).alias("total_turnover_t_jpy"),
    )


def stock_series(
    stocks: DataFrame, code: str, as_of: date | str | None = None, days: int = 365
) -> DataFrame:
    """One instrument's price and averages over the last year."""
    return (
        stocks.filter((F.col("code") == F.lit(code)) & _window("trade_date", as_of, days))
        .select("trade_date", "code", "company_name", "close", "ma5", "ma25", "ma75", "volume")
        .orderBy("trade_date")
    )


def return_ranking(stocks: DataFrame, rows: int = 20, as_of: date | str | None = None) -> DataFrame:
    """Numbered list of the best one-day returns.

    The limit comes before the numbering, so the single-task window sees only
    ``rows`` rows.
    """
    best = on_day(stocks, as_of).filter(F.col("return_1d").isNotNull())
    best = best.orderBy(_down("return_1d"), "code").limit(rows)
    rank = F.row_number().over(Window.orderBy(_down("return_1d"), "code")).cast("long")
    return best.select(
        rank.alias("rank"),
        "code",
        "company_name",
        "sector17_name",
        F.round("close", 0).alias("close"),
        F.round("return_1d", 2).alias("return_1d_pct"),
        F.round(F.col("volume") / MILLION, 1).alias("volume_m"),
        F.round("volatility_20d", 2).alias("volatility_20d"),
    ).orderBy("rank")


def volatility_vs_return(
    stocks: DataFrame,
    rows: int = 500,
    min_turnover: float = MIN_TURNOVER,
    as_of: date | str | None = None,
) -> DataFrame:
    """Five-row return against volatility for actively traded instruments."""
    return (
        on_day(stocks, as_of)
        .filter(F.col("return_5d").isNotNull() & F.col("volatility_20d").isNotNull())
        .filter(F.col("turnover_value") > min_turnover)
        .orderBy(_down("turnover_value"), "code")
        .limit(rows)
        .select(
            "code",
            "company_name",
            "sector17_name",
            F.round("return_5d", 2).alias("return_5d"),
            F.round("volatility_20d", 2).alias("volatility_20d"),
            F.round(F.col("turnover_value") / MILLION, 1).alias("turnover_m_jpy"),
        )
    )


def market_turnover(stocks: DataFrame, as_of: date | str | None = None, days: int = 90) -> DataFrame:
    """Turnover per day and market over the last quarter."""
    return (
        stocks.filter(_window("trade_date", as_of, days))
        .groupBy("trade_date", "market_name")
        .agg(F.round(F.sum("turnover_value") / TRILLION, 3).alias("total_turnover_t_jpy"))
        .orderBy("trade_date", F.col("market_name").asc_nulls_last())
    )


def curated_view(stocks: DataFrame, as_of: date | str | None = None, days: int = 730) -> DataFrame:
    """Two years of the joined table under business names, one column each."""
    renamed = {"sector17_name": "sector", "market_name": "market"}
    columns = (
        "trade_date", "code", "company_name", "sector17_name", "market_name", "scale_category",
        "close", "open", "high", "low", "volume", "turnover_value", "ma5", "ma25", "ma75",
        "return_1d", "return_5d", "return_21d", "volatility_20d", "high_52w", "low_52w",
        "dist_from_high_52w", "dist_from_low_52w", "volume_ma5",
    )
    return stocks.filter(_window("trade_date", as_of, days)).select(
        *[F.col(c).alias(renamed.get(c, c)) for c in columns]
    )


def register_curated_view(
    spark: SparkSession, stocks: DataFrame, name: str = "curated_stocks", as_of: date | str | None = None
) -> None:
    """Expose the curated columns to SQL users of this session."""
    curated_view(stocks, as_of).createOrReplaceTempView(name)


# -- sectors -------------------------------------------------------------


def sector_latest(sectors: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Sector returns and turnover of the latest day."""
    return (
        on_day(sectors, as_of)
        .select(
            "sector17_name",
            F.round("avg_return_1d", 3).alias("return_1d"),
            F.round("avg_return_5d", 3).alias("return_5d"),
            F.round(F.col("total_turnover") / BILLION, 1).alias("turnover_b_jpy"),
        )
        .orderBy(_down("return_1d"), "sector17_name")
    )


def sector_recent(sectors: DataFrame, days: int = 7, as_of: date | str | None = None) -> DataFrame:
    """Mean of the daily sector figures over the last calendar days.

    Deliberately an average of daily averages: each day weighs the same
    whatever the number of instruments traded.
    """
    newest = sectors.agg(F.max("trade_date")).scalar() if as_of is None else day(as_of)
    return (
        sectors.filter(F.col("trade_date") >= F.date_add(newest, -days))
        .groupBy("sector17_name")
        .agg(
            F.round(F.avg("avg_return_1d"), 3).alias("avg_daily_return"),
            F.round(F.avg("avg_return_5d"), 3).alias("avg_5d_return"),
            F.round(F.sum("total_turnover") / BILLION, 1).alias("total_turnover_b_jpy"),
            F.round(F.avg("avg_volatility"), 3).alias("avg_volatility"),
        )
        .orderBy(_down("avg_daily_return"), "sector17_name")
    )
