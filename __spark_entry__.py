"""

The queries run the library's operators on quotes derived from the line items
and a listing derived from the suppliers. Floating-point results are rounded
here, and only here, because engines add doubles in different orders.
"""

from __future__ import annotations

import sys
import uuid
from collections.abc import Callable
from importlib.util import find_spec
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

import oracles  # noqa: E402
from quotewright.operators import (  # noqa: E402
    MetricWindows,
    attach_master,
    latest_per_key,
    listing_to_silver,
    quotes_to_silver,
    sector_summary,
    stock_metrics,
)
from quotewright.operators import calendar, distinct, quality  # noqa: E402
from quotewright.operators.cleanse import between_dates  # noqa: E402
from quotewright.operators.incremental import refreshed_metrics  # noqa: E402
from quotewright.operators.ranges import metrics_between, metrics_of_days, newest_day  # noqa: E402
from quotewright.plans import reports, sqlfunctions  # noqa: E402
from quotewright.schemas import LISTING_RECORD, QUOTE_KEY, QUOTE_RECORD, SILVER_KEY, SILVER_QUOTE_FIELDS  # noqa: E402
from quotewright.sinks import append_rows, compact, merge_rows, overwrite_table, upsert  # noqa: E402
from quotewright.sinks.tables import scratch_dir  # noqa: E402
from quotewright.sources import derived  # noqa: E402
from quotewright.sources.landing import SOURCE_FILE, quotes_from_text, read_array, split_records, with_audit  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = "2000-06-30"
BATCH_FROM = "2000-06-01"
INGESTED = "2000-07-01"
METRICS = MetricWindows().columns


# -- shared inputs -------------------------------------------------------


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derived.quote_records(spark, sf_dir)


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quotes_to_silver(_bronze(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock_metrics(_silver(spark, sf_dir))


def _listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return listing_to_silver(derived.listing_snapshots(spark, sf_dir))


def _stocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attach_master(_metrics(spark, sf_dir), _listing(spark, sf_dir))


def _unlisted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars joined with a listing of large companies only: the others keep null attributes."""
    large = _listing(spark, sf_dir).filter(F.col("scale_category") == "Large")
    return _rounded(attach_master(_metrics(spark, sf_dir), large))


def _sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sector_summary(_stocks(spark, sf_dir))


def _rounded(df: DataFrame, columns=METRICS, digits: int | None = None) -> DataFrame:
    """Averages of prices at 8 places, percentages at 6 unless told otherwise.

    Means of two-decimal prices over up to 75 rows have no rounding ties at 8
    places; percentages can be large, so fewer places leave more spare digits.
    """
    places = {c: 8 if c.startswith(("ma", "volume_ma")) else 6 for c in columns if c in df.columns}
    return df.withColumns({c: F.round(c, n if digits is None else digits) for c, n in places.items()})


def _spoilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed but uncleansed quotes, those of the 16th twice."""
    renamed = _bronze(spark, sf_dir).select(
        F.to_date("Date").alias("trade_date"),
        F.col("Code").alias("code"),
        *[F.col(field).alias(name) for name, field in SILVER_QUOTE_FIELDS.items()],
    )
    return renamed.unionByName(renamed.filter(F.dayofmonth("trade_date") == 16))


def _broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes that fail every check: missing days and codes, crossed ranges and negative volumes as well."""
    on = F.dayofmonth("trade_date")
    spoilt = _spoilt(spark, sf_dir)
    return spoilt.select(
        F.when(on != 3, F.col("trade_date")).alias("trade_date"),
        F.when(on != 4, F.col("code")).alias("code"),
        "open",
        F.when(on == 5, F.col("low") - 1).otherwise(F.col("high")).alias("high"),
        "low",
        "close",
        F.when(on == 6, -F.col("volume")).otherwise(F.col("volume")).alias("volume"),
        *spoilt.columns[spoilt.columns.index("volume") + 1 :],
    )


def _batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer quotes and restated closes of the last loaded month."""
    restated = F.when(F.col("Date") <= AS_OF, F.col("AdjustmentClose") + 1).otherwise(F.col("AdjustmentClose"))
    return (
        _bronze(spark, sf_dir).filter(F.col("Date") >= BATCH_FROM).withColumn("AdjustmentClose", restated)
    )


# -- queries -------------------------------------------------------------


def bronze_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes as JSON text, parsed with the declared schema and audited."""
    text = _bronze(spark, sf_dir).select(F.to_json(F.struct(*QUOTE_RECORD.names)).alias("value"))
    accepted, _ = split_records(with_audit(quotes_from_text(text), INGESTED))
    return accepted.drop("_loaded_at")


def bronze_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = derived.listing_snapshots(spark, sf_dir).select(*LISTING_RECORD.names)
    accepted, _ = split_records(with_audit(records, INGESTED), dated=False)
    return accepted.drop("_loaded_at")


def upsert_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _bronze(spark, sf_dir).filter(F.col("Date") <= AS_OF)
    return merge_rows(loaded, latest_per_key(_batch(spark, sf_dir), QUOTE_KEY), QUOTE_KEY)


def upsert_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _silver(spark, sf_dir).filter(F.col("trade_date") <= F.lit(AS_OF).cast("date"))
    return merge_rows(loaded, latest_per_key(quotes_to_silver(_batch(spark, sf_dir)), SILVER_KEY), SILVER_KEY)


def upsert_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older snapshot of large companies and one market, updated by the newer one of the other markets."""
    newer, older = "2000-06-30", "1999-06-30"
    records = derived.listing_snapshots(spark, sf_dir, newer, older)
    loaded = records.filter((F.col("Date") == older) & ((F.col("ScaleCategory") == "Large") | (F.col("MarketCode") == "0")))
    fresh = latest_per_key(records.filter((F.col("Date") == newer) & (F.col("MarketCode") != "0")), ["Code"], ["Date"])
    return merge_rows(loaded, fresh, ["Code"])


def metrics_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = _silver(spark, sf_dir)
    changes = quotes.filter(F.col("trade_date") >= F.lit(AS_OF).cast("date")).select("code", "trade_date")
    return _rounded(refreshed_metrics(quotes, changes))


_QUALITY_RUNS = (
    (_spoilt, "bronze_renamed", "2000-06-30 07:00:00"),
    (_silver, "silver_quotes", "2000-06-29 07:00:00"),
    (_silver, "silver_quotes", "2000-06-27 07:00:00"),
)


def _quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [quality.quality_checks(source(spark, sf_dir), name, at) for source, name, at in _QUALITY_RUNS]
    return logs[0].unionByName(logs[1]).unionByName(logs[2])


def _failing_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_checks(_spoilt(spark, sf_dir), "bronze_renamed", "2000-06-30 07:00:00")


CHECKED_AT = "2000-06-30 07:00:00"


def quality_of_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checks of all quotes from the days' profile, of which only the days since the last month were checked anew."""
    quotes = _broken(spark, sf_dir)
    before = quality.quality_profile(quotes.filter(F.col("trade_date").isNull() | (F.col("trade_date") <= F.lit(AS_OF).cast("date"))))
    changed = quotes.filter(F.col("trade_date") >= F.lit(BATCH_FROM).cast("date"))
    return quality.checks_of_profile(quality.replaced_days(before, quotes, changed), "bronze_renamed", CHECKED_AT)


def _day_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code sets of the loaded days, those since the last month counted anew."""
    bronze = _bronze(spark, sf_dir)
    dictionary = distinct.code_dictionary(bronze.select(F.col("Code").alias("code")))
    batch = bronze.filter(F.col("Date") >= BATCH_FROM)
    loaded = distinct.day_records(bronze.filter(F.col("Date") <= AS_OF), dictionary)
    return distinct.replace_days(loaded, distinct.day_records(batch, dictionary), batch.select(F.col("Date").alias("day")))


def ingest_counts_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = distinct.counts_by_day(_day_records(spark, sf_dir)).orderBy(F.desc("day")).limit(30)
    return newest.withColumnRenamed("day", "trade_date")


def bronze_stats_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct.counts_of_all(_day_records(spark, sf_dir)).select(
        F.col("last_day").alias("last_loaded_date"), F.col("days").alias("loaded_days"), "stock_count", "total_records"
    )


def landed_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes landed as one JSON array a month and read back by many tasks."""
    path = f"{scratch_dir(spark)}/landed/{uuid.uuid4().hex}"
    derived.land_arrays(derived.monthly_records(spark, sf_dir), path)
    accepted, _ = split_records(with_audit(read_array(spark, path), INGESTED))
    return accepted.drop("_loaded_at", SOURCE_FILE)


def _new_table(spark: SparkSession, name: str) -> str:
    """A table name that no other run uses."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS round_trips")
    return f"round_trips.{name}_{uuid.uuid4().hex}"


def stored_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver written by year, updated with the batch, compacted and read back."""
    table, keys = _new_table(spark, "quotes"), ["trade_year", *SILVER_KEY]

    def by_year(quotes: DataFrame) -> DataFrame:
        return quotes.withColumn("trade_year", F.year("trade_date"))

    loaded = _silver(spark, sf_dir).filter(F.col("trade_date") <= F.lit(AS_OF).cast("date"))
    overwrite_table(by_year(loaded), table, "trade_year", ["code"])
    upsert(by_year(quotes_to_silver(_batch(spark, sf_dir))), table, keys, "trade_year")
    compact(spark, table, "trade_year", ["code"])
    return spark.table(table).drop("trade_year")


def stored_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older listing written whole, then updated by the newer one and read back."""
    newer, older = "2000-06-30", "1999-06-30"
    table = _new_table(spark, "listing")
    records = derived.listing_snapshots(spark, sf_dir, newer, older)
    overwrite_table(records.filter((F.col("Date") == older) & ((F.col("ScaleCategory") == "Large") | (F.col("MarketCode") == "0"))), table)
    upsert(records.filter((F.col("Date") == newer) & (F.col("MarketCode") != "0")), table, ["Code"], newest_by=["Date"])
    return spark.table(table)


def stored_quality_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three runs' checks appended to a log table, then the summary of the last day."""
    table = _new_table(spark, "quality")
    for source, name, at in _QUALITY_RUNS:
        append_rows(quality.quality_checks(source(spark, sf_dir), name, at), table)
    return reports.quality_summary(spark.table(table), AS_OF)


class _Views:
    """Temporary views in the place of the Gold tables."""

    stocks, sectors = "view_stock_with_master", "view_sector_summary"


def _sql(call: str, round_metrics: bool = False) -> Query:
    """A report called as a SQL table function."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        stocks = _stocks(spark, sf_dir)
        stocks.createOrReplaceTempView(_Views.stocks)
        sector_summary(stocks).createOrReplaceTempView(_Views.sectors)
        sqlfunctions.register_reports(spark, _Views, prefix="report_", temporary=True)
        result = spark.sql(f"SELECT * FROM report_{call}")
        return _rounded(result) if round_metrics else result

    return run


def load_increment(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = _bronze(spark, sf_dir).filter(F.col("Date") <= AS_OF)
    return calendar.next_increment(loaded, "2000-07-30")


def _columns_of(source: Query, *columns: str) -> Query:
    return lambda spark, sf_dir: _rounded(source(spark, sf_dir).select("trade_date", "code", *columns))


def _sector_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    sectors = _rounded(_sectors(spark, sf_dir), ("avg_return_1d", "avg_return_5d", "avg_volatility"), 6)
    return _rounded(sectors, ("total_turnover",), 2)


def _report(source: Query, report: Callable[..., DataFrame], round_metrics: bool = False, **options) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        result = report(source(spark, sf_dir), **options)
        return _rounded(result) if round_metrics else result

    return run


def _day_report(report: Callable[..., DataFrame], round_metrics: bool = False, days: int = 0, by_sector: bool = False, **options) -> Query:
    """A report on the newest day, or ``as_of``: its indicators come from a bounded tail of each instrument."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        quotes = _silver(spark, sf_dir)
        last = options.get("as_of") or newest_day(quotes)
        stocks = attach_master(metrics_of_days(quotes, options.get("as_of"), days), _listing(spark, sf_dir))
        result = report(sector_summary(stocks) if by_sector else stocks, **{**options, "as_of": last})
        return _rounded(result) if round_metrics else result

    return run


def _training_data() -> list:
    """The modules with further queries, if that part of the library is there."""
    if not find_spec("quotewright.llm") or not find_spec("corpus_pipeline"):
        return []
    import corpus_pipeline
    from quotewright.llm import queries as training

    return [training, corpus_pipeline]


def queries() -> dict[str, Query]:
    """One entry per operator and report."""
    found = _market_queries()
    for module in _training_data():
        found |= module.queries()
    return found


def _market_queries() -> dict[str, Query]:
    checked_at = CHECKED_AT
    return {
        "bronze_quotes": bronze_quotes,
        "bronze_listing": bronze_listing,
        "load_month_ranges": lambda spark, d: calendar.month_chunks(calendar.history_span(_bronze(spark, d))),
        "load_increment": load_increment,
        "high_water_mark": _report(_bronze, calendar.high_water_mark),
        "silver_quotes": _silver,
        "silver_quotes_range": lambda spark, d: quotes_to_silver(_bronze(spark, d), "1999-07-01", AS_OF),
        "silver_listing": _listing,
        "upsert_quotes": upsert_quotes,
        "upsert_silver": upsert_silver,
        "upsert_listing": upsert_listing,
        "moving_averages": _columns_of(_metrics, "ma5", "ma25", "ma75"),
        "returns": _columns_of(_metrics, "return_1d", "return_5d", "return_21d"),
        "volatility": _columns_of(_metrics, "volatility_20d"),
        "volume_average": _columns_of(_metrics, "volume_ma5"),
        "yearly_range": _columns_of(
            _metrics, "high_52w", "low_52w", "dist_from_high_52w", "dist_from_low_52w"
        ),
        "stock_metrics": lambda spark, d: _rounded(_metrics(spark, d)),
        "metrics_refresh": metrics_refresh,
        "stock_with_unlisted": _unlisted,
        "stock_with_master": lambda spark, d: _rounded(_stocks(spark, d)),
        "sector_summary": _sector_summary,
        "quality_checks": _report(
            _silver, quality.quality_checks, table_name="silver_quotes", checked_at=checked_at
        ),
        "quality_checks_failing": _failing_checks,
        "quality_checks_broken": _report(_broken, quality.quality_checks, table_name="bronze_renamed", checked_at=checked_at),
        "quality_of_profile": quality_of_profile,
        "quality_checks_range": lambda spark, d: quality.quality_checks(
            between_dates(_broken(spark, d), "trade_date", "1999-07-01", AS_OF), "bronze_renamed", checked_at
        ),
        "quality_report": _report(_failing_checks, quality.quality_report),
        "quality_summary": _report(_quality_log, reports.quality_summary, as_of=AS_OF),
        "newest_quality_rows": _report(_quality_log, reports.newest_quality_rows),
        "daily_ingest_counts": _report(_bronze, reports.daily_ingest_counts),
        "bronze_stats": _report(_bronze, reports.bronze_stats),
        "silver_stats": _report(_silver, reports.silver_stats),
        "ingest_counts_merged": ingest_counts_merged,
        "bronze_stats_merged": bronze_stats_merged,
        "landed_arrays": landed_arrays,
        "stored_quotes": stored_quotes,
        "stored_listing": stored_listing,
        "stored_quality_log": stored_quality_log,
        "calendar_gaps": _report(_bronze, calendar.calendar_gaps, as_of=AS_OF),
        "calendar_gaps_at_end": _report(_bronze, calendar.calendar_gaps, as_of="2001-11-25"),
        "top_turnover": _day_report(reports.top_turnover, round_metrics=True),
        "ma_deviation_movers": _day_report(reports.ma_deviation_movers, round_metrics=True),
        "sector_recent": _day_report(reports.sector_recent, days=7, by_sector=True),
        "gainers_losers": _day_report(reports.gainers_losers, round_metrics=True),
        "market_kpis": _day_report(reports.market_kpis),
        "market_kpis_on_day": _day_report(reports.market_kpis, as_of=AS_OF),
        "sector_latest": _day_report(reports.sector_latest, by_sector=True),
        "stock_series": _report(_stocks, reports.stock_series, round_metrics=True, code="0", as_of=AS_OF),
        "return_ranking": _day_report(reports.return_ranking),
        "volatility_vs_return": _day_report(reports.volatility_vs_return, min_turnover=1e6, as_of=AS_OF),
        "sql_return_ranking": _sql("return_ranking()"),
        "sql_top_turnover": _sql("top_turnover(top => 3)", round_metrics=True),
        "sql_gainers_losers": _sql("gainers_losers()", round_metrics=True),
        "sql_market_kpis": _sql(f"market_kpis(DATE '{AS_OF}')"),
        "sql_stock_series": _sql(f"stock_series('0', DATE '{AS_OF}')", round_metrics=True),
        "sql_sector_recent": _sql("sector_recent()"),
        # Limits that cut at every scale.
        "top_turnover_3": _day_report(reports.top_turnover, round_metrics=True, rows=3),
        "ma_deviation_movers_3": _day_report(reports.ma_deviation_movers, round_metrics=True, rows=3),
        "volatility_vs_return_3": _day_report(reports.volatility_vs_return, min_turnover=1.0, rows=3),
        "metrics_between": lambda spark, d: _rounded(metrics_between(_silver(spark, d), "1999-07-01", AS_OF)),
        "market_turnover": _report(_stocks, reports.market_turnover, as_of=AS_OF),
        "curated_view": _report(_stocks, reports.curated_view, round_metrics=True, as_of=AS_OF),
    }


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for every registered query that SQL can express."""
    found = oracles.all_statements()
    for module in _training_data():
        found |= module.oracle_sql()
    return found


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: every indicator, joined with the master, at the smallest scale."""
    return queries()["stock_with_master"](spark, "/root/testdata/sf0.001")
