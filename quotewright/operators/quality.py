"""Data-quality checks as rows, their report and the gate."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.schemas import QUALITY_LOG, SILVER_KEY


@dataclass(frozen=True)
class RowCheck:
    """A named predicate that marks a failing row (null counts as passing)."""

    name: str
    fails_when: str
    detail: str


# Check names and detail texts of the quality log.
DUPLICATES = RowCheck("no_duplicates", "", "%1$d duplicate (trade_date, code) combinations")
ROW_CHECKS = (
    *[RowCheck(f"not_null:{c}", f"{c} IS NULL", "%1$d nulls / %2$d rows") for c in ("trade_date", "code", "close", "volume")],
    RowCheck("close_positive", "close <= 0", "%1$d records with close<=0"),
    RowCheck("high_gte_low", "high < low", "%1$d records where high < low"),
    RowCheck("volume_non_negative", "volume < 0", "%1$d records with volume<0"),
)
# Order in which a report lists the checks.
CHECK_ORDER = (
    "not_null:trade_date",
    "not_null:code",
    "not_null:close",
    "not_null:volume",
    "close_positive",
    "high_gte_low",
    "no_duplicates",
    "volume_non_negative",
)


class QualityGateError(ValueError):
    """Raised when a gated table has failing checks."""


def surplus_rows(df: DataFrame, key: tuple[str, ...] = SILVER_KEY) -> DataFrame:
    """Rows beyond the first of each key; null is a key value like any other.

    The count per key is combined in each task first, so copies of one key
    reach the exchange as a single row.
    """
    return (
        df.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).alias("failed"))
    )


def quality_checks(quotes: DataFrame, table_name: str, checked_at: datetime | str | None = None) -> DataFrame:
    """One log row per check.

    The row checks are one aggregate over the whole table. Only the duplicate
    check needs an exchange, and that pass reads just the two key columns.
    """
    failed_of = {check.name: F.count_if(F.expr(check.fails_when)) for check in ROW_CHECKS}
    totals = quotes.agg(
        F.count(F.lit(1)).alias("row_count"), *[c.alias(name) for name, c in failed_of.items()]
    ).withColumn(DUPLICATES.name, surplus_rows(quotes).scalar())

    return _log_rows(totals, table_name, checked_at)


def quality_profile(quotes: DataFrame) -> DataFrame:
    """One row a day that adds up: its rows, and the failures of every check.

    Rows without a day have a row of their own (``trade_date`` null). A duplicate is a
    row beyond the first of its (trade_date, code), so a day's duplicates lie within
    the day. Rows are reduced to one a key in each task; no second scan is needed.
    """
    day, code = SILVER_KEY
    failed = {check.name: F.count_if(F.expr(check.fails_when)) for check in ROW_CHECKS}
    by_key = quotes.groupBy(day, code).agg(F.count(F.lit(1)).alias("row_count"), *[c.alias(name) for name, c in failed.items()])
    sums = [F.sum(f"`{name}`").alias(name) for name in failed]
    return by_key.groupBy(day).agg(F.sum("row_count").alias("row_count"), *sums, F.sum(F.col("row_count") - 1).alias(DUPLICATES.name))


def replaced_days(profile: DataFrame, quotes: DataFrame, changed: DataFrame) -> DataFrame:
    """The profile after the days in ``changed`` (column ``trade_date``) were checked anew in ``quotes``.

    The other days keep their rows; only the changed ones are read. A day that has no quotes left goes.
    """
    day = SILVER_KEY[0]
    days = changed.select(F.col(day).alias("_day")).distinct()
    same = F.col(day).eqNullSafe(F.col("_day"))
    kept = profile.join(days, same, "left_anti")
    return kept.unionByName(quality_profile(quotes.join(days, same, "left_semi")))


def _log_rows(totals: DataFrame, table_name: str, checked_at: datetime | str | None) -> DataFrame:
    """One log row per check from one row of counts, named like the checks."""
    stamp = F.current_timestamp() if checked_at is None else F.lit(str(checked_at)).cast("timestamp")

    def result(check: RowCheck) -> Column:
        failed = F.col(f"`{check.name}`")
        return F.struct(
            F.lit(check.name).alias("check_name"),
            (failed == 0).alias("passed"),
            F.format_string(check.detail, failed, F.col("row_count")).alias("detail"),
            failed.alias("failed_count"),
        )

    results = F.array(*[result(check) for check in (*ROW_CHECKS, DUPLICATES)])
    return totals.select(
        stamp.alias("checked_at"), F.lit(table_name).alias("table_name"), "row_count", F.inline(results)
    ).select(*QUALITY_LOG.names)


def checks_of_profile(profile: DataFrame, table_name: str, checked_at: datetime | str | None = None) -> DataFrame:
    """The same log rows as ``quality_checks`` of the whole table, from the days' rows."""
    names = ["row_count", *[check.name for check in (*ROW_CHECKS, DUPLICATES)]]
    totals = profile.agg(*[F.coalesce(F.sum(f"`{n}`"), F.lit(0)).alias(n) for n in names])
    return _log_rows(totals, table_name, checked_at)


def quality_report(checks: DataFrame) -> DataFrame:
    """Overall verdict and printable summary per table, over its check rows."""
    position = F.array_position(F.array(*[F.lit(n) for n in CHECK_ORDER]), F.col("check_name"))
    mark = F.when(F.col("passed"), "✅").otherwise("❌")
    line = F.concat(F.lit("  "), mark, F.lit(" "), F.col("check_name"), F.lit(": "), F.col("detail"))
    # At most one entry per known check, so the collected list stays tiny.
    lines = F.array_sort(F.collect_list(F.struct(position.alias("position"), line.alias("line"))))
    verdicts = checks.groupBy("table_name").agg(F.every("passed").alias("passed"), lines.alias("lines"))
    title = F.concat(
        F.lit("=== DQ Report ["),
        F.col("table_name"),
        F.lit("]: "),
        F.when(F.col("passed"), "PASSED").otherwise("FAILED"),
        F.lit(" ==="),
    )
    body = F.array_join(F.col("lines.line"), "\n")
    return verdicts.select("table_name", "passed", F.concat_ws("\n", title, body).alias("summary"))


def require_passed(checks: DataFrame) -> None:
    """Raise if any check failed; brings only the failing check rows over."""
    failing = checks.filter(~F.col("passed")).select("table_name", "check_name", "detail").collect()
    if failing:
        listed = "; ".join(f"{r.table_name} {r.check_name}: {r.detail}" for r in failing)
        raise QualityGateError(f"data-quality checks failed: {listed}")
