"""Dates: loaded history, load ranges, calendar gaps."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.functions import as_date

# Status labels of the gap report.
WEEKEND, MISSING, TRADED = "Weekend", "⚠️ Missing (possible holiday)", "OK"


def day(as_of: date | str | Column | None) -> Column:
    """The given day, also one that is found by a subquery, or the session's current date."""
    if isinstance(as_of, Column):
        return as_of
    return F.current_date() if as_of is None else F.lit(str(as_of)).cast("date")


def high_water_mark(bronze: DataFrame) -> DataFrame:
    """Newest loaded ``Date``; null for an empty table."""
    return bronze.agg(F.max("Date").alias("max_date"))


def history_span(bronze: DataFrame) -> DataFrame:
    """First and last loaded day as one (date_from, date_to) row."""
    ends = bronze.agg(F.min("Date").alias("first"), F.max("Date").alias("last"))
    return ends.select(as_date("first").alias("date_from"), as_date("last").alias("date_to"))


def _with_request_dates(ranges: DataFrame) -> DataFrame:
    """Add the bounds in the compact form a quote request takes."""
    return ranges.withColumns(
        {
            "request_from": F.date_format("date_from", "yyyyMMdd"),
            "request_to": F.date_format("date_to", "yyyyMMdd"),
        }
    )


def month_chunks(span: DataFrame) -> DataFrame:
    """Split each (date_from, date_to) into calendar months clipped to it."""
    months = F.sequence(F.trunc("date_from", "MM"), F.col("date_to"), F.expr("INTERVAL 1 MONTH"))
    chunks = span.select("date_from", "date_to", F.explode(months).alias("month")).select(
        F.greatest("month", "date_from").alias("date_from"),
        F.least(F.last_day("month"), F.col("date_to")).alias("date_to"),
    )
    return _with_request_dates(chunks)


def next_increment(bronze: DataFrame, as_of: date | str | None = None) -> DataFrame:
    """Days still to be loaded: after the newest loaded one, up to yesterday."""
    bounds = high_water_mark(bronze).select(
        F.date_add(as_date("max_date"), 1).alias("date_from"), F.date_add(day(as_of), -1).alias("date_to")
    )
    return _with_request_dates(bounds.withColumn("up_to_date", F.col("date_from") > F.col("date_to")))


def calendar_gaps(
    bronze: DataFrame, as_of: date | str | None = None, days_back: int = 45, until: int = 1
) -> DataFrame:
    """Each calendar day before ``as_of`` as weekend, missing or loaded.

    The range filter sits on the stored ``Date``, so only the partitions of
    those days are read; the distinct days then number at most ``days_back``.
    """
    first, last = F.date_add(day(as_of), -days_back), F.date_add(day(as_of), -until)
    stored_bounds = [F.date_format(bound, "yyyy-MM-dd") for bound in (first, last)]
    traded = (
        bronze.filter(F.col("Date").between(*stored_bounds))
        .select(as_date("Date").alias("trade_date"))
        .distinct()
    )
    days = bronze.sparkSession.range(1).select(
        F.explode(F.sequence(first, last, F.expr("INTERVAL 1 DAY"))).alias("cal_date")
    )
    status = (
        F.when(F.dayofweek("cal_date").isin(1, 7), WEEKEND)
        .when(F.col("trade_date").isNull(), MISSING)
        .otherwise(TRADED)
    )
    return (
        days.join(traded, F.col("cal_date") == F.col("trade_date"), "left")
        .select("cal_date", status.alias("status"))
        .orderBy(F.col("cal_date").desc())
    )
