"""Indicators of a range of days, from a bounded tail of each instrument."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quotewright.operators.calendar import day
from quotewright.operators.metrics import PRICE_COLUMNS, MetricWindows, stock_metrics


def newest_day(quotes: DataFrame, column: str = "trade_date") -> Column:
    """The table's newest day, as a scalar subquery."""
    return quotes.agg(F.max(column)).scalar()


def metrics_of_days(
    quotes: DataFrame,
    as_of: date | str | Column | None = None,
    days: int = 0,
    windows: MetricWindows = MetricWindows(),
) -> DataFrame:
    """``stock_metrics`` of the bars from ``days`` before ``as_of`` to ``as_of``, by default the newest day alone.

    A bar's indicators depend on at most ``windows.rows_needed`` bars before it, and an
    instrument has at most one bar a day. So the newest ``rows_needed + days + 1``
    bars up to ``as_of`` hold all that the range needs, whatever the length of the
    history. Each task trims its instruments to them before the only exchange
    (WindowGroupLimit); the indicators are computed on what is left, in the same
    layout. The result equals the full one on those days. (code, trade_date) must
    be unique; bars without a code or a day have no place in a history and are left out.
    """
    last = newest_day(quotes) if as_of is None else day(as_of)
    first = F.date_add(last, -days)
    # The newest day needs no upper bound.
    upto = quotes if as_of is None else quotes.filter(F.col("trade_date") <= last)
    age = F.row_number().over(Window.partitionBy("code").orderBy(F.col("trade_date").desc()))
    tail = (
        upto.select(*PRICE_COLUMNS)
        .filter(F.col("code").isNotNull() & F.col("trade_date").isNotNull())
        .withColumn("_age", age)
        .filter(F.col("_age") <= windows.rows_needed + days + 1)
        .drop("_age")
    )
    return stock_metrics(tail, windows).filter(F.col("trade_date") >= first)


def metrics_between(
    quotes: DataFrame, date_from: date | str, date_to: date | str, windows: MetricWindows = MetricWindows()
) -> DataFrame:
    """``stock_metrics`` of the bars of a closed range of days.

    Lets a backfill go range by range: what is exchanged is the range and the halo
    of earlier bars, ``rows_needed`` for each instrument, not the whole history.
    """
    first, last = date.fromisoformat(str(date_from)), date.fromisoformat(str(date_to))
    if last < first:
        raise ValueError(f"the range ends on {last}, before it begins on {first}")
    return metrics_of_days(quotes, last, (last - first).days, windows)
