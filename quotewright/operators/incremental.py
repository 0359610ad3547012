"""Indicators of the bars that a change affects."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quotewright.functions import rows_so_far, ticker_history
from quotewright.operators.metrics import PRICE_COLUMNS, MetricWindows, stock_metrics


def refreshed_metrics(
    quotes: DataFrame,
    changes: DataFrame,
    windows: MetricWindows = MetricWindows(),
    lookback_days: int = 400,
) -> DataFrame:
    """Metrics of the bars whose indicators the changes can have altered.

    ``changes`` holds the (code, trade_date) of inserted or updated quotes. Per
    code, the affected bars run from the first changed day to
    ``windows.rows_needed`` bars after the last one, and computing them takes as
    many bars before the first. Most codes find these within the lookback, which
    prunes the scan to recent partitions. Codes that do not (rarely traded or
    suspended ones) fetch the missing rows from the older partitions, so every
    returned bar equals that of a full rebuild.
    """
    needed = windows.rows_needed
    quotes = quotes.select(*PRICE_COLUMNS)
    spans = changes.groupBy("code").agg(F.min("trade_date").alias("since"), F.max("trade_date").alias("until"))
    horizon = F.date_add(changes.agg(F.min("trade_date")).scalar(), -lookback_days)

    recent = quotes.filter(F.col("trade_date") >= horizon).join(spans, "code")
    found = F.count_if(F.col("trade_date") < F.col("since"))
    short = recent.groupBy("code", "since", "until").agg(found.alias("found")).filter(F.col("found") < needed)

    # Spark trims each task to the newest rows per code before the exchange.
    newest = Window.partitionBy("code").orderBy(F.col("trade_date").desc())
    older = (
        quotes.filter(F.col("trade_date") < horizon)
        .join(short.drop("found"), "code")
        .withColumn("_age", F.row_number().over(newest))
        .filter(F.col("_age") <= needed)
        .drop("_age")
    )
    inputs = recent.unionByName(older)
    so_far = rows_so_far(ticker_history())
    after_last = F.count_if(F.col("trade_date") > F.col("until")).over(so_far)
    return (
        stock_metrics(inputs, windows, carry=("since", "until"))
        .withColumn("_after", after_last)
        .filter((F.col("trade_date") >= F.col("since")) & (F.col("_after") <= needed))
        .drop("since", "until", "_after")
    )
