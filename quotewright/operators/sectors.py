"""Sector totals per trading day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.operators.metrics import MetricWindows


def sector_summary(
    with_master: DataFrame, windows: MetricWindows = MetricWindows(), by: str = "sector17_name"
) -> DataFrame:
    """Count, mean returns, turnover and mean volatility per day and sector.

    Plain algebraic aggregates: each task reduces its rows to one partial row
    per (day, sector) before the exchange. Unlisted codes form the null sector.
    """
    short, longer = windows.returns[0], windows.returns[1]
    measures = {
        f"avg_return_{short}d": F.avg(f"return_{short}d"),
        f"avg_return_{longer}d": F.avg(f"return_{longer}d"),
        "total_turnover": F.sum("turnover_value"),
        "avg_volatility": F.avg(f"volatility_{windows.volatility}d"),
    }
    return with_master.groupBy("trade_date", by).agg(
        F.count("code").alias("stock_count"), *[c.alias(name) for name, c in measures.items()]
    )
