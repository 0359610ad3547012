"""Rolling indicators per instrument."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quotewright.functions import percent_change, rows_back, ticker_history, trailing_extreme

PRICE_COLUMNS = ("trade_date", "code", "open", "high", "low", "close", "volume", "turnover_value")


@dataclass(frozen=True)
class MetricWindows:
    """Window lengths in trading rows; output names follow from them."""

    # The standard indicator set.
    averages: tuple[int, ...] = (5, 25, 75)
    returns: tuple[int, ...] = (1, 5, 21)
    volatility: int = 20
    volume_average: int = 5
    extreme: int = 252
    extreme_label: str = "52w"

    @property
    def rows_needed(self) -> int:
        """Rows before a bar that can influence its indicators.

        Volatility looks at one-row returns, so it reaches one row further back
        than its frame.
        """
        frames = max(*self.averages, self.volume_average, self.extreme) - 1
        return max(frames, *self.returns, self.volatility)

    @property
    def columns(self) -> list[str]:
        return [
            *[f"ma{n}" for n in self.averages],
            *[f"return_{n}d" for n in self.returns],
            f"volatility_{self.volatility}d",
            f"volume_ma{self.volume_average}",
            f"high_{self.extreme_label}",
            f"low_{self.extreme_label}",
            f"dist_from_high_{self.extreme_label}",
            f"dist_from_low_{self.extreme_label}",
        ]


def moving_averages(windows: MetricWindows, history) -> dict[str, Column]:
    """Mean close over each window; the first rows average what there is."""
    return {f"ma{n}": F.avg("close").over(rows_back(history, n)) for n in windows.averages}


def trailing_returns(windows: MetricWindows, history) -> dict[str, Column]:
    """Percentage change over n rows; null for the first n rows."""
    return {
        f"return_{n}d": percent_change("close", F.lag("close", n).over(history)) for n in windows.returns
    }


def volume_average(windows: MetricWindows, history) -> dict[str, Column]:
    n = windows.volume_average
    return {f"volume_ma{n}": F.avg("volume").over(rows_back(history, n))}


def stock_metrics(
    quotes: DataFrame, windows: MetricWindows = MetricWindows(), carry: tuple[str, ...] = ()
) -> DataFrame:
    """Prices with every rolling indicator.

    All windows share one partitioning and order, hence one exchange and one
    sort. The first pass computes what depends on stored columns, the second
    what depends on the first (volatility and the long range), and a projection
    finishes the distances. Of other input columns only ``carry`` is kept.
    """
    history = ticker_history()
    label = windows.extreme_label
    high_block, high_frame = trailing_extreme(history, windows.extreme, F.max, F.greatest)
    low_block, low_frame = trailing_extreme(history, windows.extreme, F.min, F.least)

    first = {
        **moving_averages(windows, history),
        **trailing_returns(windows, history),
        **volume_average(windows, history),
        "_step": percent_change("close", F.lag("close", 1).over(history)),
        "_high_block": high_block("high"),
        "_low_block": low_block("low"),
    }
    second = {
        f"volatility_{windows.volatility}d": F.stddev_samp("_step").over(
            rows_back(history, windows.volatility)
        ),
        f"high_{label}": high_frame("_high_block"),
        f"low_{label}": low_frame("_low_block"),
    }
    distances = {
        f"dist_from_{side}_{label}": percent_change("close", f"{side}_{label}") for side in ("high", "low")
    }
    keep = [*PRICE_COLUMNS, *carry]
    return (
        quotes.select(*keep)
        .select("*", *[c.alias(name) for name, c in first.items()])
        .select("*", *[c.alias(name) for name, c in second.items()])
        .select("*", *[c.alias(name) for name, c in distances.items()])
        .select(*PRICE_COLUMNS, *windows.columns, *carry)
    )
