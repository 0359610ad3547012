"""Column expressions shared by the operators; all of them stay in the JVM."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, Window, WindowSpec
from pyspark.sql import functions as F

# Fixed value: the date format of landed records.
ISO_DAY = r"^\d{4}-\d{2}-\d{2}\z"


def percent_change(now: Column | str, base: Column | str) -> Column:
    """``(now / base - 1) * 100``; null when the base is null or zero.

    ``try_divide`` keeps a zero base from failing the job under ANSI mode.
    """
    return (F.try_divide(now, base) - 1) * 100


def as_date(text: str) -> Column:
    """Parse a ``yyyy-MM-dd`` column; any other text becomes null, not an error.

    The cast alone would also take forms such as ``2024-1-5``. With the pattern in
    front it is as strict as a formatted parse at about half the cost.
    """
    column = F.col(text)
    return F.when(column.rlike(ISO_DAY), column.try_cast("date"))


def ticker_history(key: str = "code", order: str = "trade_date") -> WindowSpec:
    """One instrument's rows in date order.

    (key, date) is unique in every table the upsert maintains, so a group holds
    at most one row per calendar day however large the table grows.
    """
    return Window.partitionBy(key).orderBy(order)


def rows_back(history: WindowSpec, rows: int) -> WindowSpec:
    """Frame of the current row and the ``rows - 1`` rows before it."""
    return history.rowsBetween(1 - rows, Window.currentRow)


def rows_so_far(history: WindowSpec) -> WindowSpec:
    """Frame of everything up to the current row."""
    return history.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def trailing_extreme(
    history: WindowSpec,
    rows: int,
    aggregate: Callable[[Column], Column],
    combine: Callable[..., Column],
) -> tuple[Callable[[str], Column], Callable[[str], Column]]:
    """Running max or min over a long row frame, in two cheap window passes.

    A sliding frame is re-evaluated in full for each row, so 252 rows cost 252
    updates per output row. Max and min may cover a frame with overlapping
    blocks instead: the first expression takes the extreme of a short block, the
    second combines that result at a few lags. The answer is the same value, as
    neither rounds; lags before the first row are null and ``greatest`` /
    ``least`` skip them, so short histories work too.
    """
    block = min(rows, math.ceil(2 * math.sqrt(rows)))
    offsets = [*range(0, rows - block, block), rows - block]

    def of_block(column: str) -> Column:
        return aggregate(F.col(column)).over(rows_back(history, block))

    def of_frame(column: str) -> Column:
        parts = [F.lag(column, n).over(history) if n else F.col(column) for n in offsets]
        return combine(*parts) if len(parts) > 1 else parts[0]

    return of_block, of_frame
