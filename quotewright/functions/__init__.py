from quotewright.functions.expressions import (  # noqa: F401
    as_date,
    percent_change,
    rows_back,
    rows_so_far,
    ticker_history,
    trailing_extreme,
)
