from quotewright.operators.cleanse import listing_to_silver, quotes_to_silver  # noqa: F401
from quotewright.operators.dedupe import latest_per_key  # noqa: F401
from quotewright.operators.master import attach_master  # noqa: F401
from quotewright.operators.metrics import MetricWindows, stock_metrics  # noqa: F401
from quotewright.operators.sectors import sector_summary  # noqa: F401
