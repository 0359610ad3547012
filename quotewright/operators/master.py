"""Join of bars with the instrument master."""

from __future__ import annotations

from pyspark.sql import DataFrame

from quotewright.schemas import MASTER_ATTRIBUTES


def attach_master(metrics: DataFrame, listing: DataFrame) -> DataFrame:
    """Left join on the code; bars of unlisted codes keep null attributes.

    The listing must have one row per code. No broadcast is forced, because a
    listing grows with the market: Spark broadcasts it while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` (or AQE finds it to be at run time)
    and otherwise merges on ``code``. Metrics fresh from their windows are
    already hash-partitioned and sorted by code, so in that case only the
    listing is shuffled.
    """
    return metrics.join(listing.select("code", *MASTER_ATTRIBUTES), "code", "left").select(
        *metrics.columns, *MASTER_ATTRIBUTES
    )
