"""One row per key, chosen deterministically."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: Sequence[str] = ()) -> DataFrame:
    """Keep the newest row of each key.

    ``newest_by`` columns are compared newest first; all other columns break
    remaining ties, so a rerun picks the same row whatever the partitioning.
    Spark trims each map task to one row per key before the exchange
    (WindowGroupLimit), so a key with a huge number of copies does not travel.
    """
    newest_by = [c for c in newest_by if c in df.columns]
    rest = [c for c in df.columns if c not in (*keys, *newest_by)]
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in [*newest_by, *rest]])
    return df.withColumn("_pick", F.row_number().over(newest)).filter("_pick = 1").drop("_pick")
