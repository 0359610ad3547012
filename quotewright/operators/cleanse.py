"""Raw records to typed, cleansed tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quotewright.functions import as_date
from quotewright.operators.dedupe import latest_per_key
from quotewright.schemas import SILVER_LISTING_FIELDS, SILVER_QUOTE_FIELDS


def between_dates(
    df: DataFrame, column: str, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """Closed, optionally one-sided range.

    The bound is compared with the stored column itself (ISO text or DATE), so
    it prunes partitions when that column is the partition column.
    """
    kind = df.schema[column].dataType
    if date_from is not None:
        df = df.filter(F.col(column) >= F.lit(str(date_from)).cast(kind))
    if date_to is not None:
        df = df.filter(F.col(column) <= F.lit(str(date_to)).cast(kind))
    return df


def quotes_to_silver(
    bronze: DataFrame, date_from: str | None = None, date_to: str | None = None
) -> DataFrame:
    """Adjusted prices under canonical names, unusable bars removed.

    A bar is usable when its adjusted close is positive and its adjusted volume
    is not negative; a null fails either comparison. One row in gives at most
    one row out, so a bronze table that is unique per key stays unique.
    """
    usable = between_dates(bronze, "Date", date_from, date_to).filter(
        (F.col("AdjustmentClose") > 0) & (F.col("AdjustmentVolume") >= 0)
    )
    carried = [c for c in ("_ingestion_date",) if c in bronze.columns]
    return usable.select(
        as_date("Date").alias("trade_date"),
        F.col("Code").cast("string").alias("code"),
        *[F.col(field).alias(name) for name, field in SILVER_QUOTE_FIELDS.items()],
        *carried,
    )


def listing_to_silver(bronze: DataFrame) -> DataFrame:
    """Newest listing record of each code, renamed."""
    current = latest_per_key(bronze.filter(F.col("Code").isNotNull()), ["Code"], ["Date", "_ingestion_date"])
    carried = [c for c in ("_ingestion_date",) if c in bronze.columns]
    return current.select(
        *[F.col(field).alias(name) for name, field in SILVER_LISTING_FIELDS.items()], *carried
    )
