"""Column layouts of the landed records and of the tables built from them."""

from __future__ import annotations

from pyspark.sql import types as T


def _fields(names: str, kind: T.DataType) -> list[T.StructField]:
    return [T.StructField(name, kind) for name in names.split()]


# Field names of the landed quote and listing records.
QUOTE_RECORD = T.StructType(
    _fields("Date Code", T.StringType())
    + _fields(
        "Open High Low Close Volume TurnoverValue AdjustmentFactor "
        "AdjustmentOpen AdjustmentHigh AdjustmentLow AdjustmentClose AdjustmentVolume",
        T.DoubleType(),
    )
)
LISTING_RECORD = T.StructType(
    _fields(
        "Date Code CompanyName CompanyNameEnglish Sector17Code Sector17CodeName "
        "Sector33Code Sector33CodeName ScaleCategory MarketCode MarketCodeName",
        T.StringType(),
    )
)

# Silver column -> landed field. Prices and volume are served adjusted; the
# traded values stay available under raw_*.
SILVER_QUOTE_FIELDS = {
    "open": "AdjustmentOpen",
    "high": "AdjustmentHigh",
    "low": "AdjustmentLow",
    "close": "AdjustmentClose",
    "volume": "AdjustmentVolume",
    "turnover_value": "TurnoverValue",
    "adjustment_factor": "AdjustmentFactor",
    "raw_open": "Open",
    "raw_high": "High",
    "raw_low": "Low",
    "raw_close": "Close",
    "raw_volume": "Volume",
}
SILVER_LISTING_FIELDS = {
    "code": "Code",
    "company_name": "CompanyName",
    "company_name_en": "CompanyNameEnglish",
    "sector17_code": "Sector17Code",
    "sector17_name": "Sector17CodeName",
    "sector33_code": "Sector33Code",
    "sector33_name": "Sector33CodeName",
    "scale_category": "ScaleCategory",
    "market_code": "MarketCode",
    "market_name": "MarketCodeName",
}

# Attributes of the instrument master that the joined table carries.
MASTER_ATTRIBUTES = ("company_name", "sector17_name", "sector33_name", "market_name", "scale_category")

QUOTE_KEY = ("Date", "Code")
SILVER_KEY = ("trade_date", "code")

QUALITY_LOG = T.StructType(
    [
        T.StructField("checked_at", T.TimestampType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("passed", T.BooleanType()),
        T.StructField("detail", T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("failed_count", T.LongType()),
    ]
)
