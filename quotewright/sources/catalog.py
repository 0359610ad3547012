"""Schemas and tables of the session catalog."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableNames:
    """Where the pipeline keeps its tables; each schema may carry a catalog prefix."""

    # The table names that reports and users query.
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"

    @property
    def bronze_quotes(self) -> str:
        return f"{self.bronze}.daily_quotes"

    @property
    def bronze_listing(self) -> str:
        return f"{self.bronze}.listed_info"

    @property
    def rejected_records(self) -> str:
        return f"{self.bronze}.rejected_records"

    @property
    def silver_quotes(self) -> str:
        return f"{self.silver}.daily_quotes"

    @property
    def silver_listing(self) -> str:
        return f"{self.silver}.listed_info"

    @property
    def quality_log(self) -> str:
        return f"{self.silver}.dq_log"

    @property
    def pending_changes(self) -> str:
        return f"{self.silver}.pending_changes"

    @property
    def metrics(self) -> str:
        return f"{self.gold}.stock_metrics"

    @property
    def stocks(self) -> str:
        return f"{self.gold}.stock_with_master"

    @property
    def sectors(self) -> str:
        return f"{self.gold}.sector_summary"


SCHEMA_COMMENTS = {
    "bronze": "Landed market data as received",
    "silver": "Cleansed and normalised market data",
    "gold": "Indicators and aggregates for reports",
}


def ensure_schemas(spark: SparkSession, names: TableNames) -> None:
    for layer, comment in SCHEMA_COMMENTS.items():
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {getattr(names, layer)} COMMENT '{comment}'")


def table_exists(spark: SparkSession, name: str) -> bool:
    """True if the name resolves; connection and permission errors still surface."""
    return spark.catalog.tableExists(name)


def list_tables(spark: SparkSession, schema: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {schema}").select(
        F.col("namespace").alias("schema_name"), F.col("tableName").alias("table_name")
    )


def current_table(spark: SparkSession, name: str) -> DataFrame:
    """The table with its present files.

    A session caches the file list of a table it has read; writes made by another
    session, such as the one a stream runs its batches in, do not invalidate it.
    """
    spark.catalog.refreshTable(name)
    return spark.table(name)
