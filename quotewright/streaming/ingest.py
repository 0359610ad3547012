"""Incremental ingest: landed files to Bronze and Silver, exactly the new ones."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.functions import as_date
from quotewright.operators import latest_per_key, quotes_to_silver
from quotewright.schemas import QUOTE_KEY, QUOTE_RECORD, SILVER_KEY
from quotewright.sinks import append_rows, upsert
from quotewright.sources.catalog import TableNames, ensure_schemas, table_exists
from quotewright.sources.landing import records_of_pieces, split_records, stream_pieces, stream_records, with_audit

NEWEST_BY = ("_ingestion_date", "_loaded_at", "_source_file")
QUOTE_CHANGE, WITHDRAWN, LISTING_CHANGE = "quote", "withdrawn", "listing"


@dataclass
class Loaded:
    bronze_rows: int = 0
    silver_rows: int = 0
    rejected_rows: int = 0

    def __iadd__(self, other: "Loaded") -> "Loaded":
        self.bronze_rows += other.bronze_rows
        self.silver_rows += other.silver_rows
        self.rejected_rows += other.rejected_rows
        return self


def record_changes(changes: DataFrame, kind: str, names: TableNames) -> None:
    """Queue changed codes, with their first and last changed day, for the next Gold refresh."""
    queued = changes.select(F.lit(kind).alias("kind"), "code", "trade_date")
    append_rows(queued, names.pending_changes)


def load_quotes(
    records: DataFrame, names: TableNames = TableNames(), ingestion_date: date | str | None = None
) -> Loaded:
    """Upsert quote records into Bronze and their cleansed form into Silver.

    A record that is no longer usable takes its older form out of Silver.
    Loading the same records again leaves both tables unchanged, so a replayed
    batch is harmless. The change queue and the reject table may then hold a row
    twice; readers of the queue only take minima and maxima.
    """
    # Accepted and rejected records come from one parse of the files.
    audited = with_audit(records, ingestion_date).persist()
    accepted, rejected = split_records(audited)
    # Both tables must agree on the winner among copies, so pick it once.
    batch = latest_per_key(accepted, QUOTE_KEY, NEWEST_BY).persist()
    try:
        bronze = upsert(batch, names.bronze_quotes, QUOTE_KEY, "Date", unique=True)
        cleansed = quotes_to_silver(batch).withColumn("_silver_updated_at", F.current_timestamp())
        withdrawn = None
        if table_exists(records.sparkSession, names.silver_quotes):
            keys = batch.select(as_date("Date").alias("trade_date"), F.col("Code").alias("code"))
            withdrawn = keys.join(cleansed.select(*SILVER_KEY), list(SILVER_KEY), "left_anti").dropna()
        silver = upsert(cleansed, names.silver_quotes, SILVER_KEY, "trade_date", unique=True, withdrawn=withdrawn)
        if withdrawn is not None:
            record_changes(withdrawn, WITHDRAWN, names)
        if silver.rows:
            ends = F.array_distinct(F.array(F.min("trade_date"), F.max("trade_date")))
            spans = cleansed.groupBy("code").agg(ends.alias("ends"))
            record_changes(spans.select("code", F.explode("ends").alias("trade_date")), QUOTE_CHANGE, names)
        refused = rejected.count()
        if refused:
            append_rows(rejected, names.rejected_records)
    finally:
        batch.unpersist()
        audited.unpersist()
    return Loaded(bronze.rows, silver.rows, refused)


def ingest_available(
    spark: SparkSession,
    landing_path: str,
    checkpoint: str,
    names: TableNames = TableNames(),
    layout: str = "lines",
    max_files_per_batch: int | None = None,
    ingestion_date: date | str | None = None,
) -> Loaded:
    """Load every landed file not seen before, then stop.

    The stream's checkpoint remembers which files were loaded; together with the
    idempotent upsert each file counts exactly once even if a run is repeated.
    """
    ensure_schemas(spark, names)
    loaded = Loaded()

    # Array files arrive as pieces, so that each is read by many tasks, and are put together batch by batch.
    in_pieces = layout == "array"

    def load(batch: DataFrame, _batch_id: int) -> None:
        nonlocal loaded
        records = records_of_pieces(batch, QUOTE_RECORD) if in_pieces else batch
        loaded += load_quotes(records, names, ingestion_date)

    if in_pieces:
        stream = stream_pieces(spark, landing_path, max_files_per_batch)
    else:
        stream = stream_records(spark, landing_path, QUOTE_RECORD, layout, max_files_per_batch)
    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return loaded
