"""The composed jobs: load, check, build, and the choice between them."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quotewright.operators import attach_master, listing_to_silver, sector_summary, stock_metrics
from quotewright.operators.cleanse import between_dates
from quotewright.operators.incremental import refreshed_metrics
from quotewright.operators.metrics import MetricWindows
from quotewright.operators.quality import quality_checks, quality_report, require_passed
from quotewright.schemas import LISTING_RECORD, MASTER_ATTRIBUTES, QUALITY_LOG, SILVER_KEY
from quotewright.sinks import append_rows, overwrite_table, replace_partitions, upsert
from quotewright.sinks.tables import finish_pending, holds_files, scratch_dir
from quotewright.sources.catalog import TableNames, current_table, ensure_schemas, table_exists
from quotewright.sources.landing import SOURCE_FILE, read_records, split_records, with_audit
from quotewright.streaming.ingest import LISTING_CHANGE, WITHDRAWN, Loaded, ingest_available, record_changes

DAY = "trade_date"


@dataclass(frozen=True)
class PipelineConfig:
    quotes_path: str
    listing_path: str | None = None
    layout: str = "lines"
    names: TableNames = TableNames()
    windows: MetricWindows = MetricWindows()
    checkpoint: str | None = None
    max_files_per_batch: int | None = None
    fail_on_error: bool = True

    def checkpoint_in(self, spark: SparkSession) -> str:
        """A folder of this warehouse, landing path and table alone, so no other load's progress is taken for its own."""
        of = f"{spark.conf.get('spark.sql.warehouse.dir')}\n{self.quotes_path}\n{self.layout}\n{self.names.bronze_quotes}"
        return self.checkpoint or f"{scratch_dir(spark)}/ingest/{self.names.bronze_quotes}-{md5(of.encode()).hexdigest()}"


@dataclass
class PipelineResult:
    mode: str
    loaded: Loaded = field(default_factory=Loaded)
    listing_rows: int = 0
    quality_passed: bool = True
    quality_text: str = ""
    gold_rows: dict[str, int] = field(default_factory=dict)


def _stamped(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.current_timestamp())


# -- instrument master ---------------------------------------------------


def refresh_listing(
    spark: SparkSession, records: DataFrame, names: TableNames = TableNames(), ingestion_date: date | str | None = None
) -> int:
    """Upsert listing records by code, rebuild the Silver listing, return its rows.

    When attributes that the joined Gold table carries have changed, the change
    is queued so that the next Gold run rewrites that table.
    """
    ensure_schemas(spark, names)
    accepted, rejected = split_records(with_audit(records, ingestion_date), dated=False)
    # Snapshots are read anew on each run, so keep only rejects that are not there yet.
    if table_exists(spark, names.rejected_records):
        known = current_table(spark, names.rejected_records).select(
            *[c for c in ("reason", "record", SOURCE_FILE) if c in rejected.columns]
        )
        same = [F.col(f"new.{c}").eqNullSafe(F.col(f"known.{c}")) for c in known.columns]
        rejected = rejected.alias("new").join(known.alias("known"), same, "left_anti")
    if not rejected.isEmpty():
        append_rows(rejected, names.rejected_records)
    upsert(accepted, names.bronze_listing, ["Code"], newest_by=("Date", "_ingestion_date"))
    current = listing_to_silver(current_table(spark, names.bronze_listing))
    first = not table_exists(spark, names.silver_listing)
    if first and table_exists(spark, names.stocks):
        record_changes(current.select("code").withColumn(DAY, F.lit(None).cast("date")), LISTING_CHANGE, names)
    if not first:
        attributes = ["code", *MASTER_ATTRIBUTES]
        new, old = current.select(attributes), current_table(spark, names.silver_listing).select(attributes)
        changed = new.exceptAll(old).unionByName(old.exceptAll(new)).select("code").distinct()
        if not changed.isEmpty():
            record_changes(changed.withColumn(DAY, F.lit(None).cast("date")), LISTING_CHANGE, names)
    return overwrite_table(_stamped(current, "_silver_updated_at"), names.silver_listing, sort_by=["code"])


# -- quality -------------------------------------------------------------


def check_quality(
    spark: SparkSession,
    names: TableNames = TableNames(),
    date_from: str | None = None,
    date_to: str | None = None,
    fail_on_error: bool = False,
) -> tuple[bool, str]:
    """Check Silver quotes, log the result, and only then raise if asked to."""
    quotes = between_dates(current_table(spark, names.silver_quotes), DAY, date_from, date_to)
    # Eight rows, needed by the log, the report and the gate alike.
    rows = quality_checks(quotes, names.silver_quotes).collect()
    checks = spark.createDataFrame(rows, QUALITY_LOG)
    append_rows(checks.coalesce(1), names.quality_log)
    report = quality_report(checks).first()
    if fail_on_error:
        require_passed(checks)
    return report.passed, report.summary


# -- gold ----------------------------------------------------------------


def build_gold(
    spark: SparkSession, names: TableNames = TableNames(), windows: MetricWindows = MetricWindows()
) -> dict[str, int]:
    """Rebuild the three Gold tables from Silver; returns their row counts."""
    metrics = stock_metrics(current_table(spark, names.silver_quotes), windows)
    rows = {"stock_metrics": _overwrite_gold(metrics, names.metrics)}
    return rows | _build_joined(spark, names, windows)


def _overwrite_gold(df: DataFrame, table: str) -> int:
    order = [c for c in ("code", "sector17_name") if c in df.columns][:1]
    return overwrite_table(_stamped(df, "_gold_updated_at"), table, DAY, order)


def _joined(metrics: DataFrame, spark: SparkSession, names: TableNames) -> DataFrame:
    """Without a listing yet, every attribute is null; one that comes later fills them."""
    if table_exists(spark, names.silver_listing):
        listing = current_table(spark, names.silver_listing)
    else:
        listing = listing_to_silver(spark.createDataFrame([], LISTING_RECORD))
    return attach_master(metrics.drop("_gold_updated_at"), listing)


def _build_joined(spark: SparkSession, names: TableNames, windows: MetricWindows) -> dict[str, int]:
    stocks = _overwrite_gold(_joined(current_table(spark, names.metrics), spark, names), names.stocks)
    sectors = _overwrite_gold(sector_summary(current_table(spark, names.stocks), windows), names.sectors)
    return {"stock_with_master": stocks, "sector_summary": sectors}


def refresh_gold(
    spark: SparkSession, names: TableNames = TableNames(), windows: MetricWindows = MetricWindows()
) -> dict[str, int]:
    """Bring Gold up to date with the queued changes only.

    Same tables as ``build_gold``, but only the bars that a change can affect are
    recomputed and only the days they fall on are rewritten.
    A changed listing touches every day, so it rewrites the joined tables.
    """
    for table in (names.metrics, names.stocks, names.sectors):
        finish_pending(spark, table)
    queue = current_table(spark, names.pending_changes)
    listing_changed = not queue.filter(F.col("kind") == LISTING_CHANGE).isEmpty()
    quotes = queue.filter(F.col("kind") != LISTING_CHANGE)

    refreshed = refreshed_metrics(current_table(spark, names.silver_quotes), quotes, windows)
    # Withdrawn quotes that no later record brought back lose their bars.
    withdrawn = queue.filter(F.col("kind") == WITHDRAWN).select(*SILVER_KEY).distinct()
    gone = withdrawn.join(current_table(spark, names.silver_quotes).select(*SILVER_KEY), list(SILVER_KEY), "left_anti")
    written = upsert(_stamped(refreshed, "_gold_updated_at"), names.metrics, SILVER_KEY, DAY, unique=True, withdrawn=gone)
    rows = {"stock_metrics": written.rows}
    if listing_changed:
        return rows | _build_joined(spark, names, windows)

    def touched(table: str) -> DataFrame:
        return current_table(spark, table).filter(F.col(DAY).isin(list(written.partitions)))

    rows |= {"stock_with_master": 0, "sector_summary": 0}
    if written.partitions:
        stocks = _stamped(_joined(touched(names.metrics), spark, names), "_gold_updated_at")
        rows["stock_with_master"] = replace_partitions(stocks, names.stocks, DAY, ["code"], written.partitions)
        sectors = _stamped(sector_summary(touched(names.stocks), windows), "_gold_updated_at")
        rows["sector_summary"] = replace_partitions(sectors, names.sectors, DAY, ["sector17_name"], written.partitions)
    return rows


def _clear_queue(spark: SparkSession, names: TableNames) -> None:
    # Gold is complete by now, so rows left by a run that stops here only repeat work.
    spark.sql(f"TRUNCATE TABLE {names.pending_changes}")


# -- runs ----------------------------------------------------------------


def run(
    spark: SparkSession,
    config: PipelineConfig,
    refresh_master: bool = True,
    ingestion_date: date | str | None = None,
) -> PipelineResult:
    """Load what is new and bring every table up to date.

    The first run loads all landed files and builds Gold; later ones load the new
    files and refresh Gold from the change queue. Every write lays its partitions
    out in sorted, well-sized files, so no separate compaction step is needed.
    The checks run before Gold, on the days that changed. The queue is emptied
    last, so a run that stops half-way is completed by the next one.
    ``refresh_master`` lets the caller refresh the listing less often.
    """
    names = config.names
    ensure_schemas(spark, names)
    first_run = not table_exists(spark, names.bronze_quotes)
    result = PipelineResult("initial" if first_run else "incremental")

    progress = f"{config.checkpoint_in(spark)}/commits"
    if first_run and not table_exists(spark, names.rejected_records) and holds_files(spark, progress):
        raise ValueError(f"{names.bronze_quotes} is gone but {progress} says that files were loaded; remove that folder to load all again")

    if config.listing_path and (refresh_master or not table_exists(spark, names.silver_listing)):
        listing = read_records(spark, config.listing_path, LISTING_RECORD, config.layout)
        result.listing_rows = refresh_listing(spark, listing, names, ingestion_date)
    result.loaded = ingest_available(
        spark,
        config.quotes_path,
        config.checkpoint_in(spark),
        names,
        config.layout,
        config.max_files_per_batch,
        ingestion_date,
    )
    if not table_exists(spark, names.pending_changes):
        raise ValueError(f"no usable quotes have landed in {config.quotes_path}")

    # A rebuild that stopped half-way has left one of them out.
    gold_exists = all(table_exists(spark, t) for t in (names.metrics, names.stocks, names.sectors))
    queue = current_table(spark, names.pending_changes)
    changed = queue.agg(F.count(F.lit(1)).alias("n"), F.min(DAY).alias("since")).first()
    if gold_exists and not changed.n:
        result.mode = "up_to_date"
        return result
    if changed.since is not None:
        result.quality_passed, result.quality_text = check_quality(
            spark, names, str(changed.since), fail_on_error=config.fail_on_error
        )
    build = refresh_gold if gold_exists else build_gold
    result.gold_rows = build(spark, names, config.windows)
    _clear_queue(spark, names)
    return result
