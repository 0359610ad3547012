"""Writes to catalog tables: overwrite, append, upsert, compaction.

Plain Parquet tables have no transactions, so a write that replaces part of a
table works in two steps: the new contents of the touched partitions are first
written to the shared scratch folder, then published over the table with
dynamic partition overwrite. The table is thus never read and overwritten by
the same job, a lost executor only repeats its tasks, and if the driver dies
while publishing, the complete staged copy is published again before the next
write to that table. One writer per table at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quotewright.operators.dedupe import latest_per_key
from quotewright.sources.catalog import current_table, table_exists

OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
TYPE_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"
#: Mean size below which several files of a partition are merged. Well under the size
#: that ``rebalance`` aims at, so that a partition just rewritten is left alone.
SMALL_FILE_BYTES = 8 << 20


@dataclass(frozen=True)
class Written:
    """Rows taken from the source, and the partition values they fell into."""

    rows: int
    partitions: tuple = ()


# -- shared scratch folder -------------------------------------------------


def scratch_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; beside the warehouse where it is unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    return configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch"


def _staging_path(spark: SparkSession, table: str) -> str:
    """Scratch path of a table, distinct per warehouse that shares the folder."""
    warehouse = spark.conf.get("spark.sql.warehouse.dir").split(":", 1)[-1].strip("/").replace("/", "_")
    return f"{scratch_dir(spark)}/staged/{warehouse}/{table}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, found = _file_system(spark, path)
    return fs.exists(found)


def holds_files(spark: SparkSession, path: str) -> bool:
    """Whether a folder exists and holds more than hidden files."""
    fs, folder = _file_system(spark, path)
    return fs.exists(folder) and any(not f.getPath().getName().startswith(".") for f in fs.listStatus(folder))


def _is_complete(spark: SparkSession, path: str) -> bool:
    fs, marker = _file_system(spark, f"{path}/_SUCCESS")
    return fs.exists(marker)


def _discard(spark: SparkSession, path: str) -> None:
    fs, folder = _file_system(spark, path)
    fs.delete(folder, True)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _dynamic_overwrite(spark: SparkSession):
    """``insertInto`` takes the overwrite mode from the session only."""
    return _setting(spark, OVERWRITE_MODE, "dynamic")


# -- layout ----------------------------------------------------------------


def _laid_out(df: DataFrame, partition_by: str | None, sort_by: Sequence[str]) -> DataFrame:
    """Bring a partition's rows together, sorted for row-group pruning.

    ``rebalance`` lets AQE size the write tasks: small days share a task, a day
    larger than the advisory size is split over several.
    """
    df = df.hint("rebalance", partition_by) if partition_by else df.hint("rebalance")
    order = [*([partition_by] if partition_by else []), *[c for c in sort_by if c != partition_by]]
    return df.sortWithinPartitions(*order) if order else df


def _counted(laid_out: DataFrame) -> tuple[DataFrame, Observation]:
    """The frame with a count of its rows, taken by the tasks that write them.

    Above the exchange that lays the rows out: there a task counts once even if it is repeated.
    """
    seen = Observation()
    return laid_out.observe(seen, F.count(F.lit(1)).alias("rows")), seen


# -- whole-table writes ------------------------------------------------------


@contextmanager
def _whole_write(spark: SparkSession, table: str) -> Iterator[None]:
    """Mark a write that creates or replaces a table, so that one stopped half-way can be repeated.

    Such a stop leaves a folder that the catalog does not know and Spark refuses
    to write to. It is cleared only if this mark says that it is such a rest.
    """
    mark = f"{_staging_path(spark, table)}.writing"
    if path_exists(spark, mark) and not table_exists(spark, table):
        schema, _, name = table.rpartition(".")
        location = spark.catalog.getDatabase(schema or spark.catalog.currentDatabase()).locationUri
        _discard(spark, f"{location}/{name.lower()}")
    fs, folder = _file_system(spark, mark)
    fs.mkdirs(folder)
    yield
    _discard(spark, mark)


def overwrite_table(
    df: DataFrame, table: str, partition_by: str | None = None, sort_by: Sequence[str] = ()
) -> int:
    """Replace a table and return its row count, observed by the write itself.

    ``df`` must not read ``table`` itself.
    """
    spark = df.sparkSession
    counted, seen = _counted(_laid_out(df, partition_by, sort_by))
    writer = counted.write.format("parquet").mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    with _whole_write(spark, table):
        writer.saveAsTable(table)
    # A staged copy of the former contents has nothing left to repair.
    _discard(spark, _staging_path(spark, table))
    return seen.get["rows"]


def append_rows(df: DataFrame, table: str) -> None:
    spark = df.sparkSession
    writer = df.write.format("parquet").mode("append")
    if table_exists(spark, table):
        writer.saveAsTable(table)
    else:
        with _whole_write(spark, table):
            writer.saveAsTable(table)


# -- partial writes ----------------------------------------------------------


def _publish(spark: SparkSession, table: str, staged: str) -> None:
    target = current_table(spark, table)
    contents = spark.read.schema(target.schema).parquet(staged).select(*target.columns)
    with _dynamic_overwrite(spark):
        contents.write.mode("overwrite").insertInto(table)
    _discard(spark, staged)


def finish_pending(spark: SparkSession, table: str) -> bool:
    """Publish a staged copy left behind by a driver that died while publishing."""
    staged = _staging_path(spark, table)
    if not _is_complete(spark, staged):
        return False
    _publish(spark, table, staged)
    return True


def replace_partitions(
    df: DataFrame, table: str, partition_by: str | None, sort_by: Sequence[str] = (), values: Iterable = ()
) -> int:
    """Replace exactly the partitions that occur in ``df`` (or an unpartitioned table); returns the rows written.

    Partitions named in ``values`` that ``df`` has no row for are dropped.
    ``df`` may read ``table``; a staged copy left behind must not be pending.
    """
    spark = df.sparkSession
    staged = _staging_path(spark, table)
    counted, seen = _counted(_laid_out(df, partition_by, sort_by))
    writer = counted.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(staged)
    if values:
        # Dropped before publishing: a complete staged copy then finishes a run that stops in between.
        copy = spark.read.schema(df.schema).parquet(staged)
        filled = {r[0] for r in copy.select(partition_by).distinct().collect()}
        for value in sorted(set(values) - filled):
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({partition_by} = '{value}')")
    _publish(spark, table, staged)
    return seen.get["rows"]


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Update matching keys and insert the rest: source rows plus unmatched target rows.

    ``source`` must be unique per key.
    """
    kept = target.join(source.select(*keys), list(keys), "left_anti")
    return kept.select(*target.columns).unionByName(source.select(*target.columns))


def upsert(
    source: DataFrame,
    table: str,
    keys: Sequence[str],
    partition_by: str | None = None,
    newest_by: Sequence[str] = (),
    unique: bool = False,
    withdrawn: DataFrame | None = None,
) -> Written:
    """Create the table from ``source``, or update and insert its rows by key.

    The newest of several source rows with one key wins; ``unique`` says there
    are none and saves that exchange. Rows with a null key
    can never match and are left out; the landing scan reports them. When the
    partition column is one of the keys only the partitions present in the
    source are read and rewritten. Rows whose key is in ``withdrawn`` and not in
    the source are deleted; this needs a partition column.
    """
    if partition_by and partition_by not in keys:
        raise ValueError("the partition column must be a key, or a row could change partition")
    spark = source.sparkSession
    fresh = source.dropna(subset=list(keys))
    if not unique:
        fresh = latest_per_key(fresh, keys, newest_by)

    if not table_exists(spark, table):
        return Written(overwrite_table(fresh, table, partition_by, keys))

    finish_pending(spark, table)
    target = current_table(spark, table)
    # Read twice below; unlike a checkpoint this survives executor loss by
    # recomputing the lost blocks.
    fresh = fresh.select(*target.columns).persist()
    try:
        if partition_by:
            # One row per calendar day of the batch: bounded whatever its size.
            sizes = {r[0]: r[1] for r in fresh.groupBy(partition_by).count().collect()}
            if withdrawn is not None:
                withdrawn = withdrawn.select(*keys).dropna()
                sizes |= {r[0]: 0 for r in withdrawn.select(partition_by).distinct().collect() if r[0] not in sizes}
            touched = target.filter(F.col(partition_by).isin(list(sizes)))
            rows = sum(sizes.values())
        else:
            sizes, touched, rows = {}, target, fresh.count()
        if withdrawn is not None:
            touched = touched.join(withdrawn, list(keys), "left_anti")
        if rows or sizes:
            replace_partitions(merge_rows(touched, fresh, keys), table, partition_by, keys, sizes)
    finally:
        fresh.unpersist()
    return Written(rows, tuple(sorted(sizes)))


def file_sizes(spark: SparkSession, table: str, partition_by: str | None = None) -> DataFrame:
    """``partition, path, bytes`` of a table's data files, from their listing alone: no file is opened."""
    location = spark.sql(f"DESCRIBE EXTENDED {table}").filter("col_name = 'Location'").first().data_type
    kind = current_table(spark, table).schema[partition_by].dataType if partition_by else "string"
    with _setting(spark, TYPE_INFERENCE, "false"):
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(location)
    value = F.col(partition_by) if partition_by and partition_by in files.columns else F.lit(None)
    return files.select(value.cast(kind).alias("partition"), "path", F.col("length").alias("bytes"))


def scattered(spark: SparkSession, table: str, partition_by: str | None = None, small_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """``partition, files, bytes`` of the partitions in several files that are small on average."""
    sizes = file_sizes(spark, table, partition_by).groupBy("partition").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"))
    return sizes.filter((F.col("files") > 1) & (F.col("bytes") < small_bytes * F.col("files")))


def compact(
    spark: SparkSession,
    table: str,
    partition_by: str | None,
    cluster_by: Sequence[str] = (),
    since: str | None = None,
    small_bytes: int = SMALL_FILE_BYTES,
) -> tuple:
    """Rewrite partitions that lie in too many small files into well-sized ones, sorted by the clustering columns.

    Which ones is decided from the file listing; the others are neither read nor
    touched. ``since`` restricts the rewrite to partitions from that value on.
    Returns the partitions rewritten, ``(None,)`` for a table without partitions.
    """
    finish_pending(spark, table)
    poor = scattered(spark, table, partition_by, small_bytes)
    df = current_table(spark, table)
    if since is not None and partition_by:
        poor = poor.filter(F.col("partition") >= F.lit(since).cast(df.schema[partition_by].dataType))
    # At most one row for each calendar day.
    values = tuple(sorted((r[0] for r in poor.select("partition").collect()), key=str))
    if not values:
        return ()
    if partition_by:
        named = F.col(partition_by).isin([v for v in values if v is not None])
        df = df.filter(named | F.col(partition_by).isNull() if None in values else named)
    replace_partitions(df, table, partition_by, cluster_by)
    return values
