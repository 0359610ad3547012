"""Landed JSON records: batch and streaming scans, audit columns, rejects."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quotewright.functions import as_date, rows_so_far
from quotewright.schemas import LISTING_RECORD, QUOTE_RECORD

UNPARSED = "_corrupt_record"
SOURCE_FILE = "_source_file"


def _options(layout: str) -> dict[str, str]:
    """Reader options for ``lines`` (one record per line) or ``array`` files.

    With ``array`` a file is read by a single task; ``read_array`` and the ingest
    split large ones over tasks. JSON Lines files always split.
    """
    if layout not in ("lines", "array"):
        raise ValueError(f"unknown layout {layout!r}: use 'lines' or 'array'")
    return {
        "multiLine": str(layout == "array").lower(),
        "columnNameOfCorruptRecord": UNPARSED,
        "mode": "PERMISSIVE",
    }


def _with_unparsed(record: T.StructType) -> T.StructType:
    return T.StructType([*record.fields, T.StructField(UNPARSED, T.StringType())])


def read_records(
    spark: SparkSession, path: str, record: T.StructType = QUOTE_RECORD, layout: str = "lines"
) -> DataFrame:
    """Scan landed files with a declared schema, keeping the file of each record."""
    reader = spark.read.schema(_with_unparsed(record)).options(**_options(layout))
    return reader.json(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


#: What stands where a record begins: an unescaped quote with a name behind it opens a key. Inside a
#: string such a quote would end the string, and no name can follow there.
_RECORD_BEGINS = r'^\s*[\[,]?\s*\{\s*"[A-Za-z_]\w*"\s*:'


def _joined_pieces(pieces: str) -> Column:
    """The pieces (place, value) of one record in their order, with the braces that parted them."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(pieces)), lambda p: p["value"]), "}")


def _pieces(texts: DataFrame) -> DataFrame:
    return texts.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")


def read_array(spark: SparkSession, path: str, record: T.StructType = QUOTE_RECORD) -> DataFrame:
    """Scan files that hold one JSON array each, every file by as many tasks as it has blocks.

    Same columns as ``read_records``. The files are read as text that is parted by closing braces,
    which splits at any byte. In a file where each piece but the last begins a record, and the last is the
    end of the array, every piece is a record: only those of other files are exchanged to be put together.
    """
    pieces = _pieces(spark.read.option("lineSep", "}").text(path))
    plain = F.broadcast(_plain_files(pieces))
    single = pieces.join(plain, "file", "left_semi").filter(F.col("value").rlike(_RECORD_BEGINS))
    joined = _joined_records(pieces.join(plain, "file", "left_anti"))
    return _parsed(single.select("file", F.concat("value", F.lit("}")).alias("value")).union(joined), record)


def _plain_files(pieces: DataFrame) -> DataFrame:
    """The files in which the only piece that begins no record is the last one, the end of the array."""
    other = ~F.col("value").rlike(_RECORD_BEGINS)
    place = F.col("place")
    blocks = pieces.withColumn("place", F.monotonically_increasing_id()).groupBy("file", "block").agg(
        F.count(F.when(other, True)).alias("others"),
        F.max("place").alias("last"),
        F.max(F.when(other & F.col("value").rlike(r"^\s*\]\s*$"), place)).alias("end"),
    )
    files = blocks.groupBy("file").agg(F.sum("others").alias("others"), F.max(F.struct("block", "last", "end")).alias("of"))
    return files.filter("others = 1 AND of.last = of.end").select("file")


def stream_pieces(spark: SparkSession, path: str, max_files_per_batch: int | None = None) -> DataFrame:
    """The pieces of array files as they arrive; a batch of them goes to ``records_of_pieces``."""
    reader = spark.readStream.option("lineSep", "}").option("maxFileAge", "36500d")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return _pieces(reader.text(path))


def records_of_pieces(pieces: DataFrame, record: T.StructType = QUOTE_RECORD) -> DataFrame:
    """Records of array files from their pieces ``file, block, value``, in the order in which tasks read them.

    A piece that begins with a key opens a record; others,
    cut off by a brace inside a string or a nested object, go on with the record before them. Pieces
    are put together within their block, and only the first and last record of each block
    with those of the neighbouring blocks.

    Records have at least one key, and none of their fields is an array of objects. A record
    that does not parse is one malformed record; the others of its file are kept, while the
    multi-line reader gives up the whole file. What stands between records is dropped.
    """
    return _parsed(_joined_records(pieces), record)


def _joined_records(pieces: DataFrame) -> DataFrame:
    """``file, value``: the text of each record, put together from its pieces."""
    pieces = pieces.withColumn("place", F.monotonically_increasing_id())
    of_block = Window.partitionBy("file", "block").orderBy("place")
    begun = F.last(F.when(F.col("value").rlike(_RECORD_BEGINS), F.col("place")), ignorenulls=True).over(rows_so_far(of_block))
    records = pieces.withColumn("begun", begun).groupBy("file", "block", "begun").agg(
        F.min("place").alias("place"), _joined_pieces(F.struct("place", "value")).alias("value")
    )
    # One record of each block may go on in the next one, and what a block begins with may belong to the one before.
    last = F.lead("place").over(of_block).isNull()
    records = records.withColumn("edge", F.col("begun").isNull() | last)
    inner = records.filter(~F.col("edge")).select("file", F.concat("value", F.lit("}")).alias("value"))
    of_file = Window.partitionBy("file").orderBy("block", "place")
    opened = F.last(F.when(F.col("begun").isNotNull(), F.struct("block", "begun")), ignorenulls=True).over(rows_so_far(of_file))
    edges = (
        records.filter("edge")
        .withColumns({"opened": opened, "tail": F.lead("place").over(of_file).isNull()})
        .groupBy("file", "opened")
        .agg(F.max("tail").alias("tail"), _joined_pieces(F.struct(F.struct("block", "place").alias("place"), "value")).alias("value"))
    )
    # Behind the last brace of a file comes the end of the array; other records end with their brace.
    ended = F.when(F.col("tail"), F.regexp_replace("value", r"\s*\]?\s*$", "")).otherwise(F.concat("value", F.lit("}")))
    return inner.union(edges.select("file", ended.alias("value")))


def _parsed(whole: DataFrame, record: T.StructType) -> DataFrame:
    text = F.regexp_replace("value", r"^\s*[\[,]?\s*", "")
    options = {"columnNameOfCorruptRecord": UNPARSED, "mode": "PERMISSIVE"}
    parsed = F.from_json("value", _with_unparsed(record), options)
    whole = whole.select("file", text.alias("value")).filter("value != ''")
    return whole.select(F.inline(F.array(parsed)), F.col("file").alias(SOURCE_FILE))


def stream_records(
    spark: SparkSession,
    path: str,
    record: T.StructType = QUOTE_RECORD,
    layout: str = "lines",
    max_files_per_batch: int | None = None,
) -> DataFrame:
    """The same scan as a stream over files as they arrive.

    A file is taken once per path, so corrected records must land under a new
    name. By default the file source skips files a week older than the newest
    one it has seen; a late backfill file must not be lost that way.
    """
    reader = spark.readStream.schema(_with_unparsed(record)).options(**_options(layout))
    reader = reader.option("maxFileAge", "36500d")
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    return reader.json(path).withColumn(SOURCE_FILE, F.col("_metadata.file_path"))


def quotes_from_text(lines: DataFrame, column: str = "value") -> DataFrame:
    """Quote records from a column that already holds one JSON object per row.

    ``inline`` keeps later filters above the parse; as a plain projection Spark
    would copy the parse into each of them and run it several times per row.
    """
    return lines.select(F.inline(F.array(F.from_json(column, QUOTE_RECORD))))


def listing_from_rows(spark: SparkSession, rows: Iterable[Mapping[str, str]]) -> DataFrame:
    """A listing the caller holds in memory; large ones should be landed as files."""
    names = LISTING_RECORD.names
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], LISTING_RECORD)


def with_audit(
    records: DataFrame,
    ingestion_date: date | str | None = None,
    loaded_at: datetime | str | None = None,
) -> DataFrame:
    """Add the ingestion day (text) and the load time."""
    day = F.current_date() if ingestion_date is None else F.lit(str(ingestion_date)).cast("date")
    stamp = F.current_timestamp() if loaded_at is None else F.lit(str(loaded_at)).cast("timestamp")
    return records.withColumns(
        {"_ingestion_date": F.date_format(day, "yyyy-MM-dd"), "_loaded_at": stamp}
    )


def _reason(records: DataFrame, dated: bool) -> Column:
    reason = F.when(F.col("Code").isNull(), "missing code")
    if dated:
        reason = reason.when(F.col("Date").isNull(), "missing date").when(
            as_date("Date").isNull(), "unreadable date"
        )
    if UNPARSED in records.columns:
        # First test: a record that did not parse has no usable fields at all.
        return F.when(F.col(UNPARSED).isNotNull(), "malformed record").otherwise(reason)
    return reason


def split_records(records: DataFrame, dated: bool = True) -> tuple[DataFrame, DataFrame]:
    """Separate records with a usable key from those that cannot be keyed.

    Returns ``(accepted, rejected)``; every input row is in exactly one of them.
    Rejects keep the record as text beside the reason.
    """
    judged = records.withColumn("_reason", _reason(records, dated))
    accepted = judged.filter(F.col("_reason").isNull()).drop("_reason", UNPARSED)
    payload = [c for c in records.columns if not c.startswith("_")]
    as_text = F.to_json(F.struct(*payload))
    if UNPARSED in records.columns:
        as_text = F.coalesce(F.col(UNPARSED), as_text)
    rejected = judged.filter(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"),
        as_text.alias("record"),
        *[c for c in (SOURCE_FILE, "_ingestion_date", "_loaded_at") if c in records.columns],
    )
    return accepted, rejected
