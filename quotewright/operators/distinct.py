"""Distinct counts that add up over days.

A count of distinct codes cannot be added over days, a set can. Every code has a
number, so the codes of a day are a bitmap, and the bitmaps of any days are
united by a bitwise or. Counts over 30 days, or the whole table, come from one small
record a day instead of the rows, without expanding each row once for every
distinct count; a changed day only replaces its own records.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Codes are numbered within so many hash groups, so no task sees all codes at once.
GROUPS = 64
#: Codes of one bitmap, as Spark's bitmap functions have it.
BITMAP_CODES = 32_768

_DICTIONARY = "code string, bucket long, place int"


def _numbered(codes: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """Codes with (bucket, place): the groups fill one bitmap each, then the next one."""
    group = F.pmod(F.xxhash64("code"), F.lit(GROUPS))
    dealt = codes.withColumn("group", group)
    if used is None:
        dealt = dealt.withColumn("used", F.lit(0).cast("long"))
    else:
        dealt = dealt.join(used, "group", "left").withColumn("used", F.coalesce("used", F.lit(0).cast("long")))
    number = F.row_number().over(Window.partitionBy("group").orderBy("code")) - 1 + F.col("used")
    numbered = dealt.withColumn("number", number)
    return numbered.select(
        "code",
        (F.floor(F.col("number") / BITMAP_CODES) * GROUPS + F.col("group")).cast("long").alias("bucket"),
        F.pmod("number", F.lit(BITMAP_CODES)).cast("int").alias("place"),
    )


def code_dictionary(codes: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``code, bucket, place`` for each distinct code of the column ``code``; null is no code.

    Codes of a ``known`` dictionary keep their numbers, new ones follow, so bitmaps made
    with the old one stay valid. ``known`` must be a stored table, or the numbers could change.
    """
    distinct = codes.select(F.col("code").cast("string")).dropna().distinct()
    if known is None:
        return _numbered(distinct)
    group = F.pmod("bucket", F.lit(GROUPS)).alias("group")
    used = known.groupBy(group).agg(F.count(F.lit(1)).alias("used"))
    return known.select("code", "bucket", "place").unionByName(_numbered(distinct.join(known, "code", "left_anti"), used))


def day_records(records: DataFrame, dictionary: DataFrame, day: str = "Date", code: str = "Code") -> DataFrame:
    """``day, bucket, records, codes``: the rows of each day and the bitmap of their codes, one record a bitmap.

    Rows without a code count in the bucket null, which has no codes. Rows are reduced
    to one a day and code in each task before they meet the dictionary. Codes that
    the dictionary does not hold raise no error but are missing in the sets; extend it first.
    """
    reduced = records.groupBy(F.col(day).alias("day"), F.col(code).cast("string").alias("code")).agg(F.count(F.lit(1)).alias("records"))
    numbered = reduced.join(dictionary, "code", "left")
    place = F.bitmap_bit_position(F.coalesce(F.col("place"), F.lit(0)).cast("long") + 1)
    return numbered.groupBy("day", "bucket").agg(
        F.sum("records").alias("records"),
        F.when(F.max("bucket").isNotNull(), F.bitmap_construct_agg(place)).alias("codes"),
    )


def _codes_in(bitmap: str):
    return F.coalesce(F.bitmap_count(bitmap), F.lit(0))


def counts_by_day(days: DataFrame) -> DataFrame:
    """``day, record_count, stock_count``."""
    return days.groupBy("day").agg(F.sum("records").alias("record_count"), F.sum(_codes_in("codes")).alias("stock_count"))


def counts_of_all(days: DataFrame) -> DataFrame:
    """One row over any set of days: ``last_day, days, stock_count, total_records``."""
    # The two reductions have different keys; each is a small aggregate of its own.
    by_day = days.groupBy("day").agg(F.sum("records").alias("records"))
    totals = by_day.agg(F.max("day").alias("last_day"), F.count("day").alias("days"), F.coalesce(F.sum("records"), F.lit(0)).alias("total_records"))
    united = days.groupBy("bucket").agg(F.bitmap_or_agg("codes").alias("codes"))
    codes = united.agg(F.coalesce(F.sum(_codes_in("codes")), F.lit(0)).alias("n"))
    return totals.withColumn("stock_count", codes.scalar())


def replace_days(days: DataFrame, fresh: DataFrame, changed: DataFrame) -> DataFrame:
    """The records after the days in ``changed`` (column ``day``) were counted anew; days left without rows go."""
    return days.join(changed.select("day").distinct(), "day", "left_anti").unionByName(fresh)
