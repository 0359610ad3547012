"""Quotes and listings derived from order line items and suppliers.

Lets every operator run on the TPC-H style tables: each supplier is an
instrument, each ship date a trading day, each line item a trade.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quotewright.schemas import LISTING_RECORD, QUOTE_RECORD

# Fixed values of the derivation: the split date, the instruments that split,
# the factor, and the days of the month whose bars are spoilt on purpose.
SPLIT_DATE = "1998-01-01"
SPLIT_EVERY = 10
SPLIT_FACTOR = 2.0
DAY_NULL_CLOSE, DAY_ZERO_CLOSE, DAY_NULL_VOLUME = 13, 14, 15


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(
        F.col("l_shipdate").cast("date").alias("trade_date"),
        F.col("l_suppkey").alias("instrument"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 1_000_000 + F.col("l_partkey")).alias("seq"),
    )


def _total(amount: Column) -> Column:
    """Exact sum of two-decimal amounts, in whole hundredths."""
    return F.sum(F.floor(amount * 100 + 0.5))


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open, high, low, close, volume and turnover per (trade_date, code)."""
    return (
        _trades(spark, sf_dir).groupBy("trade_date", "instrument")
        .agg(
            F.min_by("price", "seq").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "seq").alias("close"),
            (_total(F.col("quantity")) / 100).alias("volume"),
            (_total(F.col("price") * F.col("quantity")) / 100).alias("turnover_value"),
        )
        .withColumn("code", F.col("instrument").cast("string"))
        .drop("instrument")
    )


def _bars_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same bars with their ``month``, each month in one task and in the order of date and code.

    The trades are exchanged once, by month, and their one sort also serves what goes on by month.
    """
    dealt = _trades(spark, sf_dir).withColumn("month", F.date_format("trade_date", "yyyy-MM")).repartition("month")
    keyed = dealt.select(
        "month", F.date_format("trade_date", "yyyy-MM-dd").alias("day"), F.col("instrument").cast("string").alias("code"), "price", "quantity", "seq"
    )
    ordered = Window.partitionBy("month", "day", "code").orderBy("seq")
    bar = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    amounts = {
        "open": F.min_by("price", "seq").over(bar),
        "high": F.max("price").over(bar),
        "low": F.min("price").over(bar),
        "close": F.max_by("price", "seq").over(bar),
        "volume": _total(F.col("quantity")).over(bar) / 100,
        "turnover_value": _total(F.col("price") * F.col("quantity")).over(bar) / 100,
        "later": F.lead(F.lit(1)).over(ordered),
    }
    return keyed.select("month", "day", "code", *[c.alias(name) for name, c in amounts.items()]).filter("later IS NULL").drop("later")


def quote_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars in the landed quote layout, with a split and spoilt bars."""
    dated = F.date_format("trade_date", "yyyy-MM-dd")
    return _as_records(bars(spark, sf_dir), dated)


def monthly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``quote_records`` with their ``month``, dealt and ordered as ``land_arrays`` needs them."""
    dated = _bars_by_month(spark, sf_dir).withColumn("trade_date", F.to_date("day"))
    return _as_records(dated, F.col("day"))


def _as_records(bars: DataFrame, dated: Column) -> DataFrame:
    """Bars with the fields of a quote record, of which ``dated`` is the date as text, in the place of their own but the month."""
    day = F.dayofmonth("trade_date")
    splits = (F.col("code").cast("int") % SPLIT_EVERY == 0) & (
        F.col("trade_date") < F.lit(SPLIT_DATE).cast("date")
    )
    factor = F.when(splits, F.lit(SPLIT_FACTOR)).otherwise(F.lit(1.0))
    adjusted_close = (
        F.when(day == DAY_NULL_CLOSE, F.lit(None).cast("double"))
        .when(day == DAY_ZERO_CLOSE, F.lit(0.0))
        .otherwise(F.col("close") * F.col("factor"))
    )
    adjusted_volume = F.when(day != DAY_NULL_VOLUME, F.col("volume") / F.col("factor"))
    columns = {
        "Date": dated,
        "Code": F.col("code"),
        "Open": F.col("open"),
        "High": F.col("high"),
        "Low": F.col("low"),
        "Close": F.col("close"),
        "Volume": F.col("volume"),
        "TurnoverValue": F.col("turnover_value"),
        "AdjustmentFactor": F.col("factor"),
        "AdjustmentOpen": F.col("open") * F.col("factor"),
        "AdjustmentHigh": F.col("high") * F.col("factor"),
        "AdjustmentLow": F.col("low") * F.col("factor"),
        "AdjustmentClose": adjusted_close,
        "AdjustmentVolume": adjusted_volume,
    }
    kept = [c for c in bars.columns if c == "month"]
    return bars.withColumn("factor", factor).select(*kept, *[columns[f.name].alias(f.name) for f in QUOTE_RECORD])


def listing_records(spark: SparkSession, sf_dir: str, snapshot: str = "2000-06-30") -> DataFrame:
    """All suppliers as listing records of one snapshot."""
    supplier = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    region = spark.read.parquet(f"{sf_dir}/region.parquet")
    joined = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    columns = {
        "Date": F.lit(snapshot),
        "Code": F.col("s_suppkey").cast("string"),
        "CompanyName": F.col("s_name"),
        "CompanyNameEnglish": F.col("s_name"),
        "Sector17Code": F.col("n_nationkey").cast("string"),
        "Sector17CodeName": F.col("n_name"),
        "Sector33Code": F.col("n_nationkey").cast("string"),
        "Sector33CodeName": F.col("n_name"),
        "ScaleCategory": F.when(F.col("s_acctbal") >= 5000, "Large").otherwise("Small"),
        "MarketCode": F.col("r_regionkey").cast("string"),
        "MarketCodeName": F.col("r_name"),
    }
    return joined.select(*[columns[f.name].alias(f.name) for f in LISTING_RECORD])


def listing_snapshots(
    spark: SparkSession, sf_dir: str, newer: str = "2000-06-30", older: str = "1999-06-30"
) -> DataFrame:
    """The current snapshot together with an outdated one."""
    current = listing_records(spark, sf_dir, newer)
    outdated = current.withColumn("Date", F.lit(older)).withColumn(
        "CompanyName", F.concat("CompanyName", F.lit(" (old)"))
    )
    return current.unionByName(outdated)


def land_arrays(records: DataFrame, path: str) -> None:
    """Write quote records, with their ``month`` or without, as landed files, one JSON array for each month."""
    if "month" not in records.columns:
        records = records.withColumn("month", F.substring("Date", 1, 7))
    of_month = Window.partitionBy("month").orderBy("Date", "Code")
    first, last = F.lag("Date").over(of_month).isNull(), F.lead("Date").over(of_month).isNull()
    line = F.concat(
        F.when(first, "[\n").otherwise(",\n"), F.to_json(F.struct(*QUOTE_RECORD.names)), F.when(last, "\n]").otherwise("")
    )
    months = records.select("month", line.alias("value"))
    # The windows leave each month in one task, in order.
    months.write.partitionBy("month").text(path)
