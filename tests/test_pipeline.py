"""The composed jobs on landed files derived from the test tables."""

import json
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from quotewright.operators import attach_master, listing_to_silver, quotes_to_silver, sector_summary, stock_metrics
from quotewright.operators.quality import QualityGateError
from quotewright.plans.pipeline import PipelineConfig, refresh_listing, run
from quotewright.sources import derived
from quotewright.sources.catalog import TableNames, list_tables, table_exists

SF = "/root/testdata/sf0.001"
SINCE = "2001-09-10"
CUTS = ("2001-10-01", "2001-10-20")


def same_rows(left, right):
    columns = sorted(right.columns)
    left, right = left.select(columns), right.select(columns)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def names_for(tag):
    return TableNames(f"{tag}_bronze", f"{tag}_silver", f"{tag}_gold")


def land(df, folder, name, layout="lines"):
    """One landed file per call, as the outside fetcher would leave it."""
    rows = [json.loads(r) for r in df.toJSON().collect()]
    path = Path(folder)
    path.mkdir(parents=True, exist_ok=True)
    text = json.dumps(rows, indent=2) if layout == "array" else "\n".join(json.dumps(r) for r in rows)
    (path / f"{name}.json").write_text(text)


@pytest.fixture(scope="module")
def records(spark):
    df = derived.quote_records(spark, SF).filter(F.col("Date") >= SINCE).persist()
    df.count()
    return df


@pytest.fixture(scope="module")
def listing(spark):
    return derived.listing_records(spark, SF).filter("Code <> '3'")


def expected_gold(records, listing):
    metrics = stock_metrics(quotes_to_silver(records))
    stocks = attach_master(metrics, listing_to_silver(listing))
    return metrics, stocks, sector_summary(stocks)


def check_gold(spark, names, records, listing):
    metrics, stocks, sectors = expected_gold(records, listing)
    assert same_rows(spark.table(names.metrics).drop("_gold_updated_at"), metrics)
    assert same_rows(spark.table(names.stocks).drop("_gold_updated_at"), stocks)

    def rounded(df):
        return df.select(*[F.round(c, 6).alias(c) if c.startswith(("avg", "total")) else c for c in sectors.columns])

    assert same_rows(rounded(spark.table(names.sectors)), rounded(sectors))


def test_runs_equal_a_rebuild(spark, folder, records, listing):
    # Array files, the layout an outside fetcher writes one month at a time.
    names, layout = names_for("inc"), "array"
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", layout, names, checkpoint=f"{folder}/cp")
    land(listing, config.listing_path, "all", layout)
    land(records.filter(F.col("Date") < CUTS[0]), config.quotes_path, "history", layout)

    first = run(spark, config, ingestion_date="2001-06-01")
    assert first.mode == "initial" and first.quality_passed
    assert first.loaded.bronze_rows == records.filter(F.col("Date") < CUTS[0]).count()
    assert {"stock_metrics", "stock_with_master", "sector_summary"} <= {
        r.table_name for r in list_tables(spark, names.gold).collect()
    }

    land(records.filter(F.col("Date").between(*CUTS)), config.quotes_path, "next", layout)
    second = run(spark, config, ingestion_date="2001-10-21")
    assert second.mode == "incremental"
    # Only bars from the new days on were recomputed.
    assert 0 < second.gold_rows["stock_metrics"] < spark.table(names.metrics).count()
    check_gold(spark, names, records.filter(F.col("Date") <= CUTS[1]), listing)

    assert run(spark, config).mode == "up_to_date"

    # A correction of old days and the remaining days arrive together.
    corrected = records.filter("Date between '2001-09-20' and '2001-09-27'")
    corrected = corrected.withColumn("AdjustmentClose", F.col("AdjustmentClose") + 1)
    land(corrected, config.quotes_path, "correction", layout)
    land(records.filter(F.col("Date") > CUTS[1]), config.quotes_path, "rest", layout)
    run(spark, config, ingestion_date="2001-11-05")
    final = records.join(corrected, ["Date", "Code"], "left_anti").unionByName(corrected)
    check_gold(spark, names, final, listing)
    assert same_rows(spark.table(names.bronze_quotes).select(records.columns), final)
    log = spark.table(names.quality_log)
    assert log.count() == 24 and log.filter("not passed").isEmpty()


def test_listing_change_rewrites_joined_tables(spark, folder, records, listing):
    names = names_for("lst")
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp")
    land(listing, config.listing_path, "a")
    land(records, config.quotes_path, "a")
    run(spark, config, ingestion_date="2001-11-05")
    moved = listing.withColumn("Sector17CodeName", F.lit("MOVED")).withColumn("Date", F.lit("2001-11-06"))
    land(moved.filter("Code = '1'"), config.listing_path, "b")
    assert run(spark, config, refresh_master=False).mode == "up_to_date"
    result = run(spark, config, ingestion_date="2001-11-06")
    assert result.mode == "incremental" and result.gold_rows["stock_metrics"] == 0
    current = listing.filter("Code <> '1'").unionByName(moved.filter("Code = '1'"))
    check_gold(spark, names, records, current)


def test_gate_stops_gold_but_keeps_the_log(spark, folder, records, listing):
    names = names_for("gate")
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp")
    land(listing, config.listing_path, "a")
    bad = records.filter("Date < '2001-09-20'").withColumn("AdjustmentHigh", F.col("AdjustmentLow") - 1)
    land(bad, config.quotes_path, "bad")
    with pytest.raises(QualityGateError, match="high_gte_low"):
        run(spark, config)
    assert not table_exists(spark, names.metrics)
    assert spark.table(names.quality_log).filter("not passed").count() == 1
    # The corrected file completes what the failed run left open.
    land(records.filter("Date < '2001-09-20'"), config.quotes_path, "good")
    run(spark, config)
    check_gold(spark, names, records.filter("Date < '2001-09-20'"), listing)


def test_several_batches_in_one_run(spark, folder, records, listing):
    names = names_for("many")
    config = PipelineConfig(
        f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp", max_files_per_batch=1
    )
    some = records.filter("Date < '2001-09-24'")
    land(listing, config.listing_path, "a")
    land(some.filter("Date < '2001-09-18'"), config.quotes_path, "1")
    # Overlaps both neighbours, so batches update what others inserted.
    land(some.filter("Date between '2001-09-15' and '2001-09-20'"), config.quotes_path, "2")
    land(some.filter("Date >= '2001-09-18'"), config.quotes_path, "3")
    result = run(spark, config)
    assert result.mode == "initial" and result.loaded.bronze_rows > some.count()
    assert same_rows(spark.table(names.bronze_quotes).select(records.columns), some)
    check_gold(spark, names, some, listing)


def test_rejects_are_kept(spark, folder, records, listing):
    names = names_for("rej")
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp")
    land(listing, config.listing_path, "a")
    good = records.filter("Date < '2001-09-20'")
    land(good, config.quotes_path, "good")
    lines = [
        '{"Date": "1995-13-01", "Code": "1", "AdjustmentClose": 1.0}',
        '{"Date": "1995-01-02", "AdjustmentClose": 1.0}',
        '{"Code": "1", "AdjustmentClose": 1.0}',
        '{"Date": "1995-01-02", "Code": ',
    ]
    (Path(config.quotes_path) / "bad.json").write_text("\n".join(lines))
    result = run(spark, config)
    assert result.loaded.rejected_rows == 4
    assert {r.reason for r in spark.table(names.rejected_records).collect()} == {
        "missing code",
        "missing date",
        "unreadable date",
        "malformed record",
    }
    assert spark.table(names.bronze_quotes).count() == good.count()
    assert spark.table(names.bronze_quotes).filter(F.col("_source_file").endswith("good.json")).count() == good.count()


def test_listing_rows_held_in_memory(spark):
    from quotewright.sources.landing import listing_from_rows

    names = names_for("mem")
    rows = [{"Date": "2024-01-05", "Code": "7203", "CompanyName": "A"}, {"Date": "2024-01-05", "CompanyName": "no code"}]
    assert refresh_listing(spark, listing_from_rows(spark, rows), names, date(2024, 1, 5)) == 1
    newer = [{"Date": "2024-02-05", "Code": "7203", "CompanyName": "B"}, {"Date": "2024-02-05", "Code": "9984"}]
    assert refresh_listing(spark, listing_from_rows(spark, newer), names) == 2
    assert spark.table(names.silver_listing).filter("code = '7203'").first().company_name == "B"


def test_first_run_without_a_listing_and_a_later_one_with_rejects(spark, folder, records, listing):
    names = names_for("nolist")
    config = PipelineConfig(f"{folder}/quotes", None, "lines", names, checkpoint=f"{folder}/cp")
    land(records, config.quotes_path, "history")
    run(spark, config)
    assert spark.table(names.stocks).filter("company_name is not null").isEmpty()
    land(listing, f"{folder}/listing", "all")
    (Path(folder) / "listing" / "bad.json").write_text('{"CompanyName": "no code"}\nnot json')
    config = PipelineConfig(config.quotes_path, f"{folder}/listing", "lines", names, checkpoint=config.checkpoint)
    run(spark, config)
    check_gold(spark, names, records, listing)
    assert run(spark, config).mode == "up_to_date"
    assert sorted(r.reason for r in spark.table(names.rejected_records).collect()) == ["malformed record", "missing code"]


def test_progress_of_a_load_belongs_to_its_landing_path_and_table(spark, folder):
    paths = {PipelineConfig(q, names=n).checkpoint_in(spark) for q in ("/a", "/b") for n in (names_for("x"), names_for("y"))}
    assert len(paths) == 4


def test_withdrawn_quotes_leave_silver_and_gold(spark, folder, records, listing):
    names = names_for("gone")
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp")
    land(listing, config.listing_path, "all")
    land(records, config.quotes_path, "history")
    run(spark, config)
    codes = [r.code for r in spark.table(names.silver_quotes).select("code").distinct().orderBy("code").limit(2).collect()]
    one_day = spark.table(names.silver_quotes).agg(F.max("trade_date")).first()[0]
    # Some bars of one code, and all bars of the newest day, whose partition goes.
    lost = (F.col("Code") == codes[0]) & F.col("Date").between("2001-09-20", "2001-10-05") | (F.col("Date") == str(one_day))
    # toJSON leaves nulls out, so a price of zero stands for the withdrawn one.
    corrected = records.filter(lost).withColumn("AdjustmentClose", F.lit(0.0))
    assert not corrected.isEmpty()
    land(corrected, config.quotes_path, "withdrawn")
    assert run(spark, config).mode == "incremental"
    final = records.filter(~lost).unionByName(corrected)
    assert same_rows(spark.table(names.silver_quotes).drop("_silver_updated_at"), quotes_to_silver(final))
    assert spark.table(names.sectors).filter(F.col("trade_date") == F.lit(one_day)).isEmpty()
    check_gold(spark, names, final, listing)
    # Brought back, they are there again.
    land(records.filter(lost), config.quotes_path, "back")
    run(spark, config)
    check_gold(spark, names, records, listing)


@pytest.mark.parametrize("table", ["bronze_quotes", "stocks", "pending_changes"])
def test_whole_writes_stopped_half_way_are_completed(spark, folder, records, listing, monkeypatch, table):
    names = names_for(f"stop_{table}")
    config = PipelineConfig(f"{folder}/quotes", f"{folder}/listing", names=names, checkpoint=f"{folder}/cp")
    some = records.filter("Date < '2001-09-24'")
    land(listing, config.listing_path, "a")
    land(some, config.quotes_path, "a")
    stopped, save = getattr(names, table), DataFrameWriter.saveAsTable

    def stop(self, name, *args, **kwargs):
        save(self, name, *args, **kwargs)
        if name == stopped:
            # What a driver leaves that dies before the table is known: its files alone.
            short = name.rpartition(".")[2]
            root = Path(spark.table(name).inputFiles()[0].removeprefix("file://").split(f"/{short}/")[0]) / short
            spark.sql(f"DROP TABLE {name}")
            root.mkdir(parents=True)
            (root / "part-rest.parquet").write_text("half")
            raise RuntimeError("stopped")

    monkeypatch.setattr(DataFrameWriter, "saveAsTable", stop)
    with pytest.raises(Exception, match="stopped"):
        run(spark, config)
    monkeypatch.undo()
    run(spark, config)
    check_gold(spark, names, some, listing)
    assert run(spark, config).mode == "up_to_date"
