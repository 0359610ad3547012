"""Physical plans on stored tables: what is read, exchanged and sorted."""

import re

import pytest

from quotewright.operators import attach_master, listing_to_silver, quotes_to_silver, sector_summary, stock_metrics
from quotewright.operators.calendar import calendar_gaps
from quotewright.operators.incremental import refreshed_metrics
from quotewright.operators.quality import quality_checks
from quotewright.operators.ranges import metrics_between, metrics_of_days
from quotewright.plans import reports, sqlfunctions
from quotewright.sinks import overwrite_table
from quotewright.sources import derived

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stored(spark):
    """Bronze, Silver and Gold tables of the last weeks, partitioned by day."""
    spark.sql("CREATE SCHEMA IF NOT EXISTS plans")
    records = derived.quote_records(spark, SF).filter("Date >= '2001-09-20'")
    overwrite_table(records, "plans.bronze", "Date", ["Code"])
    quotes = quotes_to_silver(spark.table("plans.bronze"))
    overwrite_table(quotes, "plans.silver", "trade_date", ["code"])
    listing = listing_to_silver(derived.listing_records(spark, SF))
    overwrite_table(attach_master(stock_metrics(spark.table("plans.silver")), listing), "plans.stocks", "trade_date", ["code"])
    return lambda name: spark.table(f"plans.{name}")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(plan):
    return [line for line in plan.splitlines() if "FileScan" in line]


@pytest.mark.parametrize(
    "report", [reports.market_kpis, reports.return_ranking, reports.top_turnover, reports.gainers_losers]
)
def test_latest_day_reports_prune_to_a_partition(stored, report):
    plan = plan_of(report(stored("stocks")))
    pruned = [s for s in scans(plan) if re.search(r"PartitionFilters: \[[^\]]*trade_date#\d+ = Subquery", s)]
    assert pruned
    # Other scans belong to the subquery for the newest day and read no data columns.
    assert all("ReadSchema: struct<>" in s for s in scans(plan) if s not in pruned)


def test_ranking_numbers_only_the_limited_rows(stored):
    plan = plan_of(reports.return_ranking(stored("stocks")))
    assert plan.index("Window [row_number()") < plan.index("TakeOrderedAndProject(limit=20")


def test_one_stock_reads_recent_days_and_its_row_groups(stored):
    (scan,) = scans(plan_of(reports.stock_series(stored("stocks"), "1", as_of="2001-11-01", days=10)))
    assert re.search(r"PartitionFilters: \[[^\]]*trade_date#\d+ >= 2001-10-22", scan)
    assert "EqualTo(code,1)" in scan
    assert "return_1d" not in scan.split("ReadSchema")[1]


def test_cleansing_filters_reach_the_scan(stored):
    (scan,) = scans(plan_of(quotes_to_silver(stored("bronze"), "2001-10-01", "2001-10-05")))
    assert re.search(r"PartitionFilters: \[[^\]]*Date#\d+ >= 2001-10-01\), \(Date#\d+ <= 2001-10-05", scan)
    assert "GreaterThan(AdjustmentClose,0.0)" in scan and "GreaterThanOrEqual(AdjustmentVolume,0.0)" in scan


def test_gap_report_reads_only_its_days(stored):
    plan = plan_of(calendar_gaps(stored("bronze"), "2001-11-01"))
    (scan,) = scans(plan)
    assert re.search(r"PartitionFilters: \[[^\]]*Date#\d+ >= 2001-09-17", scan) and "ReadSchema: struct<>" in scan


def test_duplicate_check_reads_the_key_only(stored):
    plan = plan_of(quality_checks(stored("silver"), "t"))
    schemas = [s.split("ReadSchema: ")[1] for s in scans(plan)]
    assert len(schemas) == 2 and "struct<code:string>" in schemas
    # The row checks need no exchange by key, only the final merge of one row per task.
    assert plan.count("Exchange hashpartitioning") == 1


def test_refresh_prunes_the_recent_scan(spark, stored):
    changes = stored("silver").filter("trade_date >= '2001-11-01'").select("code", "trade_date")
    plan = plan_of(refreshed_metrics(stored("silver"), changes, lookback_days=20))
    bounded = [s for s in scans(plan) if re.search(r"trade_date#\d+ (>=|<) date_add\(Subquery", s)]
    assert len(bounded) >= 3


def test_large_listing_is_not_broadcast(spark, stored):
    listing = listing_to_silver(derived.listing_records(spark, SF))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        metrics = stock_metrics(stored("silver"))
        plan = plan_of(attach_master(metrics, listing.persist()))
        assert "SortMergeJoin" in plan
        # Bars are exchanged once, for the windows; the join reuses that layout.
        bars = plan[plan.index("SortMergeJoin") :].split("InMemoryTableScan")[0]
        assert bars.count("Exchange hashpartitioning(code") <= 2
        listing.unpersist()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_sector_totals_are_reduced_before_the_exchange(stored):
    plan = plan_of(sector_summary(stored("stocks")))
    assert plan.index("Exchange hashpartitioning(trade_date") < plan.index("partial_avg")


@pytest.mark.parametrize("metrics", [metrics_of_days, lambda quotes: metrics_between(quotes, "2001-10-01", "2001-10-05")])
def test_indicators_of_days_trim_before_the_only_exchange(stored, metrics):
    plan = plan_of(metrics(stored("silver")))
    # Other exchanges belong to the subquery for the newest day, one row a task.
    assert plan.count("Exchange hashpartitioning") == plan.count("Exchange hashpartitioning(code") == 1
    # Printed from the sink down: the trim of each task stands below the exchange.
    below = plan[plan.index("Exchange hashpartitioning(code") :]
    assert "WindowGroupLimit" in below and ", Partial" in below


class Stored:
    stocks, sectors = "plans.stocks", "plans.sectors"


@pytest.fixture(scope="module")
def functions(spark, stored):
    overwrite_table(sector_summary(stored("stocks")), Stored.sectors, "trade_date", ["sector17_name"])
    made = sqlfunctions.register_reports(spark, Stored, prefix="stored_")
    assert made == [f"stored_{name}" for name in sqlfunctions.NAMES]
    return stored


def text_of(df):
    return sorted(map(repr, df.collect()))


CALLS = {
    "return_ranking(20)": lambda t: reports.return_ranking(t("stocks")),
    "return_ranking(top => 3, as_of => DATE '2001-10-30')": lambda t: reports.return_ranking(t("stocks"), 3, "2001-10-30"),
    "top_turnover(2)": lambda t: reports.top_turnover(t("stocks"), 2),
    "ma_deviation_movers(as_of => DATE '2001-10-30')": lambda t: reports.ma_deviation_movers(t("stocks"), as_of="2001-10-30"),
    "gainers_losers(1, DATE '2001-10-30')": lambda t: reports.gainers_losers(t("stocks"), 1, "2001-10-30"),
    "volatility_vs_return(1.0D, as_of => DATE '2001-10-30')": lambda t: reports.volatility_vs_return(t("stocks"), min_turnover=1.0, as_of="2001-10-30"),
    "market_kpis()": lambda t: reports.market_kpis(t("stocks")),
    "stock_series('1', DATE '2001-11-01', 10)": lambda t: reports.stock_series(t("stocks"), "1", "2001-11-01", 10),
    "market_turnover(DATE '2001-11-01', 9)": lambda t: reports.market_turnover(t("stocks"), "2001-11-01", 9),
    "curated_stocks(DATE '2001-11-01', 5)": lambda t: reports.curated_view(t("stocks"), "2001-11-01", 5),
    "sector_latest()": lambda t: reports.sector_latest(t("sectors")),
    "sector_recent()": lambda t: reports.sector_recent(t("sectors")),
}


@pytest.mark.parametrize("call", CALLS)
def test_sql_functions_equal_their_reports(spark, functions, call):
    got = spark.sql(f"SELECT * FROM stored_{call}")
    want = CALLS[call](functions)
    assert got.columns == want.columns
    assert text_of(got) == text_of(want) != []


def test_every_sql_function_is_compared():
    assert {call.split("(")[0] for call in CALLS} == set(sqlfunctions.NAMES)


def test_sql_functions_prune_and_limit(spark, functions):
    plan = plan_of(spark.sql("SELECT * FROM stored_return_ranking(20)"))
    data = [s for s in scans(plan) if "ReadSchema: struct<>" not in s]
    assert data and all(re.search(r"PartitionFilters: \[[^\]]*trade_date#\d+ = (coalesce\([^\]]*)?Subquery", s) for s in data)
    assert "TakeOrderedAndProject(limit=20" in plan or "WindowGroupLimit" in plan
    (scan,) = [s for s in scans(plan_of(spark.sql("SELECT * FROM stored_stock_series('1', DATE '2001-11-01', 10)"))) if "code" in s]
    assert "EqualTo(code,1)" in scan and "2001-10-22" in scan


def test_sql_arguments_are_values(spark, functions):
    assert spark.sql("SELECT * FROM stored_stock_series(:code)", args={"code": "1' OR '1'='1"}).isEmpty()
    assert spark.sql("SELECT * FROM stored_return_ranking(0)").isEmpty()


def test_bronze_stats_neither_expands_nor_sorts_rows(spark):
    rows = spark.createDataFrame([("2000-01-03", "1"), ("2000-01-03", "1"), ("2000-01-04", None), (None, "2")], "Date string, Code string")
    stats = reports.bronze_stats(rows)
    assert not re.search(r"\bExpand\b|\bSort \[", plan_of(stats))
    assert [tuple(r) for r in stats.collect()] == [("2000-01-04", 2, 2, 4)]
    assert [tuple(r) for r in reports.bronze_stats(rows.limit(0)).collect()] == [(None, 0, 0, 0)]
