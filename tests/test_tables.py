"""Writes to catalog tables, and the landed-file scans."""

import json
import os
import random
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from quotewright.schemas import QUOTE_RECORD
from quotewright.sinks import append_rows, compact, overwrite_table, replace_partitions, upsert
from quotewright.sinks import tables as sink
from quotewright.sources.catalog import TableNames, current_table, ensure_schemas, list_tables, table_exists
from quotewright.sources import derived, landing
from quotewright.sources.landing import SOURCE_FILE, UNPARSED, listing_from_rows, read_array, read_records, split_records, with_audit

SCHEMA = "day string, code string, v double, at int"


@pytest.fixture(scope="module", autouse=True)
def schema(spark):
    ensure_schemas(spark, TableNames("t_bronze", "t_silver", "t_gold"))


@pytest.fixture
def table(request):
    return "t_bronze." + request.node.name.split("[")[0]


def rows_of(spark, table):
    return sorted(tuple(r) for r in current_table(spark, table).select("day", "code", "v").collect())


def frame(spark, *rows):
    return spark.createDataFrame([(*r, 0) if len(r) == 3 else r for r in rows], SCHEMA)


def put(spark, table, *rows):
    return upsert(frame(spark, *rows), table, ["day", "code"], "day", ["at"])


def files_of(spark, table, day):
    return {r[0] for r in current_table(spark, table).filter(F.col("day") == day).select("_metadata.file_path").collect()}


def test_upsert_updates_inserts_and_leaves_other_partitions(spark, table):
    assert put(spark, table, ("d1", "a", 1.0), ("d2", "a", 2.0)).rows == 2
    untouched = files_of(spark, table, "d1")
    done = put(spark, table, ("d2", "a", 9.0), ("d2", "b", 3.0), ("d3", "a", 4.0))
    assert (done.rows, done.partitions) == (3, ("d2", "d3"))
    assert rows_of(spark, table) == [("d1", "a", 1.0), ("d2", "a", 9.0), ("d2", "b", 3.0), ("d3", "a", 4.0)]
    assert files_of(spark, table, "d1") == untouched


def test_upsert_is_idempotent(spark, table):
    put(spark, table, ("d1", "a", 1.0))
    for _ in range(2):
        put(spark, table, ("d1", "a", 5.0), ("d1", "b", 6.0))
    assert rows_of(spark, table) == [("d1", "a", 5.0), ("d1", "b", 6.0)]


@pytest.mark.parametrize("existing", [False, True])
def test_upsert_newest_source_row_wins(spark, table, existing):
    if existing:
        put(spark, table, ("d1", "a", 1.0))
    put(spark, table, ("d1", "a", 7.0, 2), ("d1", "a", 8.0, 1))
    assert rows_of(spark, table) == [("d1", "a", 7.0)]


def test_upsert_of_nothing_and_of_null_keys(spark, table):
    put(spark, table, ("d1", "a", 1.0))
    assert put(spark, table).rows == 0
    assert put(spark, table, (None, "a", 2.0), ("d1", None, 2.0)).rows == 0
    assert rows_of(spark, table) == [("d1", "a", 1.0)]


def test_upsert_without_partitions(spark, table):
    for rows in ([("d1", "a", 1.0), ("d1", "b", 2.0)], [("d2", "b", 3.0), ("d2", "c", 4.0)]):
        upsert(frame(spark, *rows), table, ["code"], newest_by=["at"])
    assert rows_of(spark, table) == [("d1", "a", 1.0), ("d2", "b", 3.0), ("d2", "c", 4.0)]


def test_partition_must_be_a_key(spark, table):
    with pytest.raises(ValueError, match="must be a key"):
        upsert(frame(spark, ("d1", "a", 1.0)), table, ["code"], "day")


def test_interrupted_publish_is_completed(spark, table, monkeypatch):
    put(spark, table, ("d1", "a", 1.0), ("d1", "b", 2.0), ("d2", "a", 3.0))
    publish = sink._publish

    def dies_half_way(session, name, staged):
        # The day's old files are gone and the new ones not yet in place.
        location = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Location'").first().data_type
        sink._discard(session, f"{location}/day=d1")
        raise RuntimeError("driver lost")

    monkeypatch.setattr(sink, "_publish", dies_half_way)
    with pytest.raises(RuntimeError, match="driver lost"):
        put(spark, table, ("d1", "a", 9.0))
    monkeypatch.setattr(sink, "_publish", publish)
    assert ("d1", "b", 2.0) not in rows_of(spark, table)
    put(spark, table, ("d3", "a", 5.0))
    assert rows_of(spark, table) == [("d1", "a", 9.0), ("d1", "b", 2.0), ("d2", "a", 3.0), ("d3", "a", 5.0)]
    assert not sink.finish_pending(spark, table)


def test_overwrite_mode_of_the_session_is_restored(spark, table):
    before = spark.conf.get(sink.OVERWRITE_MODE)
    put(spark, table, ("d1", "a", 1.0))
    put(spark, table, ("d1", "a", 2.0))
    assert spark.conf.get(sink.OVERWRITE_MODE) == before


def test_scratch_folder_follows_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert sink.scratch_dir(spark) == (configured or f"{spark.conf.get('spark.sql.warehouse.dir')}/_scratch")


def test_overwrite_append_and_replace(spark, table):
    assert overwrite_table(frame(spark, ("d1", "a", 1.0), ("d2", "a", 2.0)), table, "day", ["code"]) == 2
    assert overwrite_table(frame(spark, ("d1", "b", 1.0), ("d2", "b", 2.0)), table, "day", ["code"]) == 2
    replace_partitions(current_table(spark, table).filter("day = 'd2'").withColumn("v", F.col("v") * 10), table, "day")
    assert rows_of(spark, table) == [("d1", "b", 1.0), ("d2", "b", 20.0)]
    append_rows(frame(spark, ("d1", "b", 1.0)), f"{table}_log")
    append_rows(frame(spark, ("d1", "b", 1.0)), f"{table}_log")
    assert len(rows_of(spark, f"{table}_log")) == 2


def test_compaction_merges_and_sorts_files(spark, table):
    rows = [(f"d{d}", f"c{c:02}", float(c)) for d in (1, 2) for c in range(20)]
    scattered = frame(spark, *rows).repartition(8, "code")
    scattered.write.partitionBy("day").format("parquet").saveAsTable(table)
    before, other = files_of(spark, table, "d2"), files_of(spark, table, "d1")
    assert len(before) > 1
    compact(spark, table, "day", ["code"], since="d2")
    assert len(files_of(spark, table, "d2")) == 1 and files_of(spark, table, "d1") == other
    codes = [r.code for r in current_table(spark, table).filter("day = 'd2'").collect()]
    assert codes == sorted(codes) and len(codes) == 20


def jobs_of(spark, group, action):
    spark.sparkContext.setJobGroup(group, group)
    try:
        result = action()
    finally:
        spark.sparkContext.setJobGroup("other", "other")
    return result, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_row_counts_come_from_the_write_itself(spark, table):
    rows = frame(spark, *[(f"d{d}", f"c{c}", 1.0) for d in range(3) for c in range(20)])
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        # Without adaptive planning a write is one job, whatever it counts.
        (count, jobs) = jobs_of(spark, f"{table}-overwrite", lambda: overwrite_table(rows, table, "day", ["code"]))
        assert (count, jobs) == (60, 1)
        part = current_table(spark, table).filter("day = 'd1'").limit(7)
        (count, jobs) = jobs_of(spark, f"{table}-replace", lambda: replace_partitions(part, table, "day", ["code"]))
        # Staged, then published.
        assert (count, jobs) == (7, 2)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert overwrite_table(rows.limit(0), f"{table}_empty", "day") == 0


def modified(spark, table):
    paths = current_table(spark, table).select("_metadata.file_path", "_metadata.file_modification_time").distinct().collect()
    return {r[0]: r[1] for r in paths}


def test_compaction_chooses_days_by_their_files(spark, table):
    def rows(day, n):
        return frame(spark, *[(day, f"c{c:03}", float(c)) for c in range(n)])

    # d1 in many small files, d2 in one, d3 in two large enough ones.
    rows("d1", 40).repartition(6, "code").unionByName(rows("d2", 40).coalesce(1)).write.partitionBy("day").format("parquet").saveAsTable(table)
    for _ in range(2):
        rows("d3", 900).coalesce(1).write.mode("append").partitionBy("day").format("parquet").saveAsTable(table)
    small = min(sum(r.bytes for r in sink.file_sizes(spark, table, "day").filter("partition = 'd3'").collect()) // 2, 10_000)
    before, contents = modified(spark, table), rows_of(spark, table)
    assert [r.partition for r in sink.scattered(spark, table, "day", small).collect()] == ["d1"]
    assert compact(spark, table, "day", ["code"], small_bytes=small) == ("d1",)
    after = modified(spark, table)
    kept = {path for path in before if "day=d1" not in path}
    assert {path: after[path] for path in kept} == {path: before[path] for path in kept}
    assert len([path for path in after if "day=d1" in path]) == 1 and rows_of(spark, table) == contents
    # Now there is nothing to do, and nothing is written.
    assert compact(spark, table, "day", ["code"], small_bytes=small) == ()
    assert modified(spark, table) == after


def test_compaction_of_dates_and_of_tables_without_partitions(spark, table):
    days = spark.createDataFrame([(date(2024, 1, 1 + i % 2), i) for i in range(40)], "day date, v int")
    days.repartition(4, "v").write.partitionBy("day").format("parquet").saveAsTable(table)
    assert compact(spark, table, "day", since="2024-01-02") == (date(2024, 1, 2),)
    days.repartition(4, "v").write.format("parquet").saveAsTable(f"{table}_flat")
    assert compact(spark, f"{table}_flat", None, ["v"]) == (None,)
    assert [r.v for r in current_table(spark, f"{table}_flat").collect()] == list(range(40))


def test_catalog_lookups(spark, table):
    assert not table_exists(spark, table) and not table_exists(spark, "no_schema.t")
    put(spark, table, ("d1", "a", 1.0))
    assert table_exists(spark, table)
    assert table.split(".")[1].lower() in {r.table_name for r in list_tables(spark, "t_bronze").collect()}


# -- landed files ------------------------------------------------------------


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_landed_layouts_read_alike(spark, folder, layout):
    rows = [{"Date": "2024-01-05", "Code": str(i), "Close": i / 4, "Extra": "ignored"} for i in range(3)]
    text = json.dumps(rows, indent=2) if layout == "array" else "\n".join(map(json.dumps, rows))
    (Path(folder) / "q.json").write_text(text)
    accepted, rejected = split_records(with_audit(read_records(spark, folder, QUOTE_RECORD, layout), "2024-01-06"))
    got = sorted((r.Code, r.Close, r.Open, r._ingestion_date, r._source_file.rsplit("/")[-1]) for r in accepted.collect())
    assert got == [(str(i), i / 4, None, "2024-01-06", "q.json") for i in range(3)]
    assert accepted.columns[:14] == QUOTE_RECORD.names and rejected.isEmpty()


def test_array_file_read_as_lines_is_rejected_not_loaded(spark, folder):
    (Path(folder) / "q.json").write_text(json.dumps([{"Date": "2024-01-05", "Code": "1"}], indent=2))
    accepted, rejected = split_records(with_audit(read_records(spark, folder)))
    assert accepted.isEmpty() and not rejected.isEmpty()


def test_unknown_layout(spark, folder):
    with pytest.raises(ValueError, match="unknown layout"):
        read_records(spark, folder, layout="csv")


def test_every_record_is_accepted_or_rejected(spark, folder):
    lines = ['{"Date": "2024-01-05", "Code": "1"}', '{"Date": "2024-01-35", "Code": "1"}', "{broken", '{"Code": "1"}']
    (Path(folder) / "q.json").write_text("\n".join(lines))
    accepted, rejected = split_records(with_audit(read_records(spark, folder)))
    assert accepted.count() == 1
    kept = {r.reason: r.record for r in rejected.collect()}
    assert kept["malformed record"] == "{broken"
    assert json.loads(kept["unreadable date"]) == {"Date": "2024-01-35", "Code": "1"}
    assert set(kept) == {"malformed record", "unreadable date", "missing date"}


def test_listing_rows_may_lack_fields(spark):
    assert listing_from_rows(spark, [{"Code": "1"}]).first().CompanyName is None


# -- array files, split over tasks ------------------------------------------------


def small_blocks(spark, size):
    """Scans with blocks of so many bytes; gives the setting back."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    return lambda: spark.conf.set(name, before)


TRICKY = ['a "quoted" }', "},{", '},{"Code":"9"}', "]}", "}]", "\\", "}" * 40, "[{", "new\nline }, {", "é 漢 }", ""]


def tricky_rows(seed, n):
    r = random.Random(seed)
    return [
        {"Date": "2024-01-05", "Code": f"{i} {r.choice(TRICKY)}", "Close": i / 4, **({"Open": 1.5} if r.random() < 0.5 else {}), "Extra": r.choice(TRICKY)}
        for i in range(n)
    ]


def by_file(df):
    order = [c for c in df.columns if c != UNPARSED]
    return sorted(map(repr, df.select(order).collect()))


@pytest.mark.parametrize("indent, block", [(None, 150), (2, 150), (None, 10_000_000), (2, 37)])
def test_split_arrays_equal_the_multi_line_read(spark, folder, indent, block):
    for i, n in enumerate((200, 1, 0)):
        (Path(folder) / f"q{i}.json").write_text(json.dumps(tricky_rows(i, n), indent=indent, ensure_ascii=i == 0) + "\n" * i)
    restore = small_blocks(spark, block)
    try:
        split = read_array(spark, folder)
        assert split.columns == read_records(spark, folder, layout="array").columns
        assert by_file(split) == by_file(read_records(spark, folder, layout="array"))
        assert split.filter(F.col(UNPARSED).isNotNull()).count() == 0
        if block < 1000:
            texts = spark.read.option("lineSep", "}").text(f"{folder}/q0.json")
            assert texts.rdd.getNumPartitions() > 20  # one file, many tasks
    finally:
        restore()


def test_a_malformed_record_costs_only_itself(spark, folder):
    good = [json.dumps(r) for r in tricky_rows(3, 30)]
    broken = [*good[:10], '{"Date": "2024-01-05", "Code": }', *good[10:20], '{"Date": "2024-01-05" "Code": "x"}', *good[20:]]
    (Path(folder) / "q.json").write_text("[" + ", ".join(broken) + "]")
    (Path(folder) / "cut.json").write_text("[" + good[0] + ',{"Date": "2024-01-')
    restore = small_blocks(spark, 200)
    try:
        accepted, rejected = split_records(with_audit(read_array(spark, folder)))
        assert accepted.count() == 31
        assert sorted(r.record for r in rejected.collect()) == sorted([broken[10], broken[21], '{"Date": "2024-01-'])
        assert {r.reason for r in rejected.collect()} == {"malformed record"}
        assert {os.path.basename(r[SOURCE_FILE]) for r in rejected.collect()} == {"q.json", "cut.json"}
    finally:
        restore()


def test_split_arrays_of_empty_files(spark, folder):
    for name, text in (("a", ""), ("b", "[]"), ("c", " [ ] \n"), ("d", '[{"Date": "2024-01-05", "Code": "1"}]')):
        (Path(folder) / f"{name}.json").write_text(text)
    assert [r.Code for r in read_array(spark, folder).collect()] == ["1"]


def test_landed_months_read_back(spark, folder):
    records = derived.quote_records(spark, "/root/testdata/sf0.001").filter("Date >= '2001-09-20'")
    derived.land_arrays(records, f"{folder}/landed")
    got = read_array(spark, f"{folder}/landed").select(*QUOTE_RECORD.names)
    assert got.exceptAll(records).isEmpty() and records.exceptAll(got).isEmpty()


def test_only_files_with_parted_records_are_put_together(spark, folder):
    plain, tricky = [{"Date": "2024-01-05", "Code": "7203", "Close": float(i)} for i in range(40)], tricky_rows(6, 40)
    (Path(folder) / "plain.json").write_text(json.dumps(plain) + "\n")
    restore = small_blocks(spark, 200)
    try:
        whole = read_array(spark, folder)
        assert by_file(whole) == by_file(read_records(spark, folder, layout="array"))
        # Nothing is left to be gathered, so it goes from the plan while it runs.
        final = whole.select("Code")
        assert [r.Code for r in final.collect()] == ["7203"] * 40
        assert "collect_list" not in final._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        (Path(folder) / "tricky.json").write_text(json.dumps(tricky))
        # Braces beyond the last record, objects without an array and a file cut off behind a value.
        (Path(folder) / "ends.json").write_text(json.dumps(plain[:3]) + "}")
        (Path(folder) / "lines.json").write_text("\n".join(map(json.dumps, plain[:2])))
        (Path(folder) / "cut.json").write_text(json.dumps(plain[:2])[:-2])
        pieces = landing._pieces(spark.read.option("lineSep", "}").text(folder))
        assert by_file(read_array(spark, folder)) == by_file(landing.records_of_pieces(pieces))
        assert read_array(spark, folder).filter(F.col(UNPARSED).isNull()).count() > 80
    finally:
        restore()


def test_records_by_month_are_the_quote_records(spark, folder):
    r = random.Random(8)
    rows = []
    for i in range(400):
        day = None if r.random() < 0.05 else date(1997, r.choice((11, 12)), r.randrange(12, 17))
        gone = lambda x: None if r.random() < 0.05 else x  # noqa: B023, E731
        rows.append((gone(i), r.randrange(1, 5), r.randrange(1, 9), gone(r.choice((9, 10, 11, 20))), gone(float(r.randrange(1, 50))), gone(r.randrange(100, 900) / 4), day))
    rows += rows[:30]
    schema = "l_orderkey long, l_linenumber long, l_partkey long, l_suppkey long, l_quantity double, l_extendedprice double, l_shipdate date"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/lineitem.parquet")
    records, by_month = derived.quote_records(spark, folder), derived.monthly_records(spark, folder)
    assert by_month.columns == ["month", *records.columns]
    got = by_month.drop("month")
    assert got.exceptAll(records).isEmpty() and records.exceptAll(got).isEmpty()
    # One exchange and one sort serve the bars and the arrays.
    of_month = Window.partitionBy("month").orderBy("Date", "Code")
    plan = by_month.withColumn("last", F.lead("Date").over(of_month).isNull())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
    derived.land_arrays(by_month, f"{folder}/by_month")
    derived.land_arrays(records, f"{folder}/landed")
    arrays = lambda path: {x.month: x.value for x in spark.read.option("wholetext", True).text(f"{folder}/{path}").collect()}
    assert arrays("by_month").keys() == arrays("landed").keys()
    dated = {k: v for k, v in arrays("by_month").items() if k is not None}
    assert len(dated) == 2 and all(arrays("landed")[k] == v for k, v in dated.items())
