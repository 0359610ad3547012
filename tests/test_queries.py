"""Every registered query against its DuckDB statement."""

import math
from datetime import date, datetime
from decimal import Decimal
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(SF).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    return float(value) if isinstance(value, Decimal) else value


def row_set(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(repr([plain(r[i]) for i in order]) for r in rows)


def test_every_query_has_an_oracle():
    """The training-data operators may have none where SQL cannot express them; they have tests of their own."""
    further = {n for module in contract._training_data() for n in module.queries()}
    assert contract.queries().keys() - further == contract.oracle_sql().keys() - further


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_matches_oracle(spark, duck, name):
    ours = contract.queries()[name](spark, SF)
    cursor = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    expected_columns, expected = row_set(names, cursor.fetchall())
    columns, rows = row_set(ours.columns, [tuple(r) for r in ours.collect()])
    assert columns == expected_columns
    assert len(rows) == len(expected)
    different = [pair for pair in zip(rows, expected) if pair[0] != pair[1]]
    assert not different, (len(different), different[0])
    assert rows, "a registered query should return rows at this scale"
