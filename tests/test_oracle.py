"""Every query against its SQL in DuckDB, all rows and values."""

import math
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.split('.')[0]} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


def plain(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else f"{value:.12g}"
    return str(value)


def rows_of(rows, columns):
    return sorted(tuple(plain(row[name]) for name in columns) for row in rows)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_gives_the_rows_of_its_sql(spark, duck, name):
    result = queries()[name](spark, SF_DIR)
    columns = sorted(result.columns)
    found = rows_of(result.collect(), columns)
    answer = duck.execute(oracle_sql()[name])
    names = [column[0] for column in answer.description]
    assert sorted(names) == columns
    assert found == rows_of([dict(zip(names, row)) for row in answer.fetchall()], columns)


def test_entry(spark):
    report = entry(spark)
    assert report.columns == ["class", "support", "precision", "recall", "f1"]
    assert report.count() > 0
