"""Each registered query against its SQL counterpart on the smallest tables."""

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{FOLDER}/{file}'")
    return con


def counted(columns, rows):
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(row[n] for n in order) for row in rows)


@pytest.mark.parametrize("name", list(entry.queries()))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, FOLDER)
    rows = frame.collect()
    if name not in SQL:
        assert rows
        return
    cursor = con.execute(SQL[name])
    columns = [column[0] for column in cursor.description]
    assert sorted(frame.columns) == sorted(columns)
    assert counted(frame.columns, rows) == counted(columns, cursor.fetchall())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and [r.places for r in rows] == sorted((r.places for r in rows), reverse=True)
