"""Tile queries on tables of their own: every zoom up to 14 is part of the job."""

import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = {
    "part": ("p_partkey bigint, p_name string", [(1, "a"), (2, None), (2, "b"), (194, "c")]),
    "customer": ("c_custkey bigint, c_nationkey int", [(1, 1), (223, None)]),
    "orders": ("o_orderkey bigint", [(5,), (7,), (9,), (199,), (211,)]),
    "lineitem": ("l_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, l_quantity double",
                 [(1, 1, 7, 3, "A", 2.0), (1, 7, 8, 9, "N", 1.0), (388, 1, 4, 2, None, None)]),
    "supplier": ("s_suppkey bigint, s_name string", [(2, "s"), (3, None)]),
    "events": ("event_id bigint", [(1,), (2,), (4,), (7,)]),
}


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    for name, (schema, rows) in TABLES.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/{name}.parquet")
    return str(path)


@pytest.mark.parametrize("name", ["tile_cover", "tile_update"])
def test_tiles_go_down_to_the_last_zoom_of_each_theme(spark, folder, name):
    frame = entry.queries()[name](spark, folder)
    rows = frame.collect()
    last = {theme: max(r.z for r in rows if r.theme == theme) for theme in {r.theme for r in rows}}
    assert last == {"places": 14, "addresses": 14, "transportation": 14, "buildings": 14, "divisions": 12, "base": 13}
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    cursor = con.execute(entry.oracle_sql()[name])
    columns = [column[0] for column in cursor.description]
    assert Counter(tuple(r[c] for c in columns) for r in rows) == Counter(cursor.fetchall())


@pytest.mark.parametrize("name", ["tile_assign"])
def test_no_step_is_too_large_for_java_to_compile(spark, folder, name):
    # Beyond 8,000 bytes a method is interpreted, row by row.
    spark.conf.set("spark.sql.adaptive.enabled", False)
    try:
        plan = entry.queries()[name](spark, folder)._jdf.queryExecution().executedPlan()
        code = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$").codegenString(plan)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", True)
    sizes = [int(size) for size in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000
