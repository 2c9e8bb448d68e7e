"""Every registered query against its SQL in DuckDB."""

from __future__ import annotations

import contextlib
import glob
import io
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = entry_module.queries(), entry_module.oracle_sql()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    got = as_rows(df.columns, df.collect())
    plan = io.StringIO()
    with contextlib.redirect_stdout(plan):
        df.explain()
    assert "CartesianProduct" not in plan.getvalue()
    assert "BroadcastNestedLoopJoin" not in plan.getvalue()
    if name not in SQL:
        assert df.columns
        return
    result = duck.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == as_rows(columns, result.fetchall())


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.columns == ["conv_id", "n_messages", "nbytes"]
    assert df.count() > 0


def test_sql_only_for_queries():
    assert set(SQL) <= set(QUERIES)
