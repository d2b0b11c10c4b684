"""Every registered query against its SQL, on the smallest test tables."""

from __future__ import annotations

import glob
import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

duckdb = pytest.importorskip("duckdb")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(set(queries()) & set(oracle_sql())))
def test_query(spark, oracle, name):
    df = queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in df.collect()]
    assert rows
    cursor = oracle.execute(oracle_sql()[name])
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert canonical(df.columns, rows) == canonical(names, cursor.fetchall())


def test_entry(spark):
    assert entry(spark).count() == 5
