"""Every registered query against DuckDB on the smallest driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from paritas.plans.inputs import TABLES
from tools.compare import rows

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="driver tables absent")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["o_orderkey", "difference", "n_source", "n_target"]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    got = df.collect()
    if name not in ORACLES:
        return
    cursor = duck.execute(ORACLES[name])
    names, want = [d[0] for d in cursor.description], cursor.fetchall()
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, got) == rows(names, want)
