"""Every registered query against its DuckDB oracle on the smallest tables
(the driver runs the same comparison at sf0.01)."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import TABLES, normalize  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    r = con.execute(E.oracle_sql()[name])
    c1, v1 = normalize(df.columns, rows)
    c2, v2 = normalize([d[0] for d in r.description], r.fetchall())
    assert c1 == c2
    assert len(v1) == len(v2)
    assert v1 == v2


@pytest.mark.parametrize("name", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_query_without_oracle_runs(spark, name):
    df = E.queries()[name](spark, SF)
    assert df.count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["label", "prediction", "n"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
