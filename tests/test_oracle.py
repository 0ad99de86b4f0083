"""Every registered query with SQL against its DuckDB twin (small scale factor)."""

import pytest

import __spark_entry__ as E
from tools.compare import canon, duck

from conftest import SMALL

NAMES = sorted(E.oracle_sql())
SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["city", "state", "restaurants", "reviews", "avg_rating"]
    assert 0 < df.count() <= 50


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SMALL)
    rows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    assert canon(df.columns, rows) == canon(ocols, cur.fetchall())
    duck_types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {E.oracle_sql()[name]}").fetchall()}
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in df.dtypes} == duck_types
