"""Every query that has oracle SQL against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from fathom.plans.catalog import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DIR), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.sql("SET timezone = 'UTC'")
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    return c


def plain(x):
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    if isinstance(x, bool):
        return str(x)
    try:
        return f"{float(x):.5g}"
    except (TypeError, ValueError):
        return str(x)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_oracle(spark, con, name):
    df = QUERIES[name](spark, DIR)
    cols = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    rel = con.sql(ORACLE_SQL[name])
    assert sorted(rel.columns) == cols
    theirs = sorted(tuple(map(plain, r)) for r in con.sql(f"SELECT {', '.join(f'\"{c}\"' for c in cols)} FROM ({ORACLE_SQL[name]}) t").fetchall())
    assert ours == theirs


def test_names():
    assert set(ORACLE_SQL) <= set(QUERIES)
