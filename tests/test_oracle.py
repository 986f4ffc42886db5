"""Every query with SQL gives the same rows in DuckDB; those without give rows."""

import math

import duckdb
import pytest

from shoalmark.plans import registry

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    return None if v is None or isinstance(v, float) and math.isnan(v) else repr(v) if isinstance(v, float) else str(v)


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", list(registry.QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = registry.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(map(plain, r))) for r in df.select(*columns).collect())
    if name not in registry.ORACLE_SQL:
        assert rows
        return
    found = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(found.columns) == columns
    expected = sorted(str(tuple(map(plain, r))) for r in found.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
    assert rows == expected
