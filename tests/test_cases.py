"""Every case gives the rows that its rules give."""

from importlib import import_module

import duckdb
import pytest

from tests import cases
from tests.test_oracle import plain

for _name in ("text", "sites", "merge", "sources", "client", "adapters"):
    import_module(f"tests.cases.{_name}")


@pytest.mark.parametrize("name", list(cases.QUERIES))
def test_case(name, spark, sf_dir):
    df = cases.QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    rows = sorted(str(tuple(map(plain, r))) for r in df.select(*columns).collect())
    expected = duckdb.sql(cases.ORACLE_SQL[name])
    assert sorted(expected.columns) == columns
    assert rows == sorted(str(tuple(map(plain, r))) for r in expected.select(*[duckdb.ColumnExpression(c) for c in columns]).fetchall())
