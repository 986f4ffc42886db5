"""Operators over small written-out inputs that reach their branches, with the rows that the rules give.

The rows were worked out by hand from the rules, not from what the operator returned.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import wraps

QUERIES: dict = {}
#: The expected rows as SQL.
ORACLE_SQL: dict[str, str] = {}


def query(sql: str):
    def put(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return put


_SQL_TYPE = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN", "date": "DATE"}


def _type(kind: str) -> str:
    if kind.startswith("array<"):
        return _type(kind[6:-1]) + "[]"
    return _SQL_TYPE[kind]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, (list, tuple)):
        return f"[{', '.join(map(_literal, value))}]"
    if isinstance(value, (int, float)):
        return repr(value)
    return "'" + str(value).replace("'", "''") + "'"


def rows_sql(ddl: str, rows: Sequence[tuple]) -> str:
    """SQL that gives the rows, by their schema ("name type, name type")."""
    fields = [(name, _type(kind)) for name, kind in (f.split(" ", 1) for f in ddl.split(", "))]
    columns = ", ".join(f'CAST(c{i} AS {kind}) AS "{name}"' for i, (name, kind) in enumerate(fields))
    names = ", ".join(f"c{i}" for i in range(len(fields)))
    values = ", ".join(f"({', '.join(map(_literal, row))})" for row in rows) or f"({', '.join(['NULL'] * len(fields))})"
    return f"SELECT {columns} FROM (VALUES {values}) AS t({names}){'' if rows else ' WHERE false'}"


def case(*inputs: tuple[str, Sequence[tuple]], ddl: str, expected: Sequence[tuple]):
    """Registers a function of DataFrames of the inputs (schema, rows); its rows are the expected ones."""

    def put(f):
        @wraps(f)
        def run(spark, d):
            return f(*[spark.createDataFrame(list(rows), schema) for schema, rows in inputs])

        QUERIES[f.__name__] = run
        ORACLE_SQL[f.__name__] = rows_sql(ddl, expected)
        return f

    return put
