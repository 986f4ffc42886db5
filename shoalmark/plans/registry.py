"""The registered queries of the engine, and the same in DuckDB SQL."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
FLAGSHIP = "index_search"


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame by its name, with SQL for the same rows where SQL can tell."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return put


for _name in ("searching", "merging", "joining", "placing", "ordering", "resolving", "parsing", "publishing", "reading", "scaling", "streams"):
    import_module(f".{_name}", __package__)
