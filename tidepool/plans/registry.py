"""Registry of named queries: Spark builder + equivalent DuckDB SQL.

``register(name, sql)`` decorates a ``(spark, sf_dir) -> DataFrame`` builder.
``sql=None`` marks a query whose semantics have no SQL form (approximate
sketches, streaming runs): the driver then checks rows only.
"""

from __future__ import annotations

from collections.abc import Callable

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco
