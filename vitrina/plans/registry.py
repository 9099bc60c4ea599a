"""Registry of the named queries that ``__spark_entry__`` exposes.

A query is a function ``(spark, sf_dir) -> DataFrame`` over the driver's
tables; its oracle is DuckDB SQL over the same tables (views named after the
tables).  Queries without an oracle get the driver's rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

#: Python's whitespace as a character class of DuckDB's expressions; ``@WS@`` stands for it in oracle SQL.
WS_CLASS = r"[\t\n\x{0b}\f\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None) -> Callable[[QueryFn], QueryFn]:
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip().replace("@WS@", WS_CLASS)
        return fn
    return deco


def load_all() -> None:
    """Import every query module so their ``register`` calls run."""
    from vitrina.plans import (  # noqa: F401
        q_catalog, q_text, q_series, q_quality, q_vectors, q_lookup, q_normalize, q_incremental, q_io,
    )
