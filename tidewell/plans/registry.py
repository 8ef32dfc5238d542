"""Registry of named queries and their independent SQL twins."""

from __future__ import annotations

import functools
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidewell.plans.fixtures import SQL_VIEWS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def _views_used(sql: str) -> list[str]:
    """Fixture views named in ``sql``, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in SQL_VIEWS:
            if re.search(rf"\b{name}\b", text) and name not in ordered:
                visit(SQL_VIEWS[name])
                ordered.append(name)

    visit(sql)
    return ordered


def with_views(sql: str) -> str:
    """Prefix ``sql`` with the fixture views it uses as common table expressions."""
    sql = sql.strip()
    ctes = ", ".join(f"{v} AS ({SQL_VIEWS[v].strip()})" for v in _views_used(sql))
    upper = sql.upper()
    if upper.startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes + ', ' if ctes else ''}{sql[len('WITH RECURSIVE'):]}"
    if not ctes:
        return sql
    if upper.startswith("WITH"):
        return f"WITH {ctes}, {sql[4:]}"
    return f"WITH {ctes} {sql}"


def sql_share(key: str, seed: int) -> str:
    """The SQL twin of ``functions.hashing.hash_share`` of one column."""
    return f"(('0x' || substr(md5('{seed}:' || {key}), 1, 15))::BIGINT % 1000000) / 1000000.0"


def _widened(fn: Query, cols: tuple[str, ...]) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(spark, sf_dir).withColumns({c: F.col(c).cast("long") for c in cols})

    return run


def query(name: str, sql: str | None = None, longs: tuple[str, ...] = ()) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its SQL twin where plain SQL can express it, ``longs`` are columns shown as BIGINT."""

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = _widened(fn, longs) if longs else fn
        if sql is not None:
            ORACLES[name] = with_views(sql)
        return fn

    return register
