"""The registered queries by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barloom.functions.series import rounded
from barloom.plans import sql

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if oracle:
            ORACLES[name] = oracle
        return f

    return add


def simple(name: str, build: Query, columns: list[str], uses: list[str], source: str, round_: list[str] = (), where: str = "", exprs: dict[str, str] | None = None) -> None:
    """A query that selects ``columns`` of what ``build`` gives, and the same of a subquery."""
    exprs = exprs or {}
    body = f"SELECT {', '.join(f'{exprs[c]} AS {c}' if c in exprs else c for c in columns)} FROM {source} {where}"
    register(name, sql.query(uses, body, list(round_)))(lambda s, d: rounded(build(s, d).select(*columns)))
