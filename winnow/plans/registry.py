"""Registry of named queries and their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return deco


def resolved_oracles() -> dict[str, str]:
    """Oracles with ``@name@`` references replaced by that query's SQL."""
    out = {}
    for name, sql in ORACLES.items():
        for _ in range(5):
            if "@" not in sql:
                break
            for other, osql in ORACLES.items():
                sql = sql.replace(f"@{other}@", osql.strip())
        out[name] = sql.strip()
    return out
