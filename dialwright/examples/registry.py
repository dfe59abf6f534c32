"""Registry of example queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
_CTES: dict[str, str] = {}


def cte(name: str, sql: str) -> None:
    """Define a named subquery usable by later definitions and checks."""
    _CTES[name] = sql


def with_ctes(sql: str) -> str:
    """Prefix the subqueries a statement mentions, in definition order."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name, body in _CTES.items():
            if name not in needed and f"{{{name}}}" in text:
                needed.add(name)
                visit(body)

    def resolved(text: str) -> str:
        for name in _CTES:
            text = text.replace(f"{{{name}}}", name)
        return text

    visit(sql)
    parts = [f"{name} AS ({resolved(body)})" for name, body in _CTES.items() if name in needed]
    return (f"WITH {', '.join(parts)} " if parts else "") + resolved(sql)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; ``sql`` is its independent formulation for the check.

    ``{cte_name}`` refers to a subquery defined with :func:`cte`.
    """

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return plain(fn(spark, sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = with_ctes(sql)
        return fn

    return register


def plain(df: DataFrame) -> DataFrame:
    """Types both engines report alike: decimals as doubles, dates as text."""
    casts = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, T.DateType):
            casts[field.name] = F.col(field.name).cast("string")
    return df.withColumns(casts) if casts else df
