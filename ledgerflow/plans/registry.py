"""Named queries with their columns and, where one exists, an equivalent SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.plans.fixtures import Fixtures
from ledgerflow.plans.oracle_views import with_views


@dataclass(frozen=True)
class Query:
    name: str
    columns: dict[str, str]
    build: Callable[[Fixtures], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        df = self.build(Fixtures(spark, folder))
        return df.select(*[_spark_column(name, kind) for name, kind in self.columns.items()])


REGISTRY: dict[str, Query] = {}


def _parse(columns: str) -> dict[str, str]:
    """``"date:d balance:m ratio:f6 n:i"``: d date, m money, f<k> double at k digits, i integer, s text, b flag."""
    return dict(part.rsplit(":", 1) for part in columns.split())


def _spark_column(name: str, kind: str) -> Column:
    c = F.col(name)
    if kind[0] == "f":
        return (F.round(c.cast("double"), int(kind[1:] or 6)) + F.lit(0.0)).alias(name)
    to = {"d": "string", "m": "double", "i": "bigint", "s": "string", "b": "boolean"}[kind]
    return c.cast(to).alias(name)


def _sql_column(name: str, kind: str) -> str:
    if kind[0] == "f":
        return f'round(CAST("{name}" AS DOUBLE), {int(kind[1:] or 6)}) + 0.0 AS "{name}"'
    to = {"d": "VARCHAR", "m": "DOUBLE", "i": "BIGINT", "s": "VARCHAR", "b": "BOOLEAN"}[kind]
    return f'CAST("{name}" AS {to}) AS "{name}"'


def query(name: str, columns: str, sql: str | None = None, **ctes: str):
    """Register a query; ``sql`` yields the same columns, which are then cast alike on both sides."""
    kinds = _parse(columns)

    def register(build: Callable[[Fixtures], DataFrame]) -> Callable[[Fixtures], DataFrame]:
        text = None
        if sql is not None:
            shown = ", ".join(_sql_column(n, k) for n, k in kinds.items())
            text = with_views(f"SELECT {shown} FROM ({sql.strip()}) AS shown", **ctes)
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, kinds, build, text)
        return build

    return register


def load() -> dict[str, Query]:
    """All queries, in the order of the operator inventory."""
    from ledgerflow.plans import (  # noqa: F401  (importing registers)
        queries_alerts,
        queries_cleaning,
        queries_evaluation,
        queries_forecast,
        queries_kpi,
        queries_rules,
        queries_series,
        queries_sources,
        queries_streaming,
    )

    return REGISTRY
