"""Helpers for operators over any number of series (``keys == []`` means one series)."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.window import WindowSpec


def by_series(keys: Sequence[str], *order: str | Column) -> WindowSpec:
    """Ordered window per series. Only for day-grain frames: a series then has one row a day."""
    return Window.partitionBy(*keys).orderBy(*order)


def join_series(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", plain: Sequence[str] = ()
) -> DataFrame:
    """Equi-join on the series keys, null keys included, and on ``plain`` columns that are never null.

    The left copy of the columns is kept. No broadcast is forced: Catalyst and AQE look at the size
    of the right side.
    """
    names = [*keys, *plain]
    renamed = right.withColumnsRenamed({k: f"__r_{k}" for k in names})
    matches = [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys] + [F.col(k) == F.col(f"__r_{k}") for k in plain]
    joined = left.join(renamed, reduce(lambda a, b: a & b, matches), how)
    return joined.drop(*[f"__r_{k}" for k in names])


def attach_stats(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add per-series figures to every row.

    With keys: an equi-join on the series, left to Catalyst and AQE. Where ``df`` is a whole ledger,
    pass stored ``stats``: its file size then tells the planner, before any shuffle, whether it may
    be broadcast. Without keys ``stats`` is one row and enters the plan as a scalar subquery, so the
    large side is neither shuffled nor cross-joined.
    """
    names = [c for c in stats.columns if c not in keys]
    if keys:
        return join_series(df, stats, keys, "left")
    packed = stats.select(F.struct(*names).alias("s")).scalar()
    return df.withColumn("__s", packed).select(*df.columns, *[F.col(f"__s.{n}").alias(n) for n in names])
