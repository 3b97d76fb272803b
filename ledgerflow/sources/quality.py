"""Schema checks, null and outlier profiles, key uniqueness, row counts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ledgerflow.functions.keyed import attach_stats, join_series
from ledgerflow.operators.ordered import exact_quantiles, running_totals
from ledgerflow.schemas import OPTIONAL, REQUIRED
from ledgerflow.sources.shared import store


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _data_columns(df: DataFrame) -> list[str]:
    """Columns of the data itself, without the load order added at reading."""
    return [c for c in df.columns if c != "load_seq"]


def check_schema(name: str, df: DataFrame) -> DataFrame:
    """Name check against the declared columns; an undeclared dataset counts as valid."""
    columns = _data_columns(df)
    declared = name in REQUIRED
    missing = [c for c in REQUIRED.get(name, []) if c not in columns]
    known = {*REQUIRED.get(name, []), *OPTIONAL.get(name, [])}
    extra = [c for c in columns if c not in known] if declared else []
    return df.agg(F.count("*").alias("total_rows")).select(
        F.lit(name).alias("dataset"),
        F.lit(not missing).alias("valid"),
        F.array(*[F.lit(c) for c in missing]).cast("array<string>").alias("missing_required"),
        F.array(*[F.lit(c) for c in extra]).cast("array<string>").alias("extra_columns"),
        F.lit(len(columns)).alias("total_columns"),
        "total_rows",
    )


def check_all_schemas(datasets: Mapping[str, DataFrame]) -> DataFrame:
    return _union([check_schema(name, df) for name, df in datasets.items()])


def all_valid(checks: DataFrame) -> DataFrame:
    return checks.agg(F.bool_and("valid").alias("all_valid"), F.count("*").alias("datasets"))


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage of each column that has nulls; one pass over the data."""
    columns = _data_columns(df)
    counts = df.agg(F.count("*").alias("__rows"), *[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return (
        counts.unpivot(["__rows"], columns, "column", "null_count")
        .where(F.col("null_count") > 0)
        .select("column", "null_count", F.round(F.col("null_count") / F.col("__rows") * 100, 2).alias("null_pct"))
    )


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name != "load_seq"]


def _long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")


def column_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], accuracy: int = 10000
) -> DataFrame:
    """Exact quantiles of each column, as ``column, q0, q1, ...``, without shuffling the columns.

    A sketch aggregate brackets every quantile, a second aggregate counts the values below and
    inside each bracket, and only the few values inside are ranked. The counts prove that a bracket
    holds the wanted ranks; should one not, all values are ranked instead.
    """
    slack = 4.0 / accuracy
    ends = [end for p in probabilities for end in (max(p - slack, 0.0), min(p + slack, 1.0))]
    doubles = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    sketch = store(doubles.agg(*[F.percentile_approx(c, ends, accuracy).alias(f"__b_{c}") for c in columns]), "brackets")
    bracketed = attach_stats(doubles, sketch, [])
    spots = [(c, i, F.col(f"__b_{c}")[2 * i], F.col(f"__b_{c}")[2 * i + 1]) for c in columns for i in range(len(probabilities))]

    sizes = bracketed.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.count_if(F.col(c) < low).alias(f"below_{c}_{i}") for c, i, low, _ in spots],
        *[F.count_if(F.col(c).between(low, high)).alias(f"inside_{c}_{i}") for c, i, low, high in spots],
        *[F.max(low).alias(f"low_{c}_{i}") for c, i, low, _ in spots],
        *[F.max(high).alias(f"high_{c}_{i}") for c, i, _, high in spots],
    )
    places = store(
        sizes.select(
            F.inline(
                F.array(
                    *[
                        F.struct(
                            F.lit(c).alias("column"),
                            F.lit(i).alias("spot"),
                            ((F.col(f"n_{c}") - 1) * F.lit(float(probabilities[i]))).alias("position"),
                            F.col(f"below_{c}_{i}").alias("below"),
                            F.col(f"inside_{c}_{i}").alias("inside"),
                            F.col(f"low_{c}_{i}").alias("low"),
                            F.col(f"high_{c}_{i}").alias("high"),
                        )
                        for c, i, _, _ in spots
                    ]
                )
            )
        ).where(F.col("position") >= 0),
        "places",
    )
    held = (F.col("below") <= F.floor("position")) & (F.ceil("position") < F.col("below") + F.col("inside"))
    state = places.agg(F.count_if(~held).alias("missed"), F.count_if(F.col("low") < F.col("high")).alias("open")).first()
    if state.missed:
        return exact_quantiles(_long(df, columns), ["column"], "value", probabilities)

    exact = F.col("low")
    if state.open:
        ranked = _rank_inside(bracketed, spots, places)
        places = join_series(places, ranked, [], "left", ["column", "spot"])
        exact = F.when(F.col("low") < F.col("high"), F.col("v0") + (F.col("v1") - F.col("v0")) * F.col("part")).otherwise(exact)
    return places.groupBy("column").agg(*[F.max(F.when(F.col("spot") == i, exact)).alias(f"q{i}") for i in range(len(probabilities))])


def _rank_inside(bracketed: DataFrame, spots: Sequence[tuple], places: DataFrame) -> DataFrame:
    """The two values around each position, for brackets that hold more than one value."""
    within = {(c, i): (low < high) & F.col(c).between(low, high) for c, i, low, high in spots}
    hits = [
        F.when(hit, F.struct(F.lit(c).alias("column"), F.lit(i).alias("spot"), F.col(c).alias("value")))
        for (c, i), hit in within.items()
    ]
    inside = (
        bracketed.where(reduce(lambda a, b: a | b, within.values()))
        .select(F.inline(F.array_compact(F.array(*hits))))
        .groupBy("column", "spot", "value")
        .agg(F.count("*").alias("copies"))
    )
    ranked = running_totals(inside, ["column", "spot"], ["value"], {"upto": F.col("copies")})
    placed = join_series(ranked, F.broadcast(places), [], "left", ["column", "spot"])  # one row per column and quantile

    def value_at(rank: Column) -> Column:
        upto = F.col("below") + F.col("upto")
        return F.max(F.when((upto - F.col("copies") <= rank) & (rank < upto), F.col("value")))

    low, high = F.floor("position"), F.ceil("position")
    return placed.groupBy("column", "spot").agg(
        value_at(low).alias("v0"), value_at(high).alias("v1"), F.max(F.col("position") - low).alias("part")
    )


def outlier_bounds(df: DataFrame, columns: Sequence[str], method: str = "exact") -> DataFrame:
    """Quartiles and the 1.5-IQR limits of each column.

    ``exact`` gives interpolated quartiles; ``approximate`` is a single sketch aggregate for when a
    bounded rank error is good enough.
    """
    if method == "exact":
        quartiles = column_quantiles(df, columns, [0.25, 0.75])
    elif method == "approximate":
        sketch = [F.percentile_approx(F.col(c).cast("double"), [0.25, 0.75], 10000).alias(c) for c in columns]
        quartiles = df.agg(*sketch).unpivot([], list(columns), "column", "q").select(
            "column", F.col("q")[0].alias("q0"), F.col("q")[1].alias("q1")
        )
    else:
        raise ValueError(f"unknown method: {method}")
    iqr = F.col("q1") - F.col("q0")
    return quartiles.select(
        "column",
        F.col("q0").alias("q25"),
        F.col("q1").alias("q75"),
        (F.col("q0") - 1.5 * iqr).alias("low"),
        (F.col("q1") + 1.5 * iqr).alias("high"),
    )


def outlier_counts(
    df: DataFrame, columns: Sequence[str] | None = None, method: str = "exact", keep_zero: bool = False
) -> DataFrame:
    """Rows outside the IQR limits per numeric column; columns without outliers are left out by default.

    All columns are counted in one aggregate against one row of limits.
    """
    columns = list(columns or numeric_columns(df))
    limits = outlier_bounds(df, columns, method).groupBy().pivot("column", columns).agg(
        *[F.first(c).alias(c) for c in ("q25", "q75", "low", "high")]
    )
    together = attach_stats(df.select(*columns), limits, [])
    names = ("q25", "q75")
    counted = together.agg(
        *[F.max(f"{c}_{n}").alias(f"{c}_{n}") for c in columns for n in names],
        *[
            F.count_if((F.col(c).cast("double") < F.col(f"{c}_low")) | (F.col(c).cast("double") > F.col(f"{c}_high"))).alias(f"{c}_outliers")
            for c in columns
        ],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}_{n}").alias(n) for n in (*names, "outliers")]) for c in columns
    ]
    found = counted.select(F.inline(F.array(*rows)))
    return found if keep_zero else found.where(F.col("outliers") > 0)


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("copies")).where(F.col("copies") > 1)


def row_counts(datasets: Mapping[str, DataFrame]) -> DataFrame:
    return _union(
        [df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("dataset"), "rows") for name, df in datasets.items()]
    )
