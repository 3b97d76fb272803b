"""Running totals, numbering and look-back over one long ordered series.

A plain ordered window puts a whole series into one task. Here the rows are range-partitioned by
``(series, order)``, each partition becomes a *chunk*, chunk totals are carried forward, and the
window only ever covers one chunk of one series, so a single account may hold any share of the rows.

The chunked rows are written to the shared folder first: range bounds come from sampling, and the
totals and the rows must see the same chunk for the same row even if an executor is lost.

With ``block`` (leading columns of ``order``, such as the day) the blocks are the chunks. They are known before any row moves, so
nothing is written, the rows are dealt once, and the number of partitions follows the number of rows. What is carried into a block comes
as one more row at its head. The input is read twice: pass a stored table. A block above ``BLOCK_ROWS`` sends the call the plain way.

``order`` must be unique within a series.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.functions.keyed import attach_stats, join_series
from ledgerflow.sources.shared import store

CHUNK = "__chunk"
#: Rows of one range partition of blocks, and the most rows that one block (one sort) may have.
PART_ROWS = 200_000
BLOCK_ROWS = 2_000_000
#: Rows of one partition that is grouped by a key which nearly every row has for itself.
GROUP_ROWS = 1_000_000
#: Most rows of either kind of partition, if that keeps their number small enough for rows to be dealt unsorted.
FULL_ROWS = 2_000_000


def chunked(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    ranged = df.repartitionByRange(*keys, *order)
    return store(ranged.withColumn(CHUNK, F.spark_partition_id()), "chunks")


def _parts(spark: SparkSession, rows: int, part_rows: int) -> int:
    """Partitions of ``part_rows`` rows, or of up to ``FULL_ROWS`` where more of them would have the rows sorted on the way.

    Up to ``spark.shuffle.sort.bypassMergeThreshold`` partitions, a task that deals rows writes them to their partitions as they come; above,
    it holds and sorts all rows of its input split first, and with splits of millions of rows that spills.
    """
    unsorted = int(spark.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    few = max(unsorted, spark.sparkContext.defaultParallelism)
    return max(1, math.ceil(rows / FULL_ROWS), min(math.ceil(rows / part_rows), few))


def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows dealt by ``keys``, about ``GROUP_ROWS`` to a partition whatever the shuffle setting; a grouping by ``keys`` takes them as they are.

    For keys that nearly every row has for itself: sums before the shuffle would only fill memory there. The rows are counted first.
    """
    spark = df.sparkSession
    return df.repartition(max(spark.sparkContext.defaultParallelism, _parts(spark, df.count(), GROUP_ROWS)), *keys)


def _carried(df: DataFrame, carry: DataFrame, keys: Sequence[str]) -> DataFrame:
    # At most one series continues into any chunk, so ``carry`` has at most one row per chunk:
    # its size is bounded by the partition count, whatever the data.
    return join_series(df, F.broadcast(carry), keys, "left", [CHUNK])


def _heads(df: DataFrame, keys: Sequence[str], block: Sequence[str], figures: dict[str, Column]) -> tuple[DataFrame, int] | None:
    """One row per block of each series with its figures, and the number of range partitions; none if a block is too large."""
    heads = store(df.groupBy(*keys, *block).agg(F.count("*").alias("__rows"), *[c.alias(n) for n, c in figures.items()]), "blocks")
    size = heads.agg(F.max("__rows").alias("most"), F.sum("__rows").alias("all")).first()
    if (size.most or 0) > BLOCK_ROWS:
        return None
    return heads, _parts(df.sparkSession, size.all or 0, PART_ROWS)


def _headed(df: DataFrame, heads: DataFrame, parts: int, keys: Sequence[str], block: Sequence[str]) -> DataFrame:
    """Rows and heads in range partitions of whole blocks, which a window over (series, block) takes as they are."""
    both = df.withColumn("__row", F.lit(1)).unionByName(heads.withColumn("__row", F.lit(0)), allowMissingColumns=True)
    return both.repartitionByRange(parts, *keys, *block)


def _block_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column], block: Sequence[str]
) -> DataFrame | None:
    names = list(totals)
    found = _heads(df, keys, block, {f"__sum_{n}": F.sum(c) for n, c in totals.items()})
    if found is None:
        return None
    before = Window.partitionBy(*keys).orderBy(*block).rowsBetween(Window.unboundedPreceding, -1)
    heads = found[0].select(*keys, *block, *[F.coalesce(F.sum(f"__sum_{n}").over(before), F.lit(0)).alias(f"__open_{n}") for n in names])
    rows = _headed(df, heads, found[1], keys, block)
    within = Window.partitionBy(*keys, *block).orderBy("__row", *[c for c in order if c not in block]).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"__run_{n}": F.sum(F.when(F.col("__row") == 0, F.col(f"__open_{n}")).otherwise(totals[n])).over(within) for n in names})
    return summed.where("__row = 1").select(*[c for c in df.columns if c not in names], *[F.col(f"__run_{n}").alias(n) for n in names])


def running_totals(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], totals: dict[str, Column], block: Sequence[str] = ()
) -> DataFrame:
    """Add one cumulative sum per entry of ``totals``, current row included; nulls add nothing."""
    if block:
        summed = _block_totals(df, keys, order, totals, block)
        if summed is not None:
            return summed
    names = list(totals)
    rows = chunked(df.withColumns({f"__in_{n}": totals[n] for n in names}), keys, order)
    per_chunk = rows.groupBy(*keys, CHUNK).agg(*[F.sum(f"__in_{n}").alias(n) for n in names], F.lit(True).alias("__seen"))
    before = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = per_chunk.select(
        *keys,
        CHUNK,
        F.first("__seen").over(before).alias("__continues"),
        *[F.sum(n).over(before).alias(f"__carry_{n}") for n in names],
    ).where("__continues").drop("__continues")
    within = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.withColumns({f"__run_{n}": F.sum(f"__in_{n}").over(within) for n in names})
    joined = _carried(summed, carry, keys)
    zero = F.lit(0)
    return joined.select(
        *df.columns,
        *[(F.coalesce(f"__run_{n}", zero) + F.coalesce(f"__carry_{n}", zero)).alias(n) for n in names],
    )


def row_numbers(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "load_seq") -> DataFrame:
    """1, 2, 3, ... along each series."""
    numbered = running_totals(df, keys, order, {name: F.lit(1).cast("bigint")})
    return numbered.withColumn(name, F.col(name).cast("bigint"))


def _block_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], block: Sequence[str]
) -> DataFrame | None:
    rest = [c for c in order if c not in block]
    packed = F.struct(*columns)
    # a null in the order must not hide its row, and a struct is never null
    found = _heads(df, keys, block, {"__last": F.max_by(packed, F.struct(*rest))})
    if found is None:
        return None
    carried = F.lag("__last").over(Window.partitionBy(*keys).orderBy(*block))
    rows = _headed(df, found[0].select(*keys, *block, carried.alias("__carry")), found[1], keys, block)
    within = Window.partitionBy(*keys, *block).orderBy("__row", *rest)
    seen = rows.withColumn("__prev", F.lag(F.when(F.col("__row") == 0, F.col("__carry")).otherwise(packed)).over(within))
    return seen.where("__row = 1").select(*df.columns, *[F.col("__prev")[c].alias(f"prev_{c}") for c in columns])


def previous_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], columns: Sequence[str], block: Sequence[str] = ()
) -> DataFrame:
    """Add ``prev_<column>`` from the row before in the same series; null on its first row."""
    if block:
        seen = _block_previous(df, keys, order, columns, block)
        if seen is not None:
            return seen
    rows = chunked(df, keys, order)
    packed = F.struct(*columns)
    last = rows.groupBy(*keys, CHUNK).agg(F.max_by(packed, F.struct(*order)).alias("__last"))
    carry = last.select(
        *keys, CHUNK, F.lag("__last").over(Window.partitionBy(*keys).orderBy(CHUNK)).alias("__carry")
    ).where(F.col("__carry").isNotNull())
    within = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    joined = _carried(rows.withColumn("__prev", F.lag(packed).over(within)), carry, keys)
    before = F.coalesce("__prev", "__carry")
    return joined.select(*df.columns, *[before[c].alias(f"prev_{c}") for c in columns])


def exact_quantiles(values: DataFrame, keys: Sequence[str], value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles per key, one column ``q<i>`` per probability.

    Equal values collapse before the shuffle; cumulative counts over the distinct values locate
    the two ranks around each quantile, so no task ever holds a whole column.
    """
    counts = (
        values.where(F.col(value).isNotNull())
        .groupBy(*keys, F.col(value).cast("double").alias("__v"))
        .agg(F.count("*").alias("__n"))
    )
    ranked = running_totals(counts, keys, ["__v"], {"__upto": F.col("__n")})
    size = ranked.groupBy(*keys).agg(F.max("__upto").alias("__size"))
    placed = attach_stats(ranked, size, keys)

    def position(p: float) -> Column:
        return (F.col("__size") - 1) * F.lit(float(p))

    figures = []
    for i, p in enumerate(probabilities):
        for end, rank in (("lo", F.floor(position(p))), ("hi", F.ceil(position(p)))):
            here = (F.col("__upto") - F.col("__n") <= rank) & (rank < F.col("__upto"))
            figures.append(F.max(F.when(here, F.col("__v"))).alias(f"__{end}{i}"))
    found = placed.groupBy(*keys).agg(F.max("__size").alias("__size"), *figures)
    return found.select(
        *keys,
        *[
            (
                F.col(f"__lo{i}")
                + (F.col(f"__hi{i}") - F.col(f"__lo{i}")) * (position(p) - F.floor(position(p)))
            ).alias(f"q{i}")
            for i, p in enumerate(probabilities)
        ],
    )
