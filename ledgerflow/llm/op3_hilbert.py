"""Hilbert-curve sharding: metadata dimensions are quantised, rows sorted by curve index and cut into runs.

Law ``rows``: shard sizes are at most one apart. Language and source are quantised to equal depth over all rows
(a value's cell is 32 * rows before it / rows), size to its binary magnitude; 5 bits each. The index is
computed for whole Arrow batches with bit operations. Rows are range-partitioned by (index, id, place read), so a
value that holds any share of the rows is split; ranks come from chunk totals carried forward. Texts are
only read for size and checksum and are not shuffled; :func:`write_shards` moves them once.

Rules: null text has size 8 and checksum 0; null language or source sorts as empty; repeated rows get slots of their own;
fewer rows than shards leave shards empty; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.llm.frames import documents, with_arrow
from ledgerflow.operators.ordered import CHUNK, chunked, running_totals

SHARDS = 24
BITS = 5
CELLS = 1 << BITS


def hilbert_index(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Index on the curve of each row of ``cells`` (rows x dimensions, values below 2**bits).

    Works from the most significant bit down: each bit that is set inverts, each that is not exchanges, the lower bits
    of the first axis; the result is then Gray-decoded across axes and its bits are interleaved.
    """
    axes = [cells[:, d].astype(np.int64) for d in range(cells.shape[1])]
    for b in range(bits - 1, 0, -1):
        low = (1 << b) - 1
        for d in range(len(axes)):
            on = (axes[d] >> b & 1).astype(bool)
            swap = np.where(on, 0, (axes[0] ^ axes[d]) & low)
            axes[0] = np.where(on, axes[0] ^ low, axes[0] ^ swap)
            axes[d] = axes[d] ^ swap if d else axes[0]
    for d in range(1, len(axes)):
        axes[d] = axes[d] ^ axes[d - 1]
    carry = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, 0, -1):
        carry ^= np.where(axes[-1] >> b & 1, (1 << b) - 1, 0)
    index = np.zeros(len(cells), np.int64)
    for b in range(bits - 1, -1, -1):
        for axis in axes:
            index = index << 1 | ((axis ^ carry) >> b & 1)
    return index


def equal_depth(df: DataFrame, column: str, cells: int = CELLS) -> Column:
    """Cell of a text column: ``floor(cells * rows with a smaller value / rows)``, as at most ``cells`` comparisons."""
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    counts = df.groupBy(value.alias("v")).agg(F.count("*").alias("n"))
    total = F.lit(df.count())
    ranked = running_totals(counts, [], ["v"], {"upto": F.col("n")})
    cell = F.floor(cells * (F.col("upto") - F.col("n")) / total).cast("int")
    edges = ranked.groupBy(cell.alias("cell")).agg(F.min("v").alias("low")).collect()
    out = F.lit(0)
    for edge in sorted(edges, key=lambda r: r.cell):
        out = F.when(value >= edge.low, edge.cell).otherwise(out)
    return out


def magnitude(size: Column) -> Column:
    return F.least(F.floor(F.log2(F.greatest(size, F.lit(1)))), F.lit(CELLS - 1)).cast("int")


def with_index(df: DataFrame, dimensions: list[str]) -> DataFrame:
    """Add ``curve``, the index of the cells in ``dimensions``."""

    def added(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]:
        cells = np.stack([batch.column(d).to_numpy(zero_copy_only=False) for d in dimensions], 1)
        yield batch, {"curve": pa.array(hilbert_index(cells), pa.int64())}

    return with_arrow(df, added, "curve bigint")


def hilbert_shards(docs: DataFrame, shards: int = SHARDS, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``size``, ``text_crc32``, ``curve``, ``shard`` and ``slot`` of each row."""
    cells = {"__lang": equal_depth(docs, "lang"), "__source": equal_depth(docs, "source")}
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8
    narrow = docs.select(
        *keep,
        size.alias("size"),
        F.coalesce(F.crc32(F.col(text)), F.lit(0)).alias("text_crc32"),
        *[c.alias(n) for n, c in cells.items()],
        magnitude(size).alias("__size"),
        F.monotonically_increasing_id().alias("__read"),
    )
    order = ["curve", *keep, "__read"]
    rows = chunked(with_index(narrow, ["__lang", "__source", "__size"]), [], order)
    # one row per range partition: the window over it and its broadcast are bounded by the partition count
    totals = rows.groupBy(CHUNK).count()
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        CHUNK,
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"),
        F.sum("count").over(Window.partitionBy(F.lit(0))).alias("__n"),
    )
    within = Window.partitionBy(CHUNK).orderBy(*order)
    numbered = rows.withColumn("__at", F.row_number().over(within) - 1).join(F.broadcast(carried), CHUNK)
    rank = F.col("__before") + F.col("__at")
    shard = F.expr(f"(__rank * {shards}) div __n")
    first = F.expr(f"(shard * __n + {shards - 1}) div {shards}")
    placed = numbered.withColumn("__rank", rank).withColumn("shard", shard).withColumn("slot", F.col("__rank") - first)
    return placed.select(*keep, "size", "text_crc32", "curve", F.col("shard").cast("int").alias("shard"), F.col("slot").cast("bigint").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS) -> None:
    """Write the documents, one folder per shard, in curve order; ``doc_id`` must be unique."""
    placed = hilbert_shards(docs, shards).select("doc_id", "shard", "slot")
    joined = docs.join(placed, "doc_id")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op3_hilbert(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert_shards(documents(spark, sf_dir))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )
