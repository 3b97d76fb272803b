"""CSV with line breaks inside quoted fields (RFC 4180), read by many tasks per file.

A line break ends a record only where the number of quotation marks before it is even. So a first pass counts the marks
of each block of a file (a block is what Spark gives one task); the parity at a block's start is the parity of the
counts before it, a running sum over blocks, not over rows. The second pass knows its start and cuts records locally. A
record that crosses a block's border comes out in pieces, at most two a block, which are put together afterwards.
The blocks' starts are sent to all tasks while they are few (one row per block); beyond that, lines and starts are
joined by block and put back into order.

``malformed`` marks records with another number of fields than the header, or with a quotation mark that is never closed.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ledgerflow.shipping import ship_package
from ledgerflow.sources.shared import store

SENT_BLOCKS = 100_000
#: an empty field without quotation marks is null, one with them is the empty text
_READING = {"quotechar": '"', "doublequote": True, "strict": False, "quoting": csv.QUOTE_NOTNULL}
_PIECE = "file string, block bigint, part bigint, record string, whole boolean, starts boolean, ends boolean"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    lines = spark.read.text(path, lineSep="\n")
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), "value"
    )


def _starts(lines: DataFrame) -> DataFrame:
    """Whether each block of each file starts inside a quoted field; one row per block."""
    marks = F.char_length("value") - F.char_length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "block").agg(F.sum(marks).alias("marks"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counts.select("file", "block", (F.coalesce(F.sum("marks").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of the blocks that a task reads, line by line; pieces at the blocks' borders."""
    out: list[dict] = []
    at, held, inside, starts, part = None, [], False, True, 0

    def piece(ends: bool) -> None:
        nonlocal held, starts, part
        out.append({"file": at[0], "block": at[1], "part": part, "record": "\n".join(held), "whole": starts and ends, "starts": starts, "ends": ends})
        held, starts, part = [], True, part + 1

    def table() -> pa.RecordBatch:
        nonlocal out
        made, out = pa.RecordBatch.from_pylist(out, schema=_SCHEMA), []
        return made

    for batch in batches:
        rows = zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value", "inside")), strict=True)
        for file, block, line, open_at_start in rows:
            if (file, block) != at:
                if held:
                    piece(False)
                at, inside, starts, part = (file, block), open_at_start, not open_at_start, 0
            held.append(line)
            inside ^= line.count('"') % 2 == 1
            if not inside:
                piece(True)
        if out:
            yield table()
    if held:
        piece(False)
    if out:
        yield table()


_SCHEMA = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("part", pa.int64()), ("record", pa.string()), ("whole", pa.bool_()), ("starts", pa.bool_()), ("ends", pa.bool_())]
)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block``, ``part`` (the record's place), ``record`` (its text) and ``closed``, of every record."""
    ship_package(spark)
    lines = _lines(spark, path)
    starts = store(_starts(lines), "block_starts")
    if starts.count() <= SENT_BLOCKS:
        known = lines.join(F.broadcast(starts), ["file", "block"])
    else:
        known = lines.join(starts, ["file", "block"]).repartition("file", "block").sortWithinPartitions("file", "block", "row")
    pieces = known.select("file", "block", "value", "inside").mapInArrow(_cut, _PIECE)
    whole = pieces.where("whole").select("file", "block", "part", "record", F.lit(True).alias("closed"))
    cut = pieces.where("NOT whole")
    order = Window.partitionBy("file").orderBy("block", "part")
    named = cut.withColumn("__first", F.last(F.when(F.col("starts"), F.struct("block", "part")), ignorenulls=True).over(order))
    joined = named.groupBy("file", "__first").agg(F.sort_array(F.collect_list(F.struct("block", "part", "record"))).alias("p"), F.max("ends").alias("closed"))
    return whole.unionByName(joined.select("file", "__first.block", "__first.part", F.array_join("p.record", "\n").alias("record"), "closed"))


def _fields(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [r.removesuffix("\r") for r in batch.column("record").to_pylist()]
            found = [next(csv.reader([t.removeprefix("\ufeff") if first else t], **_READING), []) for t, first in zip(texts, batch.column("first").to_pylist(), strict=True)]
            odd = [len(f) != width or not closed for f, closed in zip(found, batch.column("closed").to_pylist(), strict=True)]
            even = [(f + [None] * width)[:width] for f in found]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("file", "block", "part", "first")), pa.array(even, pa.list_(pa.string())), pa.array(odd, pa.bool_())],
                names=["file", "block", "part", "first", "fields", "malformed"],
            )

    return run


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """The header's columns as text, ``load_seq`` (the row's place in the files) and ``malformed``.

    Each file's first record is its header; empty records are left out. Too short records end in nulls, too long ones lose
    their last fields, and both are marked: :func:`malformed_counts` tells how many, per file.
    """
    header = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", quote='"', escape='"', multiLine=True).columns
    named = records(spark, path).withColumn("first", (F.col("block") == 0) & (F.col("part") == 0))
    parsed = named.where("record NOT IN ('', '\r')").mapInArrow(_fields(len(header)), "file string, block bigint, part bigint, first boolean, fields array<string>, malformed boolean")
    rows = parsed.where("NOT first")
    place = F.struct("file", "block", F.col("part").alias("row"))
    return rows.select(*[F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(header)], place.alias("load_seq"), "malformed")


def malformed_counts(rows: DataFrame) -> DataFrame:
    """``file``, ``rows`` and ``malformed`` of each file with rows."""
    return rows.groupBy(F.element_at(F.split("load_seq.file", "/"), -1).alias("file")).agg(F.count("*").alias("rows"), F.count_if("malformed").alias("malformed"))
