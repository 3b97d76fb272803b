"""Reading datasets into a catalog, and SQL over it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.schemas import OPTIONAL, REQUIRED, TABLES, raw_schema
from ledgerflow.sources.quoted_csv import malformed_counts, read_quoted_csv


def list_datasets(spark: SparkSession, folder: str, suffix: str = ".csv") -> list[str]:
    """Stems of the files (or part-file folders) directly under the folder: one level is listed, by name only."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return []
    names = (status.getPath().getName() for status in files.listStatus(path))
    return sorted(n[: -len(suffix)] for n in names if n.endswith(suffix) and len(n) > len(suffix))


def read_csv(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text, plus ``load_seq``: the position of the row in the files.

    Quotes inside quoted fields are doubled, as RFC 4180 has it. ``multi_line`` allows line breaks inside quoted
    fields; a file is still read by many tasks (:mod:`ledgerflow.sources.quoted_csv`).
    File, block start and row within the block give file order without a global numbering pass.
    """
    if multi_line:
        return read_quoted_csv(spark, path).drop("malformed")
    rows = spark.read.csv(path, header=True, inferSchema=False, encoding="UTF-8", quote='"', escape='"')
    at = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    return rows.withColumn("load_seq", at)


def read_catalog(spark: SparkSession, folder: str, fmt: str = "csv", multi_line: bool = False) -> dict[str, DataFrame]:
    """Every dataset of a folder, keyed by file stem. Lazy."""
    folder = folder.rstrip("/")
    if fmt == "csv":
        return {name: read_csv(spark, f"{folder}/{name}.csv", multi_line) for name in list_datasets(spark, folder)}
    return {
        name: spark.read.format(fmt).load(f"{folder}/{name}.{fmt}") for name in list_datasets(spark, folder, f".{fmt}")
    }


def malformed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """``dataset``, ``file``, ``rows`` and ``malformed`` of every CSV file of a folder: rows that a reader pads, cuts or never closes."""
    out = spark.createDataFrame([], "dataset string, file string, rows bigint, malformed bigint")
    for name in list_datasets(spark, folder):
        found = malformed_counts(read_quoted_csv(spark, f"{folder.rstrip('/')}/{name}.csv"))
        out = out.unionByName(found.select(F.lit(name).alias("dataset"), "file", "rows", "malformed"))
    return out


def read_dataset(spark: SparkSession, name: str, *folders: str, fmt: str = "csv") -> DataFrame | None:
    """The dataset from the first folder that has it; ``None`` when no folder does."""
    for folder in folders:
        path = f"{folder.rstrip('/')}/{name}.{fmt}"
        try:
            return read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return None


def read_or_empty(spark: SparkSession, name: str, *folders: str, fmt: str = "csv") -> DataFrame:
    """Like :func:`read_dataset`, with an empty typed frame when the dataset is missing."""
    found = read_dataset(spark, name, *folders, fmt=fmt)
    if found is not None:
        return found
    schema = TABLES.get(name) or (raw_schema(name) if name in REQUIRED or name in OPTIONAL else "value string")
    return spark.createDataFrame([], schema)


def register(datasets: Mapping[str, DataFrame]) -> None:
    for name, df in datasets.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, sql: str, args: Sequence | Mapping | None = None, **frames: DataFrame) -> DataFrame:
    """Ad-hoc SQL with positional or named parameters; frames may be named as ``{name}``."""
    if isinstance(args, Mapping):
        return spark.sql(sql, args=dict(args), **frames)
    return spark.sql(sql, args=list(args) if args else None, **frames)
