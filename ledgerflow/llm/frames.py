"""Frame helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerflow.shipping import ship_package

Added = Callable[[pa.RecordBatch], Iterator[tuple[pa.RecordBatch, dict[str, pa.Array]]]]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def with_arrow(df: DataFrame, added: Added, columns: str) -> DataFrame:
    """Narrow pass that adds columns: ``added`` yields parts of each batch with their new columns.

    A column of ``df`` that has the name of an added one is replaced.
    """
    new = StructType.fromDDL(columns)
    kept = [f for f in df.schema.fields if f.name.lower() not in {n.lower() for n in new.fieldNames()}]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in added(batch):
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), *values.values()], names=[*names, *values]
                )

    ship_package(df.sparkSession)
    return df.mapInArrow(run, StructType([*kept, *new.fields]))
