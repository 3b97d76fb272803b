"""Incremental daily cash flow as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.config import TOTAL
from ledgerflow.operators.clean import first_per_key
from ledgerflow.sources.events import event_ledger


def read_events(spark: SparkSession, folder: str, schema, pattern: str = "*.parquet", files_per_batch: int | None = None) -> DataFrame:
    """Movement stream from event files arriving in a folder."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return event_ledger(reader.parquet(folder))


def daily_flows(movements: DataFrame, lateness: str = "1 day") -> DataFrame:
    """Net, gross and count per account and day, each movement once, late rows up to the watermark.

    The same plan serves a stream and a batch of movements. The daily aggregation reduces within
    each input partition before its shuffle.
    """
    amount = F.col("amount")
    if movements.isStreaming:
        unique = movements.withWatermark("ts", lateness).dropDuplicatesWithinWatermark(["movement_id"])
    else:
        unique = first_per_key(movements, ["movement_id"], "ts")
    days = unique.groupBy(F.window("ts", "1 day").alias("w"), "bank_account").agg(
        F.sum("amount").cast(TOTAL).alias("net_cash"),
        F.coalesce(F.sum(F.when(amount > 0, amount)).cast(TOTAL), F.lit(0).cast(TOTAL)).alias("cash_inflow"),
        F.coalesce(F.sum(F.when(amount < 0, -amount)).cast(TOTAL), F.lit(0).cast(TOTAL)).alias("cash_outflow"),
        F.count("*").alias("transaction_count"),
    )
    return days.select(
        "bank_account", F.col("w.start").cast("date").alias("date"),
        "net_cash", "cash_inflow", "cash_outflow", "transaction_count",
    )


def run_daily(movements: DataFrame, target: str, checkpoint: str, lateness: str = "1 day") -> DataFrame:
    """Process everything available, append the closed days to ``target`` and return them.

    The file sink's log and the checkpoint make a restart append each closed day exactly once.
    """
    query = (
        daily_flows(movements, lateness)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return movements.sparkSession.read.parquet(target)
