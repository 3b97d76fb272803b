"""Account movements from the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerflow.config import MONEY


def event_ledger(events: DataFrame) -> DataFrame:
    """Works on a batch and on a stream."""
    income = F.col("event_type").isin("purchase", "signup")
    return events.select(
        F.col("event_id").alias("movement_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat(F.lit("ACC-"), (F.col("user_id") % 10).cast("string")).alias("bank_account"),
        F.when(income, F.col("value")).otherwise(-F.col("value")).cast(MONEY).alias("amount"),
        F.col("event_type").alias("category"),
    )
