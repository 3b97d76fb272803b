"""Alert check per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.config import MONEY, TOTAL, Thresholds
from ledgerflow.operators.alerts import check_all
from ledgerflow.operators.kpi import current_balance
from ledgerflow.operators.series import densify, zero_fill

KEYS = ["bank_account"]


def balances(days: DataFrame, opening) -> DataFrame:
    """Dense daily balance of each account from its daily net amounts."""
    dense = zero_fill(densify(days, KEYS), ["net_cash"])
    so_far = Window.partitionBy(*KEYS).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dense.withColumn("cash_balance", F.lit(opening).cast(MONEY) + F.sum("net_cash").over(so_far))


class BatchAlerts:
    """``foreachBatch`` handler: merge the batch into the daily table, check, log.

    Each batch owns one folder in the partial-days table and one in the alert log and overwrites
    them when it is replayed, so every (batch, account, code) is logged once. A replayed batch reads
    only the partials up to its own number, so it also reproduces the same alerts.
    """

    def __init__(self, folder: str, opening=0, limits: Thresholds = Thresholds()):
        self.days_path = f"{folder.rstrip('/')}/days"
        self.alerts_path = f"{folder.rstrip('/')}/alerts"
        self.opening = opening
        self.limits = limits

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        partial = batch.groupBy(*KEYS, F.to_date("ts").alias("date")).agg(F.sum("amount").cast(TOTAL).alias("net_cash"))
        partial.write.mode("overwrite").parquet(f"{self.days_path}/batch={batch_id}")
        stored = spark.read.parquet(self.days_path).where(F.col("batch") <= batch_id)
        touched = stored.where(F.col("batch") == batch_id).select(*KEYS).distinct()
        days = stored.join(touched, KEYS, "left_semi").groupBy(*KEYS, "date").agg(F.sum("net_cash").cast(TOTAL).alias("net_cash"))
        daily = balances(days, self.opening)
        found = check_all(daily, current_balance(daily, KEYS), keys=KEYS, limits=self.limits)
        stamped = found.select(
            *KEYS, F.col("code").alias("alert_code"), "severity", "message",
            F.current_timestamp().alias("triggered_at"), F.lit(0).alias("resolved"),
        )
        stamped.write.mode("overwrite").parquet(f"{self.alerts_path}/batch={batch_id}")


def run_alerts(movements: DataFrame, folder: str, checkpoint: str, opening=0, limits: Thresholds = Thresholds()) -> DataFrame:
    """Check alerts over everything available and return the alert log."""
    handler = BatchAlerts(folder, opening, limits)
    query = (
        movements.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return movements.sparkSession.read.parquet(handler.alerts_path)
