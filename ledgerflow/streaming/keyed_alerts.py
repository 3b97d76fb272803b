"""Alerts from keyed streaming state: each account keeps its balance and a week of daily nets, and nothing is read again.

Movements are summed per account and day inside each task, then handed to ``transformWithState``: the state of an account
is a fixed 10 numbers, however long its history, kept in the RocksDB state store and checkpointed with the offsets.
Each batch gives one row per account that moved; the thresholds are column expressions on it, and the 90-day projection comes
from a join with the saved model, one row per account. The file sink's log makes a replayed batch log nothing twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerflow.config import Thresholds
from ledgerflow.operators.alerts import checked_rows
from ledgerflow.operators.forecast import apply_base
from ledgerflow.shipping import ship_package

KEY = "bank_account"
WEEK = 7
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = f"{KEY} string, day int, current_cents bigint, old_cents bigint"


def daily_parts(movements: DataFrame) -> DataFrame:
    """Movements as (account, day number, cents), summed within each Arrow batch: a busy account sends few rows."""
    ship_package(movements.sparkSession)
    rows = movements.where(F.col("amount").isNotNull() & F.col("ts").isNotNull()).select(
        KEY, F.datediff(F.to_date("ts"), F.lit("1970-01-01").cast("date")).alias("day"), (F.col("amount") * 100).cast("bigint").alias("cents")
    )

    def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            summed = pa.Table.from_batches([batch]).group_by([KEY, "day"]).aggregate([("cents", "sum")])
            yield from summed.select([KEY, "day", "cents_sum"]).rename_columns([KEY, "day", "cents"]).to_batches()

    return rows.mapInArrow(combined, f"{KEY} string, day int, cents bigint")


class WeekOfBalances(StatefulProcessor):
    """State: first and last day, the sum before the week, and the week's seven daily nets, the last day last."""

    def __init__(self, opening_cents: int = 0):
        self.opening = opening_cents

    def init(self, handle: StatefulProcessorHandle) -> None:
        fields = ", ".join(["first int", "last int", "before bigint", *(f"n{k} bigint" for k in range(WEEK))])
        self.state = handle.getValueState("week", fields)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        nets: dict[int, int] = {}
        for part in rows:
            for day, cents in zip(part["day"].tolist(), part["cents"].tolist(), strict=True):
                nets[day] = nets.get(day, 0) + cents
        if not nets:
            return
        held = self.state.get() if self.state.exists() else None
        first, last, before, *week = [int(x) for x in held] if held else [min(nets), max(nets), 0, *[0] * WEEK]
        first, newest = min(first, *nets), max(last, *nets)
        if newest > last:
            passed = min(newest - last, WEEK)
            before += sum(week[:passed])
            week = week[passed:] + [0] * passed
        for day, cents in nets.items():
            place = day - newest + WEEK - 1
            if place < 0:  # a late day before the week moves every balance of the week
                before += cents
            else:
                week[place] += cents
        self.state.update((first, newest, before, *week))
        current = self.opening + before + sum(week)
        old = self.opening + before + week[0] if newest - (WEEK - 1) >= first else None
        found = pd.DataFrame({KEY: [key[0]], "day": [newest], "current_cents": [current], "old_cents": pd.array([old], dtype="Int64")})
        yield found.astype({"day": "int32", "current_cents": "int64"})

    def close(self) -> None:
        pass


def account_states(movements: DataFrame, opening_cents: int = 0) -> DataFrame:
    """For each batch and account that moved: its last day, that day's closing balance and the one six days before."""
    movements.sparkSession.conf.set(STORE, ROCKSDB)
    states = daily_parts(movements).groupBy(KEY).transformWithStateInPandas(WeekOfBalances(opening_cents), STATE, "append", "none")
    money = lambda c: F.col(c) / F.lit(100.0)
    return states.select(KEY, F.date_add(F.lit("1970-01-01").cast("date"), F.col("day")).alias("date"), money("current_cents").alias("current"), money("old_cents").alias("old"))


def alert_rows(states: DataFrame, model: DataFrame | None = None, limits: Thresholds = Thresholds(), horizon: int = 90) -> DataFrame:
    """A1, A2 and, with a saved base ``model`` (one row per account), A4 of each state row."""
    if model is None:
        ahead = states.withColumn("forecast_90d", F.lit(None).cast("double"))
    else:
        joined = states.join(model, KEY, "left").withColumn("ds", F.date_add("date", horizon))
        ahead = apply_base(joined, [KEY], keep=["date", "current", "old"]).withColumnRenamed("yhat", "forecast_90d")
    return checked_rows(ahead, [KEY, "date"], limits)


def run_keyed_alerts(
    movements: DataFrame, log: str, checkpoint: str, model: DataFrame | None = None, opening_cents: int = 0, limits: Thresholds = Thresholds()
) -> DataFrame:
    """Check everything available, append the alerts to ``log`` and return it."""
    found = alert_rows(account_states(movements, opening_cents), model, limits)
    query = (
        found.writeStream.outputMode("append").format("parquet").option("path", log).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return movements.sparkSession.read.schema(f"{KEY} string, date date, code string, severity string, message string").parquet(log)
