"""Threshold alerts and their texts. Nothing here sends anything."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.config import Thresholds
from ledgerflow.functions.keyed import attach_stats, by_series
from ledgerflow.functions.measures import share
from ledgerflow.functions.text import euros, percent
from ledgerflow.sources.shared import store

ALERT_COLUMNS = ["code", "severity", "message", "triggered"]

# Texts of the digests.
NO_ALERTS = "No hay alertas activas. Sistema OK."
TITLE = "ALERTA DE TESORERIA"
STATUS_TITLE = "=== ESTADO ACTUAL DE TESORERIA ==="


def _alert(df: DataFrame, keys: Sequence[str], code: str, severity: str, message: Column, when: Column) -> DataFrame:
    return df.select(
        *keys,
        F.lit(code).alias("code"),
        F.lit(severity).alias("severity"),
        message.alias("message"),
        F.coalesce(when, F.lit(False)).alias("triggered"),
    )


def _low_balance(balance: Column, limits: Thresholds) -> tuple[str, str, Column, Column]:
    floor = F.lit(limits.min_balance)
    return "A1", "CRITICAL", F.concat(F.lit("CASH BAJO: "), euros(balance), F.lit(" (min: "), euros(floor), F.lit(")")), balance < floor


def _weekly_drop(variation: Column, old: Column, current: Column, limits: Thresholds) -> tuple[str, str, Column, Column]:
    text = F.concat(F.lit("CAIDA SEMANAL: "), percent(variation), F.lit(" ("), F.format_number(old, 0), F.lit(" -> "), euros(current), F.lit(")"))
    return "A2", "HIGH", text, variation < limits.min_variation_7d


def _low_projection(value: Column, limits: Thresholds) -> tuple[str, str, Column, Column]:
    floor = F.lit(limits.projection_floor)
    text = F.concat(F.lit("PROYECCION NEGATIVA: "), euros(value), F.lit(" a 90 dias (floor: "), euros(floor), F.lit(")"))
    return "A4", "CRITICAL", text, value < floor


def balance_alert(latest: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """A1. ``latest`` has one ``current_cash_balance`` per series."""
    return _alert(latest, keys, *_low_balance(F.col("current_cash_balance").cast("double"), limits))


def checked_rows(states: DataFrame, keep: Sequence[str], limits: Thresholds = Thresholds()) -> DataFrame:
    """A1, A2 and A4 of rows that carry ``current``, ``old`` and ``forecast_90d``: the triggered ones, one row each.

    Column expressions only, so it serves a stream: the rows are not read once per alert.
    """
    current, old = F.col("current"), F.col("old")
    checks = [
        _low_balance(current, limits),
        _weekly_drop(share(current - old, old), old, current, limits),
        _low_projection(F.col("forecast_90d"), limits),
    ]
    entries = F.array(
        *[F.struct(F.lit(code).alias("code"), F.lit(severity).alias("severity"), text.alias("message"), F.coalesce(when, F.lit(False)).alias("triggered")) for code, severity, text, when in checks]
    )
    return states.withColumn("__a", F.explode(F.filter(entries, lambda a: a["triggered"]))).select(*keep, "__a.code", "__a.severity", "__a.message")


def weekly_variation(daily: DataFrame, keys: Sequence[str] = (), lag: int = 6) -> DataFrame:
    """Last balance against the one ``lag`` rows earlier."""
    balance = F.col("cash_balance").cast("double")
    lagged = daily.select(*keys, "date", balance.alias("current"), F.lag(balance, lag).over(by_series(keys, "date")).alias("old"))
    last = lagged.groupBy(*keys).agg(F.max_by(F.struct("current", "old"), "date").alias("__last"))
    return last.select(*keys, "__last.current", "__last.old").withColumn(
        "variation", share(F.col("current") - F.col("old"), F.col("old"))
    )


def variation_alert(
    daily: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds(), lag: int = 6
) -> DataFrame:
    """A2. Silent on a short series or a zero old balance."""
    moved = weekly_variation(daily, keys, lag)
    return _alert(moved, keys, *_weekly_drop(F.col("variation"), F.col("old"), F.col("current"), limits))


def deviation_alert(pairs: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """A3. ``pairs`` has ``actual`` and ``forecast`` per series; silent on a zero forecast."""
    off = share(F.abs(F.col("actual") - F.col("forecast")), F.abs("forecast"))
    text = F.concat(
        F.lit("DESVIACION: "), percent(off), F.lit(" (actual: "), F.format_number("actual", 0),
        F.lit(", forecast: "), F.format_number("forecast", 0), F.lit(")"),
    )
    return _alert(pairs, keys, "A3", "MEDIUM", text, off > limits.max_deviation_forecast)


def projection_alert(ahead: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """A4. ``ahead`` has one ``forecast_90d`` per series."""
    return _alert(ahead, keys, *_low_projection(F.col("forecast_90d"), limits))


def negative_projection_alert(ahead: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """A4_neg: the projection itself is below zero."""
    text = F.concat(F.lit("PROYECCION NEGATIVA: Saldo proyectado a 90 dias: "), euros(F.col("forecast_90d")))
    return _alert(ahead, keys, "A4_neg", "CRITICAL", text, F.col("forecast_90d") < 0)


def floor_alert(forecast: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds()) -> DataFrame:
    """A6: any forecast day below the floor."""
    low = forecast.groupBy(*keys).agg(F.min("yhat").alias("__low"))
    floor = F.lit(limits.projection_floor)
    text = F.concat(F.lit("PREDICCION BAJO FLOOR: "), euros(F.col("__low")), F.lit(" (floor: "), euros(floor), F.lit(")"))
    return _alert(low, keys, "A6", "HIGH", text, F.col("__low") < floor)


def anomalous_movements(
    bank: DataFrame, keys: Sequence[str] = (), by_category: bool = False, limits: Thresholds = Thresholds()
) -> DataFrame:
    """A5: movements above three times the mean absolute amount of their account (or category).

    The mean is aggregated and joined back instead of windowed, so the ledger of a large account
    is not gathered in one task; stored, its size decides between broadcast and sort-merge.
    """
    scope = [*keys, "category"] if by_category else list(keys)
    size = F.abs("amount")
    mean = bank.groupBy(*scope).agg(
        F.try_divide(F.sum(size).cast("double"), F.count("amount").cast("double")).alias("mean_abs_amount")
    )
    odd = attach_stats(bank, store(mean, "mean_abs_amount") if scope else mean, scope)
    return odd.where(size.cast("double") > limits.anomaly_multiplier * F.col("mean_abs_amount"))


def check_all(
    daily: DataFrame,
    latest: DataFrame,
    ahead: DataFrame | None = None,
    keys: Sequence[str] = (),
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """A1, A2 and, with a forecast, A4: the triggered ones, per series."""
    found = balance_alert(latest, keys, limits).unionByName(variation_alert(daily, keys, limits))
    if ahead is not None:
        found = found.unionByName(projection_alert(ahead, keys, limits))
    return found.where("triggered")


def digest(
    alerts: DataFrame,
    series: DataFrame | None = None,
    keys: Sequence[str] = (),
    title: str = TITLE,
    at: datetime | None = None,
) -> DataFrame:
    """One text per series, alerts grouped by severity; the all-clear text where there are none.

    Alerts of one code and severity are one entry: the first message and how many more there are, so the
    collected list has at most one entry per code however many rows fired (the log has them all). Other severities are
    listed last. ``series`` lists the series that must appear even without alerts; it is not needed for a single series.
    """
    levels = ["CRITICAL", "HIGH", "MEDIUM", "OTHER"]
    level_of = F.when(F.col("severity").isin(levels[:3]), F.col("severity")).otherwise("OTHER")
    per_code = alerts.groupBy(*keys, level_of.alias("severity"), "code").agg(F.min("message").alias("message"), F.count("*").alias("n"))
    more = F.when(F.col("n") > 1, F.format_string(" (+%d)", F.col("n") - 1)).otherwise("")
    entry = F.concat(F.lit("  ["), "code", F.lit("] "), "message", more)
    found = per_code.groupBy(*keys).agg(
        *[F.array_sort(F.collect_list(F.when(F.col("severity") == level, entry))).alias(level) for level in levels]
    )
    rule = F.lit("=" * 50)
    blocks = [
        F.when(F.size(level) > 0, F.concat(F.lit(f"{level}:\n"), F.array_join(level, "\n"), F.lit("\n"))) for level in levels
    ]
    dated = [F.lit(f"Fecha: {at:%Y-%m-%d %H:%M:%S}"), F.lit("")] if at else []
    text = F.concat_ws("\n", rule, F.lit(title), rule, *dated, *blocks, rule)
    some = F.coalesce(F.size("CRITICAL") + F.size("HIGH") + F.size("MEDIUM") + F.size("OTHER") > 0, F.lit(False))
    if series is not None and keys:
        found = attach_stats(series.select(*keys).distinct(), found, keys)
    return found.select(*keys, F.when(some, text).otherwise(F.lit(NO_ALERTS)).alias("message"))


def status_message(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Balance, inflow and outflow of the latest row, as text."""
    last = daily.groupBy(*keys).agg(
        F.max_by(F.struct("cash_balance", "cash_inflow", "cash_outflow"), "date").alias("r")
    )
    lines = F.concat_ws(
        "\n",
        F.lit(STATUS_TITLE),
        F.lit(""),
        F.concat(F.lit("Saldo actual: "), euros(F.col("r.cash_balance"), 2)),
        F.concat(F.lit("Ingresos 30d: "), euros(F.col("r.cash_inflow"), 2)),
        F.concat(F.lit("Gastos 30d: "), euros(F.col("r.cash_outflow"), 2)),
    )
    return last.select(*keys, lines.alias("message"))
