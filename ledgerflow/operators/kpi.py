"""Treasury KPIs and the dashboard's analytics views."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ledgerflow.config import WEEKDAY_LABELS, Thresholds
from ledgerflow.functions.dates import month_label
from ledgerflow.functions.keyed import attach_stats
from ledgerflow.functions.measures import code_risk_band, exact_mean, risk_label, risk_score
from ledgerflow.operators.clean import between_dates
from ledgerflow.operators.forecast import forecast_at
from ledgerflow.operators.series import last_days, latest_day


def current_balance(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys).agg(
        F.max("date").alias("report_date"), F.max_by("cash_balance", "date").alias("current_cash_balance")
    )


def flows_last_days(daily: DataFrame, keys: Sequence[str] = (), days: int = 30) -> DataFrame:
    return last_days(daily, days, keys).groupBy(*keys).agg(
        F.sum("cash_inflow").alias("cash_inflow_30d"), F.sum("cash_outflow").alias("cash_outflow_30d")
    )


def gross_flows_last_days(bank: DataFrame, keys: Sequence[str] = (), days: int = 30) -> DataFrame:
    """From movements; they are summed per day before the recent days are picked."""
    amount = F.col("amount")
    per_day = bank.groupBy(*keys, "date").agg(
        F.coalesce(F.sum(F.when(amount > 0, amount)), F.lit(0)).alias("cash_inflow"),
        F.coalesce(F.sum(F.when(amount < 0, -amount)), F.lit(0)).alias("cash_outflow"),
    )
    return flows_last_days(per_day, keys, days)


def net_last_days(daily: DataFrame, keys: Sequence[str] = (), days: int = 30) -> DataFrame:
    flows = flows_last_days(daily, keys, days)
    return flows.select(*keys, (F.col("cash_inflow_30d") - F.col("cash_outflow_30d")).alias("net_30d"))


def kpi_row(
    daily: DataFrame, forecast: DataFrame, keys: Sequence[str] = (), limits: Thresholds = Thresholds()
) -> DataFrame:
    """One row per series: date, balance, flows of the last 30 days, forecast at 90 days, risk."""
    today = latest_day(daily, keys)
    ahead = forecast_at(forecast, keys, "nearest", today)
    row = attach_stats(attach_stats(current_balance(daily, keys), flows_last_days(daily, keys), keys), ahead, keys)
    return row.select(
        *keys,
        "report_date",
        F.round("current_cash_balance", 2).alias("current_cash_balance"),
        F.round("cash_inflow_30d", 2).alias("cash_inflow_30d"),
        F.round("cash_outflow_30d", 2).alias("cash_outflow_30d"),
        F.round("forecast_90d", 2).alias("forecast_90d"),
        code_risk_band(F.col("forecast_90d"), limits).alias("liquidity_risk"),
    )


def forecast_floor(
    forecast: DataFrame, start: date, end: date, keys: Sequence[str] = (), limits: Thresholds = Thresholds()
) -> DataFrame:
    return between_dates(forecast, "ds", start, end).groupBy(*keys).agg(
        F.min("yhat").alias("min_forecast"), F.count_if(F.col("yhat") < limits.min_balance).alias("days_below")
    )


def risk_gauge(kpis: DataFrame) -> DataFrame:
    band = F.col("liquidity_risk")
    return kpis.withColumns({"risk_score": risk_score(band), "risk_text": risk_label(band)})


# ---- views -------------------------------------------------------------------------------------


def monthly_flows(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return daily.groupBy(*keys, month_label(F.col("date")).alias("month")).agg(
        F.sum("cash_inflow").alias("cash_inflow"), F.sum("cash_outflow").alias("cash_outflow")
    )


def weekday_pattern(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    labels = F.array(*[F.lit(label) for label in WEEKDAY_LABELS])
    means = daily.groupBy(*keys, F.weekday("date").alias("day_of_week")).agg(exact_mean(F.col("net_cash"), 2).alias("net_cash"))
    return means.withColumn("day_name", labels[F.col("day_of_week")])


def year_month_matrix(daily: DataFrame, years: Sequence[int] | None = None, keys: Sequence[str] = (), thousands: bool = False) -> DataFrame:
    """Net cash by month (rows) and year (columns).

    Without ``years`` they are those of the data, from one small aggregate. Given years fix the columns; a year of
    the data that is not among them raises when the result is computed, as its sums would be lost.
    """
    dated = daily.select(*keys, F.year("date").alias("year"), F.month("date").alias("month"), "net_cash")
    if years is None:
        years = sorted(r.year for r in dated.where(F.col("year").isNotNull()).select("year").distinct().collect())
    else:
        outside = F.concat(F.lit("year outside the given list: "), F.col("year"))
        dated = dated.where(F.when(F.col("year").isin(list(years)) | F.col("year").isNull(), True).otherwise(F.raise_error(outside).cast("boolean")))
    sums = dated.groupBy(*keys, "month").pivot("year", list(years))
    matrix = sums.agg(F.sum("net_cash"))
    if thousands:
        matrix = matrix.withColumns({str(y): F.round(F.col(f"`{y}`") / 1000, 0).cast("bigint") for y in years})
    return matrix


def net_by_year_month(daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The same matrix in long form, for any set of years."""
    return daily.groupBy(*keys, F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.sum("net_cash").alias("net_cash")
    )


def deals_per_stage(deals: DataFrame) -> DataFrame:
    counts = deals.groupBy("stage").agg(F.count("*").alias("count"))
    whole = counts.agg(F.sum("count").alias("__all"))
    return attach_stats(counts, whole, []).select("stage", "count", (F.col("count") * 100.0 / F.col("__all")).alias("share_pct"))


def amount_per_stage(deals: DataFrame) -> DataFrame:
    return deals.groupBy("stage").agg(F.sum("expected_amount").alias("expected_amount"))


def expected_closes(deals: DataFrame) -> DataFrame:
    return (
        deals.where(F.col("expected_close").isNotNull())
        .groupBy(month_label(F.col("expected_close")).alias("month"))
        .agg(F.sum("expected_amount").alias("amount"))
    )


def crm_totals(deals: DataFrame) -> DataFrame:
    weighted = F.col("expected_amount").cast("decimal(18,2)") * F.col("probability").cast("decimal(6,4)")
    return deals.agg(
        F.sum("expected_amount").alias("total_pipeline"),
        F.sum(weighted).alias("weighted_pipeline"),
        F.coalesce(F.sum(F.when(F.col("stage") == "won", F.col("expected_amount"))), F.lit(0)).alias("won_amount"),
        F.count("*").alias("total_deals"),
    )


def invoice_totals(invoices: DataFrame) -> DataFrame:
    total = F.sum("total")
    return invoices.agg(
        total.alias("total_invoiced"),
        F.round(F.try_divide(total.cast("double"), F.count("total").cast("double")), 2).alias("avg_invoice"),
        F.count_if(F.col("status") == "paid").alias("paid_invoices"),
        F.count_if(F.col("is_overdue")).alias("overdue"),
        F.count_if(F.col("status") == "overdue").alias("status_overdue"),
    )


def invoiced_per_month(invoices: DataFrame) -> DataFrame:
    return invoices.groupBy(month_label(F.col("invoice_date")).alias("month")).agg(F.sum("total").alias("total"))


def balance_series(daily: DataFrame, start: date, end: date, keys: Sequence[str] = ()) -> DataFrame:
    return between_dates(daily, "date", start, end).select(*keys, "date", "cash_balance").orderBy(*keys, "date")
