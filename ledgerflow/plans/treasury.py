"""The end-to-end treasury run: raw folder to clean tables, daily series, forecast, KPIs and alerts."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.config import ModelConfig, Thresholds
from ledgerflow.operators import alerts, clean, evaluate, forecast, kpi, rules, series
from ledgerflow.sources import catalog, quality, sinks
from ledgerflow.sources.shared import store


@dataclass(frozen=True)
class TreasuryRun:
    daily: DataFrame
    rules: DataFrame
    model: DataFrame
    forecast: DataFrame
    report: DataFrame
    kpis: DataFrame
    alerts: DataFrame


ACCOUNT = ("bank_account",)


def _fit(history: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    return forecast.fit_full(history, keys) if model == "full" else forecast.fit_base(history, keys)


def _predict(fitted: DataFrame, keys: Sequence[str], model: str) -> DataFrame:
    return forecast.predict_full(fitted, keys) if model == "full" else forecast.predict_base(fitted, keys)


def plan(cleaned: dict[str, DataFrame], limits: Thresholds = Thresholds(), keys: Sequence[str] = ACCOUNT, model: str = "full") -> TreasuryRun:
    """Everything from the clean tables on, per account (``keys=[]``: the whole ledger as one series).

    ``model``: ``full`` (trend with bends, seasons, holidays) or ``base`` (weekday and month effects).

    The daily series feeds every later step and the rules read the ledger several times, so these are stored; the rest
    is lazy. KPIs and alerts use a fit on the whole series, the report a fit on its training part.
    """
    keys = list(keys)
    if model not in ("full", "base"):
        raise ValueError(f"unknown model: {model}")
    daily = store(series.cash_flow_daily(cleaned["bank_clean"], keys), "cash_flow_daily")
    parts = series.prepare_forecasting(daily, cleaned.get("external_factors_clean"), keys=keys)
    fitted = store(_fit(parts["full"], keys, model), "model")
    ahead = _predict(fitted, keys, model)
    report = evaluate.evaluation_report(parts["test"], _predict(_fit(parts["train"], keys, model), keys, model), keys)
    latest = kpi.current_balance(daily, keys)
    horizon = forecast.forecast_at(ahead, keys, as_of=series.latest_day(daily, keys))
    ledger = store(cleaned["bank_clean"].select(*keys, "movement_id", "date", "amount", "balance_after", "category"), "rules_ledger")
    return TreasuryRun(
        daily=daily,
        rules=rules.all_rules({**cleaned, "bank_clean": ledger}, keys),
        model=fitted,
        forecast=ahead,
        report=report,
        kpis=kpi.kpi_row(daily, ahead, keys, limits),
        alerts=alerts.check_all(daily, latest, horizon, keys, limits),
    )


def run(
    spark: SparkSession,
    raw_folder: str,
    out: str,
    as_of: date,
    limits: Thresholds = Thresholds(),
    keys: Sequence[str] = ACCOUNT,
    model: str = "full",
    multi_line: bool = False,
) -> TreasuryRun:
    """Read the raw CSV folder, write every result under ``out``.

    The clean tables are written first and read back: cleaning and its deduplication run once, and
    the rules and series scan only the columns they use.
    """
    raw = catalog.read_catalog(spark, raw_folder, multi_line=multi_line)
    sinks.save_processed({"schema_checks": quality.check_all_schemas(raw)}, f"{out}/quality")
    sinks.save_processed({"malformed_rows": catalog.malformed_rows(spark, raw_folder)}, f"{out}/quality")
    sinks.save_processed(clean.clean_all(raw, as_of), f"{out}/processed")
    cleaned = catalog.read_catalog(spark, f"{out}/processed", "parquet")
    result = plan(cleaned, limits, keys, model)
    keys = list(keys)
    sinks.save_processed({"cash_flow_daily": result.daily}, f"{out}/processed")
    forecast.save_model(result.model, f"{out}/models/{model}")
    sinks.save_json(sinks.metrics_document(result.report), f"{out}/models/model_metrics.json")
    sinks.save_json(sinks.config_document(spark, ModelConfig()), f"{out}/models/model_config.json")
    figures = forecast.forecast_summary(result.forecast, keys).join(forecast.risk_indicators(result.forecast, keys), keys) if keys else sinks.forecast_summary_document(
        forecast.forecast_summary(result.forecast), forecast.risk_indicators(result.forecast)
    )
    sinks.save_json(figures, f"{out}/models/forecast_summary.json")
    sinks.save_processed({"validation_report": rules.report_lines(result.rules, keys)}, f"{out}/quality")
    tables = {"bank_movements" if n == "bank_clean" else n.removesuffix("_clean"): df for n, df in cleaned.items()}
    # the declared daily table holds one series
    sinks.load_tables(spark, tables | ({} if keys else {"cash_flow_daily": result.daily}), f"{out}/tables")
    sinks.export_for_bi(result.daily, result.forecast, result.kpis, f"{out}/bi")
    sinks.save_processed({"rules": result.rules}, f"{out}/quality")
    sinks.save_alerts(spark, result.alerts, f"{out}/log")
    return result


def write_dashboard(
    daily: DataFrame,
    ahead: DataFrame,
    invoices: DataFrame,
    deals: DataFrame,
    start: date,
    end: date,
    folder: str,
    keys: Sequence[str] = (),
) -> list[str]:
    """Every dashboard view as a table under one folder, per series where it shows a series.

    The forecast and the paired days are stored first, as each feeds several views; pass a stored
    daily series for the same reason.
    """
    ahead = store(ahead, "forecast")
    shown = store(evaluate.forecast_vs_real(ahead, daily, keys), "shown")
    return sinks.save_processed(
        {
            "kpis": kpi.kpi_row(daily, ahead, keys),
            "monthly_flows": kpi.monthly_flows(daily, keys),
            "weekday_pattern": kpi.weekday_pattern(daily, keys),
            "net_by_year_month": kpi.net_by_year_month(daily, keys),
            "deals_per_stage": kpi.deals_per_stage(deals),
            "amount_per_stage": kpi.amount_per_stage(deals),
            "expected_closes": kpi.expected_closes(deals),
            "crm_totals": kpi.crm_totals(deals),
            "invoice_totals": kpi.invoice_totals(invoices),
            "invoiced_per_month": kpi.invoiced_per_month(invoices),
            "balance_series": kpi.balance_series(daily, start, end, keys),
            "forecast_vs_real": shown,
            "error_summary": evaluate.error_summary(shown, keys),
            "error_histogram": evaluate.error_histogram(shown, keys),
            "axis_range": evaluate.axis_range(shown, keys),
        },
        folder,
    )
