"""KPI and analytics-view queries."""

from datetime import date

from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.functions.measures import code_risk_band, spec_risk_band
from ledgerflow.operators import clean, forecast, kpi, series
from ledgerflow.plans.oracle_full import full_model
from ledgerflow.plans.queries_cleaning import AS_OF
from ledgerflow.plans.queries_forecast import full_forecast
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import fresh_path, store

ACCOUNT = ["bank_account"]
START, END = date(1997, 1, 1), date(1999, 12, 31)


def daily(fx):
    return series.cash_flow_daily(fx.bank())


def daily_acc(fx):
    return series.cash_flow_daily(fx.bank_multi(), ACCOUNT)


def stored_daily(fx):
    """For queries that use the daily series in several branches; one small row per day."""
    return store(daily(fx), "daily")


def stored_daily_acc(fx):
    return store(daily_acc(fx), "daily_acc")


def forecast_of(days, keys=()):
    return forecast.predict_base(forecast.fit_base(series.target_series(days, keys=keys), keys), keys)


RECENT = "date >= (SELECT max(date) FROM v_cash) - 30"
BAND = "CASE WHEN {v} < {h} THEN 'ALTO' WHEN {v} < {m} THEN 'MEDIO' ELSE 'BAJO' END"


@query("k01_current_balance", "report_date:d current_cash_balance:m", "SELECT date AS report_date, cash_balance AS current_cash_balance FROM v_cash ORDER BY date DESC LIMIT 1")
def _(fx):
    return kpi.current_balance(daily(fx))


@query("k01_current_balance_by_account", "bank_account:s report_date:d current_cash_balance:m", "SELECT bank_account, max(date) AS report_date, max_by(cash_balance, date) AS current_cash_balance FROM v_cash_acc GROUP BY bank_account")
def _(fx):
    return kpi.current_balance(daily_acc(fx), ACCOUNT)


@query("k02_flows_30d", "cash_inflow_30d:m cash_outflow_30d:m", f"SELECT sum(cash_inflow) AS cash_inflow_30d, sum(cash_outflow) AS cash_outflow_30d FROM v_cash WHERE {RECENT}")
def _(fx):
    return kpi.flows_last_days(daily(fx))


@query(
    "k02_flows_30d_by_account",
    "bank_account:s cash_inflow_30d:m cash_outflow_30d:m",
    """SELECT bank_account, sum(cash_inflow) AS cash_inflow_30d, sum(cash_outflow) AS cash_outflow_30d FROM
     (SELECT *, max(date) OVER (PARTITION BY bank_account) AS today FROM v_cash_acc) c WHERE date >= today - 30 GROUP BY bank_account""",
)
def _(fx):
    return kpi.flows_last_days(daily_acc(fx), ACCOUNT)


@query(
    "k03_gross_flows_30d",
    "cash_inflow_30d:m cash_outflow_30d:m",
    "SELECT coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS cash_inflow_30d, coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS cash_outflow_30d FROM fx_bank WHERE date >= (SELECT max(date) FROM fx_bank) - 30",
)
def _(fx):
    return kpi.gross_flows_last_days(fx.bank())


@query("k04_net_30d", "net_30d:m", f"SELECT sum(cash_inflow) - sum(cash_outflow) AS net_30d FROM v_cash WHERE {RECENT}")
def _(fx):
    return kpi.net_last_days(daily(fx))


@query(
    "k05_risk_bands",
    "movement_id:s code_band:s spec_band:s",
    f"SELECT movement_id, {BAND.format(v='balance_after', h=25000, m=50000)} AS code_band, {BAND.format(v='balance_after', h=50000, m=75000)} AS spec_band FROM fx_bank",
)
def _(fx):
    b = F.col("balance_after")
    return fx.bank().select("movement_id", code_risk_band(b).alias("code_band"), spec_risk_band(b).alias("spec_band"))


KPI = "report_date:d current_cash_balance:m cash_inflow_30d:m cash_outflow_30d:m forecast_90d:f0 liquidity_risk:s"
KPI_SQL = f"""SELECT (SELECT max(date) FROM v_cash) AS report_date, (SELECT round(cash_balance, 2) FROM v_cash ORDER BY date DESC LIMIT 1) AS current_cash_balance,
 (SELECT sum(cash_inflow) FROM v_cash WHERE {RECENT}) AS cash_inflow_30d, (SELECT sum(cash_outflow) FROM v_cash WHERE {RECENT}) AS cash_outflow_30d,
 yhat AS forecast_90d, {BAND.format(v='yhat', h=25000, m=50000)} AS liquidity_risk
FROM (SELECT yhat FROM v_fc ORDER BY abs(date_diff('day', ds, (SELECT max(date) FROM v_cash) + 90)), ds LIMIT 1) f"""


@query("k06_kpi_row", KPI, KPI_SQL)
def _(fx):
    days = stored_daily(fx)
    return kpi.kpi_row(days, forecast_of(days))


@query(
    "k06_kpi_row_full_model",
    "bank_account:s report_date:d current_cash_balance:m forecast_90d:f-3 liquidity_risk:s",
    f"""SELECT t.bank_account, t.today AS report_date, t.balance AS current_cash_balance, f.ahead AS forecast_90d, {BAND.format(v="f.ahead", h=25000, m=50000)} AS liquidity_risk
     FROM (SELECT bank_account, max(date) AS today, round(max_by(cash_balance, date), 2) AS balance FROM v_cash_acc GROUP BY bank_account) t
     JOIN (SELECT f.bank_account, min_by(f.yhat, row(abs(date_diff('day', f.ds, t.today + 90)), f.ds)) AS ahead FROM full_ahead f
      JOIN (SELECT bank_account, max(date) AS today FROM v_cash_acc GROUP BY bank_account) t ON f.bank_account = t.bank_account GROUP BY f.bank_account) f ON f.bank_account = t.bank_account""",
    **full_model("v_hist_acc", ModelConfig(), "bank_account"),
)
def _(fx):
    days = stored_daily_acc(fx)
    model = store(forecast.fit_full(series.target_series(days, keys=ACCOUNT), ACCOUNT), "model")
    return kpi.kpi_row(days, forecast.predict_full(model, ACCOUNT), ACCOUNT)


@query(
    "k06_kpi_row_by_account",
    "bank_account:s report_date:d current_cash_balance:m forecast_90d:f0 liquidity_risk:s",
    f"""SELECT t.bank_account, t.today AS report_date, t.balance AS current_cash_balance, min_by(f.yhat, row(abs(date_diff('day', f.ds, t.today + 90)), f.ds)) AS forecast_90d,
     {BAND.format(v="min_by(f.yhat, row(abs(date_diff('day', f.ds, t.today + 90)), f.ds))", h=25000, m=50000)} AS liquidity_risk
     FROM (SELECT bank_account, max(date) AS today, round(max_by(cash_balance, date), 2) AS balance FROM v_cash_acc GROUP BY bank_account) t
     JOIN v_fc_acc f ON f.bank_account = t.bank_account GROUP BY t.bank_account, t.today, t.balance""",
)
def _(fx):
    days = stored_daily_acc(fx)
    return kpi.kpi_row(days, forecast_of(days, ACCOUNT), ACCOUNT)


@query(
    "k07_forecast_floor",
    "min_forecast:f0 days_below:i",
    f"SELECT min(yhat) AS min_forecast, count(*) FILTER (WHERE yhat < 50000) AS days_below FROM v_fc WHERE ds BETWEEN DATE '{START}' AND DATE '{END}'",
)
def _(fx):
    return kpi.forecast_floor(full_forecast(fx), START, END)


@query(
    "k08_risk_gauge",
    "liquidity_risk:s risk_score:i risk_text:s",
    f"""SELECT liquidity_risk, CASE liquidity_risk WHEN 'BAJO' THEN 0 WHEN 'MEDIO' THEN 50 ELSE 100 END AS risk_score,
     CASE liquidity_risk WHEN 'BAJO' THEN 'Saludable' WHEN 'MEDIO' THEN 'Monitoreo' ELSE 'Crítico' END AS risk_text FROM ({KPI_SQL}) k""",
)
def _(fx):
    days = stored_daily(fx)
    return kpi.risk_gauge(kpi.kpi_row(days, forecast_of(days)))


@query("a01_monthly_flows", "month:s cash_inflow:m cash_outflow:m", "SELECT strftime(date, '%Y-%m') AS month, sum(cash_inflow) AS cash_inflow, sum(cash_outflow) AS cash_outflow FROM v_cash GROUP BY 1")
def _(fx):
    return kpi.monthly_flows(daily(fx))


@query(
    "a02_weekday_pattern",
    "day_of_week:i day_name:s net_cash:f2",
    """SELECT isodow(date) - 1 AS day_of_week, CASE isodow(date) WHEN 1 THEN 'Lun' WHEN 2 THEN 'Mar' WHEN 3 THEN 'Mié' WHEN 4 THEN 'Jue' WHEN 5 THEN 'Vie' WHEN 6 THEN 'Sáb' ELSE 'Dom' END AS day_name,
     CAST(sum(net_cash) AS DOUBLE) / count(*) AS net_cash FROM v_cash GROUP BY 1, 2""",
)
def _(fx):
    return kpi.weekday_pattern(daily(fx))


YEARS = list(range(1995, 2003))


@query(
    "a03_year_month_matrix",
    "month:i " + " ".join(f"{y}:m" for y in YEARS),
    "SELECT month(date) AS month, " + ", ".join(f'sum(net_cash) FILTER (WHERE year(date) = {y}) AS "{y}"' for y in YEARS) + " FROM v_cash GROUP BY 1",
)
def _(fx):
    return kpi.year_month_matrix(daily(fx), YEARS)


@query(
    "a03_year_month_thousands",
    "month:i " + " ".join(f"{y}:m" for y in YEARS),
    "SELECT month(date) AS month, " + ", ".join(f'round(sum(net_cash) FILTER (WHERE year(date) = {y}) / 1000, 0) AS "{y}"' for y in YEARS) + " FROM v_cash GROUP BY 1",
)
def _(fx):
    return kpi.year_month_matrix(daily(fx), YEARS, thousands=True)


@query("a03_net_by_year_month", "year:i month:i net_cash:m", "SELECT year(date) AS year, month(date) AS month, sum(net_cash) AS net_cash FROM v_cash GROUP BY 1, 2")
def _(fx):
    return kpi.net_by_year_month(daily(fx))


def deals(fx):
    return clean.clean_crm_deals(fx.deals_raw())


def invoices(fx):
    return clean.clean_invoices(fx.invoices_raw(), AS_OF)


@query("a04_deals_per_stage", "stage:s count:i share_pct:f4", "SELECT stage, count(*) AS count, count(*) * 100.0 / sum(count(*)) OVER () AS share_pct FROM v_deals GROUP BY stage")
def _(fx):
    return kpi.deals_per_stage(deals(fx))


@query("a05_amount_per_stage", "stage:s expected_amount:m", "SELECT stage, sum(expected_amount) AS expected_amount FROM v_deals GROUP BY stage")
def _(fx):
    return kpi.amount_per_stage(deals(fx))


@query("a06_expected_closes", "month:s amount:m", "SELECT strftime(expected_close, '%Y-%m') AS month, sum(expected_amount) AS amount FROM v_deals WHERE expected_close IS NOT NULL GROUP BY 1")
def _(fx):
    return kpi.expected_closes(deals(fx))


@query(
    "a07_crm_totals",
    "total_pipeline:m weighted_pipeline:m won_amount:m total_deals:i",
    """SELECT sum(expected_amount) AS total_pipeline, sum(expected_amount * CAST(probability AS DECIMAL(6,4))) AS weighted_pipeline,
     coalesce(sum(expected_amount) FILTER (WHERE stage = 'won'), 0) AS won_amount, count(*) AS total_deals FROM v_deals""",
)
def _(fx):
    return kpi.crm_totals(deals(fx))


@query(
    "a08_invoice_totals",
    "total_invoiced:m avg_invoice:f2 paid_invoices:i overdue:i status_overdue:i",
    """SELECT sum(total) AS total_invoiced, CAST(sum(total) AS DOUBLE) / count(total) AS avg_invoice, count(*) FILTER (WHERE status = 'paid') AS paid_invoices,
     count(*) FILTER (WHERE is_overdue) AS overdue, count(*) FILTER (WHERE status = 'overdue') AS status_overdue FROM v_invoices""",
)
def _(fx):
    return kpi.invoice_totals(invoices(fx))


@query("a09_invoiced_per_month", "month:s total:m", "SELECT strftime(invoice_date, '%Y-%m') AS month, sum(total) AS total FROM v_invoices GROUP BY 1")
def _(fx):
    return kpi.invoiced_per_month(invoices(fx))


@query("a10_balance_series", "date:d cash_balance:m", f"SELECT date, cash_balance FROM v_cash WHERE date BETWEEN DATE '{START}' AND DATE '{END}'")
def _(fx):
    return kpi.balance_series(daily(fx), START, END)


@query(
    "a11_dashboard_feed",
    "dataset:s rows:i",
    f"""SELECT 'kpis' AS dataset, 1 AS rows UNION ALL SELECT 'monthly_flows', count(DISTINCT strftime(date, '%Y-%m')) FROM v_cash
     UNION ALL SELECT 'weekday_pattern', count(DISTINCT isodow(date)) FROM v_cash UNION ALL SELECT 'net_by_year_month', count(DISTINCT strftime(date, '%Y-%m')) FROM v_cash
     UNION ALL SELECT 'deals_per_stage', count(DISTINCT stage) FROM v_deals UNION ALL SELECT 'amount_per_stage', count(DISTINCT stage) FROM v_deals
     UNION ALL SELECT 'expected_closes', count(DISTINCT strftime(expected_close, '%Y-%m')) FROM v_deals UNION ALL SELECT 'crm_totals', 1 UNION ALL SELECT 'invoice_totals', 1
     UNION ALL SELECT 'invoiced_per_month', count(DISTINCT strftime(invoice_date, '%Y-%m')) FROM v_invoices
     UNION ALL SELECT 'balance_series', count(*) FROM v_cash WHERE date BETWEEN DATE '{START}' AND DATE '{END}'
     UNION ALL SELECT 'forecast_vs_real', count(*) FROM v_shown UNION ALL SELECT 'error_summary', 1
     UNION ALL SELECT 'error_histogram', count(DISTINCT least(floor((error - lo) / ((hi - lo) / 30)) + 1, 30)) FROM v_shown, (SELECT min(error) AS lo, max(error) AS hi FROM v_shown) b
     UNION ALL SELECT 'axis_range', 1""",
)
def _(fx):
    from ledgerflow.plans.treasury import write_dashboard
    from ledgerflow.sources import catalog, quality

    folder = fresh_path(fx.spark, "dashboard")
    days = stored_daily(fx)
    write_dashboard(days, forecast_of(days), invoices(fx), deals(fx), START, END, folder)
    return quality.row_counts(catalog.read_catalog(fx.spark, folder, "parquet"))
