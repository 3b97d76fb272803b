"""Alert queries."""

from datetime import datetime

from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig, Thresholds
from ledgerflow.operators import alerts, forecast, kpi, series
from ledgerflow.plans.oracle_full import full_model
from ledgerflow.plans.queries_kpi import daily, daily_acc, forecast_of, stored_daily_acc
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import store

ACCOUNT = ["bank_account"]
ALERT = "bank_account:s code:s severity:s message:s triggered:b"

# A stricter house policy than the default one, so that several accounts of the test ledger alert.
STRICT = Thresholds(min_balance=60_000_000.0, min_variation_7d=-0.001, max_deviation_forecast=0.05, projection_floor=65_000_000.0)

LATEST = "SELECT bank_account, max(date) AS today, max_by(cash_balance, date) AS balance FROM v_cash_acc GROUP BY bank_account"
WEEK = """SELECT bank_account, max_by(cur, date) AS cur, max_by(old, date) AS old FROM
 (SELECT bank_account, date, cash_balance AS cur, coalesce(lag(cash_balance, 6) OVER (PARTITION BY bank_account ORDER BY date), -1) AS old FROM v_cash_acc) w GROUP BY bank_account"""
AHEAD = """SELECT f.bank_account, min_by(f.yhat, row(abs(date_diff('day', f.ds, t.today + 90)), f.ds)) AS ahead FROM v_fc_acc f
 JOIN latest t ON f.bank_account = t.bank_account GROUP BY f.bank_account"""


def euros(x: str) -> str:
    return f"format('{{:,.0f}}', CAST({x} AS DOUBLE)) || '€'"


def a1(limit: float) -> str:
    return f"SELECT bank_account, 'A1' AS code, 'CRITICAL' AS severity, 'CASH BAJO: ' || {euros('balance')} || ' (min: ' || {euros(limit)} || ')' AS message, balance < {limit} AS triggered FROM latest"


def a2(limit: float) -> str:
    return f"""SELECT bank_account, 'A2' AS code, 'HIGH' AS severity, 'CAIDA SEMANAL: ' || format('{{:,.1f}}', (cur - old) / nullif(old, 0) * 100) || '% (' || format('{{:,.0f}}', old) || ' -> ' || {euros('cur')} || ')' AS message,
     coalesce((cur - old) / nullif(old, 0) < {limit}, FALSE) AS triggered FROM week"""


def a4(limit: float) -> str:
    return f"SELECT bank_account, 'A4' AS code, 'CRITICAL' AS severity, 'PROYECCION NEGATIVA: ' || {euros('ahead')} || ' a 90 dias (floor: ' || {euros(limit)} || ')' AS message, ahead < {limit} AS triggered FROM ahead"


def latest(fx):
    return kpi.current_balance(daily_acc(fx), ACCOUNT)


def horizon(days):
    return forecast.forecast_at(forecast_of(days, ACCOUNT), ACCOUNT, as_of=series.latest_day(days, ACCOUNT))


def ahead(fx):
    return horizon(stored_daily_acc(fx))


def checked(fx):
    days = stored_daily_acc(fx)
    return alerts.check_all(days, kpi.current_balance(days, ACCOUNT), horizon(days), ACCOUNT, STRICT)


@query("l01_balance_alert", ALERT, a1(50000), latest=LATEST)
def _(fx):
    return alerts.balance_alert(latest(fx), ACCOUNT)


@query("l01_balance_alert_strict", ALERT, a1(STRICT.min_balance), latest=LATEST)
def _(fx):
    return alerts.balance_alert(latest(fx), ACCOUNT, STRICT)


@query("l02_variation_alert", ALERT, a2(-0.15), week=WEEK)
def _(fx):
    return alerts.variation_alert(daily_acc(fx), ACCOUNT)


@query("l02_variation_alert_strict", ALERT, a2(STRICT.min_variation_7d), week=WEEK)
def _(fx):
    return alerts.variation_alert(daily_acc(fx), ACCOUNT, STRICT)


@query(
    "l03_deviation_alert",
    ALERT,
    """SELECT t.bank_account, 'A3' AS code, 'MEDIUM' AS severity, 'DESVIACION: ' || format('{:,.1f}', abs(t.balance - f.yhat) / nullif(abs(f.yhat), 0) * 100) || '% (actual: ' || format('{:,.0f}', t.balance)
      || ', forecast: ' || format('{:,.0f}', f.yhat) || ')' AS message, coalesce(abs(t.balance - f.yhat) / nullif(abs(f.yhat), 0) > 0.1, FALSE) AS triggered
     FROM latest t JOIN v_fc_acc f ON f.bank_account = t.bank_account AND f.ds = t.today""",
    latest=LATEST,
)
def _(fx):
    days = stored_daily_acc(fx)
    actual = kpi.current_balance(days, ACCOUNT).select("bank_account", F.col("report_date").alias("ds"), F.col("current_cash_balance").alias("actual"))
    predicted = forecast_of(days, ACCOUNT).select("bank_account", "ds", F.col("yhat").alias("forecast"))
    return alerts.deviation_alert(actual.join(predicted, ["bank_account", "ds"]), ACCOUNT)


@query("l04_projection_alert", ALERT, a4(25000), latest=LATEST, ahead=AHEAD)
def _(fx):
    return alerts.projection_alert(ahead(fx), ACCOUNT)


CHECKED = " UNION ALL ".join(f"SELECT * FROM ({part}) x WHERE triggered" for part in (a1(STRICT.min_balance), a2(STRICT.min_variation_7d), a4(STRICT.projection_floor)))
PARTS = {"latest": LATEST, "week": WEEK, "ahead": AHEAD}


@query("l05_check_all", ALERT, CHECKED, **PARTS)
def _(fx):
    return checked(fx)


@query(
    "l05_check_all_full_model",
    "bank_account:s code:s severity:s triggered:b",
    f"SELECT bank_account, code, severity, triggered FROM ({CHECKED}) c",
    **full_model("v_hist_acc", ModelConfig(), "bank_account"),
    **(PARTS | {"ahead": AHEAD.replace("v_fc_acc", "full_ahead")}),
)
def _(fx):
    days = stored_daily_acc(fx)
    model = store(forecast.fit_full(series.target_series(days, keys=ACCOUNT), ACCOUNT), "model")
    value = forecast.forecast_at(forecast.predict_full(model, ACCOUNT), ACCOUNT, as_of=series.latest_day(days, ACCOUNT))
    return alerts.check_all(days, kpi.current_balance(days, ACCOUNT), value, ACCOUNT, STRICT)


@query("l06_alert_messages", "bank_account:s message:s", f"SELECT bank_account, message FROM ({CHECKED}) c", **PARTS)
def _(fx):
    return checked(fx).select("bank_account", "message")


def _block(level: str) -> str:
    lines = f"string_agg('  [' || code || '] ' || message, chr(10) ORDER BY '  [' || code || '] ' || message) FILTER (WHERE severity = '{level}')"
    return f"coalesce('{level}:' || chr(10) || {lines} || chr(10) || chr(10), '')"


@query(
    "l07_digest",
    "bank_account:s message:s",
    f"""SELECT t.bank_account, coalesce(d.message, '{alerts.NO_ALERTS}') AS message FROM latest t LEFT JOIN
     (SELECT bank_account, repeat('=', 50) || chr(10) || '{alerts.TITLE}' || chr(10) || repeat('=', 50) || chr(10) || 'Fecha: 2003-01-31 06:00:00' || chr(10) || chr(10) || {_block('CRITICAL')} || {_block('HIGH')} || {_block('MEDIUM')} || repeat('=', 50) AS message
      FROM ({CHECKED}) c GROUP BY bank_account) d ON d.bank_account = t.bank_account""",
    **PARTS,
)
def _(fx):
    return alerts.digest(checked(fx), latest(fx), ACCOUNT, at=datetime(2003, 1, 31, 6))


@query(
    "l08_status_message",
    "message:s",
    f"""SELECT '{alerts.STATUS_TITLE}' || chr(10) || chr(10) || 'Saldo actual: ' || format('{{:,.2f}}', CAST(cash_balance AS DOUBLE)) || '€' || chr(10) || 'Ingresos 30d: ' || format('{{:,.2f}}', CAST(cash_inflow AS DOUBLE))
      || '€' || chr(10) || 'Gastos 30d: ' || format('{{:,.2f}}', CAST(cash_outflow AS DOUBLE)) || '€' AS message FROM v_cash ORDER BY date DESC LIMIT 1""",
)
def _(fx):
    return alerts.status_message(daily(fx))


@query(
    "l09_negative_projection",
    ALERT,
    f"SELECT bank_account, 'A4_neg' AS code, 'CRITICAL' AS severity, 'PROYECCION NEGATIVA: Saldo proyectado a 90 dias: ' || {euros('ahead')} AS message, ahead < 0 AS triggered FROM ahead",
    latest=LATEST,
    ahead=AHEAD,
)
def _(fx):
    return alerts.negative_projection_alert(ahead(fx), ACCOUNT)


@query(
    "l09_forecast_floor",
    ALERT,
    f"SELECT bank_account, 'A6' AS code, 'HIGH' AS severity, 'PREDICCION BAJO FLOOR: ' || {euros('min(yhat)')} || ' (floor: 25,000€)' AS message, min(yhat) < 25000 AS triggered FROM v_fc_acc GROUP BY bank_account",
)
def _(fx):
    return alerts.floor_alert(forecast_of(daily_acc(fx), ACCOUNT), ACCOUNT)


def _odd(scope: str, source: str, times: float = 3) -> str:
    by = f"PARTITION BY {scope}" if scope else ""
    return f"""SELECT movement_id, amount, m AS mean_abs_amount FROM (SELECT *, CAST(sum(abs(amount)) OVER ({by}) AS DOUBLE) / count(amount) OVER ({by}) AS m FROM {source}) t
     WHERE CAST(abs(amount) AS DOUBLE) > {times} * m"""


@query("l10_anomalous_movements", "movement_id:s amount:m mean_abs_amount:f2", _odd("", "fx_bank"))
def _(fx):
    return alerts.anomalous_movements(fx.bank())


@query("l10_anomalous_by_account_and_category", "movement_id:s amount:m mean_abs_amount:f2", _odd("bank_account, category", "fx_bank_multi", 1.9))
def _(fx):
    return alerts.anomalous_movements(fx.bank_multi(), ACCOUNT, by_category=True, limits=Thresholds(anomaly_multiplier=1.9))
