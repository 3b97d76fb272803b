"""Structured Streaming queries over the event ledger; each replays the events to completion."""

from datetime import timedelta

from pyspark.sql import functions as F

from ledgerflow.config import TOTAL, Thresholds
from ledgerflow.operators import forecast, series
from ledgerflow.plans.oracle_derived import base_forecast, predicted
from ledgerflow.plans.queries_alerts import euros
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import fresh_path, store
from ledgerflow.streaming import alerting, keyed_alerts
from ledgerflow.streaming.daily import daily_flows, read_events, run_daily

DAYS = """SELECT bank_account, CAST(ts AS DATE) AS date, sum(amount) AS net_cash, coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS cash_inflow,
 coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS cash_outflow, count(*) AS transaction_count FROM fx_event_ledger GROUP BY 1, 2"""
FLOWS = "bank_account:s date:d net_cash:m cash_inflow:m cash_outflow:m transaction_count:i"


def movements(fx):
    return read_events(fx.spark, fx.folder, fx.table("events").schema, "events.parquet")


@query(
    "x01_stream_daily_flows",
    FLOWS,
    f"SELECT * FROM ({DAYS}) d WHERE CAST(date AS TIMESTAMP) + INTERVAL 1 DAY <= (SELECT max(ts) FROM fx_event_ledger) - INTERVAL 1 DAY",
)
def _(fx):
    return run_daily(movements(fx), fresh_path(fx.spark, "days"), fresh_path(fx.spark, "state"))


@query("x01_batch_daily_flows", FLOWS, DAYS)
def _(fx):
    return daily_flows(fx.event_ledger())


SPARSE = "SELECT bank_account, CAST(ts AS DATE) AS date, sum(amount) AS net FROM fx_event_ledger GROUP BY 1, 2"
SPINE = "SELECT bank_account, CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT bank_account, min(date) AS lo, max(date) AS hi FROM sparse GROUP BY 1) b"
BALANCE = """SELECT s.bank_account, s.date, CAST(1000 + sum(coalesce(p.net, 0)) OVER (PARTITION BY s.bank_account ORDER BY s.date) AS DOUBLE) AS balance
 FROM spine s LEFT JOIN sparse p ON s.bank_account = p.bank_account AND s.date = p.date"""
LAST = """SELECT bank_account, max_by(balance, date) AS cur, max_by(old, date) AS old FROM
 (SELECT *, coalesce(lag(balance, 6) OVER (PARTITION BY bank_account ORDER BY date), 0) AS old FROM balance) b GROUP BY 1"""


@query(
    "x02_stream_alerts",
    "bank_account:s alert_code:s severity:s resolved:i",
    """SELECT bank_account, 'A1' AS alert_code, 'CRITICAL' AS severity, 0 AS resolved FROM latest WHERE cur < 50000
     UNION ALL SELECT bank_account, 'A2', 'HIGH', 0 FROM latest WHERE (cur - old) / nullif(old, 0) < -0.15""",
    sparse=SPARSE,
    spine=SPINE,
    balance=BALANCE,
    latest=LAST,
)
def _(fx):
    unique = movements(fx).withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["movement_id"])
    return alerting.run_alerts(unique, fresh_path(fx.spark, "alerting"), fresh_path(fx.spark, "state"), opening=1000)


#: Thresholds near the events' small balances, so that some accounts alert and some do not.
SMALL_LIMITS = Thresholds(min_balance=600.0, min_variation_7d=-0.15, projection_floor=300.0)
ARRIVALS = 3


def arrivals(fx):
    """The events in three parts by day, each a data frame of its own."""
    events = fx.table("events")
    day = F.to_date("ts")
    low, high = events.agg(F.min(day), F.max(day)).first()
    span = (high - low).days
    cuts = [low - timedelta(days=1), *(low + timedelta(days=span * k // ARRIVALS) for k in range(1, ARRIVALS + 1))]
    return [events.where((day > F.lit(a)) & (day <= F.lit(b))) for a, b in zip(cuts, cuts[1:], strict=False)]


@query(
    "x02_keyed_alerts",
    "bank_account:s date:d code:s severity:s message:s",
    f"""SELECT bank_account, today AS date, 'A1' AS code, 'CRITICAL' AS severity, 'CASH BAJO: ' || {euros("cur")} || ' (min: ' || {euros("600")} || ')' AS message FROM seen WHERE cur < 600
     UNION ALL SELECT bank_account, today, 'A2', 'HIGH', 'CAIDA SEMANAL: ' || format('{{:,.1f}}', (cur - old) / nullif(old, 0) * 100) || '% (' || format('{{:,.0f}}', old) || ' -> ' || {euros("cur")} || ')'
      FROM seen WHERE (cur - old) / nullif(old, 0) < -0.15
     UNION ALL SELECT bank_account, today, 'A4', 'CRITICAL', 'PROYECCION NEGATIVA: ' || {euros("ahead")} || ' a 90 dias (floor: ' || {euros("300")} || ')' FROM seen WHERE ahead < 300""",
    sparse=SPARSE,
    spine=SPINE,
    balance=BALANCE,
    ev_hist="SELECT bank_account, date AS ds, balance AS y FROM balance",
    ev_fitted=base_forecast("ev_hist", "bank_account")["fitted"],
    ev_ahead=predicted("ev_fitted", part="bank_account"),
    parts=f"""SELECT CASE WHEN k = 1 THEN lo - 1 ELSE lo + CAST((hi - lo) * (k - 1) // {ARRIVALS} AS INT) END AS after, lo + CAST((hi - lo) * k // {ARRIVALS} AS INT) AS upto
     FROM (SELECT min(date) AS lo, max(date) AS hi FROM sparse) b, (SELECT unnest(range(1, {ARRIVALS + 1})) AS k) r""",
    moved="SELECT s.bank_account, p.upto, max(s.date) AS today FROM sparse s JOIN parts p ON s.date > p.after AND s.date <= p.upto GROUP BY 1, 2",
    seen="""SELECT m.bank_account, m.today, c.balance AS cur, o.balance AS old, f.yhat AS ahead FROM moved m JOIN balance c ON c.bank_account = m.bank_account AND c.date = m.today
     LEFT JOIN balance o ON o.bank_account = m.bank_account AND o.date = m.today - 6 LEFT JOIN ev_ahead f ON f.bank_account = m.bank_account AND f.ds = m.today + 90""",
)
def _(fx):
    spark = fx.spark
    days = fx.event_ledger().groupBy("bank_account", F.to_date("ts").alias("date")).agg(F.sum("amount").cast(TOTAL).alias("net_cash"))
    history = series.target_series(alerting.balances(days, 1000), keys=["bank_account"])
    model = store(forecast.fit_base(history, ["bank_account"]), "event_model")
    incoming, log, state = (fresh_path(spark, name) for name in ("incoming", "log", "state"))
    out = None
    for part in [*arrivals(fx), None]:  # the last run finds nothing new
        if part is not None:
            part.write.mode("append").parquet(incoming)
        stream = read_events(spark, incoming, fx.table("events").schema).withWatermark("ts", "1 day").dropDuplicatesWithinWatermark(["movement_id"])
        out = keyed_alerts.run_keyed_alerts(stream, log, state, model, opening_cents=100_000, limits=SMALL_LIMITS)
    return out
