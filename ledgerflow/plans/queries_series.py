"""Time-series shaping queries."""

from pyspark.sql import functions as F

from ledgerflow.config import INITIAL_BALANCE, INDICATORS, SEASONAL_FACTOR
from ledgerflow.operators import series
from ledgerflow.operators.clean import clean_external_factors
from ledgerflow.plans.oracle_derived import gap_fill
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import store

ACCOUNT = ["bank_account"]
CASH = "date:d cash_balance:m cash_inflow:m cash_outflow:m net_cash:m transaction_count:i"


@query("t01_daily_totals", "date:d net_cash:m cash_balance:m transaction_count:i", "SELECT * FROM v_daily")
def _(fx):
    return series.daily_totals(fx.bank())


@query("t01_daily_totals_by_account", "bank_account:s date:d net_cash:m cash_balance:m transaction_count:i", "SELECT * FROM v_daily_acc")
def _(fx):
    return series.daily_totals(fx.bank_multi(), ACCOUNT)


@query("t02_split_net", "date:d cash_inflow:m cash_outflow:m", "SELECT date, greatest(net_cash, 0) AS cash_inflow, greatest(-net_cash, 0) AS cash_outflow FROM v_daily")
def _(fx):
    return series.split_flows(series.daily_totals(fx.bank()), "net")


@query("t02_split_gross", "date:d cash_inflow:m cash_outflow:m", "SELECT date, gross_inflow AS cash_inflow, gross_outflow AS cash_outflow FROM v_daily")
def _(fx):
    return series.split_flows(series.daily_totals(fx.bank()), "gross")


@query("t03_densify", "date:d net_cash:m cash_balance:m", "SELECT date, net_cash, cash_balance FROM v_dense")
def _(fx):
    return series.densify(series.daily_totals(fx.bank()))


@query("t03_densify_by_account", "bank_account:s date:d net_cash:m cash_balance:m", "SELECT bank_account, date, net_cash, cash_balance FROM v_dense_acc")
def _(fx):
    return series.densify(series.daily_totals(fx.bank_multi(), ACCOUNT), ACCOUNT)


@query("t04_interpolate", "date:d cash_balance:m", "SELECT date, cash_balance FROM v_cash")
def _(fx):
    return series.interpolate_linear(series.densify(series.daily_totals(fx.bank())), ["cash_balance"])


@query("t05_zero_fill", "date:d net_cash:m transaction_count:i", "SELECT date, coalesce(net_cash, 0) AS net_cash, coalesce(transaction_count, 0) AS transaction_count FROM v_dense")
def _(fx):
    return series.zero_fill(series.densify(series.daily_totals(fx.bank())))


@query("t06_cash_flow_daily", CASH, "SELECT * FROM v_cash")
def _(fx):
    return series.cash_flow_daily(fx.bank())


@query("t06_cash_flow_daily_by_account", "bank_account:s " + CASH, "SELECT * FROM v_cash_acc")
def _(fx):
    return series.cash_flow_daily(fx.bank_multi(), ACCOUNT)


@query("t07_running_balance", "movement_id:s date:d amount:m balance_after:m", "SELECT movement_id, date, amount, balance_after FROM fx_bank")
def _(fx):
    return series.running_balance(store(fx.bank_base(), "movements"), opening=INITIAL_BALANCE, block=["date"])


@query("t07_running_balance_by_account", "bank_account:s movement_id:s date:d amount:m balance_after:m", "SELECT bank_account, movement_id, date, amount, balance_after FROM fx_bank_multi")
def _(fx):
    split = store(fx.bank_base(), "movements").withColumn("bank_account", F.concat(F.lit("ACC-"), F.right("movement_id", F.lit(1))))
    return series.running_balance(split, ACCOUNT, opening=INITIAL_BALANCE // 10, block=["date"])


@query("t08_target_series", "ds:d y:m", "SELECT ds, y FROM v_full")
def _(fx):
    return series.target_series(series.cash_flow_daily(fx.bank()))


@query("t08_target_series_net_cash", "ds:d y:m", "SELECT date AS ds, net_cash AS y FROM v_cash WHERE net_cash IS NOT NULL")
def _(fx):
    return series.target_series(series.cash_flow_daily(fx.bank()), "net_cash")


@query(
    "t09_calendar_features",
    "ds:d day_of_week:i month:i quarter:i day_of_month:i week_of_year:i is_month_end:i is_month_start:i",
    """SELECT ds, isodow(ds) - 1 AS day_of_week, month(ds) AS month, quarter(ds) AS quarter, day(ds) AS day_of_month, weekofyear(ds) AS week_of_year,
     CAST(last_day(ds) = ds AS INT) AS is_month_end, CAST(day(ds) = 1 AS INT) AS is_month_start FROM v_full""",
)
def _(fx):
    return series.calendar_features(series.target_series(series.cash_flow_daily(fx.bank())))


@query("t10_attach_flows", "ds:d y:m cash_inflow:m cash_outflow:m net_cash:m", "SELECT f.ds, f.y, c.cash_inflow, c.cash_outflow, c.net_cash FROM v_full f LEFT JOIN v_cash c ON f.ds = c.date")
def _(fx):
    daily = store(series.cash_flow_daily(fx.bank()), "daily")
    return series.attach_flows(series.target_series(daily), daily)


WIDE = "SELECT date, " + ", ".join(f"max(value) FILTER (WHERE indicator = '{i}') AS {i}" for i in INDICATORS) + " FROM fx_factors GROUP BY date"
JOINED = "SELECT f.ds, f.y, f.rn, f.n, w.interest_rate, w.inflation, w.sector_growth FROM v_full f LEFT JOIN wide w ON f.ds = w.date"
FILLED = gap_fill("joined", {i: i for i in INDICATORS}, "ds, y, rn, n", day="ds")


@query("t11_factors_wide", "date:d interest_rate:f4 inflation:f4 sector_growth:f4", WIDE)
def _(fx):
    return series.factors_wide(clean_external_factors(fx.factors()))


@query("t12_merge_factors", "ds:d y:m interest_rate:f6 inflation:f6 sector_growth:f6", FILLED, wide=WIDE, joined=JOINED)
def _(fx):
    target = series.target_series(series.cash_flow_daily(fx.bank()))
    return series.merge_factors(target, series.factors_wide(clean_external_factors(fx.factors())))


@query("t13_split_train_test", "ds:d y:m is_train:b", "SELECT ds, y, rn <= floor(n * 0.8) AS is_train FROM v_full")
def _(fx):
    return series.split_train_test(series.target_series(series.cash_flow_daily(fx.bank())))


@query(
    "t13_split_by_account",
    "bank_account:s ds:d is_train:b",
    "SELECT bank_account, ds, row_number() OVER (PARTITION BY bank_account ORDER BY ds) <= floor(count(*) OVER (PARTITION BY bank_account) * 0.8) AS is_train FROM v_hist_acc",
)
def _(fx):
    daily = series.cash_flow_daily(fx.bank_multi(), ACCOUNT)
    return series.split_train_test(series.target_series(daily, keys=ACCOUNT), ACCOUNT)


@query(
    "t14_prepare_forecasting",
    "ds:d y:m day_of_week:i month:i cash_inflow:m cash_outflow:m net_cash:m interest_rate:f6 inflation:f6 sector_growth:f6 is_train:b",
    """SELECT p.ds, p.y, isodow(p.ds) - 1 AS day_of_week, month(p.ds) AS month, c.cash_inflow, c.cash_outflow, c.net_cash, p.interest_rate, p.inflation,
     p.sector_growth, p.rn <= floor(p.n * 0.8) AS is_train FROM filled p LEFT JOIN v_cash c ON p.ds = c.date""",
    wide=WIDE,
    joined=JOINED,
    filled=FILLED,
)
def _(fx):
    daily = store(series.cash_flow_daily(fx.bank()), "daily")
    return series.prepare_forecasting(daily, clean_external_factors(fx.factors()))["flagged"]


PAID = """SELECT 'I-' || invoice_id AS movement_id, paid_date AS date, total AS amount, 'Cobro factura ' || invoice_id || ' - ' || customer_name AS description,
 'invoice_payment' AS category, invoice_id AS reference FROM v_invoices WHERE paid_date IS NOT NULL"""


def _clean_invoices(fx):
    from ledgerflow.operators.clean import clean_invoices
    from ledgerflow.plans.queries_cleaning import AS_OF

    return clean_invoices(fx.invoices_raw(), AS_OF)


@query(
    "t15_ledger_union",
    "movement_id:s date:d amount:m category:s reference:s",
    "SELECT movement_id, date, amount, category, reference FROM paid UNION ALL SELECT movement_id, dt, amount, category, NULL FROM fx_bank_base WHERE amount < 0",
    paid=PAID,
)
def _(fx):
    costs = fx.bank_base().where(F.col("amount") < 0).drop("reference")
    return series.ledger_union(series.collections_from_invoices(_clean_invoices(fx)), costs)


@query("t16_collections", "movement_id:s date:d amount:m description:s category:s reference:s", PAID)
def _(fx):
    return series.collections_from_invoices(_clean_invoices(fx))


BOUNDS = "SELECT min(dt) AS lo, max(dt) AS hi FROM fx_bank_base"
MONTHS = "SELECT CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS m, lo, hi FROM bounds"
PAYROLL = """SELECT m AS month_start, m + CASE isodow(m) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS payroll_date, lo, hi FROM months"""


@query(
    "t17_payroll_calendar",
    "month_start:d payroll_date:d",
    "SELECT month_start, payroll_date FROM payroll WHERE payroll_date BETWEEN lo AND hi",
    bounds=BOUNDS,
    months=MONTHS,
    payroll=PAYROLL,
)
def _(fx):
    return series.payroll_calendar(series.date_bounds(fx.bank_base()))


@query(
    "t18_recurring_dates",
    "rule:s date:d",
    """SELECT 'supplier_run' AS rule, day AS date FROM steps UNION ALL SELECT 'electricity', day FROM steps WHERE month(day) IN (2, 5, 8, 11)
     UNION ALL SELECT 'gas', day FROM steps WHERE month(day) IN (3, 6, 9, 12)
     UNION ALL SELECT 'social_security', m + 27 FROM months WHERE m + 27 BETWEEN lo AND hi UNION ALL SELECT 'rent', m + 14 FROM months WHERE m + 14 BETWEEN lo AND hi""",
    bounds=BOUNDS,
    months=MONTHS,
    steps="SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 30 DAY)) AS DATE) AS day FROM bounds",
)
def _(fx):
    return series.recurring_dates(series.date_bounds(fx.bank_base()))


@query(
    "t19_vat_due_dates",
    "date:d",
    "SELECT m + 19 AS date FROM months WHERE month(m) IN (1, 4, 7, 10) AND m + 19 BETWEEN lo AND hi",
    bounds=BOUNDS,
    months=MONTHS,
)
def _(fx):
    return series.vat_due_dates(series.date_bounds(fx.bank_base()))


@query(
    "t20_seasonal_factor",
    "o_orderkey:i d:d seasonal_factor:f2",
    "SELECT o_orderkey, d, CASE month(d) " + " ".join(f"WHEN {m} THEN {f}" for m, f in SEASONAL_FACTOR.items()) + " END AS seasonal_factor FROM fx_invoices_base",
)
def _(fx):
    return series.seasonal_factor(fx.invoices_base().select("o_orderkey", "d"), "d")


@query(
    "t21_rolling_mean",
    "ds:d rolling_mean_7d:f0",
    "SELECT ds, avg(y) OVER (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean_7d FROM v_full",
)
def _(fx):
    return series.rolling_mean(series.target_series(series.cash_flow_daily(fx.bank())), "y")
