"""Evaluation queries."""

from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.functions.measures import mape_grade
from ledgerflow.operators import evaluate, forecast
from ledgerflow.plans.oracle_full import full_model
from ledgerflow.plans.queries_forecast import account_history, evaluation_parts, split
from ledgerflow.plans.queries_kpi import forecast_of, stored_daily
from ledgerflow.plans.registry import query

ACCOUNT = ["bank_account"]


def pairs(fx):
    _, test, ahead = evaluation_parts(fx)
    return evaluate.pair_up(test, ahead)


def shown(fx):
    days = stored_daily(fx)
    return evaluate.forecast_vs_real(forecast_of(days), days)


MAE = "avg(abs(y - yhat))"
RMSE = "sqrt(avg((y - yhat) * (y - yhat)))"
MAPE = "coalesce(avg(abs((y - yhat) / nullif(y, 0))) * 100, 0)"
SMAPE = "coalesce(avg(abs(y - yhat) / nullif((abs(y) + abs(yhat)) / 2, 0)) * 100, 0)"
COVERAGE = "avg(CASE WHEN y >= yhat_lower AND y <= yhat_upper THEN 1.0 ELSE 0.0 END) * 100"
ALL = f"{MAE} AS mae, {RMSE} AS rmse, {MAPE} AS mape, {SMAPE} AS smape"
STEPS = "SELECT y, yhat FROM (SELECT ds, y, lag(y) OVER (ORDER BY ds) AS yhat FROM v_test) t WHERE yhat IS NOT NULL"


@query("e01_mae", "mae:f0", f"SELECT {MAE} AS mae FROM v_pairs")
def _(fx):
    return pairs(fx).agg(evaluate.mae().alias("mae"))


@query("e02_rmse", "rmse:f0", f"SELECT {RMSE} AS rmse FROM v_pairs")
def _(fx):
    return pairs(fx).agg(evaluate.rmse().alias("rmse"))


@query("e03_mape", "mape:f4", f"SELECT {MAPE} AS mape FROM v_pairs")
def _(fx):
    return pairs(fx).agg(evaluate.mape().alias("mape"))


@query("e04_smape", "smape:f4", f"SELECT {SMAPE} AS smape FROM v_pairs")
def _(fx):
    return pairs(fx).agg(evaluate.smape().alias("smape"))


@query("e05_coverage", "coverage:f4", f"SELECT {COVERAGE} AS coverage FROM v_pairs")
def _(fx):
    return pairs(fx).agg(evaluate.coverage().alias("coverage"))


@query(
    "e06_evaluate",
    "mae:f0 rmse:f0 mape:f2 smape:f2 coverage:f2 interval_level:f2 n_evaluations:i",
    f"SELECT {ALL}, {COVERAGE} AS coverage, 0.8 AS interval_level, count(*) AS n_evaluations FROM v_pairs",
)
def _(fx):
    return evaluate.evaluate(pairs(fx))


@query(
    "e06_evaluate_by_account",
    "bank_account:s mae:f0 mape:f2 n_evaluations:i",
    f"""SELECT bank_account, {MAE} AS mae, {MAPE} AS mape, count(*) AS n_evaluations FROM
     (SELECT h.bank_account, h.y, f.yhat FROM v_hist_acc h JOIN v_fc_acc f ON h.bank_account = f.bank_account AND h.ds = f.ds) p GROUP BY bank_account""",
)
def _(fx):
    real = account_history(fx)
    ahead = forecast.predict_base(forecast.fit_base(real, ACCOUNT), ACCOUNT)
    return evaluate.evaluate(evaluate.pair_up(real, ahead, ACCOUNT), ACCOUNT)


@query(
    "e07_naive_metrics",
    "naive_mae:f0 naive_rmse:f0 naive_mape:f2",
    f"SELECT {MAE} AS naive_mae, {RMSE} AS naive_rmse, {MAPE} AS naive_mape FROM ({STEPS}) s",
)
def _(fx):
    return evaluate.naive_metrics(split(fx)[1])


@query(
    "e07_naive_last_train_value",
    "naive_mae:f0 naive_rmse:f0 naive_mape:f2",
    f"SELECT {MAE} AS naive_mae, {RMSE} AS naive_rmse, {MAPE} AS naive_mape FROM (SELECT y, (SELECT y FROM v_train ORDER BY ds DESC LIMIT 1) AS yhat FROM v_test) s",
)
def _(fx):
    train, test = split(fx)
    return evaluate.naive_metrics(test, naive="last_train_value", train=train)


@query(
    "e08_evaluation_report",
    "mae:f0 mape:f2 naive_mae:f0 naive_mape:f2 mae_improvement:f1 mape_improvement:f1 n_evaluations:i",
    f"""SELECT m.mae, m.mape, n.mae AS naive_mae, n.mape AS naive_mape, (n.mae - m.mae) / nullif(n.mae, 0) * 100 AS mae_improvement,
     (n.mape - m.mape) / nullif(n.mape, 0) * 100 AS mape_improvement, n_evaluations
     FROM (SELECT round({MAE}, 2) AS mae, round({MAPE}, 2) AS mape, count(*) AS n_evaluations FROM v_pairs) m,
      (SELECT round({MAE}, 2) AS mae, round({MAPE}, 2) AS mape FROM ({STEPS}) s) n""",
)
def _(fx):
    _, test, ahead = evaluation_parts(fx)
    return evaluate.evaluation_report(test, ahead)


@query(
    "e08_report_full_model",
    "mae:f-3 mape:f1 naive_mae:f0 naive_mape:f2 n_evaluations:i",
    f"""SELECT m.mae, m.mape, n.mae AS naive_mae, n.mape AS naive_mape, n_evaluations
     FROM (SELECT {MAE} AS mae, {MAPE} AS mape, count(*) AS n_evaluations FROM v_test t JOIN full_ahead f ON t.ds = f.ds) m,
      (SELECT round({MAE}, 2) AS mae, round({MAPE}, 2) AS mape FROM ({STEPS}) s) n""",
    **full_model("v_train", ModelConfig()),
)
def _(fx):
    train, test = split(fx)
    return evaluate.evaluation_report(test, forecast.predict_full(forecast.fit_full(train)))


@query(
    "e08_report_same_days",
    "mae:f0 naive_mae:f0 mae_improvement:f1",
    f"""SELECT m.mae, n.mae AS naive_mae, (n.mae - m.mae) / nullif(n.mae, 0) * 100 AS mae_improvement FROM (SELECT round({MAE}, 2) AS mae FROM v_pairs) m,
      (SELECT round({MAE}, 2) AS mae FROM (SELECT y, (SELECT y FROM v_train ORDER BY ds DESC LIMIT 1) AS yhat FROM v_pairs) s) n""",
)
def _(fx):
    train, test, ahead = evaluation_parts(fx)
    return evaluate.evaluation_report(test, ahead, naive="last_train_value", train=train)


SHOWN = "ds:d y:m yhat:f0 error:f0 abs_error:f0 pct_error:f2"


@query("e09_forecast_vs_real", SHOWN, "SELECT * FROM v_shown")
def _(fx):
    return shown(fx)


@query("e09_forecast_vs_real_all_days", SHOWN, "SELECT * FROM v_shown_all")
def _(fx):
    return shown(fx)


@query("e10_error_summary", "mae:f0 rmse:f0 mape:f2 bias:f0", f"SELECT {MAE} AS mae, {RMSE} AS rmse, avg(pct_error) AS mape, avg(y - yhat) AS bias FROM v_shown")
def _(fx):
    return evaluate.error_summary(shown(fx))


@query(
    "e11_error_histogram",
    "bin:i frequency:i bin_start:f0",
    """SELECT bin, count(*) AS frequency, min(lo + (bin - 1) * w) AS bin_start FROM
     (SELECT lo, (hi - lo) / 30 AS w, least(coalesce(floor((error - lo) / nullif((hi - lo) / 30, 0)) + 1, 1), 30) AS bin
      FROM v_shown, (SELECT min(error) AS lo, max(error) AS hi FROM v_shown) b) x GROUP BY bin""",
)
def _(fx):
    return evaluate.error_histogram(shown(fx))


@query("e12_axis_range", "min_val:f0 max_val:f0", "SELECT least(min(y), min(yhat)) AS min_val, greatest(max(y), max(yhat)) AS max_val FROM v_shown")
def _(fx):
    return evaluate.axis_range(shown(fx))


@query("e12_scatter_pairs", "y:m yhat:f0", "SELECT y, yhat FROM v_shown")
def _(fx):
    return shown(fx).select("y", "yhat")


@query("e13_mape_grade", "grade:s", f"SELECT CASE WHEN m < 5 THEN 'Excelente' WHEN m < 10 THEN 'Aceptable' ELSE 'Revisar' END AS grade FROM (SELECT {MAPE} AS m FROM v_pairs) p")
def _(fx):
    return pairs(fx).agg(evaluate.mape().alias("mape")).select(mape_grade(F.col("mape")).alias("grade"))


@query(
    "e14_deviation_by_day",
    "ds:d y:m yhat:f0 deviation_pct:f4",
    "SELECT ds, y, yhat, (y - yhat) / nullif(abs(yhat), 0) * 100 AS deviation_pct FROM v_shown_all WHERE ds >= (SELECT max(date) FROM v_cash) - 30",
)
def _(fx):
    days = stored_daily(fx)
    return evaluate.deviation_by_day(forecast_of(days), days)


@query("e15_metrics_by_month", "month:s mae:f0 rmse:f0 mape:f2 smape:f2 n:i", f"SELECT strftime(ds, '%Y-%m') AS month, {ALL}, count(*) AS n FROM v_pairs GROUP BY 1")
def _(fx):
    return evaluate.metrics_by_month(pairs(fx))
