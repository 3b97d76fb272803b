"""Forecasting queries."""

from datetime import date

from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.operators import evaluate, forecast, series
from ledgerflow.operators.clean import clean_external_factors
from ledgerflow.plans.oracle_derived import base_forecast
from ledgerflow.plans.oracle_full import full_model
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import fresh_path, store

ACCOUNT = ["bank_account"]
AHEAD = "ds:d yhat:f0 yhat_lower:f0 yhat_upper:f0 trend:f0 yearly:f6 weekly:f6"


def history(fx):
    return series.target_series(series.cash_flow_daily(fx.bank()))


def account_history(fx):
    return series.target_series(series.cash_flow_daily(fx.bank_multi(), ACCOUNT), keys=ACCOUNT)


def split(fx):
    """Training and test part; stored, because evaluations use both."""
    flagged = store(series.split_train_test(history(fx)), "split")
    return flagged.where("is_train").drop("is_train"), flagged.where("NOT is_train").drop("is_train")


def full_forecast(fx):
    """Origin at the series end: the input of KPIs and alerts."""
    return forecast.predict_base(forecast.fit_base(history(fx)))


def train_forecast(fx):
    """Origin at the end of the training part: the input of the evaluation."""
    return evaluation_parts(fx)[2]


def evaluation_parts(fx):
    """Training part, test part, forecast from the training part."""
    train, test = split(fx)
    return train, test, forecast.predict_base(forecast.fit_base(train))


@query("f01_linear_trend", "origin:d last_day:d n:i slope:f4 intercept:f0", "SELECT min(origin) AS origin, max(last_day) AS last_day, count(*) AS n, min(slope) AS slope, min(intercept) AS intercept FROM v_fit_full")
def _(fx):
    return forecast.trend_model(history(fx))


@query(
    "f01_linear_trend_by_account",
    "bank_account:s slope:f4 intercept:f0",
    "SELECT bank_account, min(slope) AS slope, min(intercept) AS intercept FROM v_fit_acc GROUP BY bank_account",
)
def _(fx):
    return forecast.trend_model(account_history(fx), ACCOUNT)


@query(
    "f02_seasonal_index",
    "season:s position:i effect:f6",
    "SELECT DISTINCT 'weekly' AS season, weekday AS position, weekly AS effect FROM v_fit_full UNION ALL SELECT DISTINCT 'yearly', month, yearly FROM v_fit_full",
)
def _(fx):
    return forecast.seasonal_index(history(fx))


#: what was known 90 days before: the last rate of a day up to then, and the mean of the seven days up to then
GIVEN = """SELECT f.ds, r.interest_rate, m.rolling_mean_7d FROM
 (SELECT ds FROM v_full UNION ALL SELECT CAST(unnest(generate_series(hi + 1, hi + 90, INTERVAL 1 DAY)) AS DATE) FROM (SELECT max(ds) AS hi FROM v_full) x) f
 ASOF LEFT JOIN (SELECT date, max(value) AS interest_rate FROM fx_factors WHERE indicator = 'interest_rate' AND value IS NOT NULL GROUP BY date) r ON f.ds - 90 >= r.date
 ASOF LEFT JOIN (SELECT ds, avg(y) OVER (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean_7d FROM v_full) m ON f.ds - 90 >= m.ds"""

#: two solvers of one system differ by about 1e-10 of the largest balance (here some 10^8): money is compared to thousands
AHEAD_FULL = "ds:d yhat:f-3 yhat_lower:f-3 yhat_upper:f-3 trend:f-3 yearly:f4 weekly:f4"
MONTHLY = ModelConfig(monthly_order=5)
LINE = ModelConfig(changepoints=0, yearly_order=0, weekly_order=0)


@query("f03_full_model", AHEAD_FULL, "SELECT * FROM full_ahead", **full_model("v_full", ModelConfig()))
def _(fx):
    config = ModelConfig()
    return forecast.predict_full(forecast.fit_full(history(fx), config=config), config=config)


@query("f03_full_model_by_account", "bank_account:s " + AHEAD_FULL, "SELECT * FROM full_ahead", **full_model("v_hist_acc", MONTHLY, "bank_account"))
def _(fx):
    return forecast.predict_full(forecast.fit_full(account_history(fx), ACCOUNT, MONTHLY), ACCOUNT, MONTHLY)


@query(
    "f03_line_without_bends",
    "bank_account:s intercept:f0 slope:f0 n:i",
    """SELECT bank_account, regr_intercept(y, t) AS intercept, regr_slope(y, t) * (max(t) - min(t)) AS slope, count(*) AS n
     FROM (SELECT bank_account, CAST(y AS DOUBLE) AS y, date_diff('day', min(ds) OVER (PARTITION BY bank_account), ds) AS t FROM v_hist_acc) h GROUP BY bank_account""",
)
def _(fx):
    model = forecast.fit_full(account_history(fx), ACCOUNT, LINE)
    return model.select("bank_account", F.get("trend_w", F.lit(0)).alias("intercept"), F.get("trend_w", F.lit(1)).alias("slope"), "n")


YEARS = "SELECT CAST(unnest(generate_series(year(lo), year(hi))) AS INT) AS y FROM (SELECT min(dt) AS lo, max(dt) AS hi FROM fx_bank_base) b"
MOON = """SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years"""
MOON2 = "SELECT *, (19 * a + b - b // 4 - (b - (b + 8) // 25 + 1) // 3 + 15) % 30 AS h FROM moon"
MOON3 = "SELECT *, (32 + 2 * (b % 4) + 2 * (c // 4) - h - c % 4) % 7 AS l FROM moon2"
EASTER = "SELECT y, make_date(y, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) // 31, (h + l - 7 * ((a + 11 * h + 22 * l) // 451) + 114) % 31 + 1) AS easter FROM moon3"


@query(
    "f04_holiday_calendar",
    "holiday:s date:d",
    "SELECT 'good_friday' AS holiday, easter - 2 AS date FROM easter UNION ALL "
    + " UNION ALL ".join(f"SELECT '{n}', make_date(y, {m}, {d}) FROM years" for n, (m, d) in forecast.FIXED_HOLIDAYS.items()),
    years=YEARS,
    moon=MOON,
    moon2=MOON2,
    moon3=MOON3,
    easter=EASTER,
)
def _(fx):
    return forecast.holiday_calendar(series.date_bounds(fx.bank_base()))


REGRESSORS = ["interest_rate", "rolling_mean_7d"]


def known_regressors(fx, real, horizon):
    """The frame's days with the values that were known ``horizon`` days before each of them."""
    frame = forecast.future_frame(real, horizon=horizon)
    rates = series.factors_wide(clean_external_factors(fx.factors())).select(F.col("date").alias("known"), "interest_rate")
    means = series.rolling_mean(real, "y").select(F.col("ds").alias("known"), "rolling_mean_7d")
    out = forecast.known_before(frame, rates, "known", ["interest_rate"], lag=horizon)
    return forecast.known_before(out, means, "known", ["rolling_mean_7d"], lag=horizon)


@query("f05_known_regressors", "ds:d interest_rate:f4 rolling_mean_7d:f-3", "SELECT * FROM given", given=GIVEN)
def _(fx):
    return known_regressors(fx, history(fx), ModelConfig().horizon_days)


@query("f05_extra_regressors", AHEAD_FULL, "SELECT * FROM full_ahead", given=GIVEN, **full_model("v_full", ModelConfig(), given="given", regressors=REGRESSORS))
def _(fx):
    config = ModelConfig()
    real = history(fx)
    days = store(known_regressors(fx, real, config.horizon_days), "regressors")
    forecast.require_known(days, REGRESSORS, config.horizon_days)
    model = forecast.fit_full(real.join(days, "ds"), config=config, regressors=REGRESSORS)
    return forecast.predict_full(model, config=config, regressors=REGRESSORS, regressor_days=days)


@query(
    "f05_values_known_later",
    "ds:d known:d rolling_mean_7d:f-3",
    """SELECT f.ds, m.ds AS known, m.rolling_mean_7d FROM v_full f ASOF JOIN
     (SELECT ds, avg(y) OVER (ORDER BY ds ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS rolling_mean_7d FROM v_full) m ON f.ds - 60 >= m.ds""",
)
def _(fx):
    # taken 60 days before: every one of these values is too late for a forecast 90 days ahead
    real = history(fx)
    means = series.rolling_mean(real, "y").select(F.col("ds").alias("known"), "rolling_mean_7d")
    days = forecast.known_before(real, means, "known", ["rolling_mean_7d"], lag=60)
    return forecast.known_too_late(days, ["rolling_mean_7d"], lag=90).withColumn("known", F.col("rolling_mean_7d_known"))


@query("f06_future_frame", "ds:d", "SELECT ds FROM v_full UNION ALL SELECT CAST(unnest(generate_series(hi + 1, hi + 90, INTERVAL 1 DAY)) AS DATE) FROM (SELECT max(ds) AS hi FROM v_full) m")
def _(fx):
    return forecast.future_frame(history(fx))


@query("f07_predict", AHEAD, "SELECT * FROM v_fc")
def _(fx):
    return full_forecast(fx)


@query("f07_predict_by_account", "bank_account:s " + AHEAD, "SELECT * FROM v_fc_acc")
def _(fx):
    return forecast.predict_base(forecast.fit_base(account_history(fx), ACCOUNT), ACCOUNT)


@query("f07_predict_train_origin", AHEAD, "SELECT * FROM v_fc_train")
def _(fx):
    return train_forecast(fx)


@query("f08_components", "ds:d trend:f0 yearly:f6 weekly:f6", "SELECT ds, trend, yearly, weekly FROM v_fc")
def _(fx):
    return full_forecast(fx).select("ds", "trend", "yearly", "weekly")


@query("f09_last_90_days", AHEAD, "SELECT * FROM v_fc WHERE ds >= (SELECT max(ds) FROM v_fc) - 89")
def _(fx):
    return forecast.forecast_tail(full_forecast(fx))


RISK = """SELECT min(yhat) AS min_forecast_balance, avg(yhat) AS avg_forecast_balance,
 max_by(yhat, ds) - min_by(yhat, ds) FILTER (WHERE back <= 30) AS trend_30d,
 CASE WHEN min(yhat) < 25000 THEN 'ALTO' WHEN min(yhat) < 50000 THEN 'MEDIO' ELSE 'BAJO' END AS risk_level,
 count(*) FILTER (WHERE yhat < 50000) AS days_below_threshold"""
RISK_COLUMNS = "min_forecast_balance:f0 avg_forecast_balance:f0 trend_30d:f0 risk_level:s days_below_threshold:i"


@query("f10_risk_indicators", RISK_COLUMNS, f"{RISK} FROM (SELECT *, row_number() OVER (ORDER BY ds DESC) AS back FROM v_fc) f")
def _(fx):
    return forecast.risk_indicators(full_forecast(fx))


@query(
    "f10_risk_indicators_by_account",
    "bank_account:s " + RISK_COLUMNS,
    RISK.replace("SELECT ", "SELECT bank_account, ", 1) + " FROM (SELECT *, row_number() OVER (PARTITION BY bank_account ORDER BY ds DESC) AS back FROM v_fc_acc) f GROUP BY bank_account",
)
def _(fx):
    ahead = forecast.predict_base(forecast.fit_base(account_history(fx), ACCOUNT), ACCOUNT)
    return forecast.risk_indicators(ahead, ACCOUNT)


@query(
    "f11_forecast_summary",
    "start:d end:d days:i min_balance:f0 max_balance:f0 mean_balance:f0 std_balance:f0",
    """SELECT min(ds) AS start, max(ds) AS "end", count(*) AS days, min(yhat) AS min_balance, max(yhat) AS max_balance, avg(yhat) AS mean_balance, stddev_samp(yhat) AS std_balance FROM v_fc""",
)
def _(fx):
    return forecast.forecast_summary(full_forecast(fx))


@query(
    "f12_forecast_nearest",
    "forecast_90d:f0",
    "SELECT yhat AS forecast_90d FROM v_fc ORDER BY abs(date_diff('day', ds, (SELECT max(date) FROM v_cash) + 90)), ds LIMIT 1",
)
def _(fx):
    days = store(series.cash_flow_daily(fx.bank()), "daily")
    ahead = forecast.predict_base(forecast.fit_base(series.target_series(days)))
    return forecast.forecast_at(ahead, as_of=series.latest_day(days))


@query("f12_forecast_nearest_to_date", "forecast_90d:f0", "SELECT yhat AS forecast_90d FROM v_fc ORDER BY abs(date_diff('day', ds, DATE '1998-03-01' + 90)), ds LIMIT 1")
def _(fx):
    return forecast.forecast_at(full_forecast(fx), as_of=date(1998, 3, 1))


@query("f12_forecast_last", "forecast_90d:f0", "SELECT yhat AS forecast_90d FROM v_fc ORDER BY ds DESC LIMIT 1")
def _(fx):
    return forecast.forecast_at(full_forecast(fx), method="last")


@query("f12_forecast_ordinal", "forecast_90d:f0", "SELECT yhat AS forecast_90d FROM v_fc ORDER BY ds LIMIT 1 OFFSET 89")
def _(fx):
    return forecast.forecast_at(full_forecast(fx), method="ordinal")


@query("f13_saved_model", AHEAD, "SELECT * FROM v_fc")
def _(fx):
    path = fresh_path(fx.spark, "model")
    forecast.save_model(forecast.fit_base(history(fx)), path)
    return forecast.predict_base(forecast.load_model(fx.spark, path))


@query("f13_saved_full_model", "bank_account:s " + AHEAD_FULL, "SELECT * FROM full_ahead", **full_model("v_hist_acc", MONTHLY, "bank_account"))
def _(fx):
    path = fresh_path(fx.spark, "model")
    forecast.save_model(forecast.fit_full(account_history(fx), ACCOUNT, MONTHLY), path)
    return forecast.predict_full(forecast.load_model(fx.spark, path), ACCOUNT, MONTHLY)


@query("f14_naive_forecast", "ds:d y:m y_naive:m", "SELECT * FROM (SELECT ds, y, lag(y) OVER (ORDER BY ds) AS y_naive FROM v_test) t WHERE y_naive IS NOT NULL")
def _(fx):
    return forecast.naive_forecast(split(fx)[1])


FOLDS = """SELECT f.fold, h.ds, h.y, h.rn <= h.n - (6 - f.fold) * (h.n // 6) AS is_train FROM v_full h, (SELECT unnest(generate_series(1, 5)) AS fold) f
 WHERE h.rn <= h.n - (6 - f.fold) * (h.n // 6) + h.n // 6"""


@query("f15_rolling_folds", "fold:i ds:d is_train:b", FOLDS)
def _(fx):
    return forecast.rolling_folds(history(fx))


@query(
    "f15_cross_validation",
    "fold:i mae:f0 mape:f2 n_evaluations:i",
    """SELECT t.fold, avg(abs(t.y - p.yhat)) AS mae, coalesce(avg(abs((t.y - p.yhat) / nullif(t.y, 0))) * 100, 0) AS mape, count(*) AS n_evaluations
     FROM (SELECT * FROM folds WHERE NOT is_train) t JOIN (
      SELECT m.fold, m.ds, (m.intercept + m.slope * date_diff('day', m.origin, m.ds)) * (1 + coalesce(w.weekly, 0.0) + coalesce(y.yearly, 0.0)) AS yhat
      FROM (SELECT s.fold, s.origin, s.slope, s.intercept, d.ds FROM (SELECT DISTINCT fold, origin, slope, intercept FROM fitted) s JOIN folds d ON s.fold = d.fold AND NOT d.is_train) m
      LEFT JOIN (SELECT DISTINCT fold, weekday, weekly FROM fitted) w ON w.fold = m.fold AND w.weekday = isodow(m.ds) - 1
      LEFT JOIN (SELECT DISTINCT fold, month, yearly FROM fitted) y ON y.fold = m.fold AND y.month = month(m.ds)
     ) p ON t.fold = p.fold AND t.ds = p.ds GROUP BY t.fold""",
    folds=FOLDS,
    train_folds="SELECT fold, ds, y FROM folds WHERE is_train",
    fitted=base_forecast("train_folds", "fold")["fitted"],
)
def _(fx):
    return evaluate.cross_validate(forecast.rolling_folds(history(fx)))


@query(
    "f15_full_folds",
    "fold:i mae:f-2 mape:f1 n_evaluations:i",
    """SELECT t.fold, avg(abs(t.y - a.yhat)) AS mae, coalesce(avg(abs((t.y - a.yhat) / nullif(t.y, 0))) * 100, 0) AS mape, count(*) AS n_evaluations
     FROM test_folds t JOIN full_ahead a ON a.fold = t.fold AND a.ds = t.ds GROUP BY t.fold""",
    folds=FOLDS,
    train_folds="SELECT fold, ds, y FROM folds WHERE is_train",
    test_folds="SELECT fold, ds, y FROM folds WHERE NOT is_train",
    **full_model("train_folds", ModelConfig(), "fold", days="test_folds"),
)
def _(fx):
    return evaluate.cross_validate(forecast.rolling_folds(history(fx)), model="full")


@query(
    "f10_future_risk_by_account",
    "bank_account:s " + RISK_COLUMNS,
    RISK.replace("SELECT ", "SELECT bank_account, ", 1)
    + """ FROM (SELECT *, row_number() OVER (PARTITION BY bank_account ORDER BY ds DESC) AS back FROM v_fc_acc f
     WHERE ds > (SELECT max(h.ds) FROM v_hist_acc h WHERE h.bank_account = f.bank_account)) f GROUP BY bank_account""",
)
def _(fx):
    real = store(account_history(fx), "history")
    ahead = forecast.predict_base(forecast.fit_base(real, ACCOUNT), ACCOUNT)
    return forecast.risk_indicators(ahead, ACCOUNT, scope="future", origin=real.groupBy(*ACCOUNT).agg(F.max("ds").alias("today")))
