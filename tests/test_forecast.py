"""Fits, predictions, holidays and metrics."""

import math
import random
from datetime import date, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.operators import evaluate, forecast


def synthetic(days=900, seed=3, level=1000.0, slope=1.0):
    noise = random.Random(seed)
    start = date(2021, 1, 1)
    rows = []
    for i in range(days):
        ds = start + timedelta(days=i)
        season = 1 + 0.2 * math.sin(2 * math.pi * i / 365.25) + (0.05 if ds.weekday() < 5 else -0.1)
        rows.append((ds, (level + slope * i) * season + noise.gauss(0, 5)))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    rows = [("a", *r) for r in synthetic()] + [("b", *r) for r in synthetic(seed=4, level=5000.0, slope=-2.0)]
    return spark.createDataFrame(rows, "s string, ds date, y double")


def parts(frame, horizon=90):
    cut = date(2021, 1, 1) + timedelta(days=899 - horizon)
    return frame.where(F.col("ds") <= F.lit(cut)), frame.where(F.col("ds") > F.lit(cut))


def test_trend_equals_polyfit(frame):
    model = {r.s: r for r in forecast.trend_model(frame, ["s"]).collect()}
    for s, rows in (("a", synthetic()), ("b", synthetic(seed=4, level=5000.0, slope=-2.0))):
        slope, intercept = np.polyfit(np.arange(len(rows)), [y for _, y in rows], 1)
        assert math.isclose(model[s].slope, slope, rel_tol=1e-6)
        assert math.isclose(model[s].intercept, intercept, rel_tol=1e-6)


@pytest.mark.parametrize("full", [False, True])
def test_beats_the_constant_forecast(frame, full):
    train, test = parts(frame)
    if full:
        ahead = forecast.predict_full(forecast.fit_full(train, ["s"]), ["s"])
    else:
        ahead = forecast.predict_base(forecast.fit_base(train, ["s"]), ["s"])
    report = evaluate.evaluation_report(test, ahead, ["s"], naive="last_train_value", train=train)
    for row in report.collect():
        assert row.n_evaluations == 90
        assert row.mape < row.naive_mape
        if full:
            assert row.mape < 5


def test_full_fit_equals_direct_least_squares(frame):
    """With weak priors the piecewise trend is the least-squares line on the same columns."""
    config = ModelConfig(changepoints=3, changepoint_prior_scale=1e6)
    one = frame.where("s = 'a'").drop("s")
    model = forecast.fit_full(one, config=config).first()
    y = np.array([y for _, y in synthetic()])
    tau = np.arange(len(y)) / (len(y) - 1)
    bends = [np.maximum(tau - 0.8 * (i + 1) / 4, 0) for i in range(3)]
    direct, *_ = np.linalg.lstsq(np.column_stack([np.ones_like(tau), tau, *bends]), y, rcond=None)
    assert np.allclose(model.trend_w, direct, rtol=1e-4)


def test_full_predict_equals_numpy_dot(frame):
    one = frame.where("s = 'a'").drop("s")
    config = ModelConfig(monthly_order=5)
    model = forecast.fit_full(one, config=config)
    row = model.first()
    got = {r.ds: r for r in forecast.predict_full(model, config=config, horizon=5).collect()}
    ds = date(2021, 1, 1) + timedelta(days=902)
    tau = 902 / row.train_span
    bends = [max(tau - 0.8 * (i + 1) / 26, 0) for i in range(25)]
    assert math.isclose(got[ds].trend, float(np.dot([1, tau, *bends], row.trend_w)), rel_tol=1e-9)
    assert len(got) == 905


def test_band_contains_the_forecast(frame):
    rows = forecast.predict_base(forecast.fit_base(frame, ["s"]), ["s"]).collect()
    assert all(r.yhat_lower <= r.yhat <= r.yhat_upper for r in rows)
    wide = forecast.predict_base(forecast.fit_base(frame, ["s"]), ["s"], interval_level=0.95)
    assert wide.agg(F.min(F.col("yhat_upper") - F.col("yhat_lower"))).first()[0] > rows[0].yhat_upper - rows[0].yhat_lower


def test_saved_model_predicts_the_same(spark, frame, tmp_path):
    model = forecast.fit_base(frame, ["s"])
    forecast.save_model(model, str(tmp_path / "m"))
    again = forecast.predict_base(forecast.load_model(spark, str(tmp_path / "m")), ["s"])
    assert forecast.predict_base(model, ["s"]).exceptAll(again).count() == 0


def test_regressor_improves_the_fit(frame):
    pulse = F.when(F.dayofyear("ds") % 10 == 0, 1.0).otherwise(0.0)
    one = frame.where("s = 'a'").drop("s").withColumn("pulse", pulse).withColumn("y", F.col("y") * (1 + 0.5 * F.col("pulse")))
    plain = forecast.fit_full(one).first().sigma
    assert forecast.fit_full(one, regressors=["pulse"]).first().sigma < plain / 2


def test_easter_dates(spark):
    from ledgerflow.functions.dates import easter_sunday

    known = {2000: date(2000, 4, 23), 2008: date(2008, 3, 23), 2011: date(2011, 4, 24), 2024: date(2024, 3, 31), 2025: date(2025, 4, 20), 2038: date(2038, 4, 25)}
    rows = spark.createDataFrame([(y,) for y in known], "y int").select("y", easter_sunday(F.col("y")).alias("e")).collect()
    assert {r.y: r.e for r in rows} == known


def test_metrics_on_the_four_point_sample(spark):
    rows = [(date(2024, 1, i + 1), y, p, p - 1, p + 1) for i, (y, p) in enumerate([(100.0, 105.0), (110.0, 108.0), (120.0, 125.0), (130.0, 128.0)])]
    pairs = spark.createDataFrame(rows, "ds date, y double, yhat double, yhat_lower double, yhat_upper double")
    row = evaluate.evaluate(pairs).first()
    assert row.mae == 3.5 and math.isclose(row.rmse, round(math.sqrt(14.5), 2)) and row.coverage == 0.0


def test_metrics_of_zero_and_empty_input(spark):
    schema = "ds date, y double, yhat double, yhat_lower double, yhat_upper double"
    zero = spark.createDataFrame([(date(2024, 1, 1), 0.0, 0.0, 0.0, 0.0)], schema)
    row = evaluate.evaluate(zero).first()
    assert (row.mape, row.smape, row.coverage) == (0.0, 0.0, 100.0)
    assert evaluate.evaluate(zero.limit(0)).count() == 0


def test_horizon_value_ties_take_the_earlier_day(spark):
    rows = [(date(2024, 1, 1), 1.0), (date(2024, 1, 3), 3.0)]
    frame = spark.createDataFrame(rows, "ds date, yhat double")
    assert forecast.forecast_at(frame, as_of=date(2024, 1, 2), days=0).first()[0] == 1.0
    assert forecast.forecast_at(frame, method="last").first()[0] == 3.0
    assert forecast.forecast_at(frame, method="ordinal", ordinal=1).first()[0] == 3.0
    with pytest.raises(ValueError):
        forecast.forecast_at(frame, method="other")


def test_risk_indicator_bands(spark):
    for low, band in ((10_000.0, "ALTO"), (30_000.0, "MEDIO"), (60_000.0, "BAJO")):
        frame = spark.createDataFrame([(date(2024, 1, 1), 90_000.0), (date(2024, 1, 2), low)], "ds date, yhat double")
        row = forecast.risk_indicators(frame).first()
        assert row.risk_level == band and row.trend_30d == low - 90_000.0


def test_future_scope_needs_an_origin(frame):
    with pytest.raises(ValueError):
        forecast.risk_indicators(frame.withColumnRenamed("y", "yhat"), ["s"], scope="future")


def test_folds_cover_the_tail_once(frame):
    folds = forecast.rolling_folds(frame, ["s"]).where("NOT is_train")
    assert folds.groupBy("s", "ds").count().where("count > 1").count() == 0
    assert folds.groupBy("s", "fold").count().where("count <> 150").count() == 0


def test_histogram_keeps_every_error(spark):
    frame = spark.createDataFrame([(float(i * i),) for i in range(100)], "error double")
    rows = evaluate.error_histogram(frame).collect()
    assert sum(r.frequency for r in rows) == 100 and max(r.bin for r in rows) == 30
    same = spark.createDataFrame([(5.0,)] * 3, "error double")
    assert [(r.bin, r.frequency) for r in evaluate.error_histogram(same).collect()] == [(1, 3)]


def test_regressors_do_not_depend_on_their_unit_and_must_be_known_ahead(spark):
    from ledgerflow.config import ModelConfig

    config = ModelConfig()
    days = spark.range(400).select(F.date_add(F.lit("2022-01-01").cast("date"), F.col("id").cast("int")).alias("ds"), "id")
    given = days.withColumn("r", 100 + 20 * F.sin(F.col("id") * 0.7))
    real = given.where("id < 310").withColumn("y", 1000 + F.col("id") + 3 * (F.col("r") - 100))
    ahead = {}
    for unit in (1.0, 1e6):
        known = given.withColumn("r", F.col("r") * unit)
        model = forecast.fit_full(real.withColumn("r", F.col("r") * unit).select("ds", "y", "r"), config=config, regressors=["r"])
        found = forecast.predict_full(model, config=config, regressors=["r"], regressor_days=known.select("ds", "r"))
        ahead[unit] = {r.ds: r.yhat for r in found.collect()}
    assert len(ahead[1.0]) == 400
    assert all(abs(ahead[1.0][d] - ahead[1e6][d]) < 1e-3 for d in ahead[1.0])
    last = max(ahead[1.0])
    assert abs(ahead[1.0][last] - (1000 + 399 + 60 * float(np.sin(399 * 0.7)))) < 60
    with pytest.raises(Exception, match="no regressor value"):
        forecast.predict_full(model, config=config, regressors=["r"], regressor_days=real.select("ds", "r")).collect()


def test_full_fit_equals_plain_numpy(spark, frame):
    """Both systems against numpy on the whole design, with gaps and nulls in the history and a regressor."""
    config = ModelConfig(changepoints=4, yearly_order=2, weekly_order=1, monthly_order=1)
    one = frame.where("s = 'a' AND dayofyear(ds) % 11 <> 0").drop("s")
    one = one.withColumn("r", F.when(F.dayofyear("ds") % 7 != 3, F.dayofyear("ds") % 5).cast("double"))
    gaps = one.unionByName(spark.createDataFrame([(date(2020, 1, 1), None, 1.0)], one.schema))
    model = forecast.fit_full(gaps, config=config, regressors=["r"]).first()
    rows = sorted((r.ds, r.y, r.r) for r in one.collect())
    days, y = np.array([(r[0] - date(1970, 1, 1)).days for r in rows], float), np.array([r[1] for r in rows])
    tau = (days - days[0]) / (days[-1] - days[0])
    trend_x = np.column_stack([np.ones_like(tau), tau, *[np.maximum(tau - 0.8 * (i + 1) / 5, 0) for i in range(4)]])
    scale = np.abs(y).max()

    def ridge(x, v, penalty):
        return np.linalg.solve(x.T @ x + np.diag(penalty + 1e-9), x.T @ v)

    noise = np.var(y / scale - trend_x[:, :2] @ ridge(trend_x[:, :2], y / scale, np.zeros(2)))
    trend_w = ridge(trend_x, y / scale, np.r_[0, 0, np.full(4, noise / config.changepoint_prior_scale**2)]) * scale
    trend = trend_x @ trend_w
    waves = [f(2 * np.pi * k * days / period) for period, order in ((365.25, 2), (7, 1)) for k in range(1, order + 1) for f in (np.sin, np.cos)]
    flags = np.array([list(r) for r in spark.createDataFrame([(r[0],) for r in rows], "ds date").coalesce(1).select(forecast.holiday_flags(F.col("ds")).alias("h")).toPandas()["h"]])
    r = np.array([np.nan if v[2] is None else v[2] for v in rows])
    season_x = np.column_stack([*waves, flags, *[f(2 * np.pi * days / 30.5) for f in (np.sin, np.cos)], np.nan_to_num((r - np.nanmean(r)) / np.nanstd(r))])
    level = np.var(y / trend - 1)
    season_w = ridge(season_x, y / trend - 1, np.full(season_x.shape[1], level / 100))
    assert np.allclose(model.trend_w, trend_w, rtol=1e-5)
    assert np.allclose([*model.yearly_w, *model.weekly_w, *model.other_w], season_w, rtol=1e-5, atol=1e-8)
    assert math.isclose(model.sigma, np.std(y - trend * (1 + season_x @ season_w), ddof=1), rel_tol=1e-6) and model.n == len(y)


def test_full_fit_has_no_group_of_days(frame):
    plan = forecast.fit_full(frame, ["s"])._jdf.queryExecution().toString()
    assert "FlatMapGroups" not in plan and "Window" not in plan


def test_full_fit_of_zero_and_empty_series(spark):
    flat = spark.createDataFrame([("z", date(2024, 1, 1 + i), 0.0) for i in range(20)] + [("one", date(2024, 1, 1), 5.0), ("none", date(2024, 1, 1), None)], "s string, ds date, y double")
    model = {r.s: r for r in forecast.fit_full(flat, ["s"]).collect()}
    assert set(model) == {"z", "one"} and model["one"].sigma == 0.0
    assert all(abs(r.yhat) < 1e-6 for r in forecast.predict_full(forecast.fit_full(flat.where("s = 'z'"), ["s"]), ["s"]).collect())
    assert forecast.fit_full(flat.where("false")).count() == 0


def test_values_known_before(spark):
    day = lambda k: date(2024, 1, 1) + timedelta(days=k)
    frame = spark.createDataFrame([(s, day(k)) for s in ("a", None) for k in range(6)], "s string, ds date")
    values = spark.createDataFrame([("a", day(0), 1.0, None), ("a", day(2), None, 7.0), ("a", day(3), 3.0, 8.0), (None, day(1), 9.0, 9.0)], "s string, known date, v double, w double")
    days = forecast.known_before(frame, values, "known", ["v", "w"], ["s"], lag=2)
    got = {(r.s, (r.ds - day(0)).days): (r.v, r.w) for r in days.collect()}
    assert [got["a", k] for k in range(6)] == [(None, None), (None, None), (1.0, None), (1.0, None), (1.0, 7.0), (3.0, 8.0)]
    assert [got[None, k] for k in range(6)] == [(None, None)] * 3 + [(9.0, 9.0)] * 3
    forecast.require_known(days, ["v", "w"], 2)
    with pytest.raises(ValueError, match="was not known 3 days before"):
        forecast.require_known(days, ["v", "w"], 3)
    assert forecast.known_too_late(days, ["v"], 3).count() == 3
