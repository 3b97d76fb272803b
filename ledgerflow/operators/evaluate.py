"""Forecast error metrics. ``pairs`` frames hold ``y`` (real) and ``yhat`` (forecast)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.config import ModelConfig
from ledgerflow.functions.keyed import attach_stats, join_series
from ledgerflow.operators.forecast import apply_base, apply_full, fit_base, fit_full, naive_forecast
from ledgerflow.sources.shared import store


def _error() -> Column:
    return F.col("y") - F.col("yhat")


def mae() -> Column:
    return F.avg(F.abs(_error()))


def rmse() -> Column:
    return F.sqrt(F.avg(_error() * _error()))


def mape() -> Column:
    """Over the rows with a non-zero real value; 0 when there are none."""
    ratio = F.abs(F.try_divide(_error(), F.col("y")))
    return F.coalesce(F.avg(ratio) * 100, F.lit(0.0))


def smape() -> Column:
    half = (F.abs("y") + F.abs("yhat")) / 2
    return F.coalesce(F.avg(F.try_divide(F.abs(_error()), half)) * 100, F.lit(0.0))


def coverage() -> Column:
    inside = (F.col("y") >= F.col("yhat_lower")) & (F.col("y") <= F.col("yhat_upper"))
    return F.avg(inside.cast("double")) * 100


def bias() -> Column:
    return F.avg(_error())


def pair_up(test: DataFrame, forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Real and forecast values of the days present in both."""
    return join_series(
        test.select(*keys, "ds", "y"), forecast.select(*keys, "ds", "yhat", "yhat_lower", "yhat_upper"), keys, plain=["ds"]
    )


def evaluate(pairs: DataFrame, keys: Sequence[str] = (), interval_level: float = 0.80) -> DataFrame:
    """All metrics in one aggregate; no row for an empty input."""
    return (
        pairs.groupBy(*keys)
        .agg(
            F.round(mae(), 2).alias("mae"),
            F.round(rmse(), 2).alias("rmse"),
            F.round(mape(), 2).alias("mape"),
            F.round(smape(), 2).alias("smape"),
            F.round(coverage(), 2).alias("coverage"),
            F.count("*").alias("n_evaluations"),
        )
        .where(F.col("n_evaluations") > 0)
        .withColumn("interval_level", F.lit(interval_level))
    )


def naive_metrics(
    test: DataFrame, keys: Sequence[str] = (), naive: str = "previous", train: DataFrame | None = None
) -> DataFrame:
    """``previous``: one step ahead over the whole test set. ``last_train_value``: constant."""
    if naive == "previous":
        pairs = naive_forecast(test, keys).withColumn("yhat", F.col("y_naive"))
    elif naive == "last_train_value":
        last = train.groupBy(*keys).agg(F.max_by("y", "ds").alias("yhat"))
        pairs = attach_stats(test, last, keys)
    else:
        raise ValueError(f"unknown naive forecast: {naive}")
    return (
        pairs.groupBy(*keys)
        .agg(
            F.round(mae(), 2).alias("naive_mae"),
            F.round(rmse(), 2).alias("naive_rmse"),
            F.round(mape(), 2).alias("naive_mape"),
            F.count("*").alias("__n"),
        )
        .where(F.col("__n") > 0)
        .drop("__n")
    )


def evaluation_report(
    test: DataFrame,
    forecast: DataFrame,
    keys: Sequence[str] = (),
    naive: str = "previous",
    train: DataFrame | None = None,
) -> DataFrame:
    """Model and naive metrics, and the improvement computed from the rounded figures."""
    if naive == "last_train_value":
        test = join_series(test, forecast.select(*keys, "ds"), keys, "left_semi", ["ds"])
    model = evaluate(pair_up(test, forecast, keys), keys)
    both = attach_stats(model, naive_metrics(test, keys, naive, train), keys)

    def gain(of: str) -> Column:
        return F.round(F.try_divide(F.col(f"naive_{of}") - F.col(of), F.col(f"naive_{of}")) * 100, 2)

    return both.withColumns({"mae_improvement": gain("mae"), "mape_improvement": gain("mape")})


def forecast_vs_real(forecast: DataFrame, daily: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every forecast day with a real balance, per series."""
    real = daily.select(*keys, F.col("date").alias("ds"), F.col("cash_balance").cast("double").alias("y"))
    joined = join_series(forecast, real, keys, "left", ["ds"]).where(F.col("y").isNotNull())
    error = _error()
    return joined.withColumns(
        {
            "error": error,
            "abs_error": F.abs(error),
            "pct_error": F.abs(F.try_divide(error, F.col("y"))) * 100,
        }
    )


def error_summary(shown: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return shown.groupBy(*keys).agg(
        F.round(mae(), 2).alias("mae"),
        F.round(rmse(), 2).alias("rmse"),
        F.round(F.avg("pct_error"), 2).alias("mape"),
        F.round(bias(), 2).alias("bias"),
    )


def error_histogram(shown: DataFrame, keys: Sequence[str] = (), bins: int = 30) -> DataFrame:
    """Equal-width bins from the smallest to the largest error; the largest falls in the last bin."""
    ends = shown.groupBy(*keys).agg(F.min("error").alias("__lo"), F.max("error").alias("__hi"))
    width = (F.col("__hi") - F.col("__lo")) / bins
    place = F.floor(F.try_divide(F.col("error") - F.col("__lo"), width)) + 1
    return (
        attach_stats(shown, ends, keys)
        .withColumn("bin", F.least(F.coalesce(place, F.lit(1)), F.lit(bins)))
        .groupBy(*keys, "bin")
        .agg(
            F.count("*").alias("frequency"),
            F.min(F.col("__lo") + (F.col("bin") - 1) * width).alias("bin_start"),
        )
    )


def axis_range(shown: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return shown.groupBy(*keys).agg(
        F.least(F.min("y"), F.min("yhat")).alias("min_val"), F.greatest(F.max("y"), F.max("yhat")).alias("max_val")
    )


def deviation_by_day(
    forecast: DataFrame, daily: DataFrame, last_days: int = 30, keys: Sequence[str] = ()
) -> DataFrame:
    """Signed deviation in percent of the forecast, for the last days of the real series."""
    shown = forecast_vs_real(forecast, daily, keys)
    last = daily.groupBy(*keys).agg(F.max("date").alias("__last"))
    recent = attach_stats(shown, last, keys).where(F.col("ds") >= F.date_sub("__last", last_days))
    return recent.select(
        *keys, "ds", "y", "yhat", (F.try_divide(_error(), F.abs("yhat")) * 100).alias("deviation_pct")
    )


def metrics_by_month(pairs: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return (
        pairs.groupBy(*keys, F.date_format("ds", "yyyy-MM").alias("month"))
        .agg(
            F.round(mae(), 2).alias("mae"),
            F.round(rmse(), 2).alias("rmse"),
            F.round(mape(), 2).alias("mape"),
            F.round(smape(), 2).alias("smape"),
            F.count("*").alias("n"),
        )
    )




def cross_validate(
    folds: DataFrame, keys: Sequence[str] = (), model: str = "base", config: ModelConfig = ModelConfig(), regressors: Sequence[str] = ()
) -> DataFrame:
    """Fit the base or the full model on each fold's training rows and score its test rows, all folds in one job.

    A fold is one more series key. The full model's folds are expanded once and stored; the Gram matrices of all folds come
    from one aggregate each, because the trend's columns are scaled to the fold's own span.
    """
    scope = [*keys, "fold"]
    if model == "base":
        test = folds.where("NOT is_train").select(*scope, "ds", "y")
        return evaluate(apply_base(attach_stats(test, fit_base(folds.where("is_train"), scope), scope), scope, keep=["y"]), scope)
    if model != "full":
        raise ValueError(f"unknown model: {model}")
    held = store(folds, "folds")
    fitted = store(fit_full(held.where("is_train"), scope, config, regressors), "fold_models")
    test = held.where("NOT is_train").select(*scope, "ds", "y", *regressors)
    return evaluate(apply_full(attach_stats(test, fitted, scope), scope, config, regressors, keep=["y"]), scope)
