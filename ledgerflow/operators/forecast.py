"""Decomposable daily forecast: trend times (1 + weekly + yearly) per series.

Two fits share one output contract (``ds, yhat, yhat_lower, yhat_upper, trend, yearly, weekly``):

* the base model, pure column expressions: straight trend, weekday and month effects;
* the full model: piecewise trend, Fourier seasons, holidays and regressors. Spark builds the design columns, sums
  their Gram matrices and applies the coefficients; Python only solves one system of fixed size per series.

Both fit on the day grain. A fitted model is a table with one row per series.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.config import ModelConfig, Thresholds
from ledgerflow.functions.dates import easter_sunday
from ledgerflow.functions.keyed import attach_stats, by_series, join_series
from ledgerflow.functions.measures import code_risk_band, normal_quantile
from ledgerflow.operators.regression import gram, ridge, solved
from ledgerflow.sources.shared import store

FORECAST_COLUMNS = ["ds", "yhat", "yhat_lower", "yhat_upper", "trend", "yearly", "weekly"]
EXACT = "decimal(30,6)"


# ---- base model -----------------------------------------------------------------------------


def with_trend(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``t`` (days since the series start), ``slope``, ``intercept`` and ``trend``.

    Least squares from exact decimal sums, so that the line does not depend on partitioning.
    """
    whole = Window.partitionBy(*keys)
    timed = history.withColumn("origin", F.min("ds").over(whole)).withColumn("t", F.datediff("ds", "origin"))
    y = F.col("y").cast(EXACT)
    t = F.col("t").cast("bigint")

    def total(c: Column) -> Column:
        return F.sum(c).over(whole).cast("double")

    sums = timed.withColumns(
        {
            "__n": F.count("y").over(whole).cast("double"),
            "__t": total(t),
            "__tt": total(t * t),
            "__y": total(y),
            "__ty": total((y * t.cast("decimal(8,0)")).cast("decimal(38,6)")),
        }
    )
    n, st, stt, sy, sty = (F.col(c) for c in ("__n", "__t", "__tt", "__y", "__ty"))
    slope = F.coalesce(F.try_divide(n * sty - st * sy, n * stt - st * st), F.lit(0.0))
    return (
        sums.withColumn("slope", slope)
        .withColumn("intercept", (sy - F.col("slope") * st) / n)
        .withColumn("trend", F.col("intercept") + F.col("slope") * F.col("t"))
        .drop("__n", "__t", "__tt", "__y", "__ty")
    )


def with_seasons(trended: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add ``weekly`` and ``yearly``: mean relative deviation by weekday, then by month."""

    def mean_over(c: Column, *group: str) -> Column:
        window = Window.partitionBy(*keys, *group)
        exact = F.sum(c.cast("decimal(30,12)")).over(window).cast("double")
        return F.try_divide(exact, F.count(c).over(window).cast("double"))

    zero = F.lit(0.0)
    return (
        trended.withColumns(
            {"weekday": F.weekday("ds"), "month": F.month("ds"), "ratio": F.try_divide(F.col("y"), F.col("trend"))}
        )
        .withColumn("weekly", F.coalesce(mean_over(F.col("ratio") - 1, "weekday"), zero))
        .withColumn("yearly", F.coalesce(mean_over(F.col("ratio") - 1 - F.col("weekly"), "month"), zero))
    )


def _yhat() -> Column:
    return F.col("trend") * (1 + F.col("weekly") + F.col("yearly"))


def trend_model(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    lines = with_trend(history, keys)
    return lines.groupBy(*keys).agg(
        F.first("origin").alias("origin"),
        F.max("ds").alias("last_day"),
        F.count("y").alias("n"),
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
    )


def seasonal_index(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Weekday and month effects as a long table."""
    seasons = with_seasons(with_trend(history, keys), keys)
    weekly = seasons.groupBy(*keys, F.col("weekday").alias("position")).agg(F.first("weekly").alias("effect"))
    yearly = seasons.groupBy(*keys, F.col("month").alias("position")).agg(F.first("yearly").alias("effect"))
    return weekly.withColumn("season", F.lit("weekly")).unionByName(yearly.withColumn("season", F.lit("yearly")))


def fit_base(history: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """One row per series: line, weekday map, month map, residual spread.

    The windows and this aggregate share the partitioning by series: one shuffle in all.
    """
    seasons = with_seasons(with_trend(history, keys), keys)
    return seasons.groupBy(*keys).agg(
        F.first("origin").alias("origin"),
        F.max("ds").alias("last_day"),
        F.count("y").alias("n"),
        F.first("slope").alias("slope"),
        F.first("intercept").alias("intercept"),
        F.map_from_entries(F.collect_set(F.struct("weekday", "weekly"))).alias("weekly_effect"),
        F.map_from_entries(F.collect_set(F.struct("month", "yearly"))).alias("yearly_effect"),
        F.coalesce(F.stddev_samp(F.col("y") - _yhat()), F.lit(0.0)).alias("sigma"),
    )


def _with_band(df: DataFrame, level: float) -> DataFrame:
    half = F.lit(normal_quantile(level)) * F.col("sigma")
    return df.withColumns({"yhat_lower": F.col("yhat") - half, "yhat_upper": F.col("yhat") + half})


def forecast_days(model: DataFrame, horizon: int, include_history: bool = True) -> DataFrame:
    """Expand each model row to its days; no join with the history is needed."""
    start = F.col("origin") if include_history else F.date_add("last_day", 1)
    return model.withColumn("ds", F.explode(F.sequence(start, F.date_add("last_day", horizon))))


def apply_base(days: DataFrame, keys: Sequence[str] = (), interval_level: float = 0.80, keep: Sequence[str] = ()) -> DataFrame:
    """Forecast columns for days that carry the model columns."""
    parts = days.withColumns(
        {
            "trend": F.col("intercept") + F.col("slope") * F.datediff("ds", "origin"),
            "weekly": F.coalesce(F.col("weekly_effect")[F.weekday("ds")], F.lit(0.0)),
            "yearly": F.coalesce(F.col("yearly_effect")[F.month("ds")], F.lit(0.0)),
        }
    )
    return _with_band(parts.withColumn("yhat", _yhat()), interval_level).select(*keys, *keep, *FORECAST_COLUMNS)


def predict_base(
    model: DataFrame,
    keys: Sequence[str] = (),
    horizon: int = 90,
    include_history: bool = True,
    interval_level: float = 0.80,
) -> DataFrame:
    return apply_base(forecast_days(model, horizon, include_history), keys, interval_level)


def future_frame(history: DataFrame, keys: Sequence[str] = (), horizon: int = 90) -> DataFrame:
    """The history days of each series and the next ``horizon`` days."""
    ends = history.groupBy(*keys).agg(F.max("ds").alias("last_day")).where(F.col("last_day").isNotNull())
    ahead = ends.select(
        *keys, F.explode(F.sequence(F.date_add("last_day", 1), F.date_add("last_day", horizon))).alias("ds")
    )
    return history.select(*keys, "ds").unionByName(ahead)


def known_before(
    frame: DataFrame, values: DataFrame, known: str, columns: Sequence[str], keys: Sequence[str] = (), lag: int = 0
) -> DataFrame:
    """As-of join: for each day of ``frame`` the last non-null value of each column whose day ``known`` lies ``lag`` days before it or more.

    ``<column>_known`` is that value's day, for :func:`require_known`. Both sides are day-grain, so a window over a series'
    days and values together does it; no pair of days is built.
    """
    carried = [F.struct(F.col(known).alias("day"), F.col(c).cast("double").alias("value")).alias(c) for c in columns]
    asked = frame.withColumns({"__at": F.date_sub("ds", lag), "__asks": F.lit(1)})
    offered = values.select(*keys, F.col(known).alias("__at"), F.lit(0).alias("__asks"), *[F.when(F.col(c).isNotNull(), s).alias(f"__v_{c}") for c, s in zip(columns, carried, strict=True)])
    both = asked.unionByName(offered, allowMissingColumns=True)
    so_far = by_series(keys, "__at", "__asks").rowsBetween(Window.unboundedPreceding, 0)
    filled = both.withColumns({f"__l_{c}": F.last(f"__v_{c}", ignorenulls=True).over(so_far) for c in columns}).where("__asks = 1")
    return filled.select(
        *frame.columns, *[F.col(f"__l_{c}.value").alias(c) for c in columns], *[F.col(f"__l_{c}.day").alias(f"{c}_known") for c in columns]
    )


def known_too_late(days: DataFrame, columns: Sequence[str], lag: int) -> DataFrame:
    """Days with a value that became known later than ``lag`` days before them."""
    late = [F.col(f"{c}_known") > F.date_sub("ds", lag) for c in columns]
    return days.where(reduce(lambda a, b: a | b, [F.coalesce(x, F.lit(False)) for x in late]))


def require_known(days: DataFrame, columns: Sequence[str], lag: int) -> None:
    """Raise if a regressor would use a value that a forecast ``lag`` days ahead cannot have."""
    first = known_too_late(days, columns, lag).select("ds").head()
    if first is not None:
        raise ValueError(f"a regressor of {first.ds} was not known {lag} days before")


def save_model(model: DataFrame, path: str) -> None:
    model.write.mode("overwrite").parquet(path)


def load_model(spark, path: str) -> DataFrame:
    return spark.read.parquet(path)


# ---- holidays --------------------------------------------------------------------------------

# Spanish national holidays by month and day, and by days from Easter Sunday.
FIXED_HOLIDAYS = {
    "new_year": (1, 1),
    "epiphany": (1, 6),
    "labour_day": (5, 1),
    "assumption": (8, 15),
    "national_day": (10, 12),
    "all_saints": (11, 1),
    "constitution_day": (12, 6),
    "immaculate_conception": (12, 8),
    "christmas": (12, 25),
}
MOVING_HOLIDAYS = {"good_friday": -2}
HOLIDAYS = [*FIXED_HOLIDAYS, *MOVING_HOLIDAYS]


def holiday_calendar(bounds: DataFrame) -> DataFrame:
    """Holidays of every year touched by ``first_day .. last_day``."""
    years = (
        bounds.where(F.col("first_day").isNotNull())
        .select(F.explode(F.sequence(F.year("first_day"), F.year("last_day"))).alias("year"))
        .distinct()
    )
    easter = easter_sunday(F.col("year"))
    entries = [
        F.struct(F.lit(name).alias("holiday"), F.make_date(F.col("year"), F.lit(m), F.lit(d)).alias("date"))
        for name, (m, d) in FIXED_HOLIDAYS.items()
    ] + [
        F.struct(F.lit(name).alias("holiday"), F.date_add(easter, shift).alias("date"))
        for name, shift in MOVING_HOLIDAYS.items()
    ]
    return years.select(F.explode(F.array(*entries)).alias("h")).select("h.holiday", "h.date")


def holiday_flags(ds: Column) -> Column:
    """0/1 per holiday, in the order of ``HOLIDAYS``, computed from the day itself."""
    fixed = [(F.month(ds) == m) & (F.day(ds) == d) for m, d in FIXED_HOLIDAYS.values()]
    moving = [ds == F.date_add(easter_sunday(F.year(ds)), shift) for shift in MOVING_HOLIDAYS.values()]
    return F.array(*[hit.cast("double") for hit in [*fixed, *moving]])


# ---- full model ------------------------------------------------------------------------------


def _fourier(day_number: str, period: float, order: int) -> str:
    angles = [f"{day_number} * {2.0 * np.pi / period * k!r}D" for k in range(1, order + 1)]
    return f"cast(array({', '.join(f'{f}({a})' for a in angles for f in ('sin', 'cos'))}) as array<double>)"


def design(days: DataFrame, config: ModelConfig, regressors: Sequence[str] = ()) -> DataFrame:
    """Add ``trend_x``, ``yearly_x``, ``weekly_x`` and ``other_x`` for days with ``origin, train_span``."""
    tau = "(datediff(ds, origin) / cast(greatest(train_span, 1) as double))"
    steps = [config.changepoint_range * (i + 1) / (config.changepoints + 1) for i in range(config.changepoints)]
    bends = [f"greatest({tau} - {s!r}D, 0D)" for s in steps]
    number = "cast(datediff(ds, date'1970-01-01') as double)"
    return days.withColumns(
        {
            "trend_x": F.expr(f"array({', '.join(['1D', tau, *bends])})"),
            "yearly_x": F.expr(_fourier(number, 365.25, config.yearly_order)),
            "weekly_x": F.expr(_fourier(number, 7.0, config.weekly_order)),
            "other_x": F.concat(holiday_flags(F.col("ds")), F.expr(_fourier(number, 30.5, config.monthly_order))),
            "given_x": F.array(*[F.col(r).cast("double") for r in regressors]).cast("array<double>"),
        }
    )


def fit_full(
    history: DataFrame,
    keys: Sequence[str] = (),
    config: ModelConfig = ModelConfig(),
    regressors: Sequence[str] = (),
) -> DataFrame:
    """Piecewise trend, then seasons, holidays and regressors on the relative deviation.

    Regressors are standardised here, and their means and spreads kept with the coefficients, so the penalty does not
    depend on their unit; a history day without a value counts as the mean. Days without ``y`` are left out.

    Three passes over the stored day-grain history, each a hash aggregate: bounds, then the Gram matrix of the trend's columns,
    then that of the seasons' (:mod:`ledgerflow.operators.regression`); the residual spread is a fourth. Python solves one system
    of fixed size per series and sees no day, so a series may hold any share of the days.
    """
    keys = list(keys)
    days = store(history.where(F.col("y").isNotNull()).select(*keys, "ds", F.col("y").cast("double").alias("y"), *regressors), "history")
    given = [F.col(r).cast("double") for r in regressors]
    bounds = days.groupBy(*keys).agg(
        F.min("ds").alias("origin"),
        F.max("ds").alias("last_day"),
        F.count("y").alias("n"),
        F.max(F.abs("y")).alias("__scale"),
        F.array(*[F.coalesce(F.avg(g), F.lit(0.0)) for g in given]).cast("array<double>").alias("given_mean"),
        F.array(*[F.coalesce(F.when(F.stddev_pop(g) > 1e-12, F.stddev_pop(g)), F.lit(1.0)) for g in given]).cast("array<double>").alias("given_spread"),
    ).where("n > 0").withColumns({"train_span": F.datediff("last_day", "origin"), "__scale": F.greatest("__scale", F.lit(1e-12))})
    rows = design(attach_stats(days, bounds, keys), config, regressors)
    bends = 2 + config.changepoints
    bend_prior, season_prior, holiday_prior = config.changepoint_prior_scale, config.seasonality_prior_scale, config.holidays_prior_scale

    def trend(row: dict) -> dict:
        total = np.array(row["gram"]).reshape(bends + 1, bends + 1)
        line = ridge(total[:2, :2], total[:2, -1], np.zeros(2))
        v = np.r_[-line, np.zeros(bends - 2), 1.0]
        noise = max(0.0, v @ total @ v / row["n"] - (total[0] @ v / row["n"]) ** 2)
        penalty = np.full(bends, noise / bend_prior**2)
        penalty[:2] = 0.0
        return {"trend_w": ridge(total[:-1, :-1], total[:-1, -1], penalty) * row["__scale"], "trend_penalty": float(noise / bend_prior**2)}

    trend_rows = rows.withColumn("__z", F.concat("trend_x", F.array(F.col("y") / F.col("__scale"))))
    trends = solved(attach_stats(bounds, gram(trend_rows, keys, "__z", bends + 1), keys), trend, "gram", "trend_w array<double>, trend_penalty double")
    fitted = store(trends, "trend_model")

    wide = 2 * config.yearly_order, 2 * config.weekly_order, len(HOLIDAYS) + 2 * config.monthly_order + len(regressors)
    size = sum(wide)

    def seasons(row: dict) -> dict:
        if row["gram"] is None:  # every day's trend is zero
            w, level = np.zeros(size), 0.0
        else:
            total = np.array(row["gram"]).reshape(size + 2, size + 2)
            n = total[size, size]
            level = max(0.0, total[size + 1, size + 1] / n - (total[size + 1, size] / n) ** 2)
            penalty = np.full(size, level / season_prior**2)
            penalty[wide[0] + wide[1] :] = level / holiday_prior**2
            w = ridge(total[:size, :size], total[:size, size + 1], penalty)
        parts = np.split(w, np.cumsum(wide[:2]))
        return {"yearly_w": parts[0], "weekly_w": parts[1], "other_w": parts[2], "season_spread": float(level)}

    placed = attach_stats(rows.drop(*[c for c in bounds.columns if c not in keys]), fitted, keys).withColumn("__trend", _dot("trend_x", "trend_w"))
    standard = F.zip_with(F.zip_with("given_x", "given_mean", lambda x, m: F.coalesce(x - m, F.lit(0.0))), "given_spread", lambda x, s: x / s)
    season_rows = placed.withColumn("__x", F.concat("yearly_x", "weekly_x", "other_x", standard) if regressors else F.concat("yearly_x", "weekly_x", "other_x"))
    relative = F.try_divide(F.col("y"), F.col("__trend")) - 1
    usable = season_rows.where(F.abs("__trend") > 1e-9 * F.col("__scale")).withColumn("__z", F.concat("__x", F.array(F.lit(1.0), relative)))
    weights = solved(
        attach_stats(fitted, gram(usable, keys, "__z", size + 2), keys), seasons, "gram", "yearly_w array<double>, weekly_w array<double>, other_w array<double>, season_spread double"
    )
    model = store(weights, "full_model")
    errors = attach_stats(season_rows.select(*keys, "y", "__trend", "__x"), model.select(*keys, F.concat("yearly_w", "weekly_w", "other_w").alias("__w")), keys)
    residual = F.col("y") - F.col("__trend") * (1 + _dot("__x", "__w"))
    spread = errors.groupBy(*keys).agg(F.coalesce(F.stddev_samp(residual), F.lit(0.0)).alias("sigma"))
    return attach_stats(model, spread, keys).select(
        *keys, "origin", "last_day", "train_span", "n", "sigma", "trend_w", "yearly_w", "weekly_w", "other_w", "given_mean", "given_spread", "trend_penalty", "season_spread"
    )


def _dot(x: str, w: str) -> Column:
    products = F.zip_with(x, w, lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def predict_full(
    model: DataFrame,
    keys: Sequence[str] = (),
    config: ModelConfig = ModelConfig(),
    horizon: int | None = None,
    regressors: Sequence[str] = (),
    regressor_days: DataFrame | None = None,
) -> DataFrame:
    """Apply the coefficients on the JVM side; regressors come from ``regressor_days`` by (series, ds).

    A day after the history needs a value of each regressor: without one the computation fails rather than
    forecast with a made-up figure.
    """
    days = forecast_days(model, config.horizon_days if horizon is None else horizon)
    if regressors:
        days = join_series(days, regressor_days.select(*keys, "ds", *regressors), keys, "left", ["ds"])
    return apply_full(days, keys, config, regressors)


def apply_full(
    days: DataFrame, keys: Sequence[str] = (), config: ModelConfig = ModelConfig(), regressors: Sequence[str] = (), keep: Sequence[str] = ()
) -> DataFrame:
    """Forecast columns for days that carry the model columns and the regressors."""
    built = design(days, config, regressors)
    if regressors:
        absent = F.concat(F.lit("no regressor value for "), F.col("ds").cast("string"))
        value = F.zip_with(
            F.zip_with("given_x", "given_mean", lambda x, m: F.coalesce(x, F.when(F.col("ds") > F.col("last_day"), F.raise_error(absent).cast("double")), m) - m),
            "given_spread",
            lambda x, s: x / s,
        )
        built = built.withColumn("other_x", F.concat("other_x", value))
    parts = built.withColumns(
        {
            "trend": _dot("trend_x", "trend_w"),
            "yearly": _dot("yearly_x", "yearly_w"),
            "weekly": _dot("weekly_x", "weekly_w"),
            "other": _dot("other_x", "other_w"),
        }
    )
    yhat = F.col("trend") * (1 + F.col("yearly") + F.col("weekly") + F.col("other"))
    return _with_band(parts.withColumn("yhat", yhat), config.interval_level).select(*keys, *keep, *FORECAST_COLUMNS)


# ---- reading a forecast -----------------------------------------------------------------------


def forecast_tail(forecast: DataFrame, keys: Sequence[str] = (), days: int = 90) -> DataFrame:
    """The last ``days`` calendar days of each forecast."""
    last = forecast.groupBy(*keys).agg(F.max("ds").alias("__last"))
    return attach_stats(forecast, last, keys).where(F.col("ds") >= F.date_sub("__last", days - 1)).drop("__last")


def risk_indicators(
    forecast: DataFrame,
    keys: Sequence[str] = (),
    scope: str = "all",
    origin: date | DataFrame | None = None,
    limits: Thresholds = Thresholds(),
) -> DataFrame:
    """Minimum, mean, change over the last 30 rows, band, days below the medium limit.

    ``origin``, for ``scope="future"``: the last history day, or a frame of (series, today).
    """
    if scope == "future":
        if origin is None:
            raise ValueError("scope='future' needs the last history day")
        if isinstance(origin, DataFrame):
            forecast = attach_stats(forecast, origin, keys).where(F.col("ds") > F.col("today")).drop("today")
        else:
            forecast = forecast.where(F.col("ds") > F.lit(origin))
    from_end = F.row_number().over(by_series(keys, F.col("ds").desc()))
    y = F.col("yhat")
    figures = forecast.withColumn("__back", from_end).groupBy(*keys).agg(
        F.min(y).alias("__min"),
        F.avg(y).alias("__avg"),
        F.max_by(y, "ds").alias("__last"),
        F.min_by(y, F.when(F.col("__back") <= 30, F.col("ds"))).alias("__first"),
        F.count_if(y < limits.risk_medium).alias("days_below_threshold"),
    )
    return figures.where(F.col("__min").isNotNull()).select(
        *keys,
        F.round("__min", 2).alias("min_forecast_balance"),
        F.round("__avg", 2).alias("avg_forecast_balance"),
        F.round(F.col("__last") - F.col("__first"), 2).alias("trend_30d"),
        code_risk_band(F.col("__min"), limits).alias("risk_level"),
        "days_below_threshold",
    )


def forecast_summary(forecast: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return forecast.groupBy(*keys).agg(
        F.min("ds").alias("start"),
        F.max("ds").alias("end"),
        F.count("*").alias("days"),
        F.round(F.min("yhat"), 2).alias("min_balance"),
        F.round(F.max("yhat"), 2).alias("max_balance"),
        F.round(F.avg("yhat"), 2).alias("mean_balance"),
        F.round(F.stddev_samp("yhat"), 2).alias("std_balance"),
    )


def forecast_at(
    forecast: DataFrame,
    keys: Sequence[str] = (),
    method: str = "nearest",
    as_of: date | DataFrame | None = None,
    days: int = 90,
    ordinal: int = 89,
) -> DataFrame:
    """Forecast value at the horizon, as ``forecast_90d``.

    ``nearest``: day closest to ``as_of + days``, earlier day on ties; ``as_of`` is a date or a
    frame of (series, today). ``last``: final day. ``ordinal``: row at this 0-based position.
    """
    if method == "last":
        return forecast.groupBy(*keys).agg(F.max_by("yhat", "ds").alias("forecast_90d"))
    if method == "ordinal":
        position = F.row_number().over(by_series(keys, "ds"))
        return (
            forecast.withColumn("__row", position).where(F.col("__row") == ordinal + 1).select(*keys, F.col("yhat").alias("forecast_90d"))
        )
    if method != "nearest":
        raise ValueError(f"unknown method: {method}")
    dated = (
        attach_stats(forecast, as_of, keys) if isinstance(as_of, DataFrame) else forecast.withColumn("today", F.lit(as_of))
    )
    distance = F.abs(F.datediff("ds", F.date_add("today", days)))
    return dated.groupBy(*keys).agg(F.min_by("yhat", F.struct(distance, "ds")).alias("forecast_90d"))


# ---- naive and cross-validation ----------------------------------------------------------------


def naive_forecast(test: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Previous value of the series; its first row has none and is left out."""
    return test.withColumn("y_naive", F.lag("y").over(by_series(keys, "ds"))).where(F.col("y_naive").isNotNull())


def rolling_folds(series: DataFrame, keys: Sequence[str] = (), folds: int = 5) -> DataFrame:
    """Expanding-window folds as a column: fold ``i`` trains on all rows before its test block."""
    size = F.count("*").over(Window.partitionBy(*keys))
    position = F.row_number().over(by_series(keys, "ds"))
    block = F.floor(F.col("__size") / (folds + 1))
    start = F.col("__size") - (folds + 1 - F.col("fold")) * block
    return (
        series.withColumns({"__size": size, "__row": position})
        .withColumn("fold", F.explode(F.sequence(F.lit(1), F.lit(folds))))
        .withColumns({"__start": start, "__end": start + block})
        .where(F.col("__row") <= F.col("__end"))
        .withColumn("is_train", F.col("__row") <= F.col("__start"))
        .drop("__size", "__row", "__start", "__end")
    )
