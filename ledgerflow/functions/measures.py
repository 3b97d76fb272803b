"""Ratios, grades and labels."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, functions as F

from ledgerflow.config import RISK_LABEL, RISK_SCORE, STAGE_PROBABILITY, Thresholds


def as_double(value: Column) -> Column:
    return value.cast("double")


def literal_map(values: dict) -> Column:
    """A small fixed lookup kept inside the expression, so that no join is needed."""
    return F.create_map(*[F.lit(item) for pair in values.items() for item in pair])


def risk_band(value: Column, high: float, medium: float) -> Column:
    return F.when(value < high, "ALTO").when(value < medium, "MEDIO").otherwise("BAJO")


def code_risk_band(value: Column, limits: Thresholds = Thresholds()) -> Column:
    return risk_band(value, limits.risk_high, limits.risk_medium)


def spec_risk_band(value: Column, limits: Thresholds = Thresholds()) -> Column:
    return risk_band(value, limits.spec_risk_high, limits.spec_risk_medium)


def risk_score(band: Column) -> Column:
    return literal_map(RISK_SCORE)[band]


def risk_label(band: Column) -> Column:
    return F.coalesce(literal_map(RISK_LABEL)[band], band)


def stage_probability(stage: Column) -> Column:
    return F.coalesce(literal_map(STAGE_PROBABILITY)[stage], F.lit(0.0))


def mape_grade(mape: Column) -> Column:
    return F.when(mape < 5, "Excelente").when(mape < 10, "Aceptable").otherwise("Revisar")


def normal_quantile(level: float) -> float:
    """Half-width, in standard deviations, of a central interval of this level."""
    return NormalDist().inv_cdf((1.0 + level) / 2.0)


def exact_mean(value: Column, scale: int = 12) -> Column:
    """Mean through a decimal sum, so that the result does not depend on partitioning."""
    exact = F.sum(value.cast(f"decimal(30,{scale})"))
    return F.try_divide(exact.cast("double"), F.count(value).cast("double"))


def share(part: Column, whole: Column) -> Column:
    return F.try_divide(part.cast("double"), whole.cast("double"))
