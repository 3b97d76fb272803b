"""Thresholds and fixed values. Everything here is a plan literal, never a table."""

from __future__ import annotations

from dataclasses import dataclass

MONEY = "decimal(18,2)"
TOTAL = "decimal(28,2)"


@dataclass(frozen=True)
class Thresholds:
    """Alert and risk limits, in euros or as fractions."""

    min_balance: float = 50000.0
    min_variation_7d: float = -0.15
    max_deviation_forecast: float = 0.10
    projection_floor: float = 25000.0
    anomaly_multiplier: float = 3.0
    risk_high: float = 25000.0
    risk_medium: float = 50000.0
    spec_risk_high: float = 50000.0
    spec_risk_medium: float = 75000.0
    balance_tolerance: float = 200000.0
    drop_tolerance: float = 1000.0


@dataclass(frozen=True)
class ModelConfig:
    """Shape of the decomposable forecast."""

    growth: str = "linear"
    seasonality_mode: str = "multiplicative"
    yearly_order: int = 10
    weekly_order: int = 3
    monthly_order: int = 0
    changepoints: int = 25
    changepoint_range: float = 0.8
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    interval_level: float = 0.80
    horizon_days: int = 90


# ---- Fixed values: must equal the published data model -------------------------------

INITIAL_BALANCE = 450000
VAT_RATE = "0.21"
DEFAULT_PAYMENT_CYCLE = 30
DEFAULT_DESCRIPTION = "Sin descripcion"

SEASONAL_FACTOR = {
    1: 0.95, 2: 0.98, 3: 1.10, 4: 1.05, 5: 1.02, 6: 0.90,
    7: 0.70, 8: 0.65, 9: 1.00, 10: 1.15, 11: 1.20, 12: 1.10,
}

STAGE_PROBABILITY = {
    "prospecting": 0.10,
    "qualification": 0.25,
    "proposal": 0.50,
    "negotiation": 0.75,
    "won": 1.0,
    "lost": 0.0,
}

WEEKDAY_LABELS = ["Lun", "Mar", "Mié", "Jue", "Vie", "Sáb", "Dom"]

RISK_LABEL = {"BAJO": "Saludable", "MEDIO": "Monitoreo", "ALTO": "Crítico"}
RISK_SCORE = {"BAJO": 0, "MEDIO": 50, "ALTO": 100}

INDICATORS = ["interest_rate", "inflation", "sector_growth"]

# ---- End of fixed values ---------------------------------------------------------------
