"""Declared columns of the raw datasets and the types of the produced tables."""

from __future__ import annotations

# ---- Fixed values: column names of the data model ---------------------------------------

REQUIRED = {
    "invoices": ["invoice_id", "invoice_date", "customer_name", "amount", "vat", "total", "status", "payment_method"],
    "bank_movements": ["movement_id", "date", "description", "amount", "balance_after", "category", "bank_account"],
    "crm_deals": ["deal_id", "deal_name", "customer_name", "stage", "probability", "expected_amount", "created_date"],
    "employees": ["employee_id", "name", "department", "salary"],
    "suppliers": ["supplier_id", "name", "category", "payment_cycle"],
    "external_factors": ["date", "indicator", "value", "source"],
}

OPTIONAL = {
    "invoices": ["paid_date", "due_date", "customer_id", "category"],
    "bank_movements": ["value_date", "reference"],
    "crm_deals": ["expected_close", "actual_close", "closed_date", "customer_id"],
    "employees": ["contract_type", "ss_contribution", "start_date"],
    "suppliers": ["typical_amount"],
    "external_factors": [],
}

PRIMARY_KEY = {
    "invoices": ["invoice_id"],
    "bank_movements": ["movement_id"],
    "crm_deals": ["deal_id"],
    "cash_flow_daily": ["date"],
    "forecast_results": ["ds"],
}

TABLES = {
    "invoices": (
        "invoice_id string, invoice_date date, due_date date, customer_id string, customer_name string, "
        "amount decimal(18,2), vat decimal(18,2), total decimal(18,2), status string, paid_date date, "
        "payment_method string, category string"
    ),
    "bank_movements": (
        "movement_id string, date date, value_date date, description string, amount decimal(18,2), "
        "balance_after decimal(18,2), category string, reference string, bank_account string"
    ),
    "crm_deals": (
        "deal_id string, deal_name string, customer_id string, customer_name string, stage string, "
        "probability double, expected_amount decimal(18,2), expected_close date, actual_close date, "
        "created_date date, closed_date date"
    ),
    "cash_flow_daily": (
        "date date, cash_balance double, cash_inflow double, cash_outflow double, net_cash double, "
        "transaction_count bigint"
    ),
    "forecast_results": (
        "ds date, yhat double, yhat_lower double, yhat_upper double, trend double, yearly double, weekly double"
    ),
    "model_metrics": "metric_name string, metric_value double, created_at timestamp",
    "alerts": "alert_code string, severity string, message string, triggered_at timestamp, resolved int",
}

# ---- End of fixed values -----------------------------------------------------------------


def raw_schema(name: str) -> str:
    """All-string read schema of a raw dataset, in declared order."""
    return ", ".join(f"{column} string" for column in REQUIRED[name] + OPTIONAL[name])
