"""Cleaning of the raw datasets: parse, default, deduplicate, derive."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.config import DEFAULT_DESCRIPTION, DEFAULT_PAYMENT_CYCLE, MONEY, VAT_RATE
from ledgerflow.functions.measures import literal_map
from ledgerflow.functions.parsing import lenient_date, number, number_or, strict_date, text_or


def first_per_key(df: DataFrame, keys: Sequence[str], order: str = "load_seq") -> DataFrame:
    """Keep the earliest row of each key.

    The filter on the row number becomes a group limit that runs before the shuffle too: each input
    partition sends on at most one row per key, so a key with very many copies never gathers in one
    task. Columns a later step does not use are still pruned at the scan.
    """
    earliest = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn("__nth", earliest).where(F.col("__nth") == 1).drop("__nth")


def days_to_pay(paid: Column, issued: Column) -> Column:
    return F.datediff(paid, issued)


def is_overdue(status: Column, due: Column, as_of: date) -> Column:
    return F.coalesce((status == "pending") & (due < F.lit(as_of)), F.lit(False))


def add_vat(df: DataFrame, amount: str = "amount", rate: str = VAT_RATE) -> DataFrame:
    """VAT and gross total of a net amount, both to the cent."""
    exact = F.col(amount).cast(MONEY) * F.lit(rate).cast("decimal(4,2)")
    return df.withColumns(
        {
            "vat": F.round(exact, 2).cast(MONEY),
            "total": F.round(F.col(amount).cast(MONEY) + exact, 2).cast(MONEY),
        }
    )


def due_dates(df: DataFrame, cycles: dict[str, int], group: str, issued: str = "invoice_date") -> DataFrame:
    """Due date = issue date + the payment cycle of the customer's group (default 30 days)."""
    cycle = F.coalesce(literal_map(cycles)[F.col(group)], F.lit(DEFAULT_PAYMENT_CYCLE))
    return df.withColumns({"payment_cycle": cycle, "due_date": F.date_add(F.col(issued), cycle)})


def monthly_typical_amount(df: DataFrame, yearly: str) -> DataFrame:
    return df.withColumn("typical_amount", F.col(yearly).cast("double") / 12)


def movement_flags(df: DataFrame) -> DataFrame:
    amount = F.col("amount")
    return df.withColumns(
        {
            "is_inflow": F.coalesce(amount > 0, F.lit(False)),
            "is_outflow": F.coalesce(amount < 0, F.lit(False)),
            "cash_flow": amount,
        }
    )


def deal_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_won": F.col("stage") == "won",
            "is_lost": F.col("stage") == "lost",
            "weighted_value": F.col("expected_amount").cast("double") * F.col("probability"),
        }
    )


def clean_invoices(raw: DataFrame, as_of: date, order: str = "load_seq") -> DataFrame:
    typed = raw.withColumns(
        {
            "invoice_date": strict_date("invoice_date"),
            "due_date": strict_date("due_date"),
            "paid_date": lenient_date("paid_date"),
            "status": text_or("status", "unknown"),
            "payment_method": text_or("payment_method", "transfer"),
            "amount": number_or("amount", 0),
            "vat": number_or("vat", 0),
            "total": number_or("total", 0),
        }
    )
    return first_per_key(typed, ["invoice_id"], order).withColumns(
        {
            "days_to_pay": days_to_pay(F.col("paid_date"), F.col("invoice_date")),
            "is_overdue": is_overdue(F.col("status"), F.col("due_date"), as_of),
        }
    )


def clean_bank_movements(raw: DataFrame, order: str = "load_seq") -> DataFrame:
    """Unsorted: sort with :func:`sorted_movements` at a sink, never in the middle of a plan."""
    typed = raw.withColumns(
        {
            "date": strict_date("date"),
            "value_date": lenient_date("value_date"),
            "amount": number("amount"),
            "balance_after": number("balance_after"),
            "description": text_or("description", DEFAULT_DESCRIPTION),
            "category": text_or("category", "other"),
        }
    )
    return movement_flags(first_per_key(typed, ["movement_id"], order))


def sorted_movements(df: DataFrame) -> DataFrame:
    return df.orderBy("date", "movement_id")


def clean_crm_deals(raw: DataFrame) -> DataFrame:
    typed = raw.withColumns(
        {
            "created_date": strict_date("created_date"),
            "expected_close": lenient_date("expected_close"),
            "actual_close": lenient_date("actual_close"),
            "closed_date": lenient_date("closed_date"),
            "expected_amount": number_or("expected_amount", 0),
            "probability": number_or("probability", 0, "double"),
            "stage": text_or("stage", "unknown"),
        }
    )
    return deal_flags(typed)


def clean_employees(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "salary": number_or("salary", 0),
            "ss_contribution": number_or("ss_contribution", 0),
            "start_date": lenient_date("start_date"),
            "department": text_or("department", "unknown"),
            "contract_type": text_or("contract_type", "permanent"),
        }
    )


def clean_suppliers(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "payment_cycle": number_or("payment_cycle", DEFAULT_PAYMENT_CYCLE, "double"),
            "typical_amount": number_or("typical_amount", 0),
            "category": text_or("category", "unknown"),
        }
    )


def clean_external_factors(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {
            "date": strict_date("date"),
            "value": number("value", "double"),
            "indicator": text_or("indicator", "unknown"),
            "source": text_or("source", "unknown"),
        }
    )


def clean_all(datasets: dict[str, DataFrame], as_of: date, order: str = "load_seq") -> dict[str, DataFrame]:
    """Clean whichever datasets are present; lazy."""
    steps: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
        "invoices": ("invoices_clean", lambda df: clean_invoices(df, as_of, order)),
        "bank_movements": ("bank_clean", lambda df: clean_bank_movements(df, order)),
        "crm_deals": ("crm_deals_clean", clean_crm_deals),
        "employees": ("employees_clean", clean_employees),
        "suppliers": ("suppliers_clean", clean_suppliers),
        "external_factors": ("external_factors_clean", clean_external_factors),
    }
    return {target: step(datasets[name]) for name, (target, step) in steps.items() if name in datasets}


def between_dates(df: DataFrame, column: str, start: date, end: date) -> DataFrame:
    """Inclusive at both ends; a plain comparison, so it reaches the scan."""
    return df.where(F.col(column).between(F.lit(start), F.lit(end)))
