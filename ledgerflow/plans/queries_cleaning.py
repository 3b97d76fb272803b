"""Projection, filter and cleaning queries."""

from datetime import date

from pyspark.sql import functions as F

from ledgerflow.config import VAT_RATE
from ledgerflow.functions.measures import stage_probability
from ledgerflow.functions.parsing import lenient_date, number, number_or, strict_date, text_or
from ledgerflow.functions.text import customer_slug, deal_number, invoice_number
from ledgerflow.operators import clean
from ledgerflow.plans.registry import query

AS_OF = date(1998, 6, 1)
INVOICE = (
    "invoice_id:s invoice_date:d due_date:d customer_id:s customer_name:s amount:m vat:m total:m status:s "
    "paid_date:d payment_method:s category:s days_to_pay:m is_overdue:b"
)
MOVEMENT = (
    "movement_id:s date:d value_date:d description:s amount:m balance_after:m category:s reference:s bank_account:s "
    "is_inflow:b is_outflow:b cash_flow:m"
)
DEAL = (
    "deal_id:s deal_name:s customer_id:s customer_name:s stage:s probability:f6 expected_amount:m created_date:d "
    "expected_close:d actual_close:d closed_date:d is_won:b is_lost:b weighted_value:f4"
)


@query("c01_strict_date", "invoice_id:s load_seq:i invoice_date:d", "SELECT invoice_id, load_seq, CAST(invoice_date AS DATE) AS invoice_date FROM fx_invoices_raw")
def _(fx):
    return fx.invoices_raw().select("invoice_id", "load_seq", strict_date("invoice_date").alias("invoice_date"))


@query("c02_lenient_date", "invoice_id:s load_seq:i paid_date:d", "SELECT invoice_id, load_seq, TRY_CAST(paid_date AS DATE) AS paid_date FROM fx_invoices_raw")
def _(fx):
    return fx.invoices_raw().select("invoice_id", "load_seq", lenient_date("paid_date").alias("paid_date"))


@query(
    "c03_number_or_default",
    "supplier_id:s payment_cycle:m typical_amount:m",
    "SELECT supplier_id, coalesce(TRY_CAST(payment_cycle AS DOUBLE), 30) AS payment_cycle, coalesce(TRY_CAST(typical_amount AS DECIMAL(18,2)), 0) AS typical_amount FROM fx_suppliers_raw",
)
def _(fx):
    return fx.suppliers_raw().select(
        "supplier_id",
        number_or("payment_cycle", 30, "double").alias("payment_cycle"),
        number_or("typical_amount", 0).alias("typical_amount"),
    )


@query("c04_number_or_null", "movement_id:s load_seq:i amount:m", "SELECT movement_id, load_seq, TRY_CAST(amount AS DECIMAL(18,2)) AS amount FROM fx_bank_raw")
def _(fx):
    return fx.bank_raw().select("movement_id", "load_seq", number("amount").alias("amount"))


@query(
    "c05_fill_text",
    "invoice_id:s load_seq:i status:s payment_method:s",
    "SELECT invoice_id, load_seq, coalesce(status, 'unknown') AS status, coalesce(payment_method, 'transfer') AS payment_method FROM fx_invoices_raw",
)
def _(fx):
    return fx.invoices_raw().select(
        "invoice_id", "load_seq", text_or("status", "unknown").alias("status"), text_or("payment_method", "transfer").alias("payment_method")
    )


@query(
    "c06_keep_first",
    "invoice_id:s load_seq:i total:s status:s",
    "SELECT invoice_id, load_seq, total, status FROM (SELECT *, row_number() OVER (PARTITION BY invoice_id ORDER BY load_seq) AS rn FROM fx_invoices_raw) t WHERE rn = 1",
)
def _(fx):
    return clean.first_per_key(fx.invoices_raw().select("invoice_id", "load_seq", "total", "status"), ["invoice_id"])


@query("c07_days_to_pay", "invoice_id:s days_to_pay:m", "SELECT invoice_id, days_to_pay FROM v_invoices")
def _(fx):
    return clean.clean_invoices(fx.invoices_raw(), AS_OF).select("invoice_id", "days_to_pay")


@query("c08_is_overdue", "invoice_id:s is_overdue:b", "SELECT invoice_id, is_overdue FROM v_invoices")
def _(fx):
    return clean.clean_invoices(fx.invoices_raw(), AS_OF).select("invoice_id", "is_overdue")


@query("c09_movement_flags", "movement_id:s is_inflow:b is_outflow:b cash_flow:m", "SELECT movement_id, amount > 0 AS is_inflow, amount < 0 AS is_outflow, amount AS cash_flow FROM fx_bank")
def _(fx):
    return clean.movement_flags(fx.bank())


@query("c10_deal_flags", "deal_id:s is_won:b is_lost:b weighted_value:f4", "SELECT deal_id, stage = 'won' AS is_won, stage = 'lost' AS is_lost, CAST(expected_amount AS DOUBLE) * probability AS weighted_value FROM fx_deals")
def _(fx):
    return clean.deal_flags(fx.deals())


@query("c11_sorted_movements", "movement_id:s date:d amount:m", "SELECT movement_id, date, amount FROM v_bank ORDER BY date, movement_id")
def _(fx):
    return clean.sorted_movements(clean.clean_bank_movements(fx.bank_raw()))


@query(
    "c12_select_rename",
    "ds:d account:s value:m",
    "SELECT date AS ds, bank_account AS account, amount AS value FROM fx_bank",
)
def _(fx):
    return fx.bank().withColumnsRenamed({"date": "ds", "bank_account": "account", "amount": "value"}).select("ds", "account", "value")


@query("c13_clean_invoices", INVOICE, "SELECT * FROM v_invoices")
def _(fx):
    return clean.clean_invoices(fx.invoices_raw(), AS_OF)


@query("c14_clean_bank_movements", MOVEMENT, "SELECT * FROM v_bank")
def _(fx):
    return clean.clean_bank_movements(fx.bank_raw())


@query("c15_clean_crm_deals", DEAL, "SELECT * FROM v_deals")
def _(fx):
    return clean.clean_crm_deals(fx.deals_raw())


@query(
    "c16_clean_employees",
    "employee_id:s name:s department:s contract_type:s salary:m ss_contribution:m start_date:d",
    """SELECT employee_id, name, coalesce(department, 'unknown') AS department, coalesce(contract_type, 'permanent') AS contract_type,
     coalesce(TRY_CAST(salary AS DECIMAL(18,2)), 0) AS salary, coalesce(TRY_CAST(ss_contribution AS DECIMAL(18,2)), 0) AS ss_contribution,
     TRY_CAST(start_date AS DATE) AS start_date FROM fx_employees_raw""",
)
def _(fx):
    return clean.clean_employees(fx.employees_raw())


@query(
    "c17_clean_suppliers",
    "supplier_id:s name:s category:s payment_cycle:m typical_amount:m",
    """SELECT supplier_id, name, coalesce(category, 'unknown') AS category, coalesce(TRY_CAST(payment_cycle AS DOUBLE), 30) AS payment_cycle,
     coalesce(TRY_CAST(typical_amount AS DECIMAL(18,2)), 0) AS typical_amount FROM fx_suppliers_raw""",
)
def _(fx):
    return clean.clean_suppliers(fx.suppliers_raw())


@query("c18_clean_external_factors", "date:d indicator:s value:f4 source:s", "SELECT date, indicator, value, source FROM fx_factors")
def _(fx):
    return clean.clean_external_factors(fx.factors())


@query(
    "c19_clean_all_counts",
    "dataset:s rows:i",
    """SELECT 'invoices_clean' AS dataset, count(*) AS rows FROM v_invoices UNION ALL SELECT 'bank_clean', count(*) FROM v_bank
     UNION ALL SELECT 'crm_deals_clean', count(*) FROM v_deals UNION ALL SELECT 'employees_clean', count(*) FROM customer
     UNION ALL SELECT 'suppliers_clean', count(*) FROM supplier UNION ALL SELECT 'external_factors_clean', count(*) FROM fx_factors""",
)
def _(fx):
    from ledgerflow.sources.quality import row_counts

    return row_counts(clean.clean_all(fx.raw(), AS_OF))


@query("c20_filter_paid_inflow", "movement_id:s amount:m category:s reference:s", "SELECT movement_id, amount, category, reference FROM fx_bank WHERE category = 'invoice_payment' AND amount > 0 AND reference IS NOT NULL")
def _(fx):
    return fx.bank().where((F.col("category") == "invoice_payment") & (F.col("amount") > 0) & F.col("reference").isNotNull())


@query("c21_date_range", "movement_id:s date:d amount:m", "SELECT movement_id, date, amount FROM fx_bank WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'")
def _(fx):
    return clean.between_dates(fx.bank(), "date", date(1996, 1, 1), date(1996, 12, 31))


@query("c22_customer_slug", "c_custkey:i slug:s", "SELECT c_custkey, upper(replace(substr('Seg ' || c_mktsegment || ' ' || c_name, 1, 8), ' ', '_')) AS slug FROM customer")
def _(fx):
    name = F.concat(F.lit("Seg "), "c_mktsegment", F.lit(" "), "c_name")
    return fx.table("customer").select("c_custkey", customer_slug(name).alias("slug"))


@query("c23_document_ids", "o_orderkey:i invoice_number:s deal_number:s", "SELECT o_orderkey, 'INV-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(6, length(CAST(o_orderkey AS VARCHAR))) AS INT), '0') AS invoice_number, 'DEAL-' || lpad(CAST(o_orderkey AS VARCHAR), CAST(greatest(5, length(CAST(o_orderkey AS VARCHAR))) AS INT), '0') AS deal_number FROM orders")
def _(fx):
    k = F.col("o_orderkey")
    return fx.table("orders").select(k, invoice_number(k).alias("invoice_number"), deal_number(k).alias("deal_number"))


@query(
    "c24_vat_and_total",
    "o_orderkey:i amount:m vat:m total:m",
    f"SELECT o_orderkey, amount, CAST(round(amount * CAST({VAT_RATE} AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS vat, CAST(round(amount + amount * CAST({VAT_RATE} AS DECIMAL(4,2)), 2) AS DECIMAL(18,2)) AS total FROM fx_invoices_base",
)
def _(fx):
    return clean.add_vat(fx.invoices_base().select("o_orderkey", "amount"))


@query(
    "c25_due_date",
    "o_orderkey:i payment_cycle:i due_date:d",
    "SELECT o_orderkey, cyc AS payment_cycle, d + cyc AS due_date FROM fx_invoices_base",
)
def _(fx):
    cycles = {"1": 15, "2": 30, "3": 45, "4": 60, "5": 90}
    grouped = fx.table("orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("invoice_date"), F.substring("o_orderpriority", 1, 1).alias("customer_group")
    )
    return clean.due_dates(grouped, cycles, "customer_group")


@query("c26_stage_probability", "deal_id:s stage:s probability:f2", "SELECT deal_id, stage, probability FROM fx_deals")
def _(fx):
    return fx.deals().select("deal_id", "stage", stage_probability(F.col("stage")).alias("probability"))


@query("c27_monthly_typical_amount", "s_suppkey:i typical_amount:f6", "SELECT s_suppkey, s_acctbal / 12 AS typical_amount FROM supplier")
def _(fx):
    return clean.monthly_typical_amount(fx.table("supplier"), "s_acctbal").select("s_suppkey", "typical_amount")
