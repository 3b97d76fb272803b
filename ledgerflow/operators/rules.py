"""Coherence and integrity rules across invoices, bank ledger and deals.

The rules as coded each return one row ``rule, description, coherence_pct, status, metrics``; the
strict forms return the offending rows, so that they can be listed, counted or joined further.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.config import Thresholds
from ledgerflow.functions.dates import month_label
from ledgerflow.functions.keyed import attach_stats, by_series, join_series
from ledgerflow.functions.measures import share
from ledgerflow.operators.ordered import previous_values
from ledgerflow.operators.series import date_bounds, payroll_calendar

# Rule texts as shown in reports.
DESCRIPTIONS = {
    "R1": "Factura pagada -> Movimiento banco",
    "R2": "Deal ganado -> Factura futura",
    "R3": "Saldo banco coherente",
    "R4": "Nomina mensual -> movement salary",
    "R5": "IVA trimestral -> movement tax",
    "R6": "Proveedor pagado según ciclo",
}


def _result(rule: str, status: Column, metrics: dict[str, Column], pct: Column | None = None) -> Column:
    pairs = [part for name, c in metrics.items() for part in (F.lit(name), c.cast("double"))]
    return F.struct(
        F.lit(rule).alias("rule"),
        F.lit(DESCRIPTIONS[rule]).alias("description"),
        (F.round(pct, 2) if pct is not None else F.lit(None).cast("double")).alias("coherence_pct"),
        status.alias("status"),
        F.create_map(*pairs).alias("metrics"),
    )


def _rows(figures: DataFrame, *results: Column, keys: Sequence[str] = ()) -> DataFrame:
    """One row per rule result (and series) from one row of figures (per series)."""
    return figures.select(*keys, F.inline(F.array(*results)))


def _grade(pct: Column, above: float, otherwise: str) -> Column:
    return F.when(pct > above, "PASS").otherwise(otherwise)


# ---- rules as coded -----------------------------------------------------------------------------


def r1_invoices_to_bank(invoices: DataFrame, bank: DataFrame) -> DataFrame:
    """Bank inflow as a share of paid invoices, over the days that have both."""
    paid = (
        invoices.where(F.col("status") == "paid")
        .groupBy(F.col("paid_date").alias("day"))
        .agg(F.sum("total").alias("invoiced"), F.count("*").alias("paid"))
    )
    inflow = bank.where(F.col("amount") > 0).groupBy(F.col("date").alias("bank_day")).agg(F.sum("amount").alias("received"))
    days = paid.join(inflow, F.col("day") == F.col("bank_day"), "full_outer")
    both = F.col("invoiced").isNotNull() & F.col("received").isNotNull()
    figures = days.agg(
        F.coalesce(F.sum("paid"), F.lit(0)).alias("total_paid_invoices"),
        F.coalesce(F.sum(F.when(F.col("day").isNotNull(), F.col("invoiced"))), F.lit(0)).alias("invoice_total_amount"),
        F.coalesce(F.sum("received"), F.lit(0)).alias("bank_inflow_total"),
        F.count_if(both).alias("matched_dates"),
        F.sum(F.when(both, F.col("invoiced"))).alias("__invoiced"),
        F.sum(F.when(both, F.col("received"))).alias("__received"),
    )
    ratio = F.least(share(F.col("__received"), F.col("__invoiced")) * 100, F.lit(100.0))
    pct = F.when(F.col("__invoiced") > 0, ratio).otherwise(0.0)
    names = ["total_paid_invoices", "invoice_total_amount", "bank_inflow_total", "matched_dates"]
    return _rows(figures, _result("R1", _grade(pct, 90, "FAIL"), {n: F.col(n) for n in names}, pct))


def r2_deals_to_invoices(deals: DataFrame, invoices: DataFrame) -> DataFrame:
    """Invoices per closed won deal, times ten, capped at 100."""
    won = deals.where((F.col("stage") == "won") & F.col("actual_close").isNotNull()).agg(F.count("*").alias("total_won_deals"))
    both = attach_stats(won, invoices.agg(F.count("*").alias("total_invoices")), [])
    ratio = F.col("total_invoices").cast("double") / F.greatest(F.col("total_won_deals"), F.lit(1))
    pct = F.least(ratio * 10, F.lit(100.0))
    names = ["total_won_deals", "total_invoices"]
    return _rows(both, _result("R2", _grade(pct, 70, "WARNING"), {n: F.col(n) for n in names}, pct))


def bank_figures(bank: DataFrame, limits: Thresholds = Thresholds(), keys: Sequence[str] = (), falls: bool = True) -> DataFrame:
    """Everything the ledger-only rules need, per series; the period sets are bounded by the calendar.

    The drop check looks at each row and the one before, over the whole ledger, on narrow columns in blocks of days. The ledger is
    read three times: pass a stored table.
    """
    order = F.struct("date", "movement_id")

    def periods(category: str, unit: str) -> Column:
        return F.size(F.collect_set(F.when(F.col("category") == category, F.trunc("date", unit))))

    figures = bank.groupBy(*keys).agg(
        F.min_by("balance_after", order).alias("initial_balance"),
        F.max_by("balance_after", order).alias("final_balance_actual"),
        F.sum("amount").alias("moved"),
        F.count_if(F.col("category") == "salary").alias("salary_movements"),
        periods("salary", "month").alias("months_with_salary"),
        F.count_if(F.col("category") == "tax").alias("tax_movements"),
        periods("tax", "quarter").alias("quarters_with_tax"),
        F.count_if(F.col("category") == "supplier").alias("supplier_movements"),
        F.datediff(F.max("date"), F.min("date")).alias("span_days"),
    )
    if not falls:
        return figures
    narrow = bank.select(*keys, "date", "movement_id", "balance_after")
    steps = previous_values(narrow, keys, ["date", "movement_id"], ["balance_after"], ["date"])
    fall = F.col("prev_balance_after") - F.col("balance_after")
    steady = steps.groupBy(*keys).agg((F.count_if(fall > limits.drop_tolerance) == 0).cast("int").alias("balance_monotonic"))
    return attach_stats(figures, steady, keys)


def _balance(limits: Thresholds = Thresholds()) -> Column:
    expected = F.col("initial_balance") + F.col("moved")
    gap = F.abs(expected - F.col("final_balance_actual"))
    metrics = {
        "initial_balance": F.col("initial_balance"),
        "final_balance_actual": F.col("final_balance_actual"),
        "final_balance_expected": expected,
        "difference": gap,
        "balance_monotonic": F.col("balance_monotonic"),
    }
    return _result("R3", F.when(gap < limits.balance_tolerance, "PASS").otherwise("FAIL"), metrics)


def _periodic(rule: str, counted: str, periods: str, days: int, above: float) -> Column:
    expected = F.floor(F.col("span_days") / days)
    ratio = F.least(share(F.col(periods), expected) * 100, F.lit(100.0))
    pct = F.coalesce(F.when((F.col(counted) > 0) & (expected > 0), ratio), F.lit(0.0))
    return _result(rule, _grade(pct, above, "WARNING"), {n: F.col(n) for n in (counted, periods)}, pct)


def _payroll() -> Column:
    return _periodic("R4", "salary_movements", "months_with_salary", 30, 80)


def _tax() -> Column:
    return _periodic("R5", "tax_movements", "quarters_with_tax", 90, 70)


def _suppliers() -> Column:
    return _result("R6", F.lit("PASS"), {"supplier_movements": F.col("supplier_movements")})


def r3_balance(bank: DataFrame, limits: Thresholds = Thresholds(), keys: Sequence[str] = ()) -> DataFrame:
    """First balance plus all movements against the last balance, and whether any row falls by more than the tolerance."""
    return _rows(bank_figures(bank, limits, keys), _balance(limits), keys=keys)


def r4_payroll(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _rows(bank_figures(bank, keys=keys, falls=False), _payroll(), keys=keys)


def r5_tax(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _rows(bank_figures(bank, keys=keys, falls=False), _tax(), keys=keys)


def r6_suppliers(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return _rows(bank_figures(bank, keys=keys, falls=False), _suppliers(), keys=keys)


def all_rules(datasets: dict[str, DataFrame], keys: Sequence[str] = ()) -> DataFrame:
    """Every rule whose inputs are present, as one table; R3 to R6 per series, R1 and R2 for the company (null keys)."""
    invoices, bank, deals = (datasets.get(n) for n in ("invoices_clean", "bank_clean", "crm_deals_clean"))
    results = []
    if invoices is not None and bank is not None:
        results.append(r1_invoices_to_bank(invoices, bank))
    if deals is not None and invoices is not None:
        results.append(r2_deals_to_invoices(deals, invoices))
    if bank is not None:
        ledger_rules = [_balance(), _payroll(), _tax()] + ([_suppliers()] if invoices is not None else [])
        results.append(_rows(bank_figures(bank, keys=keys), *ledger_rules, keys=keys))
    if not results:
        raise ValueError("no dataset that any rule applies to")
    table = results[0]
    for result in results[1:]:
        table = table.unionByName(result, allowMissingColumns=True)
    return table.select(*[k for k in keys if k in table.columns], *[c for c in table.columns if c not in keys])


def rules_summary(results: DataFrame) -> DataFrame:
    status = F.col("status")
    return results.agg(
        F.count("*").alias("total_rules"),
        F.count_if(status == "PASS").alias("passed"),
        F.count_if(status == "WARNING").alias("warnings"),
        F.count_if(status == "FAIL").alias("failed"),
        F.when(F.count_if(status == "FAIL") == 0, "PASS").otherwise("FAIL").alias("overall_status"),
    )


def report_lines(results: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The validation report, one text line per row, ordered by (section, line); a section is a rule (and a series)."""
    rule_lines = F.flatten(
        F.array(
            F.array(F.concat_ws(": ", "rule", "description"), F.concat(F.lit("  Status: "), "status")),
            F.when(F.col("coherence_pct").isNotNull(), F.array(F.format_string("  Coherencia: %.1f%%", "coherence_pct"))).otherwise(F.array()),
            F.transform(
                F.array_sort(F.map_entries("metrics")),
                lambda m: F.concat(F.lit("  "), m["key"], F.lit(": "), m["value"].cast("decimal(28,2)").cast("string")),
            ),
        )
    )
    body = results.select(F.concat_ws(" ", "rule", *[F.col(k).cast("string") for k in keys]).alias("section"), F.posexplode(rule_lines).alias("line", "text"))
    ends = rules_summary(results).select(
        F.lit("~").alias("section"),
        F.posexplode(
            F.array(
                F.concat(F.lit("RESULTADO: "), "overall_status"),
                *[F.concat(F.lit(f"  {label}: "), F.col(c).cast("string")) for label, c in (("Passed", "passed"), ("Warnings", "warnings"), ("Failed", "failed"))],
            )
        ).alias("line", "text"),
    )
    return body.unionByName(ends)


# ---- strict forms: offending rows -----------------------------------------------------------------


def invoice_links(invoices: DataFrame, bank: DataFrame) -> DataFrame:
    """Each paid invoice: is there a movement with its id, and one with its total on its paid date?

    Movements are reduced to distinct links before the joins, so both joins are one-to-one.
    """
    paid = invoices.where(F.col("status") == "paid").select("invoice_id", "customer_id", "total", "paid_date")
    moves = bank.where(F.col("reference").isNotNull())
    linked = moves.select(F.col("reference").alias("invoice_id")).distinct().withColumn("__linked", F.lit(True))
    exact = (
        moves.select(F.col("reference").alias("invoice_id"), F.col("amount").alias("total"), F.col("date").alias("paid_date"))
        .distinct()
        .withColumn("__exact", F.lit(True))
    )
    no = F.lit(False)
    return (
        paid.join(linked, "invoice_id", "left")
        .join(exact, ["invoice_id", "total", "paid_date"], "left")
        .select(
            "invoice_id",
            "customer_id",
            "total",
            "paid_date",
            F.coalesce("__linked", no).alias("has_movement"),
            F.coalesce("__exact", no).alias("same_amount_and_date"),
        )
    )


def paid_without_movement(invoices: DataFrame, bank: DataFrame) -> DataFrame:
    """Anti-join form of the same rule, for the list of offenders only."""
    references = bank.where(F.col("reference").isNotNull()).select(F.col("reference").alias("invoice_id")).distinct()
    return invoices.where(F.col("status") == "paid").join(references, "invoice_id", "left_anti").select("invoice_id", "customer_id", "total", "paid_date")


def won_deal_followups(deals: DataFrame, invoices: DataFrame, after: int = 30, until: int = 90) -> DataFrame:
    """Won deals with ``has_invoice``: an invoice of the same customer ``after..until`` days later.

    Both sides shrink to distinct (customer, day) marks and a RANGE frame looks ahead, so no pair of
    a deal and an invoice is ever formed; a customer has at most two marks per calendar day.
    """
    won = deals.where((F.col("stage") == "won") & F.col("actual_close").isNotNull())
    marks = (
        won.select("customer_id", F.col("actual_close").alias("day"), F.lit(0).alias("invoiced"))
        .unionByName(invoices.select("customer_id", F.col("invoice_date").alias("day"), F.lit(1).alias("invoiced")))
        .groupBy("customer_id", "day")
        .agg(F.max("invoiced").alias("invoiced"), F.min("invoiced").alias("__deal"))
    )
    ahead = Window.partitionBy("customer_id").orderBy(F.unix_date("day")).rangeBetween(after, until)
    answered = (
        marks.withColumn("has_invoice", F.coalesce(F.max("invoiced").over(ahead), F.lit(0)) == 1)
        .where(F.col("__deal") == 0)
        .select("customer_id", F.col("day").alias("actual_close"), "has_invoice")
    )
    return join_series(won, answered, ["customer_id"], "left", ["actual_close"]).select(
        "deal_id", "customer_id", "actual_close", "has_invoice"
    )


def balance_breaks(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Movements whose balance is not the previous balance plus their amount. The ledger is read twice: pass a stored table."""
    rows = bank.select(*keys, "date", "movement_id", "amount", "balance_after")
    seen = previous_values(rows, keys, ["date", "movement_id"], ["balance_after", "movement_id"], ["date"])
    step = F.col("balance_after") - F.col("prev_balance_after")
    return seen.where(F.col("prev_movement_id").isNotNull() & ~step.eqNullSafe(F.col("amount")))


def months_without_payroll(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Months whose first weekday has no salary movement."""
    expected = payroll_calendar(date_bounds(bank, "date", keys), keys)
    paid = bank.where(F.col("category") == "salary").select(*keys, F.col("date").alias("payroll_date")).distinct()
    return join_series(expected, paid, keys, "left_anti", ["payroll_date"])


def quarters_without_tax(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    bounds = date_bounds(bank, "date", keys).where(F.col("first_day").isNotNull())
    quarters = bounds.select(
        *keys,
        F.explode(F.sequence(F.trunc("first_day", "quarter"), F.col("last_day"), F.expr("INTERVAL 3 MONTH"))).alias("quarter_start"),
    )
    paid = bank.where(F.col("category") == "tax").select(*keys, F.trunc("date", "quarter").alias("quarter_start")).distinct()
    return join_series(quarters, paid, keys, "left_anti", ["quarter_start"])


def payments_after_due(bank: DataFrame, invoices: DataFrame) -> DataFrame:
    moves = bank.where(F.col("reference").isNotNull()).select("movement_id", "date", F.col("reference").alias("invoice_id"))
    return moves.join(invoices.select("invoice_id", "due_date"), "invoice_id").where(F.col("date") > F.col("due_date"))


def date_violations(df: DataFrame, column: str, start: date, end: date, as_of: date) -> DataFrame:
    day = F.col(column)
    return df.agg(
        F.count_if(day < F.lit(start)).alias("before_range"),
        F.count_if(day > F.lit(end)).alias("after_range"),
        F.count_if(day > F.lit(as_of)).alias("in_future"),
    )


def backward_steps(bank: DataFrame, order: str = "load_seq") -> DataFrame:
    """Rows dated before the row loaded just before them."""
    seen = previous_values(bank.select(order, "movement_id", "date"), [], [order], ["date"])
    return seen.where(F.col("date") < F.col("prev_date"))


def due_before_issue(invoices: DataFrame) -> DataFrame:
    return invoices.where(F.col("due_date") <= F.col("invoice_date")).select("invoice_id", "invoice_date", "due_date")


def paid_without_date(invoices: DataFrame) -> DataFrame:
    return invoices.where((F.col("status") == "paid") & F.col("paid_date").isNull())


def collectable(invoices: DataFrame) -> DataFrame:
    """Paid invoices with a date: the input of collection analyses."""
    return invoices.where((F.col("status") == "paid") & F.col("paid_date").isNotNull())


def open_deals_with_close(deals: DataFrame) -> DataFrame:
    return deals.where(~F.col("stage").isin("won", "lost") & F.col("actual_close").isNotNull())


def null_rule_counts(invoices: DataFrame, deals: DataFrame) -> DataFrame:
    counts = {
        "N1": paid_without_date(invoices),
        "N1_kept": collectable(invoices),
        "N3": open_deals_with_close(deals),
    }
    parts = [df.agg(F.count("*").alias("violations")).select(F.lit(rule).alias("rule"), "violations") for rule, df in counts.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def negative_balances(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return bank.where(F.col("balance_after") < 0).select(*keys, "movement_id", "date", "balance_after")


def opening_balances(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Balance before the first movement of each account, and whether it is positive."""
    order = F.struct("date", "movement_id")
    first = bank.groupBy(*keys).agg(F.min_by(F.col("balance_after") - F.col("amount"), order).alias("opening_balance"))
    return first.withColumn("is_positive", F.col("opening_balance") > 0)


def large_daily_changes(daily: DataFrame, keys: Sequence[str] = (), factor: float = 2.0) -> DataFrame:
    """Days whose balance change is at least ``factor`` times the mean absolute change."""
    change = F.col("cash_balance").cast("double") - F.lag(F.col("cash_balance").cast("double")).over(by_series(keys, "date"))
    moved = daily.select(*keys, "date", change.alias("change"))
    mean = moved.groupBy(*keys).agg(F.avg(F.abs("change")).alias("mean_abs_change"))
    return attach_stats(moved, mean, keys).where(F.abs("change") >= factor * F.col("mean_abs_change"))


def period_totals(invoices: DataFrame, bank: DataFrame) -> DataFrame:
    """Income from paid invoices and expense from negative movements, by month."""
    income = collectable(invoices).groupBy(month_label(F.col("paid_date")).alias("month")).agg(F.sum("total").alias("income"))
    expense = bank.where(F.col("amount") < 0).groupBy(month_label(F.col("date")).alias("month")).agg((-F.sum("amount")).alias("expense"))
    return income.join(expense, "month", "full_outer").select(
        "month", F.coalesce("income", F.lit(0)).alias("income"), F.coalesce("expense", F.lit(0)).alias("expense")
    )


def period_balance_check(bank: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """closing = opening + income - expense, month by month."""
    order = F.struct("date", "movement_id")
    amount = F.col("amount")
    none = F.lit(0)
    months = bank.groupBy(*keys, month_label(F.col("date")).alias("month")).agg(
        F.min_by(F.col("balance_after") - amount, order).alias("__before"),
        F.max_by("balance_after", order).alias("closing"),
        F.coalesce(F.sum(F.when(amount > 0, amount)), none).alias("income"),
        F.coalesce(F.sum(F.when(amount < 0, -amount)), none).alias("expense"),
    )
    opening = F.coalesce(F.lag("closing").over(by_series(keys, "month")), F.col("__before"))
    return (
        months.withColumn("opening", opening)
        .withColumn("holds", F.col("closing") == F.col("opening") + F.col("income") - F.col("expense"))
        .select(*keys, "month", "opening", "income", "expense", "closing", "holds")
    )


def ebitda(bank: DataFrame, keys: Sequence[str] = (), excluded: Sequence[str] = ("investment",)) -> DataFrame:
    """Income less operating expense by month; investment is left out."""
    amount = F.col("amount")
    none = F.lit(0)
    months = bank.where(~F.col("category").isin(list(excluded))).groupBy(*keys, month_label(F.col("date")).alias("month")).agg(
        F.coalesce(F.sum(F.when(amount > 0, amount)), none).alias("income"),
        F.coalesce(F.sum(F.when(amount < 0, -amount)), none).alias("operating_expense"),
    )
    return months.withColumn("ebitda", F.col("income") - F.col("operating_expense"))


def mixed_payment_methods(invoices: DataFrame) -> DataFrame:
    """Customers that pay in more than one way."""
    return (
        invoices.groupBy("customer_id")
        .agg(F.count_distinct("payment_method").alias("methods"))
        .where(F.col("methods") > 1)
    )
