"""Coherence and integrity rule queries."""

from datetime import date

from pyspark.sql import functions as F

from ledgerflow.operators import clean, rules, series
from ledgerflow.plans.queries_cleaning import AS_OF
from ledgerflow.plans.queries_series import BOUNDS, MONTHS, PAYROLL
from ledgerflow.plans.registry import query
from ledgerflow.sources.shared import store

ACCOUNT = ["bank_account"]


def invoices(fx):
    return clean.clean_invoices(fx.invoices_raw(), AS_OF)


def bank(fx):
    return clean.clean_bank_movements(fx.bank_raw())


def deals(fx):
    return clean.clean_crm_deals(fx.deals_raw())


def clean_ledger(fx):
    """What the rules use of the clean movements; stored, as cleaning shuffles and the rules read them several times."""
    return store(bank(fx).select("movement_id", "date", "amount", "balance_after", "category"), "bank_clean")


def datasets(fx):
    """What the rules use of the clean tables; stored where cleaning shuffles, as several rules read it."""
    return {
        "invoices_clean": store(invoices(fx).select("status", "paid_date", "total"), "invoices_clean"),
        "bank_clean": clean_ledger(fx),
        "crm_deals_clean": deals(fx),
    }


def flat(result, *metrics):
    return result.select("rule", "description", "coherence_pct", "status", *[F.col("metrics")[m].alias(m) for m in metrics])


def flat_by_account(result, *metrics):
    return result.select("bank_account", "rule", "description", "coherence_pct", "status", *[F.col("metrics")[m].alias(m) for m in metrics])


HEAD = "rule:s description:s coherence_pct:f2 status:s "


def rule_sql(rule: str, pct: str, status: str, metrics: str, source: str) -> str:
    return f"SELECT '{rule}' AS rule, '{rules.DESCRIPTIONS[rule]}' AS description, {pct} AS coherence_pct, {status} AS status, {metrics} FROM ({source}) x"


R1_SOURCE = """SELECT total_paid_invoices, invoice_total_amount, bank_inflow_total, matched_dates, CASE WHEN mi > 0 THEN least(CAST(mb AS DOUBLE) / CAST(mi AS DOUBLE) * 100, 100) ELSE 0 END AS pct FROM (
 SELECT (SELECT count(*) FROM v_invoices WHERE status = 'paid') AS total_paid_invoices, (SELECT sum(total) FROM v_invoices WHERE status = 'paid' AND paid_date IS NOT NULL) AS invoice_total_amount,
  (SELECT sum(amount) FROM v_bank WHERE amount > 0) AS bank_inflow_total, count(*) AS matched_dates, sum(i.t) AS mi, sum(b.a) AS mb
 FROM (SELECT paid_date, sum(total) AS t FROM v_invoices WHERE status = 'paid' GROUP BY 1) i JOIN (SELECT date, sum(amount) AS a FROM v_bank WHERE amount > 0 GROUP BY 1) b ON i.paid_date = b.date) y"""
R1 = rule_sql("R1", "pct", "CASE WHEN pct > 90 THEN 'PASS' ELSE 'FAIL' END", "total_paid_invoices, invoice_total_amount, bank_inflow_total, matched_dates", R1_SOURCE)
R2 = rule_sql(
    "R2",
    "pct",
    "CASE WHEN pct > 70 THEN 'PASS' ELSE 'WARNING' END",
    "total_won_deals, total_invoices",
    """SELECT w AS total_won_deals, i AS total_invoices, least(CAST(i AS DOUBLE) / greatest(w, 1) * 10, 100) AS pct FROM
     (SELECT (SELECT count(*) FROM v_deals WHERE stage = 'won' AND actual_close IS NOT NULL) AS w, (SELECT count(*) FROM v_invoices) AS i) y""",
)
R3 = rule_sql(
    "R3",
    "CAST(NULL AS DOUBLE)",
    "CASE WHEN abs(b0 + s - b1) < 200000 THEN 'PASS' ELSE 'FAIL' END",
    "b0 AS initial_balance, b1 AS final_balance_actual, b0 + s AS final_balance_expected, abs(b0 + s - b1) AS difference, mono AS balance_monotonic",
    """SELECT min_by(balance_after, row(date, movement_id)) AS b0, max_by(balance_after, row(date, movement_id)) AS b1, sum(amount) AS s,
     (SELECT CAST(count(*) FILTER (WHERE p - balance_after > 1000) = 0 AS INT) FROM (SELECT balance_after, lag(balance_after) OVER (ORDER BY date, movement_id) AS p FROM
       v_bank h) q) AS mono FROM v_bank""",
)
R1_MULTI = R1.replace("v_bank", "fx_bank_multi")
R3_BY_ACCOUNT = """SELECT f.bank_account, 'R3' AS rule, CASE WHEN abs(b0 + s - b1) < 200000 THEN 'PASS' ELSE 'FAIL' END AS status,
 b0 AS initial_balance, b1 AS final_balance_actual, b0 + s AS final_balance_expected, mono AS balance_monotonic
 FROM (SELECT bank_account, min_by(balance_after, row(date, movement_id)) AS b0, max_by(balance_after, row(date, movement_id)) AS b1, sum(amount) AS s FROM fx_bank_multi GROUP BY bank_account) f
 JOIN (SELECT bank_account, CAST(count(*) FILTER (WHERE p - balance_after > 1000) = 0 AS INT) AS mono FROM
  (SELECT bank_account, balance_after, lag(balance_after) OVER (PARTITION BY bank_account ORDER BY date, movement_id) AS p FROM fx_bank_multi) q GROUP BY bank_account) m ON f.bank_account = m.bank_account"""


def _periodic(rule: str, category: str, unit: str, days: int, above: int, counted: str, periods: str) -> str:
    return rule_sql(
        rule,
        "pct",
        f"CASE WHEN pct > {above} THEN 'PASS' ELSE 'WARNING' END",
        f"{counted}, {periods}",
        f"""SELECT {counted}, {periods}, CASE WHEN {counted} > 0 THEN coalesce(least(CAST({periods} AS DOUBLE) / nullif(span, 0) * 100, 100), 0) ELSE 0 END AS pct FROM
         (SELECT count(*) FILTER (WHERE category = '{category}') AS {counted}, count(DISTINCT CASE WHEN category = '{category}' THEN date_trunc('{unit}', date) END) AS {periods},
           date_diff('day', min(date), max(date)) // {days} AS span FROM v_bank) y""",
    )


R4 = _periodic("R4", "salary", "month", 30, 80, "salary_movements", "months_with_salary")
R5 = _periodic("R5", "tax", "quarter", 90, 70, "tax_movements", "quarters_with_tax")
R6 = rule_sql("R6", "CAST(NULL AS DOUBLE)", "'PASS'", "supplier_movements", "SELECT count(*) AS supplier_movements FROM v_bank WHERE category = 'supplier'")


def _by_account(rule: str, pct: str, status: str, metrics: str, source: str) -> str:
    return f"SELECT bank_account, '{rule}' AS rule, '{rules.DESCRIPTIONS[rule]}' AS description, {pct} AS coherence_pct, {status} AS status, {metrics} FROM ({source}) x"


def _periodic_by_account(rule: str, category: str, unit: str, days: int, above: int, counted: str, periods: str) -> str:
    return _by_account(
        rule,
        "pct",
        f"CASE WHEN pct > {above} THEN 'PASS' ELSE 'WARNING' END",
        f"{counted}, {periods}",
        f"""SELECT bank_account, {counted}, {periods}, CASE WHEN {counted} > 0 THEN coalesce(least(CAST({periods} AS DOUBLE) / nullif(span, 0) * 100, 100), 0) ELSE 0 END AS pct FROM
         (SELECT bank_account, count(*) FILTER (WHERE category = '{category}') AS {counted}, count(DISTINCT CASE WHEN category = '{category}' THEN date_trunc('{unit}', date) END) AS {periods},
           date_diff('day', min(date), max(date)) // {days} AS span FROM fx_bank_multi GROUP BY bank_account) y""",
    )


R4_BY_ACCOUNT = _periodic_by_account("R4", "salary", "month", 30, 80, "salary_movements", "months_with_salary")
R5_BY_ACCOUNT = _periodic_by_account("R5", "tax", "quarter", 90, 70, "tax_movements", "quarters_with_tax")
R6_BY_ACCOUNT = _by_account(
    "R6", "CAST(NULL AS DOUBLE)", "'PASS'", "supplier_movements", "SELECT bank_account, count(*) FILTER (WHERE category = 'supplier') AS supplier_movements FROM fx_bank_multi GROUP BY bank_account"
)
ALL_RULES = " UNION ALL ".join(f"SELECT rule, description, coherence_pct, status FROM ({r}) r" for r in (R1, R2, R3, R4, R5, R6))


@query("v01_r1_invoices_to_bank", HEAD + "total_paid_invoices:i invoice_total_amount:m bank_inflow_total:m matched_dates:i", R1)
def _(fx):
    return flat(rules.r1_invoices_to_bank(invoices(fx), bank(fx)), "total_paid_invoices", "invoice_total_amount", "bank_inflow_total", "matched_dates")


@query("v02_r2_deals_to_invoices", HEAD + "total_won_deals:i total_invoices:i", R2)
def _(fx):
    return flat(rules.r2_deals_to_invoices(deals(fx), invoices(fx)), "total_won_deals", "total_invoices")


@query("v03_r3_balance", HEAD + "initial_balance:m final_balance_actual:m final_balance_expected:m difference:m balance_monotonic:i", R3)
def _(fx):
    names = ["initial_balance", "final_balance_actual", "final_balance_expected", "difference", "balance_monotonic"]
    return flat(rules.r3_balance(clean_ledger(fx)), *names)


@query("v03_r3_balance_by_account", "bank_account:s rule:s status:s initial_balance:m final_balance_actual:m final_balance_expected:m balance_monotonic:i", R3_BY_ACCOUNT)
def _(fx):
    names = ["initial_balance", "final_balance_actual", "final_balance_expected", "balance_monotonic"]
    found = rules.r3_balance(fx.bank_multi(), keys=["bank_account"])
    return found.select("bank_account", "rule", "status", *[F.col("metrics")[n].alias(n) for n in names])


@query(
    "v07_all_rules_by_account",
    "bank_account:s rule:s status:s",
    f"""SELECT bank_account, rule, status FROM ({R3_BY_ACCOUNT}) a
     UNION ALL SELECT bank_account, 'R6', 'PASS' FROM fx_bank_multi GROUP BY bank_account
     UNION ALL SELECT NULL, rule, status FROM ({R1_MULTI}) b UNION ALL SELECT NULL, rule, status FROM ({R2}) c""",
)
def _(fx):
    given = {"invoices_clean": invoices(fx), "bank_clean": fx.bank_multi(), "crm_deals_clean": deals(fx)}
    return rules.all_rules(given, ["bank_account"]).where("rule NOT IN ('R4', 'R5')")


@query(
    "v07_every_rule_by_account",
    "bank_account:s rule:s coherence_pct:f2 status:s",
    f"""SELECT bank_account, rule, CAST(NULL AS DOUBLE) AS coherence_pct, status FROM ({R3_BY_ACCOUNT}) a
     UNION ALL SELECT bank_account, rule, coherence_pct, status FROM ({R4_BY_ACCOUNT}) d
     UNION ALL SELECT bank_account, rule, coherence_pct, status FROM ({R5_BY_ACCOUNT}) e
     UNION ALL SELECT bank_account, rule, coherence_pct, status FROM ({R6_BY_ACCOUNT}) f
     UNION ALL SELECT NULL, rule, coherence_pct, status FROM ({R1_MULTI}) b UNION ALL SELECT NULL, rule, coherence_pct, status FROM ({R2}) c""",
)
def _(fx):
    return rules.all_rules({"invoices_clean": invoices(fx), "bank_clean": fx.bank_multi(), "crm_deals_clean": deals(fx)}, ACCOUNT)


@query("v04_r4_payroll_by_account", "bank_account:s " + HEAD + "salary_movements:i months_with_salary:i", R4_BY_ACCOUNT)
def _(fx):
    return flat_by_account(rules.r4_payroll(fx.bank_multi(), ACCOUNT), "salary_movements", "months_with_salary")


@query("v05_r5_tax_by_account", "bank_account:s " + HEAD + "tax_movements:i quarters_with_tax:i", R5_BY_ACCOUNT)
def _(fx):
    return flat_by_account(rules.r5_tax(fx.bank_multi(), ACCOUNT), "tax_movements", "quarters_with_tax")


@query("v06_r6_suppliers_by_account", "bank_account:s " + HEAD + "supplier_movements:i", R6_BY_ACCOUNT)
def _(fx):
    return flat_by_account(rules.r6_suppliers(fx.bank_multi(), ACCOUNT), "supplier_movements")


@query("v04_r4_payroll", HEAD + "salary_movements:i months_with_salary:i", R4)
def _(fx):
    return flat(rules.r4_payroll(bank(fx)), "salary_movements", "months_with_salary")


@query("v05_r5_tax", HEAD + "tax_movements:i quarters_with_tax:i", R5)
def _(fx):
    return flat(rules.r5_tax(bank(fx)), "tax_movements", "quarters_with_tax")


@query("v06_r6_suppliers", HEAD + "supplier_movements:i", R6)
def _(fx):
    return flat(rules.r6_suppliers(bank(fx)), "supplier_movements")


@query("v07_all_rules", HEAD.strip(), ALL_RULES)
def _(fx):
    return rules.all_rules(datasets(fx))


@query(
    "v07_rules_summary",
    "total_rules:i passed:i warnings:i failed:i overall_status:s",
    f"""SELECT count(*) AS total_rules, count(*) FILTER (WHERE status = 'PASS') AS passed, count(*) FILTER (WHERE status = 'WARNING') AS warnings,
     count(*) FILTER (WHERE status = 'FAIL') AS failed, CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS overall_status FROM ({ALL_RULES}) a""",
)
def _(fx):
    return rules.rules_summary(rules.all_rules(datasets(fx)))


def _report_sql() -> str:
    metrics = {
        "R1": (R1, ["bank_inflow_total", "invoice_total_amount", "matched_dates", "total_paid_invoices"], True),
        "R2": (R2, ["total_invoices", "total_won_deals"], True),
        "R3": (R3, ["balance_monotonic", "difference", "final_balance_actual", "final_balance_expected", "initial_balance"], False),
        "R4": (R4, ["months_with_salary", "salary_movements"], True),
        "R5": (R5, ["quarters_with_tax", "tax_movements"], True),
        "R6": (R6, ["supplier_movements"], False),
    }
    parts = []
    for rule, (sql, names, graded) in metrics.items():
        lines = ["rule || ': ' || description", "'  Status: ' || status"]
        if graded:
            lines.append("'  Coherencia: ' || format('{:.1f}', round(coherence_pct, 2)) || '%'")
        lines += [f"'  {n}: ' || CAST(CAST({n} AS DECIMAL(28,2)) AS VARCHAR)" for n in names]
        parts += [f"SELECT '{rule}' AS section, {i} AS line, {text} AS text FROM ({sql}) r" for i, text in enumerate(lines)]
    ends = ["'RESULTADO: ' || CASE WHEN f = 0 THEN 'PASS' ELSE 'FAIL' END", "'  Passed: ' || p", "'  Warnings: ' || w", "'  Failed: ' || f"]
    counts = f"SELECT count(*) FILTER (WHERE status = 'PASS') AS p, count(*) FILTER (WHERE status = 'WARNING') AS w, count(*) FILTER (WHERE status = 'FAIL') AS f FROM ({ALL_RULES}) a"
    parts += [f"SELECT '~', {i}, {text} FROM ({counts}) c" for i, text in enumerate(ends)]
    return " UNION ALL ".join(parts)


@query("v08_report_lines", "section:s line:i text:s", _report_sql())
def _(fx):
    return rules.report_lines(rules.all_rules(datasets(fx)))


LINKS = """SELECT i.invoice_id, i.total, i.paid_date, EXISTS (SELECT 1 FROM fx_bank b WHERE b.reference = i.invoice_id) AS has_movement,
 EXISTS (SELECT 1 FROM fx_bank b WHERE b.reference = i.invoice_id AND b.amount = i.total AND b.date = i.paid_date) AS same_amount_and_date FROM v_invoices i WHERE status = 'paid'"""


@query("v09_invoice_links", "invoice_id:s total:m paid_date:d has_movement:b same_amount_and_date:b", LINKS)
def _(fx):
    return rules.invoice_links(invoices(fx), fx.bank())


@query("v09_paid_without_movement", "invoice_id:s total:m paid_date:d", f"SELECT invoice_id, total, paid_date FROM ({LINKS}) l WHERE NOT has_movement")
def _(fx):
    return rules.paid_without_movement(invoices(fx), fx.bank())


FOLLOWED = """SELECT d.deal_id, d.customer_id, d.actual_close, EXISTS (SELECT 1 FROM v_invoices i WHERE i.customer_id = d.customer_id
  AND i.invoice_date BETWEEN d.actual_close + 30 AND d.actual_close + 90) AS has_invoice FROM fx_deals d WHERE stage = 'won' AND actual_close IS NOT NULL"""


@query("v10_won_deal_followups", "deal_id:s customer_id:s actual_close:d has_invoice:b", FOLLOWED)
def _(fx):
    return rules.won_deal_followups(fx.deals(), invoices(fx))


@query("v10_won_without_invoice", "deal_id:s customer_id:s actual_close:d", f"SELECT * FROM ({FOLLOWED}) f WHERE NOT has_invoice")
def _(fx):
    return rules.won_deal_followups(fx.deals(), invoices(fx)).where("NOT has_invoice")


@query(
    "v11_balance_breaks",
    "movement_id:s date:d amount:m balance_after:m prev_balance_after:m",
    """SELECT movement_id, date, amount, balance_after, p AS prev_balance_after FROM (SELECT *, lag(balance_after) OVER w AS p, lag(movement_id) OVER w AS pm FROM v_bank WINDOW w AS (ORDER BY date, movement_id)) t
     WHERE pm IS NOT NULL AND (balance_after - p) IS DISTINCT FROM amount""",
)
def _(fx):
    return rules.balance_breaks(bank(fx))


@query(
    "v11_balance_breaks_across_accounts",
    "bank_account:s movement_id:s prev_movement_id:s",
    """SELECT bank_account, movement_id, pm AS prev_movement_id FROM (SELECT *, lag(balance_after) OVER w AS p, lag(movement_id) OVER w AS pm
       FROM (SELECT 'ACC-' || right(movement_id, 1) AS bank_account, movement_id, date, amount, balance_after FROM fx_bank) b WINDOW w AS (PARTITION BY bank_account ORDER BY date, movement_id)) t
     WHERE pm IS NOT NULL AND (balance_after - p) IS DISTINCT FROM amount""",
)
def _(fx):
    split = fx.bank().withColumn("bank_account", F.concat(F.lit("ACC-"), F.right("movement_id", F.lit(1))))
    return rules.balance_breaks(split, ACCOUNT)


@query(
    "v12_months_without_payroll",
    "month_start:d payroll_date:d",
    "SELECT month_start, payroll_date FROM payroll WHERE payroll_date BETWEEN lo AND hi AND payroll_date NOT IN (SELECT dt FROM fx_bank_base WHERE category = 'salary')",
    bounds=BOUNDS,
    months=MONTHS,
    payroll=PAYROLL,
)
def _(fx):
    return rules.months_without_payroll(fx.bank())


@query(
    "v12_months_without_payroll_by_account",
    "bank_account:s payroll_date:d",
    """SELECT bank_account, payroll_date FROM (SELECT bank_account, m + CASE isodow(m) WHEN 6 THEN 2 WHEN 7 THEN 1 ELSE 0 END AS payroll_date, lo, hi FROM
      (SELECT bank_account, lo, hi, CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS DATE) AS m FROM
       (SELECT bank_account, min(date) AS lo, max(date) AS hi FROM fx_bank_multi GROUP BY 1) b) m) p
     WHERE payroll_date BETWEEN lo AND hi AND NOT EXISTS (SELECT 1 FROM fx_bank_multi s WHERE s.category = 'salary' AND s.bank_account = p.bank_account AND s.date = p.payroll_date)""",
)
def _(fx):
    return rules.months_without_payroll(fx.bank_multi(), ACCOUNT)


QUARTERS = """SELECT bank_account, quarter_start FROM (SELECT bank_account, CAST(unnest(generate_series(date_trunc('quarter', lo), hi, INTERVAL 3 MONTH)) AS DATE) AS quarter_start FROM
  (SELECT bank_account, min(date) AS lo, max(date) AS hi FROM fx_bank_multi GROUP BY 1) b) q"""


@query(
    "v13_quarters_without_tax",
    "bank_account:s quarter_start:d",
    f"SELECT * FROM ({QUARTERS}) q WHERE NOT EXISTS (SELECT 1 FROM fx_bank_multi s WHERE s.category = 'tax' AND s.bank_account = q.bank_account AND CAST(date_trunc('quarter', s.date) AS DATE) = q.quarter_start)",
)
def _(fx):
    return rules.quarters_without_tax(fx.bank_multi(), ACCOUNT)


@query("v14_payments_after_due", "movement_id:s invoice_id:s date:d due_date:d", "SELECT b.movement_id, i.invoice_id, b.date, i.due_date FROM fx_bank b JOIN v_invoices i ON b.reference = i.invoice_id WHERE b.date > i.due_date")
def _(fx):
    return rules.payments_after_due(fx.bank(), invoices(fx))


FIRST, LAST, TODAY = date(1995, 6, 1), date(2000, 12, 31), date(2001, 6, 30)


@query(
    "v15_date_violations",
    "before_range:i after_range:i in_future:i",
    f"SELECT count(*) FILTER (WHERE date < DATE '{FIRST}') AS before_range, count(*) FILTER (WHERE date > DATE '{LAST}') AS after_range, count(*) FILTER (WHERE date > DATE '{TODAY}') AS in_future FROM fx_bank",
)
def _(fx):
    return rules.date_violations(fx.bank(), "date", FIRST, LAST, TODAY)


@query("v16_backward_steps", "load_seq:i movement_id:s date:d prev_date:d", "SELECT load_seq, movement_id, date, p AS prev_date FROM (SELECT *, lag(date) OVER (ORDER BY load_seq) AS p FROM fx_bank) t WHERE date < p")
def _(fx):
    return rules.backward_steps(fx.bank())


@query("v17_due_before_issue", "invoice_id:s invoice_date:d due_date:d", "SELECT invoice_id, invoice_date, due_date FROM v_invoices WHERE due_date <= invoice_date")
def _(fx):
    return rules.due_before_issue(invoices(fx))


@query(
    "v18_null_rules",
    "rule:s violations:i",
    """SELECT 'N1' AS rule, count(*) AS violations FROM v_invoices WHERE status = 'paid' AND paid_date IS NULL UNION ALL
     SELECT 'N1_kept', count(*) FROM v_invoices WHERE status = 'paid' AND paid_date IS NOT NULL UNION ALL
     SELECT 'N3', count(*) FROM fx_deals WHERE stage NOT IN ('won', 'lost') AND actual_close IS NOT NULL""",
)
def _(fx):
    return rules.null_rule_counts(invoices(fx), fx.deals())


@query("v18_open_deals_with_close", "deal_id:s stage:s actual_close:d", "SELECT deal_id, stage, actual_close FROM fx_deals WHERE stage NOT IN ('won', 'lost') AND actual_close IS NOT NULL")
def _(fx):
    return rules.open_deals_with_close(fx.deals())


@query("v19_negative_balances", "movement_id:s date:d balance_after:m", "SELECT movement_id, date, balance_after FROM fx_bank WHERE balance_after < 0")
def _(fx):
    return rules.negative_balances(fx.bank())


@query(
    "v19_opening_balances",
    "bank_account:s opening_balance:m is_positive:b",
    "SELECT bank_account, min_by(balance_after - amount, row(date, movement_id)) AS opening_balance, min_by(balance_after - amount, row(date, movement_id)) > 0 AS is_positive FROM fx_bank_multi GROUP BY bank_account",
)
def _(fx):
    return rules.opening_balances(fx.bank_multi(), ACCOUNT)


@query(
    "v20_large_daily_changes",
    "date:d change:f2 mean_abs_change:f2",
    """SELECT date, change, (SELECT avg(abs(change)) FROM ch) AS mean_abs_change FROM ch WHERE abs(change) >= 2 * (SELECT avg(abs(change)) FROM ch)""",
    ch="SELECT date, cash_balance - lag(cash_balance) OVER (ORDER BY date) AS change FROM v_cash",
)
def _(fx):
    return rules.large_daily_changes(series.cash_flow_daily(fx.bank()))


@query(
    "v21_period_totals",
    "month:s income:m expense:m",
    """SELECT coalesce(i.month, e.month) AS month, coalesce(income, 0) AS income, coalesce(expense, 0) AS expense FROM
     (SELECT strftime(paid_date, '%Y-%m') AS month, sum(total) AS income FROM v_invoices WHERE status = 'paid' AND paid_date IS NOT NULL GROUP BY 1) i FULL JOIN
     (SELECT strftime(date, '%Y-%m') AS month, -sum(amount) AS expense FROM fx_bank WHERE amount < 0 GROUP BY 1) e ON i.month = e.month""",
)
def _(fx):
    return rules.period_totals(invoices(fx), fx.bank())


@query(
    "v22_period_balance_check",
    "bank_account:s month:s opening:m income:m expense:m closing:m holds:b",
    """SELECT bank_account, month, opening, income, expense, closing, closing = opening + income - expense AS holds FROM
     (SELECT *, coalesce(lag(closing) OVER (PARTITION BY bank_account ORDER BY month), before) AS opening FROM
      (SELECT bank_account, strftime(date, '%Y-%m') AS month, min_by(balance_after - amount, row(date, movement_id)) AS before, max_by(balance_after, row(date, movement_id)) AS closing,
        coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS income, coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS expense FROM fx_bank_multi GROUP BY 1, 2) m) n""",
)
def _(fx):
    return rules.period_balance_check(fx.bank_multi(), ACCOUNT)


@query(
    "v23_ebitda",
    "month:s income:m operating_expense:m ebitda:m",
    """SELECT month, income, operating_expense, income - operating_expense AS ebitda FROM (SELECT strftime(date, '%Y-%m') AS month, coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS income,
     coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS operating_expense FROM fx_bank WHERE category NOT IN ('investment', 'tax') GROUP BY 1) m""",
)
def _(fx):
    return rules.ebitda(fx.bank(), excluded=["investment", "tax"])


@query("v24_mixed_payment_methods", "customer_id:s methods:i", "SELECT customer_id, count(DISTINCT payment_method) AS methods FROM v_invoices GROUP BY 1 HAVING count(DISTINCT payment_method) > 1")
def _(fx):
    return rules.mixed_payment_methods(invoices(fx))
