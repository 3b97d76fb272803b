"""Cleaned and derived tables as SQL, built on the fixture views; the oracles of later operators start here."""

AS_OF = "1998-06-01"


def gap_fill(source: str, columns: dict[str, str], carry: str, part: str = "", day: str = "date") -> str:
    """Linear fill by row position of the named columns of ``source``."""
    over = f"{'PARTITION BY ' + part if part else ''} ORDER BY {day}"
    back = f"{'PARTITION BY ' + part if part else ''} ORDER BY {day} DESC"
    so_far = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"
    inner, outer = [], []
    for name, expr in columns.items():
        value = f"CAST({expr} AS DOUBLE)"
        place = f"CASE WHEN {expr} IS NOT NULL THEN pos END"
        inner += [
            f"{value} AS v_{name}",
            f"last_value({value} IGNORE NULLS) OVER ({over} {so_far}) AS pv_{name}",
            f"last_value({place} IGNORE NULLS) OVER ({over} {so_far}) AS pp_{name}",
            f"last_value({value} IGNORE NULLS) OVER ({back} {so_far}) AS nv_{name}",
            f"last_value({place} IGNORE NULLS) OVER ({back} {so_far}) AS np_{name}",
        ]
        outer.append(
            f"CASE WHEN v_{name} IS NOT NULL THEN v_{name} WHEN pv_{name} IS NOT NULL AND nv_{name} IS NOT NULL "
            f"THEN pv_{name} + (nv_{name} - pv_{name}) * (pos - pp_{name}) / (np_{name} - pp_{name}) ELSE pv_{name} END AS {name}"
        )
    numbered = f"SELECT *, row_number() OVER ({over}) AS pos FROM {source}"
    return (
        f"SELECT {carry}, {', '.join(outer)} FROM (SELECT {carry}, pos, {', '.join(inner)} FROM ({numbered}) p) q"
    )


def _daily(bank: str, part: str = "") -> str:
    lead = f"{part}, " if part else ""
    return f"""
SELECT {lead}date, CAST(coalesce(sum(amount), 0) AS DECIMAL(28,2)) AS net_cash,
 max_by(balance_after, load_seq) FILTER (WHERE balance_after IS NOT NULL) AS cash_balance, count(movement_id) AS transaction_count,
 CAST(coalesce(sum(amount) FILTER (WHERE amount > 0), 0) AS DECIMAL(28,2)) AS gross_inflow,
 CAST(coalesce(-sum(amount) FILTER (WHERE amount < 0), 0) AS DECIMAL(28,2)) AS gross_outflow
FROM {bank} GROUP BY {lead}date"""


def _dense(daily: str, part: str = "") -> str:
    lead = f"{part}, " if part else ""
    qualified = f"s.{part}, " if part else ""
    group = f"GROUP BY {part}" if part else ""
    same = f"s.{part} = v.{part} AND " if part else ""
    return f"""
SELECT {qualified}s.date, v.cash_balance, v.net_cash, v.transaction_count, v.gross_inflow, v.gross_outflow
FROM (SELECT {lead}CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT {lead}min(date) AS lo, max(date) AS hi FROM {daily} {group}) b) s
LEFT JOIN {daily} v ON {same}s.date = v.date"""


def _cash_flow(dense: str, part: str = "") -> str:
    lead = f"{part}, " if part else ""
    carry = f"{lead}date, net_cash, transaction_count"
    filled = gap_fill(dense, {"cash_balance": "cash_balance"}, carry, part)
    return f"""
SELECT {lead}date, cash_balance, greatest(coalesce(net_cash, 0), 0) AS cash_inflow, greatest(-coalesce(net_cash, 0), 0) AS cash_outflow,
 coalesce(net_cash, 0) AS net_cash, coalesce(transaction_count, 0) AS transaction_count FROM ({filled}) f"""


def base_forecast(history: str, part: str = "") -> dict[str, str]:
    """Fit of trend, weekday and month effects on ``history(part, ds, y)``, as chained CTE texts."""
    by = f"PARTITION BY {part}" if part else ""
    by_day = f"PARTITION BY {part + ', ' if part else ''}weekday"
    by_month = f"PARTITION BY {part + ', ' if part else ''}month"
    lead = f"{part}, " if part else ""
    timed = f"""
SELECT {lead}ds, y, min(ds) OVER ({by}) AS origin, max(ds) OVER ({by}) AS last_day,
 CAST(date_diff('day', min(ds) OVER ({by}), ds) AS BIGINT) AS t FROM {history}"""
    sums = f"""
SELECT *, CAST(count(y) OVER ({by}) AS DOUBLE) AS n, CAST(sum(t) OVER ({by}) AS DOUBLE) AS st, CAST(sum(t * t) OVER ({by}) AS DOUBLE) AS stt,
 CAST(sum(CAST(y AS DECIMAL(30,6))) OVER ({by}) AS DOUBLE) AS sy,
 CAST(sum(CAST(CAST(y AS DECIMAL(30,6)) * CAST(t AS DECIMAL(8,0)) AS DECIMAL(38,6))) OVER ({by}) AS DOUBLE) AS sty FROM ({timed}) a"""
    line = f"SELECT *, coalesce((n * sty - st * sy) / nullif(n * stt - st * st, 0), 0.0) AS slope FROM ({sums}) b"
    trend = f"""
SELECT *, intercept + slope * t AS trend, isodow(ds) - 1 AS weekday, month(ds) AS month
FROM (SELECT *, (sy - slope * st) / n AS intercept FROM ({line}) c) d"""
    ratio = f"SELECT *, y / nullif(trend, 0) AS ratio FROM ({trend}) e"

    def mean(expr: str, window: str) -> str:
        return (
            f"coalesce(CAST(sum(CAST({expr} AS DECIMAL(30,12))) OVER ({window}) AS DOUBLE) "
            f"/ nullif(CAST(count({expr}) OVER ({window}) AS DOUBLE), 0), 0.0)"
        )

    weekly = f"SELECT *, {mean('(ratio - 1)', by_day)} AS weekly FROM ({ratio}) f"
    return {"fitted": f"SELECT *, {mean('(ratio - 1 - weekly)', by_month)} AS yearly FROM ({weekly}) g"}


Z80 = "1.2815515655446008"


def predicted(fitted: str, horizon: int = 90, part: str = "") -> str:
    """The forecast of a ``fitted`` table, history included."""
    lead = f"{part}, " if part else ""
    group = f"GROUP BY {part}" if part else ""

    def on(left: str, right: str, also: str = "") -> str:
        keys = [f"{left}.{part} = {right}.{part}"] if part else []
        return " AND ".join([*keys, *([also] if also else [])]) or "TRUE"

    return f"""
SELECT {lead}ds, yhat, yhat - {Z80} * sigma AS yhat_lower, yhat + {Z80} * sigma AS yhat_upper, trend, yearly, weekly FROM (
 SELECT d.*, trend * (1 + weekly + yearly) AS yhat FROM (
  SELECT {'m.' + part + ', ' if part else ''}m.ds, m.sigma, m.intercept + m.slope * date_diff('day', m.origin, m.ds) AS trend,
   coalesce(w.weekly, 0.0) AS weekly, coalesce(y.yearly, 0.0) AS yearly
  FROM (SELECT {lead}origin, slope, intercept, sigma, CAST(unnest(generate_series(origin, last_day + {horizon}, INTERVAL 1 DAY)) AS DATE) AS ds
        FROM (SELECT {lead}min(origin) AS origin, max(last_day) AS last_day, min(slope) AS slope, min(intercept) AS intercept,
               coalesce(stddev_samp(y - trend * (1 + weekly + yearly)), 0.0) AS sigma FROM {fitted} {group}) a) m
  LEFT JOIN (SELECT DISTINCT {lead}weekday, weekly FROM {fitted}) w ON {on('m', 'w', 'w.weekday = isodow(m.ds) - 1')}
  LEFT JOIN (SELECT DISTINCT {lead}month, yearly FROM {fitted}) y ON {on('m', 'y', 'y.month = month(m.ds)')}
 ) d) e"""


ACC = "bank_account"

DERIVED: dict[str, str] = {
    "v_invoices": f"""
SELECT invoice_id, invoice_date, due_date, customer_id, customer_name, amount, vat, total, status, paid_date, payment_method, category, load_seq,
 date_diff('day', invoice_date, paid_date) AS days_to_pay,
 coalesce(status = 'pending' AND due_date < DATE '{AS_OF}', FALSE) AS is_overdue
FROM (SELECT invoice_id, CAST(invoice_date AS DATE) AS invoice_date, CAST(due_date AS DATE) AS due_date, customer_id, customer_name,
  coalesce(TRY_CAST(amount AS DECIMAL(18,2)), 0) AS amount, coalesce(TRY_CAST(vat AS DECIMAL(18,2)), 0) AS vat,
  coalesce(TRY_CAST(total AS DECIMAL(18,2)), 0) AS total, coalesce(status, 'unknown') AS status, TRY_CAST(paid_date AS DATE) AS paid_date,
  coalesce(payment_method, 'transfer') AS payment_method, category, load_seq,
  row_number() OVER (PARTITION BY invoice_id ORDER BY load_seq) AS rn FROM fx_invoices_raw) t WHERE rn = 1""",
    "v_bank": """
SELECT movement_id, date, value_date, description, amount, balance_after, category, reference, bank_account, load_seq,
 coalesce(amount > 0, FALSE) AS is_inflow, coalesce(amount < 0, FALSE) AS is_outflow, amount AS cash_flow
FROM (SELECT movement_id, CAST(date AS DATE) AS date, TRY_CAST(value_date AS DATE) AS value_date, coalesce(description, 'Sin descripcion') AS description,
  TRY_CAST(amount AS DECIMAL(18,2)) AS amount, TRY_CAST(balance_after AS DECIMAL(18,2)) AS balance_after, coalesce(category, 'other') AS category,
  reference, bank_account, load_seq, row_number() OVER (PARTITION BY movement_id ORDER BY load_seq) AS rn FROM fx_bank_raw) t WHERE rn = 1""",
    "v_deals": """
SELECT *, stage = 'won' AS is_won, stage = 'lost' AS is_lost, CAST(expected_amount AS DOUBLE) * probability AS weighted_value
FROM (SELECT deal_id, deal_name, customer_id, customer_name, coalesce(stage, 'unknown') AS stage, coalesce(TRY_CAST(probability AS DOUBLE), 0) AS probability,
  coalesce(TRY_CAST(expected_amount AS DECIMAL(18,2)), 0) AS expected_amount, CAST(created_date AS DATE) AS created_date,
  TRY_CAST(expected_close AS DATE) AS expected_close, TRY_CAST(actual_close AS DATE) AS actual_close, TRY_CAST(closed_date AS DATE) AS closed_date FROM fx_deals_raw) t""",
    "v_daily": _daily("fx_bank"),
    "v_dense": _dense("v_daily"),
    "v_cash": _cash_flow("v_dense"),
    "v_daily_acc": _daily("fx_bank_multi", ACC),
    "v_dense_acc": _dense("v_daily_acc", ACC),
    "v_cash_acc": _cash_flow("v_dense_acc", ACC),
    "v_full": "SELECT ds, y, row_number() OVER (ORDER BY ds) AS rn, count(*) OVER () AS n FROM (SELECT date AS ds, cash_balance AS y FROM v_cash WHERE cash_balance IS NOT NULL) t",
    "v_train": "SELECT ds, y FROM v_full WHERE rn <= floor(n * 0.8)",
    "v_test": "SELECT ds, y FROM v_full WHERE rn > floor(n * 0.8)",
    "v_fit_train": base_forecast("v_train")["fitted"],
    "v_fc_train": predicted("v_fit_train"),
    "v_fit_full": base_forecast("v_full")["fitted"],
    "v_fc": predicted("v_fit_full"),
    "v_hist_acc": "SELECT bank_account, date AS ds, cash_balance AS y FROM v_cash_acc WHERE cash_balance IS NOT NULL",
    "v_fit_acc": base_forecast("v_hist_acc", ACC)["fitted"],
    "v_fc_acc": predicted("v_fit_acc", part=ACC),
    "v_pairs": "SELECT t.ds, t.y, f.yhat, f.yhat_lower, f.yhat_upper FROM v_test t JOIN v_fc_train f ON t.ds = f.ds",
    "v_shown_all": """
SELECT f.ds, f.yhat, f.yhat_lower, f.yhat_upper, c.cash_balance AS y, c.cash_balance - f.yhat AS error, abs(c.cash_balance - f.yhat) AS abs_error,
 abs((c.cash_balance - f.yhat) / nullif(c.cash_balance, 0)) * 100 AS pct_error
FROM v_fc f LEFT JOIN v_cash c ON f.ds = c.date WHERE c.cash_balance IS NOT NULL""",
    "v_shown": "SELECT * FROM v_shown_all",
}
