"""The fixture views as portable SQL, inlined into the oracle queries as CTEs."""

from __future__ import annotations

import re

from ledgerflow.plans.oracle_derived import DERIVED

VIEWS: dict[str, str] = {
    "fx_invoices_base": """
SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d,
 CASE substr(o_orderpriority,1,1) WHEN '1' THEN 15 WHEN '2' THEN 30 WHEN '3' THEN 45 WHEN '4' THEN 60 ELSE 90 END AS cyc,
 CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'P' THEN 'pending' ELSE 'overdue' END AS status,
 CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(o_totalprice/1.21 AS DECIMAL(18,2)) AS amount FROM orders
""",
    "fx_invoices_raw": """
SELECT 'INV-' || CAST(o_orderkey AS STRING) AS invoice_id, CAST(d AS STRING) AS invoice_date,
 CAST(CASE WHEN o_orderkey % 101 = 0 THEN d - 1 ELSE d + cyc END AS STRING) AS due_date, 'C' || CAST(o_custkey AS STRING) AS customer_id, 'Customer ' || CAST(o_custkey AS STRING) AS customer_name,
 CAST(amount AS STRING) AS amount, CAST(CAST(total - amount AS DECIMAL(18,2)) AS STRING) AS vat,
 CASE WHEN o_orderkey % 97 = 0 THEN 'n/a' ELSE CAST(total AS STRING) END AS total,
 CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE status END AS status,
 CASE WHEN o_orderkey % 83 = 0 THEN 'not-a-date' WHEN status = 'paid' THEN CAST(d + CAST(o_orderkey % cyc AS INT) AS STRING) END AS paid_date,
 CASE o_orderkey % 4 WHEN 0 THEN 'transfer' WHEN 1 THEN 'confirming' WHEN 2 THEN 'receipt' END AS payment_method,
 CASE WHEN o_orderkey % 10 < 9 THEN 'product' ELSE 'service' END AS category, l.load_seq
 FROM fx_invoices_base CROSS JOIN (SELECT 1 AS load_seq UNION ALL SELECT 2) l WHERE l.load_seq = 1 OR o_orderkey % 50 = 0
""",
    "fx_bank_base": """
SELECT 'I' || CAST(o_orderkey AS STRING) AS movement_id, d + CAST(o_orderkey % cyc AS INT) + CASE WHEN o_orderkey % 71 = 0 THEN 100 ELSE 0 END AS dt, total AS amount, 'invoice_payment' AS category,
 'INV-' || CAST(o_orderkey AS STRING) AS reference FROM fx_invoices_base WHERE status = 'paid' AND o_orderkey % 67 <> 0
UNION ALL SELECT concat_ws('-', 'S', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING)), CAST(min(l_shipdate) AS DATE),
 -CAST(sum(CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END) AS DECIMAL(18,2)), CASE WHEN l_suppkey % 10 = 0 THEN 'salary' WHEN l_suppkey % 10 = 1 THEN 'tax' WHEN l_suppkey % 10 = 2 THEN 'utility' ELSE 'supplier' END, NULL
 FROM lineitem GROUP BY l_orderkey, l_linenumber, l_partkey, l_suppkey
""",
    "fx_bank": """
SELECT movement_id, dt AS date, dt AS value_date, CASE WHEN length(movement_id) % 5 = 0 THEN NULL ELSE 'mov ' || movement_id END AS description, amount,
 CAST(450000 + sum(amount) OVER (ORDER BY dt, movement_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance_after, category, reference, 'ES7621000000001234567890' AS bank_account,
 row_number() OVER (ORDER BY CASE WHEN movement_id LIKE '%77' THEN dt + 30 ELSE dt END, movement_id) AS load_seq FROM fx_bank_base
""",
    "fx_bank_multi": """
SELECT movement_id, date, amount, CAST(45000 + sum(amount) OVER (PARTITION BY substr(movement_id, length(movement_id), 1) ORDER BY date, movement_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance_after,
 category, reference, load_seq, 'ACC-' || substr(movement_id, length(movement_id), 1) AS bank_account FROM fx_bank
""",
    "fx_bank_raw": """
SELECT movement_id, CAST(date AS STRING) AS date, CASE WHEN movement_id LIKE '%8' THEN 'bad' ELSE CAST(value_date AS STRING) END AS value_date, description,
 CASE WHEN movement_id LIKE '%51' THEN 'n/a' ELSE CAST(amount AS STRING) END AS amount, CAST(balance_after AS STRING) AS balance_after,
 CASE WHEN movement_id LIKE '%9' THEN NULL ELSE category END AS category, reference, bank_account, load_seq * 2 + l.copy AS load_seq
 FROM fx_bank CROSS JOIN (SELECT 0 AS copy UNION ALL SELECT 1) l WHERE l.copy = 0 OR movement_id LIKE '%23'
""",
    "fx_deals": """
SELECT deal_id, 'Deal ' || deal_id AS deal_name, customer_id, 'Customer ' || substr(customer_id, 2) AS customer_name, stage,
 CAST(CASE stage WHEN 'prospecting' THEN 0.10 WHEN 'qualification' THEN 0.25 WHEN 'proposal' THEN 0.50 WHEN 'negotiation' THEN 0.75 WHEN 'won' THEN 1.0 ELSE 0.0 END AS DOUBLE) AS probability,
 expected_amount, created_date, CASE WHEN k % 41 = 0 THEN NULL ELSE expected_close END AS expected_close,
 CASE WHEN stage IN ('won','lost') OR k % 205 = 0 THEN expected_close - CAST(k % 15 AS INT) END AS actual_close, CASE WHEN stage IN ('won','lost') THEN expected_close - CAST(k % 15 AS INT) END AS closed_date
FROM (SELECT o_orderkey AS k, 'DEAL-' || CAST(o_orderkey AS STRING) AS deal_id, 'C' || CAST(o_custkey AS STRING) AS customer_id,
 CASE CAST(floor(o_orderkey / 5) AS INT) % 6 WHEN 0 THEN 'prospecting' WHEN 1 THEN 'qualification' WHEN 2 THEN 'proposal' WHEN 3 THEN 'negotiation' WHEN 4 THEN 'won' ELSE 'lost' END AS stage,
 amount AS expected_amount, d - 75 AS created_date, CASE WHEN o_orderkey % 7 < 2 THEN d + 10 ELSE d - 40 END AS expected_close FROM fx_invoices_base) x
""",
    "fx_deals_raw": """
SELECT deal_id, deal_name, customer_id, customer_name, CASE WHEN deal_id LIKE '%15' THEN NULL ELSE stage END AS stage, CASE WHEN deal_id LIKE '%25' THEN '?' ELSE CAST(probability AS STRING) END AS probability,
 CASE WHEN deal_id LIKE '%35' THEN 'n/a' ELSE CAST(expected_amount AS STRING) END AS expected_amount, CAST(created_date AS STRING) AS created_date, CAST(expected_close AS STRING) AS expected_close,
 CAST(actual_close AS STRING) AS actual_close, CAST(closed_date AS STRING) AS closed_date FROM fx_deals
""",
    "fx_factors": """
SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS date, 'interest_rate' AS indicator, round(avg(l_tax)*100, 4) AS value, 'bank_spain' AS source FROM lineitem GROUP BY 1
UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'inflation', round(avg(l_discount)*100, 4), 'ine' FROM lineitem GROUP BY 1
UNION ALL SELECT CAST(date_trunc('month', l_shipdate) AS DATE), 'sector_growth', round(avg(l_quantity)/10, 4), 'market' FROM lineitem GROUP BY 1
""",
    "fx_employees_raw": """
SELECT 'E' || CAST(c_custkey AS STRING) AS employee_id, c_name AS name, CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_mktsegment END AS department,
 CASE WHEN c_custkey % 10 = 0 THEN 'temporary' WHEN c_custkey % 29 = 0 THEN NULL ELSE 'permanent' END AS contract_type,
 CASE WHEN c_custkey % 31 = 0 THEN 'x' ELSE CAST(CAST(abs(c_acctbal) AS DECIMAL(18,2)) AS STRING) END AS salary,
 CAST(CAST(abs(c_acctbal) * 0.32 AS DECIMAL(18,2)) AS STRING) AS ss_contribution, CASE WHEN c_custkey % 37 = 0 THEN 'unknown' ELSE '2020-01-15' END AS start_date FROM customer
""",
    "fx_suppliers_raw": """
SELECT 'S' || CAST(s_suppkey AS STRING) AS supplier_id, s_name AS name, CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE 'raw_material' END AS category,
 CASE WHEN s_suppkey % 9 = 0 THEN 'net' ELSE CAST(15 * (1 + s_suppkey % 6) AS STRING) END AS payment_cycle, CAST(CAST(s_acctbal AS DECIMAL(18,2)) AS STRING) AS typical_amount FROM supplier
""",
    "fx_event_ledger": """
SELECT event_id AS movement_id, ts, 'ACC-' || CAST(user_id % 10 AS STRING) AS bank_account,
 CAST(CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE -value END AS DECIMAL(18,2)) AS amount, event_type AS category FROM events
""",
}


VIEWS |= DERIVED


def _needs(sql: str) -> list[str]:
    return [name for name in VIEWS if re.search(rf"\b{name}\b", sql)]


def with_views(body: str, **extra: str) -> str:
    """Prefix ``body`` with the fixture views it uses, then with the named extra CTEs in order."""
    wanted: list[str] = []

    def add(sql: str) -> None:
        for name in _needs(sql):
            if name not in wanted:
                add(VIEWS[name])
                wanted.append(name)

    for text in (*extra.values(), body):
        add(text)
    parts = [f"{name} AS ({VIEWS[name].strip()})" for name in wanted]
    parts += [f"{name} AS ({text.strip()})" for name, text in extra.items()]
    return f"WITH {', '.join(parts)} {body.strip()}" if parts else body.strip()
