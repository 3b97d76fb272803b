"""Rules against brute force, and alert texts."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerflow.config import Thresholds
from ledgerflow.operators import alerts, rules


def test_followups_equal_brute_force_with_a_hot_customer(spark):
    draw = random.Random(5)
    start = date(2023, 1, 1)

    def customer():
        return "hot" if draw.random() < 0.5 else f"c{draw.randrange(20)}"

    deals = [(f"d{i}", customer(), "won" if draw.random() < 0.8 else "lost", start + timedelta(days=draw.randrange(400))) for i in range(150)]
    deals += [("dnull", None, "won", start), ("dopen", "hot", "won", None)]
    invoices = [(customer(), start + timedelta(days=draw.randrange(500))) for _ in range(120)]
    got = {
        r.deal_id: r.has_invoice
        for r in rules.won_deal_followups(
            spark.createDataFrame(deals, "deal_id string, customer_id string, stage string, actual_close date"),
            spark.createDataFrame(invoices, "customer_id string, invoice_date date"),
        ).collect()
    }
    want = {
        d: any(c == ic and 30 <= (day - close).days <= 90 for ic, day in invoices)
        for d, c, stage, close in deals
        if stage == "won" and close is not None
    }
    assert got == want


def bank(spark, rows):
    df = spark.createDataFrame(rows, "movement_id string, date date, amount int, balance_after int, category string")
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("amount", "balance_after")})


def test_short_span_gives_a_warning_not_an_error(spark):
    df = bank(spark, [("a", date(2024, 1, 1), -1, 9, "salary"), ("b", date(2024, 1, 5), -1, 8, "tax")])
    statuses = {r.rule: (r.status, r.coherence_pct) for r in rules.all_rules({"bank_clean": df}).collect()}
    assert statuses["R4"] == ("WARNING", 0.0) and statuses["R5"] == ("WARNING", 0.0)
    assert statuses["R3"][0] == "PASS" and set(statuses) == {"R3", "R4", "R5"}


def test_summary_counts_add_up(spark):
    df = bank(spark, [("a", date(2024, 1, 1), -1, 9, "salary"), ("b", date(2024, 6, 5), -500_000, 8, "supplier")])
    row = rules.rules_summary(rules.all_rules({"bank_clean": df})).first()
    assert row.total_rules == row.passed + row.warnings + row.failed == 3
    assert row.overall_status == ("FAIL" if row.failed else "PASS")


def test_balance_break_is_found(spark):
    df = bank(spark, [("a", date(2024, 1, 1), 5, 5, "x"), ("b", date(2024, 1, 1), 5, 10, "x"), ("c", date(2024, 1, 2), 1, 12, "x"), ("d", date(2024, 1, 3), None, 12, "x")])
    assert [r.movement_id for r in rules.balance_breaks(df).orderBy("movement_id").collect()] == ["c", "d"]


def test_no_applicable_rule(spark):
    with pytest.raises(ValueError):
        rules.all_rules({})


def test_balance_alert_threshold(spark):
    for value, fires in ((30_000.0, True), (100_000.0, False), (50_000.0, False)):
        df = spark.createDataFrame([(value,)], "current_cash_balance double")
        assert alerts.balance_alert(df).first().triggered is fires


def test_projection_alert_threshold(spark):
    for value, fires in ((20_000.0, True), (100_000.0, False)):
        df = spark.createDataFrame([(value,)], "forecast_90d double")
        row = alerts.projection_alert(df).first()
        assert row.triggered is fires
    assert "PROYECCION NEGATIVA: 100,000€" in row.message


def daily(spark, balances, acc="a"):
    rows = [(acc, date(2024, 1, 1) + timedelta(days=i), float(b), 1.0, 2.0) for i, b in enumerate(balances)]
    return spark.createDataFrame(rows, "acc string, date date, cash_balance double, cash_inflow double, cash_outflow double")


def test_variation_needs_seven_rows_and_a_non_zero_start(spark):
    assert not alerts.variation_alert(daily(spark, [100] * 5 + [1]), ["acc"]).first().triggered
    assert alerts.variation_alert(daily(spark, [100] * 6 + [1]), ["acc"]).first().triggered
    assert not alerts.variation_alert(daily(spark, [0] * 6 + [1]), ["acc"]).first().triggered


def test_deviation_is_silent_on_zero_forecast(spark):
    df = spark.createDataFrame([(100.0, 0.0), (100.0, 80.0), (100.0, 95.0)], "actual double, forecast double")
    assert [r.triggered for r in alerts.deviation_alert(df).collect()] == [False, True, False]


def test_check_all_without_forecast(spark):
    days = daily(spark, [100_000] * 6 + [40_000])
    latest = days.groupBy("acc").agg(F.max_by("cash_balance", "date").alias("current_cash_balance"))
    assert sorted(r.code for r in alerts.check_all(days, latest, keys=["acc"]).collect()) == ["A1", "A2"]


def test_digest_texts(spark):
    rows = [("a", "A1", "CRITICAL", "low", True), ("a", "A2", "HIGH", "fall", True)]
    found = spark.createDataFrame(rows, "acc string, code string, severity string, message string, triggered boolean")
    texts = {r.acc: r.message for r in alerts.digest(found, spark.createDataFrame([("a",), ("b",)], "acc string"), ["acc"]).collect()}
    assert "CRITICAL:\n  [A1] low" in texts["a"] and "HIGH:\n  [A2] fall" in texts["a"] and "MEDIUM" not in texts["a"]
    assert texts["b"] == alerts.NO_ALERTS
    assert alerts.digest(found.limit(0)).first().message == alerts.NO_ALERTS


def test_digest_lists_other_severities_and_counts_repeats(spark):
    rows = [("A5", "LOW", f"odd movement {i}") for i in range(500)]
    text = alerts.digest(spark.createDataFrame(rows, "code string, severity string, message string")).first().message
    assert "OTHER:" in text and "(+499)" in text and text.count("odd movement") == 1
    assert alerts.NO_ALERTS != text


def test_years_come_from_the_data_and_none_is_lost(spark):
    import pytest
    from pyspark.sql import functions as F

    from ledgerflow.operators import kpi

    daily = spark.createDataFrame([("1987-03-01", 5.0), ("2031-03-02", 7.0)], "date string, net_cash double").withColumn("date", F.col("date").cast("date"))
    assert kpi.year_month_matrix(daily).columns == ["month", "1987", "2031"]
    with pytest.raises(Exception, match="year outside"):
        kpi.year_month_matrix(daily, [2031]).collect()


def test_status_message_uses_the_last_row(spark):
    text = alerts.status_message(daily(spark, [10, 1234.5])).first().message
    assert "Saldo actual: 1,234.50€" in text and "Ingresos 30d: 1.00€" in text


def test_anomalies_by_account(spark):
    rows = [("a", f"m{i}", 10, "x") for i in range(20)] + [("a", "big", -500, "x"), ("b", "same", 500, "x")]
    df = spark.createDataFrame(rows, "acc string, movement_id string, amount int, category string")
    assert [r.movement_id for r in alerts.anomalous_movements(df, ["acc"]).collect()] == ["big"]
    assert alerts.anomalous_movements(df, ["acc"], limits=Thresholds(anomaly_multiplier=100)).count() == 0


def test_every_rule_is_given_per_account(spark, small):
    from ledgerflow.plans.registry import load

    rows = load()["v07_every_rule_by_account"].run(spark, small).collect()
    accounts = {r.bank_account for r in rows if r.bank_account is not None}
    want = {(a, rule) for a in accounts for rule in ("R3", "R4", "R5", "R6")} | {(None, "R1"), (None, "R2")}
    assert accounts and len(rows) == len(want) and {(r.bank_account, r.rule) for r in rows} == want
