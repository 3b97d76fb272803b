"""Hand-worked cleaning and daily-series cases."""

from datetime import date, timedelta

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerflow.operators import clean, series

BANK = "movement_id string, date date, amount int, balance_after int"


def money(df):
    return df.withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("amount", "balance_after")})


def day(text):
    return date.fromisoformat(text)


def test_two_sample_invoices(spark):
    columns = "invoice_id string, invoice_date string, due_date string, paid_date string, customer_name string, amount string, vat string, total string, status string, payment_method string, load_seq int"
    raw = spark.createDataFrame(
        [
            ("INV-001", "2023-01-01", "2023-02-01", "2023-01-15", "A", "1000", "210", "1210.0", "paid", "transfer", 1),
            ("INV-002", "2023-01-02", "2023-02-02", None, "B", "x", None, "605", "pending", None, 2),
            ("INV-002", "2023-01-03", "2023-02-03", None, "later copy", "1", "1", "1", "paid", None, 3),
        ],
        columns,
    )
    first, second = clean.clean_invoices(raw, day("2023-03-01")).orderBy("invoice_id").collect()
    assert first.days_to_pay == 14 and str(first.total) == "1210.00" and not first.is_overdue
    assert second.days_to_pay is None and second.is_overdue and second.customer_name == "B"
    assert str(second.amount) == "0.00" and second.payment_method == "transfer"


def test_strict_date_fails_and_lenient_date_is_null(spark):
    from pyspark.errors import PySparkException

    from ledgerflow.functions.parsing import lenient_date, strict_date

    df = spark.createDataFrame([("2023-13-45",)], "d string")
    assert df.select(lenient_date("d").alias("d")).first().d is None
    with pytest.raises(PySparkException):
        df.select(strict_date("d").alias("d")).collect()


def test_cancelled_invoice_is_never_overdue(spark):
    df = spark.createDataFrame([("cancelled", day("2020-01-01"))], "status string, due date")
    assert df.select(clean.is_overdue(F.col("status"), F.col("due"), day("2023-01-01")).alias("o")).first().o is False


def test_gap_day_is_interpolated_and_flows_are_zero(spark):
    bank = money(spark.createDataFrame(
        [("m1", day("2024-01-01"), 100, 100), ("m2", day("2024-01-01"), -30, 70), ("m3", day("2024-01-04"), 30, 100)], BANK
    ))
    rows = series.cash_flow_daily(bank).orderBy("date").collect()
    assert [r.cash_balance for r in rows] == [70.0, 80.0, 90.0, 100.0]
    assert [float(r.cash_inflow) for r in rows] == [70.0, 0.0, 0.0, 30.0]
    assert [r.transaction_count for r in rows] == [2, 0, 0, 1]


def test_gross_basis_keeps_both_sides(spark):
    bank = money(spark.createDataFrame([("m1", day("2024-01-01"), 100, 100), ("m2", day("2024-01-01"), -30, 70)], BANK))
    row = series.cash_flow_daily(bank, basis="gross").first()
    assert (float(row.cash_inflow), float(row.cash_outflow), float(row.net_cash)) == (100.0, 30.0, 70.0)


def test_one_day_and_empty_ledger(spark):
    bank = money(spark.createDataFrame([("m1", day("2024-01-01"), 5, 5)], BANK))
    assert series.cash_flow_daily(bank).count() == 1
    assert series.cash_flow_daily(bank.limit(0)).count() == 0


def test_all_null_balance_day_is_filled(spark):
    bank = money(spark.createDataFrame(
        [("a", day("2024-01-01"), 1, 10), ("b", day("2024-01-02"), 1, None), ("c", day("2024-01-03"), 1, 20)], BANK
    ))
    assert [r.cash_balance for r in series.cash_flow_daily(bank).orderBy("date").collect()] == [10.0, 15.0, 20.0]


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(-100, 100)), min_size=1, max_size=25), min_size=1, max_size=4))
def test_interpolation_equals_pandas(spark, groups):
    start = day("2024-01-01")
    rows = [(f"s{g}", start + timedelta(days=i), None if v is None else float(v)) for g, values in enumerate(groups) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "s string, date date, v double")
    got = {(r.s, r.date): r.v for r in series.interpolate_linear(df, ["v"], ["s"]).collect()}
    for g, values in enumerate(groups):
        filled = pd.Series(values, dtype=float).interpolate(method="linear")
        for i, want in enumerate(filled):
            value = got[f"s{g}", start + timedelta(days=i)]
            assert (value is None) == pd.isna(want) and (value is None or abs(value - want) < 1e-9)


def test_densify_has_every_day_of_each_series(spark):
    rows = [("a", day("2024-02-27"), 1), ("a", day("2024-03-02"), 2), ("b", day("2023-12-30"), 3), ("b", day("2024-01-02"), 4)]
    dense = series.densify(spark.createDataFrame(rows, "s string, date date, v int"), ["s"])
    spans = {r.s: (r.n, r.days) for r in dense.groupBy("s").agg(F.count("*").alias("n"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("days")).collect()}
    assert spans == {"a": (5, 5), "b": (4, 4)}


def test_numeric_order_keeps_a_hash_aggregate(spark):
    bank = money(spark.createDataFrame([("m1", day("2024-01-01"), 1, 1, 1)], BANK + ", load_seq bigint"))
    plan = series.daily_totals(bank, order="load_seq")._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_missing_factors_pass_through(spark):
    df = spark.createDataFrame([(day("2024-01-01"), 1.0)], "ds date, y double")
    assert series.merge_factors(df, None) is df


@pytest.mark.parametrize("size", [1, 4, 5, 99, 1234])
def test_split_equals_python_int(spark, size):
    df = spark.range(size).select(F.date_add(F.lit(day("2020-01-01")), F.col("id").cast("int")).alias("ds"), F.lit(1.0).alias("y"))
    assert series.split_train_test(df).where("is_train").count() == int(size * (1 - 0.2))


def test_payroll_moves_off_the_weekend(spark):
    bounds = spark.createDataFrame([(day("2024-06-01"), day("2024-09-30"))], "first_day date, last_day date")
    days = [r.payroll_date for r in series.payroll_calendar(bounds).orderBy("month_start").collect()]
    assert days == [day("2024-06-03"), day("2024-07-01"), day("2024-08-01"), day("2024-09-02")]
