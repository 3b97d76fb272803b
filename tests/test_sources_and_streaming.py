"""Readers, writers, the end-to-end run and the streaming jobs."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import clean
from ledgerflow.plans import treasury
from ledgerflow.sources import catalog, quality, sinks
from ledgerflow.sources.events import event_ledger
from ledgerflow.streaming.alerting import BatchAlerts, run_alerts
from ledgerflow.streaming.daily import daily_flows, read_events, run_daily


def write_text(path, text):
    path.write_text(text)


def test_csv_order_decides_which_copy_survives(spark, tmp_path):
    lines = ["movement_id,date,value_date,description,amount,balance_after,category,reference,bank_account"]
    lines += [f"m{i % 50},2024-01-01,,copy {i},1,1,,," for i in range(500)]
    write_text(tmp_path / "bank_movements.csv", "\n".join(lines))
    write_text(tmp_path / "suppliers.csv", "supplier_id,name,category,payment_cycle\nS1,n,,net\n")
    found = catalog.read_catalog(spark, str(tmp_path))
    assert sorted(found) == ["bank_movements", "suppliers"]
    kept = clean.clean_bank_movements(found["bank_movements"]).select("movement_id", "description").collect()
    assert {r.movement_id: r.description for r in kept} == {f"m{i}": f"copy {i}" for i in range(50)}


def test_missing_dataset_is_an_empty_typed_frame(spark, tmp_path):
    assert catalog.read_dataset(spark, "invoices", str(tmp_path)) is None
    assert catalog.read_catalog(spark, f"{tmp_path}/absent") == {}
    empty = catalog.read_or_empty(spark, "cash_flow_daily", str(tmp_path), fmt="parquet")
    assert empty.count() == 0 and empty.schema["date"].dataType.simpleString() == "date"
    assert catalog.read_or_empty(spark, "employees", str(tmp_path)).columns[0] == "employee_id"


def test_schema_check_names_the_missing_column(spark):
    df = spark.createDataFrame([("E1", "n", "x")], "employee_id string, name string, shoe_size string")
    row = quality.check_schema("employees", df).first()
    assert (row.valid, row.missing_required, row.extra_columns) == (False, ["department", "salary"], ["shoe_size"])
    assert quality.check_schema("unknown", df).first().valid


def test_outliers_exact_and_approximate(spark):
    df = spark.createDataFrame([(float(v),) for v in [*range(100), 1000]], "v double")
    assert quality.outlier_counts(df).first().outliers == 1
    assert quality.outlier_counts(df, method="approximate").first().outliers == 1
    with pytest.raises(ValueError):
        quality.outlier_counts(df, method="guess")


def test_duplicate_key_stops_the_table_load(spark, tmp_path):
    df = spark.createDataFrame([("I1",), ("I1",)], "invoice_id string")
    with pytest.raises(ValueError):
        sinks.load_table(spark, df, "invoices", str(tmp_path))
    assert not os.path.exists(tmp_path / "invoices")


def test_rows_append(spark, tmp_path):
    rows = [("mae", 1.5, None), ("rmse", 2.5, None)]
    sinks.append_rows(spark, rows, "model_metrics", str(tmp_path))
    assert sinks.append_rows(spark, rows[:1], "model_metrics", str(tmp_path)).count() == 3


def test_model_config_document(spark, tmp_path):
    from ledgerflow.config import ModelConfig

    sinks.save_json(sinks.config_document(spark, ModelConfig()), f"{tmp_path}/config.json")
    row = spark.read.json(f"{tmp_path}/config.json").first()
    assert (row.growth, row.seasonality_mode, row.changepoint_prior_scale) == ("linear", "multiplicative", 0.05)


def test_end_to_end_run(spark, fx, tmp_path):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    sinks.save_processed({n: d.drop("load_seq") for n, d in fx.raw().items()}, raw, "csv")
    result = treasury.run(spark, raw, out, date(1998, 6, 1))
    assert result.kpis.count() == 1 and result.rules.count() == 6
    assert result.forecast.agg(F.max("ds")).first()[0] > result.daily.agg(F.max("date")).first()[0]
    assert spark.read.json(f"{out}/models/model_metrics.json").count() == 1
    assert spark.read.json(f"{out}/models/model_config.json").count() == 1
    assert spark.read.json(f"{out}/models/forecast_summary.json").count() == 1
    assert spark.read.parquet(f"{out}/quality/validation_report.parquet").where("section LIKE 'R3%'").count() > 0
    assert "invoices" in os.listdir(f"{out}/tables")
    assert set(os.listdir(f"{out}/bi")) == {"cash_flow_daily.csv", "forecast_results.csv", "kpis.csv"}


def test_dirty_csv_is_read_and_written_as_other_tools_do(spark, tmp_path):
    import csv

    rows = [("m1", 'Pago "urgente", SA', "10"), ("m2", "two\nlines, \"and\" commas", "20"), ("m3", "plain", "30"), ("m4", "", "")]
    os.makedirs(tmp_path / "in")
    with open(tmp_path / "in" / "bank.csv", "w", newline="", encoding="utf-8") as file:
        csv.writer(file).writerows([("movement_id", "description", "amount"), *rows])
    found = catalog.read_catalog(spark, str(tmp_path / "in"), multi_line=True)["bank"]
    want = [tuple(c or None for c in r) for r in rows]
    assert sorted(tuple(r) for r in found.drop("load_seq").collect()) == sorted(want, key=str)
    sinks.save_processed({"bank": found.drop("load_seq").coalesce(1)}, str(tmp_path / "out"), "csv")
    part = next(p for p in (tmp_path / "out" / "bank.csv").iterdir() if p.suffix == ".csv")
    with open(part, newline="", encoding="utf-8") as file:
        assert sorted(csv.reader(file)) == sorted([["movement_id", "description", "amount"], *map(list, rows)])


def test_failed_key_check_leaves_the_named_table(spark, tmp_path):
    good = spark.createDataFrame([("I1",)], "invoice_id string")
    sinks.load_table(spark, good, "invoices", str(tmp_path), database="ledger_test")
    with pytest.raises(ValueError):
        sinks.load_table(spark, good.union(good), "invoices", str(tmp_path), database="ledger_test")
    assert [r.invoice_id for r in spark.sql("SELECT invoice_id FROM ledger_test.invoices").collect()] == ["I1"]
    spark.sql("DROP DATABASE ledger_test CASCADE")


def test_stored_tables_follow_their_source_files(spark, tmp_path):
    from ledgerflow.sources.shared import stored_once

    source = str(tmp_path / "in")
    for n in (3, 5):
        spark.range(n).write.mode("overwrite").parquet(f"{source}/t.parquet")
        got = stored_once(spark, ("probe", source), lambda: spark.read.parquet(f"{source}/t.parquet"))
        assert got.count() == n


def two_accounts(spark):
    rows, seq = [], 0
    for account, opening in (("A", 1_000_000), ("B", 0)):
        balance = opening
        for i in range(120):
            amount = 50 if i % 3 else -20
            balance += amount
            seq += 1
            rows.append((f"{account}{i:03d}", account, f"2024-{1 + i // 28:02d}-{1 + i % 28:02d}", amount, balance, "supplier", seq))
    df = spark.createDataFrame(rows, "movement_id string, bank_account string, date string, amount int, balance_after int, category string, load_seq bigint")
    return df.withColumns({"date": F.col("date").cast("date"), "amount": F.col("amount").cast("decimal(18,2)"), "balance_after": F.col("balance_after").cast("decimal(18,2)")})


def test_accounts_end_to_end(spark):
    from ledgerflow.operators import rules

    bank = two_accounts(spark)
    results = rules.r3_balance(bank, keys=["bank_account"]).collect()
    assert {r.bank_account: (r.status, r.metrics["balance_monotonic"]) for r in results} == {"A": ("PASS", 1), "B": ("PASS", 1)}
    for model in ("full", "base"):
        done = treasury.plan({"bank_clean": bank}, model=model)
        assert {r.bank_account: float(r.current_cash_balance) for r in done.kpis.collect()} == {"A": 1_003_200.0, "B": 3_200.0}
        low = done.daily.groupBy("bank_account").agg(F.min("cash_balance").alias("m")).collect()
        assert {r.bank_account: r.m > 900_000 for r in low} == {"A": True, "B": False}
        assert done.forecast.groupBy("bank_account").count().count() == 2
        assert done.report.count() == 2


def split_events(spark, small, folder, cut):
    events = spark.read.parquet(f"{small}/events.parquet")
    ranges = [F.col("ts") < cut, F.col("ts") >= cut]
    for i, rows in enumerate(ranges):
        events.where(rows).coalesce(1).write.parquet(f"{folder}/part{i}")
    return events


def test_two_batches_equal_the_batch_result_on_closed_days(spark, small, tmp_path):
    events = split_events(spark, small, f"{tmp_path}/in", "2024-01-15")
    os.makedirs(f"{tmp_path}/arriving")
    target, state = f"{tmp_path}/days", f"{tmp_path}/state"
    for i in range(2):
        part = [f for f in os.listdir(f"{tmp_path}/in/part{i}") if f.endswith(".parquet")][0]
        os.link(f"{tmp_path}/in/part{i}/{part}", f"{tmp_path}/arriving/{i}-{part}")
        done = run_daily(read_events(spark, f"{tmp_path}/arriving", events.schema), target, state)
    last = events.agg(F.max("ts")).first()[0].date()
    want = daily_flows(event_ledger(events)).where(F.col("date") < F.date_sub(F.lit(last), 1))
    closed = done.where(F.col("date") < F.date_sub(F.lit(last), 1))
    assert closed.count() > 0
    assert want.exceptAll(closed).count() == 0 and closed.exceptAll(want).count() == 0


def test_late_and_repeated_movements(spark, tmp_path):
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double"

    def arrive(i, rows):
        df = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    source = f"{tmp_path}/in"
    read = lambda: read_events(spark, source, spark.createDataFrame([], schema).schema)
    arrive(0, [(1, "2024-01-01 10:00:00", 1, "purchase", 5.0), (1, "2024-01-01 10:00:00", 1, "purchase", 5.0)])
    run_daily(read(), f"{tmp_path}/days", f"{tmp_path}/state")
    arrive(1, [(2, "2024-01-01 23:00:00", 1, "click", 2.0), (1, "2024-01-01 10:00:00", 1, "purchase", 5.0)])
    run_daily(read(), f"{tmp_path}/days", f"{tmp_path}/state")
    arrive(2, [(3, "2024-01-05 00:00:00", 1, "purchase", 1.0)])
    rows = run_daily(read(), f"{tmp_path}/days", f"{tmp_path}/state").collect()
    assert [(str(r.date), float(r.net_cash), r.transaction_count) for r in rows] == [("2024-01-01", 3.0, 2)]


def test_replayed_alert_batch_is_logged_once(spark, small, tmp_path):
    batch = event_ledger(spark.read.parquet(f"{small}/events.parquet"))
    handler = BatchAlerts(str(tmp_path), opening=1000)
    handler(batch, 0)
    first = spark.read.parquet(handler.alerts_path).drop("triggered_at").collect()
    handler(batch, 0)
    again = spark.read.parquet(handler.alerts_path).drop("triggered_at").collect()
    assert sorted(first) == sorted(again) and first


def test_alert_stream(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    log = run_alerts(read_events(spark, small, schema, "events.parquet"), f"{tmp_path}/a", f"{tmp_path}/s")
    assert {r.alert_code for r in log.select("alert_code").distinct().collect()} >= {"A1"}


class _Held:
    """A value state of one account, in memory."""

    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


def test_week_of_balances_equals_a_full_recount():
    import random

    import pandas as pd

    from ledgerflow.streaming.keyed_alerts import WeekOfBalances

    rng = random.Random(11)
    for _ in range(60):
        state = WeekOfBalances(500)
        state.state = _Held()
        seen, at = {}, 100
        for _ in range(8):
            at += rng.choice([0, 1, 2, 5, 30])
            rows = [(at - rng.choice([0, 0, 1, 3, 6, 7, 20]), rng.randrange(-900, 900)) for _ in range(rng.randrange(1, 6))]
            for day, cents in rows:
                seen[day] = seen.get(day, 0) + cents
            frames = [pd.DataFrame(rows[:2], columns=["day", "cents"]), pd.DataFrame(rows[2:], columns=["day", "cents"])]
            (found,) = state.handleInputRows(("a",), iter(frames), None)
            last = max(seen)
            old = 500 + sum(c for d, c in seen.items() if d <= last - 6) if last - 6 >= min(seen) else None
            row = found.iloc[0]
            assert (row.day, row.current_cents) == (last, 500 + sum(seen.values()))
            assert (None if pd.isna(row.old_cents) else row.old_cents) == old


def test_keyed_alerts_read_nothing_again(spark, small, tmp_path):
    """A second run with the same checkpoint sees new files only, logs nothing twice, and carries the balance on."""
    from datetime import datetime

    from ledgerflow.streaming.daily import read_events
    from ledgerflow.streaming.keyed_alerts import run_keyed_alerts

    schema = spark.read.parquet(f"{small}/events.parquet").schema
    fields = [f.name for f in schema.fields]

    def land(rows):
        full = [{**dict.fromkeys(fields), "event_id": i, "ts": datetime(2024, 1, d), "user_id": u, "event_type": "purchase", "value": v} for i, d, u, v in rows]
        spark.createDataFrame([tuple(r[f] for f in fields) for r in full], schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        log = run_keyed_alerts(read_events(spark, f"{tmp_path}/in", schema), f"{tmp_path}/log", f"{tmp_path}/cp", opening_cents=0)
        return sorted(tuple(r) for r in log.select("bank_account", F.col("date").cast("string"), "code", "message").collect())

    land([(1, 1, 1, 90_000.0), (2, 1, 2, 10.0)])
    first = run()
    assert first == [("ACC-2", "2024-01-01", "A1", "CASH BAJO: 10€ (min: 50,000€)")]
    for path in (tmp_path / "in").glob("*.parquet"):
        path.write_bytes(b"not to be opened again")
    assert run() == first
    land([(3, 9, 1, 5.0), (4, 9, 2, 1.5)])
    assert run() == [first[0], ("ACC-2", "2024-01-09", "A1", "CASH BAJO: 12€ (min: 50,000€)")]


@pytest.mark.parametrize(("line_end", "sent"), [("\n", 100_000), ("\r\n", 0)])
def test_one_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, monkeypatch, line_end, sent):
    import csv
    import random

    from ledgerflow.sources import quoted_csv

    monkeypatch.setattr(quoted_csv, "SENT_BLOCKS", sent)
    rng = random.Random(5)
    pieces = ["a", "x,y", 'q"q', "line\nbreak", '\n\n"",\n"', "", "é\r\nz", "w" * 5000, ",\n" * 900]
    rows = [[str(i), rng.choice(pieces), rng.choice(["", "b", '"'])] for i in range(300)]
    path = f"{tmp_path}/movements.csv"
    with open(path, "w", newline="", encoding="utf-8-sig") as file:
        writer = csv.writer(file, lineterminator=line_end)
        writer.writerow(["id", "text", "last"])
        writer.writerows(rows)
        file.write(f"77{line_end}{line_end}78,a,b,c{line_end}79,\"open{line_end}to the end")
    limits = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in limits}
    try:
        for k, v in limits.items():
            spark.conf.set(k, v)
        assert quoted_csv._lines(spark, path).rdd.getNumPartitions() > 4
        read = quoted_csv.read_quoted_csv(spark, path)
        got = {r.id: (r.text, r.last, r.malformed) for r in read.collect()}
        order = [r.id for r in read.orderBy("load_seq").collect()]
        counts = [tuple(r) for r in quoted_csv.malformed_counts(read).collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {k: (t or "", z or "", m) for k, (t, z, m) in got.items() if int(k) < 77 or 79 < int(k)} == {a: (b, c, False) for a, b, c in rows if int(a) < 77 or 79 < int(a)}
    assert got["77"] == (None, None, True) and got["78"] == ("a", "b", True) and got["79"][2] and got["79"][0].startswith("open")
    assert order[:300] == [r[0] for r in rows] and counts == [("movements.csv", 303, 3)]


ALERT = ("A1", "HIGH", "m", None, 0)


def test_append_counts_a_token_once_and_survives_a_crash(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    assert sinks.appended(spark, "alerts", folder).count() == 0
    assert sinks.append_rows(spark, [ALERT], "alerts", folder, "run-1").count() == 1
    assert sinks.append_rows(spark, [ALERT, ALERT], "alerts", folder, "run-1").count() == 1

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_put", crash)
        with pytest.raises(RuntimeError):
            sinks.append_rows(spark, [ALERT, ALERT], "alerts", folder, "run-2")
    assert sinks.appended(spark, "alerts", folder).count() == 1  # written, but not committed
    assert sinks.append_rows(spark, [ALERT, ALERT], "alerts", folder, "run-2").count() == 3
    assert sinks.append_rows(spark, [ALERT], "alerts", folder).count() == 4
    with pytest.raises(ValueError, match="not a token"):
        sinks.append_rows(spark, [ALERT], "alerts", folder, "../x")


def test_tables_of_a_load_appear_together(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    one = spark.createDataFrame([("D1",)], "deal_id string")
    two = spark.createDataFrame([("I1",)], "invoice_id string")
    sinks.load_tables(spark, {"crm_deals": one, "invoices": two}, folder)
    seen = []
    real = sinks._staged

    def watched(*args):
        real(*args)
        seen.append({n: df.count() for n, df in sinks.open_tables(spark, folder).items()})

    with monkeypatch.context() as patched:
        patched.setattr(sinks, "_staged", watched)
        sinks.load_tables(spark, {"crm_deals": one.union(spark.createDataFrame([("D2",)], "deal_id string")), "invoices": two.limit(0)}, folder)
    assert seen == [{"crm_deals": 1, "invoices": 1}] * 2
    assert {n: df.count() for n, df in sinks.open_tables(spark, folder).items()} == {"crm_deals": 2, "invoices": 0}
    with pytest.raises(ValueError, match="not unique"):
        sinks.load_tables(spark, {"invoices": two, "crm_deals": one.union(one)}, folder)
    assert {n: df.count() for n, df in sinks.open_tables(spark, folder).items()} == {"crm_deals": 2, "invoices": 0}
    assert sinks.load_table(spark, two, "invoices", folder).count() == 1
    assert {n: df.count() for n, df in sinks.open_tables(spark, folder).items()} == {"crm_deals": 2, "invoices": 1}
