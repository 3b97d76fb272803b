"""Chunked running totals, look-back and quantiles against plain Python."""

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import ordered
from ledgerflow.operators.ordered import exact_quantiles, previous_values, row_numbers, running_totals


SPLITS = {
    "range partitions as they are": {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
    "partitions merged at run time": {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1k",
    },
}


@pytest.fixture(params=SPLITS)
def many_chunks(request, spark):
    """Keep small data in several range partitions, so that a series spans chunks."""
    before = {name: spark.conf.get(name) for name in SPLITS[request.param]}
    for name, value in SPLITS[request.param].items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def ledger(n=2000, hot=0.6, seed=1):
    draw = random.Random(seed)
    return [
        ("hot" if draw.random() < hot else f"acc{draw.randrange(40)}", i, draw.choice([None, draw.randrange(-50, 50)]))
        for i in draw.sample(range(10 * n), n)
    ]


def test_running_total_of_a_hot_account_spans_chunks(spark, many_chunks):
    rows = ledger()
    df = spark.createDataFrame(rows, "acc string, seq int, amount int").repartition(7)
    got = {
        (r.acc, r.seq): r.total
        for r in running_totals(df, ["acc"], ["seq"], {"total": F.col("amount")}).collect()
    }
    want = {}
    for acc, group in itertools.groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[0]):
        total = 0
        for _, seq, amount in group:
            total += amount or 0
            want[acc, seq] = total
    assert got == want


def test_single_series_without_keys(spark, many_chunks):
    rows = [(i, (i * 7) % 11 - 5) for i in range(500)]
    df = spark.createDataFrame(rows, "seq int, amount int").repartition(5)
    got = [r.total for r in running_totals(df, [], ["seq"], {"total": F.col("amount")}).orderBy("seq").collect()]
    assert got == list(itertools.accumulate(a for _, a in rows))
    numbers = [r.n for r in row_numbers(df, [], ["seq"], "n").orderBy("seq").collect()]
    assert numbers == list(range(1, 501))


def test_null_series_is_a_series(spark, many_chunks):
    df = spark.createDataFrame([(None, i, 1) for i in range(300)] + [("a", i, 2) for i in range(10)], "acc string, seq int, amount int")
    got = running_totals(df, ["acc"], ["seq"], {"total": F.col("amount")})
    ends = {r.acc: r.end for r in got.groupBy("acc").agg(F.max("total").alias("end")).collect()}
    assert ends == {None: 300, "a": 20}


def test_previous_values_cross_chunk_borders(spark, many_chunks):
    rows = ledger(seed=2)
    df = spark.createDataFrame(rows, "acc string, seq int, amount int").repartition(6)
    got = {(r.acc, r.seq): (r.prev_seq, r.prev_amount) for r in previous_values(df, ["acc"], ["seq"], ["seq", "amount"]).collect()}
    want = {}
    for acc, group in itertools.groupby(sorted(rows, key=lambda r: r[:2]), key=lambda r: r[0]):
        before = (None, None)
        for _, seq, amount in group:
            want[acc, seq] = before
            before = (seq, amount)
    assert got == want


def test_chunks_are_really_several(spark, many_chunks):
    from ledgerflow.operators.ordered import CHUNK, chunked

    df = spark.createDataFrame(ledger(), "acc string, seq int, amount int")
    assert chunked(df, ["acc"], ["seq"]).where("acc = 'hot'").select(CHUNK).distinct().count() > 2


@pytest.mark.parametrize("size", [1, 2, 3, 4, 101, 1000])
def test_exact_quantiles_equal_numpy(spark, size):
    draw = random.Random(size)
    values = [("c", draw.choice([draw.random() * 100, 7.0, -3.0])) for _ in range(size)]
    df = spark.createDataFrame(values + [("c", None)], "column string, value double")
    row = exact_quantiles(df, ["column"], "value", [0.25, 0.5, 0.75]).first()
    want = np.quantile([v for _, v in values], [0.25, 0.5, 0.75])
    assert np.allclose([row.q0, row.q1, row.q2], want)


@pytest.mark.parametrize("size", [1, 2, 5, 1000, 30000])
def test_bracketed_column_quantiles_equal_numpy(spark, size):
    from ledgerflow.sources.quality import column_quantiles

    draw = random.Random(size)
    rows = [(draw.gauss(0, 50), draw.choice([1, 2, 2, 2, 9]), None) for _ in range(size)]
    df = spark.createDataFrame(rows, "a double, b int, c double").repartition(6)
    got = {r.column: [r.q0, r.q1] for r in column_quantiles(df, ["a", "b", "c"], [0.25, 0.75]).collect()}
    assert set(got) == {"a", "b"}
    for i, c in enumerate("ab"):
        assert np.allclose(got[c], np.quantile([r[i] for r in rows], [0.25, 0.75]))


@pytest.mark.parametrize("accuracy", [20, 100])
def test_column_quantiles_of_many_ties_and_coarse_sketches(spark, accuracy):
    from ledgerflow.sources.quality import column_quantiles

    draw = random.Random(accuracy)
    rows = [(draw.choice([1.0, 2.0, 2.0, 50.0]), draw.gauss(0, 1), draw.choice([-0.0, 0.0, float(draw.randrange(9))])) for _ in range(5000)]
    df = spark.createDataFrame(rows, "a double, b double, c double").repartition(5)
    levels = [0.0, 0.25, 0.5, 0.75, 1.0]
    for r in column_quantiles(df, ["a", "b", "c"], levels, accuracy).collect():
        assert np.allclose([r[f"q{i}"] for i in range(5)], np.quantile([x["abc".index(r.column)] for x in rows], levels))


def test_missed_bracket_falls_back_to_ranking_all_values(spark, monkeypatch):
    from ledgerflow.sources import quality

    monkeypatch.setattr(quality.F, "percentile_approx", lambda c, p, a: quality.F.array(*[quality.F.lit(-1.0)] * len(p)))
    df = spark.range(1, 101).select(F.col("id").cast("double").alias("a"))
    row = quality.column_quantiles(df, ["a"], [0.25, 0.75]).first()
    assert (row.q0, row.q1) == (25.75, 75.25)


def days(n=3000, seed=5):
    draw = random.Random(seed)
    day = lambda: draw.choice([None, *range(12)])
    return [(draw.choice([None, "a", "b"]), day(), draw.choice([None, f"m{i}"]) if i == 7 else f"m{i}", draw.choice([None, draw.randrange(-50, 50)])) for i in range(n)]


@pytest.mark.parametrize("most", [10**6, 50])  # 50: every day is too large, the plain way is taken
def test_blocks_give_what_chunks_give(spark, monkeypatch, most):
    monkeypatch.setattr(ordered, "PART_ROWS", 100)
    monkeypatch.setattr(ordered, "BLOCK_ROWS", most)
    df = spark.createDataFrame(days(), "acc string, day int, id string, amount int").repartition(7)
    totals = {"total": F.col("amount"), "n": F.lit(1)}
    want = running_totals(df, ["acc"], ["day", "id"], totals)
    got = running_totals(df, ["acc"], ["day", "id"], totals, ["day"])
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    before = previous_values(df, ["acc"], ["day", "id"], ["amount", "id"])
    assert sorted(map(str, previous_values(df, ["acc"], ["day", "id"], ["amount", "id"], ["day"]).collect())) == sorted(map(str, before.collect()))


def test_blocks_deal_the_rows_once_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 100)
    stored = []
    monkeypatch.setattr(ordered, "store", lambda df, name, plain=ordered.store: stored.append(name) or plain(df, name))
    df = spark.createDataFrame(days(), "acc string, day int, id string, amount int").localCheckpoint()
    found = running_totals(df, ["acc"], ["day", "id"], {"total": F.col("amount")}, ["day"])
    assert stored == ["blocks"]  # no copy of the rows is written
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange rangepartitioning") == 1 and "rangepartitioning(acc#" in plan
    assert found.rdd.getNumPartitions() > 8  # 3000 rows, whatever the shuffle setting


def test_rows_are_dealt_unsorted_while_partitions_stay_small(spark, monkeypatch):
    monkeypatch.setattr(ordered, "PART_ROWS", 5)  # 600 partitions of 3000 rows; from 201 on Spark holds and sorts a split before it writes it
    monkeypatch.setattr(ordered, "GROUP_ROWS", 5)
    df = spark.createDataFrame(days(), "acc string, day int, id string, amount int").localCheckpoint()
    totals = {"total": F.col("amount")}
    found = running_totals(df, ["acc"], ["day", "id"], totals, ["day"])
    assert ", 200), REPARTITION_BY_NUM" in found._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(str, found.collect())) == sorted(map(str, running_totals(df, ["acc"], ["day", "id"], totals).collect()))
    assert ordered.dealt(df, ["id"]).rdd.getNumPartitions() == 200
    monkeypatch.setattr(ordered, "FULL_ROWS", 10)  # unless partitions get too large by it
    assert ordered.dealt(df, ["id"]).rdd.getNumPartitions() == 300


def test_ledger_of_movements_seen_later_and_repeated(spark, tmp_path):
    from datetime import datetime

    from ledgerflow.plans.fixtures import Fixtures

    orders = [(k, 1, "F", 121.0 + k, datetime(1995, 1, 1 + k % 20), "1-URGENT") for k in [77, 77, 77, 177, 1, 2, 3, 77, 1]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(5, 2, 77, 1, 10.0, "N", datetime(1995, 1, 3)), (5, 2, 8, 1, 11.0, "R", datetime(1995, 1, 3)), (5, 2, 8, 1, 1.0, "N", datetime(1995, 2, 9))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    rows = Fixtures(spark, str(tmp_path)).bank().collect()
    assert len(rows) == 11 and sorted(r.load_seq for r in rows) == list(range(1, 12))
    total, balances = 450000, []
    for r in sorted(rows, key=lambda r: (r.date, r.movement_id)):
        total += r.amount
        balances.append(total)
    assert sorted(balances) == sorted(r.balance_after for r in rows)
    from datetime import timedelta

    seen = [(r.date + timedelta(30 if r.movement_id.endswith("77") else 0), r.movement_id) for r in sorted(rows, key=lambda r: r.load_seq)]
    assert seen == sorted(seen)


def test_bank_ledger_is_dealt_and_summed_once(spark, monkeypatch, tmp_path):
    from datetime import datetime

    from ledgerflow.plans import fixtures

    orders = [(k, 1, "F", 121.0 + k, datetime(1995, 1, 1 + k % 20), "1-URGENT") for k in [77, 177, 1, 2, 77]]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(5, 2, 77, 1, 10.0, "N", datetime(1995, 1, 3)), (5, 2, 8, 1, 11.0, "R", datetime(1995, 1, 3))]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    monkeypatch.setattr(ordered, "PART_ROWS", 3)
    plans = []

    def watched(spark, key, build, plain=fixtures.stored_once):
        def built():
            df = build()
            plans.append(df._jdf.queryExecution().executedPlan().toString())
            return df

        return plain(spark, key, built)

    monkeypatch.setattr(fixtures, "stored_once", watched)
    ledger = fixtures.Fixtures(spark, str(tmp_path)).bank()
    plans.append(ledger._jdf.queryExecution().executedPlan().toString())
    assert sum(p.count("Exchange rangepartitioning") for p in plans) == 1  # two branches read and sort the dealt rows twice
    assert "Exchange" not in plans[-1] and "Window" not in plans[-1]
    rows = sorted(ledger.collect(), key=lambda r: r.load_seq)
    assert [r.load_seq for r in rows] == list(range(1, 8)) and [r.movement_id[-2:] for r in rows[3:]] == ["77"] * 4
    assert len({r.balance_after for r in rows}) == 7


def test_movements_are_grouped_in_partitions_by_their_number(spark, monkeypatch, tmp_path):
    from datetime import datetime

    from ledgerflow.plans.fixtures import Fixtures

    monkeypatch.setattr(ordered, "GROUP_ROWS", 100, raising=False)
    orders = [(1, 1, "F", 121.0, datetime(1995, 1, 1), "1-URGENT")]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(k // 2 if k % 5 else None, k // 2, 7, 1, 10.0 + k, "NR"[k % 3 == 0], datetime(1995, 1, 1 + k % 9)) for k in range(3000)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_returnflag string, l_shipdate timestamp").write.parquet(f"{tmp_path}/lineitem.parquet")
    base = Fixtures(spark, str(tmp_path)).bank_base().where("movement_id LIKE 'S-%'")
    plan = base._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and ", 30), REPARTITION_BY_NUM" in plan  # not 8, the shuffle setting
    want = {}
    for order, part, supplier, number, price, flag, day in lines:
        key = "-".join(str(c) for c in ("S", order, number, part, supplier) if c is not None)
        paid, first = want.get(key, (0, day))
        want[key] = paid + (-price if flag == "R" else price), min(first, day)
    got = {r.movement_id: (-float(r.amount), r.date) for r in base.collect()}
    assert got == {key: (paid, day.date()) for key, (paid, day) in want.items()}
