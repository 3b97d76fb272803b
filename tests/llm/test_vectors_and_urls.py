import math
import random

import numpy as np
from compare import connect, difference
from pyspark.sql import functions as F

from ledgerflow.llm import op2_topk, op6_url_ratio


def test_top_k_equals_sql(spark, small):
    assert difference(op2_topk.op2_topk(spark, small), connect(small), op2_topk.ORACLE_SQL) is None


def test_top_k_with_ties_odd_vectors_and_small_blocks(spark):
    rng = random.Random(1)
    rows = [(i, [rng.choice([-2.0, 0.5, 1.0, 3.0]) * (1 + i % 9) for _ in range(40)]) for i in range(160)]
    rows += [(200, None), (220, [None, 1.0]), (240, [math.nan]), (260, [math.inf]), (0, [1.0, 1.0]), (None, [3.0, 3.0]), (40, []), (20, [6.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    got = [tuple(r) for r in op2_topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, chunk_rows=20, seeds=10).collect()]
    ok = [(i, [math.floor(64 * x) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    want = []
    for a, (q, v) in enumerate(ok):
        if q is None or q % 20:
            continue
        found = sorted((-sum(x * y for x, y in zip(v, w, strict=False)), c is None, c or 0) for b, (c, w) in enumerate(ok) if b != a)[:7]
        want += [(q, k + 1, None if none else c, -s) for k, (s, none, c) in enumerate(found)]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert op2_topk.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_in_several_query_blocks_beside_clashing_columns(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (1 + i % 11) for _ in range(24)], i, i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, rid bigint, chunk bigint, part bigint").repartition(4)
    held = {r.vec_id: [math.floor(64 * x) for x in r.embedding] for r in df.collect()}
    got = [tuple(r) for r in op2_topk.top_k(df, F.col("vec_id") % 3 == 0, k=5, chunk_rows=40, seeds=60, query_block=7).collect()]
    want = []
    for q in range(0, 300, 3):
        found = sorted((-sum(x * y for x, y in zip(held[q], w, strict=True)), c) for c, w in held.items() if c != q)[:5]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(found)]
    assert sorted(got) == sorted(want)


def test_top_k_bounds_drop_pairs_before_the_full_score():
    rng = np.random.default_rng(3)
    v = np.floor(rng.normal(0, 1, (6000, 64)) * np.geomspace(200, 1, 64) * rng.uniform(0.2, 1, (6000, 1)))
    rotation = np.linalg.eigh(v.T @ v)[1][:, ::-1].copy()
    c = op2_topk.Candidates(np.arange(6000), list(range(6000)), v, rotation)
    ask, place, _, scored = op2_topk.best(v[:100], np.arange(100), np.full(100, -math.inf), rotation, c, 5)
    assert scored < 0.5 * 100 * 6000
    scores = v[:100] @ v.T
    scores[np.arange(100), np.arange(100)] = -math.inf
    for i in range(100):
        found = np.sort(scores[i, c.rid[place[ask == i]]])[::-1][:5]
        assert np.array_equal(found, np.sort(scores[i])[::-1][:5])


def test_top_k_keeps_vectors_of_great_length(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-2.0, 0.5, 1.0, 3.0]) * (1 + i % 9) for _ in range(40)]) for i in range(160)]
    # of great length, also beyond 2^53 in the score, and apart by less than a 64-bit float's rounding
    rows += [(500, [1e6] * 40), (501, [-65536.0] * 40), (502, [2.0**23] * 40), (503, [2.0**23] * 39 + [2.0**23 + 1]), (520, [2.0**19 + 1] * 40)]
    rows += [(504, [2.0**28] + [0.0] * 39), (505, [2.0**28] + [0.0] * 38 + [1 / 64]), (540, [2.0**13] + [0.0] * 38 + [1 / 64])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3, "vec_id")
    got = [tuple(r) for r in op2_topk.top_k(df, F.col("vec_id") % 20 == 0, k=7, chunk_rows=20, seeds=10).collect()]
    held = {r.vec_id: [math.floor(64 * x) for x in r.embedding] for r in df.collect()}
    want = []
    for q in (i for i in held if i % 20 == 0):
        found = sorted((-sum(x * y for x, y in zip(held[q], w, strict=True)), c) for c, w in held.items() if c != q)[:7]
        want += [(q, k + 1, c, -s) for k, (s, c) in enumerate(found)]
    assert sorted(got) == sorted(want)


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "HTTP://A.Com", "x://WWW.example.com/en/?a", "://net/es/", "a://b.net/fr/x#y", "7://Example.COM/en/a/b?://", "a://xexample.com/en/", "a://q.org?x/y"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id bigint, url string")
    got = {r.page_id: (r.host, r.path, r.rule) for r in op6_url_ratio.judge(df).collect()}
    assert got == {
        0: ("", "", None),
        1: ("", "", None),
        2: ("a.com", "", None),
        3: ("www.example.com", "/en/", "www.example.com/en/"),
        4: ("net", "/es/", "net/es/"),
        5: ("b.net", "/fr/x", "net/fr/"),
        6: ("example.com", "/en/a/b", "example.com/en/"),
        7: ("xexample.com", "/en/", "com/"),
        8: ("q.org", "", None),
    }


def test_ratio_tells_unseen_urls_apart(spark):
    rng = random.Random(3)
    rows = []
    for i in range(1200):
        good = i % 2 == 0
        word = rng.choice(["garden", "school", "library", "museum"] if good else ["casino", "cheap", "pills", "bets"])
        host, path = (f"{word}{rng.randrange(99)}.com", "/a") if good else (f"{word}{rng.randrange(99)}.net", "/es/")
        rows.append((i, f"http://{host}{path}{rng.randrange(999)}"))
    fresh = [(5000 + i, f"http://{w}{i}.org/en/{i}") for i, w in enumerate(["garden", "library", "casino", "pills"])]
    df = spark.createDataFrame(rows + fresh, "page_id bigint, url string")
    verdict = {r.page_id: r.verdict for r in op6_url_ratio.judge(df).where("page_id >= 5000").collect()}
    assert verdict == {5000: "allow", 5001: "allow", 5002: "block", 5003: "block"}


def test_no_labelled_class_and_empty_table(spark):
    df = spark.createDataFrame([(1, "http://a.org/x"), (1, "http://a.org/x")], "page_id bigint, url string")
    assert [r.verdict for r in op6_url_ratio.judge(df).collect()] == ["allow", "allow"]
    assert op6_url_ratio.judge(df.where("false")).count() == 0


def test_judge_with_repeated_rows_very_long_urls_and_clashing_columns(spark):
    rng = random.Random(4)
    rows = [(i, f"http://{rng.choice(['garden', 'museum'])}{i}.com/a") for i in range(0, 400, 2)]
    rows += [(i, f"http://{rng.choice(['casino', 'pills'])}{i}.net/es/") for i in range(1, 400, 2)]
    long = "http://museum.org/" + "garden" * 40_000
    rows += [(900, long), (900, long), (901, "http://pills.org/casino"), (901, "http://pills.org/casino"), (902, None), (903, "")]
    plain = spark.createDataFrame(rows, "page_id bigint, url string")
    clash = plain.select("page_id", "url", *[F.lit("other").alias(c) for c in ("host", "path", "rule", "ratio", "verdict", "kept")])
    columns = ["page_id", "host", "path", "rule", "ratio", "verdict"]
    want = sorted((tuple(r) for r in op6_url_ratio.judge(plain).select(columns).collect()), key=str)
    judged = op6_url_ratio.judge(clash)
    assert sorted((tuple(r) for r in judged.select(columns).collect()), key=str) == want
    assert {r.kept for r in judged.select("kept").distinct().collect()} == {"other"}
    assert len(want) == len(rows)
    by_id = {}
    for r in want:
        by_id.setdefault(r[0], []).append(r[1:])
    assert by_id[900][0] == by_id[900][1] and by_id[900][0][4] == "allow" and len(by_id[900][0][1]) == 240_001
    assert by_id[901][0] == by_id[901][1] and by_id[901][0][4] == "block"
    assert by_id[902][0][:3] == by_id[903][0][:3] == ("", "", None)
