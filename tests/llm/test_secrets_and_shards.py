import base64
import math
import random

import numpy as np
from brute import base_secrets
from pyspark.sql import functions as F

from ledgerflow.llm import op1_secrets, op3_hilbert

PARTS = ["token", "Secret", " ", ":", "=", '"', "😀", "é", "password", "apikey", "api_key", "AKIA", "ABCDEF123456", "0123456789abcdef", "abcdefgh", "x", ".", "\n", "API-KEY"]


def spelled(text):
    return ",".join(f"{op1_secrets.KINDS[k]}:{s}:{e}" for s, k, e in base_secrets(text))


def test_base_spans_equal_brute_force(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(50))) for _ in range(250)]
    texts += [None, "", "token:abcdefgh " * 700, "token=password=abcdefgh", "token: secret : abcdefghij"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = op1_secrets.find_secrets(df).select("doc_id", op1_secrets.spelled(F.filter("secrets", lambda s: s["kind"] < 3)).alias("s"))
    assert {r.doc_id: r.s for r in found.collect()} == {i: spelled(t) for i, t in enumerate(texts)}


def test_random_runs_are_found_and_structured_ones_are_not(spark):
    rng = random.Random(11)
    keys = [base64.b64encode(bytes(rng.randrange(256) for _ in range(36))).decode() for _ in range(60)] + [f"{rng.getrandbits(160):040x}" for _ in range(60)]
    plain = [f"chapter{i}-introduction-to-the-theory-of-words" for i in range(60)] + [f"aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa{i}" for i in range(60)]
    df = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(keys + plain)], "doc_id bigint, text string")
    spans = {r.doc_id: r.spans for r in op1_secrets.find_secrets(df).select("doc_id", op1_secrets.spelled(F.col("secrets")).alias("spans")).collect()}
    hit = {i for i, s in spans.items() if "random:4:" in s}
    assert len(hit & set(range(120))) >= 108
    assert not hit & set(range(120, 240))


def test_redaction_masks_and_keeps_rows(spark, odd_documents):
    rows = [(1, 'a token = "0123456789abcdef0123456789abcdef" b', 46), (2, "clean", 5), (3, None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint")
    out = {r.doc_id: (r.text, r.n_chars) for r in op1_secrets.redact(df).collect()}
    assert out == {1: ('a <secret>" b', 13), 2: ("clean", 5), 3: (None, None)}
    clean = op1_secrets.redact(odd_documents)
    assert clean.dtypes == odd_documents.dtypes
    assert sorted(map(str, clean.collect())) == sorted(map(str, odd_documents.collect()))


def test_secret_scan_is_native_and_handles_empty_tables(spark, no_documents):
    plan = op1_secrets.find_secrets(no_documents)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert op1_secrets.find_secrets(no_documents).count() == 0
    assert op1_secrets.redact(no_documents).count() == 0


def test_hilbert_index_visits_neighbours():
    grid = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    index = op3_hilbert.hilbert_index(grid, 3)
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(index)], axis=0)).sum(1) == 1).all()


def check_shards(rows, n):
    size = [0] * op3_hilbert.SHARDS
    for r in rows:
        size[r.shard] += 1
    assert len(rows) == n and max(size) - min(size) <= 1
    assert sorted((r.shard, r.slot) for r in rows) == [(s, i) for s in range(op3_hilbert.SHARDS) for i in range(size[s])]
    curve = [r.curve for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert curve == sorted(curve)


def test_shards_follow_the_curve_and_differ_by_one_row(spark, odd_documents, no_documents):
    rng = random.Random(2)
    rows = [(i, "x" * rng.choice([1, 5, 900]), rng.choice(["en", "de", None]), rng.choice(["hot", "hot", f"s{i % 7}"]), 1) for i in range(530)] + [(1, "x", "en", "hot", 1)] * 200
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5, "doc_id")
    check_shards(op3_hilbert.hilbert_shards(df).collect(), 730)
    check_shards(op3_hilbert.hilbert_shards(odd_documents).collect(), 9)
    assert op3_hilbert.hilbert_shards(no_documents).count() == 0


def test_written_shards_prune_by_language(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    op3_hilbert.write_shards(docs, str(tmp_path / "shards"))
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert back.drop("shard", "slot").exceptAll(docs.select(*back.drop("shard", "slot").columns)).count() == 0
    assert back.count() == docs.count()
    # a curve keeps a language together: it lies in fewer shards than rows dealt at random would
    assert back.where("lang = 'es'").select("shard").distinct().count() <= 16


def random_spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: [(s.start, s.stop) for s in r.secrets if s.kind == 3] for r in op1_secrets.find_secrets(df).select("doc_id", "secrets").collect()}


def test_keys_after_a_name_or_in_a_path_are_tested(spark):
    rng = random.Random(23)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"

    def key(n, symbols=letters):
        while True:
            k = "".join(rng.choice(symbols) for _ in range(n))
            if any(c.isdigit() for c in k) and any(c.isalpha() for c in k):
                return k

    around = [("AWS_SECRET_ACCESS_KEY=", " x"), ("?sig=", "&a=b"), ("https://a.example/x?key=", ""), ("--auth=", ""), ("https://a.example/my-hook/in_use/", "/list"), ("a/b_", "-c")]
    texts, want = [], []
    for a, b in around * 20:
        k = key(40)
        texts.append(f"é {a}{k}{b}")
        want.append((len(a) + 2, len(a) + 42))
    for n in (16, 19):
        for _ in range(20):
            texts.append(f"see {key(n)} here")
            want.append((4, 4 + n))
    for signs, a in (("+/", "k-"), ("-_", "k/")):  # keys whose own signs are of one pair, behind a name with one of the other
        for _ in range(20):
            k = "".join(f"{key(6)}{rng.choice(signs)}" for _ in range(6)) + key(5)
            texts.append(f"see {a}{k}= here")
            want.append((6, 6 + len(k) + 1))
    plain = [f"see option-{i}=introduction-to-the-theory/of_words_{i % 7} here" for i in range(80)] + [f"x/aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa{i}/a-b" for i in range(60)]
    spans = random_spans(spark, texts + plain)
    hit = [w in spans[i] for i, w in enumerate(want)]
    assert all(sum(hit[at::6][:20]) >= 18 for at in range(6))
    assert sum(hit[120:160]) >= 36 and sum(hit[160:]) >= 32
    assert not [i for i in range(len(texts), len(texts + plain)) if spans[i]]


def test_one_scan_gives_the_same_secrets(spark, odd_documents, no_documents):
    rng = random.Random(3)
    parts = ["/", "+", "-", "_", "=", "==", " ", "a1b2c3d4e5f6g7h8", "Zx9", "0123456789abcdef0123", "http://x.y/", "KEY=", "é", "wJalrXUtnFEMI", "K7MDENGbPxRfiCYEXAMPLEKEY"]
    df = spark.createDataFrame([(i, "".join(rng.choice(parts) for _ in range(rng.randrange(40)))) for i in range(400)], "doc_id bigint, text string")
    for docs in (df, odd_documents, no_documents):
        once = op1_secrets.secret_spans(docs)
        assert sorted(map(str, once.collect())) == sorted(map(str, op1_secrets.find_secrets(docs).drop("text").collect()))


def plain_p(core, symbols):
    """Fisher's joint p-value of the three tests, in plain Python."""
    n, k = len(core), len(symbols)
    v = [symbols.index(c) + 1 for c in core]
    even = (sum(v.count(s + 1) ** 2 for s in range(k)) * k / n - n - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n))
    low = sum(2 * x <= k for x in v)
    mean = 1 + 2 * low * (n - low) / n
    spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 0))
    turns = sum((2 * x <= k) != (2 * y <= k) for x, y in zip(v, v[1:]))
    variance = sum(x * x for x in v) - sum(v) ** 2 / n
    lag = sum(x * y for x, y in zip(v, v[1:] + v[:1]))
    z = [max(even, 0), (turns + 1 - mean) / spread if spread else 40, ((lag - sum(v) ** 2 / n) / variance + 1 / (n - 1)) * math.sqrt(n) if variance > 0 else 40]
    joined = -sum(math.log(min(max(math.erfc(abs(x) / math.sqrt(2)), op1_secrets.LEAST_P), 1)) for x in z)
    return max(math.exp(-joined) * (1 + joined + joined**2 / 2), op1_secrets.LEAST_P)


def test_p_values_and_false_discovery_control_equal_plain_versions(spark):
    rng = random.Random(23)
    symbols = op1_secrets.ENCODINGS["hex_lower"][1]
    runs = ["".join(rng.choice(symbols) for _ in range(rng.randrange(21, 90))) for _ in range(150)]
    runs += [("0123456789abcdef" * 9)[: rng.randrange(21, 140)] for _ in range(40)] + ["a1" * 15 + "b" * i for i in range(30)]
    runs = [r for r in runs if any(c.isdigit() for c in r) and any(c.isalpha() for c in r)]
    df = spark.createDataFrame([(i, f"x {r}!") for i, r in enumerate(runs)], "doc_id bigint, text string")
    scored = {r.doc_id: r["__runs"][0] for r in op1_secrets._scored(df, "text", base=False).collect()}
    bins = {}
    for i, run in enumerate(runs):
        exact = -10 * math.log10(plain_p(run, symbols))
        assert abs(scored[i]["bin"] - exact) <= 1.01  # rounded down; the tail formula is good to 2e-7
        bins.setdefault(sum(len(run) >= c for c in op1_secrets.LENGTH_CLASSES), []).append(scored[i]["bin"])
    dismissed = {}
    for c, all_bins in bins.items():
        ok = [b for b in all_bins if 10 ** (-b / 10) <= op1_secrets.LEVEL * sum(x >= b for x in all_bins) / len(all_bins)]
        if ok:
            dismissed[c] = min(ok)
    assert dismissed and op1_secrets.dismissal_bins(df) == dismissed
