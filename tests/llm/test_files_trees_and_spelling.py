import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from compare import connect, difference
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerflow.llm import op11_token_files, op12_merkle, op13_spelling
from ledgerflow.sources.shared import fresh_path

SMALL_LETTERS = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


# ---- token files -----------------------------------------------------------------------------


def library_ids(texts):
    tokenizer = Tokenizer.from_file(op11_token_files.default_tokenizer())
    return [e.ids for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def token_rows(rows):
    """doc_id, start, n_tokens, ids_crc32 of rows in id order, nulls first."""
    out, start = [], 0
    for (name, _), ids in zip(rows, library_ids([t for _, t in rows]), strict=True):
        ids = [*ids, 0]
        out.append((name, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_token_files_equal_the_library(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    want = token_rows(sorted(tuple(r) for r in docs.collect()))
    assert sorted(tuple(r) for r in op11_token_files.op11_token_files(spark, small).collect()) == want


def test_token_files_of_odd_documents(spark, odd_documents, no_documents):
    manifest = op11_token_files.write_tokens(odd_documents, fresh_path(spark, "t"))
    got = op11_token_files.read_tokens(manifest).orderBy("start").collect()
    rows = sorted(((r.doc_id, r.text) for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [tuple(r)[:4] for r in got] == token_rows(rows)
    assert [r.ids for r in got] == [[*x, 0] for x in library_ids([t for _, t in rows])]
    empty = op11_token_files.write_tokens(no_documents, fresh_path(spark, "t"))
    assert empty.count() == 0 and op11_token_files.read_tokens(empty).count() == 0


def test_documents_span_blocks_and_chunks(spark, monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "Beta", "γάμμα", "7", "x y", "\n\n "]) for _ in range(rng.choice([0, 3, 900]))) for _ in range(40)]
    monkeypatch.setattr(op11_token_files, "CHUNK_IDS", 1500)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    manifest = op11_token_files.write_tokens(df, fresh_path(spark, "t"))
    assert manifest.count() > 5 and manifest.agg(F.sum("n_docs")).first()[0] == 40
    got = op11_token_files.read_tokens(manifest, ids=False).orderBy("start").collect()
    assert [tuple(r) for r in got] == token_rows(list(enumerate(texts)))


@pytest.mark.parametrize("kinds", [1, 2, 3, 17, 50_000])
def test_coder_round_trip(kinds):
    rng = random.Random(kinds)
    for size in (1, 2, 15, 511, 512, 513, 1025, 5000):
        for repeat in (0.0, 0.5, 0.999):
            ids = np.array([rng.randrange(kinds) if rng.random() >= repeat else 0 for _ in range(size)], "<u4")
            names, lengths, back = op11_token_files.unpack_chunk(op11_token_files.pack_chunk([None, -5], [size - 1, 1], ids.tobytes()))
            assert names == [None, -5] and lengths.tolist() == [size - 1, 1] and (back == ids).all()


def test_lanes_in_groups_code_alike(monkeypatch):
    ids = np.array([random.Random(2).randrange(900) for _ in range(6000)], "<u4").tobytes()
    whole = op11_token_files.pack_chunk([1], [6000], ids)
    monkeypatch.setattr(op11_token_files, "TABLE_BYTES", 1)  # one block at a time
    assert op11_token_files.pack_chunk([1], [6000], ids) == whole


def test_coding_is_worth_it_and_damage_is_found():
    ids = np.array([k * k % 97 for k in range(20_000)], "<u4")
    data = op11_token_files.pack_chunk([1], [20_000], ids.tobytes())
    assert len(data) < ids.nbytes / 10
    for place, text in ((9, "header"), (len(data) - 3, "block")):
        hurt = bytearray(data)
        hurt[place] ^= 4
        with pytest.raises(ValueError, match=text):
            op11_token_files.unpack_chunk(bytes(hurt))


def test_parts_are_the_librarys():
    odd = "a\x1cb! \x1c  c  d\n\n  e <|endoftext|>  <|endoftext|>f   　g h it's  \r\n\t" + "x" * 3000
    tokens = op11_token_files._tokens(open(op11_token_files.default_tokenizer(), encoding="utf-8").read())
    assert np.frombuffer(tokens.encode([odd])[0], "<u4").tolist() == library_ids([odd])[0]


# ---- Merkle manifest -------------------------------------------------------------------------


def hashed(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def tree(leaves):
    """Root, and each leaf's siblings and its runs' places, of one tree."""
    way = [([], []) for _ in leaves]
    at = list(range(len(leaves)))
    while len(leaves) > 1:
        for (siblings, steps), p in zip(way, at, strict=True):
            run = leaves[p // 8 * 8 : p // 8 * 8 + 8]
            siblings += run[: p % 8] + run[p % 8 + 1 :]
            steps.append((p % 8, len(run)))
        leaves = [hashed(*leaves[i : i + 8]) for i in range(0, len(leaves), 8)]
        at = [p // 8 for p in at]
    return leaves[0], way


def merkle_rows(rows):
    def value(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    trees = defaultdict(list)
    for name, text, lang, source, n_chars in rows:
        head = "".join(value(v) for v in (name, source, lang, n_chars))
        low = text is not None and name is not None and zlib.crc32(str(name).encode()) % 3 == 0
        trees[lang].append((name is not None, name or 0, hashed(head, value(text)), name, hashed(head, value(text.translate(SMALL_LETTERS) if low else text))))
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    made = {lang: tree([x[2] for x in sorted(trees[lang])]) for lang in order}
    root, ends = tree([made[lang][0] for lang in order])
    out = []
    for lang, (more, more_steps) in zip(order, ends, strict=True):
        for (_, _, leaf, name, given), (siblings, steps) in zip(sorted(trees[lang]), made[lang][1], strict=True):
            siblings, at, x = siblings + more, 0, given
            for place, size in steps + more_steps:
                run = siblings[at : at + size - 1]
                at += size - 1
                x = hashed(*run[:place], x, *run[place:])
            out.append((name, leaf, made[lang][0], root, hashed(*siblings), x, x == root))
    return out


def test_manifest_equals_sql(spark, small):
    assert difference(op12_merkle.op12_merkle(spark, small), connect(small), op12_merkle.ORACLE_SQL) is None


def written(spark, df, name):
    folder = fresh_path(spark, name)
    df.write.parquet(f"{folder}/documents.parquet")
    return folder


@pytest.mark.parametrize("height", [1, 2, 4])
def test_trees_of_many_blocks(spark, monkeypatch, height):
    rng = random.Random(height)
    langs = [None, "", "é", *[f"l{k}" for k in range(8)]]
    rows = [(k if k % 50 else None, rng.choice(["Some Text", "plain", None, "", f"T{k}"]), rng.choice(langs), rng.choice(["s", None]), k) for k in range(300)]
    rows += [(1000 + k, f"Big {k}", "big", "s", None) for k in range(530)] + [(1500, "same", "big", "s", 1)] * 3
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    docs = df.select("doc_id", "lang", F.unhex(op12_merkle.leaf_digest([F.col(c) for c in op12_merkle.LEAF_COLUMNS])).alias("leaf"))
    lowest = op12_merkle.manifest(docs, "lang", ["doc_id"], "leaf", height)
    got = op12_merkle.folded(lowest, "leaf", height).collect()
    want = merkle_rows(rows)
    assert sorted((str(r["item"].doc_id), r["item"].leaf.hex(), r.subroot, r.root, r.proof_sha256) for r in got) == sorted((str(w[0]), *w[1:5]) for w in want)
    assert all(r.folded_root == r.root for r in got)


def test_proofs_of_odd_documents(spark, odd_documents, no_documents):
    got = [tuple(r) for r in op12_merkle.op12_merkle(spark, written(spark, odd_documents, "odd")).collect()]
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in odd_documents.collect()]
    assert sorted(map(str, got)) == sorted(map(str, merkle_rows(rows)))
    assert op12_merkle.op12_merkle(spark, written(spark, no_documents, "none")).count() == 0


def test_layout_is_recursive():
    places = op12_merkle.layout(4)
    assert sorted(p for level in places for p in level.tolist()) == list(range(4681))
    assert places[0].tolist() == [0] and places[1].tolist() == list(range(1, 9))  # the upper half comes first
    # each lower subtree of three levels is one contiguous range, its own upper part first
    assert places[2][:2].tolist() == [9, 82] and places[3][:8].tolist() == list(range(10, 82, 9))
    assert places[4][:8].tolist() == list(range(11, 19))


# ---- spelling variants -----------------------------------------------------------------------


def spelling_rows(rows):
    import re

    count = Counter()
    for name, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(SMALL_LETTERS)
            h = zlib.crc32(f"{'' if name is None else name}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    known = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    holes, near = defaultdict(set), defaultdict(set)
    for w in known:
        for i in range(len(w)):
            holes[w[:i], w[i + 1 :]].add(w)
            if (less := w[:i] + w[i + 1 :]) in known:
                near[w].add(less)
                near[less].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, others in near.items():
        if others and known[best := min(others, key=lambda x: (-known[x], x))] >= 10 * known[w]:
            form[w] = best
    out = []
    for w, n in known.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), known[form[w]] if w in form else None))
    return sorted(out)


def spelling(df):
    return sorted(tuple(r) for r in op13_spelling.spelling_variants(df).collect())


def test_spelling_equals_plain_version(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    got = sorted(tuple(r) for r in op13_spelling.op13_spelling(spark, small).collect())
    assert got == spelling_rows([tuple(r) for r in docs.collect()])


def test_spelling_of_few_letters_and_long_words(spark, monkeypatch):
    rng = random.Random(9)
    monkeypatch.setattr(op13_spelling, "LEVELS", 10)
    bases = ["".join(rng.choice("abé") for _ in range(rng.randrange(7, 14))) for _ in range(4)] + ["aaaaaaa", "a" * 10, "a" * 11, "b" * 60]
    rows = []
    for k in range(900):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 0, 1, 1, 1])):
            at = rng.randrange(len(w))
            w[at : at + rng.choice([0, 1])] = rng.choice(["", "A", "b"])
        rows.append((rng.choice([k, None]), "".join(w) + rng.choice([" ", "1", ""]) + "aaaaaab " * rng.choice([1, 5])))
    rows += [(1, None), (2, ""), (3, "short word"), (None, "aaaaaaa")] + [(4, "z" * 2_000)] * 2 + [(5, "z" * 800 + "y" + "z" * 1_199)] * 30
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("word", F.lit("mine"))
    want = spelling_rows(rows)
    assert any(w[1] for w in want) and max(w[4] for w in want) > 5
    assert spelling(df) == want


def test_both_directions_share_one_walk(spark, monkeypatch):
    made = []
    monkeypatch.setattr(op13_spelling, "fresh_path", lambda session, name: made.append(name) or fresh_path(session, name))
    rows = [(None, "balance balanse xalance balanced zzbalance " * 2)]
    assert spelling(spark.createDataFrame(rows, "doc_id bigint, text string")) == spelling_rows(rows)
    assert sorted(made) == ["frontier", "trie"]


def test_spelling_of_odd_documents(spark, odd_documents, no_documents):
    rows = [(r.doc_id, r.text) for r in odd_documents.collect()]
    assert spelling(odd_documents) == spelling_rows(rows)
    assert spelling(no_documents) == []


def test_chains_of_forms_end_at_the_most_frequent(spark):
    chain = ["abcdefg", "abcdefgh", "abcdefghi", "abcdefghij"]
    rows = [(None, " ".join([w] * n)) for w, n in zip(chain, (2, 20, 200, 2000), strict=True)]
    got = {w[0]: w[1:3] for w in spelling(spark.createDataFrame(rows, "doc_id bigint, text string"))}
    want = {w[0]: w[1:3] for w in spelling_rows(rows)}
    assert got == want and len({r for _, r in got.values()}) <= 2
