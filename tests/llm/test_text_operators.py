import random

import pyarrow as pa
import pytest
from brute import contamination, jaccard_classes, language_model, repeated_bytes
from pyspark.sql import functions as F

from ledgerflow.llm import op4_ngram_jaccard, op5_language, op7_decontaminate, op8_ngram_trie, op9_sentencepiece, op10_suffix_dedup


def frame(spark, texts, parts=3):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartitionByRange(parts, "doc_id")


def near_copies(rng, n):
    bases = [[f"{rng.choice('abcdefghij')}{rng.randrange(30)}" for _ in range(rng.choice([5, 8, 20, 40, 120]))] for _ in range(15)]
    line = [f"c{k}" for k in range(12)]
    out = [None, "", " ", "a b", "A  B", "a"]
    for _ in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            w[rng.randrange(len(w))] = f"m{rng.randrange(40)}"
        if rng.random() < 0.4:
            w = line + w
        out.append(" ".join(w[: len(w) - rng.choice([0, 0, 0, 2])]))
    return out


@pytest.mark.parametrize(("size", "percent"), [(4, 85), (5, 80)])
def test_classes_equal_all_pairs(spark, size, percent):
    texts = near_copies(random.Random(size), 350)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_ngram_jaccard.classes(frame(spark, texts), size=size, percent=percent).collect()}
    assert got == dict(enumerate(jaccard_classes(list(enumerate(texts)), size, percent)))


def test_one_document_of_each_class_stays(spark, odd_documents, no_documents):
    out = op4_ngram_jaccard.one_per_class(odd_documents)
    assert out.dtypes == odd_documents.dtypes
    # of the repeated row and of the two long texts one each; texts without words all stay
    assert sorted(str(r.doc_id) for r in out.collect()) in (sorted(["1", "2", "3", "4", "5", k, "None"]) for k in "67")
    assert op4_ngram_jaccard.one_per_class(no_documents).count() == 0


def test_contamination_equals_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = ["a", "b", "É", "c9", "-"]
    items = [(str(k), " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 3, 13, 14, 30])))) for k in range(6)] + [("0", "x y"), (None, "q q"), ("9", None)]
    texts = [" ".join(rng.choice([*words, "zz"]) for _ in range(rng.randrange(60))) for _ in range(60)] + [None, "", "q Q", *[f"x {t} Y." for _, t in items]]
    bench = spark.createDataFrame(items, "item_id string, text string")
    want = dict(enumerate(contamination(texts, items)))
    for limit in (1 << 20, 120):  # one block of items, several
        monkeypatch.setattr(op7_decontaminate, "BLOCK_BYTES", limit)
        found = op7_decontaminate.find_matches(frame(spark, texts), bench)
        assert {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in found.collect()} == want


def test_longest_matches_are_verbatim(spark):
    item = " ".join(f"w{i}" for i in range(40))
    text = "before " + " ".join(f"W{i}" for i in range(5, 30)) + " after"
    bench = spark.createDataFrame([(7, item)], "item_id bigint, text string")
    row = op7_decontaminate.find_matches(frame(spark, [text]), bench).collect()[0]
    assert [tuple(m) for m in row.matches] == [("7", 5, 1, 25)]
    assert row.hits == [1, 26]


def test_items_that_share_windows_each_get_their_longest_match(spark):
    shared = [f"w{i}" for i in range(13)]
    longer = " ".join([*shared, "x1", "x2", "x3"])
    bench = spark.createDataFrame([("i1", " ".join(shared)), ("i2", longer), ("i3", "other " + " ".join(shared)), (None, longer)], "item_id string, text string")
    row = op7_decontaminate.find_matches(frame(spark, [longer, "no"]), bench).where("doc_id = 0").collect()[0]
    want = [("i1", 0, 0, 13), ("i2", 0, 0, 16), ("i3", 1, 0, 13), (None, 0, 0, 16)]
    assert sorted(map(str, (tuple(m) for m in row.matches))) == sorted(map(str, want))
    assert row.item_ids == ["i1", "i2", "i3"] and row.n_hit == 16


def test_rows_without_an_id_are_linked(spark):
    words = [f"v{i}" for i in range(40)]
    near = " ".join([*words[:-1], "other"])
    alone = " ".join(f"u{i}" for i in range(40))
    rows = [(None, " ".join(words)), (7, near), (9, near), (None, alone), (None, alone + " more"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'mine' AS hashes", "1 AS grp")
    got = sorted(((r.doc_id, r.component_id) for r in op4_ngram_jaccard.classes(docs).collect()), key=str)
    assert got == [(7, 7), (9, 7), (None, 7), (None, None), (None, None), (None, None)]


def test_decontamination_keeps_columns_and_clean_rows(spark, odd_documents, no_documents):
    bench = spark.createDataFrame([(1, " ".join(["hund", "und", "die", "katze"]))], "item_id bigint, text string")
    out = op7_decontaminate.decontaminate(odd_documents, bench)
    assert out.dtypes == odd_documents.dtypes and out.count() == 8 and out.where("doc_id = 5").count() == 0
    assert op7_decontaminate.decontaminate(odd_documents, bench.where("false")).count() == 9
    assert op7_decontaminate.decontaminate(no_documents, bench).count() == 0


def test_language_on_held_out_rows(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    found = op5_language.op5_language(spark, small).join(docs.select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right >= 0.97
    assert found.where("score < 0 OR score > 1").count() == 0


def test_language_edge_cases(spark, odd_documents, no_documents):
    model = op5_language.prototypes(odd_documents.where("doc_id IN (4, 5)"))
    found = {str(r.doc_id): r for r in op5_language.predict(odd_documents, model).select("doc_id", "lang_pred", "score").collect()}
    assert [found[k].lang_pred for k in ("1", "2", "3", "None")] == ["und"] * 4
    assert found["4"].lang_pred == "en" and found["5"].lang_pred == "de"
    kept = op5_language.keep_known(odd_documents, odd_documents)
    assert kept.dtypes == odd_documents.dtypes and kept.count() == 5
    assert op5_language.keep_known(odd_documents, no_documents).count() == 0
    assert op5_language.predict(no_documents, model).count() == 0


def test_long_texts_unlike_every_language_go(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    learnt = docs.where("lang <> 'fr'")
    rng = random.Random(4)
    noise = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz    ") for _ in range(n)) for n in (400, 2000, 20_000) for _ in range(5)]
    greek = ["".join(rng.choice("αβγδεζηθικλμνξοπρστυφχψω    ") for _ in range(n)) for n in (400, 20_000) for _ in range(5)]
    assert op5_language.keep_known(frame(spark, noise + greek), learnt).count() == 0
    french = docs.where("lang = 'fr' AND length(text) BETWEEN 400 AND 4000")
    assert op5_language.keep_known(french, learnt).count() <= 0.15 * french.count()
    # a few words of a learnt language stay
    short = docs.where("lang = 'en' AND length(text) > 100").selectExpr("doc_id", "array_join(slice(split(text, ' '), 3, 4), ' ') AS text")
    short = short.where("text RLIKE '[a-z]{3}'")
    assert op5_language.keep_known(short, learnt).count() >= 0.97 * short.count()


def test_language_model_equals_brute_force(spark):
    rng = random.Random(8)
    words = [f"w{i}" for i in range(40)] + ["The", "the", "É"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(40))) for _ in range(150)] + [None, "", "  ", "new words here", "x " * 3000]
    want = dict(enumerate(language_model(list(enumerate(texts)))))
    for shard_bytes, rows in ((1 << 24, 1024), (2000, 16)):
        found = op8_ngram_trie.score(frame(spark, texts), ~op8_ngram_trie.held_out(), shard_bytes=shard_bytes, block_rows=rows).collect()
        assert len(found) == len(texts)
        for r in found:
            tokens, known, n, base, score = want[r.doc_id]
            assert (r.n_tokens, r.n_known, r.train_tokens) == (tokens, known, n)
            assert r.base_score == pytest.approx(base, rel=1e-9)
            assert abs(r.score - score) <= 0.03 * tokens  # one byte per probability


def test_language_model_edge_cases(spark, odd_documents, no_documents):
    learns = ~op8_ngram_trie.held_out()
    assert op8_ngram_trie.score(odd_documents, learns).count() == 9
    assert op8_ngram_trie.score(no_documents, learns).count() == 0
    row = op8_ngram_trie.score(frame(spark, ["a b"]), F.lit(False)).collect()[0]
    assert (row.n_tokens, row.n_known, row.train_tokens, row.base_score) == (3, 0, 0, 0.0)


def test_tokens_equal_the_library(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=op9_sentencepiece.default_model())
    rng = random.Random(1)
    texts = [None, "", " ", "  a b", "Hello\n\tworld é ﬁ 　x ▁y ▁ z▁ w", "a\x00b", "<s> </s> <0x41>", "x" * 1000 + "the" * 500, " " * 300, "\n\n \n", "a▁ b"]
    texts += ["".join(rng.choice("ab the▁ \nin é😀,.") for _ in range(rng.randrange(150))) for _ in range(300)]
    encoded = op9_sentencepiece.decode(op9_sentencepiece.encode(frame(spark, texts)))
    for r in encoded.collect():
        assert r.ids == library.encode(texts[r.doc_id] or "", add_eos=True)
        assert r.decoded == library.decode(r.ids) == (texts[r.doc_id] or "").replace("▁", " ")


def test_agenda_and_side_by_side_agree():
    words = op9_sentencepiece.Encoder(op9_sentencepiece._model(None)).vocabulary
    text = " unbelievably"
    symbols = [int(words.of_char[ord(c)]) for c in text]
    import numpy as np

    flat, sizes = words.side_by_side(np.array(symbols * 2), np.array([len(symbols)] * 2))
    assert flat.tolist() == words.agenda(symbols) * 2 and sizes.tolist() == [len(flat) // 2] * 2


def test_token_digests_replace_clashing_columns(odd_documents, no_documents):
    out = op9_sentencepiece.token_digests(odd_documents)
    assert out.columns.count("n_tokens") == 1 and out.count() == 9
    assert all(r.round_trip for r in out.collect())
    assert op9_sentencepiece.token_digests(no_documents).count() == 0


def test_suffix_ranks_equal_sorted_suffixes():
    import numpy as np

    rng = random.Random(7)
    for _ in range(150):
        s = [rng.randrange(1, rng.choice([2, 3, 6]) + 1) for _ in range(rng.randrange(1, 50))]
        suffixes = [s[i:] for i in range(len(s))]
        assert op10_suffix_dedup.suffix_ranks(np.array(s, np.int64), 10**6).tolist() == [sum(x < y for x in suffixes) for y in suffixes]


@pytest.mark.parametrize("hot", [10**7, 300])
def test_repeated_strings_equal_brute_force(spark, hot):
    rng = random.Random(hot)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 6))) for _ in range(200)]
    base = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(8)]
    texts = [None, "", "a" * 100, "a" * 21, "ab" * 60, "é" * 50]
    for _ in range(90):
        b = rng.choice(base)
        a = rng.randrange(len(b))
        texts.append(b[a : a + rng.randrange(120)] + " ".join(rng.choice(words) for _ in range(rng.randrange(15))) + rng.choice(base))
    texts += texts[-3:]
    out = op10_suffix_dedup.dedup(frame(spark, texts), window=20, gram=8, hot_bytes=hot)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.drop("text").collect()} == dict(enumerate(repeated_bytes(texts, 20)))


def test_windows_of_split_classes_leave_as_stretches(spark, monkeypatch):
    rng = random.Random(4)
    passage = " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(60))
    texts = [f"{k} before {passage} after {k * 7}" for k in range(40)]
    stored = {}
    monkeypatch.setattr(op10_suffix_dedup, "store", lambda df, name, plain=op10_suffix_dedup.store: stored.setdefault(name, plain(df, name)))
    out = op10_suffix_dedup.dedup(frame(spark, texts), window=20, gram=8, hot_bytes=0)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out.drop("text").collect()} == dict(enumerate(repeated_bytes(texts, 20)))
    parts = stored["parts"]
    assert parts.count() < parts.agg(F.sum(F.col("w1") - F.col("w0"))).first()[0] / 2  # fewer rows than windows
    touching = parts.alias("a").join(parts.alias("b"), ["m", "f", "n"]).where("a.w1 = b.w0")
    assert touching.count() == 0


def test_suffix_dedup_edge_cases(odd_documents, no_documents):
    out = op10_suffix_dedup.dedup(odd_documents).collect()
    assert {r.n_removed == r.n_bytes for r in out if r.doc_id in (6, 7)} == {True} and len(out) == 9
    assert {r.rid for r in out} == {"z"}
    assert op10_suffix_dedup.dedup(no_documents).count() == 0


def test_word_hashes_do_not_depend_on_neighbours():
    from ledgerflow.llm import arrays

    import numpy as np

    data = np.frombuffer(b"abc xabc" + b"q" * 70_000 + b"abc", np.uint8)
    n = len(data)
    h = arrays.hashes(data, np.array([0, 5, n - 3, 8]), np.array([3, 8, n, n - 3]))
    assert h[0] == h[1] == h[2] != h[3]
    assert arrays.hashes(data, np.array([8, 8]), np.array([n - 3, n - 4]))[0] == h[3]
    assert [b.num_rows for b in arrays.slices(pa.record_batch([pa.array(["ab", None, "c" * 9, "d"])], names=["t"]), "t", 4)] == [2, 1, 1]
