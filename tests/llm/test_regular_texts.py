"""Two texts that exchange two letters along the Thue-Morse pattern: hashes built on powers of one base cannot tell them apart."""

import numpy as np
import pytest
from brute import contamination, jaccard_classes, language_model, repeated_bytes

from ledgerflow.llm import arrays, op4_ngram_jaccard, op7_decontaminate, op8_ngram_trie, op9_sentencepiece, op10_suffix_dedup

PATTERN = [bin(i).count("1") % 2 for i in range(4096)]
ONE, OTHER = ("".join(pair[b] for b in PATTERN) for pair in ("ab", "ba"))


@pytest.mark.parametrize("size", [64, 1024, 2048, 4096])
def test_hashes_differ(size):
    data = np.frombuffer((ONE[:size] + OTHER[:size]).encode(), np.uint8)
    a, b = arrays.hashes(data, np.array([0, size]), np.array([size, 2 * size]))
    assert a != b


def test_hashes_of_long_spans_differ():
    size = 3 << 16
    data = np.zeros(2 * size, np.uint8)
    data[1], data[size + 1 + (1 << 16)] = 7, 7
    a, b = arrays.hashes(data, np.array([0, size]), np.array([size, 2 * size]))
    assert a != b


@pytest.fixture(scope="module")
def pair(spark):
    return spark.createDataFrame([(1, ONE), (2, OTHER), (3, f"x {OTHER}")], "doc_id bigint, text string")


def test_operators_tell_them_apart(spark, pair):
    rows = [(r.doc_id, r.text) for r in pair.collect()]
    texts = [t for _, t in rows]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op4_ngram_jaccard.classes(pair, size=1, percent=85).collect()}
    assert got == {i: (n, rows[k][0]) for (i, _), (n, k) in zip(rows, jaccard_classes(rows, 1, 85), strict=True)}
    bench = spark.createDataFrame([("x", ONE)], "item_id string, text string")
    found = {r.doc_id: (r.n_words, r.n_hit, r.item_ids) for r in op7_decontaminate.find_matches(pair, bench).collect()}
    assert found == {i: w for (i, _), w in zip(rows, contamination(texts, [("x", ONE)]), strict=True)}
    held = op8_ngram_trie.held_out()
    scored = {r.doc_id: (r.n_known, round(r.base_score, 6)) for r in op8_ngram_trie.score(pair, ~held).collect()}
    assert scored == {i: (w[1], round(w[3], 6)) for (i, _), w in zip(rows, language_model(rows), strict=True)}


def test_encoding_and_repeats_tell_them_apart(pair):
    texts = {r.doc_id: r.text for r in pair.collect()}
    library = op9_sentencepiece.Vocabulary(op9_sentencepiece._model(None)).library
    for r in op9_sentencepiece.encode(pair).collect():
        assert r.ids == [*library.encode(texts[r.doc_id]), library.eos_id()]
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in op10_suffix_dedup.dedup(pair).collect()}
    assert got == {i: w[1:3] for i, w in zip(texts, repeated_bytes(list(texts.values()), 200), strict=True)}
