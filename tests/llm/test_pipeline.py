"""The five stages against plain Python, each judged on what the stage before it kept."""

import subprocess
import sys
from pathlib import Path

import pytest
from brute import base_secrets, contamination, jaccard_classes

ROOT = Path(__file__).resolve().parents[2]


@pytest.fixture(scope="module")
def kept(spark, small, tmp_path_factory):
    import corpus_pipeline

    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, small).write.parquet(str(folder / name))
        docs = spark.read.parquet(str(folder / name))
        out.append((name, docs))
    return out


def rows(df):
    return sorted(df.select("doc_id", "text").collect(), key=lambda r: r.doc_id)


def test_stages_and_columns(kept):
    names = [n for n, _ in kept]
    assert names == ["documents", "language_id", "ngram_jaccard", "decontamination", "secret_scan", "sentencepiece"]
    assert all(df.dtypes == kept[0][1].dtypes for _, df in kept[1:-1])
    assert set(kept[0][1].columns) < set(kept[-1][1].columns)


def test_language_stage_keeps_prose(kept):
    assert kept[1][1].count() == kept[0][1].where("text RLIKE '[A-Za-z]'").count()


def test_one_document_of_each_class(kept):
    before, after = rows(kept[1][1]), rows(kept[2][1])
    classes = jaccard_classes([(r.doc_id, r.text) for r in before], 5, 80)
    of = {r.doc_id: c for r, (_, c) in zip(before, classes, strict=True)}
    left = [of[r.doc_id] for r in after]
    assert len(left) == len(set(left)) == len(set(of.values()))


def test_contaminated_documents_go(spark, small, kept):
    items = [(str(r.item_id), r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]
    before = rows(kept[2][1])
    figures = contamination([r.text for r in before], items)
    clean = {r.doc_id for r, (n, hit, _) in zip(before, figures, strict=True) if not (hit and 20 * hit >= n)}
    assert {r.doc_id for r in rows(kept[3][1])} == clean


def test_secrets_are_masked_and_nothing_else_changes(kept):
    before, after = rows(kept[3][1]), rows(kept[4][1])
    assert [r.doc_id for r in before] == [r.doc_id for r in after]
    for a, b in zip(before, after, strict=True):
        assert not base_secrets(b.text)
        if a.text != b.text:
            assert "<secret>" in b.text
        else:
            assert not base_secrets(a.text)
    assert kept[4][1].where("n_chars <> length(text)").count() == 0


def test_last_stage_equals_the_library_and_run_equals_the_stages(spark, small, kept):
    import hashlib

    import corpus_pipeline
    import sentencepiece

    from ledgerflow.llm import op9_sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=op9_sentencepiece.default_model())
    for r in kept[5][1].collect():
        ids = library.encode(r.text, add_eos=True)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest())
        assert r.round_trip
    found = corpus_pipeline.run(spark, small)
    assert sorted(map(str, found.collect())) == sorted(map(str, kept[5][1].collect()))


def test_entry_imports_without_the_subpackage(tmp_path):
    """As if the llm folders and the pipeline file were not there."""
    code = (
        "import sys\n"
        "class Absent:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name.startswith('ledgerflow.llm') or name == 'corpus_pipeline':\n"
        "            raise ModuleNotFoundError(f'No module named {name!r}', name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import __spark_entry__ as e\n"
        "assert not [q for q in e.queries() if q.startswith('op')] and 'pipeline' not in e.queries()\n"
        "assert len(e.queries()) > 190\n"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)


def test_registered_queries(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    assert {"pipeline"} | {n for n in names if n.startswith("op")} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
