"""The queries of this package, and the pipeline stage by stage."""

import compare
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from epiframe.llm import kneser_ney, language, packing
from epiframe.llm.queries import QUERIES, SQL
from tests.llm.test_similar import brute, brute_at
from tests.llm.test_tokens import check_packing


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, duck, sf, name):
    assert compare.differences(QUERIES[name](spark, sf), duck, SQL[name]) == []


def test_all_are_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


def test_pipeline(spark, sf):
    """Every stage against a plain version of its rule over what the stage before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    tables = {}
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        path = f"{corpus_pipeline.scratch_dir(spark)}/{name}"
        stage(spark, before, sf).write.parquet(path)
        tables[name] = before = spark.read.parquet(path)
        if name != "best_fit_packing":
            assert before.columns == docs.columns
    ids = {n: {r["doc_id"] for r in t.select("doc_id").collect()} for n, t in tables.items()}
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    assert ids["quality_classifier"] == {r["doc_id"] for r in kneser_ney.scored(docs, labels).filter("keep").collect()}
    kept = tables["quality_classifier"]
    guess = language.predict(kept, language.fit(language.training_rows(kept)))
    assert ids["language_id"] == {r["doc_id"] for r in guess.collect() if r["lang_pred"] != "und" and r["score"] >= 0.5}
    texts = [(r["doc_id"], r["text"]) for r in tables["language_id"].collect()]
    assert ids["ngram_jaccard_join"] == {i for i, _, root in brute_at(texts, 5, 80) if i == root}
    last = [(r["doc_id"], r["text"]) for r in tables["ngram_jaccard_join"].collect()]
    sequences = check_packing(tables["best_fit_packing"].collect(), last, packing.SEQUENCE)
    tokens = sum(r["length"] for r in tables["best_fit_packing"].collect())
    assert sequences <= 1.02 * tokens / packing.SEQUENCE + 2
    assert ids["best_fit_packing"] == ids["ngram_jaccard_join"]
    clean = {r["doc_id"] for r in labels.filter("quality = 1").collect()}
    assert len(clean & ids["language_id"]) >= 0.97 * len(clean)


def test_near_copies_are_those_of_five_words(spark, make_docs, sf):
    """A run of words replaced in a copy: near by five-word shingles at 0.8, not by three-word shingles at 0.9."""
    words = [f"w{k}" for k in range(200)]
    rows = [(0, " ".join(words)), (1, " ".join([*words[:90], *(f"x{k}" for k in range(15)), *words[105:]])), (2, " ".join([*words[:90], *(f"y{k}" for k in range(40)), *words[130:]]))]
    kept = {r["doc_id"] for r in corpus_pipeline.ngram_jaccard_join(spark, make_docs(rows), sf).collect()}
    assert kept == {i for i, _, root in brute_at(rows, 5, 80) if i == root} == {0, 2}
    assert {i for i, _, root in brute(rows) if i == root} == {0, 1, 2}


def test_stages_of_nothing(spark, make_docs, sf):
    rows = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, rows, sf).count() == 0


def test_stages_take_odd_rows(spark, make_docs, odd_rows, sf):
    docs = make_docs(odd_rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf).columns == docs.columns
