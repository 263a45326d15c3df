"""The counts of the long-form models: one row a term, documents dealt by their number."""

import pytest

from kiln.operators import features as fx
from kiln.operators import naive_bayes as nb
from kiln.plans import mlpipes


@pytest.mark.parametrize("n_classes", [3, nb.WIDE_CLASSES + 2])
def test_counts_by_term(spark, n_classes):
    rows = [(None if i % n_classes == 0 else f"c{i % n_classes}", [f"w{i % 7}", f"w{i % 7}", "the", "" if i % 2 else None]) for i in range(60)]
    docs = spark.createDataFrame([*rows, ("c1", []), ("c1", None)], "lang string, tokens array<string>")
    model = nb.fit(docs, "lang", "tokens")
    expected = {}
    for label, words in rows:
        for w in filter(lambda w: w is not None, words):
            expected[w, label] = expected.get((w, label), 0) + 1
    labels = model.labels
    got = {(r.term, labels[r.k]): round(2.718281828459045 ** r.w - 1, 6) for r in model.weights.collect()}
    assert got == expected and model.vocab_size == 9 and len(model.classes) == n_classes
    for c in model.classes:
        assert c.n_terms == sum(n for (_, label), n in expected.items() if label == c.label)
    by_term = nb._counts_by_term(docs, "lang", "tokens", spark.createDataFrame([(c.label, c.idx) for c in model.classes], "_label string, k int"),
                                 [(c.label, c.idx) for c in model.classes])
    assert by_term.count() == model.vocab_size       # one row a term: no second shuffle for the vocabulary


def test_fit_on_no_rows(spark):
    model = nb.fit(spark.createDataFrame([], "lang string, tokens array<string>"), "lang", "tokens")
    assert model.classes == [] and model.vocab_size == 0 and model.weights.count() == 0


@pytest.mark.parametrize("query", ["q_ml_ngram", "q_ml_lang_nb", "q_ml_saved"])
def test_documents_are_dealt(spark, tmp_path, monkeypatch, query):
    """The tasks that count terms get so many documents each, however few files there are."""
    rows = [(i, f"the cat sat on the mat number {i}" if i % 3 else f"le chat est sur le tapis {i}", "en" if i % 3 else "fr") for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    dealt, by_document = [], mlpipes.by_document
    monkeypatch.setattr(fx, "TASK_ROWS", 10)
    monkeypatch.setattr(mlpipes, "by_document", lambda *a: dealt.append(by_document(*a)) or dealt[-1])
    assert len(mlpipes.QUERIES[query](spark, str(tmp_path)).collect()) > 0
    assert [d.rdd.getNumPartitions() for d in dealt] == [9]


def test_scoring_join_of_a_large_table(spark, monkeypatch):
    """Above JOIN_TERMS terms the join hashes a bounded share of them in each task, with the same scores."""
    docs = spark.createDataFrame([(i, f"c{i % 3}", [f"w{(i * j) % 23}" for j in range(i % 9)]) for i in range(60)]
                                 + [(60, "c0", ["new"]), (61, "c0", None)], "id long, lang string, tokens array<string>")
    model = nb.fit(docs.where("id < 50"), "lang", "tokens")
    a = nb.predict(model, docs, "id", "tokens")
    monkeypatch.setattr(nb, "JOIN_TERMS", 2)
    b = nb.predict(model, docs, "id", "tokens")
    assert "ShuffledHashJoin" in b._jdf.queryExecution().toString() and "ShuffledHashJoin" not in a._jdf.queryExecution().toString()
    a, b = (sorted((r.id, r.prediction, round(r.score, 9)) for r in p.collect()) for p in (a, b))
    assert a == b and len(a) == 62
