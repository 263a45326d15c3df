"""The long-form pipeline stage (MOD-5, SNK-1) and logistic regression (MOD-4)."""

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from kiln.operators import logistic
from kiln.operators import pipelines as P
from kiln.session import scratch_path


@pytest.fixture(scope="module")
def lines(spark):
    rows = [(i, "the cat sat on the mat" if i % 3 else "le chat est sur le tapis", "en" if i % 3 else "fr") for i in range(30)]
    return spark.createDataFrame([*rows, (30, "", "en"), (31, "the cat sat on the mat", "en")], "doc_id long, fullText string, lang string")


def test_pipeline_is_saved_and_loaded(spark, lines):
    model = P.language_pipeline("lang", keep=("doc_id",)).fit(lines)
    path = scratch_path(spark, "stage")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    test = lines.union(spark.createDataFrame([(40, "le chat", "xx"), (41, "nothing known", "en"), (41, "nothing known", "en")], lines.schema))
    a, b = (sorted(tuple(r) for r in m.transform(test).collect()) for m in (model, back))
    assert a == b and len(a) == lines.count() + 3
    got = back.transform(test)
    assert got.columns == ["doc_id", "lang", "langId", "prediction", "score"]
    by_id = {r.doc_id: r for r in got.collect()}
    assert by_id[0].prediction == by_id[0].langId == 1.0 and by_id[1].prediction == 0.0
    assert by_id[40].prediction == 1.0 and by_id[40].langId == 2.0       # a label not seen before
    assert by_id[41].prediction == 0.0                                   # the prior alone


def test_long_stage_equals_the_dense_model(spark, lines):
    long = P.ngram_pipeline("category", orders=(1, 2), keep=("doc_id",))
    dense = P.ngram_pipeline("category", orders=(1, 2), vocab_size=1000)
    d = lines.withColumn("category", (F.col("lang") == "fr").cast("double"))
    a = {r.doc_id: r.prediction for r in long.fit(d).transform(d).collect()}
    b = {r.doc_id: r.prediction for r in dense.fit(d).transform(d).select("doc_id", "prediction").collect()}
    assert a == b
    with pytest.raises(ValueError):
        P.language_pipeline("lang", kind="tree")


@pytest.mark.parametrize("kind", ["tree", "forest", "logistic"])
def test_other_classifiers_take_a_small_vocabulary(lines, kind):
    model = P.language_pipeline("lang", kind=kind, vocab_size=50).fit(lines)
    assert model.transform(lines).where("langId <> prediction").where("fullText <> ''").count() == 0


def test_logistic_equals_dense_gradient_descent(spark):
    rng = np.random.default_rng(5)
    words = [f"w{i}" for i in range(12)] + ["the"]
    rows = [(i, float(rng.random() < .4), ["the"] * int(rng.integers(0, 5)) + list(map(str, rng.choice(words, rng.integers(0, 9))))) for i in range(60)]
    rows += [(100, 1.0, []), (101, 0.0, None)]
    df = spark.createDataFrame(rows, "id long, y double, tokens array<string>").repartition(4)
    model = logistic.fit(df, "y", "id", "tokens", steps=4, step=3.0, penalty=0.01)
    x = np.array([[(r[2] or []).count(w) / max(1, len(r[2] or [])) for w in words] for r in rows])
    y = np.array([r[1] for r in rows])
    w, b, losses = np.zeros(len(words)), 0.0, []
    for _ in range(4):
        z = x @ w + b
        losses.append(float(np.mean(np.maximum(z, 0) - z * y + np.log1p(np.exp(-abs(z)))) + 0.005 * (w * w).sum()))
        e = 1 / (1 + np.exp(-z)) - y
        w, b = w - 3.0 * (x.T @ e / len(y) + 0.01 * w), b - 3.0 * e.mean()
    assert np.allclose(model.losses, losses) and losses == sorted(losses, reverse=True)
    got = {r.term: r.w for r in model.weights.collect()}
    assert all(math.isclose(got[t], v, abs_tol=1e-9) for t, v in zip(words, w, strict=True)) and math.isclose(model.intercept, b)
    p = {r.id: r.probability for r in logistic.predict(model, df, "id", "tokens").collect()}
    assert all(math.isclose(p[r[0]], q, abs_tol=1e-9) for r, q in zip(rows, 1 / (1 + np.exp(-(x @ w + b))), strict=True))


def test_logistic_of_an_empty_table(spark):
    df = spark.createDataFrame([], "id long, y double, tokens array<string>")
    model = logistic.fit(df, "y", "id", "tokens")
    assert model.losses == [] and logistic.predict(model, df, "id", "tokens").count() == 0
