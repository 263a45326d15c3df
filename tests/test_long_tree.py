"""The long-form tree (MOD-3) against MLlib's."""

import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import CountVectorizerModel

from kiln.operators import long_tree
from kiln.operators import pipelines as P
from kiln.session import scratch_path


@pytest.fixture(scope="module")
def docs(spark):
    rng, rows = random.Random(3), []
    for i in range(400):
        c = rng.randrange(4)
        words = [f"w{int(rng.expovariate(.25)) + 2 * c * (rng.random() < .4)}" for _ in range(rng.randrange(60))]
        rows.append((i % 350, " ".join(words), "abcd"[c]))
    return spark.createDataFrame(rows, "doc_id long, fullText string, lang string").repartition(3)


def test_tree_equals_mllib(spark, docs):
    model = P.language_pipeline("lang", kind="tree", vocab_size=20).fit(docs)
    assert not any("CountVector" in type(s).__name__ for s in model.stages)    # no dense vector of the vocabulary
    got = model.transform(docs)
    stats = got.selectExpr("explode(words) term").groupBy("term").count().collect()
    vocabulary = [r[0] for r in sorted(stats, key=lambda r: (-r[1], r[0]))][:20]
    x = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="words", outputCol="x").transform(got.select("doc_id", "words", "langId", "fullText"))
    theirs = DecisionTreeClassifier(featuresCol="x", labelCol="langId", seed=42).fit(x).transform(x)
    a, b = (sorted((r.doc_id, r.fullText, r.prediction, [round(v, 9) for v in r.probability if v]) for r in d.collect()) for d in (got, theirs))
    assert a == b and len(a) == 400


def test_tree_is_saved(spark, docs):
    model = P.language_pipeline("lang", kind="tree", vocab_size=50).fit(docs)
    path = scratch_path(spark, "tree")
    model.write().overwrite().save(path)
    a, b = (sorted((r.doc_id, r.fullText, r.prediction) for r in m.transform(docs).collect()) for m in (model, PipelineModel.load(path)))
    assert a == b


def test_thresholds_and_vocabulary(spark):
    assert long_tree.thresholds([(1, 2), (5, 1)], 4, 31) == [0.5, 3.0]
    assert long_tree.thresholds([(2, 4)], 4, 31) == []
    assert long_tree.thresholds([(i, 1) for i in range(1, 101)], 100, 3) == [25.5, 50.5, 75.5]
    stats = spark.createDataFrame([("a", 1), ("b", 3), ("c", 1), ("d", 1), ("e", 2)], "term string, cnt long")
    kept = {n: {r.term for r in long_tree.most_frequent(stats, n).collect()} for n in (1, 3, 4, 5, 9)}
    assert kept == {1: {"b"}, 3: {"b", "e", "a"}, 4: {"b", "e", "a", "c"}, 5: set("abcde"), 9: set("abcde")}
