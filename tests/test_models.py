"""Long-form operators against MLlib (MOD-6 vs NaiveBayes, IDF), pipelines
save/load (SNK-1), evaluation properties (EVA-1)."""

import math

from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from kiln.operators import evaluate, naive_bayes as nb
from kiln.operators import pipelines as P
from kiln.operators.features import label_index
from kiln.plans.common import doc_tokens
from kiln.session import scratch_path


def test_long_form_nb_equals_mllib(spark, sf):
    d = doc_tokens(spark, sf)
    train, test = d.filter("is_train"), d.filter("NOT is_train")
    model = nb.fit(train, "lang", "tokens")
    ours = {r.doc_id: r.predicted_label for r in nb.predict(model, test, "doc_id", "tokens").collect()}

    cv = CountVectorizer(inputCol="tokens", outputCol="f", vocabSize=1 << 22).fit(train)
    idx = label_index(train, "lang")
    lab = {r.lang: r.idx for r in idx.collect()}
    names = {v: k for k, v in lab.items()}
    m = F.create_map(*[x for k, v in lab.items() for x in (F.lit(k), F.lit(v))])
    tr = cv.transform(train).withColumn("label", m[F.col("lang")])
    ml = NaiveBayes(featuresCol="f", labelCol="label", modelType="multinomial").fit(tr)
    theirs = {r.doc_id: names[r.prediction] for r in ml.transform(cv.transform(test)).collect()}
    assert ours == theirs
    # same priors as the ml model
    pis = ml.pi.toArray()
    for c in model.classes:
        assert math.isclose(c.prior, pis[c.idx], rel_tol=1e-9)


def test_long_form_model_save_load(spark, sf):
    d = doc_tokens(spark, sf)
    model = nb.fit(d.filter("is_train"), "lang", "tokens")
    path = scratch_path(spark, "nbmodel")
    model.save(path)
    back = nb.LongNaiveBayesModel.load(spark, path)
    test = d.filter("NOT is_train")
    a = {r.doc_id: r.predicted_label for r in nb.predict(model, test, "doc_id", "tokens").collect()}
    b = {r.doc_id: r.predicted_label for r in nb.predict(back, test, "doc_id", "tokens").collect()}
    assert a == b and back.labels == model.labels


def test_pipeline_with_sql_stripper_saves(spark, sf):
    from pyspark.ml import PipelineModel
    d = spark.read.parquet(f"{sf}/documents.parquet").select(
        F.col("text").alias("fullText"), (F.col("lang") == "en").cast("double").alias("category"))
    model = P.tfidf_pipeline("category").fit(d)
    path = scratch_path(spark, "pipeline")
    model.write().overwrite().save(path)
    back = PipelineModel.load(path)
    a = [r.prediction for r in model.transform(d).orderBy("fullText").collect()]
    b = [r.prediction for r in back.transform(d).orderBy("fullText").collect()]
    assert a == b


def test_one_vs_rest_equals_multiclass(spark, sf):
    d = doc_tokens(spark, sf)
    train, test = d.filter("is_train"), d.filter("NOT is_train")
    multi = nb.predict(nb.fit(train, "lang", "tokens"), test, "doc_id", "tokens")
    ovr = nb.predict(nb.fit(train, "lang", "tokens", class_prior_k=2), test, "doc_id", "tokens")
    assert {r.doc_id: r.predicted_label for r in multi.collect()} == \
           {r.doc_id: r.predicted_label for r in ovr.collect()}


def test_confusion_sums_and_matrix(spark, sf):
    from kiln.plans.classify import lang_predictions
    p = lang_predictions(spark, sf)
    conf = evaluate.confusion_counts(p)
    assert conf.agg(F.sum("n")).first()[0] == p.count()
    labels = ["de", "en", "es", "fr"]
    mat = evaluate.confusion_matrix(conf, labels)
    assert mat.count() == 4 and mat.columns == ["label"] + labels
    total = mat.select(sum(F.col(c) for c in labels).alias("s")).agg(F.sum("s")).first()[0]
    assert total == p.count()


def test_matrix_csv_header(spark, sf, tmp_path):
    from kiln.sinks.files import write_matrix_csv
    conf = spark.createDataFrame([("a", "a", 3), ("a", "b", 1), ("b", "b", 2)], "label string, prediction string, n long")
    path = scratch_path(spark, "matrix")
    write_matrix_csv(evaluate.confusion_matrix(conf, ["a", "b"]), path)
    back = spark.read.option("header", True).csv(path)
    assert back.columns == ["v label / prediction ->", "a", "b"]
    assert sorted(tuple(r) for r in back.collect()) == [("a", "3", "1"), ("b", "0", "2")]


def test_missing_labels(spark):
    e = spark.createDataFrame([("a",), ("b",), ("b",)], "l string")
    s = spark.createDataFrame([("b",), ("c",)], "l string")
    out = sorted(tuple(r) for r in evaluate.missing_labels(e, s, "l").collect())
    assert out == [("a", "expected_only"), ("c", "seen_only")]


def test_vocabulary_restricted_nb_equals_mllib(spark, sf):
    """A given vocabulary (CountVectorizer-like) including terms never seen in
    training: those terms still count as in-vocabulary (mark rows)."""
    d = doc_tokens(spark, sf)
    train, test = d.filter("is_train"), d.filter("NOT is_train")
    cv = CountVectorizer(inputCol="tokens", outputCol="f", vocabSize=500).fit(train)
    vocab = spark.createDataFrame([(t,) for t in cv.vocabulary] + [("zzunseen",)], "term string")
    model = nb.fit(train, "lang", "tokens", vocabulary=vocab)
    assert model.marks and model.vocab_size == 501
    ours = {r.doc_id: r.predicted_label for r in nb.predict(model, test, "doc_id", "tokens").collect()}
    lab = {r.lang: r.idx for r in label_index(train, "lang").collect()}
    names = {v: k for k, v in lab.items()}
    from pyspark.ml.feature import CountVectorizerModel
    cv2 = CountVectorizerModel.from_vocabulary(cv.vocabulary + ["zzunseen"], inputCol="tokens", outputCol="f")
    m = F.create_map(*[x for k, v in lab.items() for x in (F.lit(k), F.lit(v))])
    ml = NaiveBayes(featuresCol="f", labelCol="label", modelType="multinomial").fit(
        cv2.transform(train).withColumn("label", m[F.col("lang")]))
    theirs = {r.doc_id: names[r.prediction] for r in ml.transform(cv2.transform(test)).collect()}
    assert ours == theirs


def test_probe_rows_scored(spark, sf):
    """SRC-15 + MOD-7: in-line probe sentences scored with the language model."""
    from kiln.functions.text import strip_punctuation, tokenize
    from kiln.sources.text import inline_rows
    d = doc_tokens(spark, sf)
    model = nb.fit(d.filter("is_train"), "lang", "tokens")
    probes = inline_rows(spark, [(1, "The weather is nice and the sea is calm."),
                                 (2, "Le chat dort sur la chaise près de la fenêtre."),
                                 (3, "≈57.7 units, mostly (n=18) — assessed."),
                                 (4, "")], "id int, fullText string")
    toks = probes.select("id", tokenize(strip_punctuation("fullText")).alias("tokens"))
    out = {r.id: r.predicted_label for r in nb.predict(model, toks, "id", "tokens").collect()}
    assert set(out) == {1, 2, 3, 4} and set(out.values()) <= set(model.labels)
