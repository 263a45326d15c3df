"""The reference's five user-level jobs as end-to-end functions (J1-J5).

Each returns its results as DataFrames (and writes its sinks when given an
output folder); nothing is collected except model metadata.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.text import clean_article, strip_punctuation, tokenize
from kiln.operators import evaluate, naive_bayes as nb
from kiln.operators import pipelines as P
from kiln.operators.features import by_document
from kiln.operators.select import hash_bucket, union_all
from kiln.sinks import files as sink
from kiln.sources import crawl, text as src


@dataclass
class Evaluation:
    predictions: DataFrame
    confusion: DataFrame        # (label, prediction, n)
    accuracy: DataFrame         # one row: n_rows, n_correct, accuracy, test_error
    per_label: DataFrame


def _evaluate(pred: DataFrame, label_col: str, prediction_col: str = "prediction") -> Evaluation:
    conf = evaluate.confusion_counts(pred, label_col, prediction_col)
    return Evaluation(pred, conf, evaluate.accuracy(conf), evaluate.per_label(conf))


def _split(df: DataFrame, key_col: str, train_percent: int = 80):
    b = hash_bucket(key_col)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def line_classes(spark: SparkSession, folders: dict[str, tuple[str, float]], one_vs_rest: bool = False,
                 ngram_orders=None, train_percent: int = 80):
    """J1 / J2 / J3: ``folders`` maps a folder to (kind, class), kind ``wiki``
    (FLT-1) or ``article`` (FLT-2); every line is a row.  TF-IDF + NB (J1),
    with one-vs-rest (J2), or n-gram counts + NB (J3, ``ngram_orders``)."""
    # one scan per (root, line filter): the class comes from the folder name
    groups: dict[tuple[str, str], dict[str, float]] = {}
    for folder, (kind, cls) in folders.items():
        root, name = folder.rstrip("/").rsplit("/", 1)
        groups.setdefault((root, kind), {})[name] = cls
    parts = [src.labelled_lines(spark, root, labels, kind=kind) for (root, kind), labels in groups.items()]
    rows = union_all(parts, src.LINE_SCHEMA, spark)
    # stable split key: equal lines of one class fall on the same side
    rows = rows.withColumn("_key", F.xxhash64("fullText", "category"))
    train, test = _split(rows, "_key", train_percent)
    pipe = (P.ngram_pipeline("category", orders=ngram_orders) if ngram_orders
            else P.tfidf_pipeline("category", one_vs_rest=one_vs_rest))
    model = pipe.fit(train)
    return model, _evaluate(model.transform(test), "category")


def language_id(spark: SparkSession, corpus_glob: str, exclude=(), out_dir: str | None = None,
                lang_level: int = 2, train_percent: int = 80):
    """J4 with the long-form model: one scan of all languages (SRC-3), FEA-2
    cleaning, per-row hash split (SMP-2 in expectation, no per-language
    window), FEA-3/FEA-4 unigram + bigram features, long-form NB (MOD-6),
    label x prediction matrix (EVA-2) with the missing-label check (SET-3).
    With ``out_dir``: model (SNK-1) and matrix CSV (SNK-2) are written."""
    # every record has its own id, so repeated articles are scored one by one;
    # the content hash only decides the split (equal articles on one side)
    corpus = nb.with_row_id(src.language_corpus(spark, corpus_glob, exclude, lang_level))
    corpus = by_document(corpus.withColumn("_key", F.xxhash64("fullText", "lang")), "_row")
    words = corpus.select("_row", "_key", "lang", tokenize("fullText").alias("w"))
    feats = words.select("_row", "_key", "lang", language_features("w").alias("terms"))
    train, test = _split(feats, "_key", train_percent)
    model = nb.fit(train, "lang", "terms")
    model.features = "language"
    pred = nb.predict(model, test, "_row", "terms", keep=("lang",), partitioned=True)
    ev = _evaluate(pred.select(F.col("lang").alias("label"), F.col("predicted_label").alias("prediction")), "label")
    matrix = evaluate.confusion_matrix(ev.confusion, model.labels, spark=spark)
    expected = corpus.select("lang").distinct()
    missing = evaluate.missing_labels(expected, ev.predictions.select(F.col("label").alias("lang")), "lang")
    if out_dir:
        model.save(f"{out_dir}/model")
        sink.write_matrix_csv(matrix, f"{out_dir}/prediction_matrix")
    return model, ev, matrix, missing


def language_features(words) -> F.Column:
    """Unigrams and bigrams in one tagged term space (the J4 feature vector)."""
    from kiln.functions.text import ngrams
    w = F.col(words) if isinstance(words, str) else words
    return F.concat(F.transform(w, lambda t: F.concat(F.lit("1\u0001"), t)),
                    F.transform(ngrams(w, 2), lambda g: F.concat(F.lit("2\u0001"), g)))


def crawl_documents(spark: SparkSession, wet_path: str, compat: bool = False) -> DataFrame:
    """J5: WET files to a (URI, text) table."""
    return crawl.wet_documents(spark, wet_path, compat)


# What a model's tokens are made of; stored with the model.
FEATURES = {
    "words": lambda text: tokenize(strip_punctuation(text)),
    "language": lambda text: language_features(tokenize(clean_article(text))),
}


def score_crawl(model: nb.LongNaiveBayesModel, docs: DataFrame) -> DataFrame:
    """The stated purpose of J1/J5: score crawl text (URI, text) with a fitted
    model, from the features it was fitted on.  One row per record, also where
    URIs or texts repeat; batch and streaming jobs both use it."""
    terms = nb.with_row_id(docs).select("_row", "URI", FEATURES[model.features]("text").alias("terms"))
    return nb.predict(model, terms, "_row", "terms", keep=("URI",)).select("URI", "predicted_label", "score")
