"""Classification jobs (J1-J4 shapes) as registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.text import strip_punctuation, tokenize
from kiln.operators import evaluate, naive_bayes as nb
from kiln.operators.features import ngram_space
from kiln.operators.select import hash_bucket
from kiln.plans.common import TRAIN_PERCENT, doc_tokens, r6
from kiln.session import read_table


def lang_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4 shape: language of every held-out document (long-form NB)."""
    d = doc_tokens(spark, sf_dir)
    train = d.filter("is_train")
    test = d.filter("NOT is_train")
    model = nb.fit(train, "lang", "tokens")
    p = nb.predict(model, test, "doc_id", "tokens", keep=("lang",), partitioned=True)
    return p.select("doc_id", F.col("lang").alias("label"),
                    F.col("predicted_label").alias("prediction"),
                    F.round("score", 4).alias("score"))


def q_nb_predict_lang(spark, sf_dir):
    return lang_predictions(spark, sf_dir)


def q_nb_model(spark, sf_dir):
    """AGG-12 + MOD-6: the long-form model table with theta per (class, term)."""
    d = doc_tokens(spark, sf_dir).filter("is_train")
    model = nb.fit(d, "lang", "tokens")
    classes = model.class_table(spark).select("label", "idx", "log_denominator")
    counts = nb.class_counts(d, "lang", "tokens").withColumnRenamed("lang", "label")
    return (counts.join(F.broadcast(classes), "label")   # K rows, bounded by the label set
            .select("label", "term", "cnt",
                    r6(F.log(F.col("cnt") + 1) - F.col("log_denominator")).alias("theta")))


def q_nb_classes(spark, sf_dir):
    """Per-class constants of the long-form model (prior, totals)."""
    d = doc_tokens(spark, sf_dir).filter("is_train")
    model = nb.fit(d, "lang", "tokens")
    return model.class_table(spark).select(
        "label", "idx", "n_docs", "n_terms", r6(F.col("prior")).alias("prior"),
        r6(F.col("log_denominator")).alias("log_denominator"))


def q_confusion(spark, sf_dir):
    return evaluate.confusion_counts(lang_predictions(spark, sf_dir))


def q_accuracy(spark, sf_dir):
    acc = evaluate.accuracy(evaluate.confusion_counts(lang_predictions(spark, sf_dir)))
    return acc.select("n_rows", "n_correct", r6(F.col("accuracy")).alias("accuracy"),
                      r6(F.col("test_error")).alias("test_error"))


def q_per_label(spark, sf_dir):
    per = evaluate.per_label(evaluate.confusion_counts(lang_predictions(spark, sf_dir)))
    return per.select("label", "n_rows", "n_correct", r6(F.col("recall")).alias("recall"))


# --- J1 shape: per text line, binary label -------------------------------------------------
def labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the labelled documents (FLT-1), class = quality as a double,
    unit = one line, split key = (doc, line number)."""
    from kiln.functions.text import is_wiki_text_line, lines_of
    d = read_table(spark, sf_dir, "documents").join(read_table(spark, sf_dir, "labels"), "doc_id")
    lines = (d.select("doc_id", F.col("quality").cast("double").alias("category"),
                      F.posexplode_outer(lines_of("text")).alias("pos", "line"))
             .filter(F.col("line").isNotNull() & is_wiki_text_line("line")))
    key = F.concat_ws(":", F.col("doc_id").cast("string"), F.col("pos").cast("string"))
    return lines.select(key.alias("key"), "category",
                        tokenize(strip_punctuation("line")).alias("tokens"),
                        (hash_bucket(key) < TRAIN_PERCENT).alias("is_train"))


def q_nb_binary(spark, sf_dir):
    d = labelled_lines(spark, sf_dir)
    model = nb.fit(d.filter("is_train"), "category", "tokens")
    p = nb.predict(model, d.filter("NOT is_train"), "key", "tokens", keep=("category",))
    return p.select("key", F.col("category").alias("label"),
                    F.col("predicted_label").cast("double").alias("prediction"),
                    F.round("score", 4).alias("score"))


# --- J3 shape: 3-gram + 4-gram counts -------------------------------------------------------
def q_nb_ngram(spark, sf_dir):
    d = ngram_space(doc_tokens(spark, sf_dir), "tokens", (3, 4))
    model = nb.fit(d.filter("is_train"), "lang", "grams")
    p = nb.predict(model, d.filter("NOT is_train"), "doc_id", "grams", keep=("lang",), partitioned=True)
    return p.select("doc_id", F.col("lang").alias("label"),
                    F.col("predicted_label").alias("prediction"), F.round("score", 4).alias("score"))


# --- J2 shape: one-vs-rest over Naive Bayes -------------------------------------------------
def q_ovr_predict(spark, sf_dir):
    """MOD-2 in long form: each binary model's positive-class score differs from
    the multi-class score only by its prior (K = 2), so one pass scores all."""
    d = doc_tokens(spark, sf_dir)
    model = nb.fit(d.filter("is_train"), "lang", "tokens", class_prior_k=2)
    p = nb.predict(model, d.filter("NOT is_train"), "doc_id", "tokens", keep=("lang",), partitioned=True)
    return p.select("doc_id", F.col("lang").alias("label"),
                    F.col("predicted_label").alias("prediction"), F.round("score", 4).alias("score"))


def q_confusion_pivot(spark, sf_dir):
    """AGG-5/EVA-2/SNK-2 shape: label x label matrix, rows and columns from the
    one label table (Q12)."""
    d = doc_tokens(spark, sf_dir)
    model = nb.fit(d.filter("is_train"), "lang", "tokens")
    p = nb.predict(model, d.filter("NOT is_train"), "doc_id", "tokens", keep=("lang",), partitioned=True)
    conf = evaluate.confusion_counts(p.select(F.col("lang").alias("label"),
                                              F.col("predicted_label").alias("prediction")))
    return evaluate.confusion_matrix(conf, model.labels, spark=spark)


EXCLUDED_LANGS = ["es"]


def q_missing_labels(spark, sf_dir):
    """SET-3 + FLT-5: languages expected (on disk, minus the exclusion list)
    versus languages the model predicts on the held-out part."""
    docs = read_table(spark, sf_dir, "documents")
    expected = docs.filter(~F.col("lang").isin(EXCLUDED_LANGS)).select(F.col("lang").alias("label"))
    seen = lang_predictions(spark, sf_dir).select(F.col("prediction").alias("label"))
    return evaluate.missing_labels(expected, seen, "label")


def q_class_counts(spark, sf_dir):
    """AGG-1/AGG-2/AGG-4/FLT-6: rows per class in corpus, training and test part
    in one aggregation (the reference runs one job per class)."""
    d = read_table(spark, sf_dir, "documents").select(
        "lang", (hash_bucket("doc_id") < TRAIN_PERCENT).alias("is_train"))
    return d.groupBy(F.col("lang").alias("label")).agg(
        F.count(F.lit(1)).alias("n_all"),
        F.count(F.when(F.col("is_train"), 1)).alias("n_train"),
        F.count(F.when(~F.col("is_train"), 1)).alias("n_test"))


def q_score_probes(spark, sf_dir):
    """SRC-15 + MOD-7: score the probe rows (``benchmark``) with the language model."""
    d = doc_tokens(spark, sf_dir)
    model = nb.fit(d.filter("is_train"), "lang", "tokens")
    probes = read_table(spark, sf_dir, "benchmark").select(
        "item_id", tokenize(strip_punctuation("text")).alias("tokens"))
    p = nb.predict(model, probes, "item_id", "tokens")
    return p.select("item_id", F.col("predicted_label").alias("prediction"),
                    F.round("score", 4).alias("score"))


# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------
from kiln.plans import sqlfrag as S  # noqa: E402


_DOC_SRC = (f"SELECT doc_id, lang, {S.tokens(S.strip('text'))} AS w, "
            f"{S.bucket('doc_id')} < {TRAIN_PERCENT} AS is_train FROM documents")


def _nb_sql(src: str = _DOC_SRC, prior_k: str = "tot.k") -> str:
    """NB fit on the ``is_train`` rows of ``src`` (doc_id, lang, w, is_train) and
    prediction of the others, as CTEs ending in ``pred``."""
    return f"""
d AS ({src}),
occ AS (SELECT lang, unnest(w) AS term FROM d WHERE is_train),
cnt AS (SELECT lang AS label, term, count(*) AS cnt FROM occ GROUP BY ALL),
nc AS (SELECT lang AS label, count(*) AS n FROM d WHERE is_train GROUP BY ALL),
tc AS (SELECT label, sum(cnt) AS t FROM cnt GROUP BY ALL),
v AS (SELECT count(DISTINCT term) AS v FROM cnt),
tot AS (SELECT sum(n) AS n, count(*) AS k FROM nc),
cls AS (SELECT nc.label, row_number() OVER (ORDER BY nc.n DESC, nc.label) - 1 AS idx, nc.n AS n_docs,
               coalesce(tc.t, 0) AS n_terms,
               ln(nc.n + 1) - ln(tot.n + {prior_k}) AS prior, ln(coalesce(tc.t, 0) + v.v) AS logden
        FROM nc LEFT JOIN tc USING (label) CROSS JOIN v CROSS JOIN tot),
tf AS (SELECT doc_id, lang, term, count(*) AS tf
       FROM (SELECT doc_id, lang, unnest(w) AS term FROM d WHERE NOT is_train) GROUP BY ALL),
nv AS (SELECT doc_id, sum(tf) AS n FROM tf WHERE term IN (SELECT term FROM cnt) GROUP BY ALL),
s AS (SELECT tf.doc_id, cnt.label, sum(tf.tf * ln(cnt.cnt + 1)) AS s
      FROM tf JOIN cnt ON tf.term = cnt.term GROUP BY ALL),
docs AS (SELECT doc_id, lang FROM d WHERE NOT is_train),
sc AS (SELECT docs.doc_id, docs.lang, cls.label AS cand, cls.idx,
              cls.prior - coalesce(nv.n, 0) * cls.logden + coalesce(s.s, 0) AS score
       FROM docs CROSS JOIN cls LEFT JOIN nv ON nv.doc_id = docs.doc_id
       LEFT JOIN s ON s.doc_id = docs.doc_id AND s.label = cls.label),
pred AS (SELECT doc_id, lang AS label, first(cand ORDER BY score DESC, idx) AS prediction,
                round(max(score), 4) AS score FROM sc GROUP BY doc_id, lang)"""


_LINES_SRC = f"""SELECT key AS doc_id, CAST(CAST(quality AS DOUBLE) AS VARCHAR) AS lang,
        {S.tokens(S.strip('line'))} AS w, {S.bucket('key')} < {TRAIN_PERCENT} AS is_train
    FROM (SELECT d.doc_id || ':' || (generate_subscripts(string_split(d.text, chr(10)), 1) - 1) AS key,
                 l.quality, unnest(string_split(d.text, chr(10))) AS line
          FROM documents d JOIN labels l USING (doc_id))
    WHERE regexp_matches(line, '[^{S.PY_SPACE[1:-1]}]')
      AND NOT regexp_matches(line, '^{S.PY_SPACE}*(<doc.*>|</doc>){S.PY_SPACE}*$')"""


def _tagged(n):
    return f"list_transform({S.ngrams('w', n)}, lambda g: '{n}' || chr(1) || g)"


_GRAM_SRC = f"""SELECT doc_id, lang, list_concat({_tagged(3)}, {_tagged(4)}) AS w, is_train
    FROM (SELECT doc_id, lang, {S.tokens(S.strip('text'))} AS w,
                 {S.bucket('doc_id')} < {TRAIN_PERCENT} AS is_train FROM documents)"""

_PROBE_SRC = f"""SELECT doc_id, lang, {S.tokens(S.strip('text'))} AS w, TRUE AS is_train FROM documents
        WHERE {S.bucket('doc_id')} < {TRAIN_PERCENT}
    UNION ALL SELECT item_id, NULL, {S.tokens(S.strip('text'))}, FALSE FROM benchmark"""

_PIVOT = """, conf AS (SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL),
grid AS (SELECT a.label, b.label AS prediction, coalesce(conf.n, 0) AS n
         FROM cls a CROSS JOIN cls b LEFT JOIN conf ON conf.label = a.label AND conf.prediction = b.label)
SELECT label, """ + ", ".join(f"max(n) FILTER (WHERE prediction = '{x}') AS {x}" for x in ("de", "en", "es", "fr")) + " FROM grid GROUP BY label"


ORACLE = {
    "q_nb_predict_lang": f"WITH {_nb_sql()} SELECT doc_id, label, prediction, score FROM pred",
    "q_nb_model": f"""WITH {_nb_sql()}
        SELECT cnt.label, cnt.term, cnt.cnt, round(ln(cnt.cnt + 1) - cls.logden, 6) AS theta
        FROM cnt JOIN cls USING (label)""",
    "q_nb_classes": f"""WITH {_nb_sql()}
        SELECT label, CAST(idx AS INTEGER) AS idx, CAST(n_docs AS BIGINT) AS n_docs,
               CAST(n_terms AS BIGINT) AS n_terms, round(prior, 6) AS prior,
               round(logden, 6) AS log_denominator FROM cls""",
    "q_confusion": f"WITH {_nb_sql()} SELECT label, prediction, count(*) AS n FROM pred GROUP BY ALL",
    "q_accuracy": f"""WITH {_nb_sql()},
        c AS (SELECT count(*) AS n_rows, count(*) FILTER (WHERE label = prediction) AS n_correct FROM pred)
        SELECT CAST(n_rows AS BIGINT) AS n_rows, CAST(n_correct AS BIGINT) AS n_correct,
               round(n_correct / n_rows, 6) AS accuracy, round(1 - n_correct / n_rows, 6) AS test_error FROM c""",
    "q_nb_binary": f"""WITH {_nb_sql(_LINES_SRC)}
        SELECT doc_id AS key, CAST(label AS DOUBLE) AS label, CAST(prediction AS DOUBLE) AS prediction, score
        FROM pred""",
    "q_nb_ngram": f"WITH {_nb_sql(_GRAM_SRC)} SELECT doc_id, label, prediction, score FROM pred",
    "q_ovr_predict": f"WITH {_nb_sql(prior_k='2')} SELECT doc_id, label, prediction, score FROM pred",
    "q_confusion_pivot": f"WITH {_nb_sql()} {_PIVOT}",
    "q_missing_labels": f"""WITH {_nb_sql()}
        (SELECT DISTINCT lang AS label, 'expected_only' AS side FROM documents WHERE lang NOT IN ('es')
         EXCEPT SELECT DISTINCT prediction, 'expected_only' FROM pred)
        UNION ALL
        (SELECT DISTINCT prediction, 'seen_only' FROM pred
         EXCEPT SELECT DISTINCT lang, 'seen_only' FROM documents WHERE lang NOT IN ('es'))""",
    "q_class_counts": f"""SELECT lang AS label, count(*) AS n_all,
        count(*) FILTER (WHERE {S.bucket('doc_id')} < {TRAIN_PERCENT}) AS n_train,
        count(*) FILTER (WHERE {S.bucket('doc_id')} >= {TRAIN_PERCENT}) AS n_test FROM documents GROUP BY lang""",
    "q_score_probes": f"WITH {_nb_sql(_PROBE_SRC)} SELECT doc_id AS item_id, prediction, score FROM pred",
    "q_per_label": f"""WITH {_nb_sql()}
        SELECT label, count(*) AS n_rows, count(*) FILTER (WHERE label = prediction) AS n_correct,
               round(count(*) FILTER (WHERE label = prediction) / count(*), 6) AS recall
        FROM pred GROUP BY label""",
}

QUERIES = {
    "q_nb_predict_lang": q_nb_predict_lang,
    "q_nb_model": q_nb_model,
    "q_nb_classes": q_nb_classes,
    "q_confusion": q_confusion,
    "q_accuracy": q_accuracy,
    "q_per_label": q_per_label,
    "q_nb_binary": q_nb_binary,
    "q_nb_ngram": q_nb_ngram,
    "q_ovr_predict": q_ovr_predict,
    "q_confusion_pivot": q_confusion_pivot,
    "q_missing_labels": q_missing_labels,
    "q_class_counts": q_class_counts,
    "q_score_probes": q_score_probes,
}
