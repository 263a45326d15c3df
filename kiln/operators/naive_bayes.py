"""MOD-6: multinomial Naive Bayes in long form.

The model is a sparse table ``(term, k, w)`` with one row per non-zero
(term, class) pair, ``w = ln(count + alpha)``, plus per-class constants.  It
grows with the non-zero pairs, never with classes x vocabulary, so it can be
fitted, saved and applied when the dense ``ml`` model cannot.

Scores equal ``ml.classification.NaiveBayes(modelType="multinomial")``:

    prior_c  = ln(n_c + alpha) - ln(N + K * alpha)
    theta_tc = ln(cnt_tc + alpha) - ln(T_c + V * alpha)
    score_dc = prior_c + sum_t tf_dt * theta_tc        (t in the vocabulary)
             = prior_c - n_d * ln(T_c + V * alpha) + sum_{cnt_tc > 0} tf_dt * (ln(cnt_tc + alpha) - ln(alpha))

Only the last sum needs the join, and only over non-zero pairs.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kiln.operators import packed
from kiln.operators.features import by_document, label_index, term_occurrences
from kiln.session import scratch_path

# Labels whose constants the driver holds; a label column with more distinct
# values is taken for a mistake (an id column, say) and refused.
MAX_CLASSES = 10_000

# Up to so many classes, a label is numbered by tests in the row; by a join above.
WIDE_CLASSES = 16

# Terms of the weight table that a task of the scoring join holds.
JOIN_TERMS = 500_000

# Above so many terms they are joined in blocks of many (kiln.operators.packed).
PACK_TERMS = 2_000_000

# class id of the extra "term is in the vocabulary" row per term
VOCAB_MARK = -1


@dataclass
class ClassInfo:
    label: str
    idx: int
    n_docs: int
    n_terms: int
    prior: float
    log_denominator: float


@dataclass
class LongNaiveBayesModel:
    """Fitted model: distributed weight table + per-class constants (K rows)."""

    weights: DataFrame          # term, k, w   (k = VOCAB_MARK rows carry w = 1)
    classes: list[ClassInfo]    # ordered by index
    vocab_size: int
    alpha: float = 1.0
    # True when the vocabulary may hold terms without any class count: such
    # terms then carry VOCAB_MARK rows.  Otherwise a token is in the vocabulary
    # exactly when it finds a weight row, and no mark rows are needed.
    marks: bool = False
    # how the tokens were made from text (see kiln.plans.jobs.FEATURES); scoring
    # new text uses the same recipe
    features: str = "words"
    # the counts behind the weights in blocks (kiln.operators.packed), where the model was
    # fitted on every term
    counted: DataFrame | None = None

    @property
    def labels(self) -> list[str]:
        return [c.label for c in self.classes]

    def class_table(self, spark: SparkSession) -> DataFrame:
        rows = [(c.label, c.idx, c.n_docs, c.n_terms, c.prior, c.log_denominator)
                for c in self.classes]
        return spark.createDataFrame(
            rows, "label string, idx int, n_docs long, n_terms long, prior double, log_denominator double")

    def save(self, path: str) -> None:
        """SNK-1 (long form): weights and class table as parquet."""
        spark = self.weights.sparkSession
        self.weights.write.mode("overwrite").parquet(f"{path}/weights")
        self.class_table(spark).withColumn("vocab_size", F.lit(self.vocab_size)) \
            .withColumn("alpha", F.lit(self.alpha)).withColumn("marks", F.lit(self.marks)) \
            .withColumn("features", F.lit(self.features)).coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LongNaiveBayesModel":
        cls = spark.read.parquet(f"{path}/classes").orderBy("idx").collect()
        classes = [ClassInfo(r.label, r.idx, r.n_docs, r.n_terms, r.prior, r.log_denominator)
                   for r in cls]
        return LongNaiveBayesModel(spark.read.parquet(f"{path}/weights"), classes,
                                   int(cls[0].vocab_size), float(cls[0].alpha), bool(cls[0].marks), cls[0].features)


def class_counts(docs: DataFrame, label_col: str, tokens_col: str, term_col: str = "term") -> DataFrame:
    """AGG-12: token count per (class, term).  Map-side partial aggregation
    collapses a hot term to one row per (partition, class) before the shuffle."""
    occ = term_occurrences(docs, label_col, tokens_col, term_col=term_col)
    return occ.groupBy(label_col, term_col).agg(F.count(F.lit(1)).alias("cnt"))


def _packed_counts(docs: DataFrame, label_col: str, tokens_col: str, numbers: DataFrame, index: list) -> DataFrame:
    """The (term, class) counts in blocks (:func:`kiln.operators.packed.class_counts`)."""
    if len(index) <= WIDE_CLASSES:
        docs = docs.withColumn("_k", packed.class_number(label_col, index))
    else:
        docs = docs.join(F.broadcast(numbers), F.col(label_col).eqNullSafe(F.col("_label"))).withColumnRenamed("k", "_k")
    return packed.class_counts(term_occurrences(docs, "_k", tokens_col).select("term", F.col("_k").alias("k")))


def _counts_by_term(docs: DataFrame, label_col: str, tokens_col: str, numbers: DataFrame, index: list) -> DataFrame:
    """One row for each training term, so that its rows count the vocabulary: (term,
    found: [(k, cnt)])."""
    return packed.by_term(_packed_counts(docs, label_col, tokens_col, numbers, index))


def fit(docs: DataFrame, label_col: str, tokens_col: str, alpha: float = 1.0,
        vocabulary: DataFrame | None = None, class_prior_k: int | None = None) -> LongNaiveBayesModel:
    """Fit on a DataFrame of (label, tokens).

    ``vocabulary`` (a ``term`` column) restricts the features like a
    ``CountVectorizer`` vocabulary; default = every training term.
    ``class_prior_k`` overrides K in the prior (one-vs-rest uses 2).
    The driver only receives K rows of class constants and one count; K is
    bounded by :data:`MAX_CLASSES`.
    """
    # The count table feeds class totals, vocabulary size and weights: it is
    # written once to the shared folder (a model outlives its executors, and
    # nothing stays cached) and its lineage ends there.
    spark = docs.sparkSession
    index = label_index(docs, label_col).select(label_col, F.col("idx").cast("int").alias("idx"), "n") \
        .orderBy("idx").limit(MAX_CLASSES + 1).collect()
    if len(index) > MAX_CLASSES:
        raise ValueError(f"{label_col} has more than {MAX_CLASSES} distinct labels")
    # K rows, at most MAX_CLASSES
    numbers = spark.createDataFrame([(r[0], r.idx) for r in index], T.StructType([T.StructField("_label", docs.schema[label_col].dataType), T.StructField("k", T.IntegerType())]))
    counted = _packed_counts(docs, label_col, tokens_col, numbers, [(r[0], r.idx) for r in index])
    path = scratch_path(spark, "nb-counts")
    if vocabulary is None:
        counted.write.parquet(path)
        counted = spark.read.schema(counted.schema).parquet(path)
        counts = packed.unpacked(counted)
        totals = counted.select(F.inline("totals"))
        v = counted.agg(F.coalesce(F.sum("terms"), F.lit(0))).first()[0]
    else:
        by_term = packed.by_term(counted).join(vocabulary.select("term"), "term", "left_semi")
        by_term.write.parquet(path)
        by_term = spark.read.schema(by_term.schema).parquet(path)
        counts = by_term.select("term", F.inline("found"))
        totals = counts.select("k", F.col("cnt").alias("n"))
        v = vocabulary.select("term").count()
    n_terms = {r.k: r.n for r in totals.groupBy("k").agg(F.sum("n").alias("n")).collect()}
    n_total = sum(r.n for r in index)
    k = class_prior_k or len(index)
    labels = {r.k: r.label for r in numbers.select("k", F.col("_label").cast("string").alias("label")).collect()}
    classes = [ClassInfo(labels[r.idx], r.idx, r.n, n_terms.get(r.idx, 0),
                         math.log(r.n + alpha) - math.log(n_total + k * alpha),
                         math.log(n_terms.get(r.idx, 0) + v * alpha)) for r in index]
    log_alpha = math.log(alpha)
    pairs = counts.select("term", "k", (F.log(F.col("cnt") + alpha) - F.lit(log_alpha)).alias("w"))
    if vocabulary is None:
        return LongNaiveBayesModel(pairs, classes, v, alpha, counted=counted)
    marks = vocabulary.select("term").join(by_term.select("term"), "term", "left_anti") \
        .select("term", F.lit(VOCAB_MARK).alias("k"), F.lit(1.0).alias("w"))
    return LongNaiveBayesModel(pairs.unionByName(marks), classes, v, alpha, marks=True)


def with_row_id(df: DataFrame, out: str = "_row") -> DataFrame:
    """A unique id per record of a file scan (partition and place in it).  Texts
    and URIs repeat, so neither they nor their hash may stand for a record; call
    this on the scan, before anything is shuffled."""
    return df.withColumn(out, F.monotonically_increasing_id())


def _joined(model: LongNaiveBayesModel, docs: DataFrame, keys: list, tokens_col: str) -> DataFrame:
    """(keys, k, s, t) of each (document, term) and class that has the term, rows of Spark."""
    occ = docs.select(*keys[:-1], F.size(tokens_col).alias("_n_tok"),
                      F.explode_outer(tokens_col).alias("term"))
    # (doc, term, tf) inside the partition; the empty-document row has tf = 0
    tf = occ.groupBy(*keys, "term").agg(F.count("term").alias("tf"))
    weights = model.weights
    if model.vocab_size > JOIN_TERMS:
        # a large table is not sorted: tasks hash so many of its terms each
        n = -(-model.vocab_size // JOIN_TERMS)
        try:
            n = max(n, docs.sparkSession.sparkContext.defaultParallelism)
        except Exception:  # noqa: BLE001 - remote session: only the configuration is visible
            pass
        tf, weights = tf.repartition(n, "term"), weights.repartition(n, "term").hint("shuffle_hash")
    return tf.join(weights, "term", "left").select(*keys, "k", (F.col("tf") * F.col("w")).alias("s"), F.col("tf").alias("t"))


def _packed_join(model: LongNaiveBayesModel, docs: DataFrame, keys: list, tokens_col: str) -> DataFrame:
    """The same by blocks of terms, summed within a bucket of terms."""
    names = [f"_c{i}" for i in range(len(keys))]
    docs = docs.select(*(F.col(c).alias(n) for c, n in zip(keys[:-1], names, strict=False)), F.size(tokens_col).alias(names[-1]),
                       F.explode_outer(tokens_col).alias("term"))
    occ = docs.select("term", *names, F.when(F.col("term").isNotNull(), 1).otherwise(0).cast("long").alias("tf"))
    blocks = model.counted if model.counted is not None else packed.pack(model.weights.select("term", "k", "w"), None)
    found = packed.scored(occ, blocks, model.alpha)
    return found.select(*(F.col(n).alias(c) for c, n in zip(keys, names, strict=True)), "k", "s", "t")


def raw_scores(model: LongNaiveBayesModel, docs: DataFrame, id_col: str, tokens_col: str,
               keep=(), partitioned: bool = False) -> DataFrame:
    """Per document: ``scores`` array (one log-joint per class, index order).
    ``id_col`` must be unique (:func:`with_row_id` where records have no id).

    Plan: documents hashed on id -> explode -> (doc, term, tf) counted inside
    the partition -> left join weights on term (up to :data:`JOIN_TERMS` terms AQE
    picks a broadcast when the weight table is small at run time, and splits skewed
    hot terms otherwise; above, a hash join of as many partitions as the terms need,
    where a hot term has one row a document; above :data:`PACK_TERMS`, by blocks of terms,
    and the documents' texts are not shuffled at all) -> classes as rows: one sum per (doc, class) that shares a
    term, then one row per doc.  The classes of a (doc, term) are never tested
    against each other, so the work grows with the non-zero pairs.
    """
    keys = [id_col, *keep, "_n_tok"]
    if model.vocab_size > PACK_TERMS and not docs.isStreaming and packed.packable(*(docs.schema[c].dataType for c in keys[:-1])):
        joined = _packed_join(model, docs, keys, tokens_col)
    else:
        joined = _joined(model, docs if partitioned else by_document(docs, id_col), keys, tokens_col)
    by_class = joined.groupBy(id_col, *keep, "_n_tok", "k").agg(
        F.sum("s").alias("s"), F.sum("t").alias("t"))
    # in-vocabulary tokens: all tokens minus those without any weight row
    # (a mark row counts as a weight row)
    agg = by_class.groupBy(id_col, *keep, "_n_tok").agg(
        F.sum(F.when(F.col("k").isNull(), F.col("t")).otherwise(0)).alias("n_oov"),
        F.map_from_entries(F.collect_list(F.when(F.col("k").isNotNull(), F.struct("k", "s")))).alias("found"))
    n_v = F.greatest(F.col("_n_tok"), F.lit(0)) - F.col("n_oov")
    log_alpha = math.log(model.alpha)
    constants = F.array(*[F.struct(F.lit(c.idx).alias("k"), F.lit(c.prior).alias("prior"),
                                   F.lit(c.log_denominator - log_alpha).alias("each")) for c in model.classes])
    scores = F.transform(constants, lambda c: c["prior"] - n_v * c["each"]
                         + F.coalesce(F.try_element_at(F.col("found"), c["k"]), F.lit(0.0)))
    return agg.select(id_col, *keep, scores.alias("scores"))


def predict(model: LongNaiveBayesModel, docs: DataFrame, id_col: str, tokens_col: str,
            keep=(), partitioned: bool = False) -> DataFrame:
    """TOP-5: arg max class (first max = smallest index on ties); one row out
    for each row in, provided ``id_col`` is unique."""
    scored = raw_scores(model, docs, id_col, tokens_col, keep, partitioned)
    labels = F.array(*[F.lit(c.label) for c in model.classes])
    best = F.array_position(F.col("scores"), F.array_max("scores"))
    return scored.select(
        id_col, *keep,
        (best - 1).cast("double").alias("prediction"),
        F.element_at(labels, best.cast("int")).alias("predicted_label"),
        F.array_max("scores").alias("score"),
    )
