"""MOD-4: binary logistic regression on sparse long-form features.

The weights are a table ``(term, w)`` that grows with the vocabulary and never leaves
the cluster.  A document's features are its term shares ``x = tf / tokens``; full-batch
gradient descent on the mean logistic loss plus ``penalty / 2 * |w|^2``:

    margin_d = b + sum_t x_dt * w_t          (join on the term, sum per document)
    w_t     -= step * (mean_d x_dt * (p_d - y_d) + penalty * w_t)   (sum per term)

The shares are written once, a document's terms in one row: the join with the errors
shuffles these rows, a hot term is collapsed by the partial aggregate of the gradient,
and the join with the weights leaves a skewed term to AQE's skew split.  Each step's weights are written to the shared folder, so a
lost executor costs one step at most and the lineage stays short.  The driver holds
two numbers a step: the loss and the intercept's gradient.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.features import by_document
from kiln.session import scratch_path

STEPS = 5
STEP = 20.0
PENALTY = 1e-4


@dataclass
class LongLogisticModel:
    """Weights by term, the intercept, and the loss before each step."""
    weights: DataFrame        # term, w
    intercept: float
    losses: list[float]


def shares(docs: DataFrame, id_col: str, tokens_col: str, keep=()) -> DataFrame:
    """(id, keep, term, x): each term's share of the document's tokens.  A document
    without tokens has one row with a null term and x = 0."""
    rows = by_document(docs, id_col).select(id_col, *keep, F.size(tokens_col).alias("_n"), F.explode_outer(tokens_col).alias("term"))
    return (rows.groupBy(id_col, *keep, "_n", "term").agg(F.count("term").alias("_tf"))
            .select(id_col, *keep, "term", (F.col("_tf") / F.greatest("_n", F.lit(1))).alias("x")))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def margins(x: DataFrame, weights: DataFrame, intercept: float, id_col: str, keep=()) -> DataFrame:
    """(id, keep, z) of every document."""
    return (x.join(weights, "term", "left").groupBy(id_col, *keep)
            .agg((F.lit(intercept) + F.coalesce(F.sum(F.col("x") * F.col("w")), F.lit(0.0))).alias("z")))


def fit(docs: DataFrame, label_col: str, id_col: str, tokens_col: str, steps: int = STEPS, step: float = STEP,
        penalty: float = PENALTY) -> LongLogisticModel:
    """Fit on (id, label 0 or 1, tokens); ``id_col`` is unique."""
    # a document's terms are one row: the join with the errors then sends each id once
    packed = _stored(shares(docs, id_col, tokens_col, (label_col,)).groupBy(id_col, label_col)
                     .agg(F.collect_list(F.struct("term", "x")).alias("_terms")), "logistic-shares")
    x = packed.select(id_col, label_col, F.inline("_terms"))
    weights = _stored(x.where("term is not null").select("term").distinct().withColumn("w", F.lit(0.0)), "logistic-weights")
    intercept, losses = 0.0, []
    y = F.col(label_col).cast("double")
    for _ in range(steps):
        errors = _stored(margins(x, weights, intercept, id_col, (label_col,))
                         .select(id_col, (1 / (1 + F.exp(-F.col("z"))) - y).alias("e"),
                                 # the loss, without overflow: max(z, 0) - z * y + ln(1 + exp(-|z|))
                                 (F.greatest("z", F.lit(0.0)) - F.col("z") * y + F.log1p(F.exp(-F.abs("z")))).alias("loss")), "logistic-errors")
        n, gradient, loss = errors.agg(F.count(F.lit(1)), F.avg("e"), F.avg("loss")).first()
        if not n:
            break
        squares = weights.agg(F.sum(F.col("w") * F.col("w"))).first()[0] or 0.0
        losses.append(loss + penalty / 2 * squares)
        by_term = (packed.select(id_col, "_terms").join(errors.select(id_col, "e"), id_col)
                   .select("e", F.inline("_terms")).groupBy("term").agg(F.sum(F.col("x") * F.col("e")).alias("g")))
        weights = _stored(weights.join(by_term, "term").select(
            "term", (F.col("w") - step * (F.col("g") / n + penalty * F.col("w"))).alias("w")), "logistic-weights")
        intercept -= step * gradient
    return LongLogisticModel(weights, intercept, losses)


def predict(model: LongLogisticModel, docs: DataFrame, id_col: str, tokens_col: str, keep=()) -> DataFrame:
    """(id, keep, probability, prediction); terms without a weight count nothing."""
    z = margins(shares(docs, id_col, tokens_col, keep), model.weights, model.intercept, id_col, keep)
    p = 1 / (1 + F.exp(-F.col("z")))
    return z.select(id_col, *keep, p.alias("probability"), (F.col("z") > 0).cast("double").alias("prediction"))
