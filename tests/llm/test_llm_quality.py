import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from kiln.llm import quality as Q


def held(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = Q.scores(docs, Q.fit(docs, labels))
    assert got.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = got.join(labels, "doc_id").collect()
    assert all(r["held_out"] == held(r["doc_id"]) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    out = [r for r in rows if r["held_out"]]
    good, bad = ([r["predicted"] for r in out if r["quality"] == q] for q in (1, 0))
    assert len(bad) > 100 and sum(good) / len(good) > 0.99 and sum(bad) / len(bad) < 0.05


def test_labels_of_held_out_rows_are_not_used(spark, stored):
    rows = [(i, "Plain words in a line of text, as usual." if i % 3 else "X!! Y!! Z!! ### $$$ |") for i in range(300)]
    docs = stored(rows)
    one = spark.createDataFrame([(i, int(i % 3 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    other = one.withColumn("quality", F.when(Q.held_out("doc_id"), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.fit(docs, one), Q.fit(docs, other)
    assert np.array_equal(a.weights, b.weights) and a.cut == b.cut


def test_fit_minimises_the_pairwise_loss(spark):
    """The gradient of the penalised logistic loss over all pairs vanishes, as in a
    dense fit by Newton's method."""
    rng = np.random.default_rng(3)
    x = np.zeros((40, Q.WIDTH))
    x[:, :3] = rng.normal(size=(40, 3))
    good = x[:, 0] + rng.normal(size=40) > 0
    rows = spark.createDataFrame([(i, bool(g), v.tolist()) for i, (g, v) in enumerate(zip(good, x, strict=True))], "id long, good boolean, x array<double>")
    n_few = min(good.sum(), (~good).sum())
    d = np.array([r["x"] for r in Q.pairs(rows, 4).collect()])
    assert len(d) == 4 * max(good.sum(), (~good).sum())
    # every difference is one of a good and a bad row, none twice, and both classes take part as a whole
    every = {tuple(np.round(a - b, 9)) for a in x[good] for b in x[~good]}
    assert {tuple(np.round(v, 9)) for v in d} <= every and n_few * max(good.sum(), (~good).sum()) >= len({tuple(np.round(v, 9)) for v in d}) == len(d)
    d = d[:, :3]
    w = np.zeros(3)
    for _ in range(30):
        p = 1 / (1 + np.exp(-d @ w))
        w += np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / len(d) + Q.PENALTY * np.eye(3), d.T @ (1 - p) / len(d) - Q.PENALTY * w)
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    data = spark.createDataFrame([(float(i % 2), Vectors.dense(v if i % 2 else -v)) for i, v in enumerate(d)], ["label", "features"])
    got = LogisticRegression(fitIntercept=False, standardization=False, regParam=Q.PENALTY, maxIter=Q.STEPS, tol=1e-10).fit(data).coefficients.toArray()
    assert np.allclose(got, w, atol=1e-4)


def test_statistics():
    s = dict(zip(Q.RATES, Q.statistics("Ab CD. x1|\nab ab"), strict=False))
    assert math.isclose(s["again"], 1 / 5) and math.isclose(s["shouted"], 1 / 5) and math.isclose(s["marked"], 1 / 5)
    assert math.isclose(s["upper"], 3 / 9) and math.isclose(s["digit"], 1 / 16) and math.isclose(s["stop"], 1 / 5)
    assert np.array_equal(Q.statistics(None), Q.statistics("")) and not Q.statistics("").any()
    long = "Some words, in a row. " * 200_000
    assert np.allclose(Q.statistics(long)[:4], Q.statistics(long[:22 * 256])[:4], atol=1e-3)


def test_the_cut_is_the_quantile(spark, stored):
    rows = [(i, "Plain words in a line." * (1 + i % 5) if i % 4 else "A!! B!! |" * (1 + i % 7)) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in rows], "doc_id long, quality int, toxic int")
    docs = stored(rows)
    got = Q.scores(docs, Q.fit(docs, labels)).collect()
    train = [r for r in got if not r["held_out"]]
    assert sum(r["predicted"] == 0 for r in train) == sum(r["doc_id"] % 4 == 0 for r in train)


def test_edge_rows_and_columns(spark, docs_of):
    rows = [(1, "A!! |"), (2, None), (None, "fine text"), (3, ""), (3, ""), (4, "x " * 100_000), (5, "퟿\U0001f600    y")] + [(10 + i, f"fine words number {i}.") for i in range(8)]
    labels = spark.createDataFrame([(1, 0, 1), (1, 1, 0), (3, 0, 0), (10, 1, 0), (11, None, 0), (None, 1, 1), (12, 1, 0)], "doc_id long, quality int, toxic int")
    got = Q.scores(docs_of(rows, extra=True), Q.fit(docs_of(rows, extra=True), labels)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    assert not next(r for r in got if r["doc_id"] is None)["held_out"]


def test_without_two_classes_all_are_kept(spark, docs_of):
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "some text"), (2, None)])
    for x in (labels, labels.limit(0)):
        assert [r["predicted"] for r in Q.scores(docs, Q.fit(docs, x)).collect()] == [1, 1]
    assert Q.scores(docs_of([]), Q.fit(docs_of([]), labels)).count() == 0


def test_all_labelled_rows_take_part(spark, stored, monkeypatch):
    """Not only the 20,000 of the smallest hashes; the weights are the minimum of the loss."""
    seen = {}
    real = Q.pairs

    def pairs(rows, *more):
        seen["rows"] = rows.count()
        return real(rows, *more)

    monkeypatch.setattr(Q, "pairs", pairs)
    rows = [(i, "Plain words." if i % 3 else "X!! ###") for i in range(28_000)]
    labels = spark.range(28_000).select(F.col("id").alias("doc_id"), (F.col("id") % 3 > 0).cast("int").alias("quality"))
    Q.fit(stored(rows), labels)
    assert seen["rows"] == sum(not held(i) for i, _ in rows) > 20_000


def test_newton_finds_the_minimum(spark):
    rng = np.random.default_rng(5)
    d = rng.normal(size=(200, 3)) + 0.4
    w = Q.minimum(spark.createDataFrame([(v.tolist(),) for v in d], "x array<float>"), 3)
    assert np.allclose(d.T @ (1 / (1 + np.exp(d @ w))) / len(d), Q.PENALTY * w, atol=1e-6)
