"""Toxicity severity by cumulative-link ordinal regression.

``P(grade <= k) = sigmoid(threshold_k - w . x)``: one weight vector shared by all
ordered thresholds, over sparse binary features (the distinct words of a text and
their beginnings of ``PREFIXES`` letters, which carry inflected forms).  A text's
expected severity is the sum over k of P(grade > k); it is rejected when
P(grade >= 1) reaches ``REJECT``.

Grades.  The labels say toxic or not; how severe a toxic text is comes from its
number of marker words (words that the labelled toxic texts use far more often
than the others): the toxic training texts are cut into ``GRADES - 1`` groups by
that number.  Grade 0 is not toxic.

Fitting uses at most ``SAMPLE`` labelled rows, those with the smallest hash of
their id (a documented bound).  Only features whose share differs between toxic and other
texts by ``DIFFERS`` standard errors enter, under an L1 penalty, so that a long
text is not rejected for its length.  Scoring
runs over all documents inside their partitions, without a shuffle.

Defined cases: null text is empty and scores the model's base rate; a null or
unlabelled id is not used for fitting; repeated labels of an id count as their
largest; with no labelled row, or only one class, all texts get severity 0;
repeated rows are scored each; extra columns stay as they are.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize, small_batches

SAMPLE = 20_000      # labelled rows used for fitting, at most
GRADES = 4
PREFIXES = (3, 4, 5, 6)
LEAST = 5            # sample texts that must have a feature
DIFFERS = 3.0
PENALTY = 1e-4
STEPS = 400
REJECT = 0.35        # below one half: a missed text is worse than a second look
REMEMBERED = 400_000 # words kept in a task
SEED = 8
MARKER_RATIO, MARKER_TEXTS = 8.0, 5
_WORD = re.compile(r"[^\W\d_]+")


def forms(word: str) -> list[str]:
    """The word, and its beginnings marked by ``*``."""
    return [word, *[word[:k] + "*" for k in PREFIXES if len(word) > k]]


def features(text: str | None) -> set[str]:
    """The forms of the distinct lower-cased words."""
    return {f for w in set(_WORD.findall((text or "").lower())) for f in forms(w)}


@dataclass
class Model:
    """Weights by feature, and the ordered thresholds."""
    weights: dict[str, float]
    thresholds: list[float]
    known: dict = field(default_factory=dict, repr=False)   # word: its forms that have a weight

    def score(self, text: str | None) -> float:
        found: set[str] = set()
        for w in set(_WORD.findall((text or "").lower())):
            have = self.known.get(w)
            if have is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                have = self.known[w] = tuple(f for f in forms(w) if f in self.weights)
            found.update(have)
        return sum(self.weights[f] for f in found)

    def above(self, score) -> np.ndarray:
        """P(grade > k) for each threshold k; one row per score."""
        z = np.asarray(score, float)[:, None] - np.array(self.thresholds)[None, :]
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def standard_errors(having: int, bad: int, n: int, n_bad: int) -> float:
    """Standard errors between a feature's share in toxic and in other texts."""
    share = having / n
    error = (share * (1 - share) * (1 / n_bad + 1 / (n - n_bad))) ** 0.5
    return abs(bad / n_bad - (having - bad) / (n - n_bad)) / error if error else 0.0


def grades(count: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Grade of each training text, from its label and its number of marker words."""
    cuts = np.quantile(count[toxic], np.linspace(0, 1, GRADES)[1:-1])
    return np.where(toxic, 1 + (count[:, None] > cuts[None, :]).sum(axis=1), 0)


def fit_rows(counts: dict[str, tuple[int, int]], rows: list[tuple[np.ndarray, bool]]) -> Model:
    """The regression on the sample, by proximal steps scaled per coordinate.
    ``counts``: texts and toxic texts with each feature that enters; ``rows``: the
    numbers of each text's features (places in the sorted names), and its label."""
    toxic = np.array([t for _, t in rows], bool)
    n, n_bad = len(toxic), int(toxic.sum())
    if not 0 < n_bad < n:
        return Model({}, [40.0] * (GRADES - 1))
    names = sorted(counts)
    marks = np.array([f[-1] != "*" and bad >= MARKER_TEXTS and bad / n_bad >= MARKER_RATIO * (c - bad + 1) / (n - n_bad + 1)
                      for f, (c, bad) in sorted(counts.items())], bool)
    row = np.repeat(np.arange(n, dtype=np.int32), [len(s) for s, _ in rows])
    col = np.concatenate([*[s for s, _ in rows], np.zeros(0, np.int32)]).astype(np.int32)
    y = grades(np.bincount(row[marks[col]], minlength=n), toxic)
    w = np.zeros(len(names))
    share = np.clip([(y > k).mean() for k in range(GRADES - 1)], 1e-4, 1 - 1e-4)
    theta = np.maximum.accumulate(np.log((1 - share) / share) + 1e-3 * np.arange(GRADES - 1))
    squares, squares_t = np.full(len(w), 1e-8), np.full(len(theta), 1e-8)
    upper, lower = np.minimum(y, GRADES - 2), np.maximum(y, 1) - 1
    for _ in range(STEPS):
        s = np.bincount(row, weights=w[col], minlength=n)
        up = np.where(y == GRADES - 1, 1.0, 1 / (1 + np.exp(-np.clip(theta[upper] - s, -40, 40))))
        low = np.where(y == 0, 0.0, 1 / (1 + np.exp(-np.clip(theta[lower] - s, -40, 40))))
        p = np.maximum(up - low, 1e-9)
        g = np.bincount(col, weights=((1 - up - low) / n)[row], minlength=len(w))
        gt = (np.bincount(upper, weights=np.where(y < GRADES - 1, -up * (1 - up) / p, 0) / n, minlength=len(theta))
              + np.bincount(lower, weights=np.where(y > 0, low * (1 - low) / p, 0) / n, minlength=len(theta)))
        squares += g * g
        squares_t += gt * gt
        step = 0.3 / np.sqrt(squares)
        w = w - step * g
        w = np.sign(w) * np.maximum(np.abs(w) - step * PENALTY, 0)
        theta = np.maximum.accumulate(theta - 0.3 / np.sqrt(squares_t) * gt)
    return Model({f: float(x) for f, x in zip(names, w, strict=True) if x}, [float(t) for t in theta])


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from at most ``sample`` labelled documents.  The tasks count the
    sample's features; the driver gets those that enter, and each text's share of
    them."""
    small_batches(docs.sparkSession)
    marked = (labels.where("doc_id is not null and toxic is not null")
              .groupBy(F.col("doc_id").cast("long").alias("_id")).agg((F.max("toxic") > 0).alias("_toxic"))
              .orderBy(F.xxhash64("_id", F.lit(SEED)), "_id").limit(sample))
    marked = F.broadcast(materialize(marked, "labels"))
    texts = docs.select(F.col("doc_id").cast("long").alias("_id"), F.col("text").cast("string").alias("_text")).join(marked, "_id")
    # rows that share an id count once, with the smallest text
    texts = materialize(texts.groupBy("_id").agg(F.min(F.struct("_text", "_toxic")).alias("x")).select("_id", "x._text", "x._toxic"), "labelled")

    def count(batches):
        seen, bad = Counter(), Counter()

        def rows():
            return pa.RecordBatch.from_pydict({"f": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64()),
                                               "bad": pa.array([bad[f] for f in seen], pa.int64())})

        for b in batches:
            for text, toxic in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                have = features(text)
                seen.update(have)
                if toxic:
                    bad.update(have)
            if len(seen) >= REMEMBERED:
                yield rows()
                seen.clear()
                bad.clear()
        if seen:
            yield rows()

    size = texts.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.col("_toxic").cast("int")), F.lit(0)).alias("bad")).first()
    if not 0 < size["bad"] < size["n"]:
        return fit_rows({}, [])
    share = F.col("n") / size["n"]
    error = F.sqrt(share * (1 - share) * (1 / size["bad"] + 1 / (size["n"] - size["bad"])))
    gap = F.abs(F.col("bad") / size["bad"] - (F.col("n") - F.col("bad")) / (size["n"] - size["bad"]))
    counts = (texts.select("_text", "_toxic").mapInArrow(count, "f string, n long, bad long").groupBy("f")
              .agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).where((F.col("n") >= LEAST) & (gap >= DIFFERS * error) & (error > 0)))
    chosen = {r["f"]: (r["n"], r["bad"]) for r in counts.collect()}

    number = {f: i for i, f in enumerate(sorted(chosen))}

    def own(batches):
        for b in batches:
            have = [np.array(sorted(number[f] for f in features(t) if f in number), "<i4").tobytes() for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(have, pa.binary()), b.column(2)], names=["id", "features", "toxic"])

    rows = texts.select("_id", "_text", "_toxic").mapInArrow(own, "id long, features binary, toxic boolean").orderBy("id").collect()
    return fit_rows(chosen, [(np.frombuffer(r["features"], "<i4"), r["toxic"]) for r in rows])


def severity(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, severity, p_toxic, grade) of every row; ``grade`` is the most
    probable one."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            above = model.above([model.score(t) for t in b.column(1).to_pylist()])
            full = np.concatenate([np.ones((len(above), 1)), above, np.zeros((len(above), 1))], axis=1)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(above.sum(axis=1)), pa.array(above[:, 0]),
                 pa.array((full[:, :-1] - full[:, 1:]).argmax(axis=1).astype(np.int32))],
                names=["doc_id", "severity", "p_toxic", "grade"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, "doc_id long, severity double, p_toxic double, grade int"))


def keep_clean(docs: DataFrame, model: Model, reject: float = REJECT) -> DataFrame:
    """The rows of ``docs``, all columns, whose P(grade >= 1) is below ``reject``."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            above = model.above([model.score(t) for t in b.column(at).to_pylist()])
            yield b.filter(pa.array(above[:, 0] < reject))

    return docs.mapInArrow(run, docs.schema)
