"""Quality scores learned from preferences between pairs (Bradley-Terry).

A document's strength is ``w . x`` over statistics of its text, and document i is
preferred to j with probability ``sigmoid(w . (x_i - x_j))``: logistic regression
without intercept on the differences of pairs, one labelled good and one bad.  Every
good training document meets bad ones in ``MEETINGS`` seeded rounds (and the other
way round where the bad ones are more), so each class takes part as a whole.

Threshold.  Strengths have no zero of their own.  The cut is the score quantile at
the share of bad documents among the training rows, half way between the two
strengths it falls between, and ``score = sigmoid(strength - cut + logit(KEEP))``: a
document is predicted good at a score of ``KEEP`` or more, that is above the
quantile.

The statistics are rates: sums over windows of ``WINDOW`` words, divided by the
number of words, letters, lines or windows, so that a text's length does not change
them and a long text is read window by window.

Fitting uses every labelled row that is not held out (``crc32(doc_id) mod FOLDS =
HELD_OUT``): pairs are stored, Newton's method reads them once a step, and the driver
gets sums of the size of the model.  Language, source, id and labels are no inputs of
a score.

Defined cases: null text is empty; a text without words has rates of zero and is
scored from them; a null id is not held out and not used for fitting; repeated labels
of an id count as their largest; with no training rows, or only one class, all
strengths are 0; repeated rows are scored each; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize, running_offsets, small_batches

MEETINGS = 6
KEEP = 0.7
FOLDS, HELD_OUT = 4, 2
WINDOW = 256          # words
SLICE = 1 << 20       # characters looked at in one go
PENALTY = 1e-3
STEPS = 60            # of Newton's method, at most
SMALL = 1_000_000     # repeated ids that go by broadcast, at most
SEED = 11
RATES = ("upper", "digit", "mark", "other", "space", "stop", "comma", "loud", "length", "length_sq", "shouted", "title", "marked", "no_letter",
         "one_letter", "again", "distinct", "lines", "line_again", "line_end", "short_line")
WIDTH = 2 * len(RATES) + 1

_WORD_CUT = re.compile(r"\s")
_ENDS = (".", "!", "?", '"', ":", "…", "”")
# Classes of characters; those beyond the basic plane are "other".
OTHER, SPACE, LETTER, UPPER, DIGIT, STOP, COMMA, LOUD, MARK = range(9)


def _class(c: str) -> int:
    if c.isspace():
        return SPACE
    if c.isalpha():
        return UPPER if c.isupper() else LETTER
    by = {".": STOP, ",": COMMA, ";": COMMA, "!": LOUD, "?": LOUD, **dict.fromkeys("#$%&*+<=>@[]^_`{|}~\\/", MARK)}
    return DIGIT if c.isdecimal() else by.get(c, OTHER)


_CLASSES = np.array([_class(chr(i)) for i in range(1 << 16)], np.uint8)


def _parts(text: str):
    """The text in slices that end at white space, so that no word is cut."""
    at = 0
    while at < len(text):
        end = min(len(text), at + SLICE)
        if end < len(text):
            found = _WORD_CUT.search(text, end)
            end = found.end() if found else len(text)
        yield text[at:end]
        at = end


def kinds(rows: np.ndarray) -> float:
    """Distinct words of a window, as a share of its words; of a short window as if
    it were full: distinct words grow with about the root of the number."""
    return float((np.diff(np.sort(rows)) != 0).sum() + 1) / len(rows) * math.sqrt(len(rows) / WINDOW)


def statistics(text: str | None) -> np.ndarray:
    """The rates of a text, each with its square root, and the logarithm of its
    number of words."""
    s = dict.fromkeys(RATES, 0.0)
    chars = letters = words = windows = lines = 0
    last = None
    for part in _parts(text or ""):
        c = _CLASSES[np.minimum(np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32), 0xFFFF)]
        n = np.bincount(c, minlength=9).tolist()
        chars += len(part)
        letters += n[LETTER] + n[UPPER]
        for name, k in (("upper", UPPER), ("digit", DIGIT), ("mark", MARK), ("other", OTHER), ("space", SPACE), ("stop", STOP), ("comma", COMMA), ("loud", LOUD)):
            s[name] += n[k]
        filled = np.zeros(len(c) + 2, np.int8)
        filled[1:-1] = c != SPACE
        turns = np.diff(filled)
        begin, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
        if len(begin):
            size = end - begin
            upper = c == UPPER
            of_upper = np.append(0, np.cumsum(upper))
            of_letters = np.append(0, np.cumsum(upper | (c == LETTER)))
            n_upper, n_letters = of_upper[end] - of_upper[begin], of_letters[end] - of_letters[begin]
            words += len(begin)
            s["length"] += int(size.sum())
            s["length_sq"] += int((np.minimum(size, 40) ** 2).sum())
            s["shouted"] += int(((n_upper == n_letters) & (n_upper > 0)).sum())
            s["title"] += int((upper[begin] & (n_upper == 1)).sum())
            s["marked"] += int((c[end - 1] == MARK).sum())
            s["no_letter"] += int((n_letters == 0).sum())
            s["one_letter"] += int((size == 1).sum())
            same = np.array([*map(hash, part.split())], np.int64)
            s["again"] += int((same[1:] == same[:-1]).sum()) + (last == same[0])
            last = same[-1]
            full = len(same) // WINDOW * WINDOW
            if full:
                s["distinct"] += float((np.diff(np.sort(same[:full].reshape(-1, WINDOW), axis=1), axis=1) != 0).sum() + full // WINDOW) / WINDOW
            if full < len(same):
                s["distinct"] += kinds(same[full:])
            windows += -(-len(same) // WINDOW)
        own = [x for line in part.split("\n") if (x := line.strip())]
        lines += len(own)
        s["line_again"] += len(own) - len(set(own))
        s["line_end"] += sum(x.endswith(_ENDS) for x in own)
        s["short_line"] += sum(x.count(" ") < 3 for x in own)
    s["lines"] = lines
    by = {"upper": letters, **dict.fromkeys(("digit", "mark", "other", "space"), chars), "distinct": windows,
          **dict.fromkeys(("line_again", "line_end", "short_line"), lines)}
    x = np.array([s[r] / max(1, by.get(r, words)) for r in RATES])
    return np.concatenate([x, np.sqrt(x), [math.log1p(words)]])


@dataclass
class Model:
    """Weights of the statistics, and the strength at the quantile."""
    weights: np.ndarray
    cut: float = 0.0

    def strength(self, x: np.ndarray) -> np.ndarray:
        return x @ self.weights

    def score(self, strength: np.ndarray) -> np.ndarray:
        z = strength - self.cut + math.log(KEEP / (1 - KEEP))
        return np.where(strength >= self.cut, np.maximum(KEEP, 1 / (1 + np.exp(-np.clip(z, -500, 500)))), 1 / (1 + np.exp(-np.clip(z, -500, 500))))


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(FOLDS)) == HELD_OUT, F.lit(False))


def _measured(texts: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and the statistics (``x``) of column ``text``."""
    schema = texts.select(*keep).withColumn("x", F.array(F.lit(0.0))).schema

    def run(batches):
        for b in batches:
            x = [statistics(t) for t in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(x, pa.list_(pa.float64()))], names=[*keep, "x"])

    return texts.select(*keep, "text").mapInArrow(run, schema)


def pairs(rows: DataFrame, meetings: int = MEETINGS) -> DataFrame:
    """(x) the difference good minus bad of each pair; ``rows``: (id, good, x), stored,
    ids unique.  The larger class meets the smaller in ``meetings`` rounds, each round
    with another shift of its seeded order.  The rows of the smaller class are sent
    once for each round, those of the larger once."""
    sizes = {r["good"]: r["count"] for r in rows.groupBy("good").count().collect()}
    if len(sizes) < 2:
        return rows.select("x").limit(0)
    large = sizes[True] >= sizes[False]
    n = sizes[not large]
    keys = rows.select("id", "good", F.xxhash64("id", F.lit(SEED)).alias("_hash"))
    places = running_offsets(keys, ["good", "_hash", "id"], F.lit(1), "place").select(
        "id", (F.col("place") - F.when(F.col("good"), sizes[False]).otherwise(0)).alias("place"))
    placed = rows.join(places, "id")
    many = placed.where(F.col("good") == large).select(F.col("x").alias("x1"), F.pmod("place", F.lit(n)).alias("slot"))
    few = placed.where(F.col("good") != large).withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(meetings - 1)))).select(
        F.col("x").alias("x2"), F.pmod(F.col("place") - F.col("round") * (n // meetings + 1), F.lit(n)).alias("slot"))
    one, two = ("x1", "x2") if large else ("x2", "x1")
    return many.join(few, "slot").select(F.zip_with(one, two, lambda a, b: a - b).alias("x"))


def _sums(differences: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Number of pairs, logistic loss, its gradient and its Hessian at ``weights``, in
    one row; summed within tasks, then by position."""
    width = len(weights)

    def run(batches):
        total = np.zeros(2 + width + width * width)
        for b in batches:
            d = b.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)
            z = np.clip(d @ weights, -500, 500)
            away = 1 / (1 + np.exp(z))
            total[0] += len(d)
            total[1] += np.logaddexp(0, -z).sum()
            total[2:2 + width] -= away @ d
            total[2 + width:] += ((d * (away * (1 - away))[:, None]).T @ d).ravel()
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    by_place = (differences.mapInArrow(run, "v array<double>").select(F.posexplode("v").alias("i", "v"))
                .groupBy("i").agg(F.sum("v").alias("v")))
    out = np.zeros(2 + width + width * width)
    for r in by_place.collect():
        out[r["i"]] = r["v"]
    return out


def minimum(differences: DataFrame, width: int, penalty: float = PENALTY, steps: int = STEPS) -> np.ndarray:
    """Weights of the least mean logistic loss of the differences (x) plus
    ``penalty / 2 * |w|^2``, by Newton's method; a step that raises the loss is halved."""
    w = last = np.zeros(width)
    least = math.inf
    for _ in range(steps):
        sums = _sums(differences, w)
        n = max(1.0, sums[0])
        loss = sums[1] / n + penalty / 2 * w @ w
        if loss > least + 1e-12:
            w = (w + last) / 2
            continue
        gradient = sums[2:2 + width] / n + penalty * w
        step = np.linalg.solve(sums[2 + width:].reshape(width, width) / n + penalty * np.eye(width), gradient)
        if gradient @ step < 1e-12:
            break
        last, least, w = w, loss, w - step
    return w


def _ranked(values: DataFrame, places: list[int]) -> list[float]:
    """The values (column ``s``) at the given places of their order, from 0; equal
    values are one row, ranked by key ranges."""
    counts = running_offsets(values.groupBy("s").count(), ["s"], F.col("count"), "below")
    counts = counts.where(" or ".join(f"({p} >= below and {p} < below + count)" for p in places))
    found = counts.collect()
    return [next(r["s"] for r in found if r["below"] <= p < r["below"] + r["count"]) for p in places]


def _once(texts: DataFrame) -> DataFrame:
    """(id, text): rows that share an id count once, with the smallest text.  Only the
    texts of repeated ids are brought together."""
    again = materialize(texts.groupBy("id").count().where("count > 1").select("id"), "repeated")
    n = again.count()
    if not n:
        return texts
    again = F.broadcast(again) if n <= SMALL else again
    return texts.join(again, "id", "left_anti").unionByName(
        texts.join(again, "id").groupBy("id").agg(F.min("text").alias("text")))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """A model from all labelled documents that are not held out.  The driver gets
    deviations, sums over the pairs, and two quantiles."""
    small_batches(docs.sparkSession)
    marked = (labels.where("doc_id is not null and quality is not null").where(~held_out("doc_id"))
              .groupBy(F.col("doc_id").cast("long").alias("id")).agg((F.max("quality") > 0).alias("good")))
    texts = (docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
             .where(F.col("id").isNotNull() & ~held_out("id")))
    # the statistics are shuffled, not the texts
    rows = materialize(_measured(_once(texts), ["id"]).join(marked, "id"), "measured")
    size = rows.groupBy("good").count().collect()
    if len(size) < 2:
        return Model(np.zeros(WIDTH))
    n_bad = next(r["count"] for r in size if not r["good"])
    one = rows.agg(*[F.stddev_pop(F.col("x")[i]).alias(f"c{i}") for i in range(WIDTH)]).first()
    scale = np.array([1 / v if v and v > 1e-9 else 0.0 for v in one])
    scaled = rows.withColumn("x", F.zip_with("x", F.array(*map(F.lit, scale.tolist())), lambda a, b: (a * b).cast("float")))
    weights = minimum(materialize(pairs(scaled), "pairs"), WIDTH) * scale
    strength = sum((F.col("x")[i] * float(w) for i, w in enumerate(weights)), F.lit(0.0))
    low, high = _ranked(rows.select(strength.alias("s")), [n_bad - 1, n_bad])
    return Model(weights, (low + high) / 2)


def scores(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            x = np.array([statistics(t) for t in b.column(2).to_pylist()]).reshape(-1, WIDTH)
            score = model.score(model.strength(x))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(score), pa.array((score >= KEEP).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int"))
