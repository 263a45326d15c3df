"""MOD-3 without count vectors: a ``pyspark.ml`` estimator for a decision tree on word
counts in long form.

MLlib's tree keeps an integer for every (document, term), zeros too: 1 MB a document
at 2^18 terms.  Here a document is a map of the words it has, written once; each level
of the tree is one aggregation of the (node, term, bin, class) that occur, and the
documents without the term follow from the class counts of the node.  Splits, gains
(Gini) and their order are those of ``ml.classification.DecisionTreeClassifier``, but
the thresholds come from all rows, where it takes a sample of 10,000, and terms of
equal count stand in their own order.  The driver holds the tree: at most
2^maxDepth nodes and their class counts.
"""

from __future__ import annotations

import json
import sys

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.operators import naive_bayes as nb
from kiln.operators.features import by_document
from kiln.session import scratch_path

# Cells of the (split, class) tables that a task fills at a time.
CELLS = 1 << 20


def thresholds(values, n_docs: int, most: int) -> list[float]:
    """MLlib's split points of one term: between all neighbouring counts, or, if these
    are too many, ``most`` of them at even steps.  ``values``: (count, documents)."""
    values = sorted((float(v), n) for v, n in values)
    rest = n_docs - sum(n for _, n in values)
    if rest:
        values.insert(0, (0.0, rest))
    between = [(a[0] + b[0]) / 2 for a, b in zip(values, values[1:])]
    if len(between) <= most:
        return between
    stride, out, current = n_docs / (most + 1), [], values[0][1]
    target = stride
    for middle, (_, n) in zip(between, values[1:]):
        if abs(current - target) < abs(current + n - target):
            out.append(middle)
            target += stride
        current += n
    return out


def gini(counts: np.ndarray, n: np.ndarray) -> np.ndarray:
    out = np.ones(len(counts))
    for c in counts.T:
        share = c / n
        out -= share * share
    return out


def best_splits(totals: dict, max_bins: int):
    """A function of Arrow batches (node, idx, entries of (bin, class, n)): the best bin
    of each row, as the negative gain (so that the least is best) and the counts left."""
    k = len(next(iter(totals.values())))

    def of(node, idx, entries):
        size = np.diff(entries.offsets.to_numpy())
        flat = entries.flatten()
        bins, classes, n = (flat.field(i).to_numpy() for i in range(3))
        rows = np.arange(len(node))
        # one line for each bin of a row; bin 0 holds the documents without the term
        lines, at = np.unique(np.concatenate([rows * max_bins, np.repeat(rows, size) * max_bins + bins]), return_inverse=True)
        first, row = at[:len(node)], lines // max_bins
        here = np.zeros((len(lines), k))
        np.add.at(here, (at[len(node):], classes), n)
        total = np.array([totals[x] for x in node], dtype=float)
        here[first] += total - np.add.reduceat(here, first)
        upto = np.cumsum(here, axis=0)
        left = upto - (upto[first] - here[first])[row]
        right = total[row] - left
        n_left, n_right = left.sum(axis=1), right.sum(axis=1)
        both = n_left + n_right
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = gini(total, total.sum(axis=1))[row] - n_left / both * gini(left, n_left) - n_right / both * gini(right, n_right)
        gain[(n_left == 0) | (n_right == 0) | ~(gain > 0)] = -1.0
        most = np.maximum.reduceat(gain, first)
        hits = np.flatnonzero((gain == most[row]) & (gain > 0))
        hits = hits[np.unique(row[hits], return_index=True)[1]]
        return pa.RecordBatch.from_arrays(
            [pa.array(node[row[hits]], pa.int32()), pa.array(-gain[hits]), pa.array(idx[row[hits]], pa.int32()),
             pa.array((lines % max_bins)[hits], pa.int32()), pa.array(left[hits].tolist(), pa.list_(pa.float64()))],
            ["node", "loss", "idx", "bin", "left"])

    def run(batches):
        for b in batches:
            step = max(1, CELLS // k // 4)
            for i in range(0, len(b), step):
                p = b.slice(i, step)
                yield of(p.column("node").to_numpy(), p.column("idx").to_numpy(), p.column("entries"))

    return run


def _walk(tree: dict, count):
    """The leaf of a document, as its place in ``_nodes``; ``count(term)`` is the
    document's count.  A fold over the levels: nested conditions would grow to a method
    too large for the JVM to compile."""
    nodes = _nodes(tree)
    inner = [n for n in nodes if "term" in n]
    if not inner:
        return F.lit(1)
    place = {n["node"]: i for i, n in enumerate(nodes, 1)}

    def column(of, kind):
        return F.array(*[F.lit(of(n) if "term" in n else None).cast(kind) for n in nodes])

    term, threshold = column(lambda n: n["term"], "string"), column(lambda n: n["threshold"], "double")
    left, right = (column(lambda n, s=side: place[n[s]["node"]], "int") for side in ("left", "right"))

    def step(at, _):
        t = F.element_at(term, at)
        return F.when(t.isNull(), at).when(count(t) <= F.element_at(threshold, at), F.element_at(left, at)).otherwise(F.element_at(right, at))

    levels = max(n["node"] for n in nodes).bit_length() - 1
    return F.aggregate(F.sequence(F.lit(1), F.lit(levels)), F.lit(1), step)


def _nodes(tree: dict) -> list[dict]:
    return [tree] if "term" not in tree else [tree, *_nodes(tree["left"]), *_nodes(tree["right"])]


def _pruned(tree: dict) -> dict:
    """Two leaves that predict the same class become one, as in MLlib."""
    if "term" not in tree:
        return tree
    left, right = _pruned(tree["left"]), _pruned(tree["right"])
    if "term" not in left and "term" not in right and np.argmax(left["counts"]) == np.argmax(right["counts"]):
        return {"node": tree["node"], "counts": tree["counts"]}
    return {**tree, "left": left, "right": right}


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def most_frequent(stats: DataFrame, size: int) -> DataFrame:
    """The ``size`` most frequent terms (count desc, term asc), without sorting the others."""
    w = Window.orderBy(F.desc("cnt")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # the window runs on one row for each count
    last = (stats.groupBy("cnt").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", F.sum("n").over(w))
            .where(F.col("upto") >= size).orderBy("upto").first())
    if last is None:
        return stats
    ties = stats.where(F.col("cnt") == last.cnt)
    return stats.where(F.col("cnt") > last.cnt).unionByName(ties.orderBy("term").limit(size - last.upto + last.n))


class _TreeParams(Params):
    wordsCol = Param(Params._dummy(), "wordsCol", "array column of words", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "class column, numbered from 0", TypeConverters.toString)
    predictionCol = Param(Params._dummy(), "predictionCol", "column of the predicted class", TypeConverters.toString)
    vocabSize = Param(Params._dummy(), "vocabSize", "so many of the most frequent words", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "levels below the root", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a word's counts", TypeConverters.toInt)
    tree = Param(Params._dummy(), "tree", "the fitted tree as JSON", TypeConverters.toString)


class LongDecisionTree(Estimator, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """Decision tree on the counts of the words of ``wordsCol``."""

    @keyword_only
    def __init__(self, *, wordsCol="words", labelCol="label", predictionCol="prediction", vocabSize=1 << 18, maxDepth=5, maxBins=32):
        super().__init__()
        self._set(**{"wordsCol": "words", "labelCol": "label", "predictionCol": "prediction", "vocabSize": 1 << 18,
                     "maxDepth": 5, "maxBins": 32, **self._input_kwargs})

    def _fit(self, dataset: DataFrame) -> LongDecisionTreeModel:
        label, max_depth = self.getOrDefault(self.labelCol), self.getOrDefault(self.maxDepth)
        docs = self._documents(dataset.select(F.col(label).cast("int").alias("_class"), F.col(self.getOrDefault(self.wordsCol)).alias("_words")))
        found = docs.groupBy("_class").count().limit(nb.MAX_CLASSES + 1).collect()
        if not found or len(found) > nb.MAX_CLASSES or any(r[0] is None or r[0] < 0 for r in found):
            raise ValueError(f"{label}: needs rows, and classes numbered from 0 to at most {nb.MAX_CLASSES}")
        counts = [0.0] * (max(r[0] for r in found) + 1)
        for c, n in found:
            counts[c] = float(n)
        n_docs = int(sum(counts))
        max_bins = min(self.getOrDefault(self.maxBins), n_docs)
        splits = self._splits(docs, n_docs, max_bins - 1)
        tree = {"node": 1, "counts": counts}
        active = [tree]
        for depth in range(max_depth):
            best = self._level(docs, splits, tree, active, max_bins)
            points = {r.idx: r for r in splits.where(F.col("idx").isin([b.idx for b in best.values()])).collect()}
            below = []
            for at in active:
                b = best.get(at["node"])
                if b is None:
                    continue
                at["term"], at["threshold"] = points[b.idx].term, points[b.idx].thresholds[b.bin]
                right = [x - y for x, y in zip(at["counts"], b.left, strict=True)]
                for side, child, left in (("left", 2 * at["node"], list(b.left)), ("right", 2 * at["node"] + 1, right)):
                    at[side] = {"node": child, "counts": left}
                    if depth + 1 < max_depth and abs(gini(np.array([left]), np.array([sum(left)]))[0]) >= sys.float_info.epsilon:
                        below.append(at[side])
            active = below
            if not active:
                break
        return self._copyValues(LongDecisionTreeModel(tree=json.dumps(_pruned(tree))))

    @staticmethod
    def _documents(rows: DataFrame) -> DataFrame:
        """(_class, terms): the words of a document with their counts, in one row."""
        dealt = by_document(nb.with_row_id(rows), "_row").select("_row", "_class", F.explode_outer("_words").alias("term"))
        tf = dealt.groupBy("_row", "_class", "term").agg(F.count("term").alias("tf"))
        entries = F.collect_list(F.when(F.col("term").isNotNull(), F.struct("term", "tf")))
        return _stored(tf.groupBy("_row", "_class").agg(F.map_from_entries(entries).alias("terms")).select("_class", "terms"), "tree-documents")

    def _splits(self, docs: DataFrame, n_docs: int, most: int) -> DataFrame:
        """(idx, term, thresholds) of the vocabulary, at most ``vocabSize`` rows."""
        values = docs.select(F.explode("terms").alias("term", "tf")).groupBy("term", "tf").agg(F.count(F.lit(1)).alias("n"))
        stats = _stored(values.groupBy("term").agg(F.sum(F.col("tf") * F.col("n")).alias("cnt"),
                                                   F.collect_list(F.struct("tf", "n")).alias("values")), "tree-terms")
        points = F.udf(lambda v: thresholds(v, n_docs, most), "array<double>")
        # the window runs on the bounded vocabulary only
        idx = F.row_number().over(Window.orderBy(F.desc("cnt"), F.asc("term")))
        kept = most_frequent(stats, self.getOrDefault(self.vocabSize))
        return _stored(kept.select("term", "cnt", points("values").alias("thresholds")).select(idx.alias("idx"), "term", "thresholds")
                       .where(F.size("thresholds") > 0), "tree-splits")

    @staticmethod
    def _level(docs: DataFrame, splits: DataFrame, tree: dict, active: list[dict], max_bins: int) -> dict:
        """The best split of each active node, where one has a gain."""
        totals = {a["node"]: a["counts"] for a in active}
        place = _walk(tree, lambda t: F.coalesce(F.try_element_at("terms", t), F.lit(0)))
        node = F.element_at(F.array(*[F.lit(n["node"] if n["node"] in totals else None).cast("int") for n in _nodes(tree)]), place)
        points, tf = F.col("thresholds"), F.col("tf")
        # most counts are in the first two bins
        bin_ = (F.when((F.size(points) == 1) | (tf <= F.get(points, F.lit(1))), (tf > points[0]).cast("int"))
                .otherwise(F.size(F.filter(points, lambda p: p < tf))))
        occ = (docs.select(node.alias("node"), "_class", "terms").where("node is not null")
               .select("node", "_class", F.explode("terms").alias("term", "tf"))
               .join(F.broadcast(splits), "term")      # at most vocabSize rows
               .groupBy("node", "idx", bin_.alias("bin"), "_class").agg(F.count(F.lit(1)).alias("n")))
        found = (occ.groupBy("node", "idx").agg(F.collect_list(F.struct("bin", "_class", "n")).alias("entries"))
                 .mapInArrow(best_splits(totals, max_bins), "node int, loss double, idx int, bin int, left array<double>"))
        best = found.groupBy("node").agg(F.min(F.struct("loss", "idx", "bin", "left")).alias("b")).select("node", "b.*")
        return {r.node: r for r in best.collect()}


class LongDecisionTreeModel(Model, _TreeParams, DefaultParamsReadable, DefaultParamsWritable):
    """The fitted tree: one expression on a row's words, so ``transform`` keeps every
    column and shuffles nothing."""

    @keyword_only
    def __init__(self, *, tree=None):
        super().__init__()
        if tree is not None:
            self._set(tree=tree)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        words, tree = F.col(self.getOrDefault(self.wordsCol)), json.loads(self.getOrDefault(self.tree))
        place = _walk(tree, lambda t: F.size(words) - F.size(F.array_remove(words, t)))

        def leaves(value):
            return F.element_at(F.array(*[value(n["counts"]) for n in _nodes(tree)]), place)

        def vector(of):
            return array_to_vector(leaves(lambda c: F.array(*[F.lit(x) for x in of(c)])))

        return (dataset.withColumn("rawPrediction", vector(lambda c: c))
                .withColumn("probability", vector(lambda c: [x / sum(c) for x in c]))
                .withColumn(self.getOrDefault(self.predictionCol), leaves(lambda c: F.lit(float(np.argmax(c))))))
