"""Importance resampling towards a target distribution, with segment deduplication.

Features are the words and word pairs of a text, hashed into ``BUCKETS`` buckets.
A bucket's gain is the log ratio of its share in the target texts to its share in
the documents; a document's weight is the mean gain of its features.  Documents are
drawn without replacement by adding seeded Gumbel noise to the weights and taking
the highest sums.

Segments.  Words never reach over a line end, so texts are cut into lines.  Equal
lines meet once: the buckets of a distinct line are worked out and stored once, its
counts enter the corpus's multiplied by its occurrences, and its summed gain is
handed to the documents that hold it.  The pairs across lines (last word of a line,
first of the next one that has words) are added separately, document by document.

A line may stand in a third of all documents: lines are counted before they are
shuffled, and lines found in very many documents are handed out by broadcast
(fewer than 4096 of them, see :func:`kiln.llm.common.join_unique`).

Defined cases: null text is empty, a text without words has no features and weight 0;
a null ``doc_id`` is hashed as the empty string and ranks after equal scores; rows
that repeat are scored and drawn each; with no documents or no target all gains come
from the one added to each count; extra columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import join_unique, materialize, running_offsets, slices, small_batches

BUCKETS = 10_000       # below 2 ** 16
SCALE = 1000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
SLICE = 1 << 22        # bytes worked on at a time
REMEMBERED = 300_000   # words kept in a task

# A-Z lower-cased; ASCII other than letters and digits separates.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_LINES = _TABLE[:10] + b"\n" + _TABLE[11:]


class _Sums(dict):
    """Word to its CRC-32."""
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        c = self[word] = zlib.crc32(word)
        return c


def line_buckets(line: bytes, sums: dict) -> np.ndarray:
    """The buckets of a line's words and word pairs."""
    crc32, out, last = zlib.crc32, [], []
    for part in slices(line.translate(_TABLE), SLICE, b" "):
        words = part.split()
        own = [sums[w] for w in words]
        pairs = [crc32(b, crc32(b" ", c)) for c, b in zip(last + own, words if last else words[1:], strict=False)]
        last = own[-1:] or last
        out.append((np.array(own + pairs, np.uint32) % BUCKETS).astype(np.uint16))
    return np.concatenate(out) if out else np.zeros(0, np.uint16)


def line_key(line: bytes) -> bytes:
    return xxhash.xxh3_128_digest(line)


def across(text: bytes, sums: dict) -> tuple[list[bytes], list[int]]:
    """The lines of a text that have words, and the buckets of the pairs that reach
    from one to the next."""
    held, pairs, last = [], [], None
    clean = text.translate(_LINES)
    for line, plain in zip(text.split(b"\n"), clean.split(b"\n"), strict=True):
        begins = plain.lstrip(b" ")
        if not begins:
            continue
        held.append(line)
        if last is not None:
            stop = begins.find(b" ")
            pairs.append(zlib.crc32(begins if stop < 0 else begins[:stop], zlib.crc32(b" ", sums[last])) % BUCKETS)
        ends = plain.rstrip(b" ")
        last = ends[ends.rfind(b" ") + 1:]
    return held, pairs


def segments(texts: DataFrame) -> DataFrame:
    """(key, occurrences, buckets) of each distinct line of ``text``, stored."""
    schema = pa.schema([("key", pa.binary()), ("occurrences", pa.int64()), ("buckets", pa.binary())])

    def run(batches):
        sums = _Sums()
        for b in batches:
            lines = [x.encode("utf-8") for x in b.column(0).to_pylist()]
            found = [line_buckets(x, sums).tobytes() for x in lines]
            yield pa.RecordBatch.from_arrays([pa.array([line_key(x) for x in lines], pa.binary()), b.column(1), pa.array(found, pa.binary())], schema=schema)

    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    found = lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).mapInArrow(run, "key binary, occurrences long, buckets binary")
    return materialize(found.where(F.length("buckets") > 0), "segments")


def documents(texts: DataFrame) -> DataFrame:
    """(row, doc_id, lines, pairs) of each row of ``texts``, stored: its lines' keys
    with their number, and the buckets of its pairs across lines."""
    held = pa.list_(pa.struct([("key", pa.binary()), ("n", pa.int64())]))
    schema = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("lines", held), ("pairs", pa.binary())])

    def run(batches):
        sums = _Sums()
        for b in batches:
            lines, pairs = [], []
            for t in b.column(2).to_pylist():
                have, reach = across((t or "").encode("utf-8"), sums)
                lines.append([{"key": k, "n": n} for k, n in Counter(map(line_key, have)).items()])
                pairs.append(np.array(reach, np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lines, held), pa.array(pairs, pa.binary())], schema=schema)

    rows = texts.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return materialize(rows.mapInArrow(run, "row long, doc_id long, lines array<struct<key: binary, n: long>>, pairs binary"), "rows")


def bucket_counts(lines: DataFrame, rows: DataFrame) -> np.ndarray:
    """How often each bucket occurs: distinct lines times their occurrences, and
    the pairs across lines.  The driver gets one number a bucket."""
    def run(batches):
        total = np.zeros(BUCKETS, np.int64)
        for b in batches:
            for n, held in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.frombuffer(held, np.uint16)
                if len(own) < 1000:
                    np.add.at(total, own, n)
                else:
                    total += np.bincount(own, minlength=BUCKETS) * n
        have = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(have.astype(np.int32)), pa.array(total[have])], names=["bucket", "n"])

    both = lines.select("occurrences", "buckets").unionByName(rows.select(F.lit(1).cast("long").alias("occurrences"), F.col("pairs").alias("buckets")))
    out = np.zeros(BUCKETS, np.int64)
    for r in both.mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The buckets' gains, in thousandths, floored."""
    s_all, t_all = int(corpus.sum()), int(target.sum())
    return np.array([math.floor(SCALE * math.log(float(t + 1) * float(s_all + BUCKETS) / (float(s + 1) * float(t_all + BUCKETS))))
                     for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def _texts(df: DataFrame) -> DataFrame:
    return df.select((F.col("doc_id") if "doc_id" in df.columns else F.lit(None)).cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def scores(docs: DataFrame, target: DataFrame, seed: int = SEED) -> DataFrame:
    """(row, doc_id, n_features, weight, score) of every row of ``docs``, towards
    the texts of ``target``."""
    small_batches(docs.sparkSession)
    goal, corpus = _texts(target.select("text")), _texts(docs)
    lines, rows = segments(corpus), documents(corpus)
    gain = gains(bucket_counts(lines, rows), bucket_counts(segments(goal), documents(goal)))

    def summed(batches):
        for b in batches:
            own = [np.frombuffer(x, np.uint16) for x in b.column(b.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array([len(x) for x in own], pa.int64()), pa.array([int(gain[x].sum()) for x in own], pa.int64())],
                                             names=[*b.schema.names[:-1], "features", "gain"])

    of_line = lines.select("key", "buckets").mapInArrow(summed, "key binary, features long, gain long")
    held = rows.select("row", F.explode("lines").alias("line")).select("row", F.col("line.key").alias("key"), F.col("line.n").alias("times"))
    from_lines = (join_unique(materialize(held, "held"), of_line, ["key"])
                  .select("row", F.lit(None).cast("long").alias("doc_id"), (F.col("features") * F.col("times")).alias("features"), (F.col("gain") * F.col("times")).alias("gain")))
    from_pairs = rows.select("row", "doc_id", "pairs").mapInArrow(summed, "row long, doc_id long, features long, gain long")
    n, total = F.col("n_features"), F.col("_gain")
    noise = (F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double") + 0.5) / 4294967296.0
    return (from_pairs.unionByName(from_lines).groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.sum("features").alias("n_features"), F.sum("gain").alias("_gain"))
            .withColumn("weight", F.when(n == 0, F.lit(0).cast("long")).otherwise(F.expr("(_gain - pmod(_gain, n_features)) div n_features")))
            .withColumn("score", F.col("weight") + F.floor(-1000 * F.log(-F.log(noise))))
            .select("row", "doc_id", "n_features", "weight", "score"))


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row; ``rank`` is null
    unless the row is drawn: the highest scores of the rows with at least
    ``least_words`` words, ``percent`` percent of them."""
    scored = materialize(scores(docs, target, seed), "scores")
    enough = F.col("n_features") >= 2 * least_words - 1          # n words have 2 n - 1 features
    draw = percent * scored.where(enough).count() // 100
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")]
    ranked = running_offsets(scored.where(enough), order, F.lit(1).cast("long"), "_rank0")
    rank = F.col("_rank0") + 1
    return (ranked.withColumn("rank", F.when(rank <= draw, rank)).drop("_rank0")
            .unionByName(scored.where(~enough).withColumn("rank", F.lit(None).cast("long")))
            .select("doc_id", "n_features", "weight", "score", "rank"))
