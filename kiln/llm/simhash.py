"""SimHash near-duplicates by the generalised pigeonhole principle.

Fingerprint: lower-cased (A-Z) text, words between ASCII white space, word
shingles with repeats, XXH64 (seed 42) of each; a bit is 1 where over half the
shingle hashes have it.  Documents link when their fingerprints differ in at
most ``distance`` bits; the result is the connected components.

Search.  The 64 bits are grouped into partitions of correlated bits, and each
partition gets its own threshold from -1 (skipped) upwards with
``sum(thresholds) = distance - partitions + 1``: two fingerprints within
``distance`` then agree, in at least one partition, up to that partition's
threshold.  Dynamic programming chooses the thresholds (and the number of
partitions) with the lowest estimated cost, from the bit co-occurrence counts of
all fingerprints.  A partition with threshold t is probed by masking out any t of
its bits; equal masked values meet in a bucket and are verified on all 64 bits.

Hot buckets.  A bucket above ``BUCKET`` fingerprints is never compared
all-against-all: the same principle is applied to its remaining bits, which gives
smaller buckets (several memberships per fingerprint, a bounded factor), until
every bucket is small.  Fingerprints are distinct, so a bucket with r open bits
holds at most 2^r of them and this ends.  Buckets give spanning edges, not all
pairs, and equal fingerprints are one node from the start.

Defined cases: null text is empty; a text without words has fingerprint 0 and
links like any other; with fewer words than a shingle the whole sequence is the
one shingle; rows with a null ``doc_id`` are fingerprinted and take the component
of their fingerprint (null if no row with an id shares it); repeated rows are
kept; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import components, materialize, small_batches

SEED = 42          # seed of XXH64
SHINGLE = 3        # words
DISTANCE = 2       # bits
BUCKET = 512       # fingerprints compared all-against-all at most
CHUNK = 1 << 16    # shingles hashed at a time


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of one UTF-8 text."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    total = max(1, len(words) - shingle + 1)
    ones = np.zeros(64, np.int64)
    digest, join = xxhash.xxh64_intdigest, b" ".join
    for at in range(0, total, CHUNK):
        end = min(total, at + CHUNK)
        hashes = [digest(join(words[i:i + shingle]), SEED) for i in range(at, end)]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            ids, texts = b.column(0), b.column(1).to_pylist()
            fps = np.array([fingerprint(t, shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([ids, pa.array(fps)], names=["doc_id", "fp"])

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
            .mapInArrow(run, "doc_id long, fp long"))


# ---- partitions and thresholds -------------------------------------------------

def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints and the 64 x 64 counts of bits set together, over
    all of them; tasks send one row per bit."""
    def run(batches):
        total, n = np.zeros((64, 64)), 0
        for b in batches:
            x = b.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += bits.T @ bits
            n += len(x)
        if n:
            yield pa.RecordBatch.from_pydict({"bit": pa.array(range(64), pa.int32()), "n": pa.array([n] * 64, pa.int64()),
                                              **{f"c{j}": pa.array(total[:, j].astype(np.int64)) for j in range(64)}})

    cols = [f"c{j}" for j in range(64)]
    part = fps.select("fp").mapInArrow(run, "bit int, n long, " + ", ".join(f"{c} long" for c in cols))
    rows = part.groupBy("bit").agg(F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in cols]).collect()
    out = np.zeros((64, 64))
    for r in rows:
        out[r["bit"]] = [r[c] for c in cols]
    return (rows[0]["n"] if rows else 0), out


def group_bits(free: list[int], corr: np.ndarray, m: int) -> list[list[int]]:
    """``free`` bits in m groups of nearly equal size, correlated bits together."""
    left, groups = list(free), []
    for g in range(m):
        size = len(left) // (m - g)
        group = []
        while len(group) < size:
            score = corr[np.ix_(left, group or left)].sum(axis=1)
            group.append(left.pop(int(np.argmax(score))))
        groups.append(group)
    return groups


def agreement(bits: list[int], n: int, both: np.ndarray, most: int) -> list[float]:
    """Estimated share of random pairs that differ in at most t of ``bits``, for
    t = 0 .. most; each bit is conditioned on its strongest predecessor."""
    p = np.diag(both) / n
    agree = p * p + (1 - p) * (1 - p)
    dist = [1.0] + [0.0] * most
    for k, b in enumerate(bits):
        same = agree[b]
        for a in bits[:k]:
            q11 = both[a, b] / n
            q10, q01 = p[a] - q11, p[b] - q11
            joint = q11 ** 2 + q10 ** 2 + q01 ** 2 + (1 - q11 - q10 - q01) ** 2
            same = max(same, min(1.0, joint / agree[a]))
        dist = [dist[t] * same + (dist[t - 1] * (1 - same) if t else 0) for t in range(most + 1)]
    return list(itertools.accumulate(dist))


def plan(n: int, both: np.ndarray, free: list[int], distance: int, rows: int | None = None) -> list[tuple[list[int], int]]:
    """[(bits, threshold)] of least estimated cost over ``free`` bits: verified
    candidate pairs plus probes, thresholds by dynamic programming."""
    n = max(n, 1)
    p = np.diag(both) / n
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-12))
    corr = np.abs((both / n - np.outer(p, p)) / np.outer(sd, sd))
    np.fill_diagonal(corr, 0)
    rows = rows or n
    pairs = rows * (rows - 1) / 2
    best = (math.inf, [])
    for m in range(1, min(distance + 2, len(free)) + 1):
        groups = group_bits(free, corr, m)
        # table[budget] = (cost, thresholds) after the groups so far
        table = {0: (0.0, [])}
        for g in groups:
            share, nxt = agreement(g, n, both, distance), {}
            for used, (cost, chosen) in table.items():
                for t in range(-1, min(distance, len(g)) + 1):
                    add = 0.0 if t < 0 else pairs * share[t] + 4.0 * rows * math.comb(len(g), t)
                    if used + t not in nxt or cost + add < nxt[used + t][0]:
                        nxt[used + t] = (cost + add, [*chosen, t])
            table = nxt
        cost, chosen = table.get(distance - m + 1, (math.inf, []))
        if cost < best[0]:
            best = (cost, [(g, t) for g, t in zip(groups, chosen, strict=True) if t >= 0])
    return best[1]


def masks(parts: list[tuple[list[int], int]], fixed: int = 0) -> list[int]:
    """The bit masks to probe: a partition's bits without any t of them."""
    out = []
    for bits, t in parts:
        for gone in itertools.combinations(bits, t):
            out.append(fixed | sum(1 << b for b in bits if b not in gone))
    return list(dict.fromkeys(out))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


# ---- probing and verification --------------------------------------------------

def local_links(fps: np.ndarray, roots: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning edges (node, smallest node linked to it) inside one bucket."""
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    label = roots.copy()
    while True:
        low = np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1)
        if (low == label).all():
            break
        label = low
    far = label != roots
    return roots[far], label[far]


def probe(members: DataFrame, distance: int, bucket: int) -> DataFrame:
    """(kind, mask, a, b) of ``members`` (mask, key, fp, root): kind 0 are edges
    a-b, kind 1 the rows (mask, fp = a, root = b) of buckets that are too large.
    Streams over partitions sorted by bucket; holds one bucket at most."""
    def run(batches):
        carry, hot = None, None
        for b in itertools.chain(batches, [None]):
            out: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]] = []
            if b is not None:
                rows = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)])
                if carry is not None:
                    rows = np.concatenate([carry, rows], axis=1)
            elif carry is not None:
                rows = carry
            else:
                break
            ids = rows[:2]
            cut = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
            edge = np.concatenate([[0], cut, [rows.shape[1]]])
            for lo, hi in zip(edge[:-1], edge[1:], strict=True):
                if lo == hi:
                    continue
                key, last = (rows[0, lo], rows[1, lo]), hi == rows.shape[1] and b is not None
                if hi - lo > bucket or key == hot:
                    hot = key
                    out.append((1, rows[0, lo:hi], rows[2, lo:hi], rows[3, lo:hi]))
                    if last:
                        carry = None
                elif last:
                    carry = rows[:, lo:hi].copy()
                elif hi - lo > 1:
                    u, v = local_links(rows[2, lo:hi].view(np.uint64), rows[3, lo:hi], distance)
                    out.append((0, np.zeros(len(u), np.int64), u, v))
            if b is None:
                carry = None
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in out])),
                     *[pa.array(np.concatenate([x[i] for x in out])) for i in (1, 2, 3)]],
                    names=["kind", "mask", "a", "b"])

    return (members.repartition("mask", "key").sortWithinPartitions("mask", "key", "fp")
            .select("mask", "key", "fp", "root").mapInArrow(run, "kind int, mask long, a long, b long"))


def links(nodes: DataFrame, distance: int = DISTANCE, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) whose connected components are those of all pairs of
    ``nodes`` (fp, root) within ``distance`` bits; fp must be distinct."""
    spark = nodes.sparkSession
    n, both = bit_counts(nodes)
    empty = spark.createDataFrame([], "a long, b long")
    if n < 2:
        return empty
    wide = [1 << 64]
    first = masks(plan(n, both, list(range(64)), distance))
    members = nodes.select(F.explode(F.array(*[F.lit(signed(m)).cast("long") for m in first])).alias("mask"), "fp", "root")
    found = []
    while True:
        members = members.withColumn("key", F.col("fp").bitwiseAND(F.col("mask")))
        # Keys that hold so many rows that one task would do most of the work: at
        # most 2,000 of them per level, whatever the input, so they may be sent to
        # every task; they are divided further without being gathered.
        counts = members.groupBy("mask", "key").agg(F.count(F.lit(1)).alias("c"))
        rows = counts.agg(F.sum("c")).first()[0]
        hot = counts.where(F.col("c") > F.greatest(F.lit(bucket), F.lit((rows or 0) // 2000))).select("mask", "key")
        hot = F.broadcast(materialize(hot, "hot"))
        level = materialize(
            probe(members.join(hot, ["mask", "key"], "left_anti"), distance, bucket).unionByName(
                members.join(hot, ["mask", "key"], "left_semi")
                .select(F.lit(1).alias("kind"), "mask", F.col("fp").alias("a"), F.col("root").alias("b"))), "links")
        found.append(level.where("kind = 0").select("a", "b"))
        sizes = {r["mask"]: r["n"] for r in level.where("kind = 1").groupBy("mask").agg(F.count(F.lit(1)).alias("n")).collect()}
        if not sizes:
            break
        # one row per mask: their number does not depend on the data
        finer = [(m, signed(x)) for m, c in sizes.items()
                 for x in masks(plan(n, both, [b for b in range(64) if not m % wide[0] >> b & 1], distance, rows=c), m % wide[0])]
        table = F.broadcast(spark.createDataFrame(finer, "mask long, finer long"))
        members = (level.where("kind = 1").select("mask", F.col("a").alias("fp"), F.col("b").alias("root"))
                   .join(table, "mask").select(F.col("finer").alias("mask"), "fp", "root").distinct())
    out = empty
    for f in found:
        out = out.unionByName(f)
    return out


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE,
                    bucket: int = BUCKET) -> DataFrame:
    """(doc_id, fp, component_id) of every row of ``docs`` (doc_id, text)."""
    own = materialize(fingerprints(docs, shingle), "simhash")
    nodes = materialize(own.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("root")), "nodes")
    label = components(links(nodes, distance, bucket))
    classes = (nodes.join(label.withColumnRenamed("node", "root"), "root", "left")
               .select("fp", F.coalesce("component", "root").alias("component_id")))
    return own.join(classes, "fp", "left").select("doc_id", "fp", "component_id")


def hex_fingerprint(fp):
    """The fingerprint column as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
