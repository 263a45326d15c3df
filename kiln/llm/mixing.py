"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are put in a seeded random order and cut into blocks of
``block`` documents.  The weights are taken as exact fractions: with ``c_s`` whole
shares of source s in their ratio and ``P`` the shares of all sources that still
have blocks, its weight is ``w = c_s / P``, and its i-th block (from 0) is released
at slot ``floor(i / w)`` with deadline ``ceil((i + 1) / w)``.  Earliest deadline
first among the released blocks fills every slot and keeps each source, after any
number of slots t, within less than one block of ``w * t``.

All lags are zero again after P slots, so the schedule repeats: the driver works
out one period, or the slots until a source is used up if that comes first, and a
block's slot follows from its number by arithmetic inside the tasks.  When a source
is used up, a new phase begins with the others' weights and the bound starts anew.
Every document gets exactly one place.  The driver sees one count per source; the
plan holds at most eight bytes a block (not a document), and phases are at most as
many as sources.

Defined cases: a null source is a source of its own; sources of
weight 0, as those that ``weights`` does not name, follow when all others are used
up, with equal weights; negative and non-finite weights are errors; equal deadlines
go by source name; repeated rows are separate documents and
rows with equal ids are interchangeable; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import fresh, materialize

BLOCK = 64           # documents
ALPHA = 0.7          # default weights: documents of the source to this power
SEED = 17
BUCKET = 20_000      # rows ranked in one window, about


def shares(weights: dict[str, float], period: int | None = None) -> dict[str, int]:
    """Weights as whole shares in exactly their ratio; with ``period`` rounded to so
    many shares in all, at least one each, by largest remainder."""
    if period is None:
        if not all(0 <= w < math.inf for w in weights.values()):
            raise ValueError("weights must be finite and not negative")
        exact = {s: Fraction(w) for s, w in weights.items()}
        scale = math.lcm(*(x.denominator for x in exact.values()))
        whole = {s: int(x * scale) for s, x in exact.items()}
        common = math.gcd(*whole.values()) or 1
        return {s: x // common for s, x in whole.items()}
    period = max(period, 4 * len(weights))
    total = sum(weights.values()) or 1.0
    exact = {s: w / total * period for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s)):
        if sum(out.values()) >= period:
            break
        out[s] += 1
    return out


def one_period(c: dict[str, int], blocks: dict[str, int] | None = None) -> list[str]:
    """The source of each of the sum(c) slots, earliest deadline first; with
    ``blocks`` only up to the slot that uses up the first source."""
    p, t, order = sum(c.values()), 0, []
    waiting = [(0, -(-p // n), s, 0) for s, n in c.items()]   # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    while t < p:
        while waiting and waiting[0][0] <= t:
            _, d, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (d, s, i))
        _, s, i = heapq.heappop(ready)
        order.append(s)
        i += 1
        if blocks is not None and i == blocks[s]:
            break
        if i < c[s]:
            heapq.heappush(waiting, (i * p // c[s], -(-(i + 1) * p // c[s]), s, i))
        t += 1
    return order


def phases(blocks: dict[str, int], c: dict[str, int]) -> dict[str, list[tuple]]:
    """For each source its phases: (first block, base slot, period, slots of its
    blocks in one period, or in the phase where that is shorter)."""
    left, done, base = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0
    out: dict[str, list[tuple]] = {s: [] for s in blocks}
    while left:
        active = {s: c[s] for s in left if c[s]} or dict.fromkeys(left, 1)
        common = math.gcd(*active.values())
        active = {s: n // common for s, n in active.items()}
        order = one_period(active, left)
        p = len(order)
        place: dict[str, list[int]] = {s: [] for s in active}
        for slot, s in enumerate(order):
            place[s].append(slot)
        slots = {s: np.array(x, np.int64) for s, x in place.items()}
        # a source without a slot here stays for a later phase
        end = min((left[s] - 1) // len(x) * p + int(x[(left[s] - 1) % len(x)]) for s, x in slots.items() if len(x)) + 1
        for s, x in slots.items():
            if not len(x):
                continue
            out[s].append((done[s], base, p, x))
            used = end // p * len(x) + int(np.searchsorted(x, end % p))
            done[s] += used
            left[s] -= used
        left = {s: n for s, n in left.items() if n}
        base += end
    return out


def ranked(docs: DataFrame, seed: int = SEED) -> DataFrame:
    """(doc_id, source, _source, _rank): the document's place in its source's
    seeded random order, ranked in two levels so that a hot source is spread
    over many tasks."""
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"))
    narrow = narrow.withColumns({"_source": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
                                 "_hash": F.xxhash64(F.lit(seed), "doc_id")})
    narrow = materialize(narrow, "mix-ids")
    parts = max(1, -(-narrow.count() // BUCKET))
    narrow = narrow.withColumn("_bucket", F.pmod("_hash", F.lit(parts)))
    counts = narrow.groupBy("_source", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.partitionBy("_source").orderBy("_bucket"))
    before = counts.select("_source", "_bucket", (upto - F.col("_n")).alias("_before"))
    inside = Window.partitionBy("_source", "_bucket").orderBy("_hash", "doc_id")
    return (narrow.withColumn("_in", F.row_number().over(inside) - 1).join(before, ["_source", "_bucket"])
            .select("doc_id", "source", "_source", (F.col("_before") + F.col("_in")).alias("_rank")))


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK,
             period: int | None = None, seed: int = SEED) -> DataFrame:
    """(doc_id, source, block, slot, position): ``slot`` of the document's block in
    the mix and ``position = slot * block + place in the block``, the order to read in;
    ``period`` rounds the weights to so many shares."""
    order = materialize(ranked(docs, seed), "mix-ranks")
    sizes = {r["_source"]: r["n"] for r in order.groupBy("_source").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = {"=" + s if s is not None else "": w for s, w in (weights or {}).items()}
    want = {s: float(given.get(s, 0.0)) for s in sizes} if weights else {s: n ** ALPHA for s, n in sizes.items()}
    table = phases({s: -(-n // block) for s, n in sizes.items()}, shares(want, period))
    starts = {s: np.array([x[0] for x in rows], np.int64) for s, rows in table.items()}

    def run(batches):
        for b in batches:
            ids, source, key, rank = b.columns
            rank = rank.to_numpy(zero_copy_only=False).astype(np.int64)
            number, slot = rank // block, np.zeros(len(rank), np.int64)
            names = np.array(key.to_pylist(), object)
            for s in set(names.tolist()):
                at = np.flatnonzero(names == s)
                phase = np.searchsorted(starts[s], number[at], side="right") - 1
                for k in np.unique(phase):
                    first, base, p, places = table[s][k]
                    own = at[phase == k]
                    i = number[own] - first
                    slot[own] = base + i // len(places) * p + places[i % len(places)]
            yield pa.RecordBatch.from_arrays(
                [ids, source, pa.array(number), pa.array(slot), pa.array(slot * block + rank % block)],
                names=["doc_id", "source", "block", "slot", "position"])

    return (order.select("doc_id", "source", "_source", "_rank")
            .mapInArrow(run, "doc_id long, source string, block long, slot long, position long"))


def mixed(docs: DataFrame, **options) -> DataFrame:
    """All rows of ``docs`` with their own columns, in files that follow the mix
    (rows with equal ids stay together; rows without an id come first)."""
    at, own = fresh(docs, "_mix"), fresh(docs, "_mix_id")
    place = schedule(docs, **options).where("doc_id is not null").groupBy(F.col("doc_id").alias(own)).agg(F.min("position").alias(at))
    joined = docs.join(place, F.col("doc_id") == F.col(own), "left").drop(own)
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return joined.repartitionByRange(n, at).sortWithinPartitions(at).drop(at)
