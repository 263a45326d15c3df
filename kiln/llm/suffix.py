"""Repeated passages by a run-length compressed Burrows-Wheeler index.

Every byte covered by a ``LENGTH``-byte string that also starts earlier (in a
document of smaller id, or in the same one) is marked; strings lie inside one
document and are judged on the input.

A string of ``LENGTH`` bytes is a *window*.  Each window has one anchor: of its
``GRAM``-byte grams the one with the smallest hash (the first of equals).  Equal
windows have equal anchors at the same place, so windows need to be compared only
with those of the same anchor, and neighbouring windows with one anchor form a
*segment* that is handled as a whole.

1. Anchors: each task counts its anchors and sends each distinct one once; those
   that occur only once in the corpus can have no repeat.
2. Segments: each task lists the segments of the repeated anchors.  Of segments
   with equal bytes the task keeps the earliest; the others are repeats, marked on
   the spot.  The kept ones go to the partition of their anchor.
3. Index: a partition takes its anchors' distinct segments, earliest first, a few
   million bytes at a time, and builds their suffix array and from it the runs of
   their Burrows-Wheeler transform.  The segments are then streamed backward
   through the runs (LF steps): the block of the suffix array that the row reached
   lies in says whether the place matches ``LENGTH`` bytes elsewhere and where the
   earliest such match starts (the sampled positions of run ends are not read).  A
   window with an earlier one is marked.
4. The marks go back by scan partition and are cut out of the texts.

Texts are never shuffled; what a task holds is bounded by its scan partition's
anchors, ``HELD`` bytes of segments and one index of about ``INDEX`` bytes.  An
anchor with very many segments (a phrase in a third of all documents, in different
surroundings) is divided by longer and longer context (:func:`divided`), down to
single windows, which are equal and so as few as there are tasks.

The input must list the same rows in the same partitions each time, as files do;
``stored=False`` writes it first.

Defined cases: null text is empty; texts shorter than ``LENGTH`` lose nothing;
rows without an id come before all others; rows with equal ids count as separate
documents in the order of their text's hash and then of the scan, so of repeated
rows the first stays; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize, read_by_scan, small_batches, write_by_scan

LENGTH = 100          # bytes of a string that counts
GRAM = 32             # bytes of an anchor: a power of two, at most LENGTH
PIECE = 1 << 15       # windows looked at together
HOT = 4096            # segments of an anchor from which it is divided
HELD = 64 << 20       # bytes of segments a task keeps to find equal ones
INDEX = 2 << 20       # bytes of segments per index, about
_LOW = np.uint64((1 << 20) - 1)
_BYTES = np.random.default_rng(5).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


# ---- anchors -------------------------------------------------------------------

def anchors(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(anchor hash, text, first window, number of windows, place of the anchor
    in the first window) of all segments, a few texts (or a part of a long one) at
    a time."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for k, t in enumerate(texts):
        for at in range(0, max(0, len(t) - LENGTH + 1), PIECE):
            part = t[at:at + PIECE + LENGTH - 1] if len(t) > PIECE else t
            if size + len(part) > PIECE + LENGTH and held:
                yield _segments(held)
                held, size = [], 0
            held.append((k, at, part))
            size += len(part)
    if held:
        yield _segments(held)


def _segments(parts: list[tuple[int, int, bytes]]):
    data = np.frombuffer(b"".join([p[2] for p in parts]), np.uint8)
    h, base, step = _BYTES[data], 0x9E3779B97F4A7C15, 1
    while step < GRAM:
        h = h[:len(h) - step] * np.uint64(base) + h[step:]
        base, step = base * base & 0xFFFFFFFFFFFFFFFF, step * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    low = (h & ~_LOW) | np.arange(len(h), dtype=np.uint64)
    span, step = LENGTH - GRAM + 1, 1
    while step * 2 <= span:
        low = np.minimum(low[:len(low) - step], low[step:])
        step *= 2
    if step < span:
        low = np.minimum(low[:len(low) - (span - step)], low[span - step:])
    place = (low & _LOW).astype(np.int32)          # of the anchor, for every window
    sizes = np.array([len(p[2]) for p in parts])
    starts = np.cumsum(sizes) - sizes
    new = np.ones(len(place), bool)
    new[1:] = place[1:] != place[:-1]
    new[starts[1:][starts[1:] < len(new)]] = True
    stops = starts + sizes - LENGTH + 1              # after the last window of each text
    cut = np.zeros(len(place) + 1, bool)
    cut[stops[:-1]] = True                           # windows across two texts begin here
    first = np.flatnonzero(new | cut[:-1])
    owner = np.searchsorted(starts, first, side="right") - 1
    inside = first < stops[owner]
    last = np.append(first[1:], len(place))
    first, last, owner = first[inside], last[inside], owner[inside]
    text, shift = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    return h[place[first]], text[owner], first - starts[owner] + shift[owner], last - first, place[first] - first


def divided(data: bytes, anchor: int, first: int, count: int, at: int, level: int) -> Iterator[tuple[int, int, int]]:
    """(key, first window, windows) of a segment divided ``level`` times by
    context.  A window whose anchor lies early in it holds more text after the
    anchor, one whose anchor lies late more text before it; that text, which equal
    windows share, lengthens the anchor, and half as many places are left."""
    todo = [(0, GRAM, 0, LENGTH - GRAM, level)]      # anchor text [a, b) around its place, anchor places [lo, hi]
    origin = first + at
    while todo:
        a, b, lo, hi, more = todo.pop()
        # windows whose anchor is at place d start at origin - d
        early, late = max(first, origin - hi), min(first + count - 1, origin - lo)
        if early > late:
            continue
        if more and lo < hi:
            m = (lo + hi) // 2
            todo += [(a, LENGTH - m, lo, m, more - 1), (-(m + 1), b, m + 1, hi, more - 1)]
        else:
            name = b"%d %d " % (lo, hi) + data[origin + a:origin + b]
            yield int.from_bytes(hashlib.blake2b(name, digest_size=8).digest(), "little", signed=True), early, late - early + 1


# ---- the run-length index ------------------------------------------------------

class RunIndex:
    """Burrows-Wheeler transform of segments, each closed by its own end mark
    (smaller than every byte, earlier segments first), as runs."""

    def __init__(self, segments: list[bytes]):
        sizes = np.array([len(s) for s in segments])
        self.stops = np.cumsum(sizes + 1) - 1                      # places of the end marks
        self.starts = self.stops - sizes
        n = int(self.stops[-1]) + 1
        text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
        stop = np.repeat(self.stops, sizes + 1)
        order, rank, same = _suffixes(text, stop)
        # symbol before each row: 0 for an end mark, byte + 1
        symbol = text.astype(np.int16) + 1
        symbol[self.stops] = 0
        before = symbol[order - 1]
        # runs, and where each leads
        self.run = np.flatnonzero(np.append(True, before[1:] != before[:-1]))
        head, size = before[self.run].astype(np.int64), np.diff(np.append(self.run, n))
        turn = np.argsort(head, kind="stable")
        leads = np.empty(len(turn), np.int64)
        leads[turn] = np.cumsum(size[turn]) - size[turn]
        self.lead = leads - self.run                               # LF(row) = row + lead of its run
        self.run_end = order[np.append(self.run[1:], n) - 1]       # sampled positions
        # blocks of rows with LENGTH bytes in common, and their earliest start
        block = np.flatnonzero(np.append(True, ~same))
        first = np.minimum.reduceat(order, block)
        wide = np.flatnonzero(np.diff(np.append(block, n)) > 1)
        self.block, self.block_stop, self.first = block[wide], np.append(block, n)[wide + 1], first[wide]
        # the row at which each segment's stream begins: its last whole window
        self.enter = rank[np.maximum(self.stops - LENGTH, self.starts)]

    def back(self, row: np.ndarray) -> np.ndarray:
        """The rows of the suffixes one byte longer."""
        return row + self.lead[np.searchsorted(self.run, row, side="right") - 1]

    def statistics(self, row: np.ndarray, place: np.ndarray) -> np.ndarray:
        """The start of the earliest match of LENGTH bytes; the place itself
        where there is none."""
        if not len(self.block):
            return place
        at = np.searchsorted(self.block, row, side="right") - 1
        hit = (at >= 0) & (row < self.block_stop[at])
        return np.where(hit, self.first[at], place)

    def earlier(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(segment, window) of every window that an earlier one equals; all
        segments are streamed side by side, from their last window backward."""
        which = np.flatnonzero(self.stops - self.starts >= LENGTH)
        row, place = self.enter[which], self.stops[which] - LENGTH
        while len(which):
            old = self.statistics(row, place) < place
            yield which[old], (place - self.starts[which])[old]
            on = place > self.starts[which]
            which, row, place = which[on], row[on], place[on] - 1
            row = self.back(row)


def _ordered(high: np.ndarray, index: np.ndarray, bits: int, free: int) -> tuple[np.ndarray, np.ndarray]:
    """``index`` in the order of ``high``, and where a new value begins; sorted as
    one number where both fit (``free`` bits left beside ``bits`` of the index)."""
    if bits <= free:
        both = np.sort((high << np.uint64(bits)) | index.astype(np.uint64))
        high, index = both >> np.uint64(bits), (both & np.uint64((1 << bits) - 1)).astype(np.int64)
    else:
        turn = np.argsort(high)
        high, index = high[turn], index[turn]
    return index, np.append(True, high[1:] != high[:-1])


def _suffixes(text: np.ndarray, stop: np.ndarray):
    """Sorted suffixes, their ranks, and whether each shares LENGTH bytes with
    the one before it; ranks are doubled in length until all differ."""
    n, depth = len(text), 5
    places, bits = np.arange(n), int(n).bit_length()
    left = stop - places                                           # bytes before the end mark
    key = np.zeros(n, np.uint64)
    for k in range(depth):
        byte = text[np.minimum(places + k, n - 1)].astype(np.uint64)
        key = (key << np.uint64(8)) | np.where(left > k, byte, np.uint64(0))
    key = (key << np.uint64(3)) | np.minimum(left, depth).astype(np.uint64)
    order, new = _ordered(key, places, bits, 64 - 8 * depth - 3)
    marks = np.flatnonzero(left == 0)                              # the smallest; they go by segment
    order[:len(marks)], new[:len(marks)] = marks, True
    new[len(marks):len(marks) + 1] = True
    head = np.maximum.accumulate(np.where(new, places, 0))         # rank of each row
    rank = np.empty(n, np.int64)
    rank[order] = head
    slots, seen = places, None
    while True:
        if depth * 2 > LENGTH and seen is None:
            seen = rank.copy(), LENGTH - depth
        # rows that still equal a neighbour
        tied = np.append(head[1:] == head[:-1], False)
        tied[1:] |= tied[:-1].copy()
        slots, head = slots[tied], head[tied]
        if not len(slots):
            break
        sub = order[slots]
        pair = (head.astype(np.uint64) << np.uint64(bits)) | rank[np.minimum(sub + depth, stop[sub])].astype(np.uint64)
        sub, new = _ordered(pair, sub, bits, 64 - 2 * bits)
        order[slots] = sub
        head = slots[np.maximum.accumulate(np.where(new, np.arange(len(slots)), 0))]
        rank[sub] = head
        depth *= 2
    if seen is None:                                               # all differ before that length
        return order, rank, np.zeros(n - 1, bool)
    # LENGTH bytes are equal where two overlapping stretches are
    part, further = seen
    own, there = part[order], part[np.minimum(order + further, n - 1)]
    whole = left[order] >= LENGTH
    return order, rank, whole[1:] & whole[:-1] & (own[1:] == own[:-1]) & (there[1:] == there[:-1])


# ---- Spark ---------------------------------------------------------------------

def _texts(batch) -> list[bytes]:
    return [t or b"" for t in batch.column(1).to_pylist()]


def repeated_anchors(docs: DataFrame) -> str:
    """Anchors that occur more than once, by scan partition: a side folder of
    (h, level), ``level`` saying how often the anchor is to be divided."""
    def count(batches):
        part, held, size = TaskContext.get().partitionId(), [], 0

        def rows():
            h, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), pa.array(n), pa.array(np.full(len(h), part, np.int32))],
                                              names=["h", "n", "_scan"])

        for b in batches:
            for found in anchors(_texts(b)):
                held.append(found[0])
                size += len(found[0])
            if size >= 4 << 20:
                yield rows()
                held, size = [], 0
        if held:
            yield rows()

    def repeated(batches):
        rest = np.zeros((3, 0), np.int64)
        for b in chain(batches, [None]):
            if b is not None:
                rest = np.concatenate([rest, np.stack([b.column(i).to_numpy().astype(np.int64) for i in range(3)])], axis=1)
            if not rest.shape[1]:
                continue
            edge = np.flatnonzero(np.append(True, rest[0, 1:] != rest[0, :-1]))
            stop = rest.shape[1] if b is None else edge[-1]
            edge = edge[edge < stop]
            if not len(edge):
                continue
            total = np.add.reduceat(rest[1, :stop], edge)
            size = np.diff(np.append(edge, stop))
            level = np.ceil(np.maximum(0, np.log2(np.maximum(total, 1) / HOT)) / 2).astype(np.int32)
            keep = np.repeat(total > 1, size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rest[2, :stop][keep].astype(np.int32)), pa.array(rest[0, :stop][keep]), pa.array(np.repeat(level, size)[keep])],
                names=["_scan", "h", "level"])
            rest = rest[:, stop:]

    once = docs.mapInArrow(count, "h long, n long, _scan int").repartition("h").sortWithinPartitions("h")
    return write_by_scan(once.mapInArrow(repeated, "_scan int, h long, level int"), ["h"], "anchors")


def listed_segments(docs: DataFrame, known: str) -> DataFrame:
    """Kind 0: the distinct segments of the repeated anchors, with the earliest
    place in the task; kind 1: spans (row, start, stop) of the others."""
    def run(batches):
        part, first_row = TaskContext.get().partitionId(), 0
        table = read_by_scan(known, part, _ANCHORS, ["h"])
        have = table["h"].to_numpy().view(np.uint64)
        turn = np.argsort(have)
        have, level = have[turn], table["level"].to_numpy()[turn]
        kept: dict[tuple[int, bytes], tuple] = {}
        size, spans = 0, []

        def segments():
            rows = [(key, *at, data) for (key, data), at in kept.items()]
            cols = list(zip(*rows, strict=True))
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([0] * n, pa.int32()), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array([part] * n, pa.int32()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()), pa.nulls(n, pa.int64()),
                 pa.array(cols[5], pa.binary())], schema=_LISTED)

        def marked():
            row, start, stop = (np.array(x, np.int64) for x in zip(*spans, strict=True))
            row, start, stop = joined(row, start, stop)
            n = len(row)
            return pa.RecordBatch.from_arrays(
                [pa.array([1] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()),
                 pa.array([part] * n, pa.int32()), pa.array(row), pa.array(start), pa.array(stop), pa.nulls(n, pa.binary())], schema=_LISTED)

        for b in batches:
            texts, ids, ties = _texts(b), b.column(0).to_pylist(), b.column(2).to_pylist()
            for h, text, first, count, at in anchors(texts) if len(have) else ():
                found = np.minimum(np.searchsorted(have, h), len(have) - 1)
                own = np.flatnonzero(have[found] == h)
                for hash_, k, f, n, a, lv in zip(h[own].view(np.int64).tolist(), text[own].tolist(), first[own].tolist(), count[own].tolist(),
                                                 at[own].tolist(), level[found[own]].tolist(), strict=True):
                    data = texts[k]
                    for key, s, c in divided(data, hash_, f, n, a, lv) if lv else ((hash_, f, n),):
                        name, here = (key, data[s:s + c + LENGTH - 1]), (ids[k], ties[k], first_row + k, s)
                        there = kept.get(name)
                        if there is None:
                            kept[name] = here
                            size += c + LENGTH + 100
                        else:
                            late = here
                            if here < there:
                                kept[name], late = here, there
                            spans.append((late[2], late[3], late[3] + len(name[1])))
            first_row += len(texts)
            if size >= HELD:
                yield segments()
                kept.clear()
                size = 0
            if len(spans) >= 200_000:
                yield marked()
                spans.clear()
        if kept:
            yield segments()
        if spans:
            yield marked()

    return docs.mapInArrow(run, LISTED)


def joined(row: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Spans of the same row that overlap or touch, made one; in order."""
    turn = np.lexsort((start, row))
    row, start, stop = row[turn], start[turn], stop[turn]
    wide = int(stop.max(initial=0)) + 1
    _, dense = np.unique(row, return_inverse=True)
    reach = np.maximum.accumulate(dense * wide + stop)
    new = np.append(True, (row[1:] != row[:-1]) | (dense[1:] * wide + start[1:] > reach[:-1]))[:len(row)]
    head = np.flatnonzero(new)
    return row[head], start[head], np.maximum.reduceat(stop, head) if len(head) else stop


def repeats(segments: DataFrame) -> DataFrame:
    """Spans (_scan, row, start, stop) of the windows with an earlier equal one,
    by one index after the other over partitions sorted by anchor and time."""
    def resolve(rows: list[tuple]) -> pa.RecordBatch:
        # rows: key, scan, row, start, data; equal bytes are in the order of time
        firsts: dict[tuple[int, bytes], int] = {}
        spans, own = [], []
        for key, scan, row, start, data in rows:
            if (key, data) in firsts:
                spans.append((scan, row, start, start + len(data)))
            else:
                firsts[key, data] = len(own)
                own.append((scan, row, start))
        # windows of one segment have their common anchor at different places, so an
        # anchor with a single distinct segment has no repeat in it
        several = Counter(key for key, _ in firsts)
        chosen = [k for k, (key, _) in enumerate(firsts) if several[key] > 1]
        text = [data for key, data in firsts if several[key] > 1]
        own = [own[k] for k in chosen]
        hits = list(RunIndex(text).earlier()) if text else []
        which = np.concatenate([x[0] for x in hits]) if hits else np.zeros(0, np.int64)
        if len(which):
            window = np.concatenate([x[1] for x in hits])
            place = np.array(own, np.int64)[which]
            k, start, stop = joined(which, place[:, 2] + window, place[:, 2] + window + LENGTH)
            place = np.array(own, np.int64)[k]
            spans += list(zip(place[:, 0].tolist(), place[:, 1].tolist(), start.tolist(), stop.tolist(), strict=True))
        cols = list(zip(*spans, strict=True)) if spans else [()] * 4
        return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *[pa.array(c, pa.int64()) for c in cols[1:]]], schema=_SPANS)

    def run(batches):
        held, size = [], 0
        for b in batches:
            for r in zip(*[c.to_pylist() for c in b.columns], strict=True):
                if size >= INDEX and r[0] != held[-1][0]:
                    yield resolve(held)
                    held, size = [], 0
                held.append(r)
                size += len(r[4])
        if held:
            yield resolve(held)

    return (segments.repartition("key").sortWithinPartitions("key", "doc_id", "tie", "_scan", "row", "start")
            .select("key", "_scan", "row", "start", "segment").mapInArrow(run, "_scan int, row long, start long, stop long"))


def repeated_spans(docs: DataFrame) -> str:
    """All marks, by scan partition: a side folder of (row, start, stop)."""
    listed = materialize(listed_segments(docs, repeated_anchors(docs)), "segments")
    found = repeats(listed.where("kind = 0")).unionByName(listed.where("kind = 1").select("_scan", "row", "start", "stop"))
    return write_by_scan(found, ["row", "start"], "repeats")


def without_repeats(docs: DataFrame, stored: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, spans, kept) of every row: the removed runs
    as [start, stop) pairs and the bytes that are left."""
    small_batches(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("doc_id"), F.col("text").cast("binary").alias("text"),
                       F.xxhash64("text").alias("tie"), F.col("doc_id").cast("long").alias("own_id"))
    if not stored:
        docs = materialize(docs, "suffix-input")
    marks = repeated_spans(docs)

    def run(batches):
        table = read_by_scan(marks, TaskContext.get().partitionId(), _MARKS, ["row", "start"])
        row, start, stop = joined(*[table[c].to_numpy().astype(np.int64) for c in ("row", "start", "stop")])
        at = 0
        for b in batches:
            out = []
            for i, data in zip(b.column(3).to_pylist(), _texts(b), strict=True):
                lo, hi = np.searchsorted(row, [at, at + 1])
                cuts = list(zip(start[lo:hi].tolist(), stop[lo:hi].tolist(), strict=True))
                if cuts and cuts[-1][1] > len(data):
                    raise ValueError("the input lists other rows than before; store it first")
                edges = [0, *[x for c in cuts for x in c], len(data)]
                kept = b"".join([data[a:z] for a, z in zip(edges[::2], edges[1::2], strict=True)])
                out.append({"doc_id": i, "n_bytes": len(data), "n_removed": len(data) - len(kept), "spans": cuts, "kept": kept})
                at += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in out], _KEPT.field(c).type) if c != "spans" else
                 pa.array([[{"start": a, "stop": z} for a, z in r[c]] for r in out], _KEPT.field(c).type) for c in _KEPT.names], schema=_KEPT)

    return docs.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, spans array<struct<start: long, stop: long>>, kept binary")


_ANCHORS = pa.schema([("h", pa.int64()), ("level", pa.int32())])
LISTED = "kind int, key long, doc_id long, tie long, _scan int, row long, start long, stop long, segment binary"
_LISTED = pa.schema([("kind", pa.int32()), ("key", pa.int64()), ("doc_id", pa.int64()), ("tie", pa.int64()), ("_scan", pa.int32()),
                     ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("segment", pa.binary())])
_SPANS = pa.schema([("_scan", pa.int32()), ("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_MARKS = pa.schema([("row", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])
_KEPT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                   ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])
