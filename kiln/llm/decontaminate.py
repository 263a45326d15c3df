"""Benchmark decontamination by the q-gram lemma, with banded alignment.

Texts are normalised (lower case, white space collapsed).  A benchmark item is a
passage, or several overlapping ones of ``PASSAGE`` characters if it is longer.  A
passage of n characters is found in a document where the document has a part at
most ``e = n // PER_EDIT`` edits away.

Such a part shares at least ``n - Q + 1 - Q * e`` character q-grams with the
passage, on diagonals (place in the document minus place in the passage) that lie
at most e apart.  Shared q-grams are counted in overlapping bands of ``2 * BAND``
diagonals, one every ``BAND`` (``BAND`` exceeds every e): each alignment lies
wholly in some band, so no part within the budget is lost.  Bands that reach the
bound are verified: the edit distance of the passage to any part of the region,
by an alignment restricted to the band's diagonals and e beside them.

The benchmark is the query set.  It is cut into blocks of ``BLOCK`` characters;
the q-gram table of a block goes to every task, so the largest thing sent is
bounded by the block, and the documents are scanned once per block, where they
are, without a shuffle.

Defined cases: null text is empty; items of fewer than ``LEAST`` normalised
characters identify nothing and are not searched; with several equal or repeated
items each is reported; rows are reported as often as they occur; empty tables
give no rows; extra columns stay as they are or are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_batches

Q = 8                 # a power of two
PER_EDIT = 12
PASSAGE = 256
BAND = 32             # over PASSAGE * 3 // 2 // PER_EDIT, the largest budget
LEAST = 32
BLOCK = 1 << 20
SLICE = 1 << 17       # characters, and pairs, worked on at a time
TABLE_BITS = 22


def normalise(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def qgrams(c: np.ndarray) -> np.ndarray:
    """64-bit hash of every q-gram."""
    n = len(c) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h, base, step = c.astype(np.uint64), 0x9E3779B97F4A7C15, 1
    while step < Q:                       # grams of 1, 2, 4 .. characters
        h = h[:len(h) - step] * np.uint64(base) + h[step:]
        base, step = base * base & 0xFFFFFFFFFFFFFFFF, step * 2
    return h ^ (h >> np.uint64(29))


def budget(n: int) -> int:
    """Edits allowed in a passage of n characters; none where the lemma needs it."""
    e = n // PER_EDIT
    return e if n - Q + 1 - Q * e > 0 else 0


@dataclass
class Index:
    """A block of passages and its q-grams."""
    items: list[int | None]
    texts: list[str]
    starts: np.ndarray            # of the sorted q-grams: first row in places
    keys: np.ndarray
    owner: np.ndarray             # passage of each place
    offset: np.ndarray
    table: np.ndarray             # quick test by the hash's top bits
    needs: np.ndarray             # q-grams that a part within the budget shares
    grams: list[np.ndarray]       # of each passage


def build(items: list[tuple[int | None, str]]) -> Index:
    ids, texts = [], []
    for item, text in items:
        t = normalise(text)
        if len(t) < LEAST:
            continue
        cuts = [(0, len(t))] if len(t) <= PASSAGE * 3 // 2 else [
            (a, a + PASSAGE) for a in [*range(0, len(t) - PASSAGE, PASSAGE // 2), len(t) - PASSAGE]]
        for a, b in cuts:
            ids.append(item)
            texts.append(t[a:b])
    grams = [qgrams(codes(t)) for t in texts]
    flat = np.concatenate([*grams, np.zeros(0, np.uint64)])
    owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    offset = np.concatenate([*[np.arange(len(g)) for g in grams], np.zeros(0, np.int64)]).astype(np.int64)
    order = np.argsort(flat, kind="stable")
    keys, first = np.unique(flat[order], return_index=True)
    table = np.zeros(1 << TABLE_BITS, bool)
    table[(keys >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True
    needs = np.array([len(t) - Q + 1 - Q * budget(len(t)) for t in texts], np.int64)
    return Index(ids, texts, np.append(first, len(flat)), keys, owner[order], offset[order], table, needs, grams)


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and how often each occurs (or its weights' sum)."""
    if weights is None:
        values = np.sort(values)
        first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
        return values[first], np.diff(np.append(first, len(values)))
    turn = np.argsort(values)
    values, weights = values[turn], weights[turn]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[:len(values)])
    return values[first], np.add.reduceat(weights, first) if len(first) else weights


def _pairs(index: Index, h: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(passage, diagonal) of the shared q-grams, a slice at a time."""
    at = np.flatnonzero(index.table[h >> np.uint64(64 - TABLE_BITS)])
    row = np.searchsorted(index.keys, h[at])
    ok = index.keys[np.minimum(row, len(index.keys) - 1)] == h[at]
    at, row = at[ok], row[ok]
    size = index.starts[row + 1] - index.starts[row]
    ends = np.cumsum(size)
    lo = 0
    while lo < len(at):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + SLICE, side="right")))
        n = size[lo:hi]
        place = np.repeat(index.starts[row[lo:hi]] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        yield index.owner[place], np.repeat(at[lo:hi], n) - index.offset[place]
        lo = hi


def bands(index: Index, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(passage, first diagonal) of the bands that reach their passage's bound;
    ``h``: the q-grams of the text."""
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    low = -(PASSAGE * 3 // 2 + 2 * BAND)
    width = (len(h) - low) // BAND + 2
    for owner, diagonal in _pairs(index, h):
        key, n = counted(owner * width + (diagonal - low) // BAND)
        keys, counts = counted(np.concatenate([keys, key]), np.concatenate([counts, n])) if len(keys) else (key, n)
    # a band covers its own diagonals and the next ones
    next_too = np.append(keys[1:] == keys[:-1] + 1, False)[:len(keys)]
    total = counts + np.where(next_too, np.append(counts[1:], 0)[:len(keys)], 0)
    alone = keys[np.append(True, keys[1:] != keys[:-1] + 1)[:len(keys)]] - 1     # a band with hits in its second half only
    single = counts[np.append(True, keys[1:] != keys[:-1] + 1)[:len(keys)]]
    keys, total = np.concatenate([keys, alone]), np.concatenate([total, single])
    owner = keys // width
    keep = total >= index.needs[owner] if len(keys) else np.zeros(0, bool)
    return owner[keep], keys[keep] % width * BAND + low


def aligned(passage: str, text: str, first: int) -> tuple[int, int]:
    """(edits, end) of the best part of ``text`` on the diagonals ``first`` to
    ``first + 2 * BAND`` and the budget beside them; its end in the text."""
    n, e = len(passage), budget(len(passage))
    left = first - e
    width = 2 * BAND + 2 * e + 1
    padded = np.full(width + n, -1, np.int64)                  # text from diagonal `left` on
    lo, hi = max(0, left), min(len(text), left + width + n)
    if lo < hi:
        padded[lo - left:hi - left] = codes(text[lo:hi])
    far, step = np.int64(1 << 30), np.arange(width + 1)
    place = left + step                                        # text characters before this cell, row 0
    row = np.where((place >= 0) & (place <= len(text)), 0, far)
    differs = np.ones(width + 1, bool)
    for i, c in enumerate(codes(passage).astype(np.int64)):
        np.not_equal(padded[i:i + width], c, out=differs[:width])
        cell = row + differs
        np.minimum(cell[:-1], row[1:] + 1, out=cell[:-1])
        if place[0] + i + 1 < 0 or place[-1] + i + 1 > len(text):
            cell[(place + i + 1 < 0) | (place + i + 1 > len(text))] = far
        cell -= step
        row = np.minimum.accumulate(cell) + step
    k = int(row.argmin())
    return int(row[k]), int(place[k]) + n


def search(index: Index, texts: list[str | None]) -> list[dict[int, tuple[int, int]]]:
    """For each text {passage: (edits, end)} of the passages found in it."""
    found: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
    if not index.texts:
        return found
    clean = [normalise(t) for t in texts]
    lo = 0
    while lo < len(clean):
        hi, size = lo, 0
        while hi < len(clean) and (hi == lo or size + len(clean[hi]) <= SLICE):
            size += len(clean[hi]) + Q
            hi += 1
        # texts end to end, apart by characters that no text has
        gap = [0x110000] * Q
        joined = np.concatenate([x for t in clean[lo:hi] for x in (codes(t), np.array(gap, np.uint32))])
        starts = np.cumsum([0] + [len(t) + Q for t in clean[lo:hi]])
        h = qgrams(joined)
        for p, first in zip(*(x.tolist() for x in bands(index, h)), strict=True):
            n = len(index.texts[p])
            d0 = int(np.searchsorted(starts, max(0, first - n), side="right")) - 1
            d1 = int(np.searchsorted(starts, first + 2 * BAND + 2 * n, side="right")) - 1
            for d in range(max(0, d0), min(hi - lo - 1, d1) + 1):
                text, best = clean[lo + d], found[lo + d].get(p)
                if best and best[0] == 0:
                    continue
                # enough of the passage's own q-grams must be in the band's part of this text
                part = h[max(starts[d], first):min(starts[d] + max(0, len(text) - Q + 1), first + 2 * BAND + n)]
                if np.isin(index.grams[p], part).sum() < index.needs[p]:
                    continue
                from_, to = max(0, first - starts[d] - 2 * BAND), max(0, first - starts[d] + 4 * BAND + 2 * n)
                exact = text.find(index.texts[p], from_, to)
                edits, end = (0, exact + n) if exact >= 0 else aligned(index.texts[p], text, int(first - starts[d]))
                if edits <= budget(n) and (best is None or (edits, end) < best):
                    found[lo + d][p] = (edits, end)
        lo = hi
    return found


def blocks(benchmark: DataFrame) -> Iterator[Index]:
    """The benchmark's passages, a block of items at a time."""
    held, size = [], 0
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        held.append((r["item_id"], r["text"]))
        size += len(r["text"] or "")
        if size >= BLOCK:
            yield build(held)
            held, size = [], 0
    if held:
        yield build(held)


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, edits, region_end, passages): for every row and item the
    closest passage's edits and end in the normalised text, and how many of the
    item's passages were found."""
    spark = docs.sparkSession
    small_batches(spark)
    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    out = spark.createDataFrame([], FOUND)
    for index in blocks(benchmark):
        def run(batches, index=index):
            for b in batches:
                rows = []
                for i, hits in zip(b.column(0).to_pylist(), search(index, b.column(1).to_pylist()), strict=True):
                    by: dict = {}
                    for p, (edits, end) in hits.items():
                        by.setdefault(index.items[p], []).append((edits, end))
                    rows += [{"doc_id": i, "item_id": item, "edits": min(x)[0], "region_end": min(x)[1], "passages": len(x)}
                             for item, x in by.items()]
                yield pa.RecordBatch.from_pylist(rows, schema=_FOUND)

        out = out.unionByName(narrow.mapInArrow(run, FOUND))
    return out


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no passage is found."""
    spark = docs.sparkSession
    small_batches(spark)
    at, schema = docs.columns.index("text"), docs.schema
    for index in blocks(benchmark):
        def run(batches, index=index):
            for b in batches:
                hits = search(index, b.column(at).cast(pa.string()).to_pylist())
                yield b.filter(pa.array([not h for h in hits], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


FOUND = "doc_id long, item_id long, edits int, region_end long, passages int"
_FOUND = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("edits", pa.int32()), ("region_end", pa.int64()), ("passages", pa.int32())])
