"""Phrase collocations from mergeable Misra-Gries summaries and an exact count.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends, and
the pieces into words at blanks and tabs.  Everything is counted per language.  A
candidate is a phrase of 2 to 4 words with at least ``threshold`` occurrences.

Finding the candidates.  The n-grams are dealt by hash over partitions.  Each task
summarises its n-grams per partition, and the summaries of a partition are merged
into one with a capacity of more than mass / threshold counters: over the capacity,
the (capacity + 1)-th largest count is taken off all and what falls to zero goes,
so at most mass / (capacity + 1) < threshold is ever taken from a counter, and
every frequent n-gram keeps one.  A summary's counts are clipped at the threshold
before they are merged (who reaches it in one task is frequent anyway), so a hot
phrase adds little mass.  Those whose count plus what was taken off is below the
threshold go too.  What is left sets bits of a filter of at most ``2 ** FILTER_BITS``
bits: its size is bounded, and a wrong bit only makes more to count.

The first scan summarises word pairs.  The second one summarises phrases of 3 and 4
words, only where all their pairs passed the first filter (no phrase is more frequent
than its parts), and the words of the pairs that passed.  The last scan counts,
exactly and as text, every n-gram that passes the filters: its tasks send their counts
packed, many to a row, and each hash partition adds them up.

Scores.  Cutting a candidate in two parts with l and r occurrences gives
``floor(SCALE * a / (l + r))``; its lowest cut counts.  A candidate inside a longer
one that has at least ``contained`` percent of its occurrences is dropped.  The
first ``top`` of each language are returned.

Defined cases: null text is empty; a null language is ``und``; null and repeated ids
do not matter, repeated rows count each; texts of any length are read in slices;
ties go by the occurrences, then the phrase; an empty table gives no rows; extra
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import join_unique, materialize, slices, small_batches

THRESHOLD = 30
LONGEST = 4
CONTAINED = 80         # percent
TOP = 2000
SCALE = 2_000_000
MASS = 1 << 26         # n-grams a hash partition holds, about
FILTER_BITS = 28       # 32 MB at most
SLICE = 1 << 22        # bytes of text worked on at a time
HELD = 1 << 22         # hashes kept in a task before they are summed up
ROW = 1 << 14          # counters in a row of a summary
REMEMBERED = 300_000   # words kept in a task
COUNTED = 1 << 19      # phrases kept in a task
SPREAD = 64            # groups a language is ranked in first

# A-Z lower-cased, tab to blank, piece separators to one mark.
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))
_MARK = b"."
_STEP, _FINAL = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9E3779B97F4A7C15)


class _Hashes(dict):
    """Word to 64-bit hash; 0 for the mark."""
    def __missing__(self, word: bytes) -> int:
        h = self[word] = 0 if word == _MARK else xxhash.xxh64_intdigest(word, 13) or 1
        return h


def runs(batches) -> Iterator[tuple[str, list[bytes], int]]:
    """(language, words, new) of batches of (lang, text): the texts of a language
    one after the other, a mark between pieces.  Long runs come in slices: words
    before ``new`` are the end of the slice before, repeated as the beginning of
    phrases."""
    for b in batches:
        by_lang: dict[str, list[bytes]] = {}
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if text:
                by_lang.setdefault("und" if lang is None else lang, []).append(text.encode("utf-8").translate(_TABLE))
        for lang, texts in by_lang.items():
            tail: list[bytes] = []
            for part in slices(_MARK.join(texts), SLICE, b" ."):
                words = tail + part.replace(_MARK, b" . ").split()
                yield lang, words, len(tail)
                tail = words[1 - LONGEST:]
                if _MARK in tail:
                    tail = tail[len(tail) - tail[::-1].index(_MARK):]


def grams(hashes: np.ndarray, lang: str, new: int, sizes: list[int] | range) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """{size: (hash, valid)} of the n-grams that begin at each word; valid where
    they hold no mark and end with a new word."""
    seed = np.uint64(xxhash.xxh64_intdigest(lang.encode("utf-8")))
    out, g, ok = {}, hashes, hashes != 0
    for n in range(1, max(sizes) + 1):
        if n > 1:
            g = g[:-1] * _STEP + hashes[n - 1:]
            ok = ok[:-1] & (hashes[n - 1:] != 0)
        x = (g ^ (seed + np.uint64(n))) * _FINAL
        x ^= x >> np.uint64(29)
        x *= _STEP
        x ^= x >> np.uint64(32)
        fresh = ok.copy()
        fresh[:max(0, new - n + 1)] = False
        out[n] = x, fresh
    return out


class Filter:
    """A bit set over the first bits of a hash's partition and key."""
    def __init__(self, bits: np.ndarray, parts: int):
        self.bits, self.parts = bits, np.uint64(parts - 1)
        self.shift = np.uint64(32 + (parts - 1).bit_length() - (len(bits) * 8 - 1).bit_length())

    def has(self, x: np.ndarray) -> np.ndarray:
        at = place(x, self.parts) >> self.shift
        return (self.bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 != 0


def place(x: np.ndarray, mask: np.uint64) -> np.ndarray:
    """Partition and 32-bit key of a hash, as one number."""
    return ((x >> np.uint64(32)) & mask) << np.uint64(32) | (x & np.uint64(0xFFFFFFFF))


def with_pairs(found: dict[int, tuple[np.ndarray, np.ndarray]], pairs: Filter, n: int) -> np.ndarray:
    """Where the n-gram is valid and all its word pairs passed; a word: where a pair
    that ends with a new word and holds it passed."""
    has = pairs.has(found[2][0])
    if n == 1:
        has &= found[2][1]
        return np.append(has, False)[:len(found[1][0])] | np.append(False, has)[:len(found[1][0])]
    ok = found[n][1].copy()
    for k in range(n - 1):
        ok &= has[k:len(has) - n + 2 + k]
    return ok


def merge(held: tuple[np.ndarray, np.ndarray], more: list[tuple[np.ndarray, np.ndarray]], capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Misra-Gries: the sum of summaries (key, count), cut to ``capacity`` counters;
    last, how much was taken off each counter."""
    keys = np.concatenate([held[0], *[k for k, _ in more]])
    counts = np.concatenate([held[1], *[c.astype(np.int64) for _, c in more]])
    turn = np.argsort(keys, kind="stable")
    keys, counts = keys[turn], counts[turn]
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[:len(keys)])
    keys, counts = keys[first], np.add.reduceat(counts, first) if len(first) else counts
    if len(keys) <= capacity:
        return keys, counts, 0
    off = int(np.partition(counts, len(counts) - capacity - 1)[len(counts) - capacity - 1])
    keep = counts > off
    return keys[keep], counts[keep] - off, off


def _summaries(docs: DataFrame, sizes: list[int] | range, parts: int, threshold: int, pairs=None) -> DataFrame:
    """(part, kind, mass, keys, counts): of each task and partition its mass (kind
    0), and its n-grams' keys and clipped counts (kind 1)."""
    kind = np.min_scalar_type(threshold)
    schema = pa.schema([("part", pa.int32()), ("kind", pa.int32()), ("mass", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        cache, buffer, size, mask = _Hashes(), [], 0, np.uint64(parts - 1)

        def rows():
            x = np.sort(np.concatenate(buffer))
            first = np.flatnonzero(np.append(True, x[1:] != x[:-1])[:len(x)])
            n = np.minimum(np.diff(np.append(first, len(x))), threshold)
            x = x[first]
            part = (x >> np.uint64(32)).astype(np.int64)
            keys, n = x.astype(np.uint32), n.astype(kind)
            have, at = np.unique(part, return_index=True)
            ends = np.append(at, len(x))[1:]
            cut = [(p, 0, int(n[a:e].sum(dtype=np.int64)), None, None) for p, a, e in zip(have.tolist(), at, ends, strict=True)]
            cut += [(p, 1, 0, keys[i:min(i + ROW, e)].tobytes(), n[i:min(i + ROW, e)].tobytes())
                    for p, a, e in zip(have.tolist(), at, ends, strict=True) for i in range(a, e, ROW)]
            for lo in range(0, len(cut), 256):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cut[lo:lo + 256], strict=True), schema.types, strict=True)], schema=schema)

        for lang, words, new in runs(batches):
            found = grams(np.array([cache[w] for w in words], np.uint64), lang, new, sizes)
            if len(cache) > REMEMBERED:
                cache.clear()
            for n in sizes:
                x, ok = found[n]
                if pairs is not None:
                    ok = with_pairs(found, Filter(pairs.value, parts), n)
                buffer.append(place(x[ok], mask))
                size += len(buffer[-1])
            if size >= HELD:
                yield from rows()
                buffer, size = [], 0
        if size:
            yield from rows()

    return docs.mapInArrow(run, "part int, kind int, mass long, keys binary, counts binary")


def survivors(docs: DataFrame, sizes: list[int] | range, parts: int, bits: int, threshold: int, pairs=None) -> np.ndarray:
    """The filter of the n-grams of ``sizes`` that may reach the threshold.  The
    driver gets its bits, of a fixed size."""
    own = bits - (parts - 1).bit_length()          # bits of a partition's share
    kind = np.min_scalar_type(threshold)

    def run(batches):
        empty = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        part, mass, off, held, more, waiting = None, 0, 0, empty, [], 0

        def merged():
            nonlocal held, off, more, waiting
            k, c, less = merge(held, more, mass // threshold + 1)
            held, off, more, waiting = (k, c), off + less, [], 0

        def done():
            merged()
            keys = held[0][held[1] + off >= threshold] >> np.uint32(32 - own)
            at = np.zeros(1 << own, np.uint8)
            at[keys] = 1
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([np.packbits(at, bitorder="little").tobytes()], pa.binary())],
                                              names=["part", "bits"])

        for b in batches:
            for r in b.to_pylist():
                if r["part"] != part:
                    if part is not None:
                        yield done()
                    part, mass, off, held = r["part"], 0, 0, empty
                if r["kind"] == 0:                  # all masses come before the counts
                    mass += r["mass"]
                    continue
                more.append((np.frombuffer(r["keys"], np.uint32), np.frombuffer(r["counts"], kind)))
                waiting += len(more[-1][0])
                if waiting >= max(HELD, len(held[0])):
                    merged()
        if part is not None:
            yield done()

    found = (_summaries(docs, sizes, parts, threshold, pairs).repartition(parts, "part").sortWithinPartitions("part", "kind")
             .mapInArrow(run, "part int, bits binary"))
    out = np.zeros((parts, (1 << own) // 8), np.uint8)
    for r in found.toLocalIterator():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def counted(docs: DataFrame, parts: int, threshold: int, pairs, others) -> DataFrame:
    """(lang, size, phrase, n) with the exact number of occurrences of each n-gram
    that passes and has at least ``threshold``; size 0: all words of a language."""
    packed = pa.schema([("part", pa.int32()), ("lang", pa.string()), ("size", pa.int32()), ("phrases", pa.binary()), ("counts", pa.binary())])
    whole = pa.schema([("lang", pa.string()), ("size", pa.int32()), ("phrase", pa.string()), ("n", pa.int64())])

    def batch(schema, rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), schema.types, strict=True)], schema=schema)

    def run(batches):
        cache, seen = _Hashes(), {}

        def rows():
            out = []
            for (lang, n), own in seen.items():
                by_part: dict[int, list] = {}
                for p in own:
                    by_part.setdefault(xxhash.xxh32_intdigest(p) & (parts - 1), []).append(p)
                for part, held in by_part.items():
                    for lo in range(0, len(held), ROW):
                        some = held[lo:lo + ROW]
                        out.append((part, lang, n, b"\n".join(some), np.array([own[p] for p in some], np.int64).tobytes()))
            for lo in range(0, len(out), 256):
                yield batch(packed, out[lo:lo + 256])

        for lang, words, new in runs(batches):
            found = grams(np.array([cache[w] for w in words], np.uint64), lang, new, range(1, LONGEST + 1))
            if len(cache) > REMEMBERED:
                cache.clear()
            two, other = Filter(pairs.value, parts), Filter(others.value, parts)
            seen.setdefault((lang, 0), Counter())[b""] += int(found[1][1].sum())
            for n, (x, ok) in found.items():
                passes = ok & other.has(x) if n == 1 else with_pairs(found, two, n) & (n == 2 or other.has(x))
                at = np.flatnonzero(passes).tolist()
                seen.setdefault((lang, n), Counter()).update([words[i] for i in at] if n == 1 else [b" ".join(words[i:i + n]) for i in at])
            if sum(map(len, seen.values())) >= COUNTED:
                yield from rows()
                seen = {}
        yield from rows()

    def added(batches):
        key, own = None, {}

        def done():
            held = [(key[1], key[2], p.decode("utf-8"), c) for p, c in own.items() if c >= threshold or not key[2]]
            for lo in range(0, len(held), 10_000):
                yield batch(whole, held[lo:lo + 10_000])

        for b in batches:
            for part, lang, n, phrases, counts in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if (part, lang, n) != key:
                    if own:
                        yield from done()
                    key, own = (part, lang, n), {}
                for p, c in zip(phrases.split(b"\n"), np.frombuffer(counts, np.int64).tolist(), strict=True):
                    own[p] = own.get(p, 0) + c
        if own:
            yield from done()

    return (docs.mapInArrow(run, "part int, lang string, size int, phrases binary, counts binary")
            .repartition(parts, "part").sortWithinPartitions("part", "lang", "size")
            .mapInArrow(added, "lang string, size int, phrase string, n long"))


def frequent(docs: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(lang, size, phrase, n) of every phrase of 2 to 4 words with at least
    ``threshold`` occurrences, and of their words, stored; size 0 holds a language's
    number of words."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("lang").cast("string"), F.col("text").cast("string"))
    words = (docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2 + 1          # at most
    parts = 1 << (max(words // MASS, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length()
    bits = max((parts - 1).bit_length() + 3, min(FILTER_BITS, (16 * words // threshold).bit_length(), (parts - 1).bit_length() + 32))
    sc = spark.sparkContext
    pairs = sc.broadcast(survivors(docs, [2], parts, bits, threshold))
    others = sc.broadcast(survivors(docs, [1, *range(3, LONGEST + 1)], parts, bits, threshold, pairs))
    return materialize(counted(docs, parts, threshold, pairs, others), "phrases")


def wide(c) -> F.Column:
    return F.col(c).cast("decimal(20,0)")


def cut_score(a: str, left: str, right: str) -> F.Column:
    """floor(SCALE * a / (l + r)) of long columns, exactly."""
    return F.expr(f"({SCALE}BD * cast({a} as decimal(20,0))) div (cast({left} as decimal(20,0)) + cast({right} as decimal(20,0)))")


def collocations(docs: DataFrame, threshold: int = THRESHOLD, contained: int = CONTAINED, top: int = TOP) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top``."""
    counts = frequent(docs, threshold)
    words = F.split("phrase", " ")
    phrases = counts.where("size >= 2")
    cuts = materialize(
        phrases.select("lang", "phrase", F.col("n").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        .select("lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
                F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest")), "cuts")
    parts = counts.where(f"size between 1 and {LONGEST - 1}")
    halves = materialize(join_unique(cuts, parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"]), "halves")
    whole = join_unique(halves, parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"])
    lowest = (whole.groupBy("lang", "phrase", "a").agg(F.min(F.struct(cut_score("a", "l", "r").alias("score"), "k", "l", "r")).alias("cut"))
              .select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score"))
    sizes = F.sequence(F.lit(2), F.col("size") - 1)
    inside = F.flatten(F.transform(sizes, lambda m: F.transform(
        F.sequence(F.lit(1), F.col("size") - m + 1), lambda i: F.array_join(F.slice(words, i, m), " "))))
    longest = (phrases.where("size >= 3").select("lang", F.explode(inside).alias("phrase"), "n")
               .groupBy("lang", "phrase").agg(F.max("n").alias("_longer")))
    kept = lowest.join(longest, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | (F.lit(100) * wide("_longer") < F.lit(contained) * wide("a"))).drop("_longer")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))).orderBy(*order)
    first = kept.withColumn("_some", F.row_number().over(some)).where(F.col("_some") <= top).drop("_some")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    total = counts.where("size = 0").select("lang", "n")
    return ranked.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
