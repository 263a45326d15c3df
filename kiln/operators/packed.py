"""Terms sent through a shuffle packed: many to a row, sorted and compressed.

A shuffled row for each (task, term) costs about 25 bytes a term; n-grams hardly repeat
within a task, so that was several times the text.  Here a task sorts the terms it has,
deals them to :data:`BUCKETS` by a hash and sends one block for each bucket: a small
Parquet file in which a term holds only what differs from the term before it.  Terms
that share their first words go to the same bucket, so that an n-gram stands beside the
longer ones that begin with it.  Terms are kept whole: hashes choose the bucket only.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 256
# A task sends its blocks whenever it holds so many bytes of rows.
FLUSH_BYTES = 64 << 20
# So many rows of a bucket are worked on at a time.  The others wait, unpacked up to so
# many; above, the blocks are unpacked again for each part.
PART_ROWS, HELD_ROWS = 2_500_000, 12_000_000
# Rows of a block that is written to a table, of a batch that goes back to Spark.
BLOCK_ROWS, BATCH_ROWS = 1 << 16, 1 << 16
# Terms with the same first words go to the same bucket.
WORDS = 3

PACKED = "bucket int, side int, n long, block binary"

_FACTORS = np.random.default_rng(20).integers(1 << 62, size=1024, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bytes(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary array."""
    offsets = np.frombuffer(values.buffers()[1], np.int32, len(values) + 1, values.offset * 4) if len(values) else np.zeros(1, np.int32)
    return offsets, np.frombuffer(values.buffers()[2] or b"", np.uint8)


def hashes(values: pa.Array, words: int | None = None) -> np.ndarray:
    """A hash of each value, or of its first ``words`` words."""
    offsets, data = _bytes(values)
    out = np.empty(len(values), np.uint64)
    for i in range(0, len(values), 1 << 14):
        o = offsets[i:i + (1 << 14) + 1].astype(np.int64)
        d = data[o[0]:o[-1]]
        o -= o[0]
        at = np.arange(len(d)) - np.repeat(o[:-1], np.diff(o))
        x = (d.astype(np.uint64) + np.uint64(1)) * _FACTORS[at & 1023]
        if words:
            blanks = np.zeros(len(d) + 1, np.int64)
            np.cumsum(d == 32, out=blanks[1:])
            x[blanks[1:] - np.repeat(blanks[o[:-1]], np.diff(o)) >= words] = 0
        sums = np.zeros(len(d) + 1, np.uint64)
        np.cumsum(x, out=sums[1:])
        out[i:i + len(o) - 1] = sums[o[1:]] - sums[o[:-1]]
    out ^= out >> np.uint64(32)
    return (out * _MIX) >> np.uint64(32)


def _without_tag(term: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The terms without the mark of their order (a byte and \\x01), and that byte; 0: none."""
    term = term.cast(pa.binary())
    offsets, data = _bytes(term)
    starts = offsets[:-1]
    tag = np.zeros(len(term), np.uint8)
    long = np.flatnonzero(np.diff(offsets) >= 2)
    long = long[data[starts[long] + 1] == 1]
    tag[long] = data[starts[long]]
    long = long[tag[long] != 0]
    if len(long):
        keep = np.ones(len(data), bool)
        keep[:offsets[0]] = keep[offsets[-1]:] = keep[starts[long]] = keep[starts[long] + 1] = False
        cut = np.zeros(len(offsets), np.int32)
        np.cumsum(tag != 0, out=cut[1:])
        none = term.is_valid().buffers()[1] if term.null_count else None
        term = pa.Array.from_buffers(pa.binary(), len(term), [none, pa.py_buffer(offsets - offsets[0] - 2 * cut), pa.py_buffer(data[keep])])
    return term, tag


def _with_tag(t: pa.Table) -> pa.Table:
    """The table with its terms whole again."""
    term, tag = t["term"].combine_chunks(), t["tag"].combine_chunks().to_numpy(zero_copy_only=False)
    if tag.any():
        marks = pa.array([bytes([i]) for i in range(256)], pa.binary()).take(pa.array(tag))
        term = pc.if_else(pa.array(tag != 0), pc.binary_join_element_wise(marks, term, b"\x01"), term)
    return t.drop_columns("tag").set_column(0, "term", term.view(pa.string()))


def block(t: pa.Table) -> bytes:
    """A table sorted by term as bytes."""
    out = pa.BufferOutputStream()
    pq.write_table(t, out, compression="zstd", compression_level=6, use_dictionary=[c for c in t.column_names if c not in ("term", "_c0")],
                   column_encoding={"term": "DELTA_BYTE_ARRAY"}, write_statistics=False, store_schema=False)
    return out.getvalue().to_pybytes()


def unblock(data: bytes) -> pa.Table:
    return pq.ParquetFile(pa.BufferReader(data)).read(use_threads=False)


def summed(t: pa.Table, keys: list[str], counts: list[str]) -> pa.Table:
    """The sums of ``counts`` for each value of ``keys``; without ``counts``, the rows as ``cnt``."""
    t = t.group_by(keys, use_threads=False).aggregate([(c, "sum") for c in counts] or [([], "count_all")])
    return t.rename_columns([{f"{c}_sum": c for c in counts}.get(n, "cnt" if n == "count_all" else n) for n in t.column_names]).select([*keys, *(counts or ["cnt"])])


def _flush(held: list[pa.RecordBatch], side: int, counts: list[str] | None, spread: bool) -> Iterator[pa.RecordBatch]:
    t = pa.Table.from_batches(held).combine_chunks()
    if not len(t):
        return
    if counts is not None:
        t = summed(t, [c for c in t.column_names if c not in counts], counts).combine_chunks()
    term = t["term"].chunk(0)
    body, tag = _without_tag(term)
    bucket = (hashes(body, WORDS) % np.uint64(BUCKETS)).astype(np.int64)
    if spread and term.null_count:
        none = np.flatnonzero(term.is_null())
        bucket[none] = np.arange(len(none)) % BUCKETS
    order = pc.sort_indices(body).to_numpy()
    order = order[np.argsort(bucket[order], kind="stable")]
    t = t.set_column(0, "term", body).add_column(1, "tag", pa.array(tag)).take(pa.array(order))
    ends = np.cumsum(np.bincount(bucket, minlength=BUCKETS))
    rows = [(b, side, int(end - start), block(t.slice(start, end - start)))
            for b, (start, end) in enumerate(zip([0, *ends[:-1]], ends, strict=True)) if end > start]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int64(), pa.binary()), strict=True)],
                                     names=["bucket", "side", "n", "block"])


def pack(rows: DataFrame, counts: list[str] | None, side: int = 0, spread: bool = False) -> DataFrame:
    """``rows`` (term first, no nested columns) as blocks.  Rows of a task that agree in
    all but ``counts`` are added up; with no names in it they are counted, as ``cnt``.
    ``None``: rows stay as they are.  ``spread``: rows with a null term meet nothing, not
    even each other, and go to any bucket."""
    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += b.nbytes
            if size >= FLUSH_BYTES:
                yield from _flush(held, side, counts, spread)
                held, size = [], 0
        if held:
            yield from _flush(held, side, counts, spread)

    return rows.mapInArrow(run, PACKED)


def _place(t: pa.Table, term: bytes) -> int:
    """The first row of a sorted table that does not come before ``term``; nulls are last."""
    terms = t["term"]
    return bisect.bisect_left(range(len(t)), (False, term), key=lambda i: ((v := terms[i].as_py()) is None, v or b""))


def _parts(held: list[tuple[int, int, bytes]]) -> Iterator[dict[int, pa.Table]]:
    """A bucket's rows by side, about :data:`PART_ROWS` at a time; equal terms come together.
    The blocks are sorted, so a part is a range of terms: a slice of each block."""
    n = sum(rows for _, rows, _ in held)
    blocks = [(side, unblock(data)) for side, _, data in held] if n <= HELD_ROWS else ((side, unblock(data)) for side, _, data in held)
    cuts = []
    if n > PART_ROWS:
        # every so many rows, one term to place the cuts by
        step, at, found = max(1, PART_ROWS // 64), 0, []
        for _, t in blocks:
            found += [t["term"][i].as_py() for i in range(at, len(t), step)]
            at += step * len(range(at, len(t), step)) - len(t)
        each = PART_ROWS // step
        cuts = sorted({*sorted(x for x in found if x is not None)[each::each]})
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        if n > HELD_ROWS:
            blocks = ((side, unblock(data)) for side, _, data in held)
        sides: dict[int, list[pa.Table]] = {}
        for side, t in blocks:
            a, b = 0 if low is None else _place(t, low), len(t) if high is None else _place(t, high)
            if b > a:
                sides.setdefault(side, []).append(t.slice(a, b - a))
        if sides:
            yield {side: pa.concat_tables(ts).combine_chunks() for side, ts in sides.items()}


def by_bucket(packed: DataFrame, work: Callable[[int, dict[int, pa.Table]], Iterator[pa.RecordBatch]], schema: str | T.StructType) -> DataFrame:
    """``work(bucket, {side: rows})`` of each bucket; all rows of a term come in one call.
    The terms in ``rows`` are without their tag, which stands in ``tag``."""
    def run(batches):
        held, now = [], None
        for b in batches:
            for bucket, side, n, data in zip(*(b.column(c).to_pylist() for c in ("bucket", "side", "n", "block")), strict=True):
                if bucket != now and held:
                    for sides in _parts(held):
                        yield from work(now, sides)
                    held = []
                now = bucket
                held.append((side, n, data))
        for sides in _parts(held):
            yield from work(now, sides)

    return packed.select("bucket", "side", "n", "block").repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def _batches(t: pa.Table) -> Iterator[pa.RecordBatch]:
    return t.combine_chunks().to_batches(max_chunksize=BATCH_ROWS)


def term_sums(rows: DataFrame, counts: list[str]) -> DataFrame:
    """``rows.groupBy("term")`` with the sums of ``counts``, by one shuffle of blocks."""
    def work(bucket, sides):
        yield from _batches(_with_tag(summed(sides[0], ["term", "tag"], counts)))

    return by_bucket(pack(rows, counts), work, ", ".join(["term string", *(f"{c} long" for c in counts)]))


#: A bucket's rows (term, k, cnt), sorted, in blocks; the terms in them (each in one row only) and the sum of each k.
COUNTED = f"{PACKED}, terms long, totals array<struct<k: int, n: bigint>>"


def class_counts(rows: DataFrame) -> DataFrame:
    """``rows`` (term, k), one for each occurrence, counted: :data:`COUNTED`."""
    def work(bucket, sides):
        t = summed(sides[0], ["term", "tag", "k"], ["cnt"]).combine_chunks()
        t = t.take(pc.sort_indices(t, [("term", "ascending"), ("tag", "ascending")]))
        term, tag = t["term"].combine_chunks(), t["tag"].combine_chunks()
        other = np.ones(len(t), bool)
        other[1:] = pc.or_(pc.not_equal(term[1:], term[:-1]), pc.not_equal(tag[1:], tag[:-1])).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(other)
        # whole terms to a block
        cuts = [*np.unique(starts[np.searchsorted(starts, np.arange(0, len(t), BLOCK_ROWS), "right") - 1]), len(t)]
        rows = []
        for a, b in zip(cuts, cuts[1:], strict=False):
            one = t.slice(a, b - a)
            by_k = summed(one, ["k"], ["cnt"]).rename_columns(["k", "n"])
            rows.append((bucket, 0, b - a, block(one), int(other[a:b].sum()), by_k.to_pylist()))
        names = ["bucket", "side", "n", "block", "terms", "totals"]
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.struct([("k", pa.int32()), ("n", pa.int64())])))
        for row in rows:
            yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names=names)

    return by_bucket(pack(rows, []), work, COUNTED)


def unpacked(counted: DataFrame) -> DataFrame:
    """(term, k, cnt) of :func:`class_counts`."""
    def run(batches):
        for b in batches:
            for data in b.column("block"):
                yield from _batches(_with_tag(unblock(data.as_py())))

    return counted.select("block").mapInArrow(run, "term string, k int, cnt long")


def by_term(counted: DataFrame) -> DataFrame:
    """(term, found: [(k, cnt)]) of :func:`class_counts`, one row for each term."""
    def run(batches):
        for b in batches:
            for data in b.column("block"):
                t = _with_tag(unblock(data.as_py()))
                term = t["term"].combine_chunks()
                other = np.ones(len(t), bool)
                other[1:] = pc.not_equal(term[1:], term[:-1]).to_numpy(zero_copy_only=False)
                starts = np.flatnonzero(other)
                pairs = pa.StructArray.from_arrays([t["k"].combine_chunks(), t["cnt"].combine_chunks()], ["k", "cnt"])
                found = pa.ListArray.from_arrays(pa.array([*starts, len(t)], pa.int32()), pairs)
                yield from _batches(pa.table({"term": term.take(pa.array(starts)), "found": found}))

    return counted.select("block").mapInArrow(run, "term string, found array<struct<k: int, cnt: bigint>>")


def _matched(docs: pa.Table, model: pa.Table, weight: Callable[[pa.Table], np.ndarray], keys: list[str]) -> pa.Table:
    """For each document's keys and class: the weighted sum and the sum of ``tf``; the
    terms that the model lacks have class null."""
    docs = docs.combine_chunks()
    terms = docs["term"].combine_chunks().dictionary_encode()
    codes, known = terms.indices.to_numpy(zero_copy_only=False), terms.dictionary
    missing = np.isnan(codes) if codes.dtype.kind == "f" else np.zeros(len(codes), bool)
    codes = np.where(missing, -1, codes).astype(np.int64)
    at = pc.index_in(model["term"], value_set=known).combine_chunks()
    hit = at.is_valid().to_numpy(zero_copy_only=False)
    model, at = model.filter(pa.array(hit)).combine_chunks(), at.drop_null().to_numpy()
    order = np.argsort(at, kind="stable")
    n = np.bincount(at, minlength=len(known) + 1)       # the last: of a null term
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    each = n[codes]
    rows = np.repeat(np.arange(len(docs)), each)
    of = order[np.repeat(first[codes], each) + np.arange(len(rows)) - np.repeat(np.cumsum(each) - each, each)]
    tf = docs["tf"].to_numpy()
    w, k = weight(model), model["k"].to_numpy()
    lost = np.flatnonzero(each == 0)
    out = docs.select(keys).take(pa.array(np.concatenate([rows, lost])))
    out = out.append_column("k", pa.array(np.concatenate([k[of], np.zeros(len(lost), np.int32)]).astype(np.int32), mask=np.arange(len(out)) >= len(rows)))
    out = out.append_column("s", pa.array(np.concatenate([tf[rows] * w[of], np.zeros(len(lost))]), mask=np.arange(len(out)) >= len(rows)))
    out = out.append_column("t", pa.array(np.concatenate([tf[rows], tf[lost]])))
    return summed(out, [*keys, "k"], ["s", "t"])


def scored(docs: DataFrame, model: DataFrame, alpha: float) -> DataFrame:
    """``docs`` (term, keys.., tf) joined with a model's blocks, (term, k, cnt) or (term, k,
    w), by the term: keys.., k, s, t summed within each bucket.  ``k`` is null for the terms
    that the model lacks, and ``s`` with it."""
    keys = [c for c in docs.columns if c not in ("term", "tf")]
    schema = T.StructType([*(docs.schema[c] for c in keys), T.StructField("k", T.IntegerType()), T.StructField("s", T.DoubleType()), T.StructField("t", T.LongType())])

    def weight(t):
        return t["w"].to_numpy() if "w" in t.column_names else np.log(t["cnt"].to_numpy() + alpha) - np.log(alpha)

    def work(bucket, sides):
        if 1 in sides:
            model = _with_tag(sides[0]) if 0 in sides else pa.table({"term": pa.array([], pa.string()), "k": pa.array([], pa.int32()), "w": pa.array([], pa.float64())})
            yield from _batches(_matched(_with_tag(sides[1]), model, weight, keys))

    both = pack(docs, ["tf"], side=1, spread=True).unionByName(model.select("bucket", "side", "n", "block"))
    return by_bucket(both, work, schema)


def packable(*kinds: T.DataType) -> bool:
    """Whether columns of these types can be part of a block's rows."""
    return all(isinstance(k, (T.StringType, T.BooleanType, T.IntegralType, T.FractionalType, T.DateType)) for k in kinds)


def class_number(label_col: str, index: list) -> Column:
    """The number of a row's label, by a list of (label, number)."""
    out = None
    for label, k in index:
        same = F.col(label_col).eqNullSafe(F.lit(label))
        out = F.when(same, k) if out is None else out.when(same, k)
    return F.lit(None).cast("int") if out is None else out.cast("int")
