"""Token ids in training order: packed sequences, permuted, in fixed-stride shards.

All documents, in the order of their ids (or, with ``as_listed``, of their files
and the rows in them) and each closed by the end-of-text token, make one stream of token ids that is cut into sequences of ``LENGTH``; the
last one is filled up with end-of-text tokens.  A keyed Feistel permutation of
the sequence numbers, walked along its cycle until it falls inside the range,
gives every sequence its global slot: no shuffle order is stored, and slot and
sequence can each be worked out from the other.  Shard k holds slots
``k * SHARD`` to ``(k + 1) * SHARD - 1`` as 2-byte little-endian ids, so slot s is
at byte ``(s % SHARD) * LENGTH * 2`` of its file: readers stream a shard in order
and resume at any slot.

Jobs.  The first pass counts the tokens of every document; the offsets in the
stream are running sums over those counts (ids and counts only).  They are
written back by scan partition, so that the second pass finds the offsets of its
own documents in one small file and the texts never move: the only large shuffle
carries the token ids of each piece to its shard.  The input must list the same
rows in the same partitions both times, as files do; ``stored=False`` writes it
first.  Ids are checked against the offsets, and a difference raises an error.

Shards are written under a temporary name and moved, so a task that runs twice
leaves the same file.

Defined cases: null text is empty and gives the end-of-text token alone; special
token strings in a text are ordinary text; rows without an id come first; rows
with equal ids go by the hash of their text (``as_listed``: all rows as they
stand), repeated rows are kept; an empty
table gives no sequence and no shard; extra columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import materialize, read_by_scan, running_offsets, small_batches, write_by_scan

LENGTH = 2048                 # tokens of a sequence
SHARD = 4096                  # sequences of a shard
KEY = "kiln-training-order"
ROUNDS = 6
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END = 50256
GROUP = 4 << 20               # bytes of text that are tokenised together

# Fixed value: the vocabulary's split pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


# ---- the permutation -----------------------------------------------------------

class Feistel:
    """A keyed bijection of 0 .. n - 1."""

    def __init__(self, n: int, key: str = KEY):
        self.n = n
        self.half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
        self.mask = np.uint64((1 << self.half) - 1)
        self.keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}|{n}|{r}".encode()).digest()[:8], "little")) for r in range(ROUNDS)]

    def _mix(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
        return (x ^ (x >> np.uint64(29))) & self.mask

    def _once(self, x: np.ndarray, keys) -> np.ndarray:
        left, right = x >> np.uint64(self.half), x & self.mask
        for k in keys:
            left, right = right, left ^ self._mix(right, k)
        return (right << np.uint64(self.half)) | left

    def _walk(self, x, keys) -> np.ndarray:
        y = self._once(np.asarray(x, np.uint64), keys)
        while (out := y >= self.n).any():
            y[out] = self._once(y[out], keys)
        return y.astype(np.int64)

    def slot(self, sequence) -> np.ndarray:
        return self._walk(sequence, self.keys)

    def sequence(self, slot) -> np.ndarray:
        return self._walk(slot, self.keys[::-1])


# ---- tokens --------------------------------------------------------------------

class Tokenizer:
    """Byte-pair ids (2-byte, little-endian) of whole texts.  The split pattern
    never joins a space to what stands before it unless that is white space too,
    so words between single spaces can be tokenised apart: the texts of a group are
    cut and their distinct words found by Arrow, these are tokenised in one call,
    and the ids of the texts are put together from those of their words.  A text in
    which white space meets such a space is tokenised whole."""

    def __init__(self, vocabulary: bytes):
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.spaced = np.zeros(1 << 16, bool)          # ids that begin with a space
        self.spaced[[i for t, i in ranks.items() if t[:1] == b" "]] = True

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.encoding.encode_ordinary(text), "<u2")

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of distinct words, each with a space before it: all ids, where each word's
        begin (and the end of the last), and which cannot be tokenised apart (these
        get no ids)."""
        last = pc.utf8_slice_codeunits(words, -1).dictionary_encode()
        odd = np.array([not c or c.isspace() for c in last.dictionary.to_pylist()], bool)[last.indices.to_numpy()]
        size = np.zeros(len(words) + 1, np.int64)
        plain = words.filter(pa.array(~odd))
        if not len(plain):
            return np.empty(0, "<u2"), size, odd
        ids = self.whole(" " + pc.binary_join(pa.ListArray.from_arrays([0, len(plain)], plain), " ")[0].as_py())
        first = np.flatnonzero(self.spaced[ids])       # one such id for each word
        size[1:][~odd] = np.diff(np.append(first, len(ids)))
        return ids, np.cumsum(size), odd

    def _group(self, texts: pa.Array, gather: bool) -> tuple[np.ndarray, bytes]:
        """Number of ids of each text and, with ``gather``, the ids of all."""
        cut = pc.split_pattern(texts, " ")
        at = cut.offsets.to_numpy().astype(np.int64)
        found, at = cut.flatten().dictionary_encode(), at - at[0]
        data, ends, odd_word = self._words(found.dictionary)
        word, head = found.indices.to_numpy().copy(), at[:-1]
        opening = found.dictionary.take(pa.array(word[head])).to_pylist()
        odd = odd_word[word]
        odd[head] = [w[-1:].isspace() for w in opening]
        odd = np.logical_or.reduceat(odd, head)
        # a text's first word has no space before it: it has ids of its own, which
        # are those of the whole text (and no other word has any) if need be
        own = [self.whole(texts[k].as_py() if odd[k] else w) for k, w in enumerate(opening)]
        ends = np.concatenate([ends, ends[-1] + np.cumsum([0, *map(len, own)])])
        word[np.repeat(odd, np.diff(at))] = len(odd_word)
        word[head] = len(odd_word) + 1 + np.arange(len(own))
        counts = np.add.reduceat(np.diff(ends)[word], head)
        if not gather:
            return counts, b""
        parts = pa.LargeListArray.from_arrays(ends, np.concatenate([data, *own]))
        return counts, parts.take(pa.array(word)).flatten().to_numpy().tobytes()

    def _groups(self, texts: pa.Array) -> Iterator[pa.Array]:
        """``texts`` without nulls, in groups of about ``GROUP`` bytes."""
        texts = pc.fill_null(texts, "")
        group = np.cumsum(pc.binary_length(texts).to_numpy().astype(np.int64)) // GROUP
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(texts)]
        for a, z in zip(edges, edges[1:], strict=False):
            if z > a:
                yield texts.slice(a, z - a)

    def ids(self, texts: list[str | None] | pa.Array) -> list[bytes]:
        out = []
        for part in self._groups(_array(texts)):
            counts, data = self._group(part, gather=True)
            stop = (2 * np.cumsum(counts)).tolist()
            out.extend(data[a:z] for a, z in zip([0, *stop], stop, strict=False))
        return out

    def counts(self, texts: list[str | None] | pa.Array) -> list[int]:
        """Number of ids of each text."""
        return [n for part in self._groups(_array(texts)) for n in self._group(part, gather=False)[0].tolist()]


def _array(texts) -> pa.Array:
    return texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())


def tokenizer(vocabulary: bytes) -> Tokenizer:
    """One per Python worker.  Code that is sent by value has no lasting globals,
    so the worker's tokenizer is kept with the imported library."""
    kept = tiktoken.__dict__.setdefault("_kiln_tokenizers", {})
    if vocabulary not in kept:
        kept.clear()
        kept[vocabulary] = Tokenizer(vocabulary)
    return kept[vocabulary]


# ---- Spark ---------------------------------------------------------------------

def _known(folder: str, part: int, rows: int) -> tuple[list, list]:
    """Ids and stream offsets of the documents of a scan partition, in its order."""
    table = read_by_scan(folder, part, _OFFSETS, ["_row"])
    if table["_row"].to_pylist() != list(range(table.num_rows)) or table.num_rows < rows:
        raise ValueError("the input lists other rows than before; store it first")
    return table["doc_id"].to_pylist(), table["_offset"].to_pylist()


def write_shards(docs: DataFrame, folder: str, key: str = KEY, length: int = LENGTH, shard: int = SHARD,
                 vocabulary: str = TOKENIZER, end: int = END, stored: bool = True, as_listed: bool = False) -> DataFrame:
    """Write the shards of ``docs`` below ``folder`` and return their index, one
    row per sequence: slot, sequence, shard, byte_offset, n_tokens (without the
    filling), doc_ids (in stream order), tokens_sha256.  ``as_listed`` cuts the
    sequences from the rows as the input's files list them (by number of the file,
    as Spark names them, then row), not by id."""
    spark = docs.sparkSession
    small_batches(spark)
    if as_listed and not stored:
        raise ValueError("only a stored input has an order of its own")
    keys = ["doc_id", "_tie", "_scan", "_row"]
    listed = []
    if as_listed:
        about = docs.metadataColumn("_metadata")
        name = about.getField("file_path")
        # file numbers are padded, so a longer name has the higher number
        listed = [F.length(name).alias("_long"), name.alias("_file"), about.getField("row_index").alias("_at")]
        keys = ["_long", "_file", "_at"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                       F.xxhash64("text").alias("_tie"), *listed)
    if not stored:
        docs = materialize(docs, "order-input")
    with open(vocabulary, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())

    def lengths(batches):
        counts, part, at = tokenizer(shared.value).counts, TaskContext.get().partitionId(), 0
        for b in batches:
            n = [x + 1 for x in counts(b.column(1))]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(n, pa.int64()), pa.array([part] * len(n), pa.int32()),
                 pa.array(range(at, at + len(n)), pa.int64())], names=["doc_id", *b.schema.names[2:], "_n", "_scan", "_row"])
            at += len(n)

    extra = "_long int, _file string, _at long, " if as_listed else ""
    counts = materialize(docs.mapInArrow(lengths, f"doc_id long, _tie long, {extra}_n long, _scan int, _row long"), "token-counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    n = -(-total // length)
    order = running_offsets(counts, keys, F.col("_n"), "_offset")
    places = write_by_scan(order.select("_scan", "_row", "doc_id", "_offset"), ["_row"], "token-offsets")

    def pieces(batches):
        encode, part, at = tokenizer(shared.value).ids, TaskContext.get().partitionId(), 0
        permute, closing, known = Feistel(n, key), np.array([end], "<u2").tobytes(), None
        for b in batches:
            ids = b.column(0).to_pylist()
            if known is None:
                known = _known(places, part, len(ids))
            out = []
            for k, (i, tokens) in enumerate(zip(ids, encode(b.column(1)), strict=True)):
                if at + k >= len(known[0]) or known[0][at + k] != i:
                    raise ValueError("the input lists other rows than before; store it first")
                data, start = tokens + closing, known[1][at + k]
                stop = start + len(data) // 2
                for s in range(start // length, (stop - 1) // length + 1):
                    lo, hi = max(start, s * length), min(stop, (s + 1) * length)
                    out.append((s, lo - s * length, i, data[(lo - start) * 2:(hi - start) * 2]))
            at += len(ids)
            slots = permute.slot([x[0] for x in out])
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots // shard), pa.array(slots), pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.int32()),
                 pa.array([x[2] for x in out], pa.int64()), pa.array([x[3] for x in out], pa.binary())],
                names=["shard", "slot", "sequence", "place", "doc_id", "ids"])

    def write(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        held, rows, file, number, temp = None, [], None, None, ""
        filling = np.array([end], "<u2").tobytes()

        def put():
            nonlocal file, number, temp
            slot, sequence, data, owners = held
            body = b"".join(data)
            if slot // shard != number:
                shut()
                number = slot // shard
                temp = f"{root}/_{shard_name(number)}.{TaskContext.get().taskAttemptId()}"
                file = store.open_output_stream(temp)
            full = body + filling * (length - len(body) // 2)
            file.write(full)
            rows.append({"slot": slot, "sequence": sequence, "shard": number, "byte_offset": slot % shard * length * 2,
                         "n_tokens": len(body) // 2, "doc_ids": owners, "tokens_sha256": hashlib.sha256(full).hexdigest()})

        def shut():
            if file is not None:
                file.close()
                store.move(temp, f"{root}/{shard_name(number)}")

        for b in batches:
            for r in b.to_pylist():
                if held is not None and held[0] != r["slot"]:
                    put()
                    held = None
                if held is None:
                    held = (r["slot"], r["sequence"], [], [])
                held[2].append(r["ids"])
                held[3].append(r["doc_id"])
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)
                rows = []
        if held is not None:
            put()
        shut()
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=_INDEX)

    shards = max(1, -(-n // shard))
    parts = min(shards, max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) * 4)
    index = materialize(docs.mapInArrow(pieces, "shard long, slot long, sequence long, place int, doc_id long, ids binary")
                        .repartitionById(parts, F.expr(f"cast(shard * {parts} div {shards} as int)")).sortWithinPartitions("slot", "place").mapInArrow(write, INDEX), "order-index")
    store, root = fs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    with store.open_output_stream(f"{root}/order.json") as f:
        f.write(json.dumps({"sequences": n, "tokens": total, "length": length, "shard": shard, "key": key, "end": end}).encode())
    return index


INDEX = ("slot long, sequence long, shard long, byte_offset long, n_tokens int, doc_ids array<long>, tokens_sha256 string")
_OFFSETS = pa.schema([("_row", pa.int64()), ("doc_id", pa.int64()), ("_offset", pa.int64())])
_INDEX = pa.schema([("slot", pa.int64()), ("sequence", pa.int64()), ("shard", pa.int64()), ("byte_offset", pa.int64()),
                    ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("tokens_sha256", pa.string())])


def shard_name(number: int) -> str:
    return f"shard-{number:08d}.bin"


def read_slots(folder: str, first: int = 0, count: int | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(slot, token ids) from slot ``first`` on, one shard after the other; a
    reader that stopped goes on from the next slot."""
    store, root = fs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/order.json") as f:
        about = json.loads(f.read())
    stride, last = about["length"] * 2, about["sequences"] if count is None else min(about["sequences"], first + count)
    for number in range(first // about["shard"], math.ceil(last / about["shard"])):
        start = number * about["shard"]
        with store.open_input_file(f"{root}/{shard_name(number)}") as f:
            f.seek(max(0, first - start) * stride)
            for slot in range(max(first, start), min(last, start + about["shard"])):
                yield slot, np.frombuffer(f.read(stride), "<u2")
