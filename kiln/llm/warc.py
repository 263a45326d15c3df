"""Seekable Zstandard WARC bundles.

Records are grouped into independent Zstandard frames; a skippable frame at the
end of each file holds the seek table (compressed and decompressed size of every
frame), so a record is read by decompressing one frame.  The index maps a record
id to (file, frame, offset inside the decompressed frame, length).

Of records with equal payloads of at least ``REVISIT_BYTES`` bytes, the one with
the smallest id is a ``response``, the others are ``revisit`` records that refer
to it and carry no payload; smaller payloads are always ``response``.

Files are written by the tasks below a shared folder (any file system that
``pyarrow.fs`` knows by its URI) under a temporary name and then moved, so a task
that runs twice leaves the same file.  A file is closed after ``FILE_BYTES``.

Defined cases: null payload is empty; a null id is written as a ``response`` of
its own without a number and read back as null; rows that repeat the smallest id
are all ``response``; a null uri has no header; an empty table gives no file and
no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import struct

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm.common import materialize, small_batches

REVISIT_BYTES = 100
FRAME_BYTES = 256 << 10
FILE_BYTES = 64 << 20
LEVEL = 3
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_ID = "urn:kiln:page:"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


# ---- one record ----------------------------------------------------------------

def record(page_id: int | None, uri: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """The bytes of one record, with its closing blank lines."""
    revisit = refers_to is not None
    block = _HTTP.format(len(payload)).encode() + (b"" if revisit else payload)
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_ID}{'none' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append("WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += [f"WARC-Refers-To: <{_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _number(value: str | None) -> int | None:
    tail = (value or "").strip("<>").removeprefix(_ID)
    return int(tail) if tail.lstrip("-").isdigit() else None


def parse(data: bytes, at: int = 0) -> tuple[dict, int]:
    """The record that starts at ``at`` and the place after it.  A response's
    digest is computed from its payload and must equal its header."""
    end = data.index(b"\r\n\r\n", at)
    head = {}
    for line in data[at:end].split(b"\r\n")[1:]:
        name, _, value = line.decode().partition(": ")
        head[name.lower()] = value
    start, size = end + 4, int(head["content-length"])
    block = data[start:start + size]
    http, _, body = block.partition(b"\r\n\r\n")
    digest = head["warc-payload-digest"].removeprefix("sha256:")
    revisit = head["warc-type"] == "revisit"
    if revisit:
        length = int(next(x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")).split(b":")[1])
    else:
        length = len(body)
        if hashlib.sha256(body).hexdigest() != digest:
            raise ValueError(f"payload digest of {head['warc-record-id']} does not match")
    return {"page_id": _number(head["warc-record-id"]), "record_type": head["warc-type"],
            "uri": head.get("warc-target-uri"), "payload": None if revisit else body, "payload_bytes": length,
            "payload_digest": digest, "refers_to": _number(head.get("warc-refers-to"))}, start + size + 4


# ---- one bundle ----------------------------------------------------------------

class Bundle:
    """Frames on an output stream, then the seek table."""

    def __init__(self, out):
        self.out, self.packer = out, zstandard.ZstdCompressor(level=LEVEL, write_checksum=True)
        self.sizes, self.buffer, self.at, self.pending = [], io.BytesIO(), 0, []

    def add(self, data: bytes) -> tuple[int, int, int]:
        """(frame, offset in the frame, length) of the record."""
        place = (len(self.sizes), self.buffer.tell(), len(data))
        self.buffer.write(data)
        if self.buffer.tell() >= FRAME_BYTES:
            self.flush()
        return place

    def flush(self) -> None:
        raw = self.buffer.getvalue()
        if raw:
            packed = self.packer.compress(raw)
            self.out.write(packed)
            self.at += len(packed)
            self.sizes.append((len(packed), len(raw)))
            self.buffer = io.BytesIO()

    def close(self) -> None:
        self.flush()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        footer = struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.out.write(struct.pack("<II", SKIPPABLE_MAGIC, len(entries) + len(footer)) + entries + footer)
        self.out.close()


def seek_table(file, size: int) -> list[tuple[int, int, int]]:
    """(start, compressed, decompressed) of every frame, from the footer."""
    file.seek(size - 9)
    count, descriptor, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("no seek table")
    width = 12 if descriptor & 0x80 else 8
    file.seek(size - 9 - count * width)
    table, start, out = file.read(count * width), 0, []
    for i in range(count):
        packed, raw = struct.unpack_from("<II", table, i * width)
        out.append((start, packed, raw))
        start += packed
    return out


# ---- Spark ---------------------------------------------------------------------

def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, uri, payload, digest, refers_to).  Only ids and digests are
    grouped; a payload that a third of all pages share is pre-aggregated to its
    smallest id before it meets its rows."""
    base = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("uri"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    base = base.withColumn("digest", F.sha2("payload", 256))
    narrow = (base.where((F.octet_length("payload") >= REVISIT_BYTES) & F.col("page_id").isNotNull())
              .select("page_id", "digest"))
    first = (narrow.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last"))
             .where("last > refers_to").drop("last"))
    revisits = narrow.join(first, "digest").where("page_id > refers_to").distinct()
    return base.join(revisits, ["page_id", "digest"], "left").select("page_id", "uri", "payload", "digest", "refers_to")


def write_bundles(pages: DataFrame, folder: str) -> DataFrame:
    """Write the pages below ``folder``; the index (page_id, archive, frame,
    frame_start, frame_bytes, offset, length), kept as Parquet."""
    small_batches(pages.sparkSession)

    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        part, serial, bundle, rows = TaskContext.get().partitionId(), 0, None, []

        def closed():
            bundle.close()
            store.move(temp, f"{root}/{name}")
            starts = [0]
            for packed, _ in bundle.sizes:
                starts.append(starts[-1] + packed)
            return pa.RecordBatch.from_pylist(
                [{"page_id": p, "archive": name, "frame": f, "frame_start": starts[f], "frame_bytes": bundle.sizes[f][0],
                  "offset": o, "length": n} for p, (f, o, n) in rows], schema=INDEX)

        for b in batches:
            for r in b.to_pylist():
                if bundle is None:
                    name = f"bundle-{part:06d}-{serial:04d}.warc.zst"
                    temp = f"{root}/_{name}.{TaskContext.get().taskAttemptId()}"
                    bundle, rows, serial = Bundle(store.open_output_stream(temp)), [], serial + 1
                rows.append((r["page_id"], bundle.add(record(r["page_id"], r["uri"], r["payload"], r["digest"], r["refers_to"]))))
                if bundle.at >= FILE_BYTES:
                    yield closed()
                    bundle = None
        if bundle is not None:
            yield closed()

    rows = with_revisits(pages).sortWithinPartitions("page_id", "digest", "uri")
    return materialize(rows.mapInArrow(
        run, "page_id long, archive string, frame int, frame_start long, frame_bytes long, offset long, length long"), "warc-index")


INDEX = pa.schema([("page_id", pa.int64()), ("archive", pa.string()), ("frame", pa.int32()), ("frame_start", pa.int64()),
                   ("frame_bytes", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])
RECORD = ("page_id long, record_type string, uri string, payload binary, payload_bytes long, "
          "payload_digest string, refers_to long")
_RECORD = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("uri", pa.string()), ("payload", pa.binary()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64())])


def _frames(batches, folder: str, pick):
    """Records of the frames that the rows name; ``pick(row, data)`` yields them."""
    store, root = fs.FileSystem.from_uri(folder)
    unpack, name, file = zstandard.ZstdDecompressor(), None, None
    for b in batches:
        out, held = [], 0
        for r in b.to_pylist():
            if r["archive"] != name:
                if file is not None:
                    file.close()
                name, file = r["archive"], store.open_input_file(f"{root}/{r['archive']}")
            file.seek(r["frame_start"])
            data = unpack.decompress(file.read(r["frame_bytes"]))
            held += len(data)
            out += pick(r, data)
            if held >= 16 << 20:
                yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=_RECORD)
    if file is not None:
        file.close()


def frames(spark: SparkSession, folder: str) -> DataFrame:
    """(archive, frame_start, frame_bytes) of every frame, from the seek tables;
    only the files' footers are read."""
    def run(batches):
        store, root = fs.FileSystem.from_uri(folder)
        for b in batches:
            for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                name = path.rsplit("/", 1)[1]
                with store.open_input_file(f"{root}/{name}") as f:
                    table = seek_table(f, size)
                yield pa.RecordBatch.from_pydict({"archive": [name] * len(table), "frame_start": [x[0] for x in table],
                                                  "frame_bytes": [x[1] for x in table]})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "bundle-*.warc.zst").load(folder).select("path", "length")
    return files.mapInArrow(run, "archive string, frame_start long, frame_bytes long")


def read_bundles(spark: SparkSession, folder: str) -> DataFrame:
    """All records below ``folder`` (columns of :data:`RECORD`); frames are
    dealt out over the tasks, whatever file they are in."""
    def every(row, data):
        at = 0
        while at < len(data):
            rec, at = parse(data, at)
            yield rec

    return (frames(spark, folder).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "archive", "frame_start")
            .sortWithinPartitions("archive", "frame_start")
            .mapInArrow(lambda batches: _frames(batches, folder, every), RECORD))


def fetch(index: DataFrame, folder: str, ids: DataFrame) -> DataFrame:
    """The records of ``ids`` (page_id) by the index: one frame is read for each."""
    def one(row, data):
        return [parse(data[row["offset"]:row["offset"] + row["length"]])[0]]

    return (index.join(ids.select("page_id").distinct(), "page_id").sortWithinPartitions("archive", "frame_start")
            .mapInArrow(lambda batches: _frames(batches, folder, one), RECORD))
