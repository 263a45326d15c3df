import hashlib
import os

import pytest
import zstandard
from pyarrow import fs

from kiln.llm import warc as W
from kiln.session import scratch_path

PAGES = "page_id long, url string, html string, digest string"


@pytest.fixture(scope="module")
def rows():
    big = "<p>" + "ü" * 400_000 + "</p>"
    same = "<html>" + "same text " * 30 + "</html>"
    return [(5, "http://a", same, "x"), (2, "http://b", same, "x"), (2, "http://b", same, "x"), (9, None, same, "x"), (1, "u\r\nInjected: 1", "short", "x"),
            (3, "v", "short", "x"), (4, "w", None, "x"), (6, "w", "", "x"), (7, "big", big, "x"), (None, "n", same, "x"), (8, "c", "a\r\n\r\nb" * 40, "x")]


def test_round_trip(spark, rows):
    folder = scratch_path(spark, "warc-test")
    index = W.write_bundles(spark.createDataFrame(rows, PAGES), folder)
    assert index.count() == len(rows)
    got = W.read_bundles(spark, folder).collect()
    assert len(got) == len(rows)
    texts = {r[0]: (r[2] or "").encode() for r in rows if r[0] is not None}
    for r in got:
        if r["page_id"] is None:
            assert r["record_type"] == "response" and r["refers_to"] is None
            continue
        body = texts[r["page_id"]]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body), hashlib.sha256(body).hexdigest())
        assert r["payload"] == (None if r["record_type"] == "revisit" else body)
    kinds = sorted((r["page_id"], r["record_type"], r["refers_to"]) for r in got if r["page_id"] is not None)
    assert [k for k in kinds if k[1] == "revisit"] == [(5, "revisit", 2), (9, "revisit", 2)]


def test_fetch_by_index(spark, rows):
    folder = scratch_path(spark, "warc-test")
    index = W.write_bundles(spark.createDataFrame(rows, PAGES), folder)
    got = {r["page_id"]: r["payload"] for r in W.fetch(index, folder, spark.createDataFrame([(7,), (8,), (100,)], "page_id long")).collect()}
    assert got == {7: rows[8][2].encode(), 8: rows[10][2].encode()}


def test_files_are_plain_zstandard_with_a_seek_table(spark, rows):
    folder = scratch_path(spark, "warc-test")
    W.write_bundles(spark.createDataFrame(rows, PAGES).coalesce(1), folder)
    store, root = fs.FileSystem.from_uri(folder)
    names = [f for f in os.listdir(root) if f.endswith(".warc.zst")]
    assert names and not [f for f in os.listdir(root) if f.startswith("_")]
    total = 0
    for name in names:
        path = os.path.join(root, name)
        with open(path, "rb") as f:
            table = W.seek_table(f, os.path.getsize(path))
        with open(path, "rb") as f:
            raw = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert len(raw) == sum(t[2] for t in table)
        assert raw.startswith(b"WARC/1.1\r\n")
        total += raw.count(b"WARC/1.1\r\nWARC-Type: ")
        assert b"\r\nInjected" not in raw
    assert total == len(rows)


def test_empty_table(spark):
    folder = scratch_path(spark, "warc-test")
    assert W.write_bundles(spark.createDataFrame([], PAGES), folder).count() == 0
    os.makedirs(fs.FileSystem.from_uri(folder)[1], exist_ok=True)
    assert W.read_bundles(spark, folder).count() == 0


def test_large_bundles_roll_over(spark, monkeypatch):
    monkeypatch.setattr(W, "FRAME_BYTES", 2000)
    monkeypatch.setattr(W, "FILE_BYTES", 4000)
    pages = [(i, "u", hashlib.sha512(str(i).encode()).hexdigest() * 8, "x") for i in range(60)]
    folder = scratch_path(spark, "warc-test")
    index = W.write_bundles(spark.createDataFrame(pages, PAGES).coalesce(1), folder)
    assert index.select("archive").distinct().count() > 3
    assert {r["page_id"]: r["payload"].decode() for r in W.read_bundles(spark, folder).collect()} == {p[0]: p[2] for p in pages}
