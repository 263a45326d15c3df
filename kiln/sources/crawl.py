"""Web-crawl text records (SRC-5, SRC-6, FLT-3, FLT-4).

A WET/WARC file is split into records by the text source's multi-character
``lineSep`` (plain files stay splittable; a ``.gz`` is one task per file).
The separator is ``"\\nWARC/1."`` so a record of format 1.0 or 1.1 starts only
at a line start (Q2); the minor version stays in front of the record, and the
first record of a file still carries its leading ``WARC/1.``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Record marker and header names used by the loader.
RECORD_SEP = "\nWARC/1."
VERSION = r"^(WARC/1\.)?[0-9]\r?\n"
TARGET_URI = "WARC-Target-URI"
DROP_PREFIXES = ("WARC", "Content-")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Raw record text per WARC/WET record (column ``value``)."""
    return spark.read.option("lineSep", RECORD_SEP).text(path)


def parse_records(raw: DataFrame) -> DataFrame:
    """SRC-6 on raw records: ``url``, ``header`` map, ``payload``.  Header and
    payload are separated at the first blank line (LF or CRLF).  A header that is
    given several times (legal, e.g. ``WARC-Concurrent-To``) keeps all its values,
    joined by ``", "``.  Works on batch and streaming frames alike."""
    rec = F.regexp_replace(F.col("value"), VERSION, "")
    # the header block by plain search, the map only where a plan asks for it
    head = F.substring_index(F.replace(rec, F.lit("\r"), F.lit("")), "\n\n", 1)
    uri = F.regexp_extract(head, rf"(?m)^{TARGET_URI}: ([^\n]*)", 1)
    payload = F.coalesce(F.split(rec, r"\r?\n\r?\n", 2)[1], F.lit(""))
    fields = F.transform(F.split(head, "\n"), lambda x: F.struct(
        F.substring_index(x, ": ", 1).alias("name"), F.when(F.instr(x, ": ") > 0, F.substr(x, F.instr(x, ": ") + 2)).alias("value")))

    def merged(f):
        names = F.array_distinct(F.transform(f, lambda x: x["name"]))
        return F.map_from_arrays(names, F.transform(names, lambda n: F.array_join(
            F.transform(F.filter(f, lambda x: x["name"] == n), lambda x: x["value"]), ", ")))

    # one list of the fields, so that the record is cut once and not for every name
    header = F.transform(F.array(fields), merged)[0]
    return raw.filter(F.col("value").rlike(r"\S")).select(
        F.when(uri != "", uri).alias("url"), header.alias("header"), payload.alias("payload"), F.col("_metadata.file_path").alias("file"))


def warc_records(spark: SparkSession, path: str) -> DataFrame:
    """SRC-6: one row per record of the files at ``path``."""
    return parse_records(read_records(spark, path))


def documents_of(records: DataFrame) -> DataFrame:
    """SRC-5 + FLT-3 on parsed records: (URI, text) of records with a target URI."""
    text = F.regexp_replace(F.col("payload"), r"\s+$", "")
    return records.filter(F.col("url").isNotNull() & (F.col("url") != "")).select(
        F.col("url").alias("URI"), text.alias("text"))


def compat_documents_of(raw: DataFrame) -> DataFrame:
    """SRC-5 + FLT-4 in the reference's form: every line of the record that
    does not start with ``WARC`` or ``Content-``, fused with no separator (Q1)."""
    rec = F.regexp_replace(F.col("value"), VERSION, "")
    lines = F.split(F.regexp_replace(rec, r"\r", ""), "\n")
    kept = F.filter(lines, lambda l: ~(l.startswith("WARC") | l.startswith("Content-")))
    uri = F.regexp_extract(rec, rf"(?m)^{TARGET_URI}: ([^\r\n]*)", 1)
    out = raw.select(uri.alias("URI"), F.array_join(kept, "").alias("text"))
    return out.filter(F.col("URI") != "")


def wet_documents(spark: SparkSession, path: str, compat: bool = False) -> DataFrame:
    """SRC-5 + FLT-3 (+ FLT-4 in compat mode): (URI, text) of every record
    with a target URI.  Default: text = payload with trailing white space
    removed (line breaks kept, Q1); ``compat=True``: the reference's form."""
    raw = read_records(spark, path)
    return compat_documents_of(raw) if compat else documents_of(parse_records(raw))


def wet_record(uri_col, text_col, record_id_col, date: str = "2016-02-05T21:52:39Z",
               eol: str = "\n", version="1.0", concurrent=None):
    """One WET conversion record as text (for writing fixtures and exports);
    ``concurrent``: an array of ids, each written as ``WARC-Concurrent-To``."""
    def c(x):
        return F.col(x) if isinstance(x, str) else x

    body = c(text_col)
    version = F.lit(version) if isinstance(version, str) else version
    more = F.lit("") if concurrent is None else F.array_join(
        F.transform(concurrent, lambda i: F.concat(F.lit("WARC-Concurrent-To: <urn:uuid:"), i.cast("string"), F.lit(f">{eol}"))), "")
    return F.concat(
        F.lit("WARC/"), version, F.lit(f"{eol}WARC-Type: conversion{eol}WARC-Target-URI: "), c(uri_col),
        F.lit(f"{eol}WARC-Date: {date}{eol}"), more, F.lit("WARC-Record-ID: <urn:uuid:"), c(record_id_col).cast("string"),
        F.lit(f">{eol}Content-Type: text/plain{eol}Content-Length: "),
        F.octet_length(body).cast("string"), F.lit(f"{eol}{eol}"), body, F.lit(f"{eol}{eol}"))


def warcinfo_record(eol: str = "\n") -> str:
    """The leading ``warcinfo`` record of a WET file (no target URI)."""
    return (f"WARC/1.0{eol}WARC-Type: warcinfo{eol}WARC-Date: 2016-02-16T22:12:55Z{eol}"
            f"WARC-Record-ID: <urn:uuid:0>{eol}Content-Type: application/warc-fields{eol}"
            f"Content-Length: 25{eol}{eol}isPartOf: CC-MAIN-2016-07{eol}{eol}")
