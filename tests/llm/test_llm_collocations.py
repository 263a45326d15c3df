import re
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kiln.llm import collocations as C
from kiln.llm import oracles, queries

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, threshold, contained=80, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by the definition."""
    seen, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for n in range(1, 5):
                seen.update((lang, tuple(words[i:i + n])) for i in range(len(words) - n + 1))
    found = {k: c for k, c in seen.items() if c >= threshold and len(k[1]) > 1}
    out = {}
    for (lang, p), a in found.items():
        if any(len(q) > len(p) and x == lang and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) and 100 * f >= contained * a
               for (x, q), f in found.items()):
            continue
        cut = min((2_000_000 * a // (seen[lang, p[:k]] + seen[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-cut[0], -a, " ".join(p).encode(), seen[lang, p[:cut[1]]], seen[lang, p[cut[1]:]]))
    return {(lang, i + 1, p.decode(), -a, left, right, total[lang], -s)
            for lang, x in out.items() for i, (s, a, p, left, right) in enumerate(sorted(x)[:top])}


def rows_of(df):
    return {tuple(r) for r in df.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect()}


def texts(seed, n):
    rng = np.random.default_rng(seed)
    words = ["a", "b", "Über", "c-d", "E", "ñ", "x y", "\x00z", "the", "of"]
    out = []
    for i in range(n):
        w = rng.choice(words, rng.integers(0, 60))
        out.append((["en", "de", None, ""][i % 4], "".join(x + rng.choice([" ", "  ", "\t", ", ", ".", "\n", "\x0b"], p=[.6, .1, .1, .1, .04, .04, .02]) for x in w)))
    return out + [("en", None), ("en", ""), ("en", "  . "), ("de", "a b c " * 4000), (None, "the of " * 3000)]


@pytest.mark.parametrize("threshold", [3, 30])
def test_equals_definition(spark, threshold):
    rows = texts(threshold, 120)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert rows_of(C.collocations(df, threshold)) == brute(rows, threshold)


def test_slices_flushes_and_small_summaries(spark, monkeypatch):
    for name, value in (("SLICE", 50), ("HELD", 300), ("ROW", 7), ("REMEMBERED", 40), ("COUNTED", 30), ("MASS", 1 << 11)):
        monkeypatch.setattr(C, name, value)
    rows = texts(7, 30)[:-2]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    assert rows_of(C.collocations(df, 4, top=20)) == brute(rows, 4, top=20)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 40), max_size=80), min_size=1, max_size=8), st.integers(2, 12))
def test_merged_summaries_keep_every_frequent_item(streams, threshold):
    total = Counter()
    held, off = (np.zeros(0, np.uint32), np.zeros(0, np.int64)), 0
    capacity = sum(map(len, streams)) // threshold + 1
    for s in streams:
        keys, counts = np.unique(np.array(s, np.uint32), return_counts=True)
        total.update(s)
        k, c, less = C.merge(held, [(keys, np.minimum(counts, threshold).astype(np.uint8))], capacity)
        held, off = (k, c), off + less
        assert len(k) <= capacity
    assert off < threshold
    kept = dict(zip(held[0].tolist(), held[1].tolist(), strict=True))
    for item, n in total.items():
        assert kept.get(item, 0) <= n
        if n >= threshold:
            assert kept[item] + off >= threshold


def test_scores_beyond_64_bits(spark):
    big = 2 ** 62
    rows = [(big, big, big + 1), (big - 1, 2 ** 63 - 1, big), (3, 5, 7)]
    got = [r[0] for r in spark.createDataFrame(rows, "a long, l long, r long").select(C.cut_score("a", "l", "r")).collect()]
    assert got == [2_000_000 * a // (x + y) for a, x, y in rows]


def test_a_phrase_in_a_third_of_all_rows(spark):
    rows = [("en", "hot phrase here " * 40)] * 150 + [("en", f"cold w{i} w{i % 7} w{i % 7}") for i in range(300)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert rows_of(C.collocations(df)) == brute(rows, 30)


def test_empty_table_and_extra_columns(spark, docs_of):
    assert C.collocations(docs_of([])).count() == 0
    df = docs_of([(None, "one two three. " * 40), (1, "one two"), (1, "one two")], extra=True).withColumn("phrase", F.lit("x"))
    assert rows_of(C.collocations(df)) == brute([("en", "one two three. " * 40), ("en", "one two"), ("en", "one two")], 30)


def test_query_equals_oracle(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf}/documents.parquet')")
    cols = "lang, rank, phrase, a, l, r, n, score"
    want = {tuple(r) for r in con.execute(f"SELECT {cols} FROM ({oracles.COLLOCATIONS})").fetchall()}
    assert rows_of(queries.op13_collocations(spark, sf)) == want
