import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from kiln.llm import common, oracles, queries
from kiln.llm import resample as R

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate(LOWER))
    return [zlib.crc32(f.encode()) % R.BUCKETS for f in words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]]


def brute(rows, bench, percent=25, least=20):
    """(doc_id, n_features, weight, score, rank) by the definition."""
    own = [features(t) for _, t in rows]
    s, t = Counter(x for f in own for x in f), Counter(x for y in bench for x in features(y))
    s_all, t_all = s.total(), t.total()
    gain = lambda b: math.floor(1000 * math.log(float(t[b] + 1) * float(s_all + R.BUCKETS) / (float(s[b] + 1) * float(t_all + R.BUCKETS))))
    out = []
    for (i, _), f in zip(rows, own, strict=True):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    enough = sorted((r for r in out if r[1] >= 2 * least - 1), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(enough[:percent * len(enough) // 100]):
        r[4] = place + 1
    return sorted(map(tuple, out), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


ROWS = [(i, " ".join(f"Wort{(i * j) % 37}" for j in range(5 + i % 40)) + "\nline that repeats in all\n\n" + "déjà vu, it's 42\r\n" * (i % 4)) for i in range(160)]
ODD = [(None, None), (500, ""), (501, "\n \n.\n"), (502, "x"), (503, "one\n\n two \n..\nthree"), (-7, "word " * 30_000), (504, "Äß ñ İ KK\x00nul"),
       (505, "many " * 25), (505, "many " * 25), (9_000_000_000, "A-b_c\n" * 30)]


def test_equals_definition(spark, docs_of):
    bench = ["line that repeats in all", "Wort3 Wort5\nWort7", None, ""]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(bench)], "item_id long, text string")
    got = R.resample(docs_of(ROWS + ODD, extra=True).withColumn("row", F.lit("x")).repartition(5), target)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == brute(ROWS + ODD, bench)


def test_slices_of_long_lines(spark, docs_of, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 40)
    monkeypatch.setattr(R, "REMEMBERED", 5)
    target = spark.createDataFrame([("word many line",)], "text string")
    assert rows_of(R.resample(docs_of(ROWS[:40] + ODD).repartition(2), target, percent=50)) == brute(ROWS[:40] + ODD, ["word many line"], 50)


def test_hot_lines_go_by_broadcast(spark, docs_of, monkeypatch):
    monkeypatch.setattr(common, "HOT_SHARE", 1_000_000)
    rows = [(i, f"the hot line\nown w{i} " + "text " * (i % 30)) for i in range(1500)]
    target = spark.createDataFrame([("text own",)], "text string")
    assert rows_of(R.resample(docs_of(rows).repartition(4), target)) == brute(rows, ["text own"])


def test_a_hot_key_has_few_rows_in_the_shuffle(spark):
    left = common.materialize(spark.range(6000).select((F.col("id") % 3).alias("k"), "id"), "left")
    right = spark.range(5).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = common.join_unique(left, right, ["k"])
    assert "BroadcastHashJoin" in got._jdf.queryExecution().toString()
    assert got.count() == 6000 and got.where("v <> k * 10").count() == 0


@pytest.mark.parametrize("docs, bench", [([], ["a b"]), ([(1, "a b c")], []), ([], [])])
def test_empty_tables(spark, docs_of, docs, bench):
    target = spark.createDataFrame([(t,) for t in bench], "text string")
    assert rows_of(R.resample(docs_of(docs), target)) == brute(docs, bench)


def test_query_equals_oracle(spark, sf):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = sorted((tuple(r) for r in con.execute(f"SELECT doc_id, n_features, weight, score, rank FROM ({oracles.RESAMPLE})").fetchall()), key=str)
    assert rows_of(queries.op12_importance_resampling(spark, sf)) == want
