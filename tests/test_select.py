"""Splits, top-k, running totals (SMP, TOP, WIN)."""

from pyspark.sql import functions as F

from kiln.operators.select import first_n, first_n_per_group, hash_split, stratified_split
from kiln.sinks.files import file_numbers, running_total


def test_hash_split_disjoint_and_complete(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    tr, te = hash_split(d, "doc_id")
    a = {r.doc_id for r in tr.collect()}
    b = {r.doc_id for r in te.collect()}
    assert not (a & b) and len(a | b) == d.count()
    assert 0.7 < len(a) / d.count() < 0.9


def test_stratified_split_per_stratum(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    s = stratified_split(d, "doc_id", "lang", 0.8).groupBy("lang").agg(
        F.avg((F.col("part") == "train").cast("double")).alias("f"), F.count("*").alias("n"))
    for r in s.collect():
        assert abs(r.f - 0.8) <= 1.0 / r.n + 1e-9


def test_first_n_per_group(spark):
    df = spark.createDataFrame([("a", p) for p in "zyxwv"] + [("b", "q")], "g string, p string")
    out = sorted((r.g, r.p) for r in first_n_per_group(df, "g", "p", 2).collect())
    assert out == [("a", "v"), ("a", "w"), ("b", "q")]
    assert first_n(df, "p", 0).count() == 6


def running(rows):
    acc, out = 0, []
    for r in rows:
        acc += r.size
        out.append(acc)
    return out


def test_running_total_two_level(spark):
    df = spark.range(0, 2500).select(F.col("id").alias("k"), (F.col("id") % 7 + 1).alias("size"))
    out = running_total(df, "k", "size", parts=25).orderBy("k").collect()
    assert [r.cum_bytes for r in out] == running(out)


def test_running_total_of_hashed_tied_and_null_keys(spark):
    df = spark.range(0, 900).select(F.when(F.col("id") % 10 > 0, F.md5((F.col("id") % 5).cast("string"))).alias("k"),
                                    (F.col("id") % 7).alias("size"), F.lit("same").alias("other")).repartition(3)
    out = running_total(df, "k", "size", parts=8)
    assert out.columns == ["k", "size", "other", "cum_bytes"]
    rows = out.orderBy("cum_bytes", "size").collect()
    assert len(rows) == 900 and rows[-1].cum_bytes == sum(r.size for r in rows)
    keys = [r.k or "" for r in sorted(rows, key=lambda r: (r.cum_bytes, r.size))]
    assert sorted(keys) == [k for k in sorted(keys)]
    assert max(r.cum_bytes for r in rows if r.k is None) == sum(r.size for r in rows if r.k is None)


def test_running_total_cuts_a_key_that_most_rows_share(spark):
    """No range holds much more than its share, and the window over everything has
    one row per range."""
    df = spark.range(0, 4000).select(F.lit("hot").alias("k"), F.lit(1).alias("size"))
    out = running_total(df, "k", "size", parts=8)
    assert sorted(r.cum_bytes for r in out.collect()) == list(range(1, 4001))
    inside = [c for c in out._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Window [" in c]
    assert len(inside) == 2
    files = out.inputFiles()
    assert max(spark.read.parquet(f).count() for f in files) < 1500


def test_file_numbers_cap(spark):
    df = spark.createDataFrame([(i, 100_000) for i in range(10)], "k long, size long")
    cum = running_total(df, "k", "size")
    out = file_numbers(cum, "cum_bytes", "size", cap_bytes=250_000).orderBy("k").collect()
    assert [r.file_no for r in out] == [0, 0, 0, 1, 1, 2, 2, 2, 3, 3]
    assert out[0].dir == "AA" and out[0].file == "wiki_00"


def test_top_k_per_group_is_group_limited(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("g"), F.col("id").cast("string").alias("p"))
    plan = first_n_per_group(df, "g", "p", 9)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_keep_rows_evaluates_once(spark):
    from kiln.operators.select import keep_rows
    df = spark.createDataFrame([("a b",), ("",)], "t string")
    d = df.select(F.upper(F.regexp_replace("t", "UNIQUEPATTERN", "")).alias("u"))
    out = keep_rows(d, lambda r: F.length(r["u"]) > 0)
    assert out._jdf.queryExecution().optimizedPlan().toString().count("UNIQUEPATTERN") == 1
    assert [r.u for r in out.collect()] == ["A B"]


def test_stratified_split_two_level_equals_window(spark, sf):
    from pyspark.sql import Window
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    ours = {r.doc_id: r.part for r in stratified_split(d, "doc_id", "lang", 0.8, buckets=16).collect()}
    w = Window.partitionBy("lang").orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id")
    ref = d.withColumn("part", F.when(F.percent_rank().over(w) < 0.8, "train").otherwise("test"))
    assert ours == {r.doc_id: r.part for r in ref.collect()}


def test_random_split_seeded_and_complete(spark, sf):
    from kiln.operators.select import random_split
    d = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id")
    a1, b1 = random_split(d, seed=7)
    a2, _ = random_split(d, seed=7)
    ids1 = {r.doc_id for r in a1.collect()}
    assert ids1 == {r.doc_id for r in a2.collect()}                  # reproducible
    assert not ids1 & {r.doc_id for r in b1.collect()}
    assert len(ids1) + b1.count() == d.count()                       # complete
