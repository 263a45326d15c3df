"""Terms shuffled in blocks: the same counts and scores, in a fraction of the rows."""

import pytest
from pyspark.sql import functions as F

from kiln.operators import features as fx
from kiln.operators import naive_bayes as nb
from kiln.operators import packed

WORDS = ["3\x01a b c", "4\x01a b c d", "3\x01a b", "", "a", "\x01", "é\x01è", "\x01\x01", "4\x01", "w" * 3000, "a b c d e"]


@pytest.fixture
def small(monkeypatch):
    """Many flushes, blocks and parts."""
    for name, n in (("BUCKETS", 3), ("FLUSH_BYTES", 1), ("PART_ROWS", 4), ("BLOCK_ROWS", 2), ("BATCH_ROWS", 3)):
        monkeypatch.setattr(packed, name, n)


def test_term_statistics_by_blocks(spark, small):
    rows = [(None if d == 5 else d, WORDS[(d * i) % len(WORDS)] if i else None, d + i) for d in range(12) for i in range(9)]
    tf = spark.createDataFrame(rows, "id long, w string, tf long").repartition(4)
    found = fx.term_statistics(tf, "id", "w")
    expected = tf.groupBy("w").agg(F.sum("tf").alias("cnt"), F.count("id").alias("df"))
    assert found.columns == expected.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_terms_are_shuffled_in_blocks(spark):
    """No row for each term and task goes through a shuffle."""
    docs = spark.createDataFrame([(i, f"c{i % 3}", [f"w{i} {j}" for j in range(50)]) for i in range(40)], "id long, lang string, tokens array<string>")
    stats = fx.term_statistics(fx.term_frequencies(docs.repartition(2, "id"), "id", "tokens", partitioned=True), "id")
    assert stats.count() == 2000
    assert "hashpartitioning(term" not in stats._jdf.queryExecution().toString()
    counted = packed.class_counts(docs.select(F.explode("tokens").alias("term"), F.lit(0).alias("k")))
    assert counted.agg(F.sum("terms"), F.sum("n")).first()[:] == (2000, 2000) and counted.count() <= packed.BUCKETS


@pytest.mark.parametrize("saved", [False, True])
def test_scoring_by_blocks(spark, small, monkeypatch, tmp_path, saved):
    """Above PACK_TERMS terms are joined in blocks, with the scores of the join of rows."""
    rows = [(i, f"c{i % 3}", [None if (i * j) % 13 == 5 else WORDS[(i * j + j) % len(WORDS)] + "x" * (i % 4 == j % 4) for j in range(i % 9)]) for i in range(60)]
    rows += [(60, "c0", ["new"]), (61, "c0", None), (61, None, None), (None, "c1", ["a", "a"]), (None, "c1", ["a", "a"]), (7, "c1", ["", "a"])]
    docs = spark.createDataFrame(rows, "id long, lang string, tokens array<string>").repartition(3)
    model = nb.fit(docs.where("id < 50"), "lang", "tokens")
    if saved:
        model.save(f"{tmp_path}/m")
        model = nb.LongNaiveBayesModel.load(spark, f"{tmp_path}/m")
    a = nb.predict(model, docs, "id", "tokens", keep=("lang",))
    monkeypatch.setattr(nb, "PACK_TERMS", 2)
    b = nb.predict(model, docs, "id", "tokens", keep=("lang",))
    assert "hashpartitioning(bucket" in b._jdf.queryExecution().toString() and "Join" not in b._jdf.queryExecution().toString()
    a, b = (sorted(repr((r.id, r.lang, r.prediction, r.predicted_label, round(r.score, 9))) for r in p.collect()) for p in (a, b))
    assert a == b and len(a) > 60


def test_scoring_with_marks_by_blocks(spark, monkeypatch):
    docs = spark.createDataFrame([(i, f"c{i % 2}", [f"w{(i * j) % 7}" for j in range(5)]) for i in range(20)], "id long, lang string, tokens array<string>")
    vocab = spark.createDataFrame([("w1",), ("w2",), ("never",)], "term string")
    model = nb.fit(docs.where("id > 3"), "lang", "tokens", vocabulary=vocab)
    asked = docs.union(spark.createDataFrame([(99, "c0", ["never", "w1", "lost"])], docs.schema))
    a = nb.predict(model, asked, "id", "tokens").collect()
    monkeypatch.setattr(nb, "PACK_TERMS", 1)
    b = nb.predict(model, asked, "id", "tokens").collect()
    assert sorted((r.id, r.prediction, round(r.score, 9)) for r in a) == sorted((r.id, r.prediction, round(r.score, 9)) for r in b)


@pytest.mark.parametrize("held", [100, 10000])
def test_a_large_bucket_is_worked_on_in_parts(monkeypatch, held):
    """All rows of a term come in one part, parts hold a share of the rows each, and no term is lost."""
    import pyarrow as pa
    monkeypatch.setattr(packed, "BUCKETS", 2)
    monkeypatch.setattr(packed, "PART_ROWS", 100)
    monkeypatch.setattr(packed, "HELD_ROWS", held)
    terms = [f"{i % 2 + 3}\x01a b c {i}" for i in range(600)]      # one bucket: they share their first words
    blocks = [row for _ in range(2) for b in packed._flush([pa.record_batch({"term": pa.array(terms), "k": pa.array([i % 3 for i in range(600)], pa.int32())})], 0, [], False)
              for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "side", "n", "block")), strict=True)]
    assert len({row[0] for row in blocks}) == 1
    parts = [packed._with_tag(sides[0])["term"].to_pylist() for sides in packed._parts([row[1:] for row in blocks])]
    assert len(parts) == 12 and max(map(len, parts)) <= 102
    assert all(p.count(t) == 2 for p in parts for t in p) and sorted(t for p in parts for t in p) == sorted(terms * 2)
    hot = [row for b in packed._flush([pa.record_batch({"term": pa.array(["a", "b", "a", None] * 300), "n": pa.array([1] * 1200)})], 0, None, False)
           for row in zip(*(b.column(c).to_pylist() for c in ("bucket", "side", "n", "block")), strict=True)]
    found = [packed.summed(sides[0], ["term"], ["n"]).to_pylist() for b in {row[0] for row in hot} for sides in packed._parts([row[1:] for row in hot if row[0] == b])]
    assert sorted((str(r["term"]), r["n"]) for p in found for r in p) == [("None", 300), ("b'a'", 600), ("b'b'", 300)]


@pytest.mark.parametrize("query", ["q_nb_ngram", "q_ml_ngram", "q_ml_saved"])
def test_queries_shuffle_no_row_for_a_term(spark, tmp_path, monkeypatch, query):
    import __spark_entry__ as entry
    rows = [(i, f"the cat sat on the mat number {i % 20}" if i % 3 else f"le chat est sur le tapis {i % 20}", "en" if i % 3 else "fr", "s") for i in range(90)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    run = entry.queries()[query]
    a = run(spark, str(tmp_path))
    monkeypatch.setattr(nb, "PACK_TERMS", 1)
    b = run(spark, str(tmp_path))
    plan = b._jdf.queryExecution().toString()
    assert "hashpartitioning(bucket" in plan and "hashpartitioning(term" not in plan and "Join" not in plan
    assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect())) and a.count() > 5
