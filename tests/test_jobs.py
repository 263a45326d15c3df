"""End-to-end jobs (J2, J4, J5) on fixtures written from the driver tables."""

from pyspark.sql import functions as F

from kiln.plans import jobs
from kiln.plans.corpus import article_file
from kiln.plans.ingest import write_wet
from kiln.session import scratch_path
from kiln.sinks import files as sink


def test_language_id_job(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    root = scratch_path(spark, "wp-data")
    d = d.unionByName(d.where("doc_id % 3 = 0"))      # articles repeat
    blocks = d.select(sink.doc_block("doc_id", "source", "text", "https://x.example/wiki").alias("block"), "lang")
    sink.write_doc_blocks(blocks, root, partition_by=["lang"])
    out = scratch_path(spark, "j4-out")
    model, ev, matrix, missing = jobs.language_id(spark, f"{root}/*/*", exclude=["es"], out_dir=out, lang_level=1)
    assert set(model.labels) == {"de", "en", "fr"}
    acc = ev.accuracy.first()
    assert acc.n_rows > 0 and acc.accuracy > 0.8
    # one row in, one row out: repeated articles are held-out rows of their own
    held = jobs.hash_bucket("_key") >= 80
    rows = jobs.src.language_corpus(spark, f"{root}/*/*", ["es"], 1).withColumn("_key", F.xxhash64("fullText", "lang"))
    assert acc.n_rows == rows.filter(held).count() > rows.filter(held).distinct().count()
    assert matrix.count() == 3 and missing.count() == 0
    csv = spark.read.option("header", True).csv(f"{out}/prediction_matrix")
    assert csv.count() == 3
    # J5 + scoring with the saved model
    back = jobs.nb.LongNaiveBayesModel.load(spark, f"{out}/model")
    scored = jobs.score_crawl(back, jobs.crawl_documents(spark, write_wet(spark, sf)))
    assert scored.count() == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_article_classes_job(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet").filter(F.col("lang").isin("en", "fr"))
    root = scratch_path(spark, "articles")
    sink.write_folders(d.select(article_file().alias("value"), "lang"), root, "lang")
    model, ev = jobs.line_classes(spark, {f"{root}/lang=en": ("article", 0.0),
                                          f"{root}/lang=fr": ("article", 1.0)}, one_vs_rest=True)
    acc = ev.accuracy.first()
    # every article's title line is its source name ("srcN"), present in both
    # classes, so about one line in ten cannot be told apart
    assert acc.n_rows > 0 and acc.accuracy > 0.75
    assert ev.confusion.agg(F.sum("n")).first()[0] == acc.n_rows


def test_repeated_records_are_scored_alone(spark):
    rows = [("de", ["ja", "und"]), ("en", ["yes", "and"]), ("en", ["and"])]
    model = jobs.nb.fit(spark.createDataFrame(rows, "lang string, terms array<string>"), "lang", "terms")
    docs = spark.createDataFrame([("u", "yes and"), ("u", "yes and"), ("v", "ja"), ("v", "unknown"), ("w", "")], "URI string, text string")
    got = sorted(map(tuple, jobs.score_crawl(model, docs).collect()))
    alone = sorted(tuple(r) for row in docs.collect() for r in jobs.score_crawl(model, spark.createDataFrame([row], docs.schema)).collect())
    assert got == alone and len(got) == 5


def test_many_labels(spark):
    """200 labels: the work grows with non-zero pairs and no score is lost."""
    rows = [(f"l{i:03d}", [f"w{i}", "common", f"x{i % 7}"]) for i in range(200)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id long, lang string, terms array<string>")
    model = jobs.nb.fit(df, "lang", "terms")
    got = {r["id"]: r["predicted_label"] for r in jobs.nb.predict(model, df, "id", "terms").collect()}
    assert got == {i: r[0] for i, r in enumerate(rows)}
