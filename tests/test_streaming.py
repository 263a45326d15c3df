"""The streaming crawl scorer gives the batch result."""

import os

from kiln.operators import naive_bayes as nb
from kiln.plans.common import doc_tokens
from kiln.plans.ingest import write_wet
from kiln.session import scratch_path
from kiln.sources import crawl
from kiln.streaming.crawl import score_batch, start_scoring


def test_stream_equals_batch(spark, sf):
    model = nb.fit(doc_tokens(spark, sf).filter("is_train"), "lang", "tokens")
    wet = write_wet(spark, sf)
    out = scratch_path(spark, "stream-out")
    q = start_scoring(spark, model, wet, out, scratch_path(spark, "stream-ckpt"), trigger_once=True)
    q.awaitTermination(300)
    streamed = {r.URI: r.prediction for r in spark.read.parquet(out).collect()}
    batch = {r.URI: r.prediction for r in score_batch(model, crawl.wet_documents(spark, wet)).collect()}
    assert streamed == batch and len(batch) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_restarted_stream_goes_on(spark, sf):
    """A stream started again with its checkpoint keeps earlier results, although
    their input is gone, and reads only new files; J4 features as in batch."""
    from pyspark.sql import functions as F

    from kiln.functions.text import clean_article, tokenize
    from kiln.plans import jobs
    d = spark.read.parquet(f"{sf}/documents.parquet")
    terms = d.select("doc_id", "lang", jobs.language_features(tokenize(clean_article("text"))).alias("terms"))
    model = nb.fit(terms, "lang", "terms")
    model.features = "language"
    folder, out, ckpt = (scratch_path(spark, n) for n in ("stream-in", "stream-out", "stream-ckpt"))

    def put(rows):
        rec = rows.select(crawl.wet_record(F.concat(F.lit("http://x/"), F.col("doc_id") % 3), "text", "doc_id").alias("value"))
        rec.coalesce(1).write.mode("append").text(folder)

    put(d.limit(5))
    start_scoring(spark, model, folder, out, ckpt, trigger_once=True).awaitTermination(300)
    first = sorted(map(tuple, spark.read.parquet(out).select("URI", "prediction").collect()))
    assert first == sorted(map(tuple, jobs.score_crawl(model, crawl.wet_documents(spark, folder)).select("URI", "predicted_label").collect()))
    assert len(first) == 5            # URIs repeat, records do not merge
    local = folder.removeprefix("file:")
    for name in os.listdir(local):
        os.remove(os.path.join(local, name))
    put(d.where("doc_id >= 100").limit(4))
    start_scoring(spark, model, folder, out, ckpt, trigger_once=True).awaitTermination(300)
    assert spark.read.parquet(out).count() == 9
