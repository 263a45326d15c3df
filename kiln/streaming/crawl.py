"""Streaming form of the crawl job: WET files arriving in a folder are parsed
(SRC-5) and scored with a fitted long-form language model (MOD-7) as they come.

The reference loads and scores crawl files in batch; this is the same
operator chain over ``readStream``.  Scoring needs a join with the weight
table and a per-document aggregation, so every micro-batch runs the batch
plan through ``foreachBatch`` and writes its own ``batch_id=`` folder of a
parquet table (idempotent on replay); the checkpoint folder, which the caller
names, makes a restarted job resume where it stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kiln.operators import naive_bayes as nb
from kiln.plans import jobs
from kiln.sources import crawl


def crawl_stream(spark: SparkSession, input_dir: str, max_files_per_trigger: int = 16) -> DataFrame:
    """Streaming (URI, text) of the WET files that appear in ``input_dir``."""
    raw = (spark.readStream.option("lineSep", crawl.RECORD_SEP)
           .option("maxFilesPerTrigger", max_files_per_trigger).text(input_dir))
    return crawl.documents_of(crawl.parse_records(raw))


def score_batch(model: nb.LongNaiveBayesModel, docs: DataFrame) -> DataFrame:
    """MOD-7 on one batch of crawl documents: predicted language per record, by
    the batch job's own scoring."""
    return jobs.score_crawl(model, docs).withColumnRenamed("predicted_label", "prediction")


def start_scoring(spark: SparkSession, model: nb.LongNaiveBayesModel, input_dir: str, output_dir: str,
                  checkpoint: str, trigger_once: bool = False):
    """Start the streaming job; returns the ``StreamingQuery``.  ``checkpoint`` is
    a lasting folder of the shared file system: a job started again with the same
    one goes on after the last finished micro-batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        # one folder per micro-batch, overwritten: a batch replayed after a
        # failure replaces its own output instead of appending it twice
        score_batch(model, batch).write.mode("overwrite").parquet(f"{output_dir}/batch_id={batch_id}")

    w = crawl_stream(spark, input_dir).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
