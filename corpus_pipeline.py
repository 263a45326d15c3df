"""The corpus pipeline: documents to training shards in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written
as Parquet and read again as the next stage's ``docs``; all but the last return
the columns they got.

1. ``toxicity``: texts that the severity model rejects go.
2. ``near_duplicates``: of each SimHash component one row stays, the one with the
   smallest id.
3. ``decontamination``: documents that contain a benchmark passage go.
4. ``mixing``: all rows stay, in files that follow the Pfair mix of the sources.
5. ``training_order``: token-id shards, their sequences cut from the documents in
   the order of stage 4's files; returns their index, one row per sequence.

Rows without a ``doc_id`` pass stages 1 to 4 under their text alone: they are
scored and searched like others, and stay in stage 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import decontaminate, mixing, simhash, toxicity, training_order
from kiln.llm.common import fresh, join_unique, materialize
from kiln.session import read_table, scratch_path

ORACLE_SQL = None     # fitted models, SimHash and shards have no SQL form


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.keep_clean(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows, not ids, are compared and go: texts that share an id are apart unless
    they are near copies.  Of a component the row with the smallest id stays (the
    first of the file where rows share it).  ``docs`` is stored, so that a row has the
    same number in both scans; its id is checked where it goes."""
    row, own, old = fresh(docs, "_row"), fresh(docs, "_gone"), fresh(docs, "_gone_id")
    numbered = docs.withColumn(row, F.monotonically_increasing_id())
    texts = numbered.where("doc_id is not null").select(F.col(row).alias("doc_id"), "text")
    ids = numbered.where("doc_id is not null").select(F.col(row).alias("row"), F.col("doc_id").cast("long").alias("id"))
    found = materialize(simhash.near_duplicates(texts).select(F.col("doc_id").alias("row"), "component_id").join(ids, "row"), "near-duplicates")
    kept = (found.groupBy("component_id").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("id", "row")).alias("kept"))
            .where("n > 1").select("component_id", F.col("kept.row").alias("kept")))
    gone = join_unique(found, kept, ["component_id"]).where("row <> kept").select(F.col("row").alias(own), F.col("id").alias(old))
    stays = (F.when(F.col(own).isNull(), True).when(F.col("doc_id").cast("long") == F.col(old), False)
             .otherwise(F.raise_error(F.lit("the documents were not listed in the same order twice")).cast("boolean")))
    return numbered.join(gone, F.col(row) == F.col(own), "left").where(stays).drop(row, own, old)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return training_order.write_shards(docs, scratch_path(spark, "training-order"), as_listed=True)


STAGES = [("toxicity", clean_language), ("near_duplicates", one_of_each), ("decontamination", without_benchmark),
          ("mixing", mixed_sources), ("training_order", shards)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each one's result written to the shared folder before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
