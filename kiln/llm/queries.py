"""The registered queries: each applies its operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.llm import (
    collocations,
    decontaminate,
    imatch,
    licenses,
    mixing,
    oracles,
    quality,
    resample,
    secrets,
    simhash,
    suffix,
    toxicity,
    training_order,
    warc,
)
from kiln.session import read_table, scratch_path


def op1_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = imatch.fingerprints_with_edits(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_chars", "edited_sha256", imatch.text_of("own").alias("fingerprint"),
                        imatch.text_of("edited").alias("edited_fingerprint"), "near_edited", "near_next")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint("fp").alias("fingerprint"), "component_id")


def op3_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "warc")
    warc.write_bundles(read_table(spark, sf_dir, "pages"), folder)
    return warc.read_bundles(spark, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(read_table(spark, sf_dir, "documents"))


def op5_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.without_repeats(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op6_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.write_shards(read_table(spark, sf_dir, "documents"), scratch_path(spark, "training-order"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(read_table(spark, sf_dir, "documents"))
    return found.withColumn("dice", F.round("dice", 6))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    found = toxicity.severity(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))
    return found.withColumn("toxic", (F.col("p_toxic") >= toxicity.REJECT).cast("int"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_novel")


def op11_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_imatch, op2_simhash_near_dedup, op3_warc_bundles, op4_source_mix, op5_repeated_passages, op6_training_order, op7_license_scan,
    op8_toxicity, op9_decontamination, op10_secret_scan, op11_quality_ranking, op12_importance_resampling, op13_collocations)}
ORACLE: dict[str, str] = {"op12_importance_resampling": oracles.RESAMPLE, "op13_collocations": oracles.COLLOCATIONS}
