"""Shared inputs of the registered queries: the driver tables turned into the
reference's corpus shapes by Spark itself."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions.text import strip_punctuation, tokenize
from kiln.operators.features import by_document, spread
from kiln.operators.select import hash_bucket
from kiln.session import read_table

TRAIN_PERCENT = 80


def documents(spark: SparkSession, sf_dir: str, spread_scan: bool = True) -> DataFrame:
    """The documents table; a scan with fewer splits than cores is spread on
    ``doc_id`` (see :func:`kiln.operators.features.spread`)."""
    d = read_table(spark, sf_dir, "documents")
    return spread(d, "doc_id") if spread_scan else d


def doc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents -> FEA-1 strip -> FEA-3 tokens, with the stable split column.
    Hashed on ``doc_id`` first: the regex work runs on all cores and every
    later per-document aggregation is local (pass ``partitioned=True``)."""
    d = by_document(documents(spark, sf_dir, spread_scan=False), "doc_id", "text")
    return d.select("doc_id", "lang", "source",
                    tokenize(strip_punctuation("text")).alias("tokens"),
                    (hash_bucket("doc_id") < TRAIN_PERCENT).alias("is_train"))


def r6(c):
    return F.round(c, 6)
