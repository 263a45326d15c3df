"""Long-form text features: term tables, vocabulary, document frequency, TF-IDF,
label index.

A sparse vector is kept as rows ``(doc, term, tf)``: it grows with the non-zero
entries only and every step is a plain aggregation or join that Spark
partitions, pre-aggregates map-side and spills.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.functions.text import explode_terms, ngrams
from kiln.operators.packed import term_sums


def term_occurrences(df: DataFrame, id_col: str, tokens_col: str,
                     keep=(), term_col: str = "term") -> DataFrame:
    """One row per token occurrence (no shuffle: a projection + explode)."""
    return (df.select(id_col, *keep, explode_terms(tokens_col).alias(term_col))
            .filter(F.col(term_col).isNotNull()))


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread a scan with fewer partitions than the cluster has cores (one
    small file, one row group) before CPU-heavy row work; a scan of many
    splits is left alone, so this costs nothing at scale."""
    try:
        target = df.sparkSession.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= target:
            return df
    except Exception:  # noqa: BLE001 - no RDD view (e.g. a remote session): leave the plan as is
        return df
    return df.repartition(target, key) if key else df.repartition(target)


# A task of per-document term counts gets about so many rows, or bytes of text.
TASK_ROWS = 2048
TASK_BYTES = 4 << 20


def by_document(df: DataFrame, id_col: str, text_col: str | None = None) -> DataFrame:
    """Hash-partition the documents on their id.  Every later per-document
    aggregation (doc, term) then runs inside the partition with no exchange:
    the text rows are shuffled instead of the several times larger
    (doc, term) pairs.

    The number of partitions follows from the number of rows (and of bytes in
    ``text_col``), counted first: the terms of a task are held in hash tables, many
    times its text, so their size must not grow with the corpus.  Left to itself,
    adaptive execution joins partitions up to 64 MB of compressed text, and the
    tables spill."""
    if df.isStreaming:
        return df.repartition(id_col)
    size = F.sum(F.octet_length(text_col)) if text_col else F.lit(0)
    n, n_bytes = df.agg(F.count(F.lit(1)), F.coalesce(size, F.lit(0))).first()
    try:
        least = df.sparkSession.sparkContext.defaultParallelism
    except Exception:  # noqa: BLE001 - remote session: only the configuration is visible
        least = 1
    return df.repartition(max(least, -(-n // TASK_ROWS), -(-n_bytes // TASK_BYTES)), id_col)


def term_frequencies(df: DataFrame, id_col: str, tokens_col: str,
                     keep=(), term_col: str = "term", partitioned: bool = False) -> DataFrame:
    """(doc, term, tf), counted inside each document's partition
    (``partitioned=True``: the input is already hashed on the id)."""
    occ = term_occurrences(df if partitioned else by_document(df, id_col), id_col, tokens_col, keep, term_col)
    return occ.groupBy(id_col, *keep, term_col).agg(F.count(F.lit(1)).alias("tf"))


def ngram_space(df: DataFrame, tokens_col: str, orders=(3, 4),
                out_col: str = "grams") -> DataFrame:
    """FEA-8 in long form: one array of all n-grams of the given orders, each
    tagged with its order so equal strings of different orders stay apart
    (like separate vector blocks of ``VectorAssembler``)."""
    def tag(n):
        return lambda g: F.concat(F.lit(f"{n}\u0001"), g)

    parts = [F.transform(ngrams(tokens_col, n), tag(n)) for n in orders]
    return df.withColumn(out_col, F.concat(*parts) if len(parts) > 1 else parts[0])


def tag_terms(cols) -> F.Column:
    """One array of the terms of several array columns, each term tagged with its
    column's number, so equal strings of different columns stay apart."""
    def tag(n):
        return lambda t: F.concat(F.lit(f"{n}\u0001"), t)

    return F.concat(*[F.transform(c, tag(n)) for n, c in enumerate(cols)])


def term_statistics(tf: DataFrame, id_col: str, term_col: str = "term") -> DataFrame:
    """FEA-6/AGG-11/AGG-10: per term total count and document frequency.  The terms are
    shuffled in blocks of many (:mod:`kiln.operators.packed`)."""
    rows = tf.select(F.col(term_col).alias("term"), F.col("tf").alias("cnt"),
                     F.when(F.col(id_col).isNotNull(), 1).otherwise(0).cast("long").alias("df"))
    return term_sums(rows, ["cnt", "df"]).withColumnRenamed("term", term_col)


def vocabulary(stats: DataFrame, size: int = 1 << 18, min_df: int = 1,
               term_col: str = "term") -> DataFrame:
    """TOP-4: most frequent terms, at most ``size``; tie order made explicit
    (count desc, term asc).  Spark plans this as a distributed top-k
    (TakeOrderedAndProject); the result is bounded by ``size``."""
    kept = stats.filter(F.col("df") >= min_df)
    top = kept.orderBy(F.desc("cnt"), F.asc(term_col)).limit(size)
    w = Window.orderBy(F.desc("cnt"), F.asc(term_col))
    # the window runs on the bounded top-k only
    return top.withColumn("idx", F.row_number().over(w) - 1)


def idf_table(tf: DataFrame, id_col: str, n_docs=None, term_col: str = "term") -> DataFrame:
    """AGG-10/FEA-7: ``idf = ln((N+1)/(df+1))`` (the ``ml.feature.IDF`` formula).

    N is a scalar subquery (``DataFrame.scalar()``), evaluated once; no join."""
    dfreq = tf.groupBy(term_col).agg(F.count(id_col).alias("df"))
    if n_docs is None:
        n_docs = tf.select(F.countDistinct(id_col)).scalar()
    return dfreq.withColumn("idf", F.log((F.lit(n_docs) + 1) / (F.col("df") + 1)))


def tfidf(tf: DataFrame, idf: DataFrame, term_col: str = "term") -> DataFrame:
    """FEA-7 applied: ``tf * idf`` per (doc, term)."""
    return tf.join(idf.select(term_col, "idf"), term_col).withColumn(
        "tfidf", F.col("tf") * F.col("idf"))


def label_index(df: DataFrame, label_col: str) -> DataFrame:
    """AGG-13/WIN-4/FEA-9: ``StringIndexer`` order (most frequent = 0, ties
    alphabetical).  The window runs on the aggregated label table, whose size
    is the number of labels."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy(F.desc("n"), F.asc(label_col))
    return counts.withColumn("idx", (F.row_number().over(w) - 1).cast("double"))
