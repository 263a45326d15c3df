"""Sinks (SNK-1..10).  All writes are Spark writes of whole DataFrames,
overwrite mode, so a re-run (or a retried task) gives the same files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.session import scratch_path


def doc_block(id_col: str, title_col: str, text_col: str, url_base: str | None = None,
              revid_col: str | None = None) -> Column:
    """SNK-3/SNK-9 record: ``<doc id url title>``, title, blank line, text,
    ``</doc>``.  Without ``url_base`` the header has no url (citation blocks)."""
    i = F.col(id_col).cast("string")
    parts = [F.lit('<doc id="'), i, F.lit('"')]
    if revid_col:
        parts += [F.lit(' revid="'), F.col(revid_col).cast("string"), F.lit('"')]
    if url_base is not None:
        parts += [F.lit(' url="'), page_url(url_base, id_col), F.lit('"')]
    parts += [F.lit(' title="'), F.col(title_col), F.lit('">\n'), F.col(title_col),
              F.lit("\n\n"), F.col(text_col), F.lit("\n</doc>")]
    return F.concat(*parts)


def page_url(base: str, id_col: str) -> Column:
    """PRJ-3: ``base?curid=id``."""
    return F.concat(F.lit(base), F.lit("?curid="), F.col(id_col).cast("string"))


def write_doc_blocks(df: DataFrame, path: str, block_col: str = "block",
                     partition_by: list | None = None, compression: str | None = None) -> None:
    """SNK-3: one text record per block (the record ends with a newline)."""
    w = df.select(block_col, *(partition_by or [])).write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def running_total(df: DataFrame, order: str | list[str], size_col: str, parts: int | None = None, out_col: str = "cum_bytes") -> DataFrame:
    """WIN-3: inclusive running sum of ``size_col`` in the order of the columns
    ``order`` (of any type; sparse, hashed and repeated keys alike), in two levels:

    1. the rows are cut into ranges of the order (sampled bounds) and written once
       to the shared folder, so that the cut stays the same however often it is read;
    2. a window inside each range, plus the sums of the ranges before it: the only
       window over everything has one row per range.

    Rows with equal keys are told apart by a hash of their other columns and at last
    by their place in the input, so a key that many rows share is cut as well."""
    order = [order] if isinstance(order, str) else list(order)
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [c for c in df.columns if c not in order]
    keys = [*order, "_tie", "_place"]
    path = scratch_path(spark, "ranges")
    (df.withColumn("_tie", F.xxhash64(*others) if others else F.lit(0)).withColumn("_place", F.monotonically_increasing_id())
     .repartitionByRange(n, *keys).withColumn("_range", F.spark_partition_id()).write.parquet(path))
    cut = spark.read.parquet(path)
    sums = cut.groupBy("_range").agg(F.sum(size_col).alias("_sum"))
    before = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = F.sum(size_col).over(Window.partitionBy("_range").orderBy(*keys).rowsBetween(Window.unboundedPreceding, 0))
    return (cut.withColumn("_inside", inside).join(F.broadcast(before), "_range")
            .withColumn(out_col, F.col("_before") + F.col("_inside")).drop("_range", "_inside", "_before", "_tie", "_place"))


def file_numbers(df: DataFrame, cum_col: str, size_col: str, cap_bytes: int = 1 << 20,
                 per_dir: int = 100) -> DataFrame:
    """SNK-4 naming: file number = floor(bytes before the record / cap) (a file
    may exceed the cap by one record, Q18), 100 files per directory, directories
    ``AA``, ``AB``, … ``ZZ``, then ``BAA`` and so on with as many letters as are
    needed, files ``wiki_00`` … ``wiki_99``.  A cap under 200 KiB is refused."""
    cap = int(cap_bytes)
    if cap < 200 * 1024:
        raise ValueError("a file takes at least 200 KiB")
    start = F.col(cum_col) - F.col(size_col)
    no = F.floor(start / cap)
    d = F.floor(no / per_dir).cast("bigint")
    # base 26 with at least two digits, A = 0; 14 digits hold every bigint
    digit = lambda k: F.substr(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (F.floor(d / F.lit(26 ** k)) % 26 + 1).cast("int"), F.lit(1))
    more = [F.when(d >= 26 ** k, digit(k)).otherwise("") for k in range(13, 1, -1)]
    letters = F.concat(*more, digit(1), digit(0))
    return df.withColumn("file_no", no.cast("bigint")).withColumn("dir", letters) \
             .withColumn("file", F.format_string("wiki_%02d", (no % per_dir).cast("int")))


def write_packed(df: DataFrame, path: str, block_col: str = "block", order_col: str | None = None,
                 compression: str | None = None) -> None:
    """SNK-4 write: one output folder per (dir, file) holding that file's
    records in order.  Range partitioning on the file number keeps every file
    in one task (equal keys share a range) and balances tasks by size."""
    out = df.repartitionByRange("file_no")
    out = out.sortWithinPartitions("file_no", order_col) if order_col else out
    w = out.select(block_col, "dir", "file").write.mode("overwrite").partitionBy("dir", "file")
    if compression:
        w = w.option("compression", compression)
    w.text(path)


def write_folders(df: DataFrame, path: str, folder_col: str, text_col: str = "value") -> None:
    """SNK-5/SNK-6: lines written grouped by folder (or class); overwrite keeps
    re-runs idempotent (the reference appends)."""
    df.select(text_col, folder_col).write.mode("overwrite").partitionBy(folder_col).text(path)


def write_list(df: DataFrame, path: str, col: str) -> None:
    """SNK-8: one value per line."""
    df.select(col).write.mode("overwrite").text(path)


def write_matrix_csv(matrix: DataFrame, path: str, corner: str = "v label / prediction ->") -> None:
    """SNK-2: label x label matrix as CSV with a corner label in the header.
    The matrix has K rows (labels), so one output file is fine."""
    m = matrix.withColumnRenamed("label", corner)
    m.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def preview(df: DataFrame, n: int = 20) -> None:
    """SNK-10: console preview."""
    df.show(n, truncate=80)
