"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.dataset as ds
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.session import scratch_path

# Rows per Arrow batch handed to Python: texts are long, so the default of
# 10,000 rows could fill a worker.
ARROW_ROWS = 1000
# Scan partitions whose side rows share a folder.
SCAN_GROUP = 64


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch length to :data:`ARROW_ROWS` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key)) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the lineage is cut, and a lost executor loses nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_by_scan(df: DataFrame, order: list[str], name: str) -> str:
    """Write rows that belong to partitions of a scan (column ``_scan``), in
    ``order``, to a folder of the shared file system; a later pass over the same
    scan reads those of its own partition with :func:`read_by_scan`, so the
    scanned texts need not move."""
    path = scratch_path(df.sparkSession, name)
    (df.withColumn("_group", F.floor(F.col("_scan") / SCAN_GROUP).cast("int")).repartition("_scan")
     .sortWithinPartitions("_scan", *order).write.partitionBy("_group").parquet(path))
    return path


def read_by_scan(path: str, scan: int, schema: pa.Schema, order: list[str]) -> pa.Table:
    """Inside a task: the side rows of scan partition ``scan``, in ``order``."""
    store, root = fs.FileSystem.from_uri(path)
    folder = f"{root}/_group={scan // SCAN_GROUP}"
    if store.get_file_info(folder).type != fs.FileType.Directory:
        return schema.empty_table()
    table = ds.dataset(folder, filesystem=store, format="parquet").to_table(columns=schema.names, filter=ds.field("_scan") == scan)
    return table.cast(schema).sort_by([(c, "ascending") for c in order])


def range_parts(df: DataFrame, order: list, parts: int | None = None) -> DataFrame:
    """``df`` cut into key ranges: adds ``_part`` (0, 1, ... in key order) and is
    written once, so that the cut is the same however often it is read.  Rows
    with equal keys share a part; give a tie-breaker where a key may be hot."""
    n = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return materialize(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranges")


def running_offsets(df: DataFrame, order: list, value, out: str, parts: int | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over all rows before this one in the
    total ``order``.  Two levels: a window inside each key range, plus the sums
    of the ranges before it (one row per range, so the single-task window over
    them is as long as the number of ranges, never the number of rows)."""
    cut = range_parts(df.withColumn("_value", value), order, parts)
    sums = cut.groupBy("_part").agg(F.sum("_value").alias("_sum"))
    before = sums.select("_part", (F.sum("_sum").over(Window.orderBy("_part")) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (cut.withColumn("_inside", F.sum("_value").over(inside) - F.col("_value"))
            .join(before, "_part")
            .withColumn(out, F.col("_before") + F.col("_inside"))
            .drop("_part", "_value", "_inside", "_before"))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an edge list ``(a, b)`` of longs: rows
    ``(node, component)`` for every node that is not itself its component's
    smallest id.  Alternating large-star and small-star steps; each round is
    written to the shared folder, and the driver sees a count and a checksum
    only.  A hub's rows are pre-aggregated (``min``) before they meet."""
    def mark(df):
        row = df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        return row["n"], row["x"]

    now = materialize(edges.where(F.col("a") != F.col("b"))
                      .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    state = mark(now)
    while state[0]:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = both.groupBy("x").agg(F.min("y").alias("m"))
        large = (both.join(least, "x").where(F.col("y") > F.col("x"))
                 .select(F.col("y").alias("u"), F.least("x", "m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u")
                 .select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                         F.col("m").alias("v")).distinct())
        now = materialize(small, "edges")
        after = mark(now)
        if after == state:
            break
        state = after
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))


def slices(data: bytes, size: int, separators: bytes) -> Iterator[bytes]:
    """``data`` in parts of about ``size`` bytes, each but the last ending with
    one of the one-byte ``separators``; a longer run without one stays whole."""
    at = 0
    while at < len(data):
        end = len(data)
        if end - at > size:
            cut = max(data.rfind(s, at, at + size) for s in (separators[i:i + 1] for i in range(len(separators))))
            if cut < 0:
                after = [p for i in range(len(separators)) if (p := data.find(separators[i:i + 1], at + size)) >= 0]
                cut = min(after, default=len(data) - 1)
            end = cut + 1
        yield data[at:end]
        at = end


# Keys with over one in so many of a join's rows are hot: fewer keys than that.
HOT_SHARE = 4096


def join_unique(left: DataFrame, right: DataFrame, on: list[str]) -> DataFrame:
    """Inner join of ``left`` (a stored table, read twice) with ``right``, which
    has one row per key.  A key that more than one in :data:`HOT_SHARE` of left's
    rows have would make its task long: these keys, fewer than ``HOT_SHARE``, are
    joined by broadcast, all others by a shuffle in which no key has more rows."""
    per_key = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(per_key.where(F.col("_n") > left.count() / HOT_SHARE + 1000).select(*on), "hot-keys")
    if hot.isEmpty():
        return left.join(right, on)
    hot_rows = materialize(right.join(F.broadcast(hot), on), "hot-rows")
    return (left.join(F.broadcast(hot_rows), on)
            .unionByName(left.join(F.broadcast(hot), on, "left_anti").join(right, on)))
