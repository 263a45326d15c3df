"""Selection: reproducible splits (SMP), top-k per group (TOP/WIN), set
operations (SET), semi/anti joins (JOIN-3/5) and size selections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def hash_bucket(key, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets): first 32 bits of md5(key).  The same in
    every engine and every run, independent of partitioning."""
    k = F.col(key) if isinstance(key, str) else key
    h = F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % buckets


def hash_split(df: DataFrame, key: str, train_percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """SMP-1 (stable form): (train, test) by hash bucket; disjoint and complete."""
    b = hash_bucket(key)
    return df.filter(b < train_percent), df.filter(b >= train_percent)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = 42) -> list[DataFrame]:
    """SMP-1 (as in the reference, but seeded)."""
    return df.randomSplit(list(weights), seed)


def stratified_split(df: DataFrame, key: str, stratum: str, train_fraction: float = 0.8,
                     out_col: str = "part", buckets: int | None = None) -> DataFrame:
    """SMP-2 exact form: inside every stratum, rows ordered by (md5(key), key)
    are ``train`` while ``percent_rank < train_fraction``.

    The rank inside a stratum is computed in two levels, so a stratum holding
    most of the rows is never one task: rows fall into ``buckets`` md5 ranges (by
    default one for every 50,000 rows, 1,024 at least; they do not change the result);
    a small (stratum, bucket) count table gives every bucket its offset (prefix
    sum); ``row_number`` runs inside a (stratum, bucket) group only."""
    buckets = buckets or max(1024, df.count() // 50_000)
    h = F.md5(F.col(key).cast("string"))
    d = df.withColumn("_h", h).withColumn(
        "_b", (F.conv(F.substring("_h", 1, 8), 16, 10).cast("bigint") * buckets / (1 << 32)).cast("int"))
    counts = d.groupBy(stratum, "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_off = Window.partitionBy(stratum).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(stratum, "_b", F.coalesce(F.sum("_c").over(w_off), F.lit(0)).alias("_off"),
                            F.sum("_c").over(Window.partitionBy(stratum)).alias("_n"))
    local = F.row_number().over(Window.partitionBy(stratum, "_b").orderBy("_h", F.col(key)))
    ranked = d.withColumn("_r", local).join(offsets, [stratum, "_b"])
    pr = F.when(F.col("_n") > 1, (F.col("_off") + F.col("_r") - 1) / (F.col("_n") - 1)).otherwise(F.lit(0.0))
    return ranked.withColumn(out_col, F.when(pr < train_fraction, "train").otherwise("test")) \
        .drop("_h", "_b", "_r", "_off", "_n")


def first_n_per_group(df: DataFrame, group: str, order, n: int, rank_col: str = "rank") -> DataFrame:
    """TOP-1/TOP-2: first n rows of every group in the given order.
    ``row_number() <= n`` is planned as a WindowGroupLimit, so each task keeps
    at most n rows per group before the shuffle."""
    order_cols = [order] if isinstance(order, (str, Column)) else list(order)
    w = Window.partitionBy(group).orderBy(*order_cols)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= n)


def first_n(df: DataFrame, order, n: int) -> DataFrame:
    """TOP-3: first n rows in the given order; n <= 0 means all rows."""
    order_cols = [order] if isinstance(order, (str, Column)) else list(order)
    out = df.orderBy(*order_cols)
    return out.limit(n) if n > 0 else out


def union_all(frames: list[DataFrame], schema: StructType | None = None, spark=None) -> DataFrame:
    """SET-1/SET-2/SRC-16: union by name; with no frames the empty table of the
    declared schema is the neutral element."""
    if not frames:
        return spark.createDataFrame([], schema)
    return reduce(lambda a, b: a.unionByName(b), frames)


def semi_join(df: DataFrame, selection: DataFrame, on) -> DataFrame:
    """JOIN-5: rows whose key is in the selection (no duplication)."""
    return df.join(selection, on, "left_semi")


def anti_join(df: DataFrame, done: DataFrame, on) -> DataFrame:
    """JOIN-3/FLT-15: rows without a match (work not yet done)."""
    return df.join(done, on, "left_anti")


def keep_rows(df: DataFrame, predicate) -> DataFrame:
    """``df.filter(predicate)`` for predicates on expensive computed columns.

    A plain filter is pushed below the projection that computes the column and
    the whole expression is then evaluated twice (filter and projection).  Here
    the predicate is evaluated inside a generator over the row, which the
    optimizer does not push through, so every column is computed once."""
    cols = df.columns
    kept = F.filter(F.array(F.struct(*cols)), lambda r: predicate(r))
    return (df.select(F.explode_outer(kept).alias("_row")).filter(F.col("_row").isNotNull())
            .select(*[F.col("_row")[c].alias(c) for c in cols]))
