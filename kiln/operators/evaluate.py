"""EVA-1/EVA-2 and AGG-1..7: everything is derived from one grouped count
``(label, prediction) -> n``, so the predictions are scanned once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def confusion_counts(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    """AGG-3/AGG-7: count per (actual, predicted); rows = actual labels."""
    return pred.groupBy(F.col(label_col).alias("label"),
                        F.col(prediction_col).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))


def accuracy(confusion: DataFrame) -> DataFrame:
    """AGG-6/AGG-1: accuracy, test error and row count in one aggregate."""
    return confusion.agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("n_correct"),
    ).select("n_rows", "n_correct",
             (F.col("n_correct") / F.col("n_rows")).alias("accuracy"),
             (1 - F.col("n_correct") / F.col("n_rows")).alias("test_error"))


def per_label(confusion: DataFrame) -> DataFrame:
    """AGG-2/AGG-4: rows per true label, correct ones and recall."""
    return confusion.groupBy("label").agg(
        F.sum("n").alias("n_rows"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("n_correct"),
    ).withColumn("recall", F.col("n_correct") / F.col("n_rows"))


def confusion_matrix(confusion: DataFrame, labels: list, fill: int = 0, spark=None) -> DataFrame:
    """AGG-5/SNK-2 shape: one row per actual label, one column per predicted
    label (given order), zero filled.  ``labels`` is the label table (K values),
    so the pivot needs no extra job to find its columns; rows come from the same
    label list, so rows and columns always agree (Q12)."""
    spark = spark or confusion.sparkSession
    wide = confusion.groupBy("label").pivot("prediction", labels).agg(F.sum("n"))
    rows = spark.createDataFrame([(x,) for x in labels], "label string")   # K rows
    return rows.join(wide, "label", "left").na.fill(fill)


def missing_labels(expected: DataFrame, seen: DataFrame, col: str) -> DataFrame:
    """SET-3: symmetric difference of two label sets, with a side column."""
    e = expected.select(F.col(col).alias("label")).distinct()
    s = seen.select(F.col(col).alias("label")).distinct()
    return (e.exceptAll(s).withColumn("side", F.lit("expected_only"))
            .unionByName(s.exceptAll(e).withColumn("side", F.lit("seen_only"))))
