"""Session and scratch-location helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job relies on: adaptive execution (runtime re-plan, skew-join
# splitting, partition coalescing) and no web UI.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "kiln",
              shuffle_partitions: int | None = None,
              conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the defaults above."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the cluster (a shared file system).  Only
    when it is unset (local tests) a private temp folder is created and set.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: only the configuration is visible
        sc = None
    d = sc.getCheckpointDir() if sc is not None else None
    if d:
        return d
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = tempfile.mkdtemp(prefix="kiln-ckpt-")
        if sc is None:
            spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None:
        sc.setCheckpointDir(d)
        return sc.getCheckpointDir() or d
    return d


# Rows per Arrow batch handed to Python: the default of 10,000 pages, several copies of
# each, fills a worker.
ARROW_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch length to :data:`ARROW_ROWS` rows."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if now <= 0 or now > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder below the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/kiln-scratch/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))
