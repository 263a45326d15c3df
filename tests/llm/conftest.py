import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:  # columns whose names the operators use themselves
            for name in ("fp", "component_id", "h", "code", "_part", "_row", "_mix", "tie", "_tie", "slot", "position", "severity", "spans", "key"):
                df = df.withColumn(name, df["doc_id"].cast("string"))
        return df
    return make


@pytest.fixture(scope="session")
def stored(spark, docs_of, tmp_path_factory):
    """The same as stored files, in several partitions."""
    def make(rows, parts=3, extra=False):
        path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
        docs_of(rows, extra).repartition(parts).write.parquet(path)
        return spark.read.parquet(path)
    return make
