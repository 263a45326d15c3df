"""Text functions against MLlib and Python (FEA-1..4, FLT-1/2, Q4-Q5)."""

import re

import pytest
from pyspark.ml.feature import NGram, Tokenizer
from pyspark.sql import functions as F

from kiln.functions import text as T

SAMPLES = ["", " ", "   ", "a", " a", "a ", "a  b", "A\tB\nC", "Hello, World!", "x  y  ", "≈57.7 años (n=18)",
           "naïve café — «quote»", "é combining", "snake_case_word", "tab\x1cfile\x1fsep", "İstanbul"]


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([(i, s) for i, s in enumerate(SAMPLES)], "id int, t string")


def test_tokenizer_equals_mllib(df):
    ours = {r.id: r.w for r in df.select("id", T.tokenize("t").alias("w")).collect()}
    ml = {r.id: r.words for r in Tokenizer(inputCol="t", outputCol="words").transform(df).collect()}
    assert ours == ml


@pytest.mark.parametrize("n", [2, 3, 4])
def test_ngrams_equal_mllib(df, n):
    w = df.select("id", T.tokenize("t").alias("w"))
    ours = {r.id: r.g for r in w.select("id", T.ngrams("w", n).alias("g")).collect()}
    ml = {r.id: r.g for r in NGram(n=n, inputCol="w", outputCol="g").transform(w).collect()}
    assert ours == ml


def test_strip_equals_python(df):
    py = re.compile(r"[^\w\s]", re.UNICODE)
    for r in df.select("t", T.strip_punctuation("t").alias("s")).collect():
        assert r.s == py.sub("", r.t), r.t


def test_clean_article_equals_python(spark):
    begin = re.compile("<doc [^>]*>")
    punct = re.compile(r"[^\w\s]", re.UNICODE)
    rows = ['<doc id="1" url="u" title="t">\nHello, world!\n', "  plain text.  ", '\n<doc id="2">x</doc>']
    df = spark.createDataFrame([(r,) for r in rows], "t string")
    for r in df.select("t", T.clean_article("t").alias("c")).collect():
        assert r.c == punct.sub("", begin.sub("", r.t.strip()))


def test_line_filters(spark):
    lines = ["", "   ", "<doc id=1>", "</doc>", "  </doc>  ", "text", "==== Body", "  ==== Refs", "a ==== b"]
    df = spark.createDataFrame([(x,) for x in lines], "l string")
    wiki = [r.l for r in df.filter(T.is_wiki_text_line("l")).collect()]
    art = [r.l for r in df.filter(T.is_article_text_line("l")).collect()]
    assert wiki == ["text", "==== Body", "  ==== Refs", "a ==== b"]
    assert art == ["<doc id=1>", "</doc>", "  </doc>  ", "text", "a ==== b"]


def test_drop_empty_tokens(spark):
    df = spark.createDataFrame([("a  b",)], "t string")
    assert df.select(T.drop_empty_tokens(T.tokenize("t"))).first()[0] == ["a", "b"]


def test_explode_has_no_inferred_prefilter(spark):
    """The token explode must not duplicate the tokenizer below the Generate."""
    from kiln.operators.features import term_occurrences
    df = spark.createDataFrame([(1, "a b")], "id int, t string").select("id", T.tokenize("t").alias("w"))
    plan = term_occurrences(df, "id", "w")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1


def test_by_document_cuts_by_size(spark):
    """Partitions follow the rows and bytes; adaptive execution does not join them."""
    from pyspark.sql import functions as F

    from kiln.operators import features as fx
    rows = spark.range(5 * fx.TASK_ROWS)
    cut = fx.by_document(rows, "id")
    assert cut.rdd.getNumPartitions() == 5
    assert cut.withColumn("p", F.spark_partition_id()).select("p").distinct().count() == 5
    long = spark.range(8).select("id", F.repeat(F.lit("x"), fx.TASK_BYTES).alias("text"))
    assert fx.by_document(long, "id", "text").rdd.getNumPartitions() == 8
    assert sorted(r["id"] for r in cut.collect()) == list(range(5 * fx.TASK_ROWS))
