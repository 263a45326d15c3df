"""Text corpus sources (SRC-1..4, SRC-11..16).

One scan per corpus: the class or language comes from the file path
(``_metadata.file_path``), never from one plan branch per class.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from kiln.functions.text import clean_article, is_article_text_line, is_wiki_text_line

LINE_SCHEMA = StructType([StructField("fullText", StringType(), True),
                          StructField("category", DoubleType(), False)])
ARTICLE_SCHEMA = StructType([StructField("fullText", StringType(), True),
                             StructField("lang", StringType(), False)])


def folder_of(path_col="path", level: int = 1, encoded: bool = True) -> F.Column:
    """Name of the ``level``-th folder above the file (a ``key=value`` folder of a
    partitioned write gives its value).  ``encoded``: the path comes from
    ``_metadata.file_path``, where blanks, accents and the like are percent-encoded;
    a ``key=value`` folder's value is escaped once more by the writer."""
    def decoded(c):
        return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))

    folder = F.regexp_extract(F.col(path_col), r"/([^/]+)" + r"/[^/]+" * level + "$", 1)
    folder = decoded(folder) if encoded else folder
    value = F.regexp_extract(folder, r"^[^=]+=(.*)$", 1)
    return F.when(value != "", F.coalesce(F.try_url_decode(F.replace(value, F.lit("+"), F.lit("%2B"))), value)).otherwise(folder)


def labelled_lines(spark: SparkSession, root: str, labels: dict[str, float],
                   kind: str = "wiki", path_glob: str = "*") -> DataFrame:
    """SRC-1: every line of ``root/<folder>/*`` for the folders in ``labels``,
    filtered (``kind`` = ``wiki`` -> FLT-1, ``article`` -> FLT-2) and tagged with
    the folder's numeric class.  Only the listed folders are scanned; a line whose
    folder has no class fails the job."""
    paths = [f"{root.rstrip('/')}/{folder}/{path_glob}" for folder in labels]
    keep = is_wiki_text_line if kind == "wiki" else is_article_text_line
    def value(folder):   # a key=value folder is keyed by its value, like folder_of
        return folder.split("=", 1)[1] if "=" in folder else folder

    m = F.create_map(*[x for k, v in labels.items() for x in (F.lit(value(k)), F.lit(float(v)))])
    df = spark.read.text(paths).select(F.col("value").alias("fullText"),
                                       F.col("_metadata.file_path").alias("path"))
    return (df.filter(keep("fullText"))
            .select("fullText", F.coalesce(m[folder_of("path")], F.raise_error(
                F.concat(F.lit("no class for the folder of "), "path")).cast("double")).alias("category")))


def concatenated_lines(spark: SparkSession, path: str, category: float, kind: str = "article") -> DataFrame:
    """SRC-2: the same from one concatenated file."""
    keep = is_wiki_text_line if kind == "wiki" else is_article_text_line
    return (spark.read.text(path).filter(keep("value"))
            .select(F.col("value").alias("fullText"), F.lit(float(category)).alias("category")))


# Record delimiter of extracted article files and the header.
DOC_END = "</doc>\n"
DOC_HEADER = r'<doc id="([^"]*)"(?: revid="([^"]*)")? url="([^"]*)" title="([^"]*)">'


def article_records(spark: SparkSession, glob: str, lang_level: int = 2, fail_fast: bool = False) -> DataFrame:
    """SRC-3/SRC-4: whole-article records of extracted wiki files
    (``<root>/<lang>/<AA>/wiki_NN``), one scan for all languages; the
    multi-character ``lineSep`` keeps plain files splittable.

    Columns: path, lang, id, revid, url, title, body, corrupt.  ``corrupt`` is
    set when a record does not start with a well-formed header (Q15: a missing
    ``</doc>`` leaves the header of the next record inside the body).
    ``fail_fast``: such a record fails the job, with its file and beginning."""
    raw = (spark.read.option("lineSep", DOC_END).text(glob)
           .select(F.col("value").alias("record"), F.col("_metadata.file_path").alias("path")))
    rec = F.regexp_replace(F.col("record"), r"^\n+", "")
    header = F.regexp_extract(rec, "^" + DOC_HEADER, 0)
    body = F.substring(rec, F.length(header) + 2, 1 << 30)
    corrupt = (header == "") | (F.instr(body, "<doc ") > 0)
    if fail_fast:
        corrupt = F.when(corrupt, F.raise_error(F.concat(F.lit("malformed record in "), "path", F.lit(": "), F.substring(rec, 1, 80))).cast("boolean")) \
            .otherwise(False)
    return raw.filter(F.length(F.trim(F.col("record"))) > 0).select(
        "path", folder_of("path", lang_level).alias("lang"),
        F.regexp_extract(rec, "^" + DOC_HEADER, 1).alias("id"),
        F.regexp_extract(rec, "^" + DOC_HEADER, 2).alias("revid"),
        F.regexp_extract(rec, "^" + DOC_HEADER, 3).alias("url"),
        F.regexp_extract(rec, "^" + DOC_HEADER, 4).alias("title"),
        body.alias("body"), corrupt.alias("corrupt"),
        F.col("record"))


def language_corpus(spark: SparkSession, glob: str, exclude=(), lang_level: int = 2) -> DataFrame:
    """J4 loader: (fullText, lang) with FEA-2 cleaning; FLT-5 exclusion."""
    df = (spark.read.option("lineSep", DOC_END).text(glob)
          .select(F.col("value"), folder_of("_metadata.file_path", lang_level).alias("lang")))
    if exclude:
        df = df.filter(~F.col("lang").isin(list(exclude)))
    return df.select(clean_article("value").alias("fullText"), "lang")


def file_listing(spark: SparkSession, root: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """SRC-13: (folder, path, name, length) of the files below ``root``; the
    ``content`` column is never read (column pruning on ``binaryFile``)."""
    df = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
          .option("pathGlobFilter", glob).load(root))
    return df.select(folder_of("path", encoded=False).alias("folder"), "path",
                     F.regexp_extract("path", r"([^/]+)$", 1).alias("name"), "length")


def text_list(spark: SparkSession, path: str) -> DataFrame:
    """FLT-14: non-blank, trimmed lines of a list file (languages, URLs)."""
    return (spark.read.text(path).select(F.trim(F.col("value")).alias("value"))
            .filter(F.col("value") != ""))


# Size report line shapes.
SIZE_LINE = r"^(\S+)\s*:\s*(\d+)$"
SIZE_ERROR = r"^Could not download dump for (\S+)$"


def size_report(spark: SparkSession, path: str) -> DataFrame:
    """SRC-12: (lang, size, ok) from a size report; error lines -> ok = false,
    the summary line and blanks are skipped."""
    lines = text_list(spark, path)
    ok = lines.value.rlike(SIZE_LINE)
    err = lines.value.rlike(SIZE_ERROR)
    return lines.filter(ok | err).select(
        F.when(ok, F.regexp_extract("value", SIZE_LINE, 1))
         .otherwise(F.regexp_extract("value", SIZE_ERROR, 1)).alias("lang"),
        F.when(ok, F.regexp_extract("value", SIZE_LINE, 2).cast("bigint")).alias("size"),
        ok.alias("ok"))


# Crawl file types of a manifest.
CRAWL_TYPES = ("warc", "wat", "wet")


def crawl_manifest(spark: SparkSession, root: str, file_type: str, prefix: str,
                   n: int = 0) -> DataFrame:
    """SRC-11 + TOP-3: relative paths of ``<root>/<type>.paths[.gz]`` trimmed and
    prefixed; ``all`` = the three types; first ``n`` lines per type in file
    order (n <= 0: all).  A gz manifest is one task, so the row id follows the
    file order within each file."""
    if file_type == "all":
        types = list(CRAWL_TYPES)
    elif file_type in CRAWL_TYPES:
        types = [file_type]
    else:
        raise ValueError(f"unknown crawl file type: {file_type}")
    paths = [f"{root.rstrip('/')}/{t}.paths*" for t in types]
    df = spark.read.text(paths).select(
        F.regexp_extract("_metadata.file_path", r"/(warc|wat|wet)\.paths[^/]*(?:/[^/]*)?$", 1).alias("file_type"),
        F.col("_metadata.file_path").alias("file"),
        F.monotonically_increasing_id().alias("pos"),
        F.trim("value").alias("rel")).filter(F.col("rel") != "")
    out = df.select("file_type", "file", "pos", F.concat(F.lit(prefix), "rel").alias("url"))
    if n > 0:
        from kiln.operators.select import first_n_per_group
        out = first_n_per_group(out, "file_type", ["file", "pos"], n)
    return out.select("file_type", "url")


def inline_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """SRC-15: rows given in the program (probe sentences)."""
    return spark.createDataFrame(rows, schema)


def empty_table(spark: SparkSession, schema=LINE_SCHEMA) -> DataFrame:
    """SRC-16: empty table with a declared schema (neutral element of a union)."""
    return spark.createDataFrame([], schema)
