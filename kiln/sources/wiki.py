"""Wiki dump XML (SRC-8, SRC-9, SRC-10, SRC-14, SRC-17) and MEDLINE XML (SRC-7).

A dump is read as text records ending in ``</page>\\n`` (splittable on plain
files, bz2/gz through Hadoop codecs) and every ``<page>`` is parsed by
``from_xml`` with an explicit schema.  The ``xml`` file source would make a
whole dump one partition (multiLine) or break pages that span lines.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import markup
from kiln.session import scratch_path

PAGE_END = "</page>\n"
PAGE_SCHEMA = "revision STRUCT<id: BIGINT, text: STRING>"
HEAD_CHARS = 1 << 16     # of a page that may stand before its revision
XML_OPTS = {"excludeAttribute": "true"}
# Disambiguation markers (a line starting with the template).
DISAMBIG = r"(?m)^\{\{disambig(uation)?(\|[^}]*)?\}\}"
TEMPLATE_NS = ("10", "828")


def xml_escape(c) -> Column:
    """Escape text for an XML element body."""
    c = F.col(c) if isinstance(c, str) else c
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def xml_unescape(c) -> Column:
    """Decode the five predefined XML entities (``&amp;`` last)."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def dump_chunks(spark: SparkSession, path: str) -> DataFrame:
    """Raw ``</page>``-terminated chunks with their position (file, row id)."""
    return spark.read.option("lineSep", PAGE_END).text(path).select(
        F.col("value").alias("chunk"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("pos"))


def dump_pages(spark: SparkSession, path: str) -> DataFrame:
    """SRC-8: (id, revid, title, ns, redirect, text, file, block, pos) of every page.
    ns defaults to '0'; ``<text/>`` gives ''.  Everything but the text and the
    revision stands in the page's head, before ``<revision>``, so a plan that does
    not read these two (:func:`first_by_id`) parses no page."""
    at = F.instr("chunk", "<page>")
    head = F.substring_index(F.substr("page", F.lit(1), F.lit(HEAD_CHARS)), "<revision>", 1)
    tag = lambda name: F.regexp_extract("head", rf"<{name}>\s*([^<]*)", 1)
    redirect = F.regexp_extract("head", r'<redirect\s+title="([^"]*)"', 1)
    body = F.from_xml(F.concat("page", F.lit("</page>")), PAGE_SCHEMA, XML_OPTS)["revision"]
    return (dump_chunks(spark, path).filter(at > 0)
            .select(F.substr("chunk", at).alias("page"), "file", "block", "pos")
            .select(head.alias("head"), body.alias("revision"), "file", "block", "pos")
            .select(F.expr("try_cast(regexp_extract(head, '<id>\\\\s*([0-9]+)', 1) AS BIGINT)").alias("id"), F.col("revision.id").alias("revid"),
                    xml_unescape(F.trim(tag("title"))).alias("title"), F.coalesce(F.nullif(tag("ns"), F.lit("")), F.lit("0")).alias("ns"),
                    xml_unescape(F.nullif(redirect, F.lit(""))).alias("redirect"),
                    F.coalesce("revision.text", F.lit("")).alias("text"), "file", "block", "pos"))


# Repeated ids handed to every task at most; more are joined by a shuffle.
REPEATED_IDS = 1_000_000


def first_by_id(pages: DataFrame, repeated_ids: int = REPEATED_IDS) -> DataFrame:
    """WIN-1: keep the first page per id in input order (file, block, position).
    Decided on the keys alone: an aggregate over (id, file, block, pos) finds the few
    ids that occur more than once and where each is first; pages of those ids that
    stand elsewhere go.  The texts are neither sorted nor aggregated, and not
    shuffled unless over ``repeated_ids`` ids repeat.  The scan runs twice; the first
    time reads the heads only."""
    spark = pages.sparkSession
    place = F.struct("file", "block", "pos")
    path = scratch_path(spark, "repeated-ids")
    (pages.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first")).where("n > 1")
     .select(F.col("id").alias("_id"), F.col("first").alias("_first")).write.parquet(path))
    repeated = spark.read.parquet(path)
    if repeated.count() <= repeated_ids:
        repeated = F.broadcast(repeated)
    same = F.col("id").eqNullSafe(F.col("_id"))
    return pages.join(repeated, same, "left").where(F.col("_first").isNull() | (place == F.col("_first"))).drop("_id", "_first")


def article_pages(pages: DataFrame, drop_disambiguation: bool = False, ignore_case: bool = True) -> DataFrame:
    """FLT-7 + FLT-8 (+ FLT-9): main-namespace, non-redirect pages.  The reference
    takes the disambiguation template in lower case only (``ignore_case=False``)."""
    out = pages.filter((F.col("ns") == "0") & F.col("redirect").isNull())
    if drop_disambiguation:
        out = out.filter(~F.col("text").rlike(("(?i)" if ignore_case else "") + DISAMBIG))
    return out


SITE_SCHEMA = "base STRING, namespaces STRUCT<namespace: ARRAY<STRUCT<_key: STRING, _VALUE: STRING>>>"


def site_info(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: one row: base URL (cut at the last '/') and namespaces (key, name)
    from the ``<siteinfo>`` block, which stands before the first page of a dump, or
    of the first of its files.  Only that file's first record is read: the file
    comes from the listing (no content), and the first record of its first split is
    one bounded row.  A dump without the block gives no row."""
    first = spark.read.format("binaryFile").load(path).agg(F.min("path")).first()[0]
    if first is None:
        return spark.createDataFrame([], "base string, namespaces array<struct<_key: string, _VALUE: string>>")
    head = spark.read.option("lineSep", PAGE_END).text(escape_glob(first)).select(F.substring_index("value", "<page>", 1).alias("head")).head(1)
    chunk = spark.createDataFrame([tuple(r) for r in head], "head string")
    block = F.regexp_extract("head", r"(?s)(<siteinfo>.*?</siteinfo>)", 1)
    return (chunk.select(block.alias("block")).filter("block <> ''").select(F.from_xml("block", SITE_SCHEMA, {"rowTag": "siteinfo"}).alias("s"))
            .select(F.regexp_replace("s.base", r"/[^/]*$", "").alias("base"), F.col("s.namespaces.namespace").alias("namespaces")))


def escape_glob(path: str) -> str:
    """A listed path, so that a reader takes it literally."""
    return re.sub(r"([\\[\]{}*?])", r"\\\1", path)


def namespaces(spark: SparkSession, path: str) -> DataFrame:
    """SRC-9: (base, key, name) rows of the site's namespaces."""
    return site_info(spark, path).select("base", F.explode("namespaces").alias("n")).select(
        "base", F.col("n._key").alias("key"), F.coalesce(F.col("n._VALUE"), F.lit("")).alias("name"))


def with_extraction_totals(pages: DataFrame, name: str = "extraction_totals"):
    """AGG-16: pages processed and template pages seen, collected as
    observed metrics of the job that consumes the returned frame (no extra
    pass).  Returns (frame, Observation); read ``observation.get`` after an
    action."""
    from pyspark.sql import Observation
    obs = Observation(name)
    out = pages.observe(obs, F.count(F.lit(1)).alias("pages"),
                        F.count_if(F.col("ns").isin(*TEMPLATE_NS)).alias("templates"))
    return out, obs


def template_pages(pages: DataFrame) -> DataFrame:
    """SRC-10/FLT-16: template and module pages (ns 10 / 828)."""
    return pages.filter(F.col("ns").isin(*TEMPLATE_NS))


def template_prefixes(pages: DataFrame) -> DataFrame:
    """SRC-10: (ns, prefix) of templates and modules, taken from the first title in
    input order that has one (two rows at most)."""
    colon = F.instr("title", ":")
    return (template_pages(pages).where(colon > 2).groupBy("ns")
            .agg(F.min_by(F.substr("title", F.lit(1), colon), F.struct("file", "block", "pos")).alias("prefix")))


def template_definitions(pages: DataFrame) -> DataFrame:
    """SRC-10 + TXT-30: (title, name, target, body) of template and module pages;
    ``name`` is the title without its namespace's prefix.  A redirect has a target and
    no body, a page that includes nothing is no definition, and of pages with one
    title the last in input order counts (redirects and bodies apart).  The pages are
    scanned once more for the prefixes, titles only."""
    target, place = markup.template_target("text"), F.struct("file", "block", "pos")
    found = (template_pages(pages).select("title", "ns", target.alias("target"), F.when(target.isNull(), markup.template_body("text")).alias("body"), place.alias("place"))
             .where("target is not null or body <> ''"))
    last = found.groupBy("title", "ns", F.col("target").isNull().alias("plain")).agg(F.max_by(F.struct("target", "body"), "place").alias("d"))
    name = F.when(F.startswith("title", "prefix"), F.expr("substr(title, length(prefix) + 1)")).otherwise(F.col("title"))
    return (last.join(F.broadcast(template_prefixes(pages)), "ns", "left")
            .select("title", name.alias("name"), F.col("d.target").alias("target"), F.col("d.body").alias("body")))


# --- MEDLINE ---------------------------------------------------------------------------------
MEDLINE_SCHEMA = ("Article STRUCT<ArticleTitle: STRING, Abstract: STRUCT<AbstractText: ARRAY<STRING>>>, "
                  "OtherAbstract ARRAY<STRUCT<AbstractText: ARRAY<STRING>>>")
MEDLINE_OPTS = {"rowTag": "MedlineCitation", "ignoreSurroundingSpaces": "false"}


def medline_citations(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7 + PRJ-6: one row per ``MedlineCitation``: file base name, title,
    first abstract text, first other-abstract text.  The schema is explicit
    and all strings (inference turns a title like ``T1`` into a timestamp)."""
    df = spark.read.format("xml").options(**MEDLINE_OPTS).schema(MEDLINE_SCHEMA).load(path)
    return df.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+?)(\.[^./]*)?$", 1).alias("file"),
        F.col("Article.ArticleTitle").alias("title"),
        F.col("Article.Abstract.AbstractText")[0].alias("abstract"),
        F.col("OtherAbstract")[0]["AbstractText"][0].alias("other_abstract"))


def citation_text(title="title", abstract="abstract", other="other_abstract") -> Column:
    """TXT-32: title, blank line, first abstract, other abstract; missing
    parts skipped."""
    body = F.concat_ws("", F.col(abstract), F.col(other))
    return F.concat_ws("\n\n", F.col(title), F.when(body != "", body))
