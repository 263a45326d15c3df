"""Source round trips: the driver tables written in the reference's input
formats by Spark (WET, ``<doc>`` files, wiki dump XML, MEDLINE XML), read back
with the sources, compared with SQL on the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kiln.functions import markup
from kiln.plans import sqlfrag as S
from kiln.plans.common import documents
from kiln.session import read_table, scratch_path
from kiln.sinks import files as sink
from kiln.sources import crawl, text as src, wiki

URL_BASE = "https://example.org/"


def write_wet(spark, sf, eol="\n", compression=None, varied=False) -> str:
    """documents as WET files: a warcinfo record, then one conversion record
    per document (URI from language and id).  ``varied``: format 1.0 or 1.1, and
    no, one or two ``WARC-Concurrent-To`` headers, by row."""
    d = documents(spark, sf)
    uri = F.concat(F.lit(URL_BASE), F.col("lang"), F.lit("/"), F.col("doc_id").cast("string"))
    options = {} if not varied else {
        "version": F.when(F.col("doc_id") % 2 == 0, "1.0").otherwise("1.1"),
        "concurrent": F.slice(F.array(F.col("doc_id") + 1, F.col("doc_id") + 2), 1, (F.col("doc_id") % 3).cast("int"))}
    recs = d.select(crawl.wet_record(uri, "text", "doc_id", eol=eol, **options).alias("value"))
    info = spark.createDataFrame([(crawl.warcinfo_record(eol),)], "value string")
    out = scratch_path(spark, "wet")
    w = info.unionByName(recs).write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(out)
    return out


def q_wet_roundtrip(spark, sf):
    """SRC-5 + FLT-3: (URI, text) of every conversion record."""
    return crawl.wet_documents(spark, write_wet(spark, sf))


def q_wet_compat(spark, sf):
    """SRC-5 + FLT-4, reference form (lines fused, Q1)."""
    return crawl.wet_documents(spark, write_wet(spark, sf), compat=True)


def q_warc_records(spark, sf):
    """SRC-6: url, header fields and payload size of every record (gz, CRLF)."""
    recs = crawl.warc_records(spark, write_wet(spark, sf, eol="\r\n", compression="gzip", varied=True))
    return recs.select("url", F.col("header")["WARC-Type"].alias("warc_type"),
                       F.col("header")["WARC-Concurrent-To"].alias("concurrent"),
                       F.col("header")["Content-Length"].cast("bigint").alias("content_length"),
                       F.size(F.map_keys("header")).alias("n_headers"),
                       F.octet_length(F.regexp_replace("payload", r"\s+$", "")).alias("payload_bytes"))


def q_doc_roundtrip(spark, sf):
    """SNK-3 + PRJ-3 -> SRC-3/SRC-4: ``<doc>`` blocks per language folder, read
    back as whole-article records with one scan."""
    d = documents(spark, sf)
    out = scratch_path(spark, "docs")
    blocks = d.select(sink.doc_block("doc_id", "source", "text", URL_BASE + "wiki").alias("block"), "lang")
    sink.write_doc_blocks(blocks, out, partition_by=["lang"])
    recs = src.article_records(spark, f"{out}/*/*", lang_level=1)
    return recs.select("id", "url", "title", F.regexp_replace("lang", "^lang=", "").alias("lang"),
                       "corrupt", "body")


EXCLUDED = ["es"]


def q_language_corpus(spark, sf):
    """SRC-3 (J4 loader) + FEA-2 + FLT-5: one scan of all language folders,
    language from the folder, listed languages excluded, records cleaned."""
    d = documents(spark, sf)
    out = scratch_path(spark, "langs")
    blocks = d.select(sink.doc_block("doc_id", "source", "text", URL_BASE + "wiki").alias("block"), "lang")
    sink.write_doc_blocks(blocks, out, partition_by=["lang"])
    return src.language_corpus(spark, f"{out}/*/*", exclude=EXCLUDED, lang_level=1)


def site_header(d):
    """The site info block of the generated dump: the base URL from the first
    language, the names of keys 10 and 828, and a namespace for every source."""
    sources = F.array_sort(F.collect_set("source"))
    own = F.transform(sources, lambda x, i: F.concat(F.lit('      <namespace key="'), (i * 2 + 100).cast("string"),
                                                      F.lit('" case="first-letter">'), wiki.xml_escape(x), F.lit("</namespace>\n")))
    return d.agg(F.concat(
        F.lit('<mediawiki xml:lang="'), F.min("lang"), F.lit('">\n  <siteinfo>\n    <sitename>Example</sitename>\n    <base>https://'), F.min("lang"),
        F.lit(".example.org/w"), F.count(F.lit(1)).cast("string"), F.lit('/Main_Page</base>\n    <namespaces>\n      <namespace key="0" case="first-letter" />\n'
              '      <namespace key="10" case="first-letter">Template</namespace>\n      <namespace key="828" case="first-letter">Module</namespace>\n'),
        F.array_join(own, ""), F.lit("    </namespaces>\n  </siteinfo>")).alias("value")).select(F.lit(-1).cast("long").alias("pos"), "value")


def _page(id_, title, ns, revid, body, redirect=None):
    parts = [F.lit("  <page>\n    <title>"), wiki.xml_escape(title), F.lit("</title>\n    <ns>"), ns,
             F.lit("</ns>\n    <id>"), id_.cast("string"), F.lit("</id>\n")]
    if redirect is not None:
        parts += [F.lit('    <redirect title="'), wiki.xml_escape(redirect), F.lit('" />\n')]
    parts += [F.lit("    <revision>\n      <id>"), revid.cast("string"), F.lit("</id>\n      ")]
    parts += [F.when(body == "", F.lit('<text bytes="0" />'))
              .otherwise(F.concat(F.lit('<text xml:space="preserve">'), wiki.xml_escape(body), F.lit("</text>")))]
    parts += [F.lit("\n    </revision>\n  </page>")]
    return F.concat(*parts)


def write_dump(spark, sf, compression="bzip2") -> str:
    """documents as a wiki dump: one article page per document, plus per
    document a redirect page; some documents get a consecutive duplicate page
    (same id), a template page, or an extra empty page."""
    d = documents(spark, sf)
    i = F.col("doc_id")
    title = F.concat(F.col("source"), F.lit(" "), i.cast("string"))
    pages = [
        (i * 8, _page(i, title, F.lit("0"), i + 1_000_000, F.col("text"))),
        (i * 8 + 1, _page(i + 1_000_000, F.concat(F.lit("R "), i.cast("string")), F.lit("0"), i + 2_000_000,
                          F.concat(F.lit("#REDIRECT [["), title, F.lit("]]")), redirect=title)),
    ]
    rows = [d.select(pos.alias("pos"), xml.alias("value")) for pos, xml in pages]
    rows.append(d.filter(i % 7 == 0).select((i * 8 + 2).alias("pos"),
                                            _page(i, title, F.lit("0"), i + 3_000_000, F.lit("DUPLICATE")).alias("value")))
    rows.append(d.filter(i % 50 == 0).select((i * 8 + 3).alias("pos"), _page(
        i + 4_000_000, F.concat(F.lit("Template:T"), i.cast("string")), F.lit("10"), i + 5_000_000,
        F.lit("<noinclude>doc</noinclude>{{{1}}}")).alias("value")))
    rows.append(d.filter(i % 11 == 0).select((i * 8 + 4).alias("pos"), _page(
        i + 6_000_000, F.concat(F.lit("Empty "), i.cast("string")), F.lit("0"), i + 7_000_000,
        F.lit("")).alias("value")))
    allrows = site_header(d).unionByName(spark.createDataFrame([(1 << 62, "</mediawiki>")], "pos long, value string"))
    for r in rows:
        allrows = allrows.unionByName(r)
    out = scratch_path(spark, "dump")
    w = allrows.orderBy("pos").select("value").write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.text(out)
    return out


def q_dump_pages(spark, sf):
    """SRC-8 + SRC-14 + FLT-7 + FLT-8 + WIN-1: article pages of a bz2 dump."""
    pages = wiki.first_by_id(wiki.dump_pages(spark, write_dump(spark, sf)))
    return wiki.article_pages(pages).select("id", "revid", "title", "ns", "text")


def q_dump_redirects(spark, sf):
    """SRC-8 redirect edges (title -> target) for JOIN-2."""
    pages = wiki.dump_pages(spark, write_dump(spark, sf, compression=None))
    return pages.filter(F.col("redirect").isNotNull()).select("id", "title", F.col("redirect").alias("target"))


def q_disambiguation(spark, sf):
    """FLT-9: article pages without disambiguation pages.  By row: no template, the
    short or the long name at a line start, one with a parameter, one inside a line,
    one in upper case (the last two stay)."""
    d = documents(spark, sf)
    i = F.col("doc_id")
    kinds = F.array(*map(F.lit, ["plain", "first\n{{disambig}}", "{{disambiguation}}\nlast", "x\n{{disambig|geo}} y", "see {{disambig}}", "{{Disambig}}"]))
    out = scratch_path(spark, "dump")
    d.select(_page(i, F.col("source"), F.lit("0"), i + 1, F.element_at(kinds, (i % 6 + 1).cast("int"))).alias("value")).write.text(out)
    pages = wiki.article_pages(wiki.dump_pages(spark, out), drop_disambiguation=True, ignore_case=False)
    return pages.select("id", "title", "text")


def q_extraction_totals(spark, sf):
    """AGG-16: pages and template pages, observed while the pages are written."""
    pages, seen = wiki.with_extraction_totals(wiki.dump_pages(spark, write_dump(spark, sf, compression=None)))
    pages.select("id", "title").write.parquet(scratch_path(spark, "pages"))
    return spark.createDataFrame([(k, int(v)) for k, v in sorted(seen.get.items())], "metric string, n long")


def q_doc_strict(spark, sf):
    """SRC-4: the permissive reader flags records without an end, the strict one
    takes the files without such records."""
    d = documents(spark, sf)
    out = scratch_path(spark, "docs")
    block = sink.doc_block("doc_id", "source", "text", URL_BASE + "wiki")
    # every seventh record loses its end, and swallows the next one of its file
    kind = F.when(F.col("doc_id") % 7 == 0, "broken").otherwise("whole")
    broken = F.concat(F.replace(block, F.lit("</doc>"), F.lit("")), F.lit("\n"), block)
    sink.write_doc_blocks(d.select(F.when(F.col("doc_id") % 7 == 0, broken).otherwise(block).alias("block"), kind.alias("kind")), out, partition_by=["kind"])
    flagged = src.article_records(spark, f"{out}/*/*", lang_level=1).select(F.lit("permissive").alias("mode"), "id", "corrupt")
    strict = src.article_records(spark, f"{out}/kind=whole/*", lang_level=1, fail_fast=True).select(F.lit("strict").alias("mode"), "id", "corrupt")
    return flagged.unionByName(strict)


def q_siteinfo(spark, sf):
    """SRC-9: base URL and namespaces (key, name) of the dump's site info."""
    return wiki.namespaces(spark, write_dump(spark, sf, compression=None))


def q_dump_templates(spark, sf):
    """SRC-8 -> SRC-10 + FLT-16 + TXT-30 -> SNK-7 (parquet) -> SRC-17: the
    template dictionary of the dump, saved and loaded again."""
    pages = wiki.first_by_id(wiki.dump_pages(spark, write_dump(spark, sf, compression=None)))
    defs = wiki.template_pages(pages).select("title", markup.template_body("text").alias("body"))
    out = scratch_path(spark, "templates")
    defs.write.mode("overwrite").parquet(out)                # SNK-7
    return spark.read.parquet(out)                           # SRC-17


def q_template_bodies(spark, sf):
    """SRC-10 + TXT-29 + TXT-30: definitions of templates and modules whose prefixes
    come from the titles.  By row: parts left out, parts included alone, a redirect,
    an unterminated part, nothing to include, empty parts."""
    d = documents(spark, sf)
    lowest = d.agg(F.min("source").alias("prefix")).scalar()
    i, lg, src_ = F.col("doc_id").cast("string"), F.col("lang"), F.col("source")
    title = lambda n: F.concat("prefix", F.when(n % 5 == 0, F.lit(" module")).otherwise(F.lit("")), F.lit(":T"), n.cast("string"))
    kinds = F.array(
        F.concat(F.lit("<noinclude>doc "), i, F.lit("</noinclude><!-- c -->"), lg, F.lit(" {{{1}}}<includeonly>!</includeonly>")),
        F.concat(F.lit("a<onlyinclude>x "), i, F.lit("</onlyinclude>b<onlyinclude> y "), src_, F.lit("</onlyinclude>c")),
        F.concat(F.lit("#redirect  [["), title(F.col("doc_id") + 1), F.lit("]] rest")),
        F.concat(F.lit("kept "), i, F.lit("<noinclude/> too<noinclude >open "), lg),
        F.concat(F.lit("<noinclude>doc "), i, F.lit("</noinclude>")),
        F.concat(F.lit("<onlyinclude></onlyinclude>z "), i, F.lit("<includeonly> "), lg, F.lit("</includeonly>")))
    out = scratch_path(spark, "dump")
    ns = F.when(F.col("doc_id") % 5 == 0, "828").otherwise("10")
    body = F.element_at(kinds, (F.col("doc_id") % 6 + 1).cast("int"))
    (d.withColumn("prefix", lowest).select(_page(F.col("doc_id"), title(F.col("doc_id")), ns, F.col("doc_id") + 1, body).alias("value"))
     .write.text(out))
    return wiki.template_definitions(wiki.dump_pages(spark, out))


def write_medline(spark, sf) -> str:
    """conversations as MEDLINE citations, one for every four turns: the first =
    title, the next two = AbstractText elements, the fourth = OtherAbstract
    (missing turns -> missing elements)."""
    c = read_table(spark, sf, "conversations")
    g = c.groupBy("conv_id", F.floor(F.col("turn") / 4)).agg(
        *[F.max(F.when(F.col("turn") % 4 == k, F.col("text"))).alias(f"t{k}") for k in range(4)])

    abstract = F.when(F.col("t1").isNotNull(), F.struct(
        F.filter(F.array("t1", "t2"), lambda x: x.isNotNull()).alias("AbstractText")))
    other = F.when(F.col("t3").isNotNull(), F.struct(F.array("t3").alias("AbstractText")))
    cit = g.select(F.struct(F.col("t0").alias("ArticleTitle"), abstract.alias("Abstract")).alias("Article"),
                   other.alias("OtherAbstract"))
    out = scratch_path(spark, "medline")
    (cit.write.mode("overwrite").format("xml").option("rootTag", "MedlineCitationSet")
     .option("rowTag", "MedlineCitation").save(out))
    return out


def q_medline(spark, sf):
    """SRC-7 + TXT-32 (+ SNK-9 text): title, first abstract, other abstract."""
    cits = wiki.medline_citations(spark, write_medline(spark, sf))
    return cits.select("title", "abstract", "other_abstract", wiki.citation_text().alias("text"))


QUERIES = {
    "q_wet_roundtrip": q_wet_roundtrip,
    "q_wet_compat": q_wet_compat,
    "q_warc_records": q_warc_records,
    "q_doc_roundtrip": q_doc_roundtrip,
    "q_dump_pages": q_dump_pages,
    "q_dump_redirects": q_dump_redirects,
    "q_disambiguation": q_disambiguation,
    "q_extraction_totals": q_extraction_totals,
    "q_doc_strict": q_doc_strict,
    "q_siteinfo": q_siteinfo,
    "q_medline": q_medline,
    "q_language_corpus": q_language_corpus,
    "q_dump_templates": q_dump_templates,
    "q_template_bodies": q_template_bodies,
}

_URI = "'https://example.org/' || lang || '/' || doc_id"
_DOCREC = ("'<doc id=\"' || doc_id || '\" url=\"https://example.org/wiki?curid=' || doc_id || '\" title=\"' || source "
           "|| '\">' || chr(10) || source || chr(10) || chr(10) || text || chr(10)")
_TITLE = "source || ' ' || doc_id"
ORACLE = {
    "q_wet_roundtrip": rf"SELECT {_URI} AS URI, regexp_replace(text, '[\s\x{{0b}}]+$', '') AS text FROM documents",
    "q_wet_compat": f"SELECT {_URI} AS URI, replace(text, chr(10), '') AS text FROM documents",
    "q_warc_records": r"""SELECT 'https://example.org/' || lang || '/' || doc_id AS url, 'conversion' AS warc_type,
            CASE doc_id % 3 WHEN 1 THEN '<urn:uuid:' || (doc_id + 1) || '>'
                WHEN 2 THEN '<urn:uuid:' || (doc_id + 1) || '>, <urn:uuid:' || (doc_id + 2) || '>' END AS concurrent,
            CAST(strlen(text) AS BIGINT) AS content_length, CASE WHEN doc_id % 3 = 0 THEN 6 ELSE 7 END AS n_headers,
            CAST(strlen(regexp_replace(text, '[\s\x{0b}]+$', '')) AS INTEGER) AS payload_bytes FROM documents
        UNION ALL SELECT NULL, 'warcinfo', NULL, 25, 5, 25""",
    "q_doc_roundtrip": f"""SELECT CAST(doc_id AS VARCHAR) AS id, 'https://example.org/wiki?curid=' || doc_id AS url,
        source AS title, lang, FALSE AS corrupt, source || chr(10) || chr(10) || text || chr(10) AS body FROM documents""",
    "q_dump_pages": f"""SELECT doc_id AS id, doc_id + 1000000 AS revid, {_TITLE} AS title, '0' AS ns, text FROM documents
        UNION ALL SELECT doc_id + 6000000, doc_id + 7000000, 'Empty ' || doc_id, '0', '' FROM documents WHERE doc_id % 11 = 0""",
    "q_dump_redirects": f"SELECT doc_id + 1000000 AS id, 'R ' || doc_id AS title, {_TITLE} AS target FROM documents",
    "q_language_corpus": f"""SELECT {S.strip(f"regexp_replace({S.py_strip(_DOCREC)}, '<doc [^>]*>', '', 'g')")} AS fullText,
        lang FROM documents WHERE lang NOT IN ('es')""",
    "q_template_bodies": """WITH d AS (SELECT *, (SELECT min(source) FROM documents) AS p FROM documents)
        SELECT p || CASE WHEN doc_id % 5 = 0 THEN ' module' ELSE '' END || ':T' || doc_id AS title, 'T' || doc_id AS name,
            CASE WHEN doc_id % 6 = 2 THEN p || CASE WHEN (doc_id + 1) % 5 = 0 THEN ' module' ELSE '' END || ':T' || (doc_id + 1) END AS target,
            CASE doc_id % 6 WHEN 0 THEN lang || ' {{{1}}}!' WHEN 1 THEN 'x ' || doc_id || ' y ' || source WHEN 3 THEN 'kept ' || doc_id || ' too'
                WHEN 5 THEN '<onlyinclude></onlyinclude>z ' || doc_id || ' ' || lang END AS body
        FROM d WHERE doc_id % 6 <> 4""",
    "q_dump_templates": "SELECT 'Template:T' || doc_id AS title, '{{{1}}}' AS body FROM documents WHERE doc_id % 50 = 0",
    "q_disambiguation": """SELECT doc_id AS id, source AS title, CASE doc_id % 6 WHEN 0 THEN 'plain' WHEN 4 THEN 'see {{disambig}}' ELSE '{{Disambig}}' END AS text
        FROM documents WHERE doc_id % 6 IN (0, 4, 5)""",
    "q_extraction_totals": """SELECT 'pages' AS metric, count(*) * 2 + count(*) FILTER (WHERE doc_id % 7 = 0) + count(*) FILTER (WHERE doc_id % 50 = 0)
            + count(*) FILTER (WHERE doc_id % 11 = 0) AS n FROM documents
        UNION ALL SELECT 'templates', count(*) FROM documents WHERE doc_id % 50 = 0""",
    "q_doc_strict": """SELECT 'permissive' AS mode, CAST(doc_id AS VARCHAR) AS id, doc_id % 7 = 0 AS corrupt FROM documents
        UNION ALL SELECT 'strict', CAST(doc_id AS VARCHAR), false FROM documents WHERE doc_id % 7 <> 0""",
    "q_siteinfo": """WITH b AS (SELECT 'https://' || min(lang) || '.example.org/w' || count(*) AS base FROM documents),
        n AS (SELECT CAST(98 + 2 * row_number() OVER (ORDER BY source) AS VARCHAR) AS key, source AS name FROM (SELECT DISTINCT source FROM documents)
            UNION ALL SELECT * FROM (VALUES ('0', ''), ('10', 'Template'), ('828', 'Module')) t(key, name))
        SELECT base, key, name FROM b, n""",
    "q_medline": """WITH g AS (SELECT conv_id, max(text) FILTER (WHERE turn % 4 = 0) AS title,
            max(text) FILTER (WHERE turn % 4 = 1) AS abstract, max(text) FILTER (WHERE turn % 4 = 3) AS other_abstract
            FROM conversations GROUP BY conv_id, turn // 4)
        SELECT title, abstract, other_abstract,
               concat_ws(chr(10) || chr(10), title, nullif(concat_ws('', abstract, other_abstract), '')) AS text FROM g""",
}
