"""Corpus building and selection queries: line corpora from folders (SRC-1/2),
unions (SET-1/2), splits (SMP-1/2), top-k per folder (TOP-1/2), semi / anti
joins (JOIN-3/5), size survey (SRC-12, AGG-8), crawl manifest (SRC-11, TOP-3),
size-bounded packing (WIN-2/3, SNK-4) and folder concatenation (SNK-5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.operators.select import (anti_join, first_n_per_group, hash_bucket, semi_join,
                                   stratified_split, union_all)
from kiln.plans import sqlfrag as S
from kiln.plans.common import TRAIN_PERCENT, documents
from kiln.session import scratch_path
from kiln.sinks import files as sink
from kiln.sources import text as src


def _lang_labels(docs: DataFrame) -> dict:
    """Folder -> class number, classes in name order.  The label set is small
    (one value per language folder), so it is fetched as metadata."""
    langs = sorted(r[0] for r in docs.select("lang").distinct().collect())
    return {f"lang={x}": float(i) for i, x in enumerate(langs)}


def q_lines(spark, sf):
    """SNK-3 -> SRC-1 + FLT-1 + PRJ-1: documents written as extracted-wiki
    files, one folder per language, read back as labelled text lines."""
    docs = documents(spark, sf)
    out = scratch_path(spark, "lines")
    blocks = docs.select(sink.doc_block("doc_id", "source", "text", "https://example.org/wiki").alias("block"),
                         "lang")
    sink.write_doc_blocks(blocks, out, partition_by=["lang"])
    return src.labelled_lines(spark, out, _lang_labels(docs), kind="wiki")


def article_file(source_col="source", text_col="text"):
    """A full-text article file: blank first line, section headers, blank
    lines between paragraphs."""
    return F.concat(F.lit("\n==== Front\n"), F.col(source_col), F.lit("\n\n==== Body\n"),
                    F.regexp_replace(F.col(text_col), "\n", "\n\n"), F.lit("\n\n==== Refs\n"))


def q_article_lines(spark, sf):
    """SRC-1 + FLT-2: article files per class folder; header and blank lines out."""
    docs = documents(spark, sf)
    out = scratch_path(spark, "articles")
    sink.write_folders(docs.select(article_file().alias("value"), "lang"), out, "lang")
    return src.labelled_lines(spark, out, _lang_labels(docs), kind="article")


# The three class corpora of the union (J2 shape).
UNION_PARTS = (("en", 0.0), ("fr", 1.0), ("rest", 2.0))


def q_union_corpora(spark, sf):
    """SRC-2 + SET-1/SET-2 + SRC-16: three class corpora, each one concatenated
    file, unioned from the empty table of the declared schema."""
    docs = documents(spark, sf)
    out = scratch_path(spark, "union")
    part = F.when(F.col("lang").isin("en", "fr"), F.col("lang")).otherwise(F.lit("rest"))
    docs.select(F.col("text").alias("value"), part.alias("part")) \
        .write.mode("overwrite").partitionBy("part").text(out)
    frames = [src.concatenated_lines(spark, f"{out}/part={name}", cat, kind="wiki")
              for name, cat in UNION_PARTS]
    return union_all([src.empty_table(spark)] + frames)


def q_split_global(spark, sf):
    """SMP-1 (stable): 80/20 by hash of the key."""
    d = documents(spark, sf)
    return d.select("doc_id", F.when(hash_bucket("doc_id") < TRAIN_PERCENT, "train")
                    .otherwise("test").alias("part"))


def q_split_stratified(spark, sf):
    """SMP-2 exact: 80/20 inside every language."""
    d = documents(spark, sf).select("doc_id", "lang")
    return stratified_split(d, "doc_id", "lang", TRAIN_PERCENT / 100)


def listing(spark, sf) -> DataFrame:
    """A file listing (SRC-13 shape) derived from the documents: one file per
    document in its source folder, size in bytes of its text."""
    d = documents(spark, sf)
    name = F.concat(F.upper("lang"), F.lit("_"), F.col("doc_id").cast("string"), F.lit(".txt"))
    return d.select(F.col("source").alias("folder"), F.concat_ws("/", "source", name).alias("path"),
                    name.alias("name"), F.octet_length("text").cast("bigint").alias("length"), "doc_id")


def q_first9_per_folder(spark, sf):
    """TOP-1: first 9 files (by path) of every folder."""
    return first_n_per_group(listing(spark, sf), "folder", "path", 9) \
        .select("folder", "path", "length", "rank")


def q_selection_totals(spark, sf):
    """AGG-9: number of files, bytes and whole MB of the selection."""
    sel = first_n_per_group(listing(spark, sf), "folder", "path", 9)
    return sel.agg(F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("n_bytes"),
                   F.floor(F.sum("length") / 1048576).alias("n_mb"))


# Folder keywords that mark a class folder (FLT-13) and the
# file-name keyword of FLT-12 (both case-insensitive).
FOLDER_KEYWORDS = ("src1",)
NAME_KEYWORD = "en"


def q_first5_other(spark, sf):
    """FLT-13 + TOP-2: first 5 files of every folder without a keyword."""
    lst = listing(spark, sf)
    pat = "(?i)" + "|".join(FOLDER_KEYWORDS)
    return first_n_per_group(lst.filter(~F.col("folder").rlike(pat)), "folder", "path", 5) \
        .select("folder", "path", "length", "rank")


def q_keyword_files(spark, sf):
    """FLT-12: files whose base name contains the keyword, any case."""
    lst = listing(spark, sf)
    return lst.filter(F.col("name").ilike(f"%{NAME_KEYWORD}%")).select("folder", "path", "length")


def q_select_rows(spark, sf):
    """JOIN-5 (+ SNK-6 input): text rows of the selected files, class = folder."""
    sel = first_n_per_group(listing(spark, sf), "folder", "path", 9).select("doc_id")
    d = documents(spark, sf)
    return semi_join(d, sel, "doc_id").select("doc_id", F.col("source").alias("class"),
                                               F.octet_length("text").alias("n_bytes"))


def q_skip_done(spark, sf):
    """PRJ-5 + FLT-15/JOIN-3: dump files whose key (part before the first '-')
    has no output yet (here: no document labelled quality 0)."""
    d = documents(spark, sf)
    inputs = d.select(F.concat("source", F.lit("-pages-articles.xml.bz2")).alias("name")).distinct() \
        .withColumn("key", F.substring_index("name", "-", 1))
    labelled = spark.read.parquet(f"{sf}/labels.parquet").filter(F.col("quality") == 0)
    done = d.join(labelled, "doc_id", "left_semi") \
        .select(F.col("source").alias("key")).distinct()
    return anti_join(inputs, done, "key")


# Size survey
SIZE_THRESHOLD_MB = 8
FAILED_SOURCES = ("src7", "src13")
DUMP_URL = "https://dumps.example.org/{0}wiki/latest/{0}wiki-latest-pages-articles.xml.bz2"


def size_report_lines(spark, sf) -> DataFrame:
    """A size report as the survey writes it: ``name : bytes`` or an error line,
    then a blank line and a summary line."""
    d = documents(spark, sf)
    per = d.groupBy("source").agg((F.sum(F.octet_length("text")) * 64).alias("b"))
    line = F.when(F.col("source").isin(*FAILED_SOURCES),
                  F.concat(F.lit("Could not download dump for "), F.col("source"))) \
        .otherwise(F.format_string("%-10s: %d", F.col("source"), F.col("b")))
    tail = spark.createDataFrame([("",), ("Total: see above",)], "line string")
    return per.select(line.alias("line")).unionByName(tail)


def q_size_survey(spark, sf):
    """SRC-12 + FLT-14 + AGG-8 + FLT-11 + PRJ-7: one aggregate over the report."""
    out = scratch_path(spark, "sizes")
    size_report_lines(spark, sf).write.mode("overwrite").text(out)
    rep = src.size_report(spark, out)
    mb = F.col("size") / 1048576
    return rep.agg(
        F.count(F.lit(1)).alias("n_attempts"),
        F.count_if(F.col("ok")).alias("n_ok"),
        F.count_if(~F.col("ok")).alias("n_errors"),
        F.sum("size").alias("total_bytes"),
        F.sum(F.when(mb <= SIZE_THRESHOLD_MB, F.col("size"))).alias("selected_bytes"),
        F.count(F.when(mb <= SIZE_THRESHOLD_MB, 1)).alias("n_selected"))


def q_size_list(spark, sf):
    """SRC-12 + PRJ-4 + PRJ-7 + FLT-11 (+ SNK-8 input): the selected dump URLs."""
    out = scratch_path(spark, "sizes")
    size_report_lines(spark, sf).write.mode("overwrite").text(out)
    rep = src.size_report(spark, out).filter("ok")
    mb = F.col("size") / 1048576
    url = F.format_string(DUMP_URL.replace("{0}", "%1$s"), F.col("lang"))
    return rep.filter(mb <= SIZE_THRESHOLD_MB).select("lang", "size", F.round(mb, 6).alias("mb"),
                                                        url.alias("url"))


# Crawl manifest
CRAWL_ID = "CC-MAIN-2016-07"
CRAWL_PREFIX = "https://data.example.org/"
MANIFEST_N = 100


def q_manifest(spark, sf):
    """SRC-11 + TOP-3 + SRC-14: gz manifests per file type built from pages.url,
    read back, trimmed, prefixed, first n lines per type in file order."""
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    out = scratch_path(spark, "manifest")
    rel = F.regexp_replace("url", r"^https?://([^/?#]+).*$", "$1")
    for t in src.CRAWL_TYPES:
        line = F.concat(F.lit(f" crawl-data/{CRAWL_ID}/segments/"), F.col("page_id").cast("string"),
                        F.lit(f"/{t}/"), rel, F.lit(f".{t}.gz "))
        # a range-sorted write: part files are numbered in key order and the
        # reader orders by (file, position), so no single-task write is needed
        (pages.orderBy("page_id").select(line.alias("value"))
         .write.mode("overwrite").option("compression", "gzip").text(f"{out}/{t}.paths"))
    return src.crawl_manifest(spark, out, "all", CRAWL_PREFIX, MANIFEST_N)


PACK_CAP = 200 * 1024


def q_pack_files(spark, sf):
    """WIN-2/WIN-3 + SNK-4: output file of every document block in id order,
    files of at most ~200 KiB (plus one record)."""
    d = documents(spark, sf)
    blocks = d.select("doc_id", F.octet_length(
        sink.doc_block("doc_id", "source", "text", "https://example.org/wiki")).alias("size"))
    cum = sink.running_total(blocks, "doc_id", "size")
    return sink.file_numbers(cum, "cum_bytes", "size", PACK_CAP).select(
        "doc_id", "size", "cum_bytes", "file_no", "dir", "file")


PACK_KEYS = 97        # distinct hashed keys of q_pack_hashed, whatever the table's size


def q_pack_hashed(spark, sf):
    """WIN-3 + SNK-4 in the order of a hashed key that many blocks share (ties by
    id): output file of every document block."""
    d = documents(spark, sf)
    blocks = d.select(F.md5(F.pmod(F.col("doc_id"), F.lit(PACK_KEYS)).cast("string")).alias("key"), "doc_id", F.octet_length(
        sink.doc_block("doc_id", "source", "text", "https://example.org/wiki")).alias("size"))
    cum = sink.running_total(blocks, ["key", "doc_id"], "size")
    return sink.file_numbers(cum, "cum_bytes", "size", PACK_CAP).select(
        "key", "doc_id", "size", "cum_bytes", "file_no", "dir", "file")


def q_pack_write(spark, sf):
    """SNK-4 write: the packed files written (one folder per dir / file) and
    read back: documents, lines and bytes per output file."""
    d = documents(spark, sf)
    blocks = d.select("doc_id", sink.doc_block("doc_id", "source", "text", "https://example.org/wiki").alias("block"))
    sized = blocks.withColumn("size", F.octet_length("block"))
    packed = sink.file_numbers(sink.running_total(sized, "doc_id", "size"),
                               "cum_bytes", "size", PACK_CAP)
    out = scratch_path(spark, "packed")
    sink.write_packed(packed, out, order_col="doc_id")
    back = spark.read.text(out)            # partition discovery: dir, file
    return back.groupBy("dir", "file").agg(F.count_if(F.col("value").startswith("<doc ")).alias("n_docs"),
                                           F.count(F.lit(1)).alias("n_lines"),
                                           F.sum(F.octet_length("value")).alias("n_bytes"))


def q_class_folders(spark, sf):
    """JOIN-5 + SNK-6: the selected files' texts written into one folder per
    class (the source folder), read back: lines and bytes per class."""
    sel = first_n_per_group(listing(spark, sf), "folder", "path", 9).select("doc_id")
    rows = semi_join(documents(spark, sf), sel, "doc_id").select(F.col("text").alias("value"),
                                                                  F.col("source").alias("class"))
    out = scratch_path(spark, "classes")
    sink.write_folders(rows, out, "class")
    back = spark.read.text(out)
    return back.groupBy("class").agg(F.count(F.lit(1)).alias("n_lines"),
                                     F.sum(F.octet_length("value")).alias("n_bytes"))


# Folders with a blank, an accent and a plus, as corpora have them.
SPECIAL = {"en": "others small", "fr": "français", "de": "a+b", "es": "100% [x]"}


def q_special_folders(spark, sf):
    """SRC-1 + SRC-3 over folders whose names are encoded in file paths: lines per
    class from plain folders, and per language from the folders of a partitioned write."""
    d = documents(spark, sf)
    name = F.create_map(*[F.lit(x) for kv in SPECIAL.items() for x in kv])[F.col("lang")]
    out = scratch_path(spark, "special")
    sink.write_folders(d.select(F.col("text").alias("value"), name.alias("folder")), out, "folder")
    by_folder = src.language_corpus(spark, f"{out}/*/*", lang_level=1).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    plain = scratch_path(spark, "special")
    for folder in list(SPECIAL.values())[:3]:
        d.where(name == folder).select("text").write.text(f"{plain}/{folder}")
    classes = {folder: float(i) for i, folder in enumerate(list(SPECIAL.values())[:3])}
    by_class = src.labelled_lines(spark, plain, classes, kind="article").groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    return by_folder.select(F.col("lang").alias("name"), (F.col("n") > 0).cast("long").alias("n")).unionByName(
        by_class.select(F.format_string("class %.0f", "category").alias("name"), "n"))


def q_listing(spark, sf):
    """SRC-13 + TOP-1 + AGG-9 + JOIN-5: a listing of real files without their
    content, the first two files per folder, joined back to their lines."""
    d = documents(spark, sf)
    out = scratch_path(spark, "listing")
    d.repartitionByRange(8, "doc_id").select(F.col("text").alias("value"), F.col("source").alias("folder")).write.partitionBy("folder").text(out)
    files = src.file_listing(spark, out, "*.txt")
    chosen = first_n_per_group(files, "folder", "path", 2)
    lines = spark.read.text(f"{out}/*").select(F.octet_length("value").alias("bytes"), F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+/[^/]+)$", 1).alias("file"))
    names = chosen.select("folder", "length", F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("file"))
    found = lines.join(names, "file").groupBy("folder", "file").agg(F.max("length").alias("length"), (F.sum("bytes") + F.count(F.lit(1))).alias("bytes"))
    return found.groupBy("folder").agg(F.count(F.lit(1)).alias("n_files"), (F.sum("length") == F.sum("bytes")).alias("same_bytes"))


def q_url_list(spark, sf):
    """SNK-8 -> FLT-14: the selected dump URLs written as a list and read back."""
    urls = q_size_list(spark, sf).select("url")
    out = scratch_path(spark, "urls")
    sink.write_list(urls, out, "url")
    return src.text_list(spark, out).select(F.col("value").alias("url"))


def q_folder_concat(spark, sf):
    """SNK-5 + AGG-14: all texts of a folder into one folder output (partitioned
    write, no shuffle for the grouping), read back: lines and bytes per folder."""
    d = documents(spark, sf)
    out = scratch_path(spark, "folders")
    sink.write_folders(d.select(F.col("text").alias("value"), F.col("source").alias("folder")), out, "folder")
    back = spark.read.text(out)          # partition discovery gives the folder column
    return back.groupBy("folder").agg(F.count(F.lit(1)).alias("n_lines"),
                                      F.sum(F.octet_length("value")).alias("n_bytes"))


QUERIES = {
    "q_lines": q_lines,
    "q_article_lines": q_article_lines,
    "q_union_corpora": q_union_corpora,
    "q_split_global": q_split_global,
    "q_split_stratified": q_split_stratified,
    "q_first9_per_folder": q_first9_per_folder,
    "q_selection_totals": q_selection_totals,
    "q_first5_other": q_first5_other,
    "q_keyword_files": q_keyword_files,
    "q_select_rows": q_select_rows,
    "q_skip_done": q_skip_done,
    "q_size_survey": q_size_survey,
    "q_size_list": q_size_list,
    "q_manifest": q_manifest,
    "q_pack_files": q_pack_files,
    "q_folder_concat": q_folder_concat,
    "q_pack_hashed": q_pack_hashed,
    "q_pack_write": q_pack_write,
    "q_class_folders": q_class_folders,
    "q_url_list": q_url_list,
    "q_special_folders": q_special_folders,
    "q_listing": q_listing,
}

# ---------------------------------------------------------------------------
# DuckDB oracles
# ---------------------------------------------------------------------------
_LANGCAT = "(SELECT lang, dense_rank() OVER (ORDER BY lang) - 1 AS c FROM (SELECT DISTINCT lang FROM documents))"
_NONBLANK = f"regexp_matches(line, '[^{S.PY_SPACE[1:-1]}]')"
_FLT1 = f"{_NONBLANK} AND NOT regexp_matches(line, '^{S.PY_SPACE}*(<doc.*>|</doc>){S.PY_SPACE}*$')"
_FLT2 = f"{_NONBLANK} AND NOT regexp_matches(line, '^{S.PY_SPACE}*====')"
_LINES = "(SELECT lang, source AS line FROM documents UNION ALL SELECT lang, unnest(string_split(text, chr(10))) FROM documents)"
_LISTING = """(SELECT source AS folder, source || '/' || upper(lang) || '_' || doc_id || '.txt' AS path,
        upper(lang) || '_' || doc_id || '.txt' AS name, CAST(strlen(text) AS BIGINT) AS length, doc_id FROM documents)"""
_FIRST9 = f"(SELECT *, CAST(row_number() OVER (PARTITION BY folder ORDER BY path) AS INTEGER) AS rank FROM {_LISTING} QUALIFY rank <= 9)"
_SIZES = f"""(SELECT source AS lang, CASE WHEN source IN ('src7', 'src13') THEN NULL ELSE sum(strlen(text)) * 64 END AS size,
        source NOT IN ('src7', 'src13') AS ok FROM documents GROUP BY source)"""
_BLOCK_LEN = """strlen('<doc id="' || doc_id || '" url="https://example.org/wiki?curid=' || doc_id || '" title="' || source
        || '">' || chr(10) || source || chr(10) || chr(10) || text || chr(10) || '</doc>')"""

ORACLE = {
    "q_lines": f"""SELECT line AS fullText, CAST(c AS DOUBLE) AS category FROM {_LINES} JOIN {_LANGCAT} USING (lang)
        WHERE {_FLT1}""",
    "q_article_lines": f"""SELECT line AS fullText, CAST(c AS DOUBLE) AS category FROM {_LINES} JOIN {_LANGCAT} USING (lang)
        WHERE {_FLT2}""",
    "q_union_corpora": f"""SELECT line AS fullText, CASE lang WHEN 'en' THEN 0.0 WHEN 'fr' THEN 1.0 ELSE 2.0 END::DOUBLE AS category
        FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE {_FLT1}""",
    "q_split_global": f"""SELECT doc_id, CASE WHEN {S.bucket('doc_id')} < {TRAIN_PERCENT} THEN 'train' ELSE 'test' END AS part
        FROM documents""",
    "q_split_stratified": f"""SELECT doc_id, lang, CASE WHEN percent_rank() OVER (PARTITION BY lang ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id)
        < {TRAIN_PERCENT / 100} THEN 'train' ELSE 'test' END AS part FROM documents""",
    "q_special_folders": f"""WITH s AS (SELECT * FROM (VALUES ('en', 'others small', 0), ('fr', 'français', 1), ('de', 'a+b', 2), ('es', '100% [x]', NULL)) t(lang, folder, c))
        SELECT folder AS name, 1::BIGINT AS n FROM s WHERE lang IN (SELECT lang FROM documents)
        UNION ALL SELECT 'class ' || c, count(*) FROM (SELECT lang, unnest(string_split(text, chr(10))) AS line FROM documents) JOIN s USING (lang)
        WHERE c IS NOT NULL AND {_FLT2} GROUP BY c""",
    "q_listing": """SELECT source AS folder, least(count(DISTINCT part), 2) AS n_files, true AS same_bytes
        FROM (SELECT source, ntile(8) OVER (ORDER BY doc_id) AS part FROM documents) GROUP BY source""",
    "q_first9_per_folder": f"SELECT folder, path, length, rank FROM {_FIRST9}",
    "q_selection_totals": f"""SELECT count(*) AS n_files, CAST(sum(length) AS BIGINT) AS n_bytes,
        CAST(floor(sum(length) / 1048576) AS BIGINT) AS n_mb FROM {_FIRST9}""",
    "q_first5_other": f"""SELECT folder, path, length, CAST(row_number() OVER (PARTITION BY folder ORDER BY path) AS INTEGER) AS rank
        FROM {_LISTING} WHERE NOT regexp_matches(lower(folder), 'src1') QUALIFY rank <= 5""",
    "q_keyword_files": f"SELECT folder, path, length FROM {_LISTING} WHERE name ILIKE '%en%'",
    "q_select_rows": f"""SELECT doc_id, source AS class, CAST(strlen(text) AS INTEGER) AS n_bytes FROM documents
        WHERE doc_id IN (SELECT doc_id FROM {_FIRST9})""",
    "q_skip_done": """SELECT DISTINCT source || '-pages-articles.xml.bz2' AS name, source AS key FROM documents
        WHERE source NOT IN (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0)""",
    "q_size_survey": f"""SELECT count(*) AS n_attempts, count(*) FILTER (WHERE ok) AS n_ok, count(*) FILTER (WHERE NOT ok) AS n_errors,
        CAST(sum(size) AS BIGINT) AS total_bytes,
        CAST(sum(size) FILTER (WHERE size / 1048576 <= {SIZE_THRESHOLD_MB}) AS BIGINT) AS selected_bytes,
        count(*) FILTER (WHERE size / 1048576 <= {SIZE_THRESHOLD_MB}) AS n_selected FROM {_SIZES}""",
    "q_size_list": f"""SELECT lang, CAST(size AS BIGINT) AS size, round(size / 1048576, 6) AS mb,
        'https://dumps.example.org/' || lang || 'wiki/latest/' || lang || 'wiki-latest-pages-articles.xml.bz2' AS url
        FROM {_SIZES} WHERE ok AND size / 1048576 <= {SIZE_THRESHOLD_MB}""",
    "q_manifest": f"""WITH t AS (SELECT unnest(['warc', 'wat', 'wet']) AS file_type),
        m AS (SELECT file_type, '{CRAWL_PREFIX}crawl-data/{CRAWL_ID}/segments/' || page_id || '/' || file_type || '/'
                  || regexp_replace(url, '^https?://([^/?#]+).*$', '\\1') || '.' || file_type || '.gz' AS url, page_id
              FROM pages CROSS JOIN t)
        SELECT file_type, url FROM m QUALIFY row_number() OVER (PARTITION BY file_type ORDER BY page_id) <= {MANIFEST_N}""",
    "q_pack_files": f"""WITH b AS (SELECT doc_id, CAST({_BLOCK_LEN} AS INTEGER) AS size FROM documents),
        c AS (SELECT doc_id, size, CAST(sum(size) OVER (ORDER BY doc_id) AS BIGINT) AS cum_bytes FROM b),
        f AS (SELECT *, CAST(floor((cum_bytes - size) / {PACK_CAP}) AS BIGINT) AS file_no FROM c)
        SELECT doc_id, size, cum_bytes, file_no,
               chr(65 + CAST(floor(file_no / 100 / 26) % 26 AS INTEGER)) || chr(65 + CAST(floor(file_no / 100) % 26 AS INTEGER)) AS dir,
               printf('wiki_%02d', CAST(file_no % 100 AS INTEGER)) AS file FROM f""",
    "q_pack_hashed": f"""WITH b AS (SELECT md5(CAST(doc_id % {PACK_KEYS} AS VARCHAR)) AS key, doc_id, CAST({_BLOCK_LEN} AS INTEGER) AS size FROM documents),
        c AS (SELECT *, CAST(sum(size) OVER (ORDER BY key, doc_id) AS BIGINT) AS cum_bytes FROM b),
        f AS (SELECT *, CAST(floor((cum_bytes - size) / {PACK_CAP}) AS BIGINT) AS file_no FROM c)
        SELECT key, doc_id, size, cum_bytes, file_no,
               chr(65 + CAST(floor(file_no / 100 / 26) % 26 AS INTEGER)) || chr(65 + CAST(floor(file_no / 100) % 26 AS INTEGER)) AS dir,
               printf('wiki_%02d', CAST(file_no % 100 AS INTEGER)) AS file FROM f""",
    "q_pack_write": f"""WITH b AS (SELECT doc_id, {_BLOCK_LEN} AS size, len(string_split(text, chr(10))) + 4 AS n_lines FROM documents),
        c AS (SELECT *, sum(size) OVER (ORDER BY doc_id) AS cum FROM b),
        f AS (SELECT *, CAST(floor((cum - size) / {PACK_CAP}) AS BIGINT) AS file_no FROM c)
        SELECT chr(65 + CAST(floor(file_no / 100 / 26) % 26 AS INTEGER)) || chr(65 + CAST(floor(file_no / 100) % 26 AS INTEGER)) AS dir,
               printf('wiki_%02d', CAST(file_no % 100 AS INTEGER)) AS file, count(*) AS n_docs,
               CAST(sum(n_lines) AS BIGINT) AS n_lines, CAST(sum(size - (n_lines - 1)) AS BIGINT) AS n_bytes
        FROM f GROUP BY file_no""",
    "q_class_folders": f"""SELECT source AS class, count(*) AS n_lines, CAST(sum(strlen(line)) AS BIGINT) AS n_bytes
        FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents
              WHERE doc_id IN (SELECT doc_id FROM {_FIRST9})) GROUP BY source""",
    "q_url_list": f"""SELECT 'https://dumps.example.org/' || lang || 'wiki/latest/' || lang || 'wiki-latest-pages-articles.xml.bz2' AS url
        FROM {_SIZES} WHERE ok AND size / 1048576 <= {SIZE_THRESHOLD_MB}""",
    "q_folder_concat": """SELECT source AS folder, count(*) AS n_lines, CAST(sum(strlen(line)) AS BIGINT) AS n_bytes
        FROM (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents) GROUP BY source""",
}
