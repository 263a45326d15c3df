"""Source edge cases: WET line ends and compression, record
markers inside bodies, block reader without end tag, dump edge pages,
file listing without content, size report lines, manifests."""

import gzip
import os

import pytest
from pyspark.sql import functions as F

from kiln.session import scratch_path
from kiln.sources import crawl, text as src, wiki


def _local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def _write(path, name, data: bytes, gz=False):
    os.makedirs(_local(path), exist_ok=True)
    p = os.path.join(_local(path), name)
    with (gzip.open(p, "wb") if gz else open(p, "wb")) as f:
        f.write(data)
    return p


WET = ("WARC/1.0\nWARC-Type: warcinfo\nContent-Length: 3\n\nabc\n\n"
       "WARC/1.0\nWARC-Type: conversion\nWARC-Target-URI: http://a.example/\nContent-Type: text/plain\n"
       "Content-Length: 20\n\nfirst line\nWARC-like body line\nsee WARC/1.0 inline\n\n"
       "WARC/1.0\nWARC-Type: conversion\nWARC-Target-URI: http://b.example/x?y=1\nContent-Length: 2\n\nhi\n\n")


def test_wet_lf_crlf_gz(spark):
    for eol, gz in (("\n", False), ("\r\n", False), ("\n", True), ("\r\n", True)):
        d = scratch_path(spark, "wet")
        _write(d, "a.wet.gz" if gz else "a.wet", WET.replace("\n", eol).encode(), gz=gz)
        rows = {r.URI: r.text for r in crawl.wet_documents(spark, d).collect()}
        assert set(rows) == {"http://a.example/", "http://b.example/x?y=1"}
        assert rows["http://b.example/x?y=1"] == "hi"
        # Q2: a body line starting with WARC is kept; an inline marker does not split
        assert rows["http://a.example/"].replace("\r", "") == "first line\nWARC-like body line\nsee WARC/1.0 inline"


def test_wet_compat_fuses_lines(spark):
    d = scratch_path(spark, "wet")
    _write(d, "a.wet", WET.encode())
    rows = {r.URI: r.text for r in crawl.wet_documents(spark, d, compat=True).collect()}
    # Q1: the reference form has no separator and drops WARC-prefixed body lines
    assert rows["http://a.example/"] == "first linesee WARC/1.0 inline"


def test_warc_records_headers(spark):
    d = scratch_path(spark, "warc")
    _write(d, "a.warc", WET.encode())
    recs = crawl.warc_records(spark, d).collect()
    assert len(recs) == 3
    info = [r for r in recs if r.url is None][0]
    assert info.header["WARC-Type"] == "warcinfo" and info.payload.startswith("abc")


def test_doc_blocks_reader_flags_corrupt(spark):
    d = scratch_path(spark, "docs")
    data = ('<doc id="1" url="u1" title="A">\nA\n\nbody one\n</doc>\n'
            '<doc id="2" url="u2" title="B">\nB\n\nno end tag\n'
            '<doc id="3" url="u3" title="C">\nC\n\n\n</doc>\n')
    _write(d + "/en/AA", "wiki_00", data.encode())
    recs = {r.id: r for r in src.article_records(spark, f"{d}/*/*/*", lang_level=2).collect()}
    assert recs["1"].body == "A\n\nbody one\n" and not recs["1"].corrupt and recs["1"].lang == "en"
    assert recs["2"].corrupt                       # Q15: missing end -> flagged
    assert "3" not in recs                         # swallowed into record 2, visible through the flag
    assert recs["1"].url == "u1" and recs["1"].title == "A"


DUMP = """<mediawiki>
  <siteinfo>
    <base>https://x.example.org/wiki/Main_Page</base>
    <namespaces>
      <namespace key="0" />
      <namespace key="10">Template</namespace>
    </namespaces>
  </siteinfo>
  <page>
    <title>One &amp; Only</title>
    <id>1</id>
    <revision><id>11</id><text xml:space="preserve">a &lt;b&gt;
second line</text></revision>
  </page>
  <page>
    <title>One again</title>
    <ns>0</ns>
    <id>1</id>
    <revision><id>12</id><text>dup</text></revision>
  </page>
  <page>
    <title>Empty</title>
    <ns>0</ns>
    <id>2</id>
    <revision><id>21</id><text bytes="0" /></revision>
  </page>
  <page>
    <title>Go</title>
    <ns>0</ns>
    <id>3</id>
    <redirect title="One &amp; Only" />
    <revision><id>31</id><text>#REDIRECT [[One]]</text></revision>
  </page>
  <page>
    <title>Template:T</title>
    <ns>10</ns>
    <id>4</id>
    <revision><id>41</id><text>{{{1}}}</text></revision>
  </page>
  <page>
    <title>Dis</title>
    <ns>0</ns>
    <id>5</id>
    <revision><id>51</id><text>x
{{Disambiguation|y}}</text></revision>
  </page>
</mediawiki>
"""


def test_dump_pages_edge_cases(spark):
    d = scratch_path(spark, "dump")
    _write(d, "dump.xml", DUMP.encode())
    pages = wiki.dump_pages(spark, d)
    first = wiki.first_by_id(pages)
    arts = {r.id: r for r in wiki.article_pages(first).collect()}
    assert arts[1].title == "One & Only" and arts[1].text == "a <b>\nsecond line" and arts[1].ns == "0"
    assert arts[1].revid == 11                     # WIN-1: first copy wins
    assert arts[2].text == ""                      # <text/>
    assert 3 not in arts and 4 not in arts         # redirect, template namespace
    assert 5 in arts and 5 not in {r.id for r in wiki.article_pages(first, drop_disambiguation=True).collect()}
    red = {r.id: r.redirect for r in pages.filter("redirect IS NOT NULL").collect()}
    assert red == {3: "One & Only"}
    assert [r.title for r in wiki.template_pages(first).collect()] == ["Template:T"]
    ns = {r.key: r.name for r in wiki.namespaces(spark, d).collect()}
    assert ns == {"0": "", "10": "Template"}
    assert wiki.site_info(spark, d).first().base == "https://x.example.org/wiki"


def test_first_by_id_keeps_texts_out_of_sorts_and_aggregates(spark):
    d = scratch_path(spark, "dump")
    page = "<page><title>t{i}</title><id>{id}</id><revision><id>9</id><text>body {i}</text></revision></page>\n"
    for f in range(3):
        _write(d, f"part{f}.xml", "".join(page.format(i=f * 50 + i, id=7 if i % 3 == 0 else f * 50 + i + 100) for i in range(50)).encode())
    pages = wiki.dump_pages(spark, d)
    for bound in (10, 0):          # by broadcast, and by shuffle
        got = wiki.first_by_id(pages, bound)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Aggregate" not in plan and plan.count("from_xml") <= 1
        assert sorted(r.id for r in got.collect()) == [7] + sorted({f * 50 + i + 100 for f in range(3) for i in range(50) if i % 3})
        assert [r.text for r in got.where("id = 7").collect()] == ["body 0"]
    keys = pages.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "from_xml" not in keys           # the keys need no parsed page


def test_site_info_reads_one_record(spark):
    d = scratch_path(spark, "dump [x]")
    head = ("<mediawiki><siteinfo><base>https://y.example.org/a/b</base><namespaces><namespace key=\"10\">Vorlage</namespace>"
            "</namespaces></siteinfo>")
    page = "<page><title>t</title><id>1</id><revision><id>2</id><text>x</text></revision></page>\n"
    _write(d, "a.xml", (head + page * 3).encode())
    _write(d, "b.xml", (page * 3).encode())
    assert [tuple(r) for r in wiki.namespaces(spark, wiki.escape_glob(d)).collect()] == [("https://y.example.org/a", "10", "Vorlage")]
    none = scratch_path(spark, "dump")
    _write(none, "a.xml", (page * 3).encode())
    assert wiki.site_info(spark, none).count() == 0


def test_medline_title_stays_string(spark):
    d = scratch_path(spark, "medline")
    xml = ("<MedlineCitationSet><MedlineCitation><Article><ArticleTitle>T1</ArticleTitle></Article></MedlineCitation>"
           "<MedlineCitation><Article><ArticleTitle>Two</ArticleTitle><Abstract><AbstractText>a1</AbstractText>"
           "<AbstractText>a2</AbstractText></Abstract></Article><OtherAbstract><AbstractText>o</AbstractText>"
           "</OtherAbstract></MedlineCitation></MedlineCitationSet>")
    _write(d, "cits.xml", xml.encode())
    rows = {r.title: r for r in wiki.medline_citations(spark, d).select(
        "*", wiki.citation_text().alias("text")).collect()}
    assert rows["T1"].text == "T1" and rows["T1"].file == "cits"
    assert rows["Two"].text == "Two\n\na1o"


def test_file_listing_prunes_content(spark):
    d = scratch_path(spark, "files")
    _write(d + "/cancer", "a.txt", b"x" * 10)
    _write(d + "/other", "b.txt", b"y" * 3)
    lst = src.file_listing(spark, d, "*.txt")
    plan = lst._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema:")[-1].split("\n")[0]
    assert sorted((r.folder, r.name, r.length) for r in lst.collect()) == [("cancer", "a.txt", 10), ("other", "b.txt", 3)]


def test_size_report_and_lists(spark):
    d = scratch_path(spark, "sizes")
    _write(d, "wp_size.txt", b"en        : 1000\nCould not download dump for xx\nde : 20\n\nTotal 2\n")
    rep = {r.lang: (r.size, r.ok) for r in src.size_report(spark, d).collect()}
    assert rep == {"en": (1000, True), "xx": (None, False), "de": (20, True)}   # Q11: blank line skipped


def test_manifest_types_and_order(spark):
    d = scratch_path(spark, "man")
    for t in ("warc", "wet"):
        _write(d, f"{t}.paths.gz", "".join(f"  p/{t}/{i}.gz \n" for i in range(5)).encode(), gz=True)
    out = src.crawl_manifest(spark, d, "wet", "https://h/", 3).collect()
    assert [r.url for r in out] == ["https://h/p/wet/0.gz", "https://h/p/wet/1.gz", "https://h/p/wet/2.gz"]
    try:
        src.crawl_manifest(spark, d, "bogus", "x")
        assert False
    except ValueError:
        pass


def test_extraction_totals_observed(spark):
    d = scratch_path(spark, "dump")
    _write(d, "dump.xml", DUMP.encode())
    pages, obs = wiki.with_extraction_totals(wiki.dump_pages(spark, d))
    n = wiki.article_pages(pages).count()
    assert n == 4                                   # pages 1, 1 (copy), 2, 5
    assert obs.get == {"pages": 6, "templates": 1}  # AGG-16, no extra pass


def test_warc_versions_and_repeated_headers(spark):
    d = scratch_path(spark, "warc")
    rec = "WARC/{}\r\nWARC-Type: response\r\nWARC-Target-URI: http://{}/\r\nWARC-Concurrent-To: <a>\r\nWARC-Concurrent-To: <b>\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    _write(d, "a.warc", (rec.format("1.1", "x") + rec.format("1.1", "y") + rec.format("1.0", "z")).encode())
    recs = {r.url: r for r in crawl.warc_records(spark, d).collect()}
    assert sorted(recs) == ["http://x/", "http://y/", "http://z/"]
    assert all(r.header["WARC-Concurrent-To"] == "<a>, <b>" and r.payload.strip() == "hi" for r in recs.values())
    assert {r.URI: r.text for r in crawl.wet_documents(spark, d).collect()} == dict.fromkeys(recs, "hi")


def test_strict_reader_names_the_broken_record(spark):
    d = scratch_path(spark, "docs")
    _write(d + "/en/AA", "wiki_00", b'<doc id="1" url="u1" title="A">\nA\n\nx\n</doc>\n')
    assert [r.corrupt for r in src.article_records(spark, f"{d}/*/*/*", fail_fast=True).collect()] == [False]
    _write(d + "/en/AA", "wiki_01", b'<doc id="2" title="no url">\nB\n\nx\n</doc>\n')
    with pytest.raises(Exception, match=r"malformed record in .*wiki_01: <doc id=\"2\""):
        src.article_records(spark, f"{d}/*/*/*", fail_fast=True).collect()


def test_folder_names_are_decoded_and_unknown_folders_fail(spark):
    d = scratch_path(spark, "folders")
    for folder in ("others small", "été", "a+b", "100%"):
        _write(f"{d}/{folder}", "f.txt", b"one line\n")
    labels = {"others small": 0.0, "été": 1.0, "a+b": 2.0, "100%": 3.0}
    got = src.labelled_lines(spark, d, labels, kind="article")
    assert sorted(r.category for r in got.collect()) == [0.0, 1.0, 2.0, 3.0]
    with pytest.raises(Exception, match="no class for the folder"):
        src.labelled_lines(spark, d, {"o*": 0.0}, kind="article").collect()
    assert {r.folder for r in src.file_listing(spark, d).collect()} == set(labels)


def test_crawl_text_needs_no_header_map(spark):
    from kiln.sources import crawl
    d = scratch_path(spark, "wet")
    _write(d, "a.wet", (crawl.warcinfo_record() + "WARC/1.0\nWARC-Target-URI: http://x\nA: 1\nA: 2\n\nWARC-Target-URI: not this\n\n").encode())
    docs = crawl.wet_documents(spark, d)
    assert [tuple(r) for r in docs.collect()] == [("http://x", "WARC-Target-URI: not this")]
    assert "map_from_arrays" not in docs._jdf.queryExecution().optimizedPlan().toString()
    records = crawl.warc_records(spark, d)
    assert records._jdf.queryExecution().optimizedPlan().toString().count("map_from_arrays") == 1
    assert {r.url: r.header.get("A") for r in records.collect()} == {None: None, "http://x": "1, 2"}


def test_template_definitions(spark):
    """The last page of a title counts, redirects apart; prefixes come from the first
    title of each namespace that has one; a page without content is no definition."""
    rows = [(0, "10", "Plain", "no prefix"), (1, "10", "Vorlage:A", "old"), (2, "10", "Other:B", "b<noinclude>x"), (3, "828", "Modul:M", "m"),
            (4, "10", "Vorlage:A", "new <!-- c -->"), (5, "10", "Vorlage:A", "#Redirect [[Vorlage:B]]"), (6, "10", "Vorlage:C", "<noinclude>all"),
            (7, "0", "Vorlage:D", "an article"), (8, "10", "Vorlage:E", None), (9, "10", "Vorlage:F", "")]
    pages = spark.createDataFrame([(t, ns, x, "f", 0, i) for i, ns, t, x in rows], "title string, ns string, text string, file string, block long, pos long")
    assert sorted(tuple(r) for r in wiki.template_prefixes(pages).collect()) == [("10", "Vorlage:"), ("828", "Modul:")]
    got = {tuple(r) for r in wiki.template_definitions(pages).collect()}
    assert got == {("Plain", "Plain", None, "no prefix"), ("Vorlage:A", "A", None, "new "), ("Vorlage:A", "A", "Vorlage:B", None),
                   ("Other:B", "Other:B", None, "b"), ("Modul:M", "M", None, "m")}
    assert wiki.template_definitions(pages.limit(0)).count() == 0
