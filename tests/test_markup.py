"""Markup cleaning cases (TXT-*), compared with expected text by hand."""

import pytest

from kiln.functions import markup as M


def run(spark, fn, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r.o for r in df.select("i", fn("t").alias("o")).orderBy("i").collect()]


CASES = [
    ("{{a|{{b|{{c}}}}}} x", " x"),                                   # TXT-1 nested templates
    ("{| class=t\n|-\n| a || b\n|}\ny", "\ny"),                       # TXT-1 table
    ("'''bold''' and ''it'' and '''''both'''''", 'bold and "it" and both'),   # TXT-3
    ("[[Page|label]] [[Plain]] [[w:Foo]] [[Category:X]] [[:Cat:Y]] [[:Foo]]", "label Plain w:Foo :Foo"),  # TXT-4/17 (+ TXT-15 blank runs)
    ("see [https://example.org/x anchor text] and [http://bare]", "see anchor text and "),  # TXT-6
    ("__NOTOC__text__TOC__", "text"),                                 # TXT-7
    ("a &amp;lt; b &#65;&#x42; &copy; &bogus;", "a < b AB © &bogus;"),    # TXT-8 (two decodes in total)
    ("<syntaxhighlight lang=c>&amp;</syntaxhighlight> &amp;", "& &"),  # TXT-9 (clean() still decodes)
    ("a<!-- c\nd -->b", "ab"),                                        # TXT-10
    ("x<br/>y<ref name=a />z", "xyz"),                                 # TXT-11
    ("<b>bo</b><span class=x>sp</span>", "bosp"),                      # TXT-12
    ("a<ref>cite</ref>b<div><div>in</div>out</div>c", "abc"),         # TXT-13 nested
    ("<math>x^2</math> and <math>y</math>; <code>c</code>", "formula_1 and formula_2; codice_1"),  # TXT-14
    ("a" + "<div>L<DIV x=1>" * 25 + "</div>" * 50 + "z", "az"),        # TXT-13 depth 50
    ("a" + "{{t|" * 40 + "x" + "}}" * 40 + "[[File:f|" * 40 + "c" + "]]" * 40 + "b", "ab"),   # TXT-1, TXT-4 depth 40
    ("<li>one<li>two</li> {{open [[File:x|[[inner]] rest", "<li>one {{open [[File:x|inner rest"),  # unbalanced stays
    ("&#x0000000000041;", "A"),                                       # TXT-8 leading zeros
    ("<<q>>\tmany    spaces.....,, x,.", "«q» many spaces..., x."),     # TXT-15
    ("<nowiki>{{kept}}</nowiki>", "<nowiki>{{kept}}</nowiki>"),       # TXT-18
]


def test_clean_wiki_cases(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = {r.i: r.o for r in M.with_clean_wiki(df, "t", "o").collect()}
    assert [(CASES[i][0], got[i]) for i in range(len(CASES))] == CASES


def test_one_expression_gives_the_same(spark):
    src, expected = CASES[0]
    assert run(spark, M.clean_wiki, [src]) == [expected]


def test_clean_html_page(spark):
    html = ("<html><head><title>T &amp; U</title></head><body><nav><ul><li><a href='/x'>x</a></li></ul></nav>"
            "<!-- ad --><div class=ad>ad</div><p><b>Bold</b> text&nbsp;here</p></body></html>")
    assert run(spark, M.clean_markup, [html]) == ["<html><head><title>T & U</title></head><body><nav></nav>"
                                                   "Bold text\xa0here</body></html>"]


COMPACT = [
    ("== H ==\n pre first\n pre second\ntext", [" pre first", "text"]),        # TXT-25
    ("intro\n== A ==\n=== B ===\nbody", ["intro", "body"]),                      # TXT-19 headings not emitted
    ("* item\n{residue after list\n{residue\n(aside)\n---\nok", ["{residue after list", "ok"]),  # Q20, TXT-23/24
    (": indent\n# n\n; d\nafter", ["after"]),                                    # TXT-21/22
    ("++Page title++\nx", ["Page title.", "x"]),                                 # TXT-20
    ("\n\nonly\n\n", ["only"]),                                                  # TXT-26
]


@pytest.mark.parametrize("src,expected", COMPACT)
def test_compact_cases(spark, src, expected):
    assert run(spark, M.compact, [src]) == [expected]


def test_residual_markup_counts(spark):
    """Balanced markup leaves nothing at any depth; what has no partner is counted."""
    texts = ["{{" * 7 + "x" + "}}" * 7, "{{" * 7 + "x" + "}}" * 5, "plain"]
    out = run(spark, lambda c: M.residual_markup(M.clean_wiki(c)), texts)
    assert out == [0, 2, 0]


SECTIONS = [
    ("intro\n== A ==\ntext a\n== B ==\n=== C ===\n== D ==\nd text", ["intro", "A.", "text a", "D.", "d text"]),
    ("== Why? ==\n=== Sub ===\nx", ["Why?", "Sub.", "x"]),      # level order, '?' keeps no dot
    ("== A ==\n=== B ===\n== C ==\ny", ["C.", "y"]),             # deeper pending heading cleared
]


@pytest.mark.parametrize("src,expected", SECTIONS)
def test_compact_keep_sections(spark, src, expected):
    assert run(spark, lambda c: M.compact(c, keep_sections=True), [src]) == [expected]


def test_large_page(spark):
    """A page of 1 MB with thousands of nested blocks is cleaned in one scan."""
    import time
    block = "{{a|{{b}}|[[File:x|[[y]]]]}}<div><div>in</div></div>word "
    page = block * 18_000
    t0 = time.time()
    df = spark.createDataFrame([(1, page)], "i int, t string")
    out = M.with_clean_wiki(df, "t", "o").first().o
    assert out == "word " * 18_000 and len(page) > 1_000_000
    assert time.time() - t0 < 60


LIST_PAGE = """++Title++
== A ==
* one
** two
*# num
# x
text after
plain
== B ==
; term
: skipped
;: both
last
more
=== C ===
 pre
*
**\x20
(tail)"""


def test_lists_are_dropped_kept_as_bullets_or_as_html(spark):
    def lines(**how):
        return run(spark, lambda c: M.compact(c, **how), [LIST_PAGE])[0]
    assert lines() == ["Title.", "text after", "plain", "last", "more", " pre", "(tail)"]
    # an item clears the headings, so the plain line of that section goes
    assert lines(lists="bullets") == ["Title.", "A.", "- one", "- two", "1. num", "1. x", "text after", "B.", "- term", "- both", "last",
                                      " pre", "(tail)"]
    assert lines(lists="html") == [
        "Title.", "<h2>A</h2>", "<ul>", "<li>one</li>", "<ul>", "<li>two</li>", "</ul>", "<ol>", "<li>num</<li>", "</ul>", "<ol>", "</ol>",
        "<li>x</<li>", "text after", "</ul>", "plain", "<h2>B</h2>", "<dl>", "<dt>term</dt>", "<dl>", "<dd>both</dd>", "last", "</dl>", "</dl>",
        "more", "<h3>C</h3>", " pre", "<ul>", "<ul>", "(tail)", "</ul>", "</ul>"]
    deep = "*" * 5
    assert run(spark, lambda c: M.compact(c, lists="bullets"), [f"{deep} x\n### y"])[0] == ["-    x", "1. y"]


def test_compact_joins_pieces_and_is_linear(spark):
    import time
    n = 3 * M.SEGMENT + 5
    text = "\n".join(["== H =="] + [f"line {i}" for i in range(n)] + ["* a", "end"])
    assert run(spark, lambda c: M.compact(c, lists="html"), [text])[0] == ["<h2>H</h2>"] + [f"line {i}" for i in range(n)] + [
        "<ul>", "<li>a</li>", "end", "</ul>"]
    page = "* item of a list with words\ntext line of some more words\n" * 20_000     # 1.1 MB, 40,000 lines
    t0 = time.time()
    assert len(run(spark, lambda c: M.compact(c, lists="html"), [page])[0]) == 20_000 * 4
    assert time.time() - t0 < 60
    assert run(spark, M.compact, ["", None]) == [[], None]


OPTIONS = [
    (dict(links=True), "[[A b#c|x| label ]]s [[w:Z]] [[Category:X]] [http://e.org/é a b]",
     '<a href="A%20b%23c">label</a>s <a href="w%3AZ">w:Z</a> <a href="http%3A//e.org/%C3%A9">a b</a>'),          # TXT-4, 6, 17
    (dict(links=True), "[http://e.org http://e.org/a/b.jpg] <a href='x'>kept</a> <b>bold</b>",
     """<a href="http%3A//e.org"><img src="http://e.org/a/b.jpg" alt=""></a> <a href='x'>kept</a> bold"""),
    ({}, "[http://e.org http://e.org/a/b.jpg]. <a href='x'>kept</a>", ". kept"),                                    # image anchor
    (dict(to_html=True), "'''b''' ''i'' '''''bi''''' ''open & [[P]]", 'b i bi "open &amp; &lt;a href="P"&gt;P&lt;/a&gt;'),  # TXT-3, 16
    (dict(namespaces=("q",)), "[[q:A|a]] [[w:B|b]] [[q:C]]", "a q:C"),                                               # FLT-17
    (dict(blanks=True), "a , b ( c ) [ d ] « e » : f .", "a, b (c) [d] «e»: f."),                                    # Q10
]


@pytest.mark.parametrize("options,src,expected", OPTIONS)
def test_clean_wiki_options(spark, options, src, expected):
    df = spark.createDataFrame([(src,), (None,), ("",)], "t string")
    assert [r.o for r in M.with_clean_wiki(df, "t", "o", **options).select("o").collect()] == [expected, None, ""]


def test_wiki_text_writes_tags(spark):
    df = spark.createDataFrame([("'''b''' ''i'' [[P|l]]",)], "t string")
    assert M.with_wiki_text(df, "t", "o", html=True, links=True).first().o == '<b>b</b> <i>i</i> <a href="P">l</a>'


def test_percent_encoding_is_that_of_urls(spark):
    from urllib.parse import quote
    texts = ["a b", "~-_.!*'()", "ö/文", "%&+=?#", ""]
    assert run(spark, M.percent_encoded, texts) == [quote(t) for t in texts]


def test_python_gets_short_batches(spark):
    """A task's rows come to Python in batches of bounded length."""
    from kiln.session import ARROW_ROWS
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "10000")
        df = spark.range(3).selectExpr("id", "concat('{{t|', id, '}}text ', id) AS w")
        out = M.with_clean_wiki(df, "w", "clean").orderBy("id").collect()
        assert int(spark.conf.get(key)) == ARROW_ROWS
        assert [r["clean"].strip() for r in out] == ["text 0", "text 1", "text 2"]
    finally:
        spark.conf.set(key, before)
