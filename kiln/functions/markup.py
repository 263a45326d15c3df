"""Wiki / HTML markup cleaning as column expressions (TXT-1..32).

Steps are native regex or array expressions on the text column, except where
markup nests (:mod:`kiln.functions.nested`, Arrow batches).  The steps are declared as data (:func:`html_steps`,
:func:`wiki_steps`) so the same chain can be checked against another engine.

Nested markup (``{{…}}``, tables, dropped elements, links) is removed at any
depth in one scan; unbalanced markup stays visible (:func:`residual_markup`
counts it) instead of being hidden.
"""

from __future__ import annotations

import html.entities

from pyspark.sql import Column
from pyspark.sql import functions as F

from kiln.functions import nested
from kiln.session import small_batches

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour)
# ---------------------------------------------------------------------------
SELF_CLOSING_TAGS = ("br", "hr", "nobr", "ref", "references", "nowiki")
KEEP_CONTENT_TAGS = ("abbr", "b", "big", "blockquote", "center", "cite", "em", "font", "h1", "h2", "h3",
                     "h4", "hiero", "i", "kbd", "p", "plaintext", "s", "span", "strike", "strong", "tt",
                     "u", "var")
DROP_ELEMENTS = ("gallery", "timeline", "noinclude", "pre", "table", "tr", "td", "th", "caption", "div",
                 "form", "input", "select", "option", "textarea", "ul", "li", "ol", "dl", "dt", "dd",
                 "menu", "dir", "ref", "references", "img", "imagemap", "source", "small", "sub", "sup",
                 "indicator")
PLACEHOLDERS = (("math", "formula"), ("code", "codice"))
ACCEPTED_NAMESPACES = ("w", "wiktionary", "wikt")
URL_PROTOCOLS = ("bitcoin:", "ftp://", "ftps://", "geo:", "git://", "gopher://", "http://", "https://",
                 "irc://", "ircs://", "magnet:", "mailto:", "mms://", "news:", "nntp://", "redis://",
                 "sftp://", "sip:", "sips:", "sms:", "ssh://", "svn://", "tel:", "telnet://", "urn:",
                 "worldwind://", "xmpp:", "//")
SWITCHES = ("__NOTOC__", "__FORCETOC__", "__TOC__", "__NEWSECTIONLINK__", "__NONEWSECTIONLINK__",
            "__NOGALLERY__", "__HIDDENCAT__", "__NOCONTENTCONVERT__", "__NOCC__", "__NOTITLECONVERT__",
            "__NOTC__", "__START__", "__END__", "__INDEX__", "__NOINDEX__", "__STATICREDIRECT__",
            "__DISAMBIG__")
# What makes an anchor an image address, and where an external link's parts end.
IMAGE_ANCHOR = r"https?://[^\]\[<>\"\x00-\x20\x7f\s]+/[A-Za-z0-9_.,~%\-+&;#*?!=()@\x{80}-\x{ff}]+\.(?:gif|png|jpg|jpeg)"
LINK_URL = r"[^\]\[<>\"\x00-\x20\x7f\s]+"
LINK_ANCHOR = r"[^\]\[\x00-\x08\x0a-\x1f]*?"
# Named character references: the HTML 4 table of the Python standard library
# (252 names), built from that rule rather than written out.
ENTITY_NAMES = dict(sorted(html.entities.name2codepoint.items()))

ENTITY = r"&#?\w+;"
PROTECT = "\x02"     # marks accepted link namespaces while namespaced links are dropped
BRACE_MASK = "\x03"  # stands for '{' inside <nowiki> while templates are dropped


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _alt(words) -> str:
    return "|".join(words)


def _proto_alt() -> str:
    return "|".join(p.replace("/", r"/") for p in URL_PROTOCOLS)


# A step is (pattern, replacement-with-$n-groups, rounds, guard); a callable in
# place of the pattern takes the column and handles nesting itself.
def html_steps(engine: str = "spark", links: bool = False):
    """clean() part: comments, self-closing tags, tags kept with content,
    dropped elements, in that order.

    ``spark``: dropped elements of any depth in one scan (:mod:`nested`).
    ``re2``: one lazy pattern per element (for engines without back references);
    both give the same text on markup without same-name nesting.  With ``links`` the
    ``<a>`` tags stay."""
    tags = _alt(KEEP_CONTENT_TAGS + (() if links else ("a",)))
    steps = [
        (r"(?s)<!--.*?-->", "", 1, "<!--"),                                                # TXT-10
        (rf"(?is)<\s*(?:{_alt(SELF_CLOSING_TAGS)})\b[^>]*/\s*>", "", 1, "/"),               # TXT-11
        (rf"(?is)<(?:{tags})\b.*?>", "", 1, "<"),                                          # TXT-12
        (rf"(?i)</\s*(?:{tags})>", "", 1, "</"),
    ]
    if engine == "spark":                                                                  # TXT-13
        steps.append((lambda c: nested.mapped(c, c.rlike(rf"(?i)<\s*(?:{_alt(DROP_ELEMENTS)})\b"),
                                              lambda t: nested.without_elements(t, DROP_ELEMENTS)), "", 1, None))
    else:
        for t in DROP_ELEMENTS:
            steps.append((rf"(?is)<\s*{t}\b[^>/]*>.*?<\s*/\s*{t}>", "", 1, None))
    return steps


# TXT-15 clean-up, after entity decoding and placeholders.
CLEANUP_STEPS = [
    ("<<", "«", 0, None), (">>", "»", 0, None), ("\t", " ", 0, None),   # 0 = literal replace
    (r" {2,}", " ", 1, "  "),
    (r"\.{4,}", "...", 1, "...."),
    (r"\n[^\p{L}\p{N}_]+?\n", "\n", 1, "\n"),                           # punctuation-only lines
    (",,", ",", 0, None), (",.", ".", 0, None),
]


# Q10: blanks before closing and after opening punctuation (an option).
BLANK_STEPS = [(r" ([,:.)\]»])", "$1", 1, " "), (r"([\[(«]) ", "$1", 1, " ")]


def percent_encoded(c) -> Column:
    """UTF-8 percent encoding; letters, digits, ``_.-~/`` stay."""
    out = F.url_encode(c)
    for a, b in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def _kept_external(c) -> Column:
    """TXT-6: ``[url anchor]`` as ``<a href>``; an anchor that is an image address
    becomes that image."""
    link = rf"(?is)\[((?:{_proto_alt()}){LINK_URL})\s*({LINK_ANCHOR})\]"

    def one(m):
        anchor = F.regexp_extract(m, link, 2)
        shown = F.when(anchor.rlike(rf"(?i)^{IMAGE_ANCHOR}$"), F.concat(F.lit('<img src="'), anchor, F.lit('" alt="">'))).otherwise(anchor)
        return F.concat(F.lit('<a href="'), percent_encoded(F.regexp_extract(m, link, 1)), F.lit('">'), shown, F.lit("</a>"))
    return map_matches(c, link, one)


def wiki_steps(engine: str = "spark", depth: int = 5, html: bool = False, links: bool = False, namespaces=ACCEPTED_NAMESPACES):
    """wiki2text part before the HTML decode: templates and tables (TXT-1),
    quotes (TXT-3), internal links with the namespace rule (TXT-4, TXT-17),
    external links (TXT-6), behaviour switches (TXT-7).

    ``html`` writes emphasis as ``<b>`` and ``<i>``; ``links`` keeps internal and
    external links as ``<a href>`` (``spark`` only); links into ``namespaces`` are
    accepted, into others dropped (FLT-17).

    ``spark``: nested markup of any depth in one scan (:mod:`nested`); ``re2``:
    ``depth`` rounds, innermost first, and no image anchors."""
    q2, q3, q5 = "''", "'''", "'''''"
    if engine == "spark":
        templates = [(lambda c: nested.mapped(c, (F.instr(c, "{{") > 0) | (F.instr(c, "{|") > 0), nested.without_templates), "", 1, None)]
        inside = [(lambda c: nested.mapped(c, F.instr(c, "[[") > 0, lambda t: nested.link_text(t, PROTECT, links)), "", 1, None)]
    else:
        templates = [(r"\{\{[^{}]*\}\}", "", depth, "{{"), (r"(?s)\{\|[^{}]*?\|\}", "", depth, "{|")]
        inside = [(rf"\[\[:?[^\[\]|:{PROTECT}]+:[^\[\]]*\]\]", "", 1, "[["),
                 (r"\[\[(?:[^\[\]|]*\|)*([^\[\]|]*)\]\]", "$1", 1, "[[")] * 3
    if html:
        quotes = [(rf"{q5}(.*?){q5}", "<b>$1</b>", 1, q5), (rf"{q3}(.*?){q3}", "<b>$1</b>", 1, q3),
                  (rf"{q2}(.*?){q2}", "<i>$1</i>", 1, q2)]
    else:
        quotes = [(rf"{q5}(.*?){q5}", "$1", 1, q5),
                  (rf"{q3}(.*?){q3}", "$1", 1, q3),
                  (rf"{q2}\"([^\"]*?)\"{q2}", "\"$1\"", 1, q2 + '"'),
                  (rf"{q2}(.*?){q2}", "\"$1\"", 1, q2),
                  (r"\"\"([^\"]*?)\"\"", "\"$1\"", 1, '""')]
    outside = ([(_kept_external, "", 1, None)] if links else
               ([(rf"(?is)\[(?:{_proto_alt()}){LINK_URL}\s+{IMAGE_ANCHOR}\]", "", 1, "[")] if engine == "spark" else []) +
               [(rf"(?is)\[(?:{_proto_alt()}){LINK_URL}\s*({LINK_ANCHOR})\]", "$1", 1, "[")])
    return [
        *templates,                                                                        # TXT-1
        *quotes,                                                                           # TXT-3
        (q3, "", 0, None), (q2, "\"", 0, None),
        (rf"\[\[(:?)({_alt(namespaces)}):", f"[[$1{PROTECT}$2:", 1, "[["),         # TXT-17
        *inside,                                                                           # TXT-4
        (PROTECT, "", 0, None),
        *outside,                                                                          # TXT-6
        ("__(?:" + "|".join(w.strip("_") for w in SWITCHES) + ")__", "", 1, "__"),         # TXT-7
    ]


def _one(c, pattern, repl, rounds):
    if callable(pattern):
        return pattern(c)
    if rounds == 0:
        return F.replace(c, F.lit(pattern), F.lit(repl))
    return F.regexp_replace(c, pattern, repl)


def apply_steps(c, steps) -> Column:
    """All steps as one expression (no guards)."""
    c = _c(c)
    for pattern, repl, rounds, _guard in steps:
        for _ in range(max(rounds, 1)):
            c = _one(c, pattern, repl, rounds)
    return c


def guarded_stages(steps):
    """One stage per step and round, skipped when its guard is absent (a
    literal that must occur, or ``("rlike", pattern)``).  Meant for
    :func:`with_stages`: the guard reads the stage's input column twice, so the
    stages stay separate projections and later rounds of nested removal cost a
    substring test once nothing is left."""
    out = []
    for pattern, repl, rounds, guard in steps:
        for _ in range(max(rounds, 1)):
            def st(c, pattern=pattern, repl=repl, rounds=rounds, guard=guard):
                if guard is None:
                    return _one(c, pattern, repl, rounds)
                cond = c.rlike(guard[1]) if isinstance(guard, tuple) else (F.instr(c, guard) > 0)
                return F.when(cond, _one(c, pattern, repl, rounds)).otherwise(c)
            st.barrier = callable(pattern)
            out.append(st)
    return out


def _guard(lit: str, fn):
    return lambda c: F.when(F.instr(c, lit) > 0, fn(c)).otherwise(c)


def map_matches(c, pattern: str, fn, with_index: bool = False) -> Column:
    """Replace every match of ``pattern`` by ``fn(match)`` (or ``fn(match, i)``
    with the 0-based match number), in one left-to-right pass: the text is
    split at the matches and rebuilt with the mapped matches in between."""
    c = _c(c)
    parts = F.split(c, pattern, -1)
    found = F.regexp_extract_all(c, F.lit(pattern), 0)
    mapped = F.transform(found, (lambda x, i: fn(x, i)) if with_index else (lambda x: fn(x)))
    return F.array_join(F.zip_with(parts, F.concat(mapped, F.array(F.lit(""))),
                                   lambda p, r: F.concat(p, r)), "")


def _entity_map() -> Column:
    return F.create_map(*[x for k, v in ENTITY_NAMES.items() for x in (F.lit(k), F.lit(chr(v)))])


def decode_entity(e: Column) -> Column:
    """One character reference -> its character; unknown ones unchanged."""
    dec = F.regexp_extract(e, r"^&#([0-9]+);$", 1)
    hx = F.regexp_extract(e, r"^&#[xX]([0-9a-fA-F]+);$", 1)
    name = F.regexp_extract(e, r"^&(\w+);$", 1)
    code = (F.when(dec != "", dec.try_cast("bigint"))
            .when(hx != "", F.when(F.length(F.ltrim(F.lit("0"), hx)) <= 8, F.conv(hx, 16, 10).try_cast("bigint"))))
    valid = (code >= 0) & (code <= 0x10FFFF) & ~((code >= 0xD800) & (code <= 0xDFFF))
    char = F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))
    return F.coalesce(char, F.when(name != "", _entity_map()[name]), e)


def unescape(c) -> Column:
    """TXT-8: decode character references and named entities in one pass
    (``&amp;lt;`` gives ``&lt;``, not ``<``)."""
    return map_matches(c, ENTITY, decode_entity)


def placeholders(c) -> Column:
    """TXT-14: the n-th ``<math>…</math>`` -> ``formula_n``, ``<code>`` -> ``codice_n``."""
    return _compose([_placeholder(tag, name) for tag, name in PLACEHOLDERS])(c)


def _escape_html(c) -> Column:
    """TXT-16."""
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def _cleanup(c, to_html: bool = False, blanks: bool = False) -> Column:
    c = apply_steps(c, CLEANUP_STEPS + (BLANK_STEPS if blanks else []))
    return _escape_html(c) if to_html else c


def clean_stages(to_html: bool = False, guarded: bool = False, links: bool = False, blanks: bool = False):
    """clean(): TXT-10..13, 8, 14, 15 (+16), as a list of column stages.  ``links``
    keeps ``<a>`` tags; ``blanks`` takes those at punctuation out (Q10).
    ``guarded`` splits the regex chains into one guarded stage per step."""
    if not guarded:
        stages = [lambda c: apply_steps(c, html_steps(links=links))]
        if not to_html:
            stages.append(unescape)
        stages += [_placeholder(tag, name) for tag, name in PLACEHOLDERS]
        stages.append(lambda c: _cleanup(c, to_html, blanks))
        return stages
    stages = guarded_stages(html_steps(links=links))
    if not to_html:
        stages.append(_guard("&", unescape))
    stages += [_guard("<", _placeholder(tag, name)) for tag, name in PLACEHOLDERS]
    stages += guarded_stages(CLEANUP_STEPS + (BLANK_STEPS if blanks else []))
    if to_html:
        stages.append(_escape_html)
    return stages


def _placeholder(tag, name):
    pat = rf"(?is)<\s*{tag}(?:\s*| [^>]+?)>.*?<\s*/\s*{tag}\s*>"
    return lambda c: map_matches(c, pat, lambda x, i: F.concat(F.lit(f"{name}_"), (i + 1).cast("string")),
                                 with_index=True)


def _compose(stages):
    def run(c):
        c = _c(c)
        for st in stages:
            c = st(c)
        return c
    return run


def with_stages(df, col: str, out: str, stages):
    """Apply column stages as separate projections.  A stage that reads its
    input twice (split + extract) then reads a computed column instead of
    repeating the whole chain below it (Catalyst keeps such projections apart).
    After a stage that goes to Python (``barrier``) a one-element generator ends
    the chain: Catalyst would else join the projections between two such stages
    into one expression, which grows threefold with each.  Arrow batches are short, so
    that a worker's memory does not grow with the rows of its task."""
    if any(getattr(st, "barrier", False) for st in stages):
        small_batches(df.sparkSession)
    cur = col
    for i, st in enumerate(stages):
        nxt = f"__{out}_s{i}"
        df = df.withColumn(nxt, st(F.col(cur)))
        if cur != col:
            df = df.drop(cur)
        if getattr(st, "barrier", False):
            df = df.select(*[c for c in df.columns if c != nxt], F.explode_outer(F.array(nxt)).alias(f"{nxt}_b"))
            nxt = f"{nxt}_b"
        cur = nxt
    return df.withColumnRenamed(cur, out)


def clean_markup(c, to_html: bool = False) -> Column:
    """clean() as one expression (small inputs); prefer :func:`with_clean_markup`."""
    return _compose(clean_stages(to_html))(c)


def with_clean_markup(df, col: str, out: str, to_html: bool = False, links: bool = False):
    """clean() as guarded projections: the form for large texts."""
    return with_stages(df, col, out, clean_stages(to_html, guarded=True, links=links))


SYNTAXHIGHLIGHT = r"(?is)<syntaxhighlight[^>]*>.*?</syntaxhighlight>"
NOWIKI = r"(?s)<nowiki>.*?</nowiki>"


def protect_nowiki(c) -> Column:
    """TXT-18: braces inside ``<nowiki>`` are not template markup."""
    return map_matches(c, NOWIKI, lambda m: F.replace(m, F.lit("{"), F.lit(BRACE_MASK)))


def decode_outside_highlight(c) -> Column:
    """TXT-9: decode entities everywhere except inside ``<syntaxhighlight>``,
    whose content is kept as is (tags removed)."""
    c = _c(c)
    parts = F.split(c, SYNTAXHIGHLIGHT, -1)
    blocks = F.regexp_extract_all(c, F.lit(SYNTAXHIGHLIGHT), 0)
    inner = F.transform(blocks, lambda b: F.regexp_replace(b, r"(?is)^<syntaxhighlight[^>]*>|</syntaxhighlight>$", ""))
    return F.array_join(F.zip_with(F.transform(parts, lambda p: unescape(p)),
                                   F.concat(inner, F.array(F.lit(""))), lambda p, r: F.concat(p, r)), "")


def wiki_stages(guarded: bool = False, **options):
    """wiki2text (TXT-1, 3, 4, 6, 7, 9, 17, 18) as column stages; ``options`` are
    those of :func:`wiki_steps`."""
    if not guarded:
        return [protect_nowiki,
                lambda c: F.replace(apply_steps(c, wiki_steps(**options)), F.lit(BRACE_MASK), F.lit("{")),
                decode_outside_highlight]
    return ([_guard("<nowiki>", protect_nowiki)] + guarded_stages(wiki_steps(**options))
            + [lambda c: F.replace(c, F.lit(BRACE_MASK), F.lit("{")),
               lambda c: (F.when(F.instr(F.lower(c), "<syntaxhighlight") > 0, decode_outside_highlight(c))
                          .when(F.instr(c, "&") > 0, unescape(c)).otherwise(c))])


def wiki_to_text(c) -> Column:
    return _compose(wiki_stages())(c)


def clean_wiki(c) -> Column:
    """TXT-28 without the line compaction, one expression (small inputs);
    prefer :func:`with_clean_wiki`."""
    return _compose(wiki_stages() + clean_stages())(c)


def with_wiki_text(df, col: str, out: str, html: bool = False, links: bool = False, namespaces=ACCEPTED_NAMESPACES):
    """wiki2text alone as guarded projections: with ``html`` and ``links`` the tags
    that stand for quotes and links are still there."""
    return with_stages(df, col, out, wiki_stages(guarded=True, html=html, links=links, namespaces=namespaces))


def with_clean_wiki(df, col: str, out: str, to_html: bool = False, links: bool = False, namespaces=ACCEPTED_NAMESPACES, blanks: bool = False):
    """wiki2text + clean() as guarded projections: the form for large texts.

    ``links`` keeps links as ``<a href>``.  ``to_html`` implies it, and gives what the
    reference's HTML mode gives: emphasis tags go again in clean(), where ``b`` and
    ``i`` keep their content only, entities stay, and all of the text is escaped at
    the end, the link tags included (:func:`with_wiki_text` has them as tags)."""
    links = links or to_html
    return with_stages(df, col, out, wiki_stages(guarded=True, html=to_html, links=links, namespaces=namespaces)
                       + clean_stages(to_html, guarded=True, links=links, blanks=blanks))


def residual_markup(c) -> Column:
    """Count of markup openers left after cleaning (unbalanced): reported, not
    hidden."""
    return F.size(F.regexp_extract_all(_c(c), F.lit(r"\{\{|\}\}|\[\[|\]\]"), 0))


# ---------------------------------------------------------------------------
# TXT-19..27: line compaction
# ---------------------------------------------------------------------------
SECTION = r"^(==+)\s*(.*?)\s*\1"
STRIP_ENDS = r"^\s+|\s+$"


def line_kind(line: Column) -> Column:
    """S heading, P page title (``++``), I indent, L list item, R table/template
    residue, X irrelevant line, B preformatted (leading blank), T text."""
    first = F.substring(line, 1, 1)
    last = F.substring(line, -1, 1)
    return (F.when(line.rlike(SECTION), "S")
            .when(line.startswith("++"), "P")
            .when(first == ":", "I")
            .when(first.isin("*", "#", ";"), "L")
            .when(first.isin("{", "|") | (last == "}"), "R")
            .when(((first == "(") & (last == ")")) | (F.regexp_replace(line, r"^[.\-]+|[.\-]+$", "") == ""), "X")
            .when(first == " ", "B")
            .otherwise("T"))


def _title_dot(t: Column) -> Column:
    return F.when((t != "") & ~F.substring(t, -1, 1).isin("!", "?"), F.concat(t, F.lit("."))).otherwise(t)


# What opens, closes and holds the items of a list, by its mark.
LIST_OPEN = {"*": "<ul>", "#": "<ol>", ";": "<dl>", ":": "<dl>"}
LIST_CLOSE = {"*": "</ul>", "#": "</ol>", ";": "</dl>", ":": "</dl>"}
LIST_ITEM = {"*": ("<li>", "</li>"), "#": ("<li>", "</<li>"), ";": ("<dt>", "</dt>"), ":": ("<dd>", "</dd>")}
LISTS = ("drop", "bullets", "html")
SEGMENT = 128            # lines folded into one piece of the output


def _by_mark(values: dict, mark: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, v in values.items():
        out = F.when(mark == k, F.lit(v)).otherwise(out)
    return out


def _list_moves(stack: Column, marks: Column) -> Column:
    """TXT-22: struct(tags, stack) when an item with ``marks`` follows the open lists
    ``stack`` (one character a level).  Level by level: the same mark, or definition
    marks on either side, leave a level open; another mark closes the innermost list
    and opens its own; levels beyond the marks are closed from inside."""
    at = F.sequence(F.lit(1), F.greatest(F.length(stack), F.length(marks)))
    init = F.struct(F.array().cast("array<string>").alias("tags"), stack.alias("now"))

    def level(acc, i):
        c, n = F.substr(stack, i, F.lit(1)), F.substr(marks, i, F.lit(1))
        stays = (c == n) | ((c != "") & (n != "") & (c.isin(";", ":") | n.isin(";", ":")))
        closed = F.when((c != "") & ~stays, F.array(_by_mark(LIST_CLOSE, c))).otherwise(F.array().cast("array<string>"))
        opened = F.when((n != "") & ~stays, F.array(_by_mark(LIST_OPEN, n))).otherwise(F.array().cast("array<string>"))
        left = F.when((c != "") & ~stays, F.substr(acc["now"], F.lit(1), F.length(acc["now"]) - 1)).otherwise(acc["now"])
        return F.struct(F.concat(acc["tags"], closed, opened).alias("tags"),
                        F.when((n != "") & ~stays, F.concat(left, n)).otherwise(left).alias("now"))

    return F.aggregate(at, init, level)


def compact(c, keep_sections: bool = False, lists: str = "drop") -> Column:
    """TXT-27: page text -> list of kept lines (residues and preformatted lines as in
    the reference's default mode).

    ``lists`` (TXT-22): ``drop``; ``bullets``: items as ``- `` or ``1. ``, padded to
    their level, after the pending headings; ``html``: ``<ul>/<ol>/<dl>`` and their
    items, and headings as ``<h2>`` and so on.

    Each line is classified once, then folded (no shuffle).  State: ``pend`` the
    pending headings (level, title) - a heading replaces its level and clears deeper
    ones (TXT-19); the first text line after headings is kept even when preformatted
    and, with ``keep_sections``, is preceded by the pending headings in level order
    (SORT-2), so empty sections never appear; ``empty`` no text since the last
    heading; ``open`` the marks of the open lists (the next text line is kept
    whatever it looks like, Q20, and closes them).  The output grows in pieces of
    ``SEGMENT`` lines that are joined at the end, so a page of n lines costs about
    n, not n * n, copies."""
    if lists not in LISTS:
        raise ValueError(f"lists is one of {', '.join(LISTS)}")
    no_lines, no_heads = F.array().cast("array<string>"), F.array().cast("array<struct<lev:int,title:string>>")
    marks = lambda x: F.regexp_extract(x, "^([*#;][*#;:]*)", 1)
    parsed = F.transform(F.filter(F.split(_c(c), "\n"), lambda x: x != ""), lambda x: F.struct(
        line_kind(x).alias("k"), x.alias("line"), F.length(F.regexp_extract(x, SECTION, 1)).cast("int").alias("lev"),
        F.regexp_extract(x, SECTION, 2).alias("title"), marks(x).alias("marks")))
    state = "struct<out:array<string>,pend:array<struct<lev:int,title:string>>,empty:boolean,open:string>"
    first_state = F.struct(no_lines.alias("out"), no_heads.alias("pend"), F.lit(False).alias("empty"), F.lit("").alias("open")).cast(state)

    def step(acc, x):
        k, line, pend, empty, open_ = x["k"], x["line"], acc["pend"], acc["empty"], acc["open"]
        heads = F.transform(F.array_sort(pend), lambda p: p["title"])
        h = F.size(pend) > 0
        page_title = _title_dot(F.substring(line, F.lit(3), F.greatest(F.length(line) - 4, F.lit(0))))
        is_text = k.isin("R", "X", "B", "T")
        after_list = is_text & (open_ != "")
        first_text = is_text & (open_ == "") & h & k.isin("B", "T")
        plain = is_text & (open_ == "") & ~h & ~empty & (k == "T")
        item = F.regexp_replace(F.substr(line, F.length(x["marks"]) + 1), STRIP_ENDS, "")
        last_mark = F.substring(x["marks"], -1, 1)
        is_item = (k == "L") & (item != "")
        added = (F.when((k == "P") & (page_title != ""), F.array(page_title))
                 .when(first_text, F.concat(heads, F.array(line)) if keep_sections else F.array(line)))
        new_open = F.when(k == "S", "").when(after_list, "")
        if lists == "html":
            close = F.transform(F.reverse(F.split(open_, "")), lambda m: _by_mark(LIST_CLOSE, m))
            begin, end = ({m: v[i] for m, v in LIST_ITEM.items()} for i in (0, 1))
            moved = _list_moves(open_, x["marks"])
            tag = F.concat(F.lit("h"), x["lev"].cast("string"), F.lit(">"))
            added = (added.when(after_list, F.concat(F.array(line), close)).when(plain, F.array(line))
                     .when(k == "S", F.array(F.concat(F.lit("<"), tag, x["title"], F.lit("</"), tag)))
                     .when(is_item, F.array_append(moved["tags"], F.concat(_by_mark(begin, last_mark), item, _by_mark(end, last_mark))))
                     .when(k == "L", moved["tags"]))
            new_open = new_open.when(k == "L", moved["now"])
        else:
            added = added.when(after_list | plain, F.array(line))
            new_open = new_open.when(k == "L", x["marks"])
            if lists == "bullets":
                bullet = F.when(last_mark == "#", "1. ").otherwise("- ")
                width = F.greatest(F.length(x["marks"]), F.length(bullet))
                added = added.when(is_item, F.array_append(heads, F.concat(F.rpad(bullet, width, " "), item)))
        cleared = first_text | is_item if lists == "bullets" else first_text
        heading = F.struct(x["lev"].alias("lev"), _title_dot(x["title"]).alias("title"))
        return F.struct(F.concat(acc["out"], added.otherwise(no_lines)).alias("out"),
                        F.when(k == "S", F.array_append(F.filter(pend, lambda p: p["lev"] < x["lev"]), heading))
                        .when(cleared, no_heads).otherwise(pend).alias("pend"),
                        F.when(k == "S", True).when(first_text, False).otherwise(empty).alias("empty"),
                        new_open.otherwise(open_).alias("open")).cast(state)

    whole = f"struct<parts:array<array<string>>,now:{state}>"
    init = F.struct(F.array().cast("array<array<string>>").alias("parts"), first_state.alias("now")).cast(whole)

    # one list of the classified lines, so that they are worked out once
    folded = F.transform(F.array(parsed), lambda lines: F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.floor((F.size(lines) - 1) / SEGMENT).cast("int"), F.lit(0))), init,
        lambda acc, i: F.aggregate(F.slice(lines, i * SEGMENT + 1, F.lit(SEGMENT)), acc["now"], step, lambda done: F.struct(
            F.array_append(acc["parts"], done["out"]).alias("parts"),
            F.struct(no_lines.alias("out"), done["pend"].alias("pend"), done["empty"].alias("empty"), done["open"].alias("open")).cast(state).alias("now")).cast(whole)),
        lambda done: F.flatten(done["parts"])))
    return folded[0]


# ---------------------------------------------------------------------------
# TXT-30: template definitions
# ---------------------------------------------------------------------------
TEMPLATE_STEPS = [
    (r"(?s)<!--.*?-->", "", 1, "<!--"),
    (r"(?s)<noinclude>.*?</noinclude>", "", 1, "<noinclude>"),
    (r"(?s)<noinclude\s*>.*", "", 1, "<noinclude"),          # unterminated
    ("<noinclude/>", "", 0, None),
]


def template_target(c) -> Column:
    """Title that a template page redirects to, else null."""
    return F.nullif(F.regexp_extract(_c(c), r"(?i)^#REDIRECT[^\n]*?\[\[([^\]]*)\]\]", 1), F.lit(""))


def template_body(c) -> Column:
    """What a template page stands for where it is included: no comments, no
    ``<noinclude>`` parts (an unterminated one runs to the end); where
    ``<onlyinclude>`` parts hold something these alone, else all without the
    ``<includeonly>`` tags."""
    t = apply_steps(c, TEMPLATE_STEPS)
    only = F.array_join(F.regexp_extract_all(t, F.lit(r"(?s)<onlyinclude>(.*?)</onlyinclude>"), 1), "")
    return F.when(only != "", only).otherwise(F.regexp_replace(t, "</?includeonly>", ""))
