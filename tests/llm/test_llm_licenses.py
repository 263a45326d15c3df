import random
import re
from collections import Counter

from kiln.llm import licenses as L


def dice(a, b):
    words = lambda t: re.findall(r"[^\W_]+(?:\.[^\W_]+)*", t.lower())
    x, y = (Counter(zip(words(t), words(t)[1:])) for t in (a, b))
    return 2 * sum((x & y).values()) / max(1, sum(x.values()) + sum(y.values()))


def brute(text):
    lines, best = (text or "").split("\n"), {}
    units = [("line", i, x) for i, x in enumerate(lines)]
    at = 0
    for i, x in enumerate([*lines, ""]):
        if not x.strip():
            if i - at > 1:
                units.append(("paragraph", at, "\n".join(lines[at:i])))
            at = i + 1
    if len(lines) > 1:
        units.append(("text", 0, text))
    for name, t in L.TEMPLATES.items():
        for kind, i, u in units:
            d = dice(u, t)
            if d >= L.SIMILARITY and (name not in best or (-d, L.UNITS.index(kind), i) < best[name]):
                best[name] = (-d, L.UNITS.index(kind), i)
    return {n: (round(-d, 9), L.UNITS[k], i) for n, (d, k, i) in best.items()}


def test_equals_brute_force(docs_of, spark, sf):
    mit = L.TEMPLATES["MIT"].split(". ")
    rows = [(1, "intro\n\n" + ".\n".join(mit) + "\n\nend"), (2, L.TEMPLATES["ISC"] + " and more words here"), (3, "Some text. " * 3000), (4, None), (5, ""), (6, "word"),
            (7, "Licensed under the Apache License, Version 2.0"), (8, "x\nReleased under the MIT Licence."), (9, L.TEMPLATES["GPL-3.0-notice"].upper()),
            (9, L.TEMPLATES["GPL-3.0-notice"].upper()), (10, "Copyright (c) 2020 Someone\n" + L.TEMPLATES["MPL-2.0-notice"]), (None, "Licensed under CC BY 4.0.")]
    small = [(r["doc_id"] + 1000, r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {}
    for r in L.scan(docs_of(rows + small, extra=True)).collect():
        got.setdefault(r["doc_id"], Counter())[r["license"], round(r["dice"], 9), r["unit"], r["line"]] += 1
    for i, text in rows + small:
        if i == 10:
            continue   # its copyright line is dropped before comparing
        want = {(n, *x): (2 if i == 9 else 1) for n, x in brute(text).items()}
        assert got.get(i, {}) == want, i
    assert ("MPL-2.0-notice", 1.0, "line", 1) in got[10]


def test_best_and_empty(docs_of):
    rows = L.scan(docs_of([(1, "Licensed under CC BY-SA 4.0.\nLicensed under the Apache License, Version 2.0.")])).collect()
    assert [r["license"] for r in rows if r["best"]] == ["Apache-2.0-short"]
    assert L.scan(docs_of([])).count() == 0
    assert L.scan(docs_of([(1, "anything at all")]), templates={}).count() == 0


MIT = L.TEMPLATES["MIT"].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")


def test_a_header_with_blank_lines_in_front_of_code():
    match = L.Matcher(L.TEMPLATES, L.SIMILARITY)
    code = "\n\nimport sys\n\n" + "\n".join(f"def function_{i}(value):\n    return value + {i}" for i in range(200))
    gpl = L.TEMPLATES["GPL-3.0-notice"].replace("version. This", "version.\n\nThis").replace("details. You", "details.\n\nYou")
    assert MIT.count("\n\n") == gpl.count("\n\n") == 2
    assert match.scan("MIT License\n\nCopyright (c) 2020 Foo\n\n" + MIT + code) == [("MIT", 1.0, "run", 4)]
    assert match.scan("#!/bin/x\n\n" + gpl.replace(" of ", " of\n") + code) == [("GPL-3.0-notice", 1.0, "run", 2)]


def test_runs_equal_all_runs():
    rnd = random.Random(5)
    templates = {"x": "a b c d e f g h", "y": "a b a b c a b", "z": "d e f"}
    match = L.Matcher(templates, L.SIMILARITY)
    for _ in range(3000):
        lines = [[rnd.choice("abcdefgh") if rnd.random() < 0.3 else "abcdefgh"[(k + j) % 8] for j in range(rnd.randint(0, 4))] for k in range(rnd.randint(1, 9))]
        best = {}
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                for name, t in templates.items():
                    best[name] = max(best.get(name, 0), dice(" ".join(w for x in lines[i:j] for w in x), t))
        got = {name: d for name, d, _, _ in match.scan("\n".join(" ".join(x) for x in lines))}
        assert {n: round(d, 9) for n, d in got.items()} == {n: round(d, 9) for n, d in best.items() if d >= L.SIMILARITY}


def test_only_the_copyright_notice_is_dropped():
    for line in ("Copyright (c) 2020 Foo. Released under the MIT License.", "# (c) 2020-2021 J. Foo, Inc. All rights reserved. Released under the MIT License.",
                 "Copyright 2020 Foo, released under the MIT License."):
        assert [r[:2] for r in L.Matcher(L.TEMPLATES, L.SIMILARITY).scan(line)] == [("MIT-short", 1.0)], line
    assert L.line_words("Copyright (c) 2020 Foo Inc.") == L.line_words("© Foo. All rights reserved.") == []
    assert L.line_words("copyright notice and this") == ["copyright", "notice", "and", "this"]
