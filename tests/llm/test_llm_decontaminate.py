import random

from kiln.llm import decontaminate as D


def nearest(passage, text):
    """Edit distance of the passage to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        prev, row[0] = row[0], i
        for j, x in enumerate(text, 1):
            prev, row[j] = row[j], min(prev + (c != x), row[j] + 1, row[j - 1] + 1)
    return min(row)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeé") for _ in range(rnd.randint(1, 6))) for _ in range(n))


def edited(rnd, text, k):
    out = list(text)
    for _ in range(k):
        at = rnd.randrange(len(out))
        kind = rnd.randrange(3)
        if kind == 0:
            out[at] = rnd.choice("abcxyz")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, rnd.choice("abcxyz"))
    return "".join(out)


def made(seed):
    rnd = random.Random(seed)
    items = [(i, words(rnd, rnd.randint(8, 60))) for i in range(12)] + [(50, "short"), (51, None), (52, "aaaa " * 20), (53, words(rnd, 200)), (None, words(rnd, 20))]
    rows = []
    for i in range(60):
        text = words(rnd, rnd.randint(0, 40))
        if i % 2:
            item = rnd.choice(items)[1] or ""
            part = D.normalise(item)
            text += " " + edited(rnd, part, rnd.randint(0, len(part) // 8 + 1)) if part else ""
            text += " " + words(rnd, rnd.randint(0, 30))
        rows.append((i, text))
    rows += [(100, None), (101, ""), (102, "a" * 3000), (103, "  " + items[3][1].upper().replace(" ", " \n ") + " "), (104, items[4][1]), (104, items[4][1])]
    return items, rows


def test_index_search_equals_brute_force():
    items, rows = made(1)
    index = D.build(items)
    found = D.search(index, [t for _, t in rows])
    hits = 0
    for (_, text), got in zip(rows, found, strict=True):
        clean = D.normalise(text)
        for p, passage in enumerate(index.texts):
            d = nearest(passage, clean)
            want = d <= D.budget(len(passage))
            assert (p in got) == want, (p, d, D.budget(len(passage)))
            if want:
                hits += 1
                assert got[p][0] == d
    assert hits > 25


def test_alignment_equals_full_table():
    rnd = random.Random(5)
    for _ in range(60):
        passage = words(rnd, 12)[:60]
        lead = rnd.randint(0, 80)
        text = (words(rnd, 40)[:lead] + edited(rnd, passage, rnd.randint(0, 6)) + words(rnd, 10))
        want = nearest(passage, text)
        if want <= D.budget(len(passage)):
            assert D.aligned(passage, text, lead - D.BAND)[0] == want


def test_slices_do_not_lose_pairs(monkeypatch):
    items, rows = made(2)
    texts = [t for _, t in rows]
    whole = D.search(D.build(items), texts)
    monkeypatch.setattr(D, "SLICE", 300)
    assert D.search(D.build(items), texts) == whole


def test_frames(spark, docs_of, monkeypatch):
    items, rows = made(3)
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(rows, extra=True)
    got = sorted((r["doc_id"], r["item_id"] or -1, r["edits"]) for r in D.contaminated(docs, bench).collect())
    monkeypatch.setattr(D, "BLOCK", 200)   # several blocks
    assert sorted((r["doc_id"], r["item_id"] or -1, r["edits"]) for r in D.contaminated(docs, bench).collect()) == got
    clean = D.keep_clean(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(i for i, _ in rows if i not in {g[0] for g in got})
    assert {103, 104} <= {g[0] for g in got} and got.count((104, 4, 0)) == 2


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.contaminated(docs_of([(1, "x y z")]), none).count() == 0
    assert D.keep_clean(docs_of([(1, "x y z")]), none).count() == 1
    assert D.contaminated(docs_of([]), spark.createDataFrame([(1, "some words " * 8)], "item_id long, text string")).count() == 0
