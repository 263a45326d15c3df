import hashlib
import random

from kiln.llm import imatch as M


def run(docs):
    return M.fingerprints_with_edits(docs).collect()


def test_edits_and_equal_texts(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"]: r for r in run(docs)}
    order = sorted(texts, reverse=True)
    for k, i in enumerate(order):
        text, nxt = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        edited = text[:len(text) - half] + nxt[:half]
        assert (got[i]["n_chars"], got[i]["edited_sha256"]) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= got[i]["near_edited"] <= 1
        same = sum(x == y != 0 for x, y in zip(got[i]["own"], got[order[(k + 1) % len(order)]]["own"], strict=True))
        assert (got[i]["near_next"] > 0) == (same > 0) or not any(got[i]["own"])
    by = {}
    for i, t in texts.items():
        by.setdefault(t, set()).add(tuple(got[i]["own"]))
    assert all(len(x) == 1 for x in by.values())
    mean = lambda c: sum(r[c] for r in got.values()) / len(got)
    assert mean("near_edited") > 5 * mean("near_next")


def words(rnd, n):
    return " ".join(f"t{rnd.randrange(400)}x" for _ in range(n))


def test_fingerprint_is_the_band_of_the_lexicon(spark, docs_of):
    rnd = random.Random(2)
    rows = [(i, words(rnd, 30) + " everywhere") for i in range(300)]
    rows.append((300, " ".join(reversed(rows[7][1].split())) + " onlyhere, EVERYWHERE everywhere!"))
    docs = docs_of(rows)
    got = {r["doc_id"]: r for r in run(docs)}
    # order, case, repeats, punctuation, terms of every text and of one text do not count
    assert got[7]["own"] == got[300]["own"]
    lexicon = {r["h"] for r in M.lexicon(docs).collect()}
    seen = {}
    for _, t in rows:
        for w in set(t.lower().replace(",", "").replace("!", "").split()):
            seen[w] = seen.get(w, 0) + 1
    band = [w for w, c in seen.items() if 2 <= c <= 30]
    hashes = {r["h"] for r in spark.createDataFrame([(w,) for w in band], "w string").selectExpr("xxhash64(w) AS h").collect()}
    assert lexicon - {0} == hashes


def test_nulls_ties_and_clashing_columns(docs_of):
    rnd = random.Random(3)
    rows = [(i, words(rnd, 20)) for i in (10, 20, 30, 40)] + [(30, words(rnd, 20)), (20, None), (None, words(rnd, 9)), (None, None), (1, ""), (2, "."), (3, "é" * 100_001)]
    rows += [(50, rows[0][1]), (50, rows[0][1])]
    got = run(docs_of(rows, extra=True))
    assert len(got) == len(rows)
    lengths = sorted(len(t or "") for _, t in rows)
    assert sorted(r["n_chars"] for r in got) == lengths
    empty = [r for r in got if r["n_chars"] == 0]
    assert all(not any(r["own"]) for r in empty)
    assert len({tuple(r["own"]) for r in got if r["doc_id"] in (10, 50)}) == 1
    assert all(r["near_next"] is not None and r["edited_sha256"] for r in got)


def test_spread_ids_and_small_ranges(docs_of, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_PART", 3)
    monkeypatch.setattr(M, "SEGMENTS", 4)
    rnd = random.Random(4)
    ids = [0, 1, 2, 3, 4, 10 ** 15, 10 ** 15 + 1, -5, 77, 10 ** 18] + [1000 + i for i in range(40)]
    texts = {i: words(rnd, rnd.randint(0, 12)) for i in ids}
    got = {r["doc_id"]: r for r in run(docs_of(list(texts.items())))}
    order = sorted(ids, reverse=True)
    for k, i in enumerate(order):
        text, nxt = texts[i], texts[order[(k + 1) % len(order)]]
        half = len(text) // 2
        assert got[i]["edited_sha256"] == hashlib.sha256((text[:len(text) - half] + nxt[:half]).encode()).hexdigest()


def test_one_row_and_empty_table(docs_of):
    one = run(docs_of([(5, "abcd")]))[0]
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and one["near_next"] == 1.0
    assert run(docs_of([])) == []


def test_plan_has_no_python(docs_of):
    plan = M.fingerprints_with_edits(docs_of([(1, "a b")]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
