import random

import numpy as np
import xxhash

from kiln.llm import simhash as S
from kiln.llm.common import components


def brute_fingerprint(text, shingle=3):
    words = (text or "").translate({c: c + 32 for c in range(65, 91)})
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs, distance=2):
    """pairs (id, fp) -> {id: smallest id reachable}"""
    fps = sorted({f for _, f in pairs})
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= distance:
                parent[find(a)] = find(b)
    low = {}
    for i, f in pairs:
        low[find(f)] = min(low.get(find(f), i), i)
    return {(i, f): low[find(f)] for i, f in pairs}


def test_fingerprint_is_the_majority_of_shingle_hashes():
    rnd = random.Random(3)
    texts = ["", None, "a", "A b", "one two three", " \t\n ", "X\x0by\x0cz w v", "É é ſ K", " ".join(rnd.choice("abcdef") for _ in range(400))]
    for t in texts:
        assert S.fingerprint(t.encode() if t is not None else None) == brute_fingerprint(t), t


def test_thresholds_keep_the_pigeonhole_bound():
    both = np.full((64, 64), 250.0)
    np.fill_diagonal(both, 500.0)
    for rows in (10, 10_000, 10 ** 10):
        parts = S.plan(1000, both, list(range(64)), 2, rows=rows)
        bits = sorted(b for g, _ in parts for b in g)
        assert len(set(bits)) == len(bits)
        assert parts
        masks = S.masks(parts)
        rnd = random.Random(rows)
        for _ in range(300):  # any two within 2 bits agree on some mask
            a = rnd.getrandbits(64)
            b = a ^ (1 << rnd.randrange(64)) ^ (1 << rnd.randrange(64))
            assert any(not (a ^ b) & m for m in masks)


def test_components_of_dense_groups_with_small_buckets(spark, docs_of):
    rnd = random.Random(7)
    fps = {rnd.getrandbits(64) for _ in range(300)}
    for _ in range(3):
        centre = rnd.getrandbits(64)
        for _ in range(250):
            x = centre
            for _ in range(rnd.randint(0, 4)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    nodes = [(S.signed(f), k) for k, f in enumerate(sorted(fps, key=lambda f: rnd.random()))]
    df = spark.createDataFrame(nodes, "fp long, root long")
    got = {r["node"]: r["component"] for r in components(S.links(df, 2, bucket=16)).collect()}
    want = brute_components([(k, f % (1 << 64)) for f, k in nodes])
    assert {k: got.get(k, k) for _, k in nodes} == {i: c for (i, _), c in want.items()}


def test_documents_with_nulls_ties_and_clashing_columns(docs_of):
    body = " ".join(f"w{i}" for i in range(200))
    rows = [(5, body), (3, body), (3, body), (9, body + " tail"), (1, None), (2, ""), (4, "  "), (None, body), (7, "single"), (8, "x" * 100_000), (None, "alone words here")]
    got = S.near_duplicates(docs_of(rows, extra=True)).collect()
    assert len(got) == len(rows)
    want = brute_components([(i, brute_fingerprint(t)) for i, t in rows if i is not None])
    for r in got:
        fp = r["fp"] % (1 << 64)
        if r["doc_id"] is not None:
            assert r["component_id"] == want[r["doc_id"], fp]
    assert {r["component_id"] for r in got if r["doc_id"] is None} <= {3, None, 1, 2}


def test_empty_table(docs_of):
    assert S.near_duplicates(docs_of([])).count() == 0


def test_whole_small_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    want = brute_components([(i, brute_fingerprint(t)) for i, t in texts.items()])
    for r in S.near_duplicates(docs).collect():
        assert r["component_id"] == want[r["doc_id"], r["fp"] % (1 << 64)]
