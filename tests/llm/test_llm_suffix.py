import random

import pytest

from kiln.llm import suffix as X


def brute(rows, length=100):
    """{row number: (kept, runs)}; rows in order of id, then as given."""
    seen, out = set(), {}
    for k, (_, text) in enumerate(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - length + 1):
            w = data[p:p + length]
            if w in seen:
                gone[p:p + length] = b"\1" * length
            else:
                seen.add(w)
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[k] = (bytes(c for c, g in zip(data, gone, strict=True) if not g), runs)
    return out


def made(seed, alphabet="abcdefghij ", n=60):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice(alphabet) for _ in range(k))
    shared = [word(rnd.randint(90, 400)) for _ in range(6)]
    rows = []
    for i in range(n):
        text = word(rnd.randint(0, 120))
        for _ in range(rnd.randint(0, 3)):
            part = rnd.choice(shared)
            a = rnd.randint(0, 40)
            text += part[a:a + rnd.randint(60, 300)] + word(rnd.randint(0, 60))
        rows.append((i, text))
    rows += [(n, shared[0] * 3), (n + 1, "é" * 300), (n + 2, "xé" * 200), (n + 3, None), (n + 4, ""), (n + 5, "a" * 5000)]
    rnd.shuffle(rows)
    return rows


def check(df, rows):
    got = {r["doc_id"]: r for r in X.without_repeats(df).collect()}
    want = brute(sorted(rows, key=lambda r: r[0]))
    for k, (i, text) in enumerate(sorted(rows, key=lambda r: r[0])):
        r, data = got[i], (text or "").encode()
        assert bytes(r["kept"]) == want[k][0], i
        assert (r["n_bytes"], r["n_removed"], len(r["spans"])) == (len(data), len(data) - len(want[k][0]), want[k][1])


@pytest.mark.parametrize("alphabet", ["ab", "abcdefghij "])
def test_documents_equal_brute_force(stored, alphabet):
    rows = made(len(alphabet), alphabet)
    check(stored(rows, extra=True), rows)


def test_hot_anchors_are_divided(stored, monkeypatch):
    monkeypatch.setattr(X, "HOT", 2)
    rows = made(5)
    check(stored(rows), rows)


def test_small_parts(stored, monkeypatch):
    for name, value in (("PIECE", 150), ("HELD", 500), ("INDEX", 300)):
        monkeypatch.setattr(X, name, value)
    rows = made(6, n=25)
    check(stored(rows), rows)


def test_long_text_and_copies(stored):
    rnd = random.Random(2)
    long = "".join(rnd.choice("abcdefgh") for _ in range(150_000))
    rows = [(3, long), (1, long), (2, long[1000:90_000]), (4, "z" + long)]
    check(stored(rows), rows)


def test_repeated_and_missing_ids(stored):
    body = "".join(chr(97 + i * 7 % 26) + str(i) for i in range(100))
    got = X.without_repeats(stored([(2, body), (2, body), (None, body), (1, body)], parts=2)).collect()
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in got) == [(0, 0), (1, len(body)), (2, len(body)), (2, len(body))]
    got = X.without_repeats(stored([(2, body), (2, body)], parts=1)).collect()
    assert sorted(r["n_removed"] for r in got) == [0, len(body)]


def test_unstored_and_empty(docs_of):
    assert X.without_repeats(docs_of([]), stored=False).count() == 0
    assert [r["n_bytes"] for r in X.without_repeats(docs_of([(1, "é")]), stored=False).collect()] == [2]


def test_index_runs_and_samples():
    rnd = random.Random(4)
    base = bytes(rnd.choice(b"abcd\0\xff") for _ in range(300))
    segments = list(dict.fromkeys(base[a:a + rnd.randint(100, 168)] for a in [rnd.randrange(190) for _ in range(40)]))
    first, want = {}, set()
    for k, s in enumerate(segments):
        for p in range(len(s) - 99):
            if s[p:p + 100] in first:
                want.add((k, p))
            first.setdefault(s[p:p + 100], (k, p))
    index = X.RunIndex(segments)
    assert {(int(a), int(b)) for which, place in index.earlier() for a, b in zip(which, place, strict=True)} == want
    assert len(index.run) < sum(map(len, segments)) / 3
