import random

import numpy as np
import pytest

from kiln.llm import training_order as T
from kiln.session import scratch_path


@pytest.fixture(scope="module")
def vocabulary():
    with open(T.TOKENIZER, "rb") as f:
        return f.read()


@pytest.mark.parametrize("n", [1, 2, 3, 7, 64, 1000, 4097])
def test_permutation_is_a_bijection(n):
    f = T.Feistel(n, "k")
    slots = f.slot(np.arange(n))
    assert sorted(slots) == list(range(n))
    assert (f.sequence(slots) == np.arange(n)).all()
    if n > 60:
        assert (slots != T.Feistel(n, "other").slot(np.arange(n))).any()


@pytest.mark.parametrize("group", [1 << 20, 30])
def test_words_give_the_ids_of_whole_texts(vocabulary, group, monkeypatch):
    monkeypatch.setattr(T, "GROUP", group)
    t = T.Tokenizer(vocabulary)
    rnd = random.Random(1)
    texts = ["", " ", "  ", "a", " a", "a ", "a  b", "a   b", "a \n b", "a\n b", "a \nb", "a\n\n  b", "\t a", "x  y", "it's  we'll", "<|endoftext|>", "a\x1c b", "é" * 50]
    texts += ["".join(rnd.choice("ab 1.,'\n\té!ªɐ文") for _ in range(rnd.randint(1, 60))) for _ in range(500)]
    for _ in range(2):
        for some in (texts, texts[7:9], [None, *texts[:40]]):
            whole = [t.whole(x or "").tobytes() for x in some]
            assert t.counts(some) == [len(x) // 2 for x in whole]
            assert t.ids(some) == whole
    assert t.ids([]) == t.counts([]) == []


def expected(rows, vocabulary, length):
    t = T.Tokenizer(vocabulary)
    stream = []
    for _, text in rows:
        stream += np.frombuffer(t.whole(text or ""), "<u2").tolist() + [T.END]
    stream += [T.END] * (-len(stream) % length)
    return [stream[i:i + length] for i in range(0, len(stream), length)]


def test_round_trip_and_resume(stored, spark, vocabulary):
    rnd = random.Random(2)
    rows = [(i, " ".join(rnd.choice(["alpha", "beta", "gamma", "Δ"]) for _ in range(rnd.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "long " * 5000), (None, "no id")]
    folder = scratch_path(spark, "order-test")
    index = T.write_shards(stored(rows, parts=5, extra=True), folder, length=32, shard=16).collect()
    want = expected(sorted(rows, key=lambda r: (r[0] is not None, r[0])), vocabulary, 32)
    assert len(index) == len(want)
    permute = T.Feistel(len(want))
    read = dict(T.read_slots(folder))
    assert sorted(read) == list(range(len(want)))
    for r in index:
        assert read[r["slot"]].tolist() == want[r["sequence"]]
        assert permute.slot([r["sequence"]])[0] == r["slot"]
        assert (r["shard"], r["byte_offset"]) == (r["slot"] // 16, r["slot"] % 16 * 64)
    later = list(T.read_slots(folder, first=21, count=9))
    assert [s for s, _ in later] == list(range(21, 30))
    assert all((x == read[s]).all() for s, x in later)


def test_order_does_not_depend_on_the_partitions(stored, spark):
    rows = [(i % 40, f"text number {i % 57}") for i in range(150)]
    out = [sorted((r["slot"], r["tokens_sha256"]) for r in T.write_shards(stored(rows, parts=p), scratch_path(spark, "order-test"), length=16, shard=8).collect()) for p in (1, 7)]
    assert out[0] == out[1]


def test_empty_table(docs_of, spark):
    folder = scratch_path(spark, "order-test")
    assert T.write_shards(docs_of([]), folder, stored=False).count() == 0
    assert list(T.read_slots(folder)) == []
