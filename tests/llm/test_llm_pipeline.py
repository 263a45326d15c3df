import random

import corpus_pipeline as P
from kiln.llm import decontaminate, mixing, simhash, toxicity
from kiln.llm.common import materialize

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    seen = [docs]
    for name, stage in P.STAGES[:-1]:
        seen.append(materialize(stage(spark, seen[-1], sf), "test"))
        assert seen[-1].columns == COLUMNS, name
    ids = [{r["doc_id"] for r in d.select("doc_id").collect()} for d in seen]
    assert ids[0] >= ids[1] >= ids[2] >= ids[3] and ids[3] == ids[4]
    assert len(ids[4]) > 0.7 * len(ids[0])
    # stage 1: exactly the rejected ones go
    model = toxicity.fit(docs, labels)
    assert ids[0] - ids[1] == {r["doc_id"] for r in toxicity.severity(docs, model).where(f"p_toxic >= {toxicity.REJECT}").collect()}
    # stage 2: one document of each component stays
    found = simhash.near_duplicates(seen[1]).collect()
    assert ids[2] == {r["component_id"] for r in found}
    # stage 3: documents with a benchmark passage go
    assert ids[2] - ids[3] == {r["doc_id"] for r in decontaminate.contaminated(seen[2], bench).collect()}
    # last: every document is in the shards
    index = P.STAGES[-1][1](spark, seen[-1], sf).collect()
    assert {i for r in index for i in r["doc_ids"]} == ids[4]


def test_odd_rows(spark, sf, stored):
    rows = [(1, "a b c d"), (1, "a b c d"), (2, None), (2, None), (None, "x"), (None, None), (3, ""), (4, "long " * 30_000), (5, "a b c d", None)]
    docs = stored(rows, extra=True)
    for name, stage in P.STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf), "test")
        assert len(docs.columns) > 10, name
    assert sorted(r["doc_id"] for r in docs.where("doc_id is not null").collect()) == [1, 2, 4]
    assert docs.where("doc_id is null").count() == 2


def test_texts_that_share_an_id_are_told_apart(spark, sf, stored):
    rng = random.Random(3)
    a, b, c, d = (" ".join(rng.choice("abcdefgh") + str(rng.randrange(999)) for _ in range(60)) for _ in range(4))
    for rows, kept in (([(1, a), (2, a), (2, b), (3, c), (3, d)], {(1, a), (2, b), (3, c), (3, d)}),
                       ([(5, b), (2, a), (2, a), (None, a), (None, a), (9, c), (4, c), (9, d)], {(5, b), (2, a), (None, a), (4, c), (9, d)})):
        left = dict(P.STAGES)["near_duplicates"](spark, stored(rows, extra=True), sf)
        got = [(r["doc_id"], r["text"]) for r in left.collect()]
        assert set(got) == kept
        assert len(got) == len(kept) + sum(i is None for i, _ in rows) - sum(i is None for i, _ in kept)


def test_empty(spark, sf, stored):
    docs = stored([])
    for _, stage in P.STAGES:
        docs = materialize(stage(spark, docs, sf), "test")
    assert docs.count() == 0


def test_the_mix_decides_the_sequences(spark, stored):
    docs = stored([(i, f"text number {i} " + "word " * (i % 90), "ab"[i % 3 == 0]) for i in range(3000)])

    def sequences(mixed):
        rows = sorted(P.STAGES[-1][1](spark, mixed, "").collect(), key=lambda r: r["sequence"])
        ids = [i for r in rows for i in r["doc_ids"]]
        return list(dict.fromkeys(ids))

    seen = {}
    for name, weights in (("more a", {"a": 9, "b": 1}), ("more b", {"a": 1, "b": 9})):
        place = {r["doc_id"]: r["position"] for r in mixing.schedule(docs, weights=weights).collect()}
        seen[name] = sequences(materialize(mixing.mixed(docs, weights=weights), "test"))
        assert seen[name] == sorted(place, key=place.get)
    assert seen["more a"] != seen["more b"]
    assert sequences(docs.orderBy("doc_id").transform(lambda d: materialize(d, "test"))) == list(range(3000))
