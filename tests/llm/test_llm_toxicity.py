import math

import numpy as np
import pytest

from kiln.llm import toxicity as X


def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    train = labels.where("doc_id % 5 <> 0")
    model = X.fit(docs, train)
    held = labels.where("doc_id % 5 = 0").select("doc_id", "toxic")
    rows = X.severity(docs, model).join(held, "doc_id").collect()
    assert len(rows) > 500
    toxic = [r for r in rows if r["toxic"]]
    clean = [r for r in rows if not r["toxic"]]
    assert sum(r["p_toxic"] >= X.REJECT for r in toxic) / len(toxic) > 0.9
    assert sum(r["p_toxic"] >= X.REJECT for r in clean) / len(clean) < 0.005
    assert all(0 <= r["severity"] <= X.GRADES - 1 for r in rows)


def test_more_markers_are_more_severe():
    rng = np.random.default_rng(1)
    common = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(80)]
    bad = ["vile", "nasty", "rotten", "awful", "horrid"]
    sets, toxic, counts = [], [], {}
    for i in range(1500):
        text = list(rng.choice(common, 30))
        t = i % 5 == 0
        if t:
            text += list(rng.choice(bad, rng.integers(1, 6), replace=False))
        sets.append(X.features(" ".join(text)))
        toxic.append(t)
    for s, t in zip(sets, toxic, strict=True):
        for f in s:
            counts[f] = (counts.get(f, (0, 0))[0] + 1, counts.get(f, (0, 0))[1] + t)
    counts = {f: c for f, c in counts.items() if X.standard_errors(*c, len(sets), sum(toxic)) >= X.DIFFERS}
    names = {f: i for i, f in enumerate(sorted(counts))}
    model = X.fit_rows(counts, [(np.array(sorted(names[f] for f in s if f in names), "<i4"), t) for s, t in zip(sets, toxic, strict=True)])
    assert model.thresholds == sorted(model.thresholds)
    severity = [model.above([model.score(" ".join(["waa", *bad[:k]]))]).sum() for k in range(6)]
    assert severity == sorted(severity) and severity[0] < 0.3 and severity[5] > 1.5
    long = " ".join(common * 300)
    assert model.above([model.score(long)])[0, 0] < X.REJECT


def test_edge_rows_and_columns(spark, docs_of):
    rows = [(1, "bad vile text"), (2, None), (None, "vile"), (3, ""), (3, ""), (4, "x " * 100_000)] + [(10 + i, f"fine words number {chr(97 + i)}") for i in range(8)]
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 0), (10, 1, 0), (11, 0, None), (None, 1, 1), (12, 1, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(rows, extra=True)
    model = X.fit(docs, labels)
    got = X.severity(docs, model).collect()
    assert len(got) == len(rows) and all(r["severity"] is not None for r in got)
    kept = X.keep_clean(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r["p_toxic"] < X.REJECT for r in got)


def test_without_labels_nothing_is_rejected(spark, docs_of):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    docs = docs_of([(1, "some text"), (2, None)])
    model = X.fit(docs, labels)
    assert X.keep_clean(docs, model).count() == 2
    assert all(r["severity"] < 1e-9 for r in X.severity(docs, model).collect())
    assert X.severity(docs_of([]), model).count() == 0


def _objective(weights, thresholds, rows, grades):
    """Mean negative log likelihood of the grades plus the penalty, text by text."""
    total = 0.0
    for found, grade in zip(rows, grades, strict=True):
        above = [1.0, *(1 / (1 + math.exp(t - sum(weights[f] for f in found))) for t in thresholds), 0.0]
        total -= math.log(max(above[grade] - above[grade + 1], 1e-12))
    return total / len(rows) + X.PENALTY * sum(abs(w) for w in weights)


@pytest.mark.parametrize("steps,gain", [(X.STEPS, 0.03), (20 * X.STEPS, 0.0005)])
def test_fit_nears_the_optimum_of_the_ordinal_likelihood(monkeypatch, steps, gain):
    """The objective, worked out from the model's definition, falls by no more than
    ``gain`` of itself wherever one weight or threshold is moved: the steps lead to the
    optimum, but the number that is taken stops short of it (measured here: one move
    gains 2 percent)."""
    monkeypatch.setattr(X, "STEPS", steps)
    rnd = np.random.default_rng(3)
    names = [f"f{k}" for k in range(8)]
    toxic = rnd.random(400) < 0.4
    rows = [np.flatnonzero(rnd.random(8) < np.where(np.arange(8) < 3, 0.6 if t else 0.03, 0.3)).astype(np.int32) for t in toxic]
    counts = {f: (sum(k in r for r in rows), sum(k in r for r, t in zip(rows, toxic, strict=True) if t)) for k, f in enumerate(names)}
    model = X.fit_rows(counts, list(zip(rows, toxic.tolist(), strict=True)))
    weights, cuts = [model.weights.get(f, 0.0) for f in names], model.thresholds
    marks = [k for k, f in enumerate(names) if counts[f][1] >= X.MARKER_TEXTS
             and counts[f][1] / toxic.sum() >= X.MARKER_RATIO * (counts[f][0] - counts[f][1] + 1) / ((~toxic).sum() + 1)]
    grades = X.grades(np.array([np.isin(r, marks).sum() for r in rows]), toxic).tolist()
    assert set(grades) == {0, 1, 2, 3}
    best = _objective(weights, cuts, rows, grades)
    assert best < _objective([0.0] * 8, cuts, rows, grades) - 0.05
    least = best
    for values in (weights, cuts):
        for k, value in enumerate(values):
            for move in (-0.2, -0.05, 0.05, 0.2):
                values[k] = value + move
                if cuts == sorted(cuts):
                    least = min(least, _objective(weights, cuts, rows, grades))
            values[k] = value
    assert 1 - least / best < gain
