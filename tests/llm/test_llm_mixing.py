import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest

from kiln.llm import mixing as M


def simulate(blocks, shares):
    """Slot by slot: earliest deadline first among the released blocks."""
    left, order = {s: n for s, n in blocks.items() if n}, []
    while left:
        p, t, done = sum(shares[s] for s in left), 0, dict.fromkeys(left, 0)
        while all(left.values()):
            ready = [(-(-(done[s] + 1) * p // shares[s]), s) for s in left if done[s] * p // shares[s] <= t]
            _, s = min(ready)
            order.append((s, done[s]))
            done[s] += 1
            left[s] -= 1
            t += 1
        left = {s: n for s, n in left.items() if n}
    return [s for s, _ in order]


@pytest.mark.parametrize("seed", range(12))
def test_schedule_equals_the_simulation(seed):
    rnd = random.Random(seed)
    names = [f"s{i}" for i in range(rnd.randint(1, 7))]
    blocks = {s: rnd.randint(1, 60) for s in names}
    shares = M.shares({s: rnd.random() + 0.01 for s in names}, 40)
    table = M.phases(blocks, shares)
    slots = {}
    for s in names:
        for i in range(blocks[s]):
            first, base, p, places = [x for x in table[s] if x[0] <= i][-1]
            slots[base + (i - first) // len(places) * p + int(places[(i - first) % len(places)])] = s
    assert [slots[t] for t in range(len(slots))] == simulate(blocks, shares)


def test_every_prefix_is_within_one_block_of_the_weights():
    shares = M.shares({"a": 0.61, "b": 0.25, "c": 0.1, "d": 0.04}, 1000)
    order, p, seen = M.one_period(shares) * 2, sum(shares.values()), Counter()
    for t, s in enumerate(order, 1):
        seen[s] += 1
        for x, c in shares.items():
            assert abs(seen[x] - t * c / p) < 1
    assert seen == {x: 2 * c for x, c in shares.items()}


def test_every_document_has_one_place(docs_of):
    rnd = random.Random(1)
    rows = [(i, "t", rnd.choice(["hot"] * 6 + ["b", "c", None])) for i in range(3000)] + [(7, "t", "hot"), (None, "t", "b"), (None, None, None)]
    got = M.schedule(docs_of(rows, extra=True), block=8).collect()
    assert len(got) == len(rows)
    assert len({r["position"] for r in got}) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["slot"], set()).add((r["source"], r["block"]))
    assert all(len(x) == 1 for x in by.values())
    assert sorted(by) == list(range(len(by)))
    counts = Counter(r[2] for r in rows)
    assert Counter(r["source"] for r in got) == counts


def test_weights_rule_until_a_source_ends(docs_of):
    rows = [(i, "t", "a" if i % 2 else "b") for i in range(4000)]
    got = sorted(M.schedule(docs_of(rows), weights={"a": 3, "b": 1}, block=10).collect(), key=lambda r: r["position"])
    head = got[:2000]
    assert abs(sum(r["source"] == "a" for r in head) - 1500) <= 10


def test_mixed_keeps_rows_and_columns(docs_of):
    rows = [(i % 50, f"text {i}", "ab"[i % 2]) for i in range(200)] + [(None, None, None)]
    docs = docs_of(rows, extra=True)
    out = M.mixed(docs)
    assert out.columns == docs.columns
    assert Counter((r["doc_id"], r["text"]) for r in out.collect()) == Counter((r[0], r[1]) for r in rows)


def test_empty_table(docs_of):
    assert M.schedule(docs_of([])).count() == 0
    assert M.mixed(docs_of([])).count() == 0


def worst_lag(weights, slots):
    """Most blocks by which a source leaves its given weight in the first slots."""
    table, total, worst = M.phases({s: slots for s in weights}, M.shares(weights)), sum(map(Fraction, weights.values())), 0.0
    for s, w in weights.items():
        i = np.arange(slots)
        starts = np.array([x[0] for x in table[s]])
        k = np.searchsorted(starts, i, side="right") - 1
        at = np.concatenate([base + (i[k == n] - first) // len(x) * p + x[(i[k == n] - first) % len(x)]
                             for n, (first, base, p, x) in enumerate(table[s])])
        at = at[at < slots]
        for count, slot in zip(range(len(at)), at.tolist(), strict=True):
            ideal = Fraction(w) / total
            worst = max(worst, abs(float(count - ideal * slot)), abs(float(count + 1 - ideal * (slot + 1))))
        worst = max(worst, abs(float(len(at) - Fraction(w) / total * slots)))
    return worst


def test_long_schedules_keep_the_given_weights():
    ends = {f"s{k}": (300 + 211 * k) ** 0.7 for k in range(20)}
    for weights in ({"a": 1, "b": 2}, {"a": 1.0, "b": 1e-5}, ends, {"hot": 10.0, **{f"s{k}": 1.0 for k in range(20)}}):
        assert worst_lag(weights, 150_000) < 1 + 1e-9


def test_a_weight_of_zero_waits_for_the_others():
    table = M.phases({"a": 50, "b": 20, "z": 5, "y": 5}, M.shares({"a": 0.3, "b": 0.7, "z": 0, "y": 0}))
    assert table["z"][0][1] == table["y"][0][1] == 70 and [x[0] for x in table["a"]] == [0, table["a"][1][0]]
    with pytest.raises(ValueError):
        M.shares({"a": -1.0, "b": 2.0})
