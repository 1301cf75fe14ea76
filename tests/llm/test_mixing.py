from __future__ import annotations

import random

import pytest

from handbill.llm import mixing


def test_targets():
    assert mixing.targets([("b", 60), ("a", 60)]) == {"a": 40.0, "b": 80.0}
    got = mixing.targets([("a", 100), ("b", 10), ("c", 1), (None, 5)])
    assert got["c"] == 3 and abs(sum(got.values()) - 116) < 1e-9 and all(v <= 3 * s + 1e-9 for v, s in zip([got[x] for x in ("a", "b", "c", None)], (100, 10, 1, 5), strict=True))
    assert mixing.targets([]) == {} and mixing.targets([("a", 0)]) == {"a": 0.0}


@pytest.mark.parametrize("seed", range(5))
def test_flight_keeps_both_totals(seed):
    rng = random.Random(seed)
    words, held = [float(rng.randrange(1, 400)) for _ in range(500)], [0.37] * 500
    out = mixing.flight(words, held, rng)
    assert sum(0 < h < 1 for h in out) <= 2 and abs(sum(out) - sum(held)) < 1e-6
    assert abs(sum(w * h for w, h in zip(words, out, strict=True)) - 0.37 * sum(words)) < 1e-3
    assert all(h in (0.0, 1.0) for h in mixing.land(words, out))
    assert sum(0 < h < 1 for h in mixing.flight([5.0] * 9, [0.5] * 9, rng)) <= 2


def test_inclusion_is_unbiased():
    took = [0] * 12
    for seed in range(600):
        for i, h in enumerate(mixing.flight([float(i + 1) for i in range(12)], [0.4] * 12, random.Random(seed))):
            took[i] += h
    assert all(abs(t / 600 - 0.4) < 0.08 for t in took)


def test_mix_meets_the_targets(docs_of, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 32)
    monkeypatch.setattr(mixing, "FAN", 3)
    rng = random.Random(2)
    rows = [(i, "w " * rng.randrange(1, 60), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(1500)] + [(5000, None, "en", "a"), (5001, "", "en", "b"), (None, "w w", "en", "c"), (7, "w w w", "en", "z"), (7, "w w w", "en", "z")]
    docs = docs_of(*rows, extra="copies")
    got = mixing.mixed(docs).collect()
    assert len(got) == len(rows) and sum(r.size for r in got) == sum(len((t or "").split()) for _, t, _, _ in rows)
    for s in ("a", "b", "c", None):
        own = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 120 and all(r.taken <= 3 * r.size for r in own)
    again = mixing.mixed(docs.repartition(7)).collect()
    key = lambda rs: sorted((str(r.doc_id), r.source or "", r.taken) for r in rs)
    assert key(got) == key(again)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.copies for r in got)


def test_empty(docs_of):
    assert mixing.mixed(docs_of((1, "a")).limit(0)).count() == 0
    assert [r.taken for r in mixing.mixed(docs_of((1, None), (2, ""))).collect()] == [0, 0]


def test_repeated_rows_are_dealt_each(docs_of, spark):
    docs = docs_of(*[(1, "w " * 100, "en", "a")] * 200, *[(i, "w " * 100, "en", "b") for i in range(10, 210)])
    got = mixing.mixed(docs).collect()
    for s in "ab":
        own = [r for r in got if r.source == s]
        assert len(own) == 200 and abs(sum(r.taken for r in own) - own[0].target) <= 100 and {r.copies for r in own} <= {0, 1, 2}
    assert mixing.mix(docs).where("doc_id = 1").count() == sum(r.copies for r in got if r.doc_id == 1)


def test_words_of_a_source_come_as_near_as_the_last_choice_allows(docs_of):
    """Against all subsets: with few documents the mix is one whose words lie within the largest document of the target."""
    rng = random.Random(4)
    for _ in range(3):
        rows = [(i, "w " * rng.randrange(1, 30), "en", "ab"[i % 2]) for i in range(18)]
        got = mixing.mixed(docs_of(*rows)).collect()
        for s in "ab":
            own = [r for r in got if r.source == s]
            whole = min(int(r.target / r.source_size + 1e-12) for r in own)
            base, sizes = whole * own[0].source_size, [r.size for r in own]
            sums = {0}
            for x in sizes:
                sums |= {y + x for y in sums}
            assert sum(r.taken for r in own) - base in sums and abs(sum(r.taken for r in own) - own[0].target) <= max(sizes)
