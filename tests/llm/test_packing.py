from __future__ import annotations

import itertools
import random

import pytest
from pyspark.sql import functions as F

from handbill.llm import packing


def waste(hist, tops):
    return sum(c * (next(t for t in tops if t >= x) - x) for x, c in hist)


@pytest.mark.parametrize("seed", range(25))
def test_bounds_are_optimal(seed):
    rng = random.Random(seed)
    hist = [(x, rng.randrange(1, 9)) for x in sorted(rng.sample(range(60), rng.randrange(1, 9)))]
    k = rng.randrange(1, 6)
    tops = packing.bounds(hist, k)
    lengths = [x for x, _ in hist]
    best = min(waste(hist, sorted((*c, lengths[-1]))) for n in range(min(k, len(hist))) for c in itertools.combinations(lengths[:-1], n))
    assert len(tops) <= k and tops[-1] == lengths[-1] and waste(hist, tops) == best


def test_batches_hold_the_budget(docs_of):
    rng = random.Random(0)
    rows = [(i, "w " * rng.choice([0, 1, 5, 50, 300])) for i in range(200)] + [(500, None), (501, "w " * 5000), (3, "w"), (3, "w"), (None, "w w")]
    got = packing.packed(docs_of(*rows, extra="bucket"), buckets=4, budget=1000).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((r[0] is None, r[0] or 0) for r in rows)
    batches = {}
    for r in got:
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for rs in batches.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs))) and (len(rs) == 1 or rs[0].padded_to * len(rs) <= 1000)
        assert all(r.n_tokens <= r.padded_to for r in rs)
    for b in {k[0] for k in batches}:
        own = sorted(n for k, n in batches if k == b)
        each = max(1, 1000 // max(1, batches[b, 0][0].padded_to))
        assert own == list(range(len(own))) and all(len(batches[b, n]) == each for n in own[:-1])
    assert next(r for r in got if r.doc_id == 500).n_tokens == 0


def test_other_lengths_and_empty(docs_of):
    got = packing.packed(docs_of((1, "abc"), (2, "a")), length=F.length("text")).collect()
    assert sorted(r.n_tokens for r in got) == [1, 3]
    assert packing.packed(docs_of((1, "a")).limit(0)).count() == 0


def test_batches_do_not_depend_on_how_rows_lie(docs_of):
    rng = random.Random(1)
    docs = docs_of(*[(rng.choice([None, rng.randrange(300)]), "w " * rng.randrange(40)) for _ in range(700)])
    got = [sorted(map(str, packing.packed(docs.repartition(n), buckets=5, budget=200).collect())) for n in (1, 5)]
    assert got[0] == got[1]
