from __future__ import annotations

import random

import numpy as np
import pytest

from handbill.llm import minhash


def brute(rows, k, percent):
    import re

    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[x : x + k]) for x in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            a, b = sets[x], sets[y]
            if None not in (i, j) and a and b and 100 * len(a & b) >= percent * len(a | b):
                u, v = find(i), find(j)
                parent[max(u, v)] = min(u, v)
    return sorted(((i, len(s), None if i is None else find(i), i is None or find(i) == i) for (i, _), s in zip(rows, sets, strict=True)), key=repr)


@pytest.mark.parametrize(("seed", "k", "percent"), [(0, 3, 85), (1, 5, 80), (2, 3, 85)])
def test_matches_brute_force(docs_of, seed, k, percent):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(4))
    rows = []
    for _ in range(6):  # families of copies with more and more edits, so links lie on both sides of the threshold
        base = [word() for _ in range(90)]
        for _ in range(14):
            copy = list(base)
            for _ in range(rng.randrange(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append((len(rows), " ".join(copy)))
    rows += [(500, None), (501, ""), (502, " \n "), (503, "two words"), (504, "TWO  words"), (505, "one"), (506, "One\u00a0"), (507, "x y z " * 3000), (None, rows[0][1]), (8, rows[8][1])]
    got = minhash.near_components(docs_of(*rows, extra="band"), k, percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, k, percent)


def test_bands_miss_little_and_estimate_without_bias():
    for j, v in ((0.85, 50), (0.8, 50), (0.85, 256), (0.8, 256)):
        r = minhash.band_rows(j, v)
        assert (1 - j**r) ** (2 * (v // r)) <= minhash.MISS
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**63, 400, dtype=np.uint64)
    b = np.concatenate([a[:300], rng.integers(0, 2**63, 100, dtype=np.uint64)])
    keys, bits = minhash.bands(np.concatenate([np.unique(a), np.unique(b)]), np.array([0, 400, 800]), 1, 256, 256)
    assert abs((keys[0] == keys[1]).mean() - 0.6) < 0.1
    assert abs(1 - 2 * sum(int(x).bit_count() for x in bits[0] ^ bits[1]) / 512 - 0.6) < 0.15


def test_keeps_one_of_each(docs_of):
    rows = [(5, "a b c d e f g h"), (2, "a b c d e f g h"), (9, "other words here are some more"), (None, "a b c d e f g h"), (7, None)]
    got = minhash.deduplicated(docs_of(*rows))
    assert sorted((r.doc_id for r in got.collect()), key=str) == [2, 7, 9, None] and got.columns[-1] == "size"
    assert minhash.deduplicated(docs_of((1, "a")).limit(0)).count() == 0
