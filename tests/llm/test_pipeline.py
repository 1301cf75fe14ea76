from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from support import SF, same

from handbill.llm import langid, lines, mixing, packing, queries
from handbill.llm.common import WORD


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_sql(spark, duck, name):
    same(queries.QUERIES[name](spark, SF), duck, queries.SQL[name])


def test_stages_act_in_turn(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    assert [n for n, _ in p.STAGES] == ["language", "line dedup", "near dedup", "mixture", "packing"]
    kept = {}
    for name, stage in p.STAGES[:-1]:
        docs = stage(spark, docs, SF).cache()
        assert docs.columns == columns
        kept[name] = docs.count()
    assert 0 < kept["near dedup"] <= kept["line dedup"] <= kept["language"] <= 200
    out = p.STAGES[-1][1](spark, docs, SF)
    assert out.count() == kept["mixture"] and p.ORACLE_SQL is None
    assert p.run(spark, SF).count() == kept["mixture"]


def test_clean_documents_stay(spark, docs_of):
    import corpus_pipeline as p

    docs = docs_of(*((i, " ".join(f"lorem{i}x{j}" for j in range(80)), "en", "s") for i in range(12)))
    for _, stage in p.STAGES[:3]:
        docs = stage(spark, docs, SF)
    assert docs.count() == 12


def _posteriors(m, text):
    """Forward-backward over one text, word by word."""
    em, _, letters = m.emissions(pa.array([text]))
    e, step = np.exp(em.astype(float)), np.exp(m.transitions)
    f, b = e.copy(), np.ones_like(e)
    for t in range(1, len(e)):
        f[t] = (f[t - 1] / f[t - 1].sum()) @ step * e[t]
    for t in range(len(e) - 2, -1, -1):
        b[t] = step @ (e[t + 1] * b[t + 1])
        b[t] /= b[t].sum()
    p = f * b
    return (p / p.sum(1, keepdims=True))[letters].mean(0)


def _shingles(text):
    ws = re.findall(WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} if len(ws) >= 5 else {tuple(ws)} if ws else set()


def _kept_near(rows):
    """The doc_ids that stay, by comparing all pairs."""
    sets = {r.doc_id: _shingles(r.text) for r in rows if r.doc_id is not None}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a, x in sets.items():
            for b, y in sets.items():
                if x and y and root[a] < root[b] and 100 * len(x & y) >= 80 * len(x | y):
                    root[b], changed = root[a], True
    return {i for i in root if root[i] == i}


def test_stages_match_brute_force(spark, docs_of):
    """Each stage on what the one before it kept, odd rows among them."""
    import corpus_pipeline as p

    rng = random.Random(9)
    en, fr = ["the", "thing", "with", "that", "ring", "under"], ["une", "quelle", "deux", "leaux", "vie", "tre"]
    make = lambda pool, n: [f"{rng.choice(pool)}{rng.choice(pool)}{rng.randrange(9)}" for _ in range(n)]
    rows = [(i, " ".join(make(en if i % 2 else fr, 70)), "en" if i % 2 else "fr", rng.choice(["a", "a", "b", None])) for i in range(24)]
    base, passage = rows[3][1].split(), " ".join(make(en, 60))
    rows += [(30, rows[3][1], "en", "a"), (31, " ".join([*base[:30], "changed", *base[31:]]), "en", "b"), (32, f"some words here {passage} and more of them", "en", "a"), (33, f"other text now {passage} that ends", "en", "b")]
    rows += [(40, None), (41, ""), (42, "123 $$$"), (43, " \n"), (None, " ".join(make(en, 20)), "en", "a"), (50, " ".join(make(fr, 40)), None, "b"), (50, " ".join(make(fr, 40)), None, "b"), rows[5], (60, "thing " * 3000, "en", "a")]
    docs = docs_of(*rows, extra="__runs2")
    shown = lambda rs: sorted((str(r.doc_id), r.text or "") for r in rs)

    model = langid.fit(docs)
    before, kept = docs.collect(), p.language(spark, docs, "").cache()
    letters = [r for r in before if r.text and any(c.isalpha() for c in r.text)]
    assert shown(kept.collect()) == shown(r for r in letters if _posteriors(model, r.text).max() >= 0.35)

    before, kept = kept.collect(), p.line_dedup(spark, kept, "").cache()
    # texts of one line: what the rule on lines deletes is in passages too
    want = _without_passages(before)
    assert sorted((str(r.doc_id), r.text.split()) for r in kept.collect()) == sorted((str(r.doc_id), want[r.doc_id, r.text]) for r in before if want[r.doc_id, r.text])
    assert sum(passage in r.text for r in kept.collect()) == 1

    before, kept = kept.collect(), p.near_dedup(spark, kept, "").cache()
    stay = _kept_near(before)
    assert shown(kept.collect()) == shown(r for r in before if r.doc_id is None or r.doc_id in stay)

    before, mixed_ = kept.collect(), p.mixture(spark, kept, "").cache()
    size = lambda r: len(re.findall(WORD, r.text or ""))
    goal = mixing.targets(list({s: sum(size(r) for r in before if r.source == s) for s in {r.source for r in before}}.items()))
    for s, t in goal.items():
        own = [r for r in before if r.source == s]
        assert abs(sum(size(r) for r in mixed_.collect() if r.source == s) - t) <= max(map(size, own))
    assert {str(r) for r in mixed_.collect()} <= {str(r) for r in before}

    got = p.pack(spark, mixed_, "").collect()
    lengths = sorted(size(r) for r in mixed_.collect())
    tops = packing.bounds([(x, lengths.count(x)) for x in sorted(set(lengths))])
    nth, want = {}, []
    for r in sorted(mixed_.collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, size(r))):
        k = next(i for i, t in enumerate(tops) if t >= size(r))
        n, each = nth.get(k, 0), max(1, packing.BUDGET // max(tops[k], 1))
        nth[k] = n + 1
        want.append((str(r.doc_id), size(r), k, tops[k], n // each, n % each))
    assert sorted((str(r.doc_id), r.n_tokens, r.bucket, r.padded_to, r.batch, r.slot) for r in got) == sorted(want)


def _without_passages(rows):
    """Words by (doc_id, text) without those in a passage that occurs in an earlier text; texts of one id come by a hash, here they share none."""
    n, seen, out = lines.PASSAGE, set(), {}
    for i, t in sorted({(r.doc_id, r.text) for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0)):
        ws, gone = t.split(), set()
        for k in range(len(ws) - n + 1):
            if (key := tuple(ws[k : k + n])) in seen:
                gone |= set(range(k, k + n))
            seen.add(key)
        out[i, t] = [w for k, w in enumerate(ws) if k not in gone]
    return out


def test_stages_take_an_empty_table(spark, docs_of):
    import corpus_pipeline as p

    docs = docs_of((1, "a")).limit(0)
    for _, stage in p.STAGES:
        docs = stage(spark, docs, "")
    assert docs.count() == 0


def test_run_leaves_only_its_result(spark):
    import corpus_pipeline as p
    from handbill.llm.common import MADE

    made = len(MADE)
    p.run(spark, SF)
    assert len(MADE) == made + 1
