from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pytest

from handbill.llm import langid, queries


@pytest.mark.parametrize("segment", [1, 3, 8, 500])
def test_forward_backward_is_exact(segment):
    rng = np.random.default_rng(segment)
    at = np.array([0, 5, 5, 40, 41, 141])
    em, tr = rng.normal(size=(141, 3)) * 2, rng.normal(size=(3, 3))
    got = langid.forward_backward(em, at, tr, segment)
    for a, b in zip(at[:-1], at[1:], strict=True):
        e = np.exp(em[a:b])
        f, w = np.zeros_like(e), np.ones_like(e)
        for t in range(len(e)):
            f[t] = e[t] if t == 0 else (f[t - 1] @ np.exp(tr)) * e[t]
            f[t] /= f[t].sum()
        for t in range(len(e) - 2, -1, -1):
            w[t] = np.exp(tr) @ (e[t + 1] * w[t + 1])
            w[t] /= w[t].sum()
        p = f * w
        assert np.allclose(got[a:b], p / p.sum(1, keepdims=True), atol=1e-5)


def test_labels_words_of_mixed_text():
    rng = np.random.default_rng(1)
    a, b = ["the", "thing", "with", "that"], ["une", "quelle", "deux", "leaux"]
    make = lambda pool: " ".join(rng.choice(pool, 60))
    m = langid.train([make(a) for _ in range(20)] + [make(b) for _ in range(20)], ["en"] * 20 + ["fr"] * 20)
    em, at, _ = m.emissions(pa.array(["the thing with that une quelle deux leaux"]))
    post = langid.forward_backward(em, at, m.transitions)
    assert post.argmax(1).tolist() == [0] * 4 + [1] * 4
    assert m.transitions[0, 0] > m.transitions[0, 1] and m.transitions[1, 1] > m.transitions[1, 0]


def test_odd_rows(docs_of):
    docs = docs_of(*((i, "the thing with that", "en") for i in range(8)), *((i + 10, "une quelle deux leaux", "fr") for i in range(8)), (50, None), (51, ""), (52, "123 $$$"), (53, "x", None), (53, "x", None), (54, "the thing with " * 20000), extra="score")
    model = langid.fit(docs)
    assert model.languages == ["en", "fr"]
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    assert got[50].lang_pred == got[51].lang_pred == got[52].lang_pred == "und" and got[54].lang_pred == "en" and got[12].lang_pred == "fr"
    assert all(0 <= r.score <= 1 for r in got.values())
    kept = langid.accepted(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id in (50, 51, 52)").count() == 0
    none = langid.fit(docs.where("lang is null"))
    assert {r.lang_pred for r in langid.identify(docs, none).collect()} == {"und"} and langid.identify(docs.limit(0), model).count() == 0


def test_query_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = queries.op9_language(spark, "/root/testdata/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.95


def test_expected_counts_are_those_of_all_label_sequences():
    import itertools

    rng = np.random.default_rng(6)
    em, tr = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3))
    post, pair = langid._expected(em, tr)
    want, pairs = np.zeros_like(em), np.zeros((3, 3))
    for c in range(2):
        paths = list(itertools.product(range(3), repeat=4))
        w = np.exp([sum(em[c, t, y] for t, y in enumerate(p)) + sum(tr[a, b] for a, b in itertools.pairwise(p)) for p in paths])
        for p, x in zip(paths, w / w.sum(), strict=True):
            for t, y in enumerate(p):
                want[c, t, y] += x
            for a, b in itertools.pairwise(p):
                pairs[a, b] += x
    assert np.allclose(post, want) and np.allclose(pair, pairs)


def test_sample_is_of_the_lowest_hashes(docs_of, spark, monkeypatch):
    from pyspark.sql import functions as F

    docs = docs_of(*((i, f"word{i} text", "en" if i % 3 else "fr") for i in range(60)), (1, "word1 text", "en"), (None, "no id", "fr"))
    seen = {}
    monkeypatch.setattr(langid, "train", lambda texts, labels: seen.update(texts=texts, labels=labels))
    langid.fit(docs, sample=5)
    known = docs.where(~(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 4 == 2)).withColumn("h", F.xxhash64("doc_id")).collect()
    for lang in ("en", "fr"):
        lowest = sorted((r for r in known if r.lang == lang), key=lambda r: (r.h, r.doc_id or -1))[:5]
        assert sorted({r.text for r in lowest}) == sorted(t for t, x in zip(seen["texts"], seen["labels"], strict=True) if x == lang)
