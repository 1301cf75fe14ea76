from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
from support import SF
from pyspark.sql import functions as F

from handbill.llm import common, quality, queries


def test_words_match_the_pattern(monkeypatch):
    import re

    monkeypatch.setattr(common, "SEGMENT", 40)
    texts = ["a bb  ccc", "", None, " x\ty\n", "w" * 300 + " q " + "z" * 90, "é ü  A a\u00a0b", "end"] * 3
    data, at = common.text_bytes(pa.array(texts))
    start, length, h, of = common.words(data, at)
    got = [[bytes(data[start[k] : start[k] + length[k]]).decode() for k in range(of[i], of[i + 1])] for i in range(len(texts))]
    assert got == [re.findall(common.WORD, t or "") for t in texts]
    by = {}
    for k, x in enumerate(w for ws in got for w in ws):
        assert by.setdefault(x, h[k]) == h[k]
    assert len(set(by.values())) == len(by)


def test_learns_what_marks_a_class():
    rng = random.Random(1)
    good = [" ".join(rng.choice(["river", "stone", "cloud", "light"]) for _ in range(30)) for _ in range(60)]
    bad = [" ".join(rng.choice(["river$$$", "stone###", "CLOUD!!", "light"]) for _ in range(30)) for _ in range(60)]
    m = quality.train(good[:40] + bad[:40], [1] * 40 + [0] * 40)
    s = m.scores(pa.array(good[40:] + bad[40:] + ["", None]))
    assert (s[:20] > 0.5).all() and (s[20:40] < 0.5).all() and s[40] == s[41] == 0.5


def test_long_texts_are_read_whole(monkeypatch):
    m = quality.Model(np.random.default_rng(0).normal(size=1 << quality.BITS).astype(np.float32), 0.1, 0.0)
    text = " ".join(f"w{i % 50}x" for i in range(4000))
    whole = m.scores(pa.array([text]))
    monkeypatch.setattr(quality, "segments", lambda data: common.segments(data, 1000))
    assert abs(m.scores(pa.array([text]))[0] - whole[0]) < 1e-12


def test_held_out_rows_and_odd_rows(spark, docs_of):
    docs = docs_of((1, "good text here"), (1, "good text here"), (2, None), (3, ""), (None, "x"), extra="score")
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (9, None, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert quality.score(docs.limit(0), model).count() == 0
    assert quality.fit(docs, labels.limit(0)).scores(pa.array(["a"]))[0] == 0.5


def test_query_on_held_out_labels(spark):
    got = queries.op1_quality(spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.predicted == r.quality for r in held]) > 0.9
    assert spark.read.parquet(f"{SF}/documents.parquet").where(F.col("doc_id") < 0).count() == 0


def test_score_is_the_softmax_of_the_mean_vector():
    """Against one document at a time, with vectors, layer and softmax as they are trained."""
    rng = np.random.default_rng(2)
    vectors, layer, bias = rng.normal(size=(1 << quality.BITS, 3)), rng.normal(size=(2, 3)), rng.normal(size=2)
    m = quality.Model(vectors @ (layer[1] - layer[0]), bias[1] - bias[0], 0.25)
    texts = ["a bb a bb ccc", "x", "ü é ü", "one two  three\nfour " * 9]
    for text, got in zip(texts, m.scores(pa.array(texts)), strict=True):
        data, at = common.text_bytes(pa.array([text]))
        ids = np.concatenate([i for i, _ in quality.features(data, at)])
        words_ = text.split()
        grams = sum(max(0, len(f" {w} ".encode()) - n + 1) for w in words_ for n in quality.ORDERS)
        assert len(ids) == len(words_) + len(words_) - 1 + grams
        z = layer @ sum(vectors[i] for i in ids) / len(ids) + bias + np.array([0, 0.25])
        assert abs(got - np.exp(z[1]) / np.exp(z).sum()) < 1e-9


def test_a_step_of_descent_follows_the_gradient():
    """A pass over one document of each class lowers the loss, and what marks class 1 gains weight."""
    texts, labels = ["alpha beta", "gamma delta"], [1, 0]
    before = quality.train(texts, labels, epochs=1, rate=1e-9)
    after = quality.train(texts, labels, epochs=1, rate=0.2)
    loss = lambda m: -sum(np.log(s if y else 1 - s) for s, y in zip(m.scores(pa.array(texts)), labels, strict=True))
    assert loss(after) < loss(before)
    data, at = common.text_bytes(pa.array([texts[0]]))
    own = np.unique(np.concatenate([i for i, _ in quality.features(data, at)]))
    assert after.weight[own].mean() > before.weight[own].mean()
