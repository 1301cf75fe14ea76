from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from handbill.llm import topk


def brute(rows, k, query):
    """Every row is a candidate but those of the query's own id; rows of one id ask as one query."""
    full = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for i in {i for i, _ in full if query(i)}:
        s = sorted((-sum(a * b for a, b in zip(v, w)), j) for h, v in full if h == i for j, w in full if j != i)[:k]  # noqa: B905
        out += [(i, n + 1, j, -x) for n, (x, j) in enumerate(s)]
    return sorted(out)


def run(spark, rows, k=5, query=lambda i: i % 3 == 0):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    return sorted(tuple(r) for r in topk.search(df, F.col("id") % 3 == 0, k).collect())


@pytest.mark.parametrize("shard", [8192, 16])
def test_matches_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * rng.choice([0.1, 1, 3])]) for i in range(150)]
    rows += [(200 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(3, None), (301, None), (302, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (303, [float("nan")] * 6), (304, [float("inf")] + [0.0] * 5), (None, [1.0] * 6), rows[5], (306, [1.0]), (307, [])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_equal_lengths_over_many_shards(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 10)
    rows = [(i, [1.0, 0.0] if i % 2 else [0.0, 1.0]) for i in range(120)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)


def test_large_components_and_few_rows(spark):
    rows = [(0, [3e6, -2e6]), (1, [2.5e6, 1e6]), (3, [1e6, 1e6])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
    assert run(spark, [(0, [1.0])]) == [] and run(spark, [(None, None)]) == []


def test_rows_that_repeat_an_id_stay(spark):
    rows = [(6, [1.0, 2.0]), (7, [3.0, 1.0]), (7, [2.0, 1.0]), (7, [2.0, 1.0]), (6, [0.0, 1.0])]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
    assert run(spark, rows)[0] == (6, 1, 7, 65536 * 5)


def test_scores_beyond_64_bits_are_errors(spark):
    for x in (1e15, 1e200):
        with pytest.raises(Exception, match="64 bits"):
            topk.search(spark.createDataFrame([(0, [x, x]), (1, [x, x])], "vec_id long, embedding array<double>"), F.col("id") % 3 == 0, 5).collect()


def test_queries_of_a_shard_are_split(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 16)
    monkeypatch.setattr(topk, "CELL", 5)
    rng = np.random.default_rng(5)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=4)]) for i in range(120)] + [(200 + i, [0.5, 0.5, 0.5, 0.5]) for i in range(60)]
    assert run(spark, rows) == brute(rows, 5, lambda i: i % 3 == 0)
