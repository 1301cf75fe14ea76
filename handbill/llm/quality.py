"""A quality classifier of supervised subword embeddings.

Features are words, pairs of words (a word with itself is one and the same feature for all words), and character 3- to 5-grams with word ends, all hashed into buckets. Each bucket has
a learned vector; a document is the mean of its features' vectors, and a softmax over a linear layer gives the classes. Both are
trained by stochastic gradient descent in numpy on the driver, on a bounded sample: the ``SAMPLE`` labelled documents of each class
whose ids hash lowest, the same at any size. The sample is balanced; the score is brought back to the class shares of all
learnable labels. For scoring, the linear layer is applied to the vectors once, so that a feature costs one look-up.

Only texts are inputs. Defined cases: an empty, blank or null text has no features, its score is the share of label 1; a doc_id with several labels
is learned with each; without labels of both classes every score is the share of 1 (0.5 without any). A text of over 2 MB is read in segments that end between
words, with the same features as in one. Rows that repeat a document are scored each, ties do not occur. An empty table gives an empty one; without documents or
labels nothing is learned. Only doc_id, text and the labels are read, so columns of any other name do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_mod, grams, pieces, segments, stream, text_bytes, words

SAMPLE = 1500
BITS, DIMS, ORDERS = 18, 8, (3, 4, 5)
EPOCHS, RATE, SEED = 6, 1.5, 7
#: The bucket of all pairs of one word with itself.
TWICE = 1


def features(data: np.ndarray, offsets: np.ndarray, carried: list[np.ndarray] | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets in the order of the texts, and the n+1 offsets of each text's, for each kind of feature. ``carried``: for a text that is read in
    segments, the last word of the one before, which makes a pair with the first of this one."""
    _, _, h, at = words(data, offsets)
    top = np.uint64(64 - BITS)
    yield (h >> top).astype(np.int32), at
    if carried is not None:
        h, at = np.concatenate([carried[0], h]), np.array([0, len(carried[0]) + len(h)])
        carried[0] = h[-1:]
    if len(h) > 1:
        with np.errstate(over="ignore"):
            pair = ((h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xD6E8FEB86659FD93) >> top).astype(np.int32)
        pair[h[:-1] == h[1:]] = TWICE
        inside = np.ones(len(pair), bool)
        ends = at[1:-1]
        inside[ends[(ends > 0) & (ends <= len(pair))] - 1] = False
        yield pair[inside], np.concatenate([[0], np.cumsum(inside)])[np.minimum(at, len(pair))]
    text, starts = stream(data, offsets)
    starts = np.append(starts, len(text))
    for ids, valid in grams(text, ORDERS, BITS):
        yield ids[valid], np.concatenate([[0], np.cumsum(valid)])[np.minimum(starts, len(ids))]


def _sums(column: pa.Array, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text, the sum of its features' weights and their number."""
    data, offsets = text_bytes(column)
    parts = list(segments(data)) if len(column) == 1 else [data]
    total, count = np.zeros(len(column)), np.zeros(len(column), np.int64)
    carried = [np.zeros(0, np.uint64)] if len(parts) > 1 else None
    for part in parts:
        at = offsets if len(parts) == 1 else np.array([0, len(part)], np.int64)
        for ids, ends in features(part, at, carried):
            run = np.concatenate([[0.0], np.cumsum(weight[ids], dtype=np.float64)])
            total += run[ends[1:]] - run[ends[:-1]]
            count += np.diff(ends)
    return total, count


class Model:
    """``weight``: the log-odds of class 1 that a bucket adds to the mean; ``bias``: those of a text without features."""

    def __init__(self, weight: np.ndarray, bias: float, prior: float):
        self.weight, self.bias, self.prior = weight, bias, prior

    def scores(self, column: pa.Array) -> np.ndarray:
        total, count = _sums(column, self.weight)
        odds = np.where(count > 0, total / np.maximum(count, 1) + self.bias, 0.0) + self.prior
        return 1 / (1 + np.exp(-np.clip(odds, -50, 50)))


def train(texts: list[str], labels: list[int], prior: float = 0.0, epochs: int = EPOCHS, rate: float = RATE) -> Model:
    """Stochastic gradient descent on the vectors, the linear layer and its bias."""
    if len(set(labels)) < 2:
        return Model(np.zeros(1 << BITS, np.float32), 0.0, prior)
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIMS, 1 / DIMS, (1 << BITS, DIMS)).astype(np.float32)
    layer, bias = np.zeros((2, DIMS), np.float32), np.zeros(2, np.float32)
    docs = []
    for text, label in zip(texts, labels, strict=True):
        data, at = text_bytes(pa.array([text]))
        found = [ids for ids, _ in features(data, at)]
        ids, times = np.unique(np.concatenate(found), return_counts=True)
        if len(ids):
            docs.append((ids, (times / times.sum()).astype(np.float32), int(label)))
    share = np.bincount([y for _, _, y in docs], minlength=2) / max(1, len(docs))
    steps, step = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            ids, share_of, y = docs[k]
            now = rate * (1 - step / steps)
            step += 1
            hidden = share_of @ vectors[ids]
            z = layer @ hidden + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            p *= 0.5 / max(share[y], 1e-9)  # classes count alike
            back = p @ layer
            layer -= now * np.outer(p, hidden)
            bias -= now * 0.1 * p
            vectors[ids] -= (now * share_of)[:, None] * back * 8
    return Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]), prior)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns ``labels`` (doc_id, quality) of rows that are not held out; ``sample`` bounds the documents of each class."""
    known = labels.where(F.col("quality").isin(0, 1)).where(crc_mod(F.col("doc_id"), 5) != 0).select(F.col("doc_id").alias("of"), F.col("quality").cast("int").alias("y"))
    counts = {r.y: r.n for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    prior = float(np.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)))
    picked = [known.where(F.col("y") == y).orderBy(F.xxhash64("of"), "of").limit(sample) for y in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(picked[0].unionByName(picked[1])), F.col("doc_id") == F.col("of"))  # 2 * sample rows
    rows = rows.groupBy("doc_id", "y").agg(F.min("text").alias("text"))  # of rows that repeat an id, one is learned
    texts = sorted((r.doc_id, r.y, r.text or "") for r in rows.collect())
    return train([t for _, _, t in texts], [y for _, y, _ in texts], prior)


def score(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """A row per document: doc_id, score (of label 1), predicted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(model.scores(part.column("text")))], names=["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
