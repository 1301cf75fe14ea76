"""Language identification by a linear-chain conditional random field over words.

Every word of a text is labelled with a language. Its features are the hashed word itself (the lexicon) and character
2- to 4-grams with word ends, so prefixes and suffixes of up to three bytes are among them; transitions between the languages of neighbouring words are
learned. Training maximises the likelihood of label sequences with AdaGrad in numpy on the driver, over a bounded sample: the ``SAMPLE``
documents of each language whose ids hash lowest, the same at any size. Their words carry the document's language, and spans of different
documents are joined, as in code-switched text, so that transitions are learned too.

Predicting runs forward-backward over all words of a text. Chains are cut into segments whose transfer matrices are
multiplied first, then each segment runs between its exact messages: the result is that of the whole chain, and all segments of a batch run at
once. The prediction is the language with the largest mean posterior over the words that hold a letter, the score is that mean.

Only texts are inputs. Defined cases: null texts and texts without a letter are ``und`` with score 1, or with score 0 where a model has no language; ties go to the
first language by code point; languages that are null are not learned; rows that repeat a document are predicted each, and one of them is learned; texts of any
length are one chain. An empty table gives an empty one, and a model without a language. Only doc_id, text and lang are read; ``accepted`` keeps all other columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, grams, pieces, stream, text_bytes, words

SAMPLE = 250
BITS, ORDERS = 16, (2, 3, 4)
EPOCHS, RATE, SEED = 3, 0.3, 11
#: Words to a training chain, to a joined span at most, and to a segment when predicting.
CHAIN, SPAN, SEGMENT = 48, 24, 256
UNKNOWN = "und"


def _word_features(column: pa.Array) -> tuple[list, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Buckets per kind of feature with the place in the stream, word hash buckets, the words' first places, the words' offsets by text, and
    whether a word may hold a letter: a byte that is one, or part of a longer character."""
    data, offsets = text_bytes(column)
    start, length, h, at = words(data, offsets, lower=True)
    text, _ = stream(data, offsets, lower=True)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    first = start + doc  # the space before the word, in the stream
    kinds = [(ids, valid) for ids, valid in grams(text, ORDERS, BITS)]
    letter = (((data | 32) >= 97) & ((data | 32) <= 122)) | (data >= 128)
    run = np.concatenate([np.zeros(1, np.int32), np.cumsum(letter, dtype=np.int32)])
    return kinds, (h >> np.uint64(64 - BITS)).astype(np.int32), first, at, run[start + length] > run[start]


class Model:
    """``weights``: (languages, 1 + orders, buckets); ``transitions``: log weights from one language to the next."""

    def __init__(self, languages: list[str], weights: np.ndarray, transitions: np.ndarray):
        self.languages, self.weights, self.transitions = languages, weights, transitions

    def emissions(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Log weights (words, languages), the words' offsets by text, and which may hold a letter."""
        kinds, lexicon, first, at, letters = _word_features(column)
        out = np.empty((len(lexicon), len(self.languages)), np.float32)
        if not len(lexicon):
            return out, at, letters
        for k, w in enumerate(self.weights):
            out[:, k] = w[0][lexicon]
            for j, (ids, valid) in enumerate(kinds):
                out[:, k] += np.add.reduceat(np.append(w[1 + j][ids] * valid, 0), np.minimum(first, len(ids)))
        return out, at, letters

    def predict(self, column: pa.Array) -> tuple[list[str], np.ndarray]:
        n, count = len(column), len(self.languages)
        if not count:
            return [UNKNOWN] * n, np.zeros(n)
        emissions, at, counts = self.emissions(column)
        post = forward_backward(emissions, at, self.transitions)
        run = np.concatenate([np.zeros((1, count)), np.cumsum(post * counts[:, None], axis=0, dtype=np.float64)])
        total = np.concatenate([[0], np.cumsum(counts)])
        mean = (run[at[1:]] - run[at[:-1]]) / np.maximum(total[at[1:]] - total[at[:-1]], 1)[:, None]
        best = mean.argmax(1)
        return [self.languages[k] for k in best], np.clip(mean[np.arange(n), best], 0, 1)


def forward_backward(emissions: np.ndarray, at: np.ndarray, transitions: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Posterior of each language at each word; chains are the ranges between the offsets ``at``."""
    n, count = emissions.shape
    out = np.empty((n, count), np.float32)
    if not n:
        return out
    e = np.exp(emissions - emissions.max(1, keepdims=True))
    step = np.exp(transitions - transitions.max())
    lengths = np.diff(at)
    pieces_of = -(-lengths // segment)
    owner = np.repeat(np.arange(len(lengths)), pieces_of)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces_of) - pieces_of, pieces_of)
    begin = at[:-1][owner] + nth * segment
    size = np.minimum(segment, at[1:][owner] - begin)
    order = np.argsort(-size, kind="stable")
    begin, size, nth_sorted = begin[order], size[order], nth[order]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    alive = np.searchsorted(-size, -np.arange(1, segment + 1), "right")  # segments of at least t words come first
    many = np.flatnonzero(pieces_of > 1)
    rows = len(begin)
    left = np.full((rows, count), 1 / count)  # the message into a segment, before its first transition
    right = np.full((rows, count), 1.0)
    start = np.ones(rows, bool)
    start[nth_sorted > 0] = False
    if len(many):
        chosen = np.flatnonzero(np.isin(owner[order], many))
        where = np.full(rows, -1)
        where[chosen] = np.arange(len(chosen))
        transfer = np.broadcast_to(np.eye(count), (len(chosen), count, count)).copy()
        for t in range(segment):
            live = chosen[size[chosen] > t]
            if not len(live):
                break
            w = where[live]
            m = transfer[w] @ step
            if t == 0:  # the first word of a chain has no transition before it
                m[start[live]] = np.eye(count)
            m = m * e[begin[live] + t][:, None, :]
            transfer[w] = m / m.sum((1, 2), keepdims=True)
        firsts = np.cumsum(pieces_of) - pieces_of
        for k in range(int(pieces_of.max())):
            chains = many[pieces_of[many] > k + 1]
            if not len(chains):
                break
            here, after = rank[firsts[chains] + k], rank[firsts[chains] + k + 1]
            message = left[here]
            m = np.einsum("ri,rij->rj", message, transfer[where[here]])
            left[after] = m / m.sum(1, keepdims=True)
        for k in range(int(pieces_of.max()) - 1, 0, -1):
            chains = many[pieces_of[many] > k]
            here, before = rank[firsts[chains] + k], rank[firsts[chains] + k - 1]
            m = np.einsum("rij,rj->ri", transfer[where[here]], right[here])
            right[before] = m / m.sum(1, keepdims=True)
    forward = np.empty((segment, rows, count), np.float64)
    message = left
    for t in range(segment):
        live = alive[t]
        if not live:
            break
        moved = message[:live] @ step
        if t == 0:
            moved[start[:live]] = 1.0 / count
        moved *= e[begin[:live] + t]
        moved /= moved.sum(1, keepdims=True)
        forward[t, :live] = moved
        message = moved
    back = right
    for t in range(segment - 1, -1, -1):
        live = alive[t]
        if not live:
            continue
        both = forward[t, :live] * back[:live]
        out[begin[:live] + t] = both / both.sum(1, keepdims=True)
        if t:
            m = (e[begin[:live] + t] * back[:live]) @ step.T
            back[:live] = m / m.sum(1, keepdims=True)
    return out


def _chains(texts: list[str], labels: list[int], rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Word places (chains, CHAIN) and labels: spans of documents in random order, so neighbours may differ in language."""
    column = pa.array(texts, pa.string())
    at = _word_features(column)[3]
    spans = []
    for k, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
        while a < b:
            to = min(b, a + int(rng.integers(SPAN // 4, SPAN + 1)))
            spans.append((a, to, labels[k]))
            a = to
    place, label = [], []
    for i in rng.permutation(len(spans)).tolist():
        a, b, y = spans[i]
        place.append(np.arange(a, b))
        label.append(np.full(b - a, y))
    place, label = np.concatenate(place), np.concatenate(label)
    full = len(place) // CHAIN * CHAIN
    return place[:full].reshape(-1, CHAIN), label[:full].reshape(-1, CHAIN), column


def train(texts: list[str], labels: list[str], epochs: int = EPOCHS, rate: float = RATE) -> Model:
    languages = sorted(set(labels))
    count = len(languages)
    if not count:
        return Model([], np.zeros((0, 1 + len(ORDERS), 1 << BITS), np.float32), np.zeros((0, 0)))
    rng = np.random.default_rng(SEED)
    weights = np.zeros((count, 1 + len(ORDERS), 1 << BITS), np.float32)
    transitions = np.zeros((count, count))
    place, label, column = _chains(texts, [languages.index(x) for x in labels], rng) if any(texts) else (np.zeros((0, CHAIN), int), np.zeros((0, CHAIN), int), None)
    if column is None or not len(place):
        return Model(languages, weights, transitions)
    kinds, lexicon, first, _, _ = _word_features(column)
    # flat features of each word: (word, bucket + offset of its kind)
    owner, bucket = [np.arange(len(lexicon), dtype=np.int32)], [lexicon]
    while kinds:
        ids, valid = kinds.pop()
        spot = np.flatnonzero(valid).astype(np.int32)
        owner.append((np.searchsorted(first, spot, "right") - 1).astype(np.int32))
        bucket.append(ids[spot] + np.int32((len(kinds) + 1) << BITS))
    owner, bucket = np.concatenate(owner), np.concatenate(bucket)
    bucket = bucket[np.argsort(owner, kind="stable")]
    edge = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=len(lexicon)))])
    del owner
    flat = weights.reshape(count, -1)
    seen, seen_t = np.full(flat.shape, 1e-6, np.float32), np.full(transitions.shape, 1e-6)
    batch = 128
    for _ in range(epochs):
        for at in np.array_split(rng.permutation(len(place)), max(1, len(place) // batch)):
            spots, y = place[at].ravel(), label[at].ravel()
            n = edge[spots + 1] - edge[spots]
            feature = bucket[np.repeat(edge[spots], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
            word = np.repeat(np.arange(len(spots)), n)
            emission = np.stack([np.bincount(word, f[feature], len(spots)) for f in flat], 1).reshape(len(at), CHAIN, count)
            post, pair = _expected(emission, transitions)
            grad = post.reshape(-1, count)
            grad[np.arange(len(y)), y] -= 1
            used, slot = np.unique(feature, return_inverse=True)
            for k in range(count):
                g = (np.bincount(slot, grad[word, k], len(used)) / len(at)).astype(np.float32)
                seen[k, used] += g * g
                flat[k, used] -= rate * g / np.sqrt(seen[k, used])
            real = np.zeros((count, count))
            np.add.at(real, (label[at][:, :-1].ravel(), label[at][:, 1:].ravel()), 1)
            g = (pair - real) / len(at)
            seen_t += g * g
            transitions -= rate * g / np.sqrt(seen_t)
    return Model(languages, weights, transitions)


def _expected(emission: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Posteriors, and expected counts of transitions, of chains of one length."""
    e = np.exp(emission - emission.max(2, keepdims=True))
    step = np.exp(transitions - transitions.max())
    n, length, count = e.shape
    forward, backward = np.empty_like(e), np.ones_like(e)
    forward[:, 0] = e[:, 0] / e[:, 0].sum(1, keepdims=True)
    for t in range(1, length):
        m = (forward[:, t - 1] @ step) * e[:, t]
        forward[:, t] = m / m.sum(1, keepdims=True)
    pair = np.zeros((count, count))
    for t in range(length - 1, 0, -1):
        into = e[:, t] * backward[:, t]
        both = forward[:, t - 1, :, None] * step * into[:, None, :]
        pair += (both / both.sum((1, 2), keepdims=True)).sum(0)
        m = into @ step.T
        backward[:, t - 1] = m / m.sum(1, keepdims=True)
    post = forward * backward
    return post / post.sum(2, keepdims=True), pair


def fit(docs: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns text and lang of documents that are not held out; ``sample`` bounds the documents of each language."""
    known = docs.where("lang is not null and text is not null").where(crc_mod(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")
    # one pass over ids for all languages, cut to the sample before any shuffle, and one for the sampled texts
    nth = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    picked = known.select("doc_id", "lang").withColumn("nth", nth).where(F.col("nth") <= sample).select(F.col("doc_id").alias("of"), F.col("lang").alias("of_lang")).distinct()
    rows = known.join(F.broadcast(picked), F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("lang") == F.col("of_lang")))  # at most sample rows a language
    rows = rows.groupBy("doc_id", "lang").agg(F.min("text").alias("text"))  # of rows that repeat an id, one is learned
    rows = sorted(((r.doc_id, r.lang, r.text) for r in rows.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    return train([t for _, _, t in rows], [x for _, x, _ in rows])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """A row per document: doc_id, lang_pred, score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                names, scores = model.predict(part.column("text"))
                lettered_ = part.column("lettered").to_numpy(zero_copy_only=False)
                names = [x if ok else UNKNOWN for x, ok in zip(names, lettered_, strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(names, pa.string()), pa.array(np.where(lettered_, scores, 1.0))], names=["doc_id", "lang_pred", "score"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("lettered")
    return docs.select("doc_id", "text", letters).mapInArrow(run, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.35) -> DataFrame:
    """The documents, with their own columns, that are in a learned language with a score of ``least`` or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                names, scores = model.predict(part.column("text"))
                keep = (scores >= least) & (np.array(names, object) != UNKNOWN)
                yield part.filter(pa.array(keep))

    return docs.where(F.col("text").rlike(r"\p{L}")).mapInArrow(run, docs.schema)
