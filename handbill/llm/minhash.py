"""Near-duplicate components by min-max hashing.

Under each of ``PERMUTATIONS`` hash functions a document keeps both the minimum and the maximum over its
shingles: two values for one evaluation, each equal between two documents with the probability of their
Jaccard index J, and negatively correlated, so the estimate is unbiased with less variance. Some minima, or maxima, make a
band; the rows of a band are as many as keep the chance that a pair at the threshold shares no band below ``MISS``.

Documents of one set are one class first (a sum of hashes, pre-aggregated), so copies never meet in a band.
In a band, classes are not paired with each other: all are compared with the band's pivot, its smallest class,
on their full sets. That joins groups of near copies at the cost of one comparison a member. Bands whose classes then lie in more than
one component are open. Their classes get a second, five times longer min-max signature, of which longer bands
and one bit of each value, of four times as many, are kept. In each longer band, the classes outside its largest component meet the classes of other components whose bits differ in few
places (five standard deviations beyond what the threshold gives); these pairs are confirmed on full sets too.
So every pair that shares the bands and could join two components is decided, none is capped, and the pairs of one component cost nothing.

Defined cases: null, empty and blank texts have no shingles and are linked with nothing; with fewer words than ``k`` the whole sequence
is one shingle; rows of one doc_id are one node; a null doc_id links with nothing, its component is null and it is kept.
Repeated rows are rows of one class, ties go to the smallest doc_id; texts of any length are read whole; an empty table gives an empty one. Only doc_id and text
are read, so columns of other names do no harm; ``deduplicated`` keeps them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, mix, pieces, stored, text_bytes, words
from .components import components

PERMUTATIONS, LONG_PERMUTATIONS = 50, 256
#: Hash functions of the one-bit signature; the first LONG_PERMUTATIONS make the longer bands.
BIT_PERMUTATIONS = 1024
#: The chance that a pair at the threshold shares no band, at most.
MISS = 2e-5

_rng = np.random.default_rng(8128)
_A = _rng.integers(0, 2**63, BIT_PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BIT_PERMUTATIONS, dtype=np.uint64)
_PLACE = _rng.integers(0, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def band_rows(similarity: float, permutations: int) -> int:
    """The most rows to a band that keep the chance to miss a pair at the threshold below MISS."""
    fits = [r for r in range(1, permutations + 1) if (1 - similarity**r) ** (2 * (permutations // r)) <= MISS]
    return max(fits, default=1)


def shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, ascending, and their n+1 offsets."""
    data, offsets = text_bytes(column)
    _, _, h, at = words(data, offsets, lower=True)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(h) - k + 1), np.uint64)
        for i in range(k):
            rolled += h[i : i + len(rolled)] * _PLACE[i]
        rolled = mix(rolled)
        sets = []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if b - a >= k:
                sets.append(np.unique(rolled[a : b - k + 1]))
            elif b > a:
                sets.append(mix((h[a:b] * _PLACE[: b - a]).sum(keepdims=True) + np.uint64(b - a)))
            else:
                sets.append(h[:0])
    return np.concatenate(sets) if sets else h[:0], np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64)


def _extremes(values: np.ndarray, first: np.ndarray, p: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each set, the least and the largest value under one hash function."""
    v = values * _A[p] + _B[p]
    v ^= v >> np.uint64(32)
    return np.minimum.reduceat(v, first), np.maximum.reduceat(v, first)


def bands(values: np.ndarray, at: np.ndarray, rows: int, permutations: int = PERMUTATIONS, bits: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of the sets, a row each, and one bit of each value of ``bits`` hash functions in 64-bit words; the sets are not empty."""
    first = at[:-1]
    count = permutations // rows
    out = np.empty((len(first), 2 * count), np.uint64)
    packed = np.zeros((len(first), 2 * bits // 64), np.uint64)
    with np.errstate(over="ignore"):
        for p in range(max(count * rows, bits)):
            least, most = _extremes(values, first, p)
            band, row = divmod(p, rows)
            if band < count:
                for k, x in ((2 * band, least), (2 * band + 1, most)):
                    out[:, k] = mix((out[:, k] if row else np.uint64(k + 1)) + x * _PLACE[row])
            if p < bits:
                for k, x in ((2 * p, least), (2 * p + 1, most)):
                    packed[:, k // 64] |= (mix(x) & np.uint64(1)) << np.uint64(k % 64)
    return out, packed


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("s1", pa.int64()), ("s2", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _sign(k: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                values, at = shingles(part.column("text"), k)
                n = np.diff(at)
                some = n > 0
                sums = np.zeros((2, len(n)), np.uint64)
                count = 2 * (PERMUTATIONS // rows)
                keys = np.zeros((len(n), count), np.uint64)
                if some.any():
                    full = np.append(at[:-1][some], at[-1])
                    with np.errstate(over="ignore"):
                        sums[0, some] = np.add.reduceat(mix(values ^ np.uint64(0x51ED)), full[:-1])
                        sums[1, some] = np.add.reduceat(mix(values * np.uint64(0x2545F4914F6CDD1D)), full[:-1])
                    keys[some] = bands(values, full, rows)[0]
                flat = pa.array(keys[some].ravel().view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(some * count)]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n), pa.array(sums[0].view(np.int64)), pa.array(sums[1].view(np.int64)), lists], schema=_SIGNED)

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                values, at = shingles(part.column("text"), k)
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values.view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), lists], names=["id", "set"])

    return run


_LONG = pa.schema([("rep", pa.int64()), ("bands", pa.list_(pa.int64())), ("brief", pa.list_(pa.int32())), ("bits", pa.list_(pa.int64()))])


def _sign_longer(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for x in range(0, batch.num_rows, 512):
                part = batch.slice(x, 512)
                lists = part.column("set")
                at = lists.offsets.to_numpy().astype(np.int64)
                values = lists.flatten().to_numpy().view(np.uint64)
                keys, packed = bands(values, at - at[0], rows, LONG_PERMUTATIONS, BIT_PERMUTATIONS)
                flat = lambda m: pa.ListArray.from_arrays(pa.array(np.arange(len(m) + 1) * m.shape[1], pa.int32()), pa.array(m.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("id"), flat(keys.view(np.int64)), flat((keys >> np.uint64(32)).astype(np.uint32).view(np.int32)), flat(packed.view(np.int64))], schema=_LONG)

    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    left, right = (sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}")) for x in "ab")
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(100 * common >= percent * (F.size("set_a") + F.size("set_b") - common)).select("a", "b")


def near_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """A row per row of ``docs``: doc_id, n_shingles, component_id (the smallest doc_id that it reaches over links of
    ``percent`` or more), kept (whether that is its own)."""
    similarity = percent / 100
    texts = docs.select("doc_id", "text")
    signed = stored(texts.mapInArrow(_sign(k, band_rows(similarity, PERMUTATIONS)), "doc_id long, n long, s1 long, s2 long, bands array<long>"), "near-signed")
    key = ["n", "s1", "s2"]
    classes = stored(signed.where("n > 0 and doc_id is not null").groupBy(*key).agg(F.min("doc_id").alias("rep"), F.min_by("bands", "doc_id").alias("bands")), "near-classes")
    placed = classes.select("rep", "n", F.explode("bands").alias("band"))
    shared = placed.groupBy("band").agg(F.min(F.struct("rep", "n")).alias("pivot"), F.count("*").alias("m")).where("m > 1")
    members = stored(placed.join(shared.select("band", "pivot"), "band"), "near-members")

    def similar(n: str, m: str):
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)

    star = members.where("rep <> pivot.rep").where(similar("n", "pivot.n")).select(F.col("pivot.rep").alias("a"), F.col("rep").alias("b"))
    reps = members.select(F.col("rep").alias("of")).distinct()
    sets = stored(texts.join(reps.hint("merge"), F.col("doc_id") == F.col("of"), "left_semi").dropDuplicates(["doc_id", "text"]).mapInArrow(_sets(k), "id long, set array<long>"), "near-sets")
    links = stored(_confirmed(star.distinct(), sets, percent), "near-links")
    labels = components(links)
    # what lies in bands of more than one component
    here = stored(members.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select("band", "rep", "n", F.coalesce("label", "rep").alias("label")), "near-here")
    split = here.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("m")).where("low <> high and m > 2").select("band")
    open_ = stored(here.join(split, "band", "left_semi").groupBy("rep").agg(F.first("n").alias("n"), F.first("label").alias("label")), "near-open")
    rows = band_rows(similarity, LONG_PERMUTATIONS)
    longer = sets.join(open_, F.col("id") == F.col("rep"), "left_semi").where(F.size("set") > 0).mapInArrow(_sign_longer(rows), "rep long, bands array<long>, brief array<int>, bits array<long>")
    longer = stored(longer.join(open_, "rep").select("rep", "n", "label", "brief", "bits", F.posexplode("bands").alias("nth", "band")), "near-longer")
    sizes = longer.groupBy("band", "label").agg(F.count("*").alias("m")).groupBy("band").agg(F.max_by("label", F.struct("m", "label")).alias("main"), F.count("*").alias("parts")).where("parts > 1").select("band", "main")
    mixed = longer.join(sizes, "band")
    p = (1 - similarity) / 2
    n_bits = 2 * BIT_PERMUTATIONS
    far = int(n_bits * p + 5 * (n_bits * p * (1 - p)) ** 0.5)
    some, other = mixed.where("label <> main").alias("x"), mixed.alias("y")
    differ = sum((F.bit_count(F.get("x.bits", i).bitwiseXOR(F.get("y.bits", i))) for i in range(n_bits // 64)), F.lit(0))
    before = F.zip_with(F.slice("x.brief", F.lit(1), F.col("x.nth")), F.slice("y.brief", F.lit(1), F.col("x.nth")), lambda a, b: a == b)  # a pair meets in its first band only
    meet = (F.col("x.band") == F.col("y.band")) & (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))) & similar("x.n", "y.n") & (differ <= far) & ~F.exists(before, lambda c: c)
    pairs = some.join(other, meet).select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b")).distinct()
    found = stored(_confirmed(pairs, sets, percent), "near-found")
    discard(members, here, open_, longer)
    if not found.isEmpty():
        labels = components(links.unionByName(found))
    named = classes.join(labels.select(F.col("node").alias("rep"), "label"), "rep", "left").select(*(F.col(c).alias(f"c_{c}") for c in key), F.coalesce("label", "rep").alias("label"))
    discard(sets, links, found)
    rows = signed.select("doc_id", *key).join(named, F.expr("n = c_n and s1 = c_s1 and s2 = c_s2 and doc_id is not null"), "left")
    component = F.coalesce("label", "doc_id")
    return rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, that of the smallest doc_id, with its own columns; rows that repeat its doc_id stay with it."""
    gone = near_components(docs, k, percent).where("not kept").select(F.col("doc_id").alias("__near_id")).distinct()
    return docs.join(gone.hint("merge"), docs["doc_id"] == gone["__near_id"], "left_anti").select(*(docs[c] for c in docs.columns))
