"""Document fingerprints from prefix polynomial hashes.

``Prefix`` holds, for two primes, the sums of ``c[j] * base**j`` over all prefixes of a text's code points. Any
two spans, of one text or of two, compare in constant time, and the longest common extension of two places is
found by binary search. A fingerprint holds the length, hashes of the whole text, and the ``SKETCH`` least mixed
hashes of all distinct spans of ``SPAN`` code points (a shorter text is one span). The likeness of two fingerprints is the
share of common spans, 2J / (1 + J) of the estimated Jaccard index J: about the share of a text that is kept. Where the common
prefix and suffix, which the prefix arrays give, are a larger share of the longer text, that is the likeness: so texts too short for many spans are compared too.

Each document is linked with its successor by doc_id: documents are dealt to ranges of doc_id whose bounds
are percentiles, the least row of each range also goes to the end of the range before it, and each range is read in
order, one text at a time. Memory is a text and its arrays, and a bound for each range.

Defined cases: a null text is empty; null doc_ids come first; rows of one doc_id are ordered by text; a single
document is its own successor; two empty texts are alike by 1, an empty and another by 0; rows that repeat a document follow one another; a text of any length is read
whole, by one task; an empty table gives an empty one. Null ids, if many, are all in the first range. Only doc_id and text are read, so columns of other names do no harm.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, parts

#: Three primes below 2**31 and their bases.
PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (911382323, 972663749, 1337031523)
SPAN, SKETCH = 32, 64
#: Ranges of doc_id to a task.
RANGES = 8

_tables: dict[int, np.ndarray] = {}


def _powers(lane: int, n: int) -> np.ndarray:
    have = _tables.get(lane)
    if have is None or len(have) < n:
        p, have = PRIMES[lane], np.array([1], np.uint64)
        while len(have) < max(n, 1 << 16):
            step = np.uint64(pow(BASES[lane], len(have), p))
            have = np.concatenate([have, have * step % np.uint64(p)])
        _tables[lane] = have
    return have[:n]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)


class Prefix:
    """Prefix hashes of a text's code points (each plus 1)."""

    def __init__(self, codes: np.ndarray, kept: tuple[Prefix, int] | None = None):
        """``kept``: the prefix arrays of another text and how many of its code points begin this one."""
        self.codes, self.n = codes, len(codes)
        self.sums = []
        for lane in (0, 1):
            p, skip = np.uint64(PRIMES[lane]), kept[1] if kept else 0
            out = np.empty(self.n + 1, np.uint64)
            out[: skip + 1] = kept[0].sums[lane][: skip + 1] if kept else 0
            terms = codes[skip:] * _powers(lane, self.n)[skip:] % p
            np.cumsum(terms, out=out[skip + 1 :])
            out[skip + 1 :] = (out[skip + 1 :] + out[skip]) % p
            self.sums.append(out)

    def whole(self) -> tuple[int, ...]:
        p = np.uint64(PRIMES[2])
        third = int((self.codes * _powers(2, self.n) % p).sum() % p) if self.n else 0
        return (int(self.sums[0][-1]), int(self.sums[1][-1]), third)

    def span(self, start: int, length: int, shift: int) -> tuple[int, ...]:
        """The hash of a span, brought to the power ``shift``, at least its start."""
        return tuple((int(s[start + length]) - int(s[start])) * pow(BASES[k], shift - start, PRIMES[k]) % PRIMES[k] for k, s in enumerate(self.sums))

    def equal(self, start: int, other: Prefix, at: int, length: int) -> bool:
        shift = max(start, at)
        return self.span(start, length, shift) == other.span(at, length, shift)

    def extension(self, start: int, other: Prefix, at: int) -> int:
        """How many code points from ``start`` here equal those from ``at`` there, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            mid = (low + high + 1) // 2
            if self.equal(start, other, at, mid):
                low = mid
            else:
                high = mid - 1
        return low

    def spans(self, length: int = SPAN) -> np.ndarray:
        """Mixed 64-bit hashes of all spans of ``length``; of a shorter text, the one of it all."""
        if not self.n:
            return np.zeros(0, np.uint64)
        length = min(length, self.n)
        count = self.n - length + 1
        lanes = []
        for lane, s in enumerate(self.sums):
            p = np.uint64(PRIMES[lane])
            raised = (s[length:] + p - s[:count]) % p * _powers(lane, count)[::-1] % p  # all brought to the power count - 1
            back = pow(BASES[lane], 1 - count, PRIMES[lane])
            lanes.append(raised * np.uint64(back) % p)
        return mix(lanes[0] << np.uint64(31) | lanes[1])


def least(hashes: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The k least distinct values, ascending."""
    take = 4 * k
    while True:
        some = np.unique(hashes if take >= len(hashes) else np.partition(hashes, take)[:take])
        if len(some) >= k or take >= len(hashes):
            return some[:k]
        take *= 4


def fingerprint(prefix: Prefix) -> tuple[str, np.ndarray]:
    sketch = least(prefix.spans())
    head = f"{prefix.n:x}." + "".join(f"{x:08x}" for x in prefix.whole())
    return f"{head}.{base64.b64encode((sketch >> np.uint64(24)).astype('>u8').view(np.uint8).reshape(-1, 8)[:, 3:].tobytes()).decode()}", sketch


def sketch_of(text: str) -> np.ndarray:
    """The sketch that a fingerprint holds."""
    raw = np.frombuffer(base64.b64decode(text.rpartition(".")[2]), np.uint8).reshape(-1, 5)
    return np.concatenate([np.zeros((len(raw), 3), np.uint8), raw], axis=1).copy().view(">u8").reshape(-1).astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray, k: int = SKETCH) -> float:
    """Of two sketches; of full ones it is an estimate, of smaller ones exact."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:k]
    shared = len(np.intersect1d(np.intersect1d(a, b, assume_unique=True), both, assume_unique=True))
    j = shared / len(both)
    return 2 * j / (1 + j)


_FIELDS = [
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
    ("near_edited", pa.float64()), ("near_next", pa.float64()), ("common_prefix", pa.int64()), ("common_suffix", pa.int64()),
]
_SCHEMA = pa.schema(_FIELDS)
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, common_prefix long, common_suffix long"


def suffix(a: Prefix, b: Prefix) -> int:
    """How many code points at the ends are equal, by the same search as for extensions."""
    low, high = 0, min(a.n, b.n)
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a.equal(a.n - mid, b, b.n - mid, mid) else (low, mid - 1)
    return low


def alike(a: Prefix, b: Prefix, sketches: float, ends: tuple[int, int]) -> float:
    """The larger of the sketches' likeness and the share of common ends."""
    return max(sketches, min(a.n, b.n, sum(ends)) / max(a.n, b.n)) if a.n and b.n else sketches


class _Document:
    def __init__(self, doc_id, text):
        self.doc_id, self.text = doc_id, text or ""
        self.prefix = Prefix(code_points(self.text))
        self.print, self.sketch = fingerprint(self.prefix)
        self.sketch = self.sketch >> np.uint64(24)

    def row(self, after: _Document) -> tuple:
        n = self.prefix.n
        cut = n - n // 4
        new = after.text[: n // 4]
        edited = self.text[:cut] + new
        prefix = Prefix(np.concatenate([self.prefix.codes[:cut], after.prefix.codes[: n // 4]]), (self.prefix, cut))
        mark, sketch = fingerprint(prefix)
        sketch = sketch >> np.uint64(24)
        sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
        ends = self.prefix.extension(0, prefix, 0), suffix(self.prefix, prefix)
        next_ends = self.prefix.extension(0, after.prefix, 0), suffix(self.prefix, after.prefix)
        near = alike(self.prefix, prefix, likeness(self.sketch, sketch), ends)
        return self.doc_id, n, sha, self.print, mark, near, alike(self.prefix, after.prefix, likeness(self.sketch, after.sketch), next_ends), *ends


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range and order; the last of each range is the first of the next one."""
    last, at, out, size = None, None, [], 0
    for batch in batches:
        for k in range(batch.num_rows):
            rng, doc_id, text, _ = (batch.column(i)[k].as_py() for i in range(4))
            here = _Document(doc_id, text)
            if rng == at:
                out.append(last.row(here))
                size += 1
            at, last = rng, here
            if size >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _FIELDS, strict=True)], schema=_SCHEMA)
                out, size = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out, strict=True), _FIELDS, strict=True)], schema=_SCHEMA)


def fingerprints(docs: DataFrame) -> DataFrame:
    """A row per document: its fingerprint, that of its edited text (the last quarter replaced by the start of its
    successor), the likeness of its own to the edited text's and the successor's, and the common prefix and suffix."""
    spark = docs.sparkSession
    n = parts(spark)
    rows = docs.select("doc_id", "text")
    # several ranges to a task, as their hashes deal them unevenly
    share = [i / (RANGES * n) for i in range(1, RANGES * n)]
    cuts = rows.agg(F.percentile_approx("doc_id", share, 10 * RANGES * n).alias("at")).first()["at"]
    bounds = sorted(set(cuts or []))

    @F.pandas_udf("int")
    def range_of(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(np.array(bounds, np.int64), ids.to_numpy(), "right"))

    known = F.coalesce("doc_id", F.lit(-(2**63)).cast("long"))
    ids = rows.select("doc_id", F.sha2("text", 256).alias("sha"), range_of(known).alias("range"))
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", F.coalesce("sha", F.lit("")).alias("sha"))
    firsts = sorted((r.range, r.first) for r in ids.groupBy("range").agg(F.min(place).alias("first")).collect())  # a row per range
    if not firsts:
        return spark.createDataFrame([], _DDL)
    before = {rng: firsts[k - 1][0] for k, (rng, _) in enumerate(firsts)}
    heads = spark.createDataFrame([(rng, before[rng], f.doc_id, f.sha) for rng, f in firsts], "range int, before int, head_id long, head_sha string")
    tail = F.broadcast(heads)  # a row per range
    near = rows.withColumn("range", range_of(known))
    ends = near.join(F.broadcast(heads.select("head_id").distinct()), F.col("doc_id").eqNullSafe(F.col("head_id")), "left_semi")
    ends = ends.withColumn("sha", F.coalesce(F.sha2("text", 256), F.lit(""))).join(tail.select("before", "head_id", "head_sha"), F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.col("sha") == F.col("head_sha")))
    ends = ends.groupBy("before").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")).select(F.col("before").alias("range"), "doc_id", "text", F.lit(True).alias("tail"))
    dealt = near.select("range", "doc_id", "text", F.lit(False).alias("tail")).unionByName(ends).repartition(n, "range")
    return dealt.sortWithinPartitions("range", "tail", F.col("doc_id").asc_nulls_first(), F.sha2("text", 256)).mapInArrow(_read, _DDL)
