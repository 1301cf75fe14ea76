"""What the operators of this subpackage share: shared storage, word hashing, hash lanes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.storage import shared_dir

#: Words, as all contracts of this subpackage define them.
WORD = r"[^\x20\x09-\x0D]+"


#: Folders made in the shared folder and not deleted yet.
MADE: list[str] = []


def new_path(spark: SparkSession, name: str) -> str:
    MADE.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return MADE[-1]


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: cuts the lineage, and survives the loss of any executor."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*frames: DataFrame) -> None:
    """Delete tables written by :func:`stored` that nothing reads any more."""
    for df in frames:
        if path := getattr(df, "_stored_at", None):
            sweep(df.sparkSession, [path])


def sweep(spark: SparkSession, paths: list[str] | None = None, keep: DataFrame | None = None) -> None:
    """Delete folders of ours, all by default but the one of ``keep``: for when every result is written elsewhere."""
    for path in list(MADE if paths is None else paths):
        if keep is None or path != keep._stored_at:
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
            if path in MADE:
                MADE.remove(path)


def parts(spark: SparkSession) -> int:
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))


def crc_mod(column: Column, n: int) -> Column:
    """crc32 of the id as text, mod n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- words of an Arrow column, hashed without a Python loop over words ---------------------------

_rng = np.random.default_rng(20240115)
_TABLE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _TABLE.copy()
_LOWER[65:91] = _TABLE[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 2**64)
_powers: dict[int, np.ndarray] = {}
#: Bytes that are hashed at a time; bounds the memory, not the text.
SEGMENT = 1 << 21


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, SEGMENT + 1)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.cumprod(have)
        _powers[base] = have
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit over all output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the n+1 offsets of its texts; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Segments of about SEGMENT bytes that end where no word goes on."""
    at, n = 0, len(data)
    while at < n:
        to = min(n, at + SEGMENT)
        if to < n:
            edge = offsets[np.searchsorted(offsets, to, "right") - 1]
            if edge > at:
                to = int(edge)
            else:
                while to < n:
                    gap = np.flatnonzero(_SPACE[data[to : to + 65536]])
                    if len(gap):
                        to += int(gap[0])
                        break
                    to = min(n, to + 65536)
                after = offsets[np.searchsorted(offsets, at, "right")]
                to = min(to, int(after)) if after > at else to
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, length and 64-bit hash of each word, and the n+1 offsets of each text's words.

    The hash of a word is a difference of two prefix sums of ``table[byte] * base**position`` modulo 2**64,
    divided by ``base**start``, so a segment takes a few array operations whatever its words."""
    table = _LOWER if lower else _TABLE
    starts, lengths, hashes = [], [], []
    with np.errstate(over="ignore"):
        for a, b in _cuts(data, offsets):
            part = data[a:b]
            black = ~_SPACE[part]
            edges = offsets[np.searchsorted(offsets, a) : np.searchsorted(offsets, b)] - a
            before = np.empty_like(black)
            before[0] = False
            before[1:] = black[:-1]
            before[edges] = False
            after = np.empty_like(black)
            after[-1] = False
            after[:-1] = black[1:]
            after[edges[edges > 0] - 1] = False
            s = np.flatnonzero(black & ~before)
            e = np.flatnonzero(black & ~after) + 1
            prefix = np.empty(len(part) + 1, np.uint64)
            prefix[0] = 0
            np.cumsum(table[part] * _power(_BASE, len(part))[: len(part)], out=prefix[1:])
            h = (prefix[e] - prefix[s]) * _power(_BACK, len(part))[s]
            starts.append(s + a)
            lengths.append(e - s)
            hashes.append(mix(h + (e - s).astype(np.uint64)))
    if not starts:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    start = np.concatenate(starts)
    return start, np.concatenate(lengths), np.concatenate(hashes), np.searchsorted(start, offsets)


def pieces(batch: pa.RecordBatch, column: str, size: int = SEGMENT) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``size`` bytes of text; a longer text is a slice of its own."""
    _, offsets = text_bytes(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield batch.slice(at, min(to, n) - at)
        at = to


# --- hashed character n-grams with word ends, over whole batches of bytes -----------------------

_TAB = np.random.default_rng(577215).integers(0, 2**64, (8, 256), dtype=np.uint64)


def stream(data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """The texts' bytes with a space before each and at the end, all white space as a space, and where each text's space is."""
    n = len(offsets) - 1
    out = np.full(len(data) + n + 1, 32, np.uint8)
    starts = offsets[:-1] + np.arange(n)
    body = data.copy()
    body[_SPACE[body]] = 32
    if lower:
        capital = (body >= 65) & (body <= 90)
        body[capital] += 32
    if n == 1:
        out[1:-1] = body
    elif n:
        out[np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(offsets))] = body
    return out, starts


def grams(text: np.ndarray, orders: tuple[int, ...], bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the bucket of the n-gram at each byte and whether it is one: of one word, with the spaces at its ends."""
    white = np.cumsum(np.concatenate([[0], text == 32]), dtype=np.int64)
    h = np.zeros(len(text), np.uint64)
    done = 0
    for n in orders:
        for k in range(done, n):
            h[: max(0, len(text) - k)] ^= _TAB[k][text[k:]]
        done = n
        count = max(0, len(text) - n + 1)
        inside = white[n - 1 : n - 1 + count] - white[1 : 1 + count] if n > 2 else (white[2 : 2 + count] - white[:count] == 2)
        yield ((h[:count] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int32), inside == 0


def segments(data: np.ndarray, size: int = SEGMENT) -> Iterator[np.ndarray]:
    """One text's bytes in segments that end between words."""
    for a, b in _cuts(data, np.array([0, len(data)], np.int64)) if len(data) > size else [(0, len(data))]:
        yield data[a:b]
