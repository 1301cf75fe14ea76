"""URL filters by a sort-merge range join.

A rule (host, path) becomes the interval of all keys that start with its own key: the host's labels from the
last to the first, each closed by a low character, a higher character, and the path. An url becomes one probe
for each suffix of its host's labels, so that a rule of a parent host is a prefix of one of the probes. Rules
and probes are cut into ranges of keys, a rule going to every range that its interval meets, and each range is
swept in key order with a stack of the rules that are open; the stack's top is the longest rule that fits.
Bounds between the ranges come from a bounded sample of keys and only balance the work. Ties between rows of a
key are broken by the row's id, so that a host or an url that holds most of the rows is spread over ranges.
Memory is the stack: as many rules as are nested.

Defined cases: a url that is null or has no ``://`` has an empty host and path; rules of an empty host fit none
but those; where rules are equal, block wins; no rule: the default verdict, ``allow``. Only the id and url columns
are read, so columns of other names do no harm; null ids and repeated rows each keep their row. An url of any length gives as many probes as the deepest rule has
labels, at most; a host may hold any character. An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import parts, stored

#: Marks in keys: of a label's end, of the path's start, and before a character of a host that looks like a mark.
_LABEL, _PATH, _ESCAPE = "\x01", "\x02", "\x03"
#: Keys sampled to choose the bounds of ranges.
SAMPLE = 8192
DEFAULT = "allow"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    text = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _labels(name: Column) -> Column:
    """The labels of a host, the empty one of one, without marks."""
    for k, mark in enumerate((_ESCAPE, _LABEL, _PATH)):
        name = F.replace(name, F.lit(mark), F.lit(_ESCAPE + "abc"[k]))
    return F.split(name, r"\.")


def _host_key(labels: Column) -> Column:
    return F.concat(F.array_join(F.reverse(labels), _LABEL), F.lit(_LABEL))


def _probes(rows: DataFrame, deepest: int) -> DataFrame:
    """A row for each suffix of the host's labels that is no longer than the deepest rule's host."""
    labels = _labels(F.col("host"))
    suffixes = F.transform(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(deepest))), lambda n: F.concat(_host_key(F.slice(labels, -n, n)), F.lit(_PATH), F.col("path")))
    return rows.select("row_id", F.explode(suffixes).alias("key"))


_DEALT = pa.schema([("range", pa.int32()), ("key", pa.string()), ("is_probe", pa.bool_()), ("row_id", pa.int64()), ("rule", pa.string()), ("verdict", pa.string())])


def _deal_probes(bounds: list[tuple[str, int]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, keys = batch.column("row_id").to_pylist(), batch.column("key").to_pylist()
            at = [bisect_right(bounds, place) for place in zip(keys, rows, strict=True)]
            none = pa.nulls(len(rows), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), batch.column("key"), pa.array([True] * len(rows)), batch.column("row_id"), none, none], schema=_DEALT)

    return run


def _deal_rules(bounds: list[tuple[str, int]]):
    """A rule to every range that holds keys which start with its own; nested rules only meet at few bounds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.to_pylist():
                key = x["key"]
                first = bisect_right(bounds, (key, -1))
                last = bisect_right(bounds, key, key=lambda b, k=key: b[0][: len(k)])
                out += [{"range": r, "key": key, "is_probe": False, "row_id": -1, "rule": x["rule"], "verdict": x["verdict"]} for r in range(first, last + 1)]
            yield pa.RecordBatch.from_pylist(out, schema=_DEALT)

    return run


SWEPT = pa.schema([("row_id", pa.int64()), ("rule", pa.string()), ("verdict", pa.string()), ("length", pa.int64())])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by range, then key; the rules of a key come before its probes."""
    at, stack = None, []
    for batch in batches:
        found: list[tuple] = []
        cols = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
        for rng, key, is_probe, row, rule, verdict in zip(*cols, strict=True):
            if rng != at:
                at, stack = rng, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if not is_probe:
                stack.append((key, rule, verdict))
            elif stack:
                found.append((row, stack[-1][1], stack[-1][2], len(stack[-1][1])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), SWEPT.types, strict=True)], schema=SWEPT)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = DEFAULT) -> DataFrame:
    """Rows ``(id, host, path, rule, verdict)``. ``rules`` has host, path and verdict (allow or block)."""
    spark = pages.sparkSession
    n = parts(spark)
    named = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    numbered = stored(named.withColumn("row_id", F.monotonically_increasing_id()), "urls")
    host_of = F.lower("host")
    deepest = rules.agg(F.max(F.size(_labels(host_of)))).first()[0] or 1
    probes = _probes(numbered, deepest)
    sample = probes.select("key", "row_id").orderBy(F.xxhash64("key", "row_id")).limit(SAMPLE).sort("key", "row_id").collect()  # at most SAMPLE keys
    ranges = 2 * n
    cuts = [sample[i * len(sample) // ranges] for i in range(1, ranges)] if sample else []
    bounds = sorted({(c.key, c.row_id) for c in cuts})
    dealt_type = "range int, key string, is_probe boolean, row_id long, rule string, verdict string"
    probes = probes.mapInArrow(_deal_probes(bounds), dealt_type)
    intervals = rules.select(
        F.concat(_host_key(_labels(host_of)), F.lit(_PATH), F.coalesce("path", F.lit(""))).alias("key"), F.concat(F.lower("host"), F.coalesce("path", F.lit(""))).alias("rule"), "verdict",
    ).groupBy("key", "rule").agg(F.max("verdict").alias("verdict")).mapInArrow(_deal_rules(bounds), dealt_type)
    dealt = probes.unionByName(intervals).repartition(n, "range").sortWithinPartitions("range", "key", "is_probe", "row_id")
    hits = dealt.mapInArrow(_sweep, "row_id long, rule string, verdict string, length long")
    best = hits.groupBy("row_id").agg(F.max(F.struct("length", "rule", "verdict")).alias("best"))
    return numbered.join(best, "row_id", "left").select(F.col("id").alias(id_col), "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
