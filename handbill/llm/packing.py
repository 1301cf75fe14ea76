"""Packing into length buckets that minimise padding.

The bucket bounds are optimal: dynamic programming over the histogram of all lengths, where a bucket pads its
documents to its longest. dp[j] = min over i of dp[i] + length[j] * (count[j] - count[i]) - (sum[j] - sum[i]) is the lower
envelope of lines, read off in one pass for each bucket. The driver holds the histogram, a row for each distinct length.
In a bucket of bound L, batches of ``budget // max(L, 1)`` documents, one at least, hold at most the budget of padded tokens.
Documents of a bucket are numbered by doc_id, then length: within ranges of doc_id, that are moved on by the counts of the ranges before, so no
task orders a whole bucket, and batches are the same however the rows lie.

Length is the number of words unless another Column is given. Defined cases: a null or empty text has length 0;
repeated rows are packed each, null ids come first; rows that tie in doc_id and length are alike in all that is returned; a document longer than the budget is a batch of its own; texts of
any length are counted whole; an empty table packs nothing. Only doc_id and what the length reads are read, so columns of other names do no harm. The ranges are those of the session's
shuffle partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, parts, stored
from .mixing import n_words

BUCKETS, BUDGET = 16, 16384


def bounds(histogram: list[tuple[int, int]], buckets: int = BUCKETS) -> list[int]:
    """Ascending upper bounds of at most ``buckets`` buckets with the least padding in total; of equal ones, the fewest."""
    rows = sorted(histogram)
    m = len(rows)
    if not m:
        return []
    length = [x for x, _ in rows]
    count, total = [0], [0]
    for x, c in rows:
        count.append(count[-1] + c)
        total.append(total[-1] + x * c)
    best = [0] + [None] * m
    back: list[list[int]] = []
    costs = []
    for _ in range(min(buckets, m)):
        lines: list[tuple[int, int, int]] = []  # slope, intercept, i
        at, new, origin = 0, [None] * (m + 1), [0] * (m + 1)
        for j in range(1, m + 1):
            i = j - 1
            if best[i] is not None:
                line = (-count[i], best[i] + total[i], i)
                while len(lines) - at >= 2:
                    (s1, b1, _), (s2, b2, _) = lines[-2], lines[-1]
                    if (line[1] - b1) * (s1 - s2) <= (b2 - b1) * (s1 - line[0]):
                        lines.pop()
                    else:
                        break
                lines.append(line)
            x = length[j - 1]
            while at + 1 < len(lines) and lines[at + 1][0] * x + lines[at + 1][1] <= lines[at][0] * x + lines[at][1]:
                at += 1
            if at < len(lines):
                s, b, i = lines[at]
                new[j], origin[j] = s * x + b + x * count[j] - total[j], i
        best = new
        back.append(origin)
        costs.append(new[m])
    k = min(range(len(costs)), key=lambda k: (costs[k], k))
    out, j = [], m
    for level in reversed(range(k + 1)):
        out.append(length[j - 1])
        j = back[level][j]
    return sorted(out)


def packed(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, length: Column | None = None) -> DataFrame:
    """A row per document: doc_id, n_tokens, bucket, padded_to, batch (numbered within the bucket), slot."""
    spark = docs.sparkSession
    size = n_words(F.col("text")) if length is None else F.coalesce(length.cast("long"), F.lit(0))
    counted = stored(docs.select("doc_id", size.alias("n_tokens")), "packing-sizes")  # a table: to find the ranges reads it once more
    rows = counted.repartitionByRange(parts(spark), F.asc_nulls_first("doc_id"), "n_tokens")
    rows = stored(rows.withColumn("part", F.spark_partition_id()), "packing")  # a table: its ranges stay as they are
    discard(counted)
    histogram = [(r.n_tokens, r.n) for r in rows.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()]  # a row per distinct length
    tops = bounds(histogram, buckets)
    if not tops:
        return spark.createDataFrame([], "doc_id long, n_tokens long, bucket int, padded_to long, batch long, slot int")
    bucket = F.lit(len(tops) - 1)
    for k in reversed(range(len(tops) - 1)):
        bucket = F.when(F.col("n_tokens") <= tops[k], k).otherwise(bucket)
    dealt = rows.withColumn("bucket", bucket)
    before, offsets = {}, []
    for r in sorted(dealt.groupBy("bucket", "part").agg(F.count("*").alias("n")).collect()):  # at most buckets * ranges rows
        offsets.append((r.bucket, r.part, before.get(r.bucket, 0)))
        before[r.bucket] = before.get(r.bucket, 0) + r.n
    starts = F.broadcast(spark.createDataFrame(offsets, "bucket int, part int, start long"))
    nth = F.row_number().over(Window.partitionBy("bucket", "part").orderBy(F.asc_nulls_first("doc_id"), "n_tokens")) - 1
    top = F.element_at(F.array(*(F.lit(x).cast("long") for x in tops)), F.col("bucket") + 1)
    each = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest(top, F.lit(1)))).cast("long")
    numbered = dealt.withColumn("nth", nth).join(starts, ["bucket", "part"]).withColumn("nth", F.col("nth") + F.col("start"))
    return numbered.select("doc_id", "n_tokens", "bucket", top.alias("padded_to"), F.floor(F.col("nth") / each).cast("long").alias("batch"), (F.col("nth") % each).cast("int").alias("slot"))
