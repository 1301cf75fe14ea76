"""Exact top-k search by inner product over integer vectors.

Candidates are dealt to shards by descending length (norm); the bounds are percentiles of the squared lengths.
The eigenvectors of the sum of outer products, that is the right singular vectors of the table, turn all
vectors so that few leading coordinates carry most of each product. First every query meets the shard of the
longest vectors, which gives it a threshold, its k-th best score so far. Then it meets only shards whose longest
vector times its own length can reach that threshold. In a shard, blocks of queries pass blocks of
candidates of descending length; a pair whose leading partial sum plus the product of the residual lengths
(Cauchy-Schwarz) is below the threshold is pruned, and the others get their exact integer product. A shard is a
bounded number of vectors, and the queries that reach it are dealt to as many cells of the shard as there are times ``CELL`` of them, so a
task has a shard and about CELL queries, which stream past it.

Scores are exact: products of integers in float64 where they stay below 2**53, else Python integers. A score, or a component times the scale, that
does not fit in 64 bits (a double) is an error, not a wrong number.

Defined cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids; shorter
vectors are padded with zeros; of rows that repeat an id each is a candidate, and a query under one id, but none for its own id; ties go to the
smaller id; fewer candidates than k: all of them; an empty table gives an empty one. Only the id and vector columns are read, so columns of other names do no harm.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, parts, stored

#: Candidates to a shard, candidates and queries to a block of pairs, queries to a cell.
SHARD, BLOCK, QUERIES, CELL = 8192, 1024, 256, 4096
#: Share of the squared lengths that the leading coordinates carry.
ENERGY = 0.8


def quantized(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component as double; null where one is null or not finite."""
    # a double of 2**53 or more is whole
    doubles = F.transform(F.transform(vector, lambda x: x.cast("double") * scale), lambda x: F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x))
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(vector.isNotNull() & F.coalesce(ok, F.lit(False)), doubles)


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    column = column.cast(pa.large_list(pa.float64()))
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy()
    if len(lengths) and (lengths == dims).all():
        return values.reshape(-1, dims)
    out = np.zeros((len(lengths), dims))
    out[np.repeat(np.arange(len(lengths)), lengths), np.concatenate([np.arange(n) for n in lengths] or [np.zeros(0, int)])] = values
    return out


def _gram(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims, dims))
        for batch in batches:
            m = _matrix(batch.column("v"), dims)
            total += m.T @ m
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "r"])

    return run


def rotation(vectors: DataFrame, dims: int) -> tuple[np.ndarray, int]:
    """Singular vectors, strongest first, and how many of them carry ENERGY. The driver gets dims x dims sums."""
    rows = vectors.select("v").mapInArrow(_gram(dims), "i long, r array<double>").select("i", F.posexplode("r").alias("j", "x")).groupBy("i", "j").agg(F.sum("x").alias("x"))
    gram = np.zeros((dims, dims))
    for i, j, x in rows.collect():
        gram[i, j] = x
    values, turn = np.linalg.eigh(gram)
    values, turn = np.maximum(values[::-1], 0), turn[:, ::-1]
    share = np.cumsum(values) / max(values.sum(), 1e-300)
    return turn.copy(), int(min(dims, max(1, np.searchsorted(share, ENERGY) + 1)))


class Shard:
    """The candidates of a shard, longest first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, turn: np.ndarray, lead: int, k: int):
        order = np.lexsort((ids, -(vectors * vectors).sum(1)))
        self.ids, self.vectors, self.k, self.lead, self.turn = ids[order], vectors[order], k, lead, turn
        turned = self.vectors @ turn
        self.head, self.rest = turned[:, :lead], np.sqrt((turned[:, lead:] ** 2).sum(1))
        self.norm = np.sqrt((self.vectors**2).sum(1))
        self.peak = np.abs(self.vectors).max() if self.vectors.size else 0.0

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray) -> list[tuple[int, int, int]]:
        """The pairs that may be among a query's k best, given a lower bound of its k-th best score."""
        turned = queries @ self.turn
        head, rest, norm = turned[:, : self.lead], np.sqrt((turned[:, self.lead :] ** 2).sum(1)), np.sqrt((queries**2).sum(1))
        exact = queries.shape[1] * (np.abs(queries).max() if queries.size else 0.0) * self.peak < 2.0**53
        best: list[list[tuple[int, int]]] = [[] for _ in ids]
        floor = floor.astype(float).copy()
        for at in range(0, len(self.ids), BLOCK):
            to = at + BLOCK
            slack = 1e-9 * (1 + norm * self.norm[at])  # for rounding in the turned sums
            alive = np.flatnonzero(norm * self.norm[at] + slack >= floor)  # the block's first is its longest
            if not len(alive):
                break
            bound = head[alive] @ self.head[at:to].T + np.outer(rest[alive], self.rest[at:to])
            q, c = np.nonzero((bound + slack[alive, None] >= floor[alive, None]) & (ids[alive, None] != self.ids[None, at:to]))
            q, c = alive[q], c + at
            if not len(q):
                continue
            if exact:
                scores = np.einsum("ij,ij->i", queries[q], self.vectors[c]).astype(np.int64)
            else:
                scores = [sum(int(a) * int(b) for a, b in zip(queries[i], self.vectors[j], strict=True)) for i, j in zip(q, c, strict=True)]
                if max(scores) >= 2**63 or min(scores) < -(2**63):
                    raise OverflowError("a score does not fit in 64 bits")
                scores = np.array(scores, dtype=np.int64)
            order = np.lexsort((self.ids[c], -scores, q))
            q, c, scores = q[order], c[order], scores[order]
            first = np.searchsorted(q, q)
            keep = np.arange(len(q)) - first < self.k
            for i, j, s in zip(q[keep].tolist(), self.ids[c[keep]].tolist(), scores[keep].tolist(), strict=True):
                best[i].append((-s, j))
            for i in np.unique(q[keep]).tolist():
                best[i] = sorted(best[i])[: self.k]
                if len(best[i]) == self.k:
                    floor[i] = max(floor[i], -best[i][-1][0])
        return [(int(ids[i]), j, -s) for i, found in enumerate(best) for s, j in found]


_FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def _search(turn: np.ndarray, lead: int, k: int, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by cell, the candidates of its shard before its queries."""
        at, held, shard, ids = None, [], None, []

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows, strict=True)], schema=_FOUND)

        for batch in batches:
            shards, is_query = batch.column("cell").to_numpy(zero_copy_only=False), batch.column("is_query").to_numpy(zero_copy_only=False)
            all_ids, floors = batch.column("id").to_numpy(), batch.column("floor").to_numpy(zero_copy_only=False)
            vectors = _matrix(batch.column("v"), dims)
            edges = np.flatnonzero((np.diff(shards) != 0) | (np.diff(is_query.astype(int)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(shards)], strict=True):
                if a == b:
                    continue
                if shards[a] != at:
                    at, held, shard, ids = shards[a], [], None, []
                if not is_query[a]:
                    held.append(vectors[a:b])
                    ids.append(all_ids[a:b])
                    continue
                if shard is None:
                    if not held:
                        continue
                    shard = Shard(np.concatenate(ids), np.concatenate(held), turn, lead, k)
                for x in range(a, b, QUERIES):
                    y = min(b, x + QUERIES)
                    if found := shard.search(all_ids[x:y], vectors[x:y], floors[x:y]):
                        yield batch_of(found)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The k candidates of the highest inner product for each row where ``queries`` (over ``id``) holds, other than itself:
    query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), quantized(F.col(vector_col)).alias("v")).where("id is not null and v is not null")
    # the number of a row deals rows of one id and length to different shards
    rows = stored(rows.withColumns({"length": F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x), "nth": F.monotonically_increasing_id()}), "vectors")
    n, dims, most = rows.agg(F.count("*"), F.max(F.size("v")), F.max("length")).first()
    if not n:
        discard(rows)
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if most is None or not np.isfinite(most):
        raise OverflowError("a vector is too long for its inner products to fit in 64 bits")
    turn, lead = rotation(rows, max(1, dims))
    shards = max(1, -(-n // SHARD))
    cuts = rows.agg(F.percentile_approx("length", [i / shards for i in range(1, shards)] or [0.5], 20 * shards + 1000).alias("at")).first()["at"] if shards > 1 else []
    cuts = sorted(set(cuts))  # ascending squared lengths; shard 0 holds the longest

    @F.pandas_udf("int")
    def shard_of(length: pd.Series) -> pd.Series:
        return pd.Series(len(cuts) - np.searchsorted(np.array(cuts), length.to_numpy(), "right"))

    # equal lengths can overfill a shard: it is cut again by a hash
    placed = rows.withColumn("band", shard_of("length"))
    sizes = {r.band: (r.n, r.longest) for r in placed.groupBy("band").agg(F.count("*").alias("n"), F.max("length").alias("longest")).collect()}  # a row per shard
    start, firsts, reach = 0, {}, []
    for band in sorted(sizes):
        pieces = -(-sizes[band][0] // (2 * SHARD))
        firsts[band] = (start, pieces)
        reach += [float(np.sqrt(sizes[band][1]))] * pieces
        start += pieces
    table = spark.createDataFrame([(b, s, p) for b, (s, p) in firsts.items()], "of int, start int, pieces int")
    placed = placed.join(F.broadcast(table), F.col("band") == F.col("of")).select((F.col("start") + F.pmod(F.xxhash64("nth"), F.col("pieces"))).cast("int").alias("shard"), F.lit(False).alias("is_query"), "id", "v", "length", F.lit(0.0).alias("floor"))
    asked = rows.where(queries).select(F.lit(True).alias("is_query"), "id", "v", "length", "nth")
    run = _search(turn, lead, k, max(1, dims))
    columns = ["cell", "is_query", "id", "v", "floor"]

    def pass_over(candidates: DataFrame, probes: DataFrame) -> DataFrame:
        """Candidates go to every cell of their shard, queries to one of each shard that they reach."""
        at, cells = 0, []
        for r in sorted(probes.groupBy("shard").agg(F.count("*").alias("n")).collect()):  # a row per shard
            cells.append((r.shard, at, -(-r.n // CELL)))
            at += cells[-1][2]
        if not cells:
            return spark.createDataFrame([], "query_id long, vec_id long, score long")
        of = F.broadcast(spark.createDataFrame(cells, "cell_of int, first int, cells int"))
        here = candidates.join(of, F.col("shard") == F.col("cell_of")).withColumn("cell", F.explode(F.sequence("first", F.col("first") + F.col("cells") - 1)))
        there = probes.join(of, F.col("shard") == F.col("cell_of")).withColumn("cell", (F.col("first") + F.pmod(F.xxhash64("nth"), F.col("cells"))).cast("int"))
        dealt = here.select(columns).unionByName(there.select(columns)).repartition(max(parts(spark), at), "cell").sortWithinPartitions("cell", "is_query")
        return dealt.mapInArrow(run, "query_id long, vec_id long, score long")

    lowest = float(-(2**63)) * 4
    first = stored(pass_over(placed.where("shard = 0"), asked.withColumns({"shard": F.lit(0), "floor": F.lit(lowest)})), "topk-first")
    floors = first.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score").cast("double")).alias("kth"))
    longest = np.array(reach)

    @F.pandas_udf("int")
    def last_shard(length: pd.Series, floor: pd.Series) -> pd.Series:
        """The number of leading shards whose longest vector can reach the floor; shards come by descending length."""
        norm, bound = np.sqrt(length.to_numpy()), floor.to_numpy()
        bound = bound - 1e-9 * (1 + np.abs(bound))
        with np.errstate(divide="ignore", invalid="ignore"):
            needed = np.where(norm > 0, bound / norm, np.where(bound <= 0, -np.inf, np.inf))
        return pd.Series(len(longest) - np.searchsorted(longest[::-1], needed, "left"), dtype="int32")

    if start > 1:
        aimed = asked.join(floors, F.col("id") == F.col("query_id"), "left").withColumn("floor", F.coalesce("kth", F.lit(lowest)))
        aimed = aimed.withColumn("to", last_shard("length", "floor")).where("to > 1").withColumn("shard", F.explode(F.sequence(F.lit(1), F.col("to") - 1)))
        found = first.unionByName(pass_over(placed.where("shard > 0"), aimed))
    else:
        found = first
    return _best(found, k).select("query_id", "rank", "vec_id", "score")
