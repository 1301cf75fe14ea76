"""Mixing of sources to target weights by the cube method.

A source's target divided by its size is the rate at which its documents are taken. The whole part of the rate
goes to every document; the rest is an inclusion probability. Documents are dealt to blocks of a source by a
hash of their id, and in each block the *flight* moves three fractional documents at a time along the null
space of (words, 1), until at least one of them is taken or left. Sums of words and of documents stay exact.
At most two documents of a block remain fractional; they meet in blocks of the next level, a thousand times
fewer, and the last two of each source are *landed* on the choice with the least deviation in words.

Rows that repeat doc_id, source and text are one unit of as many copies: their whole number of inclusions is dealt among them, and the rest of it is the
unit's probability.

Defined cases: a null text has 0 words; a null source is a source of its own, the last; a null doc_id is an id like others; repeated rows are taken each, so
that their number comes out as for different rows; ties are broken by a hash; a table without rows, or without words, takes nothing;
a source of no words has the target 0; texts of any length are counted whole. Only doc_id, text and source are read; further columns, whatever their
names, go through ``mix`` unchanged.
"""

from __future__ import annotations

import math
import random
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, stored

#: Documents to a block, and blocks whose remainders meet in one block of the next level.
BLOCK, FAN = 1024, 512
MOST = 3.0
_KEPT = "unit_id long, part int, block long, level int, words long, held double, order long"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights=(1, 2, 3), most: float = MOST) -> dict:
    """Targets of the sources: shares by weight of the sum of all sizes, none above ``most`` times its size;
    what lies above goes to the others by weight, until none is above."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {name: weights[i % len(weights)] for i, (name, _) in enumerate(order)}
    size = dict(order)
    out, free, rest = {}, list(size), float(sum(size.values()))
    while free:
        total = sum(weight[x] for x in free)
        over = [x for x in free if rest * weight[x] / total > most * size[x]]
        if not over:
            out |= {x: rest * weight[x] / total for x in free}
            break
        out |= {x: most * size[x] for x in over}
        rest -= sum(most * size[x] for x in over)
        free = [x for x in free if x not in set(over)]
    return out


def flight(words: list[float], held: list[float], draw: random.Random) -> list[float]:
    """``held`` after the flight phase; at most two of its values stay strictly between 0 and 1."""
    held = [0.0 if h < 1e-9 else 1.0 if h > 1 - 1e-9 else h for h in held]
    active: list[int] = []
    for k in range(len(held)):
        if not 0 < held[k] < 1:
            continue
        active.append(k)
        while len(active) == 3:
            x = [words[i] for i in active]
            u = [x[1] - x[2], x[2] - x[0], x[0] - x[1]]
            if not any(u):
                u = [1.0, -1.0, 0.0]
            h = [held[i] for i in active]
            up = min((1 - a) / b if b > 0 else a / -b for a, b in zip(h, u, strict=True) if b)
            down = min(a / b if b > 0 else (1 - a) / -b for a, b in zip(h, u, strict=True) if b)
            step = up if draw.random() * (up + down) < down else -down
            for i, a, b in zip(active, h, u, strict=True):
                v = a + step * b
                held[i] = 0.0 if v < 1e-9 else 1.0 if v > 1 - 1e-9 else v
            active = [i for i in active if 0 < held[i] < 1]
    return held


def land(words: list[float], held: list[float]) -> list[float]:
    """The choice of 0 or 1 for the few fractional values that moves the words least, then the documents."""
    left = [i for i, h in enumerate(held) if 0 < h < 1]
    best = None
    for bits in range(1 << len(left)):
        pick = [bits >> j & 1 for j in range(len(left))]
        cost = (abs(sum(words[i] * (b - held[i]) for i, b in zip(left, pick, strict=True))), abs(sum(b - held[i] for i, b in zip(left, pick, strict=True))), bits)
        if best is None or cost < best[0]:
            best = (cost, pick)
    out = list(held)
    for i, b in zip(left, best[1] if best else [], strict=True):
        out[i] = float(b)
    return out


def _block(last: bool, seed: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["order", "words"], kind="stable")
        key = f"{seed}|{pdf['part'].iloc[0]}|{pdf['block'].iloc[0]}|{pdf['level'].iloc[0]}"
        words = [float(x) for x in pdf["words"]]
        held = flight(words, [float(x) for x in pdf["held"]], random.Random(zlib.crc32(key.encode())))
        pdf["held"] = land(words, held) if last else held
        return pdf[["unit_id", "part", "block", "level", "words", "held", "order"]]

    return run


def _keyed(docs: DataFrame) -> DataFrame:
    """The documents with their unit's key, in columns that are never null, so that joins and windows share a partitioning."""
    doc_id, source = F.col("doc_id"), F.col("source")
    return docs.withColumns({"__id": F.coalesce(doc_id.cast("long"), F.lit(0).cast("long")), "__source": F.coalesce(source, F.lit("")), "__null": doc_id.isNull().cast("int") * 2 + source.isNull().cast("int"), "__hash": F.coalesce(F.xxhash64("text"), F.lit(0).cast("long"))})


_KEY = ["__id", "__source", "__null", "__hash"]


def copies(docs: DataFrame, weights=(1, 2, 3), most: float = MOST, seed: int = 0) -> DataFrame:
    """One row per unit (the key columns): ``__words``, ``__source_words``, ``__target``, ``__whole``, the copies of each of its rows, and ``__extra``, how
    many of its rows have one more."""
    spark = docs.sparkSession
    rows = _keyed(docs.select("doc_id", "source", "text")).select(*_KEY, "source", n_words(F.col("text")).alias("words"))
    units = rows.groupBy(*_KEY).agg(F.first("source").alias("unit_source"), F.max("words").alias("words"), F.count("*").alias("times"))
    # the number of a unit stands for its key in the flight
    units = stored(units.withColumn("unit_id", F.monotonically_increasing_id()), "mix-units")
    stats = units.groupBy("unit_source").agg(F.count("*").alias("n"), F.sum(F.col("words") * F.col("times")).alias("words")).collect()  # a row per source
    goal = targets([(r.unit_source, r.words) for r in stats], weights, most)
    sources = []
    for part, r in enumerate(sorted(stats, key=lambda r: (r.unit_source is None, r.unit_source or ""))):
        rate = min(most, goal[r.unit_source] / r.words) if r.words else 0.0
        whole = math.floor(rate + 1e-12)
        sources.append((r.unit_source, part, max(1, math.ceil(r.n / BLOCK)), r.words, goal[r.unit_source], whole, max(0.0, rate - whole)))
    table = spark.createDataFrame(sources, "name string, part int, blocks long, source_words long, target double, whole int, rate double")
    order = F.xxhash64(F.lit(seed), *_KEY)
    units = units.join(table, units.unit_source.eqNullSafe(table.name)).withColumns({"order": order, "full": F.floor(F.col("times") * F.col("rate") + 1e-12)})
    level = units.select("unit_id", "part", F.pmod("order", "blocks").alias("block"), F.lit(0).alias("level"), "words", F.greatest(F.lit(0.0), F.col("times") * F.col("rate") - F.col("full")).alias("held"), "order")
    most_blocks, decided, n = max([1, *(s[2] for s in sources)]), [], 0
    while True:
        kept = stored(level.groupBy("part", "block").applyInPandas(_block(most_blocks == 1, seed), _KEPT), "mix-level")
        decided.append(kept.where("held = 0 or held = 1"))
        if most_blocks == 1:
            break
        n, most_blocks = n + 1, math.ceil(most_blocks / FAN)
        level = kept.where("held > 0 and held < 1").withColumns({"block": F.floor(F.col("block") / FAN).cast("long"), "level": F.lit(n)})
    every = decided[0]
    for more in decided[1:]:
        every = every.unionByName(more)
    every = every.select(F.col("unit_id").alias("of"), F.col("held").alias("landed"))
    return units.join(every.hint("merge"), F.col("unit_id") == F.col("of")).select(*_KEY, *(F.col(c).alias(f"__{c}") for c in ("words", "source_words", "target", "whole")), (F.col("full") + F.col("landed").cast("long")).alias("__extra"))


def _with_copies(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The keyed rows with ``__copies``; of a unit's rows, which are alike, the first ``extra`` have one more."""
    both = rows.join(chosen.withColumnsRenamed({c: c.replace("__", "__of_") for c in _KEY}).hint("merge"), [F.col(c) == F.col(c.replace("__", "__of_")) for c in _KEY])
    both = both.withColumn("__nth", F.row_number().over(Window.partitionBy(*_KEY).orderBy("__hash")))
    return both.withColumn("__copies", F.col("__whole") + F.when(F.col("__nth") <= F.col("__extra"), 1).otherwise(0))


def mixed(docs: DataFrame, weights=(1, 2, 3), most: float = MOST, seed: int = 0) -> DataFrame:
    """A row per document: doc_id, source, size, source_size, target, copies, and taken, the words the mix takes."""
    rows = _with_copies(_keyed(docs.select("doc_id", "source", "text")).drop("text"), copies(docs, weights, most, seed))
    size = F.col("__words")
    return rows.select("doc_id", "source", size.alias("size"), F.col("__source_words").alias("source_size"), F.col("__target").alias("target"), F.col("__copies").cast("int").alias("copies"), (size * F.col("__copies")).alias("taken"))


def mix(docs: DataFrame, weights=(1, 2, 3), most: float = MOST, seed: int = 0) -> DataFrame:
    """The documents as often as the mix takes them, with their own columns."""
    chosen = copies(docs, weights, most, seed).where("__whole > 0 or __extra > 0")
    rows = _with_copies(_keyed(docs), chosen).where("__copies > 0")
    return rows.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*(F.col(f"`{c}`") for c in docs.columns))
