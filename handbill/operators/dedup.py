"""Keys and order-dependent choices: first wins, last wins, caps, repeats. ``ordinal`` is the order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import filled, strip


def title_key(title: str = "title") -> Column:
    return F.lower(strip(filled(title)))


def merge_keys() -> list[Column]:
    """What makes two listings the same: the title without case and outer space, and the date."""
    return [title_key(), strip(filled("date"))]


def first_wins(df: DataFrame, keys: list[Column] | None = None, order: str = "ordinal") -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*(merge_keys() if keys is None else keys)).orderBy(order))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def last_wins(df: DataFrame, keys: list[str], order: str = "ordinal") -> DataFrame:
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(order)))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def capped(df: DataFrame, by: list[str], most: int, order: str = "ordinal") -> DataFrame:
    """The first ``most`` rows of each group."""
    nth = F.row_number().over(Window.partitionBy(*by).orderBy(order))
    return df.withColumn("__nth", nth).where(F.col("__nth") <= most).drop("__nth")


def first_titles(df: DataFrame, by: list[str], most: int, order: str = "ordinal", before: bool = False) -> DataFrame:
    """The first of each title within a group, at most ``most``; ``before``: the cap is on the rows before the choice."""
    if before:
        return first_wins(capped(df, by, most, order), [*map(F.col, by), F.lower("title")], order)
    return capped(first_wins(df, [*map(F.col, by), F.lower("title")], order), by, most, order)


def is_recursive(batch: DataFrame, store: DataFrame | None = None, order: str = "ordinal") -> DataFrame:
    """Adds is_recursive: the title and source are in the store, or come earlier in the batch."""
    # an aggregate and a join, so that a title that holds most rows is no task of its own
    firsts = batch.groupBy(F.col("title").alias("__bt"), F.col("source_url").alias("__bs")).agg(F.min(order).alias("__first"))
    batch = batch.join(firsts, F.col("title").eqNullSafe(F.col("__bt")) & F.col("source_url").eqNullSafe(F.col("__bs")))
    again = F.coalesce(F.col(order) > F.col("__first"), F.lit(False))
    extra = ["__bt", "__bs", "__first"]
    if store is None:
        return batch.withColumn("is_recursive", again).drop(*extra)
    known = store.select(F.col("title").alias("__t"), F.col("source_url").alias("__s"), F.lit(True).alias("__known")).distinct()
    joined = batch.join(known, (F.col("title") == F.col("__t")) & (F.col("source_url") == F.col("__s")), "left")
    return joined.withColumn("is_recursive", again | F.coalesce("__known", F.lit(False))).drop("__t", "__s", "__known", *extra)


def lowest_tier(df: DataFrame, by: str = "source_url", tier: str = "tier") -> DataFrame:
    """The rows of the first strategy that gave any for their source. An aggregate and a join, so that a large source is split."""
    first = df.groupBy(F.col(by).alias("__by")).agg(F.min(tier).alias("__tier"))
    return df.join(first, F.col(by).eqNullSafe(F.col("__by")) & (F.col(tier) == F.col("__tier"))).drop("__by", "__tier")
