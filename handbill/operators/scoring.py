"""Scoring and ranking of listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.prices import MAX_PRICE, NO_PRICE_RANK, price_label, price_score
from ..functions.text import filled, nonempty
from .categories import STOCK, Profile, content_categories, haystack, is_near
from .dedup import first_wins
from .filters import affordable
from .storage import stored

#: Fixed values.
MOST_CATEGORIES, CATEGORY_POINTS, NEAR_POINTS, MOST_POINTS = 3, 15, 20, 100


def scored(df: DataFrame, profile: Profile = STOCK, fields: tuple[str, ...] = ("title", "description", "category")) -> DataFrame:
    """Adds price_label, matched_categories and score; category becomes the matched ones, else its own, else general."""
    found = content_categories(F.col("__text"), profile)
    df = df.withColumn("__text", haystack(*fields)).withColumns({"__found": found, "__near": is_near(F.col("__text"), filled("venue"), profile)})
    points = price_score("price") + F.least(F.lit(MOST_CATEGORIES * CATEGORY_POINTS), F.size("__found") * CATEGORY_POINTS) + F.when(F.col("__near"), NEAR_POINTS).otherwise(0)
    near = F.when(F.col("__near"), F.array(F.lit(profile.near_label))).otherwise(F.array().cast("array<string>"))
    return df.withColumns({
        "price_label": price_label("price"), "matched_categories": F.concat("__found", near), "score": F.least(F.lit(MOST_POINTS), points).cast("int"),
        "category": F.coalesce(nonempty(F.array_join("__found", ", ")), nonempty("category"), F.lit("general")),
    }).drop("__text", "__found", "__near")


def rank_keys() -> list[Column]:
    """What listings are ranked by, ascending: the score from the highest, then the price (unknown last), then the title; rows that tie keep their order."""
    return [-F.col("score"), F.coalesce("price", F.lit(NO_PRICE_RANK)), F.lower(filled("title")), F.col("ordinal")]


def rank_order() -> list[Column]:
    return [k.asc() for k in rank_keys()]


def ranked(df: DataFrame) -> DataFrame:
    """In the order of publication. Sorting by range is distributed; :func:`numbered` gives the rank itself."""
    return df.orderBy(*rank_order())


def numbered(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Adds each row's place in a total order without bringing all rows to one task: rows are dealt by ranges of the
    order and written to the shared folder, each task's rows as sorted files of their own, so that a lost executor changes neither ranges nor
    places; then they are numbered within their range and moved on by the sizes of the ranges before."""
    spark = df.sparkSession
    n = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = stored(df.repartitionByRange(n, *order).withColumn("__part", F.spark_partition_id()), "numbered")
    sizes = dict(sorted((r["__part"], r["n"]) for r in dealt.groupBy("__part").agg(F.count("*").alias("n")).collect()))  # a row per partition
    before, starts = 0, []
    for part, size in sizes.items():
        starts.append((part, before))
        before += size
    offsets = spark.createDataFrame(starts or [(0, 0)], "__of int, __before long")
    nth = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return dealt.withColumn("__nth", nth).join(F.broadcast(offsets), F.col("__part") == F.col("__of")).withColumn(name, (F.col("__nth") + F.col("__before")).cast("long")).drop("__part", "__nth", "__of", "__before")


def score_and_rank(df: DataFrame, most: float = MAX_PRICE, profile: Profile = STOCK, fields: tuple[str, ...] = ("title", "description", "category"), keys: list[Column] | None = None) -> DataFrame:
    """The published list: price filter, then first-wins dedup, then scores. The filter comes first by meaning: a dear first occurrence must not hide a cheap later one."""
    return ranked(scored(first_wins(df.where(affordable("price", most)), keys), profile, fields))
