"""The driver's tables as listings, and as pages that hold listings; the same in Spark and in SQL. Descriptions are dealt from all documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.categories import Profile

AS_OF = "2024-01-15"

#: Keywords that occur in the test tables.
TEST_PROFILE = Profile({"acts": ["click", "signup"], "tion": ["tion"], "und": ["und"], "that": ["purchase", "that"]}, ["v1"], "near v1")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    d = table(spark, sf_dir, "documents").select("doc_id", F.left("text", F.lit(500)).alias("description"))
    text = lambda c: F.col(c).cast("string")
    e = e.select(
        F.col("event_id").alias("ordinal"), F.concat("event_type", F.lit(" night "), (F.col("user_id") % 50).cast("string")).alias("title"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"), F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "HH:mm")).alias("time"),
        F.when(F.col("event_id") % 10 == 0, None).when((F.col("event_id") % 10).isin(1, 2), 0.0).otherwise(F.col("value")).alias("price"),
        F.when(F.col("event_id") % 3 == 0, "").otherwise(F.col("event_type")).alias("category"), F.concat(F.lit("v"), (F.col("user_id") % 9).cast("string")).alias("venue"),
        F.concat(F.lit("https://s"), (F.col("user_id") % 12).cast("string"), F.lit(".example")).alias("source_url"), (F.col("event_id") % d.agg(F.count("*")).scalar()).alias("__doc"),
    )
    url = F.when(F.col("ordinal") % 4 != 0, F.concat("source_url", F.lit("/e/"), text("ordinal")))
    return e.join(d, F.col("__doc") == F.col("doc_id"), "left").withColumn("url", url).select("ordinal", "title", "date", "time", "price", "category", "description", "url", "venue", "source_url")


LISTINGS_SQL = """listings AS (
SELECT event_id AS ordinal, event_type || ' night ' || (user_id % 50) AS title, strftime(ts, '%Y-%m-%d') AS date,
  CASE WHEN event_id % 7 <> 0 THEN strftime(ts, '%H:%M') END AS time,
  CASE WHEN event_id % 10 = 0 THEN NULL WHEN event_id % 10 IN (1, 2) THEN 0.0 ELSE value END AS price,
  CASE WHEN event_id % 3 = 0 THEN '' ELSE event_type END AS category, left(d.text, 500) AS description,
  CASE WHEN event_id % 4 <> 0 THEN 'https://s' || (user_id % 12) || '.example/e/' || event_id END AS url,
  'v' || (user_id % 9) AS venue, 'https://s' || (user_id % 12) || '.example' AS source_url
FROM events e LEFT JOIN documents d ON d.doc_id = e.event_id % (SELECT count(*) FROM documents))"""

#: Listings to a made page; bounds what a page collects.
PER_PAGE = 40


def euro(cents: Column) -> Column:
    return F.concat((cents / 100).cast("int").cast("string"), F.lit(","), F.lpad((cents % 100).cast("string"), 2, "0"))


def pages_of(rows: DataFrame, line: Column, joint: str, head: str = "", foot: str = "", name: str = "body", size: int = PER_PAGE) -> DataFrame:
    """Pages of ``size`` rows: their lines in order."""
    page = F.floor(F.col("ordinal") / size).cast("long")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("ordinal", line.alias("line")))), lambda x: x["line"])
    return rows.groupBy(F.concat(F.lit("https://p.example/"), page.cast("string")).alias("source_url")).agg(F.concat(F.lit(head), F.array_join(lines, joint), F.lit(foot)).alias(name))
