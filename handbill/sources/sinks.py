"""Sinks: documents, the store's table, calendars, reports."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.report import category_distribution, envelope
from ..operators.scoring import rank_keys
from ..schema import LISTING_FIELDS

SCORED_FIELDS = (*LISTING_FIELDS, "price_label", "matched_categories", "score")


def _files(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text to any file system that Spark reaches."""
    files, p = _files(spark, path)
    out = files.create(p, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()


def scrape_document(df: DataFrame, source: str, scraped_at: str, site_name: str | None = None) -> DataFrame:
    """One row, ``value``: a scrape's document. ``site_name`` is left out where there is none."""
    doc = envelope(df, [F.col("ordinal")], LISTING_FIELDS)
    head = [F.lit(source).alias("source"), *([F.lit(site_name).alias("site_name")] if site_name else []), F.lit(scraped_at).alias("scraped_at")]
    return doc.select(F.to_json(F.struct(*head, F.col("count").alias("event_count"), "events"), {"ignoreNullFields": "false"}).alias("value"))


def scored_document(df: DataFrame) -> DataFrame:
    """One row: the count and the scored listings, the best first."""
    return envelope(df, rank_keys(), SCORED_FIELDS).select(F.to_json(F.struct("count", "events"), {"ignoreNullFields": "false"}).alias("value"))


def merged_document(df: DataFrame, recovered_count: int) -> DataFrame:
    """One row: the merged listings, their count, and how many were recovered before any dedup."""
    doc = envelope(df, [F.col("recovered"), F.col("ordinal")], LISTING_FIELDS)
    return doc.select(F.to_json(F.struct("events", "count", F.lit(recovered_count).alias("recovered_count")), {"ignoreNullFields": "false"}).alias("value"))


def published_document(df: DataFrame, scraped_at: str) -> DataFrame:
    """One row: the published listings with the distribution of their categories."""
    doc = envelope(df, [F.col("ordinal")], LISTING_FIELDS).crossJoin(category_distribution(df))  # one row each
    return doc.select(F.to_json(F.struct(F.lit(scraped_at).alias("scraped_at"), F.col("count").alias("total_events"), "category_distribution", "events"), {"ignoreNullFields": "false"}).alias("value"))


def write_document(document: DataFrame, path: str) -> None:
    document.coalesce(1).write.mode("overwrite").text(path)


def write_lines(df: DataFrame, path: str, fields: tuple[str, ...] = LISTING_FIELDS) -> None:
    """A listing a line, in as many files as there are partitions: the form for lists too large for one document."""
    df.select(*fields).write.mode("overwrite").json(path)


def create_store(spark: SparkSession, name: str = "listing_store") -> None:
    """The store as a table. There are no indexes; rows are clustered by date when written, so scans by date skip files."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} (title STRING NOT NULL, date STRING NOT NULL, time STRING, price DOUBLE, category STRING, description STRING, source_url STRING, scraper_script STRING, is_recursive BOOLEAN, created_at TIMESTAMP, updated_at TIMESTAMP) USING parquet")


def replace_store(df: DataFrame, path: str) -> None:
    """The new state of a store beside the old one, then in its place; the old one may be read while writing."""
    spark = df.sparkSession
    beside = f"{path.rstrip('/')}_{uuid.uuid4().hex}"
    df.repartitionByRange("date").sortWithinPartitions("date", "time").write.parquet(beside)
    files, p = _files(spark, path)
    old = spark._jvm.org.apache.hadoop.fs.Path(f"{beside}_old")
    if files.exists(p):
        files.rename(p, old)
    files.rename(spark._jvm.org.apache.hadoop.fs.Path(beside), p)
    files.delete(old, True)


def improvement_patch(missed: list[dict], recommendations: list[str]) -> str:
    """A patch of the configuration, in YAML."""
    quote = lambda x: '"' + str(x).replace("\\", "\\\\").replace('"', '\\"') + '"'
    lines = ["missed_patterns:"] + [f"  - pattern_name: {quote(m.get('pattern_name', ''))}\n    description: {quote(m.get('description', ''))}" for m in missed]
    return "\n".join([*lines, "recommendations:", *(f"  - {quote(r)}" for r in recommendations), ""])


def missed_patterns(df: DataFrame) -> DataFrame:
    """A missed listing as a pattern; two of its fields are constants."""
    return df.select(F.coalesce("title", F.lit("")).alias("pattern_name"), F.coalesce("description", F.lit("")).alias("description"), F.lit("").alias("html_structure"), F.lit("not found by the scraper").alias("why_missed"), F.coalesce("url", F.lit("")).alias("example"))
