"""Sources: scrape documents, snapshots of pages, configuration, the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import around, recent
from ..operators.scoring import numbered
from ..schema import ENVELOPE, LISTING_FIELDS, STORED


def _listings(envelopes: DataFrame) -> DataFrame:
    """A row per listing; the ordinal keeps the order of files, then of listings. A price that is no number becomes null."""
    rows = envelopes.select("source", "site_name", "site", "path", F.posexplode("events").alias("position", "e"))
    fields = [(F.col("e.price").try_cast("double") if f == "price" else F.col(f"e.{f}")).alias(f) for f in LISTING_FIELDS]
    return rows.select("site", "source", "path", "position", *fields)


def envelopes(spark: SparkSession, path: str, pattern: str = "raw_*.json") -> DataFrame:
    """Scrape documents of a folder; the site's name is that of the file. Unreadable files and those without listings stay out of
    ``listings`` but are rows here, the unreadable ones with ``_corrupt_record``."""
    rows = spark.read.schema(ENVELOPE).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").option("pathGlobFilter", pattern).json(path)
    name = F.col("_metadata.file_name")
    return rows.select("*", F.regexp_replace(F.regexp_replace(name, r"^raw_", ""), r"\.json$", "").alias("site"), F.col("_metadata.file_path").alias("path"))


def readable(rows: DataFrame) -> DataFrame:
    return rows.where("_corrupt_record is null")


def corrupt(rows: DataFrame) -> DataFrame:
    return rows.where("_corrupt_record is not null")


def with_ordinal(rows: DataFrame) -> DataFrame:
    """A number that orders by path, then position; files are ranked in ranges of their paths, so their number does not matter."""
    ranks = numbered(rows.select(F.col("path").alias("ranked")).distinct(), [F.asc("ranked")], "file")
    return rows.join(ranks, F.col("path") == F.col("ranked")).withColumn("ordinal", (F.col("file") - 1) * (1 << 32) + F.col("position")).drop("file", "ranked")


def read_listings(spark: SparkSession, path: str, pattern: str = "raw_*.json") -> DataFrame:
    """The union of all listings of a folder's documents, without dedup, with ``ordinal``."""
    return with_ordinal(_listings(readable(envelopes(spark, path, pattern))))


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """The listings of one document; a bare list of listings is read too."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    kind = ENVELOPE["events"].dataType
    inner = F.coalesce(F.get(F.array(F.from_json("value", ENVELOPE)["events"]), 0), F.when(F.ltrim("value").startswith("["), F.from_json("value", kind)))
    rows = whole.select("path", F.posexplode(inner).alias("ordinal", "e"))
    return rows.select(*((F.col("e.price").try_cast("double") if f == "price" else F.col(f"e.{f}")).alias(f) for f in LISTING_FIELDS), F.col("ordinal").cast("long").alias("ordinal"))


def read_pages(spark: SparkSession, path: str, pattern: str = "*.html", most_chars: int | None = None) -> DataFrame:
    """(site, body): one row per snapshot; bytes that are no UTF-8 become replacement characters."""
    rows = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    body = F.col("value") if most_chars is None else F.left("value", F.lit(most_chars))
    return rows.select(F.regexp_replace(F.col("_metadata.file_name"), r"\.[^.]*$", "").alias("site"), body.alias("body"), F.col("_metadata.file_path").alias("path"))


def first_page(pages: DataFrame) -> DataFrame:
    """The page of the smallest path."""
    return pages.agg(F.min_by(F.struct(*pages.columns), "path").alias("p")).where("p is not null").select("p.*")


def failed_with_pages(scrapes: DataFrame, pages: DataFrame, most_sites: int = 12, most_chars: int = 12000) -> DataFrame:
    """Sites that gave no listing, with the start of their page; the first dozen, as a report shows them."""
    empty = readable(scrapes).where(F.size(F.coalesce("events", F.array())) <= 0)
    return empty.select("site", "source", "path").join(pages.select("site", F.left("body", F.lit(most_chars)).alias("html")), "site", "left").orderBy("path").limit(most_sites)


def key_values(text: str) -> dict[str, str]:
    """Settings of ``name=value`` lines; blank lines, comments and lines without a sign are skipped."""
    pairs = (line.split("=", 1) for line in map(str.strip, text.splitlines()) if line and not line.startswith("#") and "=" in line)
    return {k.strip(): v.strip() for k, v in pairs}


def read_config(spark: SparkSession, path: str) -> dict:
    """A configuration file in YAML, from any file system that Spark reaches; empty where the file is. Needs a YAML library on the driver."""
    import yaml

    return yaml.safe_load(spark.read.text(path, wholetext=True).first()["value"]) or {}


def categories_of(config: dict) -> dict[str, list[str]]:
    """The categories of a parsed configuration, in its order."""
    return {name: [str(k) for k in (body or {}).get("keywords", [])] for name, body in (config.get("categories") or {}).items()}


def dictionary(spark: SparkSession, categories: dict[str, list[str]], profile: str = "configured") -> DataFrame:
    """A row per keyword: profile, ord, category, keyword."""
    rows = [(profile, k, name, word) for k, (name, words) in enumerate(categories.items()) for word in words]
    return spark.createDataFrame(rows, "profile string, ord int, category string, keyword string")


def source_config(spark: SparkSession, config: dict) -> DataFrame:
    """A row per configured url: ordinal, name, url, script, categories."""
    rows = [(k, x.get("name"), x.get("url"), x.get("script"), list(x.get("categories") or [])) for k, x in enumerate(config.get("urls") or [])]
    return spark.createDataFrame(rows, "ordinal int, name string, url string, script string, categories array<string>")


def read_store(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(STORED).parquet(path)


def stored_of_source(store: DataFrame, source_url: str, as_of: str, days: int = 7) -> DataFrame:
    return store.where((F.col("source_url") == source_url) & around(as_of, days)).select("title", "date", "time", "price", "category", "description", "source_url")


def for_publication(store: DataFrame, as_of: str) -> DataFrame:
    """The last seven days and all to come, in order of date and time."""
    return store.where(recent(as_of)).orderBy(F.asc_nulls_first("date"), F.asc_nulls_first("time"))


def published(spark: SparkSession, path: str) -> DataFrame:
    """The published listings, none where there is no such file."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], "ordinal long, " + ", ".join(f"{f} {'double' if f == 'price' else 'string'}" for f in LISTING_FIELDS))
    return read_document(spark, path)


def with_id(rows: DataFrame) -> DataFrame:
    """The reader's stable number of a listing."""
    return rows.withColumn("_id", F.col("ordinal"))


