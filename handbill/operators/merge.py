"""Reconciling batches: missed listings, recovered ones, and the store's two ways to insert."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled, nonempty
from ..schema import LISTING_FIELDS
from .dedup import first_wins, last_wins, merge_keys

STORE_KEY = ["title", "date", "time", "source_url"]


def normalized(df: DataFrame, fallback_source: str = "") -> DataFrame:
    """The nine fields with their defaults; other columns but ``ordinal`` go."""
    source = F.coalesce(nonempty("source_url"), F.lit(fallback_source))
    filled_in = {"title": F.coalesce(nonempty("title"), F.lit("Untitled event")), "source_url": source, "url": F.coalesce(nonempty("url"), source), "category": filled("category")}
    extra = ["ordinal"] if "ordinal" in df.columns else []
    return df.select(*(filled_in.get(f, F.col(f)).alias(f) for f in LISTING_FIELDS), *extra)


def agent_listings(df: DataFrame, source_url: str) -> DataFrame:
    """An agent's answer in the nine fields: empty texts where it says nothing."""
    return df.select(*((F.lit(source_url) if f == "source_url" else F.coalesce(F.col(f), F.lit(source_url)) if f == "url" else F.col(f) if f == "price" else filled(f)).alias(f) for f in LISTING_FIELDS))


def missed(agent: DataFrame, store: DataFrame) -> DataFrame:
    """The agent's listings whose title, without case, the store does not have; repeats stay."""
    known = store.select(F.lower(filled("title")).alias("__key")).distinct()
    return agent.join(known, F.lower(filled("title")) == F.col("__key"), "left_anti")


def merge_recovered(existing: DataFrame, recovered: DataFrame) -> DataFrame:
    """All existing listings, then the first of each recovered one that they do not have; ``recovered`` tells which."""
    a, b = merge_keys()
    known = existing.select(a.alias("__a"), b.alias("__b")).distinct()
    new = first_wins(recovered).join(known, (a == F.col("__a")) & (b == F.col("__b")), "left_anti")
    return existing.withColumn("recovered", F.lit(False)).unionByName(new.withColumn("recovered", F.lit(True)))


def rejected(batch: DataFrame) -> DataFrame:
    """Rows that the store does not take: without a title or a date."""
    return batch.where("title is null or date is null")


def upsert_replace(store: DataFrame, batch: DataFrame, order: str = "ordinal") -> DataFrame:
    """The store with the batch put in; the last row of a key wins. A null time (or source) equals nothing, so such rows are added."""
    batch = batch.where("title is not null and date is not null")
    keyed = F.col("time").isNotNull() & F.col("source_url").isNotNull()
    new = last_wins(batch.where(keyed), STORE_KEY, order).unionByName(batch.where(~keyed))
    kept = store.join(batch.where(keyed).select(*STORE_KEY).distinct(), STORE_KEY, "left_anti")
    return kept.unionByName(new.select(*store.columns) if order not in store.columns else new, allowMissingColumns=True)


#: What a missed listing gets where it lacks a field.
IGNORE_DEFAULTS = {"time": "12:00", "price": 0.0, "category": "needs_review", "description": "", "scraper_script": "desk_agent_validation"}


def with_insert_defaults(batch: DataFrame, present: list[str]) -> DataFrame:
    """Defaults for the fields that the batch does not carry at all; a null that it carries stays."""
    return batch.withColumns({k: F.lit(v) for k, v in IGNORE_DEFAULTS.items() if k not in present})


def insert_ignore(store: DataFrame, batch: DataFrame, order: str = "ordinal") -> DataFrame:
    """The store with those of the batch whose key it does not have, the first of each; a null time or source equals nothing."""
    batch = batch.where("title is not null and date is not null")
    keyed = F.col("time").isNotNull() & F.col("source_url").isNotNull()
    new = first_wins(batch.where(keyed), [F.col(k) for k in STORE_KEY], order).join(store.select(*STORE_KEY).distinct(), STORE_KEY, "left_anti").select(*batch.columns)
    return store.unionByName(new.unionByName(batch.where(~keyed)), allowMissingColumns=True)


def with_source_html(envelopes: DataFrame, pages: DataFrame, most_chars: int = 12000) -> DataFrame:
    """Envelopes with the start of their page, by the site's name."""
    return envelopes.join(pages.select("site", F.left("body", F.lit(most_chars)).alias("html")), "site", "left")


def script_of(urls: DataFrame, config: DataFrame) -> DataFrame:
    """The script configured for each url: that of the first entry."""
    first = config.groupBy("url").agg(F.min_by("script", "ordinal").alias("script"))
    return urls.join(first, "url", "left")
