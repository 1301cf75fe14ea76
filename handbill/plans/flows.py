"""The three flows end to end: weekly publication, the store's run, validation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import merge, scoring
from ..operators.report import validation_totals
from ..streaming.ingest import to_store


def publication(listings: DataFrame, recovered: DataFrame | None = None, most: float = 15.0) -> DataFrame:
    """Listings, with those recovered from failed sites, filtered, deduplicated, scored and ranked."""
    rows = listings
    if recovered is not None:
        both = merge.merge_recovered(listings, recovered)
        last = F.lit(1 << 62)  # recovered listings come after all others
        rows = both.withColumn("ordinal", F.when(F.col("recovered"), last + F.col("ordinal")).otherwise(F.col("ordinal"))).drop("recovered")
    return scoring.score_and_rank(rows, most)


def store_run(batch: DataFrame, store: DataFrame, script: str) -> DataFrame:
    return to_store(batch, store, script)


def validation(agent: DataFrame, store: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The missed listings, the store with them, and the totals over sites."""
    missed = merge.missed(agent, store)
    rows = merge.with_insert_defaults(missed, missed.columns).withColumn("scraper_script", F.lit(merge.IGNORE_DEFAULTS["scraper_script"]))
    keep = [c for c in rows.columns if c in store.columns or c == "ordinal"]
    return missed, merge.insert_ignore(store, rows.select(*keep)).select(*store.columns), validation_totals(results)
