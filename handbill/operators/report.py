"""Aggregates over listings and the reports made of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import current_week, event_date
from ..functions.prices import MAX_PRICE, price_bucket
from .filters import upcoming


def category_counts(df: DataFrame, as_of: str | None = None) -> DataFrame:
    rows = df if as_of is None else df.where(upcoming(as_of))
    return rows.groupBy("category").agg(F.count("*").alias("n"))


def price_buckets(df: DataFrame, as_of: str | None = None, fixed_labels: bool = False) -> DataFrame:
    rows = df if as_of is None else df.where(upcoming(as_of))
    return rows.groupBy(price_bucket("price", fixed_labels).alias("price_range")).agg(F.count("*").alias("n"))


def run_totals(df: DataFrame, most: float = MAX_PRICE) -> DataFrame:
    """How many listings a run saved, filtered by price, and saw."""
    dear = F.coalesce(F.col("price") > most, F.lit(False))
    return df.agg(F.count_if(~dear).alias("saved"), F.count_if(dear).alias("filtered"), F.count("*").alias("processed"))


def validation_totals(results: DataFrame) -> DataFrame:
    """Sums over validated sites."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    ok = F.coalesce("success", F.lit(False))
    return results.agg(F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"), total("phase1_events").alias("phase1_events"), total("agent_events").alias("agent_events"), total("missed_events").alias("missed_events"), total("sub_urls").alias("sub_urls"))


def site_stats(df: DataFrame, as_of: str) -> DataFrame:
    """The counts of the published page: all, free, paid (the others), in this week."""
    first, last = current_week(as_of)
    free = F.coalesce(F.col("price") == 0, F.lit(False))
    return df.agg(F.count("*").alias("total"), F.count_if(free).alias("free"), F.count_if(~free).alias("paid"), F.count_if(F.coalesce(event_date("date").between(first, last), F.lit(False))).alias("in_week"))


def per_source(df: DataFrame) -> DataFrame:
    return df.groupBy("source_url").agg(F.count("*").alias("n"))


def completeness(sources: DataFrame, df: DataFrame) -> DataFrame:
    """Each configured source with its number of listings and whether it has none."""
    n = F.coalesce("n", F.lit(0)).cast("long")
    return sources.join(per_source(df), "source_url", "left").select("source_url", n.alias("n"), (n == 0).alias("failed"))


def category_distribution(df: DataFrame) -> DataFrame:
    """One row: a map from category to count."""
    pairs = category_counts(df.where("category is not null")).agg(F.array_sort(F.collect_list(F.struct("category", "n"))).alias("pairs"))
    return pairs.select(F.map_from_entries("pairs").alias("category_distribution"))


def distinct_titles(df: DataFrame) -> DataFrame:
    return df.select(F.lower(F.coalesce("title", F.lit(""))).alias("title")).distinct()


def samples(df: DataFrame, by: str, value: str, most: int, order: str = "ordinal") -> DataFrame:
    """The first few values of each group, in order."""
    from .dedup import capped

    return capped(df, [by], most, order).groupBy(by).agg(F.array_sort(F.collect_list(F.struct(order, value))).alias("s")).select(by, F.transform("s", lambda x: x[value]).alias(value))


def quality_metrics(df: DataFrame) -> DataFrame:
    """How many listings have a date that is none, a price below 0, no price, no title."""
    return df.agg(F.count_if(F.col("date").isNotNull() & event_date("date").isNull()).alias("bad_dates"), F.count_if(F.col("price") < 0).alias("negative_prices"), F.count_if(F.col("price").isNull()).alias("unknown_prices"), F.count_if(F.coalesce("title", F.lit("")) == "").alias("untitled"))


def weekly_report(df: DataFrame, as_of: str, generated: str, location: str = "", most: float = MAX_PRICE) -> str:
    """The weekly summary in markdown; only the aggregates reach the driver."""
    t = run_totals(df, most).first()
    kept = df.where(F.col("price").isNull() | (F.col("price") <= most))
    lines = ["# Weekly Event Scraping Report", f"**Generated:** {generated}", "", "## Summary", f"- **Total Events Saved:** {t.saved}", f"- **Events Filtered (>{most:g}€):** {t.filtered}", f"- **Total Processed:** {t.processed}", "", "## Category Breakdown"]
    lines += [f"- {r.category}: {r.n}" for r in category_counts(kept, as_of).orderBy("category").collect()]
    lines += ["", "## Price Distribution", *(f"- {r.price_range}: {r.n}" for r in price_buckets(kept, as_of).orderBy("price_range").collect()), "", "## Database Location", location, ""]
    return "\n".join(lines)


def validation_report(results: DataFrame, as_of_day: int, generated: str) -> str:
    """The validation summary in markdown: totals, then each site with its first five missed titles; without results, a rest day."""
    from ..functions.dates import CYCLE_DAYS, DAY_NAMES, NEXT_DAY_NAMES

    name, after = DAY_NAMES[as_of_day % 7], NEXT_DAY_NAMES[(as_of_day + 1) % CYCLE_DAYS % 7]
    head = ["# Validation Report", f"**Generated:** {generated}", f"**Cycle Day:** {as_of_day} ({name})"]
    t = validation_totals(results).first()
    if not t.successful + t.failed:
        return "\n".join([*head, "", "Rest day: no sites validated.", f"- **Next:** Day {(as_of_day + 1) % CYCLE_DAYS} ({after})", ""])
    lines = [*head, "", "## Summary", f"- **Sites Validated:** {t.successful + t.failed}", f"- **Successful:** {t.successful}", f"- **Failed:** {t.failed}", f"- **Phase 1 Events:** {t.phase1_events}", f"- **Agent Events Found:** {t.agent_events}", f"- **Missed Events Retrieved:** {t.missed_events}", f"- **Sub-URLs Discovered:** {t.sub_urls}", "", "## Detailed Results"]
    for r in results.orderBy("site").toLocalIterator():  # a site at a time
        lines += ["", f"### {'✅' if r.success else '❌'} {r.site}", f"- URL: {r.url}", f"- Phase 1 Events: {r.phase1_events}", f"- Agent Events: {r.agent_events}", f"- Missed Events: {r.missed_events}", f"- Sub-URLs Discovered: {r.sub_urls}"]
        lines += [f"- **Error:** {r.error}"] if r.error else []
        lines += ["**Missed Event Titles:**", *(f"  - {x}" for x in (r.missed_titles or [])[:5])] if r.missed_titles else []
    return "\n".join([*lines, "", "## 14-Day Schedule", f"- **Today:** Day {as_of_day} ({name})", f"- **Next:** Day {(as_of_day + 1) % CYCLE_DAYS} ({after})", ""])


def missed_counts(scraped: DataFrame, missed: DataFrame, by: str = "source_url") -> DataFrame:
    """How many listings of each source were scraped and how many missed, and whether its scraper is to be improved."""
    have, lack = scraped.groupBy(by).agg(F.count("*").alias("scraped_count")), missed.groupBy(by).agg(F.count("*").alias("missed_count"))
    both = have.join(lack, by, "full").na.fill(0, ["scraped_count", "missed_count"])
    return both.withColumn("improvements_needed", F.col("missed_count") > 0)


def envelope(df: DataFrame, order: list[Column], fields: tuple[str, ...]) -> DataFrame:
    """One row with all listings in order, for a document of publication size."""
    rows = df.select(F.struct(*fields).alias("e"), F.struct(*(c.alias(f"k{i}") for i, c in enumerate(order))).alias("k"))
    packed = rows.agg(F.count("*").alias("count"), F.array_sort(F.collect_list(F.struct("k", "e"))).alias("all"))
    return packed.select("count", F.transform("all", lambda x: x["e"]).alias("events"))

