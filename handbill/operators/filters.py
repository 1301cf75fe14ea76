"""Filters and predicates over listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import GERMAN, ISO, TEXTUAL, current_week, day, event_date, shown
from ..functions.prices import EURO, FREE, MAX_PRICE
from ..functions.text import col, filled


def affordable(price: Column | str = "price", most: float = MAX_PRICE) -> Column:
    """At most ``most``; an unknown price stays."""
    return col(price).isNull() | (col(price) <= most)


def affordable_zero(price: Column | str = "price", most: float = MAX_PRICE) -> Column:
    """At most ``most``, an unknown price counting as 0."""
    return F.coalesce(col(price), F.lit(0.0)) <= most


def affordable_known(price: Column | str = "price", most: float = MAX_PRICE) -> Column:
    """At most ``most``, and known."""
    return col(price) <= most


def in_days(as_of: str, days: int = 14, enabled: bool = False) -> Column:
    """Within the next ``days``; off unless asked for, as the published flow does not drop any date."""
    return F.lit(True) if not enabled else event_date("date").between(day(as_of), F.date_add(day(as_of), days))


def around(as_of: str, back: int = 7, ahead: int = 14, date: str = "date") -> Column:
    """From ``back`` days ago to ``ahead`` days on, by the text of the date."""
    return (F.col(date) >= shown(F.date_sub(day(as_of), back))) & (F.col(date) <= shown(F.date_add(day(as_of), ahead)))


def upcoming(as_of: str, date: str = "date") -> Column:
    return F.col(date) >= shown(day(as_of))


def recent(as_of: str, back: int = 7, date: str = "date") -> Column:
    return F.col(date) >= shown(F.date_sub(day(as_of), back))


def has_signal(text: Column | str) -> Column:
    """A text that names a price, a free entry or a date."""
    t = col(text)
    return t.rlike(EURO) | t.rlike(FREE) | t.rlike(ISO) | t.rlike(GERMAN) | t.rlike(TEXTUAL)


#: The words one of which a line of these sites has.
MEETUP_WORDS = r"(?iU)meetup|rsvp|online|free|gratis|€|berlin|\d{1,2}:\d{2}"
TICKET_WORDS = r"(?iU)eventbrite|tickets?|free|gratis|€|berlin|\d{1,2}:\d{2}"


def length_between(text: Column | str, least: int, most: int | None = None) -> Column:
    n = F.length(col(text))
    return n >= least if most is None else n.between(least, most)


def failed_sources(envelopes: DataFrame) -> DataFrame:
    """Envelopes without any listing."""
    return envelopes.where(F.size(F.coalesce("events", F.array())) <= 0)


def run_succeeded(envelopes: DataFrame) -> DataFrame:
    """Whether a scrape counts as a success (it declares listings), and whether its first one lacks a price, which only warns."""
    first = F.try_element_at("events", F.lit(1))
    return envelopes.select("source", (F.coalesce("event_count", F.lit(0)) > 0).alias("succeeded"), (first.isNotNull() & first["price"].isNull()).alias("warns"))


def needs_review(description: Column | str = "description", category: Column | str = "category", price: Column | str = "price") -> Column:
    """A listing without a description, a category or a price; a price of 0 counts as missing here."""
    return (filled(description) == "") | (filled(category) == "") | (F.coalesce(col(price), F.lit(0.0)) == 0)


def site_filter(name: str, as_of: str) -> Column:
    """The filters of the published page: free, paid (with unknown prices), weekend (this whole week), today, all."""
    text, p = F.lower(F.col("price").cast("string")), F.col("price").try_cast("double")
    free = F.coalesce((p == 0) | (text == "free"), F.lit(False))
    first, last = current_week(as_of)
    named = {"free": free, "paid": ~free, "weekend": F.coalesce(event_date("date").between(first, last), F.lit(False)), "today": F.coalesce(F.col("date") == shown(day(as_of)), F.lit(False))}
    return named.get(name, F.lit(True))
