"""What a reader of the published list does: search, filter, sort, select, export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import filled


def search(df: DataFrame, query: str | None) -> DataFrame:
    """Listings with the text, without case, in title, venue, description, category, label or matched categories."""
    if not query:
        return df
    matched = F.coalesce("matched_categories", F.array().cast("array<string>"))
    hay = F.concat_ws(" ", *(filled(c) for c in ("title", "venue", "description", "category", "price_label")), matched)
    return df.where(F.contains(F.lower(hay), F.lower(F.lit(query))))


def free_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("price") == 0)


def sort_value(key: str) -> Column:
    """What a column sorts by: scores with -1 for none, prices with 999999 for none, dates with times, else the text without case."""
    if key == "score":
        return F.coalesce("score", F.lit(-1))
    if key == "price":
        return F.coalesce("price", F.lit(999999.0))
    if key == "date":
        return F.concat(filled("date"), F.lit(" "), filled("time"))
    return F.lower(filled(F.col(key).cast("string")))


def sort_order(key: str = "score", descending: bool = True) -> list[Column]:
    """Rows that tie keep their order in both directions."""
    return [sort_value(key).desc() if descending else sort_value(key).asc(), F.asc("ordinal")]


def browse(df: DataFrame, query: str | None = None, free: bool = False, key: str = "score", descending: bool = True) -> DataFrame:
    rows = search(df, query)
    return (free_only(rows) if free else rows).orderBy(*sort_order(key, descending))


def selected(df: DataFrame, chosen: DataFrame, key: str = "ordinal") -> DataFrame:
    return df.join(chosen.select(key).distinct(), key, "left_semi")


def ics_escape(text: Column | str) -> Column:
    return F.replace(F.regexp_replace(filled(text), r"([\\;,])", r"\\$1"), F.lit("\n"), F.lit("\\n"))


def ics_start(date: Column | str = "date", time: Column | str = "time") -> Column:
    """The start's line: with a time where there is one; null where the date has not eight digits."""
    digits = F.replace(filled(date), F.lit("-"), F.lit(""))
    h, m = (F.regexp_extract(filled(time), r"(\d{1,2})[:.](\d{2})", n) for n in (1, 2))
    timed = F.concat(F.lit("DTSTART:"), digits, F.lit("T"), F.lpad(h, 2, "0"), m, F.lit("00"))
    return F.when(digits.rlike(r"^\d{8}$"), F.when(h != "", timed).otherwise(F.concat(F.lit("DTSTART;VALUE=DATE:"), digits)))


def ics_events(df: DataFrame, uid: Column) -> DataFrame:
    """Adds ``ics``, a listing's VEVENT; listings without a proper date go."""
    url = F.nullif(F.col("url"), F.lit(""))
    description = F.concat(F.lit("DESCRIPTION:"), ics_escape("description"), F.when(url.isNotNull(), F.concat(F.lit("\\n"), ics_escape(url))).otherwise(""))
    lines = [F.lit("BEGIN:VEVENT"), F.concat(F.lit("UID:"), uid.cast("string")), ics_start(), F.concat(F.lit("SUMMARY:"), ics_escape("title")), F.concat(F.lit("LOCATION:"), ics_escape("venue")), description, F.when(url.isNotNull(), F.concat(F.lit("URL:"), url)), F.lit("END:VEVENT")]
    return df.where(ics_start().isNotNull()).withColumn("ics", F.concat_ws("\r\n", *lines))


def calendar(df: DataFrame, uid: Column, product: str = "-//listings//table-export//EN") -> str:
    """The calendar file of a selection, listing by listing."""
    body = [r.ics for r in ics_events(df, uid).orderBy("ordinal").select("ics").toLocalIterator()]
    return "\r\n".join(["BEGIN:VCALENDAR", "VERSION:2.0", f"PRODID:{product}", *body, "END:VCALENDAR"])

