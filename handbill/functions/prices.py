"""Prices: reading them from texts, showing, scoring and grouping them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, group

#: What marks a free entry, and a price in euro with its sign before or behind it.
FREE = r"(?iU)\b(free|gratis|kostenlos|eintritt frei|freier eintritt)\b"
EURO = r"(?iU)(?:€\s*(\d+[.,]?\d*)|(\d+[.,]?\d*)\s*€|(\d+[.,]?\d*)\s*EUR)"
TICKET_EURO = r"(?iU)(\d+[,.]\d+|\d+)\s*(?:€|EUR)"
#: Fixed values of scoring and filtering.
MAX_PRICE, PREFERRED_PRICE, NO_PRICE_RANK = 15.0, 10.0, 999.0


def number(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(".")).try_cast("double")


def parse_price(text: Column | str) -> Column:
    """0 if a free entry is named anywhere, else the first price, else null."""
    any_group = F.coalesce(*(group(text, EURO, n) for n in (1, 2, 3)))
    return F.when(col(text).rlike(FREE), 0.0).otherwise(number(any_group))


def parse_ticket_price(text: Column | str) -> Column:
    """The ticket site's reading: 0 where nothing else is said."""
    low = F.lower(col(text))
    free = F.contains(low, F.lit("free")) | F.contains(low, F.lit("gratis"))
    return F.when(free, 0.0).otherwise(F.coalesce(number(group(text, TICKET_EURO)), F.lit(0.0)))


def parse_ticket_card_price(text: Column | str) -> Column:
    """On a ticket card: a number with decimals, else 0."""
    low = F.lower(col(text))
    free = F.contains(low, F.lit("free")) | F.contains(low, F.lit("gratis"))
    return F.when(free, 0.0).otherwise(F.coalesce(number(group(text, r"(\d+[,.]\d+)")), F.lit(0.0)))


def parse_meetup_card_price(text: Column | str) -> Column:
    """On a meetup card: a number behind a currency sign, else 0."""
    low = F.lower(col(text))
    free = F.contains(low, F.lit("free")) | F.contains(low, F.lit("gratis"))
    return F.when(free, 0.0).otherwise(F.coalesce(number(group(text, r"[$€£](\d+\.?\d*)")), F.lit(0.0)))


def parse_meetup_line_price(text: Column | str) -> Column:
    return F.coalesce(number(group(text, TICKET_EURO)), F.lit(0.0))


#: Fixed value: the price tokens of the programme site.
PROGRAMME_PRICE = r"(?i)(Free admission|\d+[,.]\d+\s*€|from\s+\d+[,.]\d+\s*€|0,00\s*to\s+\d+[,.]\d+\s*€)"


def parse_programme_price(token: Column) -> Column:
    """The first decimal of a price token, 0 if it says free or has none."""
    free = F.contains(F.lower(token), F.lit("free"))
    return F.when(free, 0.0).otherwise(F.coalesce(number(group(token, r"(\d+[,.]\d+)")), F.lit(0.0)))


def price_label(price: Column | str) -> Column:
    p = col(price)
    text = F.concat(F.lit("€"), F.rtrim(F.rtrim(F.call_function("format_number", p, F.lit("0.00")), F.lit("0")), F.lit(".")))
    return F.when(p.isNull(), "Check site").when(p == 0, "Free").otherwise(text)


def price_score(price: Column | str, preferred: float = PREFERRED_PRICE, most: float = MAX_PRICE) -> Column:
    p = col(price)
    return F.when(p.isNull(), 5).when(p == 0, 40).when(p <= preferred, 25).when(p <= most, 10).otherwise(0)


def price_bucket(price: Column | str, fixed_labels: bool = False) -> Column:
    """The band of a price; an unknown price is called Free and 0 is in the first band, unless ``fixed_labels``."""
    p = col(price)
    out = F.when(p.isNull(), "Unknown" if fixed_labels else "Free")
    if fixed_labels:
        out = out.when(p == 0, "Free")
    return out.when(p <= 5, "0-5€").when(p <= 10, "5-10€").when(p <= 15, "10-15€").otherwise(">15€")


def price_class(price: Column | str) -> Column:
    """The style of a price on a card; a text price may say free."""
    text, p = F.lower(col(price).cast("string")), col(price).try_cast("double")
    return F.when((p == 0) | (text == "free"), "price-free").when(p > 0, "price-paid").otherwise("price-unknown")


def price_display(price: Column | str) -> Column:
    text, p = col(price).cast("string"), col(price).try_cast("double")
    shown = F.regexp_replace(p.cast("string"), r"\.0$", "")
    return F.when((p == 0) | (F.lower(text) == "free"), "Free").when(p > 0, F.concat(F.lit("€"), shown)).otherwise(F.coalesce(F.nullif(text, F.lit("")), F.lit("Price TBD")))
