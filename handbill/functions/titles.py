"""Titles: noisy ones, those from a url's slug, and marks of a page that is no listing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .dates import ISO, TEXTUAL, TIME
from .text import col, filled

#: Badges of listing pages, what bot checks say, and parts of class names of listing cards.
BADGES = ("pick of the day", "presented", "sponsored", "today,", "tomorrow,")
BOT_MARKERS = ("just a moment", "attention required", "cf-browser-verification", "checking your browser", "access denied")
CARD_HINTS = ("event", "teaser", "views-row", "card", "listing", "termin", "veranstaltung", "programme-item", "program-item", "spielplan", "show-item")


def any_of(text: Column, words) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def title_looks_noisy(title: Column | str) -> Column:
    t = col(title)
    return (F.length(t) > 80) | t.rlike(TIME) | t.rlike(TEXTUAL) | t.rlike(ISO) | any_of(F.lower(t), BADGES)


def title_from_slug(url: Column | str) -> Column:
    """The last part of a url's path as a title: hyphens part its words, a number at its end goes; null without a hyphen."""
    path = F.rtrim(F.substring_index(filled(url), "?", 1), F.lit("/"))
    part = F.substring_index(path, "/", -1)
    words = F.filter(F.split(F.regexp_replace(part, r"-\d+$", ""), "-"), lambda w: w != "")
    named = F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.left(w, F.lit(1))), F.lower(F.substr(w, F.lit(2))))), " ")
    return F.when(F.contains(part, F.lit("-")) & (F.size(words) > 0), named)


def is_bot_challenge(html: Column | str) -> Column:
    return any_of(F.lower(F.left(col(html), F.lit(2000))), BOT_MARKERS)
