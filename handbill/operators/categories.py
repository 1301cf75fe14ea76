"""Categories: profiles of keywords, matched at the start of a word or anywhere, all of them or the first."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Literal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import col, filled, quoted

#: The scorer's categories in the order of display, and what is near.
SCORER = {
    "dancing": ["dance", "dancing", "tanz", "ballet", "ballett", "choreograph"],
    "music": ["concert", "konzert", "music", "musik", "band", "live music", "dj set", "festival", "gig"],
    "outside events": ["outdoor", "open air", "openair", "freiluft", "garden", "biergarten", "terrace"],
    "entrepreneurial events": ["startup", "entrepreneur", "business", "networking", "pitch", "venture", "founder"],
    "social gatherings": ["meetup", "social", "gathering", "community", "mixer", "stammtisch"],
    "theater": ["theater", "theatre", "schauspiel", "bühne", "buehne", "drama"],
    "culture": ["museum", "kultur", "culture", "exhibition", "ausstellung", "gallery", "kunst", "art"],
    "musical": ["musical"],
    "participating workshops": ["workshop", "seminar", "hands-on", "kurs", "participat", "mitmach"],
}
NEAR_LABEL, NEAR = "near Charlottenburg", ["charlottenburg", "schloss charlottenburg", "kurfürstendamm", "kudamm"]
#: The store's categories by priority.
STORE = {
    "music": ["concert", "music", "band", "live", "dj", "festival", "song"],
    "dance": ["dance", "tanz", "ballet", "choreography", "movement"],
    "networking": ["networking", "business", "entrepreneur", "startup", "professional"],
    "social": ["meetup", "networking", "social", "community", "gathering", "party"],
}
#: The configured categories in the order of the file, and the default.
CONFIGURED = {
    "music": ["concert", "live music", "band", "DJ", "club", "party", "dance", "festival", "gig", "acoustic", "orchestra", "symphony", "jazz", "rock", "pop", "electronic", "techno", "house"],
    "dance": ["dance", "ballet", "contemporary", "hip hop", "salsa", "tango", "choreography", "performance"],
    "social": ["meetup", "networking", "social", "gathering", "community", "friends", "party", "celebration", "pub crawl", "workshop", "seminar", "talk", "lecture"],
    "networking": ["business", "professional", "startup", "entrepreneur", "tech", "conference", "summit", "expo", "trade show", "career", "job fair"],
    "sports": ["sport", "fitness", "marathon", "cycling", "running", "football", "soccer", "basketball", "yoga", "training", "competition"],
    "culture": ["museum", "exhibition", "art", "gallery", "theater", "cinema", "film", "documentary", "history", "culture", "heritage"],
    "food": ["food", "restaurant", "cuisine", "cooking", "chef", "tasting", "market", "fair", "beer", "wine", "festival"],
    "family": ["family", "kids", "children", "kids", "playground", "zoo", "aquarium", "workshop", "activity"],
    "free": ["free", "gratis", "no cost", "complimentary", "open access"],
}
CONFIGURED_DEFAULT = "social"


@dataclass(frozen=True)
class Profile:
    """Categories in order, and the place that earns the proximity label, if any."""

    categories: dict[str, list[str]]
    near: list[str] | None = None
    near_label: str = NEAR_LABEL


STOCK = Profile(SCORER, NEAR)


def word_start(words: list[str]) -> str:
    """Any of the words, from the start of a word on; letters of all scripts count."""
    return r"(?iU)\b(?:" + "|".join(map(quoted, words)) + ")"


def haystack(*fields: str) -> Column:
    return F.concat_ws(" ", *(filled(f) for f in fields))


def content_categories(text: Column, profile: Profile) -> Column:
    """All categories with a keyword in the text, in the profile's order."""
    return F.array_compact(F.array(*(F.when(text.rlike(word_start(w)), F.lit(name)) for name, w in profile.categories.items())))


def is_near(text: Column, venue: Column, profile: Profile) -> Column:
    if not profile.near:
        return F.lit(False)
    return text.rlike(word_start(profile.near)) | venue.rlike(word_start(profile.near))


def categorize(text: Column | list[Column], categories: dict[str, list[str]], mode: Literal["word", "substring"] = "substring", default: str = "unknown") -> Column:
    """The first category with a keyword in the text (in any of several)."""
    texts = text if isinstance(text, list) else [text]

    def first(t: Column) -> Column:
        """The texts are joined by a mark that no keyword holds, and read once for each category."""
        out = F.lit(default)
        for name, words in reversed(categories.items()):
            pattern = word_start(words) if mode == "word" else "|".join(quoted(w.lower()) for w in words)
            out = F.when(t.rlike(pattern), name).otherwise(out)
        return out

    whole = F.concat_ws("\x00", *texts) if len(texts) > 1 else texts[0]
    # one element, so that the text is made and lowered once and not for each category
    return F.get(F.transform(F.array(whole if mode == "word" else F.lower(whole)), first), 0)


def store_category(title: Column | str = "title", description: Column | str = "description") -> Column:
    return categorize([filled(title), filled(description)], STORE)


def configured_category(title: Column | str = "title", description: Column | str = "description") -> Column:
    return categorize(F.concat_ws(" ", filled(title), filled(description)), CONFIGURED, default=CONFIGURED_DEFAULT)


def with_category(category: Column | str, found: Column) -> Column:
    """A listing's own category, or what was found where it has none."""
    return F.coalesce(F.nullif(col(category), F.lit("")), found)
