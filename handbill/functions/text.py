"""Expressions over texts that several operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nonempty(c: Column | str) -> Column:
    """Null where the text is empty."""
    return F.nullif(col(c), F.lit(""))


def filled(c: Column | str) -> Column:
    """Empty where the text is null."""
    return F.coalesce(col(c), F.lit(""))


def strip(c: Column | str) -> Column:
    """Without white space of any script at its ends."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def group(c: Column | str, pattern: str, n: int = 1) -> Column:
    """A group of the first match; null where nothing matches or the group is empty."""
    return nonempty(F.regexp_extract(col(c), pattern, n))


def quoted(word: str) -> str:
    """A word as a pattern that Java and RE2 read alike."""
    return re.sub(r"([^\w\s])", r"\\\1", word)


#: A markdown link with a label of 5 to 160 characters, and the marks that are stripped from a line without one. Fixed values.
LINK = r"\[([^\]]{5,160})\]\((https?://[^)]+)\)"
MARKS = r"[#*_`>-]"


def link_title(line: Column | str) -> Column:
    return F.coalesce(strip(group(line, LINK, 1)), strip(F.regexp_replace(col(line), MARKS, "")))


def link_url(line: Column | str, otherwise: Column) -> Column:
    return F.coalesce(group(line, LINK, 2), otherwise)


def file_slug(name: Column | str) -> Column:
    """A site's name as part of a file name."""
    return F.replace(F.lower(col(name)), F.lit(" "), F.lit("_"))


def absolute_url(href: Column | str, base: Column | str) -> Column:
    """A link resolved against its page, for the forms that pages use: absolute, protocol, root, query, fragment and relative."""
    h, b = filled(href), col(base)
    root = F.regexp_extract(b, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*", 0)
    page = F.regexp_extract(b, r"^[^?#]*", 0)
    folder = F.when(page == root, F.concat(root, F.lit("/"))).otherwise(F.regexp_replace(page, r"[^/]*$", ""))
    # the parts of the path in order: a step up takes the last one away, at the root it does nothing; what follows ? or # is no path
    tail = F.regexp_extract(h, r"(?s)[?#].*$", 0)
    steps = F.split(F.concat(F.substr(folder, F.length(root) + 2), F.regexp_replace(h, r"(?s)[?#].*$", "")), "/")
    last = F.element_at(steps, -1)
    kept = F.aggregate(
        F.slice(steps, F.lit(1), F.size(steps) - 1), F.array().cast("array<string>"),
        lambda have, x: F.when(x == ".", have).when(x == "..", F.slice(have, F.lit(1), F.greatest(F.size(have) - 1, F.lit(0)))).otherwise(F.array_append(have, x)),
    )
    up = F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))
    parts = F.when(last == "..", F.array_append(up, F.lit(""))).when(last == ".", F.array_append(kept, F.lit(""))).otherwise(F.array_append(kept, last))
    joined = F.concat(root, F.lit("/"), F.array_join(parts, "/"), tail)
    return (
        F.when(h == "", b)
        .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(F.regexp_extract(b, r"^[^:]*:", 0), h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("#"), F.concat(F.regexp_extract(b, r"^[^#]*", 0), h))
        .when(h.startswith("?"), F.concat(page, h))
        .otherwise(joined)
    )


def prefixed_url(href: Column | str, prefix: str) -> Column:
    """A link that does not start with http gets a site's prefix."""
    return F.when(col(href).startswith("http"), col(href)).otherwise(F.concat(F.lit(prefix), filled(href)))
