"""Extractors: from pages, structured data and markdown to listings. Each takes rows of pages and gives the nine fields with ``ordinal``."""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import TIME, day, parse_clock, parse_date, parse_meetup_date, parse_time, shown
from ..functions.prices import EURO, MAX_PRICE, PROGRAMME_PRICE, parse_meetup_card_price, parse_meetup_line_price, parse_price, parse_programme_price, parse_ticket_card_price, parse_ticket_price
from ..functions.text import absolute_url, filled, link_title, link_url, nonempty, prefixed_url, strip
from ..functions.titles import is_bot_challenge, title_from_slug, title_looks_noisy
from ..schema import LISTING_FIELDS
from . import dom
from .dedup import capped, first_titles, lowest_tier
from .filters import MEETUP_WORDS, TICKET_WORDS, has_signal, length_between

#: Caps of accepted rows by site, and lengths of texts.
GENERIC_CAP, MEETUP_CAP, TICKET_CAP = 60, 50, 40
TITLE_CHARS, SHORT_TITLE_CHARS, DESCRIPTION_CHARS = 200, 180, 500


def _listing(**fields: Column) -> list[Column]:
    return [*(fields[f].cast("double" if f == "price" else "string").alias(f) for f in LISTING_FIELDS), fields["ordinal"].cast("long").alias("ordinal")]


def _lines(pages: DataFrame, body: str) -> DataFrame:
    """A row per line of a page, without its outer white space."""
    return pages.select("source_url", F.posexplode(F.split(body, r"\r\n|\n|\r")).alias("ordinal", "line")).withColumn("text", strip("line"))


def markdown_generic(pages: DataFrame, as_of: str, body: str = "markdown") -> DataFrame:
    """Lines of 8 characters or more that name a price or date; the first of each title, at most 60 a page."""
    rows = _lines(pages, body).where((F.length("text") >= 8) & has_signal("text")).withColumn("title", link_title("text"))
    rows = first_titles(rows.where(F.length("title") >= 5), ["source_url"], GENERIC_CAP)
    return rows.select(*_listing(title=F.left("title", F.lit(TITLE_CHARS)), date=parse_date("text", as_of), time=parse_time("text"), price=parse_price("text"), category=F.lit(""), description=F.left("text", F.lit(DESCRIPTION_CHARS)), url=link_url("text", F.col("source_url")), venue=F.lit(""), source_url=F.col("source_url"), ordinal=F.col("ordinal")))


def markdown_programme(pages: DataFrame, as_of: str, body: str = "markdown") -> DataFrame:
    """Lines with a time before a price, the title from an image's text; repeats stay."""
    rows = _lines(pages, body).where(F.col("line").rlike(r"\d{1,2}:\d{2}.*?(?:Free|€|\d+[,.]\d+\s*€)") & F.col("line").rlike(PROGRAMME_PRICE))
    token = F.regexp_extract("line", PROGRAMME_PRICE, 1)
    pattern = r"!\[Image \d+:\s*(.*?)\]\([^)]+\)"
    title = F.when(F.col("line").rlike(pattern), strip(F.regexp_extract("line", pattern, 1))).otherwise("Unknown Event")
    return rows.select(*_listing(title=title, date=shown(day(as_of)), time=F.regexp_extract("line", r"(\d{1,2}:\d{2})", 1), price=parse_programme_price(token), category=F.lit("music"), description=F.lit(""), url=F.col("source_url"), venue=F.lit("Various"), source_url=F.col("source_url"), ordinal=F.col("ordinal")))


def _markdown_site(pages: DataFrame, body: str, words: str, price: Column, most: float, cap: int, date: Column, time: Column) -> DataFrame:
    """The price filter comes before the choice of the first title, so a dear line does not hide a cheap one."""
    rows = _lines(pages, body).where((F.length("text") >= 8) & F.col("text").rlike(words)).withColumns({"title": link_title("text"), "price": price})
    rows = first_titles(rows.where((F.length("title") >= 5) & (F.col("price") <= most)), ["source_url"], cap)
    return rows.select(*_listing(title=F.left("title", F.lit(SHORT_TITLE_CHARS)), date=date, time=time, price=F.col("price"), category=F.lit("social"), description=F.left("text", F.lit(DESCRIPTION_CHARS)), url=link_url("text", F.col("source_url")), venue=F.lit("Berlin"), source_url=F.col("source_url"), ordinal=F.col("ordinal")))


def markdown_meetup(pages: DataFrame, as_of: str, body: str = "markdown", most: float = MAX_PRICE) -> DataFrame:
    return _markdown_site(pages, body, MEETUP_WORDS, parse_meetup_line_price("text"), most, MEETUP_CAP, parse_meetup_date("text", as_of), parse_clock("text"))


def markdown_tickets(pages: DataFrame, as_of: str, body: str = "markdown", most: float = MAX_PRICE) -> DataFrame:
    return _markdown_site(pages, body, TICKET_WORDS, parse_ticket_price("text"), most, TICKET_CAP, shown(day(as_of)), F.lit(""))


# --- structured data -------------------------------------------------------------------------------

LD_JSON = r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""


def jsonld_nodes(pages: DataFrame, body: str = "html") -> DataFrame:
    """All objects of a page's structured data: the root, the elements of lists, and of graphs. Blocks that are no JSON go. A block is opened
    level by level, as often as its brackets lie in one another: an object gives itself, done, and the elements of its graph; a list gives its elements."""
    blocks = pages.select("source_url", F.posexplode(F.regexp_extract_all(F.coalesce(body, F.lit("")), F.lit(LD_JSON), F.lit(1))).alias("block", "raw"))
    bare = F.regexp_replace(F.regexp_replace(F.regexp_replace("raw", r"(?s)\\.", ""), r'"[^"]*"', ""), r"[^\[\]]", "")
    level = blocks.select("source_url", "block", F.try_parse_json("raw").alias("node"), bare.alias("bare")).where("node is not null")
    level = level.selectExpr("source_url", "block", "node", """aggregate(split(bare, ''), struct(0 AS at, 0 AS most), (a, x) -> struct(
        a.at + CASE x WHEN '[' THEN 1 WHEN ']' THEN -1 ELSE 0 END AS at, greatest(a.most, a.at + CASE x WHEN '[' THEN 1 ELSE 0 END) AS most), a -> a.most) AS depth""")
    # outer: an inner one would infer a filter that opens each block twice
    level = level.selectExpr("source_url", """inline_outer(aggregate(filter(sequence(0, depth), i -> i > 0), array(struct(array(block) AS path, node AS node, false AS done)), (level, i) -> flatten(transform(level, n -> concat(
        CASE WHEN n.done THEN array(n) WHEN schema_of_variant(n.node) LIKE 'OBJECT%' THEN array(struct(concat(n.path, array(-1)) AS path, n.node AS node, true AS done)) ELSE array() END,
        transform(coalesce(CASE WHEN n.done THEN NULL WHEN schema_of_variant(n.node) LIKE 'ARRAY%' THEN try_variant_get(n.node, '$', 'array<variant>')
            WHEN schema_of_variant(n.node) LIKE 'OBJECT%' THEN try_variant_get(n.node, '$["@graph"]', 'array<variant>') END, array()), (x, k) -> struct(concat(n.path, array(k)) AS path, x AS node, false AS done)))))))""")
    return level.where("node is not null AND (done OR schema_of_variant(node) LIKE 'OBJECT%')").drop("done")


def jsonld(pages: DataFrame, as_of: str, body: str = "html") -> DataFrame:
    """Listings of the nodes whose type, or one of whose types, says event."""
    get = lambda path, kind="string": F.expr(f"try_variant_get(node, '{path}', '{kind}')")
    types = F.lower(F.to_json(F.expr("try_variant_get(node, '$[\"@type\"]', 'variant')")))
    start = filled(get("$.startDate"))
    place = F.expr("try_variant_get(node, '$.location', 'variant')")
    first = F.expr("try_variant_get(node, '$.location[0]', 'variant')")
    plain = lambda v: F.when(F.expr(f"schema_of_variant({v})") == "STRING", F.expr(f"cast({v} as string)"))
    rows = jsonld_nodes(pages, body).where(F.contains(types, F.lit("event"))).withColumns({"place": place, "first": first})
    venue = F.coalesce(get("$.location.name"), get("$.location[0].name"), plain("place"), plain("first"), F.lit(""))
    price = F.coalesce(get("$.offers.price", "double"), get("$.offers[0].price", "double"))
    nth = F.row_number().over(Window.partitionBy("source_url").orderBy("path")) - 1
    # a variant key can't be part of a window's sort, so the place is numbered beside the extracted fields
    flat = rows.select("source_url", "path", F.coalesce(get("$.name"), F.lit("Untitled event")).alias("title"), F.coalesce(nonempty(F.substring_index(start, "T", 1)), shown(day(as_of))).alias("date"), F.when(F.contains(start, F.lit("T")), F.left(F.regexp_replace(start, "^[^T]*T", ""), F.lit(5))).otherwise("").alias("time"), price.alias("price"), F.left(filled(get("$.description")), F.lit(DESCRIPTION_CHARS)).alias("description"), F.coalesce(nonempty(get("$.url")), F.col("source_url")).alias("url"), venue.alias("venue"))
    return flat.withColumn("ordinal", nth).select(*_listing(title=F.col("title"), date=F.col("date"), time=F.col("time"), price=F.col("price"), category=F.lit(""), description=F.col("description"), url=F.col("url"), venue=F.col("venue"), source_url=F.col("source_url"), ordinal=F.col("ordinal")))


# --- trees ---------------------------------------------------------------------------------------


def heuristic(pages: DataFrame, as_of: str, body: str = "html") -> DataFrame:
    """Elements whose class hints at a listing, of 15 to 3000 characters, with a price or date; the outermost of nested ones; of the first 60
    of a page the first of each title."""
    cards = pages.select("source_url", F.col(body).alias("html")).mapInArrow(dom.hinted_cards, dom.CARD_TYPE)
    cards = cards.where(length_between("text", 15, dom.MOST_CHARS) & has_signal("text"))
    # elements are numbered in the order of the page, so a card lies in one before it if it is not past that one's last element
    reach = F.max("last").over(Window.partitionBy("source_url").orderBy("card_id").rowsBetween(Window.unboundedPreceding, -1))
    rows = cards.withColumn("reach", reach).where("reach is null or card_id > reach").withColumn("ordinal", F.col("pos"))
    clean = lambda x: ~x.rlike(EURO) & ~x.rlike(TIME)
    named = F.filter(F.transform("scopes", lambda s: F.coalesce(F.nullif(s["heading"], F.lit("")), F.when(clean(s["link"]), F.nullif(s["link"], F.lit(""))))), lambda t: t.isNotNull())
    href = F.try_element_at(F.filter(F.transform("scopes", lambda s: s["href"]), lambda h: h.isNotNull()), F.lit(1))
    title = F.coalesce(nonempty(strip(F.coalesce(F.try_element_at(named, F.lit(1)), F.left("text", F.lit(120))))), F.lit("Untitled event"))
    rows = rows.withColumns({"url": F.coalesce(href, "source_url"), "title": title})
    rows = rows.withColumn("title", F.when(title_looks_noisy("title"), F.coalesce(title_from_slug("url"), F.col("title"))).otherwise(F.col("title")))
    rows = first_titles(rows, ["source_url"], GENERIC_CAP, before=True)
    context = F.concat_ws(" ", F.array_join("context", " "), "text")
    return rows.select(*_listing(title=F.left("title", F.lit(TITLE_CHARS)), date=parse_date(context, as_of), time=parse_time("text"), price=parse_price("text"), category=F.lit(""), description=F.left("text", F.lit(DESCRIPTION_CHARS)), url=F.col("url"), venue=F.lit(""), source_url=F.col("source_url"), ordinal=F.col("ordinal")))


def meetup_cards(pages: DataFrame, as_of: str, body: str = "html", most: float = MAX_PRICE) -> DataFrame:
    rows = pages.select("source_url", F.col(body).alias("html")).mapInArrow(dom.selected_cards(dom.MEETUP_CARDS), dom.PARTS_TYPE)
    price = parse_meetup_card_price(F.coalesce("price", F.lit("Free")))
    title = F.coalesce("title", F.concat(F.lit("Event "), F.col("pos") + 1))
    url = F.when(F.col("href").isNull(), F.col("source_url")).otherwise(prefixed_url("href", "https://meetup.com"))
    return rows.select(*_listing(title=title, date=parse_meetup_date(filled("date"), as_of), time=parse_clock(filled("date")), price=price, category=F.lit("social"), description=F.left(filled("description"), F.lit(DESCRIPTION_CHARS)), url=url, venue=F.coalesce("venue", F.lit("Online")), source_url=F.col("source_url"), ordinal=F.col("pos"))).where(F.col("price") <= most)


def ticket_cards(pages: DataFrame, as_of: str, body: str = "html", most: float = MAX_PRICE) -> DataFrame:
    rows = pages.select("source_url", F.col(body).alias("html")).mapInArrow(dom.selected_cards(dom.TICKET_CARDS), dom.PARTS_TYPE)
    venue = F.coalesce("venue", F.lit("Berlin"))
    title = F.coalesce("title", F.concat(F.lit("Event "), F.col("pos") + 1))
    url = F.when(F.col("href").isNull(), F.col("source_url")).otherwise(prefixed_url("href", "https://www.eventbrite.de"))
    return rows.select(*_listing(title=title, date=shown(day(as_of)), time=F.lit(""), price=parse_ticket_card_price(F.coalesce("price", F.lit("Free"))), category=F.lit("social"), description=F.concat(F.lit("Event at "), venue, F.lit(" on "), filled("date")), url=url, venue=venue, source_url=F.col("source_url"), ordinal=F.col("pos"))).where(F.col("price") <= most)


def page_links(pages: DataFrame, body: str = "html") -> DataFrame:
    """The first heading and the first link of each page, resolved."""
    heading = F.regexp_replace(F.regexp_extract(body, r"(?is)<h1[^>]*>(.*?)</h1>", 1), r"<[^>]*>", "")
    href = F.regexp_extract(body, r"""(?is)<a\s[^>]*href\s*=\s*["']([^"']*)["']""", 1)
    return pages.select("source_url", heading.alias("heading"), href.alias("href"), absolute_url(href, "source_url").alias("url"))


#: An extractor takes (pages, as_of, body), where ``body`` names the column to read, and gives the nine fields with ``ordinal``.
Extractor = Callable[[DataFrame, str, str], DataFrame]
#: The strategies by name: the extractor, the column it reads, and its tier. Of each source the lowest tier that finds any listing counts.
EXTRACTORS: dict[str, tuple[Extractor, str, int]] = {
    "jsonld": (jsonld, "html", 0), "heuristic": (heuristic, "html", 1), "rendered jsonld": (jsonld, "rendered", 2),
    "rendered heuristic": (heuristic, "rendered", 3), "markdown": (markdown_generic, "markdown", 4),
}


def register(name: str, extractor: Extractor, body: str, tier: int) -> None:
    """Adds a strategy to the cascade, or replaces the one of that name. Strategies of one tier count together."""
    EXTRACTORS[name] = (extractor, body, tier)


def cascade(pages: DataFrame, as_of: str, extractors: dict[str, tuple[Extractor, str, int]] | None = None) -> DataFrame:
    """Of each source the listings of the first strategy that finds any: structured data then cards of the plain page (unless it is a bot check), the same
    of the rendered page, then markdown, and what :func:`register` has added. ``pages`` has source_url and the columns that the strategies read, each possibly null."""
    every = None
    for extractor, body, tier in (EXTRACTORS if extractors is None else extractors).values():
        some = pages.where(F.col(body).isNotNull())
        rows = extractor(some.where(~is_bot_challenge(body)) if body == "html" else some, as_of, body).withColumn("tier", F.lit(tier))
        every = rows if every is None else every.unionByName(rows)
    return lowest_tier(every)


# --- answers in texts ------------------------------------------------------------------------------


def json_array(text: Column | str, schema: T.StructType) -> Column:
    """The listings in an answer: without a code fence, as JSON, else from the first [ to the last ]; an object gives its ``events``."""
    t = strip(text)
    t = F.when(t.startswith("```"), strip(F.regexp_replace(F.regexp_replace(t, r"^```[a-zA-Z]*\n?", ""), r"\n?```$", ""))).otherwise(t)
    many = T.ArrayType(schema)
    sliced = F.regexp_extract(t, r"(?s)(\[.*\])", 1)
    inner = F.from_json(t, T.StructType([T.StructField("events", many)]))["events"]
    whole = F.when(t.startswith("["), F.from_json(t, many)).when(t.startswith("{"), inner)
    return F.filter(F.coalesce(whole, F.from_json(F.nullif(sliced, F.lit("")), many)), lambda x: x.isNotNull())


@F.pandas_udf(T.StringType())
def json_object(texts: pd.Series) -> pd.Series:
    """The first object whose braces balance, else a fenced block; null where neither is JSON."""

    def one(text):
        if not text:
            return None
        start, tries = text.find("{"), []
        if start >= 0:
            depth = 0
            for m in re.finditer(r"[{}]", text[start:]):
                depth += 1 if m[0] == "{" else -1
                if not depth:
                    tries.append(text[start : start + m.end()])
                    break
        at = text.find("```json")
        if at >= 0 and (end := text.find("```", at + 7)) > at:
            tries.append(text[at + 7 : end].strip())
        for t in tries:
            try:
                return json.dumps(json.loads(t), ensure_ascii=False)
            except ValueError:
                continue
        return None

    return pd.Series([one(t) for t in texts], dtype=object)


def exploded(rows: DataFrame, answer: str, schema: T.StructType) -> DataFrame:
    """A row per listing of an answer."""
    return rows.select("source_url", F.posexplode(json_array(answer, schema)).alias("ordinal", "e")).select(F.col("source_url").alias("fallback"), "ordinal", "e.*")


def first_of_page(df: DataFrame, most: int) -> DataFrame:
    return capped(df, ["source_url"], most)
