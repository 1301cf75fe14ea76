"""The registered queries over listings, and the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, prices, text, titles
from ..operators import browse, categories, dedup, extract, filters, merge, report, scoring
from ..sources import readers, sinks
from .listings import AS_OF, LISTINGS_SQL, PER_PAGE, TEST_PROFILE, euro, listings, pages_of, table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None, with_listings: bool = True):
    """Registers a query under its function's name; ``sql`` may use the view ``listings``."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = f"WITH {LISTINGS_SQL}{',' if sql.lstrip().startswith('+') else ''} {sql.lstrip().removeprefix('+')}" if with_listings else sql
        return f

    return add


def _word(words: str) -> str:
    return rf"(?i)(?:^|[^\p{{L}}\p{{N}}_])(?:{words})"


_KEY = "lower(trim(title)), trim(date)"
_HITS = f"""+ f AS (SELECT * FROM listings WHERE price IS NULL OR price <= 15),
u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ordinal) AS nth FROM f) WHERE nth = 1),
h AS (SELECT *, concat_ws(' ', coalesce(title, ''), coalesce(description, ''), coalesce(category, '')) AS hay FROM u),
c AS (SELECT *, list_filter([CASE WHEN regexp_matches(hay, '{_word("click|signup")}') THEN 'acts' END, CASE WHEN regexp_matches(hay, '{_word("tion")}') THEN 'tion' END,
  CASE WHEN regexp_matches(hay, '{_word("und")}') THEN 'und' END, CASE WHEN regexp_matches(hay, '{_word("purchase|that")}') THEN 'that' END], lambda x: x IS NOT NULL) AS found,
  regexp_matches(hay, '{_word("v1")}') OR regexp_matches(venue, '{_word("v1")}') AS near FROM h),
s AS (SELECT ordinal, title, date, time, price, source_url, venue, description,
  CASE WHEN price IS NULL THEN 'Check site' WHEN price = 0 THEN 'Free' ELSE '€' || rtrim(rtrim(printf('%.2f', price), '0'), '.') END AS price_label,
  array_to_string(list_concat(found, CASE WHEN near THEN ['near v1'] ELSE [] END), '|') AS matched,
  CASE WHEN len(found) > 0 THEN array_to_string(found, ', ') WHEN category <> '' THEN category ELSE 'general' END AS category,
  least(100, CASE WHEN price IS NULL THEN 5 WHEN price = 0 THEN 40 WHEN price <= 10 THEN 25 WHEN price <= 15 THEN 10 ELSE 0 END + least(45, 15 * len(found)) + CASE WHEN near THEN 20 ELSE 0 END)::INTEGER AS score FROM c)"""


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dedup.first_wins(listings(spark, sf_dir).where(filters.affordable()))
    return scoring.scored(rows, TEST_PROFILE)


def _flat(df: DataFrame, *more: str) -> DataFrame:
    return df.select("ordinal", "title", "date", "price", "price_label", F.array_join("matched_categories", "|").alias("matched"), "category", "score", *more)


@query(f"{_HITS} SELECT ordinal, title, date, price, price_label, matched, category, score, row_number() OVER (ORDER BY score DESC, coalesce(price, 999), lower(title), ordinal) AS rank FROM s")
def flagship_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat(scoring.numbered(_scored(spark, sf_dir), scoring.rank_order()), "rank")


@query("SELECT ordinal, price FROM listings WHERE price IS NULL OR price <= 15")
def price_filter_null_kept(spark, sf_dir):
    return listings(spark, sf_dir).where(filters.affordable()).select("ordinal", "price")


@query("SELECT ordinal, price FROM listings WHERE coalesce(price, 0) <= 15")
def price_filter_zero(spark, sf_dir):
    return listings(spark, sf_dir).where(filters.affordable_zero()).select("ordinal", "price")


@query("SELECT ordinal, price FROM listings WHERE price <= 15")
def price_filter_known(spark, sf_dir):
    return listings(spark, sf_dir).where(filters.affordable_known()).select("ordinal", "price")


@query("SELECT ordinal, CASE WHEN price IS NULL THEN 'Check site' WHEN price = 0 THEN 'Free' ELSE '€' || rtrim(rtrim(printf('%.2f', price), '0'), '.') END AS price_label FROM listings")
def price_label(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", prices.price_label("price").alias("price_label"))


@query("SELECT ordinal, (CASE WHEN price IS NULL THEN 5 WHEN price = 0 THEN 40 WHEN price <= 10 THEN 25 WHEN price <= 15 THEN 10 ELSE 0 END)::INTEGER AS price_score FROM listings")
def price_score(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", prices.price_score("price").alias("price_score"))


_BUCKET = "CASE WHEN price IS NULL THEN 'Free' WHEN price <= 5 THEN '0-5€' WHEN price <= 10 THEN '5-10€' WHEN price <= 15 THEN '10-15€' ELSE '>15€' END"


@query(f"SELECT {_BUCKET} AS price_range, count(*) AS n FROM listings WHERE date >= '{AS_OF}' GROUP BY 1")
def price_buckets(spark, sf_dir):
    return report.price_buckets(listings(spark, sf_dir), AS_OF)


@query(f"SELECT * EXCLUDE nth FROM (SELECT ordinal, title, date, row_number() OVER (PARTITION BY {_KEY} ORDER BY ordinal) AS nth FROM listings) WHERE nth = 1")
def first_wins_dedup(spark, sf_dir):
    return dedup.first_wins(listings(spark, sf_dir)).select("ordinal", "title", "date")


_STORE = ("ordinal", "title", "date", "time", "price", "source_url")
_COLS = ", ".join(_STORE)


def _halves(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """The store holds the first of each key among even ordinals; the odd ones are the batch."""
    rows = listings(spark, sf_dir).select(*_STORE)
    return dedup.first_wins(rows.where("ordinal % 2 = 0"), [F.col(k) for k in merge.STORE_KEY]), rows.where("ordinal % 2 = 1")


_SPLIT = f"""+ store AS (SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY title, date, time, source_url ORDER BY ordinal) AS nth FROM listings WHERE ordinal % 2 = 0) WHERE nth = 1),
batch AS (SELECT {_COLS} FROM listings WHERE ordinal % 2 = 1)"""


@query(f"""{_SPLIT}, new AS (SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY title, date, time, source_url ORDER BY ordinal DESC) AS nth FROM batch) WHERE nth = 1 OR time IS NULL)
SELECT {_COLS} FROM store s WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.title = s.title AND b.date = s.date AND b.time = s.time AND b.source_url = s.source_url)
UNION ALL SELECT {_COLS} FROM new""")
def last_wins_upsert(spark, sf_dir):
    return merge.upsert_replace(*_halves(spark, sf_dir))


@query(f"""{_SPLIT}, new AS (SELECT {_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY title, date, time, source_url ORDER BY ordinal) AS nth FROM batch) WHERE nth = 1 OR time IS NULL)
SELECT {_COLS} FROM store UNION ALL SELECT {_COLS} FROM new n
WHERE NOT EXISTS (SELECT 1 FROM store s WHERE n.title = s.title AND n.date = s.date AND n.time = s.time AND n.source_url = s.source_url)""")
def insert_ignore(spark, sf_dir):
    return merge.insert_ignore(*_halves(spark, sf_dir))


@query("""+ b AS (SELECT *, row_number() OVER (PARTITION BY title, source_url ORDER BY ordinal) > 1 AS again FROM listings WHERE ordinal % 2 = 1)
SELECT ordinal, again OR EXISTS (SELECT 1 FROM listings s WHERE s.ordinal % 2 = 0 AND s.title = b.title AND s.source_url = b.source_url) AS is_recursive FROM b""")
def is_recursive(spark, sf_dir):
    store, batch = _halves(spark, sf_dir)
    return dedup.is_recursive(batch, store).select("ordinal", "is_recursive")


@query("+ s AS (SELECT DISTINCT lower(title) AS k FROM listings WHERE ordinal % 3 = 0 AND title LIKE 'click%') SELECT ordinal, title FROM listings WHERE ordinal % 3 <> 0 AND lower(title) NOT IN (SELECT k FROM s)")
def missed_events(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return merge.missed(rows.where("ordinal % 3 <> 0"), rows.where("ordinal % 3 = 0 and title like 'click%'")).select("ordinal", "title")


@query(f"""+ e AS (SELECT * FROM listings WHERE ordinal % 2 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY ordinal) AS nth FROM listings WHERE ordinal % 2 = 1)
SELECT ordinal, title, date, FALSE AS recovered FROM e UNION ALL
SELECT ordinal, title, date, TRUE FROM r WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM e WHERE lower(trim(e.title)) = lower(trim(r.title)) AND trim(e.date) = trim(r.date))""")
def merge_recovered(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return merge.merge_recovered(rows.where("ordinal % 2 = 0"), rows.where("ordinal % 2 = 1")).select("ordinal", "title", "date", "recovered")


@query("SELECT source_url, count(*) AS n FROM listings GROUP BY 1")
def per_source_counts(spark, sf_dir):
    return report.per_source(listings(spark, sf_dir))


def _sources(spark) -> DataFrame:
    return spark.range(15).select(F.concat(F.lit("https://s"), F.col("id").cast("string"), F.lit(".example")).alias("source_url"))


@query("+ s AS (SELECT 'https://s' || range || '.example' AS source_url FROM range(15)), n AS (SELECT source_url, count(*) AS n FROM listings GROUP BY 1) SELECT s.source_url, coalesce(n, 0) AS n, coalesce(n, 0) = 0 AS failed FROM s LEFT JOIN n USING (source_url)")
def completeness(spark, sf_dir):
    return report.completeness(_sources(spark), listings(spark, sf_dir))


@query("+ s AS (SELECT 'https://s' || range || '.example' AS source_url FROM range(15)) SELECT source_url FROM s WHERE source_url NOT IN (SELECT source_url FROM listings)")
def failed_sources(spark, sf_dir):
    return report.completeness(_sources(spark), listings(spark, sf_dir)).where("failed").select("source_url")


@query(f"SELECT category, count(*) AS n FROM listings WHERE date >= '{AS_OF}' GROUP BY 1")
def category_counts(spark, sf_dir):
    return report.category_counts(listings(spark, sf_dir), AS_OF)


@query("SELECT string_agg(category || '=' || n, '|' ORDER BY category) AS distribution FROM (SELECT category, count(*) AS n FROM listings GROUP BY 1)")
def category_distribution(spark, sf_dir):
    pairs = F.transform(F.array_sort(F.map_entries("category_distribution")), lambda x: F.concat(x["key"], F.lit("="), x["value"].cast("string")))
    return report.category_distribution(listings(spark, sf_dir)).select(F.array_join(pairs, "|").alias("distribution"))


def _contains(hay: str, groups: dict[str, list[str]], default: str) -> str:
    cases = " ".join(f"WHEN {' OR '.join(f'contains({h}, {w.lower()!r})' for w in words for h in hay.split('&'))} THEN {name!r}" for name, words in groups.items())
    return f"CASE {cases} ELSE {default!r} END"


@query(f"SELECT ordinal, {_contains('lower(title)&lower(description)', categories.STORE, 'unknown')} AS category FROM listings")
def categorize_substring(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", categories.store_category().alias("category"))


@query(f"+ h AS (SELECT ordinal, lower(title || ' ' || description) AS hay FROM listings) SELECT ordinal, {_contains('hay', categories.CONFIGURED, 'social')} AS category FROM h")
def categorize_first(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", categories.configured_category().alias("category"))


_STOCK_SQL = ", ".join(f"CASE WHEN regexp_matches(hay, '{_word('|'.join(w))}') THEN '{name}' END" for name, w in categories.SCORER.items())


@query(f"+ h AS (SELECT doc_id, coalesce(text, '') AS hay FROM documents) SELECT doc_id, array_to_string(list_filter([{_STOCK_SQL}], lambda x: x IS NOT NULL), '|') AS matched FROM h")
def categorize_stock(spark, sf_dir):
    found = categories.content_categories(text.filled("text"), categories.STOCK)
    return table(spark, sf_dir, "documents").select("doc_id", F.array_join(found, "|").alias("matched"))


@query("SELECT ordinal, coalesce(description, '') = '' OR coalesce(category, '') = '' OR coalesce(price, 0) = 0 AS needs_review FROM listings")
def needs_review(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", filters.needs_review().alias("needs_review"))


@query(f"""SELECT ordinal, date >= strftime(DATE '{AS_OF}' - 7, '%Y-%m-%d') AND date <= strftime(DATE '{AS_OF}' + 14, '%Y-%m-%d') AS around, date >= '{AS_OF}' AS upcoming,
  date >= strftime(DATE '{AS_OF}' - 7, '%Y-%m-%d') AS recent, date::DATE BETWEEN DATE '{AS_OF}' AND DATE '{AS_OF}' + 14 AS in_days FROM listings""")
def date_windows(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", filters.around(AS_OF).alias("around"), filters.upcoming(AS_OF).alias("upcoming"), filters.recent(AS_OF).alias("recent"), filters.in_days(AS_OF, enabled=True).alias("in_days"))


_DAY = "o_orderdate::DATE"


@query(f"""SELECT o_orderkey, strftime({_DAY} + (8 - isodow({_DAY}))::INTEGER, '%Y-%m-%d') AS monday, strftime({_DAY} + (14 - isodow({_DAY}))::INTEGER, '%Y-%m-%d') AS sunday FROM orders""", False)
def next_week(spark, sf_dir):
    monday, sunday = dates.next_week(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.shown(monday).alias("monday"), dates.shown(sunday).alias("sunday"))


@query(f"""SELECT o_orderkey, strftime({_DAY} - dayofweek({_DAY})::INTEGER, '%Y-%m-%d') AS sunday, strftime({_DAY} - dayofweek({_DAY})::INTEGER + 6, '%Y-%m-%d') AS saturday FROM orders""", False)
def current_week(spark, sf_dir):
    sunday, saturday = dates.current_week(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.shown(sunday).alias("sunday"), dates.shown(saturday).alias("saturday"))


@query(f"""+ d AS (SELECT o_orderkey, (((({_DAY}) - DATE '2024-01-06') % 14 + 14) % 14)::INTEGER AS n FROM orders)
SELECT o_orderkey, n AS cycle_day, ['Sunday', 'Monday', 'Tuesday', 'Wednesday', 'Thursday', 'Friday', 'Saturday'][(n % 7 + 1)::INTEGER] AS name, ['Mon', 'Tue', 'Wed', 'Thu', 'Fri', 'Sat', 'Sun'][(((n + 1) % 14) % 7 + 1)::INTEGER] AS next_name FROM d""")
def cycle_day(spark, sf_dir):
    n = dates.cycle_day(F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select("o_orderkey", n.alias("cycle_day"), dates.cycle_day_name(n).alias("name"), dates.next_cycle_day_name(n).alias("next_name"))


_SEARCH = "contains(lower(concat_ws(' ', coalesce(title, ''), coalesce(venue, ''), coalesce(description, ''), coalesce(category, ''), coalesce(price_label, ''), replace(matched, '|', ' '))), 'night 7')"


@query(f"{_HITS} SELECT ordinal FROM s WHERE {_SEARCH}")
def browse_search(spark, sf_dir):
    return browse.search(_scored(spark, sf_dir), "Night 7").select("ordinal")


@query("SELECT ordinal, price FROM listings WHERE price = 0")
def browse_free(spark, sf_dir):
    return browse.free_only(listings(spark, sf_dir)).select("ordinal", "price")


@query("SELECT ordinal, row_number() OVER (ORDER BY coalesce(price, 999999) DESC, ordinal) AS place FROM listings")
def browse_sort_price(spark, sf_dir):
    return scoring.numbered(listings(spark, sf_dir), browse.sort_order("price"), "place").select("ordinal", "place")


@query("SELECT ordinal, row_number() OVER (ORDER BY coalesce(date, '') || ' ' || coalesce(time, ''), ordinal) AS place FROM listings")
def browse_sort_date(spark, sf_dir):
    return scoring.numbered(listings(spark, sf_dir), browse.sort_order("date", False), "place").select("ordinal", "place")


@query("SELECT ordinal, row_number() OVER (ORDER BY date NULLS FIRST, time NULLS FIRST, ordinal) AS place FROM listings WHERE date >= strftime(DATE '2024-01-15' - 7, '%Y-%m-%d')")
def publication_order(spark, sf_dir):
    rows = listings(spark, sf_dir).where(filters.recent(AS_OF))
    return scoring.numbered(rows, [F.asc_nulls_first("date"), F.asc_nulls_first("time"), F.asc("ordinal")], "place").select("ordinal", "place")


@query("SELECT ordinal, title FROM listings WHERE ordinal IN (SELECT o_orderkey FROM orders)")
def browse_selected(spark, sf_dir):
    return browse.selected(listings(spark, sf_dir), table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("ordinal"))).select("ordinal", "title")


@query(f"""SELECT ordinal, coalesce(price = 0, FALSE) AS free, NOT coalesce(price = 0, FALSE) AS paid, date::DATE BETWEEN DATE '2024-01-14' AND DATE '2024-01-20' AS weekend, date = '{AS_OF}' AS today FROM listings""")
def site_filters(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", *(filters.site_filter(n, AS_OF).alias(n) for n in ("free", "paid", "weekend", "today")))


@query("SELECT count(*) AS total, count(*) FILTER (price = 0) AS free, count(*) FILTER (price IS NULL OR price <> 0) AS paid, count(*) FILTER (date::DATE BETWEEN DATE '2024-01-14' AND DATE '2024-01-20') AS in_week FROM listings")
def site_stats(spark, sf_dir):
    return report.site_stats(listings(spark, sf_dir), AS_OF)


@query("SELECT count(*) FILTER (price IS NULL OR price <= 15) AS saved, count(*) FILTER (price > 15) AS filtered, count(*) AS processed FROM listings")
def run_totals(spark, sf_dir):
    return report.run_totals(listings(spark, sf_dir))


@query("""+ r AS (SELECT source_url, count(*) FILTER (ordinal % 2 = 0) AS a, count(*) FILTER (ordinal % 2 = 1) AS b, count(*) FILTER (price IS NULL) AS m, count(DISTINCT url) AS u FROM listings GROUP BY 1)
SELECT count(*) FILTER (m > 0) AS successful, count(*) FILTER (NOT m > 0) AS failed, sum(a)::BIGINT AS phase1_events, sum(b)::BIGINT AS agent_events, sum(m)::BIGINT AS missed_events, sum(u)::BIGINT AS sub_urls FROM r""")
def validation_totals(spark, sf_dir):
    rows = listings(spark, sf_dir).groupBy("source_url").agg(F.count_if(F.col("ordinal") % 2 == 0).alias("phase1_events"), F.count_if(F.col("ordinal") % 2 == 1).alias("agent_events"), F.count_if(F.col("price").isNull()).alias("missed_events"), F.count_distinct("url").alias("sub_urls"))
    return report.validation_totals(rows.withColumn("success", F.col("missed_events") > 0))


@query("SELECT lower(title) AS title FROM listings GROUP BY 1")
def distinct_titles(spark, sf_dir):
    return report.distinct_titles(listings(spark, sf_dir))


@query("SELECT source_url, string_agg(title, '|' ORDER BY ordinal) AS titles FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY ordinal) AS nth FROM listings) WHERE nth <= 10 GROUP BY 1")
def sample_titles(spark, sf_dir):
    return report.samples(listings(spark, sf_dir), "source_url", "title", 10).select("source_url", F.array_join("title", "|").alias("titles"))


@query(r"""SELECT ordinal, 'BEGIN:VEVENT' || chr(13) || chr(10) || 'UID:' || ordinal || chr(13) || chr(10) ||
  CASE WHEN time IS NULL THEN 'DTSTART;VALUE=DATE:' || replace(date, '-', '') ELSE 'DTSTART:' || replace(date, '-', '') || 'T' || replace(time, ':', '') || '00' END || chr(13) || chr(10) ||
  'SUMMARY:' || title || chr(13) || chr(10) || 'LOCATION:' || venue || chr(13) || chr(10) ||
  'DESCRIPTION:' || replace(regexp_replace(coalesce(description, ''), '([\\;,])', '\\\1', 'g'), chr(10), '\n') || coalesce('\n' || regexp_replace(url, '([\\;,])', '\\\1', 'g'), '') || chr(13) || chr(10) ||
  coalesce('URL:' || url || chr(13) || chr(10), '') || 'END:VEVENT' AS ics FROM listings""")
def ics_events(spark, sf_dir):
    return browse.ics_events(listings(spark, sf_dir), F.col("ordinal")).select("ordinal", "ics")


# --- parsers, over texts made of the columns of orders ------------------------------------------


def _orders(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumns({"cents": F.col("o_orderkey") % 5000, "kind": F.col("o_orderkey") % 6, "day": F.col("o_orderdate").cast("date")})


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 0.0 WHEN 4 THEN (o_orderkey % 5000 // 100)::DOUBLE WHEN 5 THEN NULL ELSE (o_orderkey % 5000) / 100.0 END::DOUBLE AS price,
  CASE o_orderkey % 6 WHEN 1 THEN (o_orderkey % 5000) / 100.0 WHEN 3 THEN (o_orderkey % 5000) / 100.0 ELSE 0.0 END::DOUBLE AS ticket FROM orders""", False)
def parse_price(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    amount = euro(F.col("cents"))
    line = F.when(F.col("kind") == 0, F.concat(F.lit("Eintritt frei, gratis, sonst "), amount, F.lit(" €"))).when(F.col("kind") == 1, F.concat(F.lit("ab "), amount, F.lit(" €"))).when(F.col("kind") == 2, F.concat(F.lit("€ "), amount)).when(F.col("kind") == 3, F.concat(amount, F.lit(" EUR an der Kasse"))).when(F.col("kind") == 4, F.concat(F.lit("€"), (F.col("cents") / 100).cast("int").cast("string"), F.lit(" p.P."))).otherwise(F.lit("tba"))
    return rows.select("o_orderkey", prices.parse_price(line).alias("price"), prices.parse_ticket_price(line).alias("ticket"))


@query(f"""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN '{AS_OF}' ELSE strftime({_DAY}, '%Y-%m-%d') END AS date FROM orders""", False)
def parse_date(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    form = lambda f: F.date_format("day", f)
    line = F.when(F.col("kind") == 0, F.concat(F.lit("am "), form("yyyy-MM-dd"), F.lit(" um acht"))).when(F.col("kind") == 1, form("d.M.yyyy")).when(F.col("kind") == 2, F.concat(F.lit("Fr, "), form("dd. MM. yyyy"))).when(F.col("kind") == 3, form("d MMMM yyyy")).when(F.col("kind") == 4, F.concat(form("d"), F.lit(". "), form("MMMM"), F.lit(" "), form("yyyy"), F.lit(" abends"))).otherwise(F.lit("July 4, every year"))
    return rows.select("o_orderkey", dates.parse_date(line, AS_OF).alias("date"))


@query(f"""+ d AS (SELECT o_orderkey, make_date(2024, month({_DAY}), least(day({_DAY}), 28)) AS this FROM orders)
SELECT o_orderkey, strftime(CASE WHEN this < DATE '{AS_OF}' - 31 THEN this + INTERVAL 1 YEAR ELSE this END, '%Y-%m-%d') AS date FROM d""")
def parse_date_without_year(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    line = F.concat(F.least(F.dayofmonth("day"), F.lit(28)).cast("string"), F.lit(". "), F.date_format("day", "MMMM"), F.lit(" 19:00"))
    return rows.select("o_orderkey", dates.parse_date(line, AS_OF).alias("date"))


@query(f"SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN '{AS_OF}' ELSE strftime({_DAY}, '%Y-%m-%d') END AS date FROM orders", False)
def parse_meetup_date(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    form = lambda f: F.date_format("day", f)
    line = F.when(F.col("kind") == 0, form("MMM d, yyyy")).when(F.col("kind") == 1, form("MMMM d, yyyy")).when(F.col("kind") == 2, form("d MMM yyyy")).when(F.col("kind") < 5, form("yyyy-MM-dd")).otherwise(F.lit("next week"))
    return rows.select("o_orderkey", dates.parse_meetup_date(line, AS_OF).alias("date"))


@query("""SELECT o_orderkey, CASE o_orderkey % 6 WHEN 5 THEN '' ELSE (o_orderkey % 24) || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') END AS time,
  CASE o_orderkey % 6 WHEN 5 THEN '' WHEN 0 THEN '' WHEN 1 THEN (o_orderkey % 24) || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') || ' PM' ELSE (o_orderkey % 24) || ':' || lpad((o_orderkey % 60)::VARCHAR, 2, '0') END AS clock FROM orders""", False)
def parse_time(spark, sf_dir):
    rows = _orders(spark, sf_dir)
    h, m = (F.col("o_orderkey") % 24).cast("string"), F.lpad((F.col("o_orderkey") % 60).cast("string"), 2, "0")
    line = F.when(F.col("kind") == 0, F.concat(F.lit("Beginn "), h, F.lit("."), m, F.lit(" Uhr"))).when(F.col("kind") == 1, F.concat(h, F.lit(":"), m, F.lit(" PM"))).when(F.col("kind") < 5, F.concat(F.lit("at "), h, F.lit(":"), m)).otherwise(F.lit("none"))
    return rows.select("o_orderkey", dates.parse_time(line).alias("time"), dates.parse_clock(line).alias("clock"))


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE array_to_string(list_transform(list_filter(string_split(lower(replace(p_name, ' ', '-')), '-'), lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), ' ') END AS title FROM part""", False)
def title_slug(spark, sf_dir):
    rows = table(spark, sf_dir, "part")
    slug = F.lower(F.replace("p_name", F.lit(" "), F.lit("-")))
    url = F.when(F.col("p_partkey") % 5 == 0, "https://x.example/events/single").otherwise(F.concat(F.lit("https://x.example/events/"), slug, F.lit("-"), F.col("p_partkey").cast("string"), F.lit("/?ref=a-b")))
    return rows.select("p_partkey", titles.title_from_slug(url).alias("title"))


@query(r"""SELECT ordinal, ordinal % 3 = 0 OR ordinal % 5 = 0 OR ordinal % 7 = 3 OR length(title) > 80 AS noisy FROM listings""")
def title_noisy(spark, sf_dir):
    o = F.col("ordinal")
    name = F.when(o % 3 == 0, F.concat("title", F.lit(" 19:30"))).when(o % 5 == 0, F.concat(F.lit("Sponsored "), F.col("title"))).when(o % 7 == 3, F.concat("title", F.lit(" 3. Mai"))).otherwise(F.col("title"))
    return listings(spark, sf_dir).select("ordinal", titles.title_looks_noisy(name).alias("noisy"))


@query("""SELECT page_id, contains(lower(left(html, 2000)), 'access denied') OR contains(lower(left(html, 2000)), 'just a moment') OR contains(lower(left(html, 2000)), 'attention required')
  OR contains(lower(left(html, 2000)), 'cf-browser-verification') OR contains(lower(left(html, 2000)), 'checking your browser') AS challenge FROM pages""", False)
def bot_challenge(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", titles.is_bot_challenge("html").alias("challenge"))


# --- extraction, from pages made of listings -----------------------------------------------------

_PAGE = f"'https://p.example/' || (ordinal // {PER_PAGE})"
_MARKED = "(price > 0 AND ordinal % 10 > 2)"


def _marked(spark, sf_dir) -> DataFrame:
    """Listings with a price in cents, so that its text is exact."""
    return listings(spark, sf_dir).withColumn("cents", F.col("ordinal") % 3000)


@query(f"""+ l AS (SELECT *, {_PAGE} AS page, (ordinal % 3000) / 100.0 AS p FROM listings), t AS (SELECT *, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM l WHERE ordinal % 9 <> 0)
SELECT page AS source_url, title, date, coalesce(lpad(ltrim(time, '0'), 5, '#'), '') AS time, p::DOUBLE AS price, source_url || '/e' AS url FROM t WHERE nth = 1""")
def markdown_lines(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    line = F.when(F.col("ordinal") % 9 == 0, F.lit("nothing to see on this line")).otherwise(F.concat(F.lit("* ["), F.col("title"), F.lit("]("), F.col("source_url"), F.lit("/e) "), F.col("date"), F.coalesce(F.concat(F.lit(" "), F.col("time")), F.lit("")), F.lit(" "), euro(F.col("cents")), F.lit(" €")))
    found = extract.markdown_generic(pages_of(rows, line, "\n", name="markdown"), AS_OF)
    time = F.when(F.col("time") == "", "").otherwise(F.lpad(F.ltrim("time", F.lit("0")), 5, "#"))
    return found.select("source_url", "title", "date", time.alias("time"), "price", "url")


@query(f"""+ l AS (SELECT *, {_PAGE} AS page FROM listings) SELECT page AS source_url, title, date, coalesce(time, '') AS time,
  CASE WHEN ordinal % 4 = 0 THEN NULL ELSE (ordinal % 3000) / 100.0 END::DOUBLE AS price, venue, coalesce(url, page) AS url FROM l WHERE ordinal % 5 <> 0""")
def jsonld_extract(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    amount = F.when(F.col("ordinal") % 4 != 0, F.concat((F.col("cents") / 100).cast("int").cast("string"), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0")))
    kind = F.when(F.col("ordinal") % 5 == 0, "Place").when(F.col("ordinal") % 2 == 0, "MusicEvent").otherwise("Event")
    start = F.concat("date", F.coalesce(F.concat(F.lit("T"), F.col("time"), F.lit(":00+01:00")), F.lit("")))
    node = F.to_json(F.struct(F.array(kind).alias("@type"), F.col("title").alias("name"), start.alias("startDate"), F.array(F.struct(F.col("venue").alias("name"))).alias("location"), F.struct(amount.alias("price")).alias("offers"), "url"))
    pages = pages_of(rows, node, ",", '<html><script type="application/ld+json">{"@graph": [', "]}</script></html>", "html")
    return extract.jsonld(pages, AS_OF).select("source_url", "title", "date", "time", "price", "venue", "url")


@query(f"""+ l AS (SELECT *, {_PAGE} AS page FROM listings), t AS (SELECT *, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM l WHERE ordinal % 9 <> 0)
SELECT page AS source_url, title, date, ((ordinal % 3000) / 100.0)::DOUBLE AS price, 'https://p.example/e/' || ordinal AS url FROM t WHERE nth = 1""")
def heuristic_cards(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    card = F.concat(F.lit('<div class="Event-Card"><h3>'), F.col("title"), F.lit('</h3><p class="card-date">'), F.col("date"), F.lit('</p><a href="/e/'), F.col("ordinal").cast("string"), F.lit('">more</a> '), F.when(F.col("ordinal") % 9 == 0, F.lit("soon")).otherwise(F.concat(euro(F.col("cents")), F.lit(" €"))), F.lit("</div>"))
    card = F.when(F.col("ordinal") % 9 == 0, F.lit('<div class="event">too short</div>')).otherwise(card)
    found = extract.heuristic(pages_of(rows, card, "\n", "<html><body><p>What is on in this town: concerts, talks and everything else, week by week</p>", "</body></html>", "html"), AS_OF)
    return found.select("source_url", "title", "date", "price", "url")


@query(r"""SELECT page_id, regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '<[^>]*>', '', 'g') AS heading, regexp_extract(html, '(?is)<a\s[^>]*href\s*=\s*["'']([^"'']*)["'']', 1) AS href FROM pages""", False)
def page_links(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("html", F.col("page_id").cast("string").alias("source_url"))
    return extract.page_links(rows).select(F.col("source_url").cast("long").alias("page_id"), "heading", "href")


@query("+ t AS (SELECT *, ordinal % 5 + (ordinal // 10) % 3 AS tier FROM listings) SELECT ordinal, source_url, tier::INTEGER AS tier FROM t WHERE tier = (SELECT min(tier) FROM t x WHERE x.source_url = t.source_url)")
def tier_cascade(spark, sf_dir):
    tier = (F.col("ordinal") % 5 + F.floor(F.col("ordinal") / 10) % 3).cast("int")
    return dedup.lowest_tier(listings(spark, sf_dir).withColumn("tier", tier)).select("ordinal", "source_url", "tier")


@query("""SELECT ordinal, coalesce(title, 'Untitled event') AS title, coalesce(url, source_url) AS url, coalesce(category, '') AS category FROM listings""")
def normalized(spark, sf_dir):
    return merge.normalized(listings(spark, sf_dir)).select("ordinal", "title", "url", "category")


@query("SELECT ordinal, title, ((ordinal % 3000) / 100.0)::DOUBLE AS price FROM listings WHERE ordinal % 2 = 0")
def answer_array(spark, sf_dir):
    """Answers of one listing each, fenced, and within prose."""
    from pyspark.sql import types as T

    rows = _marked(spark, sf_dir).where("ordinal % 2 = 0").withColumn("p", (F.col("cents") / 100).cast("double"))
    body = F.to_json(F.array(F.struct("title", F.col("p").alias("price"), F.col("ordinal").alias("id"))))
    answer = F.when(F.col("ordinal") % 4 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(F.concat(F.lit("Here they are: "), body, F.lit(" - done.")))
    schema = T.StructType([T.StructField("title", T.StringType()), T.StructField("price", T.DoubleType()), T.StructField("id", T.LongType())])
    return extract.exploded(rows.select("source_url", answer.alias("answer")), "answer", schema).select(F.col("id").alias("ordinal"), "title", "price")


@query("""SELECT ordinal, CASE WHEN price = 0 THEN 'price-free' WHEN price > 0 THEN 'price-paid' ELSE 'price-unknown' END AS class,
  CASE WHEN price = 0 THEN 'Free' WHEN price > 0 THEN '€' || regexp_replace(price::VARCHAR, '[.]0$', '') ELSE 'Price TBD' END AS display FROM listings""")
def price_cards(spark, sf_dir):
    return listings(spark, sf_dir).select("ordinal", prices.price_class("price").alias("class"), prices.price_display("price").alias("display"))


@query("""SELECT page_id, CASE page_id % 4 WHEN 0 THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || '/e/' || page_id WHEN 1 THEN 'https://other.example/' || page_id
  WHEN 2 THEN regexp_extract(url, '^[a-z]+:') || '//cdn.example/x' ELSE regexp_extract(url, '^[^?#]*') || '?p=' || page_id END AS link FROM pages""", False)
def resolved_links(spark, sf_dir):
    rows = table(spark, sf_dir, "pages")
    n = F.col("page_id").cast("string")
    href = F.when(F.col("page_id") % 4 == 0, F.concat(F.lit("/e/"), n)).when(F.col("page_id") % 4 == 1, F.concat(F.lit("https://other.example/"), n)).when(F.col("page_id") % 4 == 2, "//cdn.example/x").otherwise(F.concat(F.lit("?p="), n))
    return rows.select("page_id", text.absolute_url(href, "url").alias("link"))


@query("SELECT count(*) FILTER (TRY_CAST(date AS DATE) IS NULL) AS bad_dates, count(*) FILTER (price < 0) AS negative_prices, count(*) FILTER (price IS NULL) AS unknown_prices, count(*) FILTER (coalesce(title, '') = '') AS untitled FROM listings")
def quality_metrics(spark, sf_dir):
    return report.quality_metrics(listings(spark, sf_dir))


@query("SELECT title, date, coalesce(time, '') AS time, price, coalesce(category, '') AS category, coalesce(url, 'https://a.example') AS url, 'https://a.example' AS source_url FROM listings")
def agent_listings(spark, sf_dir):
    return merge.agent_listings(listings(spark, sf_dir), "https://a.example").select("title", "date", "time", "price", "category", "url", "source_url")


_CHEAP = f"l AS (SELECT *, {_PAGE} AS page, (ordinal % 3000) / 100.0 AS p FROM listings), t AS (SELECT *, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM l WHERE p <= 15)"


@query(f"+ {_CHEAP} SELECT page AS source_url, title, '{AS_OF}' AS date, coalesce(time, '') AS time, p::DOUBLE AS price, source_url || '/e' AS url FROM t WHERE nth = 1")
def markdown_meetup(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    line = F.concat(F.lit("- ["), F.col("title"), F.lit("]("), F.col("source_url"), F.lit("/e) rsvp"), F.coalesce(F.concat(F.lit(" "), F.col("time")), F.lit("")), F.lit(" for "), euro(F.col("cents")), F.lit(" EUR"))
    return extract.markdown_meetup(pages_of(rows, line, "\n", name="markdown"), AS_OF).select("source_url", "title", "date", "time", "price", "url")


@query(f"+ {_CHEAP} SELECT page AS source_url, title, '{AS_OF}' AS date, '' AS time, p::DOUBLE AS price, 'Berlin' AS venue FROM t WHERE nth = 1")
def markdown_tickets(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    line = F.concat(F.lit("[ "), F.col("title"), F.lit("](https://t.example/x) tickets "), euro(F.col("cents")), F.lit(" €"))
    return extract.markdown_tickets(pages_of(rows, line, "\n", name="markdown"), AS_OF).select("source_url", "title", "date", "time", "price", "venue")


@query(f"+ l AS (SELECT *, {_PAGE} AS page FROM listings WHERE time IS NOT NULL) SELECT page AS source_url, title, time, CASE WHEN ordinal % 4 = 0 THEN 0.0 ELSE (ordinal % 3000) / 100.0 END::DOUBLE AS price, 'music' AS category FROM l")
def markdown_programme(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    price = F.when(F.col("ordinal") % 4 == 0, F.lit("Free admission")).otherwise(F.concat(F.lit("from "), euro(F.col("cents")), F.lit(" €")))
    line = F.concat(F.lit("![Image 3: "), F.col("title"), F.lit("](https://i.example/3) "), F.coalesce("time", F.lit("soon")), F.lit(" "), price)
    return extract.markdown_programme(pages_of(rows, line, "\n", name="markdown"), AS_OF).select("source_url", "title", "time", "price", "category")


_CARDS = f"l AS (SELECT *, {_PAGE} AS page, (ordinal % 3000) / 100.0 AS p FROM listings)"


@query(f"""+ {_CARDS} SELECT page AS source_url, title, date, '' AS time, CASE WHEN ordinal % 6 = 0 THEN 0.0 ELSE p END::DOUBLE AS price, venue, 'https://meetup.com/e/' || ordinal AS url
FROM l WHERE ordinal % 6 = 0 OR p <= 15""")
def meetup_cards(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    amount = F.concat((F.col("cents") / 100).cast("int").cast("string"), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    price = F.when(F.col("ordinal") % 6 == 0, F.lit("")).otherwise(F.concat(F.lit('<b class="price">€'), amount, F.lit("</b>")))
    card = F.concat(F.lit('<div class="event-card"><h3>'), F.col("title"), F.lit("</h3><time>"), F.col("date"), F.lit('</time><i class="venue">'), F.col("venue"), F.lit("</i>"), price, F.lit('<a href="/e/'), F.col("ordinal").cast("string"), F.lit('">go</a></div>'))
    found = extract.meetup_cards(pages_of(rows, card, "\n", "<html><body>", "</body></html>", "html"), AS_OF)
    return found.select("source_url", "title", "date", "time", "price", "venue", "url")


@query(f"""+ {_CARDS} SELECT page AS source_url, title, CASE WHEN ordinal % 6 = 0 THEN 0.0 ELSE p END::DOUBLE AS price, 'Event at Berlin on ' || date AS description, 'https://www.eventbrite.de/e/' || ordinal AS url
FROM l WHERE ordinal % 6 = 0 OR p <= 15""")
def ticket_cards(spark, sf_dir):
    rows = _marked(spark, sf_dir)
    price = F.when(F.col("ordinal") % 6 == 0, F.lit("")).otherwise(F.concat(F.lit('<p class="price-tag">ab '), euro(F.col("cents")), F.lit("</p>")))
    card = F.concat(F.lit("<article><h2>"), F.col("title"), F.lit('</h2><span class="date">'), F.col("date"), F.lit("</span>"), price, F.lit('<a href="/e/'), F.col("ordinal").cast("string"), F.lit('">go</a></article>'))
    found = extract.ticket_cards(pages_of(rows, card, "\n", "<html><body>", "</body></html>", "html"), AS_OF)
    return found.select("source_url", "title", "price", "description", "url")


@query(f"""+ {_CARDS}, a AS (SELECT DISTINCT page, (ordinal // {PER_PAGE}) % 3 AS kind FROM l)
SELECT page AS source_url, title, CASE kind WHEN 0 THEN 0 ELSE 4 END AS tier, p::DOUBLE AS price FROM (SELECT l.*, kind, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM l JOIN a USING (page)) WHERE kind = 0 OR nth = 1""")
def extraction_cascade(spark, sf_dir):
    """Pages of three kinds: with structured data, behind a bot check, and with markdown alone."""
    rows = _marked(spark, sf_dir)
    amount = F.concat((F.col("cents") / 100).cast("int").cast("string"), F.lit("."), F.lpad((F.col("cents") % 100).cast("string"), 2, "0"))
    node = F.to_json(F.struct(F.lit("Event").alias("@type"), F.col("title").alias("name"), F.struct(amount.alias("price")).alias("offers")))
    line = F.concat(F.lit("["), F.col("title"), F.lit("](https://m.example/x) "), euro(F.col("cents")), F.lit(" €"))
    html = pages_of(rows, node, ",", '<html><script type="application/ld+json">[', "]</script></html>", "html")
    pages = html.join(pages_of(rows, line, "\n", name="markdown"), "source_url").withColumn("kind", F.regexp_extract("source_url", r"(\d+)$", 1).cast("long") % 3)
    plain = F.when(F.col("kind") == 0, F.col("html")).when(F.col("kind") == 1, F.concat(F.lit("<title>Just a moment...</title>"), F.col("html")))
    pages = pages.select("source_url", plain.alias("html"), F.lit(None).cast("string").alias("rendered"), "markdown")
    return extract.cascade(pages, AS_OF).select("source_url", "title", F.col("tier"), "price")


# --- envelopes, counts and pages that the flows meet more seldom ---------------------------------


def _envelopes(spark, sf_dir) -> DataFrame:
    """An envelope for each of 15 sites, three of them without listings; the first listing is that of the smallest ordinal."""
    first = F.min_by(F.struct("title", "price"), "ordinal")
    rows = listings(spark, sf_dir).groupBy("source_url").agg(F.count("*").alias("event_count"), F.array(first).alias("events"))
    return _sources(spark).join(rows, "source_url", "left").withColumn("source", F.col("source_url"))


@query("""+ s AS (SELECT 'https://s' || range || '.example' AS source FROM range(15)), f AS (SELECT source_url, count(*) AS n, arg_min(ordinal, ordinal) AS o FROM listings GROUP BY 1)
SELECT s.source, coalesce(n, 0) > 0 AS succeeded, coalesce(n > 0 AND l.price IS NULL, FALSE) AS warns FROM s LEFT JOIN f ON f.source_url = s.source LEFT JOIN listings l ON l.ordinal = f.o""")
def run_succeeded(spark, sf_dir):
    found = filters.run_succeeded(_envelopes(spark, sf_dir))
    return found.select("source", "succeeded", F.coalesce("warns", F.lit(False)).alias("warns"))


@query("+ s AS (SELECT 'https://s' || range || '.example' AS source FROM range(15)) SELECT source FROM s WHERE source NOT IN (SELECT source_url FROM listings)")
def failed_envelopes(spark, sf_dir):
    return filters.failed_sources(_envelopes(spark, sf_dir)).select("source")


@query("SELECT source_url AS site, left(string_agg(title, ' ' ORDER BY ordinal), 12000) AS html FROM listings GROUP BY 1 UNION ALL SELECT 'https://s' || range || '.example', NULL FROM range(12, 15)")
def envelopes_with_html(spark, sf_dir):
    titles_ = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "title"))), lambda x: x["title"]), " ")
    pages = listings(spark, sf_dir).groupBy(F.col("source_url").alias("site")).agg(titles_.alias("body"))
    return merge.with_source_html(_sources(spark).select(F.col("source_url").alias("site")), pages).select("site", "html")


@query(f"""SELECT title, date, time, price, category, description, source_url FROM listings WHERE source_url = 'https://s3.example'
  AND date >= strftime(DATE '{AS_OF}' - 7, '%Y-%m-%d') AND date <= strftime(DATE '{AS_OF}' + 14, '%Y-%m-%d')""")
def store_of_source(spark, sf_dir):
    return readers.stored_of_source(listings(spark, sf_dir), "https://s3.example", AS_OF)


@query("SELECT ordinal, date || CASE WHEN time IS NULL THEN '' ELSE ' ' || time END AS shown, replace(lower(title), ' ', '_') AS slug, ordinal AS _id FROM listings")
def display_date(spark, sf_dir):
    return readers.with_id(listings(spark, sf_dir)).select("ordinal", dates.date_time("date", "time").alias("shown"), text.file_slug("title").alias("slug"), "_id")


@query("""SELECT source_url, count(*) FILTER (ordinal % 3 <> 0) AS scraped_count, count(*) FILTER (ordinal % 3 = 0 AND price > 15) AS missed_count, count(*) FILTER (ordinal % 3 = 0 AND price > 15) > 0 AS improvements_needed FROM listings GROUP BY 1""")
def missed_counts(spark, sf_dir):
    rows = listings(spark, sf_dir)
    return report.missed_counts(rows.where("ordinal % 3 <> 0"), rows.where("ordinal % 3 = 0 and price > 15"))


@query("SELECT coalesce(title, '') AS pattern_name, coalesce(description, '') AS description, '' AS html_structure, 'not found by the scraper' AS why_missed, coalesce(url, '') AS example FROM listings WHERE price > 15")
def missed_patterns(spark, sf_dir):
    return sinks.missed_patterns(listings(spark, sf_dir).where("price > 15"))


@query("+ l AS (SELECT DISTINCT source_url, min(url) OVER (PARTITION BY source_url) AS path FROM listings) SELECT source_url, path FROM l WHERE path = (SELECT min(path) FROM l)")
def first_page(spark, sf_dir):
    return readers.first_page(listings(spark, sf_dir).groupBy("source_url").agg(F.min("url").alias("path")))


@query("SELECT doc_id, length(text) >= 15 AS long_enough, length(text) BETWEEN 15 AND 3000 AS fits FROM documents", False)
def text_lengths(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", filters.length_between("text", 15).alias("long_enough"), filters.length_between("text", 15, 3000).alias("fits"))


#: Listings to a page that is longer than every cap, and the deepest structured data.
LONG_PAGE, DEEP = 100, 20
_LONG = f"l AS (SELECT *, 'https://p.example/' || (ordinal // {LONG_PAGE}) AS page, (ordinal % 1500) / 100.0 AS p FROM listings)"


def _capped(cap: int) -> str:
    """The first of each title of a page, at most ``cap``."""
    return f"t AS (SELECT *, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM l), u AS (SELECT *, row_number() OVER (PARTITION BY page ORDER BY ordinal) AS k FROM t WHERE nth = 1), c AS (SELECT * FROM u WHERE k <= {cap})"


def _long_lines(spark, sf_dir) -> DataFrame:
    rows = listings(spark, sf_dir).withColumn("cents", F.col("ordinal") % 1500)
    line = F.concat(F.lit("- ["), F.col("title"), F.lit("](https://t.example/x) tickets, rsvp "), euro(F.col("cents")), F.lit(" €"))
    return pages_of(rows, line, "\n", name="markdown", size=LONG_PAGE)


@query(f"+ {_LONG}, {_capped(extract.GENERIC_CAP)} SELECT page AS source_url, title FROM c")
def long_page_generic(spark, sf_dir):
    return extract.markdown_generic(_long_lines(spark, sf_dir), AS_OF).select("source_url", "title")


@query(f"+ {_LONG}, {_capped(extract.MEETUP_CAP)} SELECT page AS source_url, title FROM c")
def long_page_meetup(spark, sf_dir):
    return extract.markdown_meetup(_long_lines(spark, sf_dir), AS_OF).select("source_url", "title")


@query(f"+ {_LONG}, {_capped(extract.TICKET_CAP)} SELECT page AS source_url, title FROM c")
def long_page_tickets(spark, sf_dir):
    return extract.markdown_tickets(_long_lines(spark, sf_dir), AS_OF).select("source_url", "title")


@query(f"+ l AS (SELECT *, {_PAGE} AS page FROM listings) SELECT page AS source_url, title FROM l")
def jsonld_deep(spark, sf_dir):
    """Lists and graphs that lie in one another 20 deep."""
    node = F.to_json(F.struct(F.lit("Event").alias("@type"), F.col("title").alias("name")))
    head, foot = ("[" * 10 + '{"@graph":[' * 10), ("]}" * 10 + "]" * 10)
    pages = pages_of(listings(spark, sf_dir), node, ",", f'<script type="application/ld+json">{head}', f"{foot}</script>", "html")
    return extract.jsonld(pages, AS_OF).select("source_url", "title")


@query("""SELECT page_id, 'https://h.example/' || CASE WHEN page_id % 12 >= 9 THEN '' ELSE array_to_string(list_transform(range(8 - page_id % 12), lambda i: 'f' || i), '/') || CASE WHEN page_id % 12 = 8 THEN '' ELSE '/' END END || 'x/y?z=../a' AS link FROM pages""", False)
def links_up(spark, sf_dir):
    """As many steps up as the id says, from a page eight folders deep."""
    rows = table(spark, sf_dir, "pages")
    base = F.lit("https://h.example/" + "".join(f"f{i}/" for i in range(8)) + "page?q=1")
    href = F.concat(F.repeat(F.lit("../"), (F.col("page_id") % 12).cast("int")), F.lit("x/./w/../y?z=../a"))
    return rows.select("page_id", text.absolute_url(href, base).alias("link"))


@query(f"""+ l AS (SELECT *, {_PAGE} AS page, (ordinal % 3000) / 100.0 AS p FROM listings), n AS (SELECT *, title || ' ' || ordinal AS name FROM l)
SELECT page AS source_url, CASE WHEN ordinal % 3 = 0 THEN 'Big Show' ELSE name END AS title, '2024-03-05' AS date, p::DOUBLE AS price, 'https://p.example/e/' || CASE WHEN ordinal % 3 = 0 THEN 'big-show-' ELSE '' END || ordinal AS url
FROM (SELECT *, row_number() OVER (PARTITION BY page, CASE WHEN ordinal % 3 = 0 THEN 'Big Show' ELSE name END ORDER BY ordinal) AS nth FROM n) WHERE nth = 1""")
def nested_cards(spark, sf_dir):
    """Cards within cards, of which the outer ones count; titles with a badge, whose link names them; dates that stand above the card."""
    rows = _marked(spark, sf_dir)
    o = F.col("ordinal")
    noisy = o % 3 == 0
    name = F.concat("title", F.lit(" "), o.cast("string"))
    heading = F.when(noisy, F.concat(F.lit("Sponsored "), name)).otherwise(name)
    link = F.when(noisy, F.concat(F.lit("/e/big-show-"), o.cast("string"))).otherwise(F.concat(F.lit("/e/"), o.cast("string")))
    card = F.concat(F.lit('<div class="event"><div class="event-card"><h3>'), heading, F.lit('</h3><a href="'), link, F.lit('">more</a> <b class="teaser">nothing but inner text for '), euro(F.col("cents")), F.lit(" €</b></div></div>"))
    found = extract.heuristic(pages_of(rows, card, "\n", "<html><body><h1>am 2024-03-05</h1><div>", "</div></body></html>", "html"), AS_OF)
    return found.select("source_url", "title", "date", "price", "url")


@query(f"""+ {_CARDS}, a AS (SELECT *, (ordinal // {PER_PAGE}) % 3 AS kind FROM l), t AS (SELECT *, row_number() OVER (PARTITION BY page, lower(title) ORDER BY ordinal) AS nth FROM a)
SELECT page AS source_url, title, CASE kind WHEN 0 THEN 2 WHEN 1 THEN 3 ELSE 5 END AS tier FROM t WHERE kind IN (0, 2) OR nth = 1""")
def rendered_cascade(spark, sf_dir):
    """Pages of three kinds whose listings show only when rendered, as structured data or as cards, or that a strategy of one's own reads."""
    rows = _marked(spark, sf_dir)
    node = F.to_json(F.struct(F.lit("Event").alias("@type"), F.col("title").alias("name")))
    card = F.concat(F.lit('<div class="event"><h3>'), F.col("title"), F.lit("</h3> on 2024-02-02 for "), euro(F.col("cents")), F.lit(" €</div>"))
    data = pages_of(rows, node, ",", '<script type="application/ld+json">[', "]</script>", "data")
    pages = data.join(pages_of(rows, card, "\n", name="cards"), "source_url").withColumn("kind", F.regexp_extract("source_url", r"(\d+)$", 1).cast("long") % 3)
    none = F.lit(None).cast("string")
    pages = pages.select("source_url", F.lit("<p>loading</p>").alias("html"), F.when(F.col("kind") == 0, F.col("data")).when(F.col("kind") == 1, F.col("cards")).alias("rendered"), none.alias("markdown"), F.when(F.col("kind") == 2, F.col("data")).alias("feed"))
    own = extract.EXTRACTORS | {"feed": (extract.jsonld, "feed", 5)}
    return extract.cascade(pages, AS_OF, own).select("source_url", "title", "tier")
