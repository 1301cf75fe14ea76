from __future__ import annotations

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from handbill.operators import browse, categories, dedup, dom, extract, filters, merge, report, scoring
from handbill.schema import LISTING_FIELDS

FIELDS = "ordinal long, title string, date string, time string, price double, category string, description string, url string, venue string, source_url string"


def make(spark, *rows):
    base = {"title": "T", "date": "2024-01-15", "time": "19:00", "price": 5.0, "category": "", "description": "", "url": None, "venue": "", "source_url": "https://s"}
    names = [f.split()[0] for f in FIELDS.split(", ")]
    full = [{"ordinal": i} | base | r for i, r in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], FIELDS)


def test_dear_first_occurrence_does_not_hide_a_cheap_one(spark):
    df = make(spark, {"title": " Jam ", "price": 20.0}, {"title": "JAM", "price": 5.0}, {"title": "jam", "price": 1.0})
    assert [r.ordinal for r in scoring.score_and_rank(df).collect()] == [1]


def test_keywords_start_words(spark):
    df = make(spark, {"title": "Startup"}, {"title": "Tanzabend"}, {"title": "BÜHNE frei"}, {"title": "ätanz"})
    got = scoring.scored(df).orderBy("ordinal").collect()
    assert [r.matched_categories for r in got] == [["entrepreneurial events"], ["dancing"], ["theater"], []]
    assert [r.category for r in got][3] == "general"


def test_score_is_clamped(spark):
    df = make(spark, {"title": "Tanz Konzert Workshop Museum", "price": 0.0, "venue": "Schloss Charlottenburg"})
    r = scoring.scored(df).first()
    assert r.score == 100 and r.matched_categories[-1] == categories.NEAR_LABEL


def test_ranks_ties_by_ordinal(spark):
    df = scoring.scored(make(spark, *({"title": "x", "date": str(i)} for i in range(20))))
    ranks = scoring.numbered(df, scoring.rank_order()).orderBy("rank").collect()
    assert [r.ordinal for r in ranks] == list(range(20)) and [r["rank"] for r in ranks] == list(range(1, 21))


def test_store_rules(spark):
    store = make(spark, {"title": "A", "price": 1.0}, {"title": "B", "time": None, "price": 2.0}).drop("ordinal").withColumn("ordinal", F.lit(-1).cast("long"))
    batch = make(spark, {"title": "A", "price": 9.0}, {"title": "A", "price": 8.0}, {"title": "B", "time": None, "price": 7.0}, {"title": None}, {"title": "C", "date": None})
    up = sorted((r.title, r.price) for r in merge.upsert_replace(store, batch).collect())
    assert up == [("A", 8.0), ("B", 2.0), ("B", 7.0)]
    ignored = sorted((r.title, r.price) for r in merge.insert_ignore(store, batch).collect())
    assert ignored == [("A", 1.0), ("B", 2.0), ("B", 7.0)]
    assert merge.rejected(batch).count() == 2


def test_missed_and_merge(spark):
    a = make(spark, {"title": "One"}, {"title": "Two"}, {"title": "TWO"})
    assert [r.title for r in merge.missed(a, make(spark, {"title": "oNE"})).orderBy("ordinal").collect()] == ["Two", "TWO"]
    merged = merge.merge_recovered(make(spark, {"title": "One"}, {"title": "One"}), a)
    assert merged.count() == 3 and merged.where("recovered").first().title == "Two"


def test_recursive_counts_the_same_batch(spark):
    df = make(spark, {"title": "A"}, {"title": "A"}, {"title": "B"})
    got = dedup.is_recursive(df, make(spark, {"title": "B"})).orderBy("ordinal").collect()
    assert [r.is_recursive for r in got] == [False, True, True]


def test_site_filters_and_stats(spark):
    df = make(spark, {"price": 0.0}, {"price": None, "date": "2024-02-01"}, {"price": 3.0, "date": "nope"})
    assert [df.where(filters.site_filter(n, "2024-01-15")).count() for n in ("free", "paid", "weekend", "today", "all")] == [1, 2, 1, 1, 3]
    assert tuple(report.site_stats(df, "2024-01-15").first()) == (3, 1, 2, 1)


def test_calendar(spark):
    df = make(spark, {"title": "A, B; C\\D", "time": "7.30", "url": "https://u", "description": "x\ny"}, {"date": "soon"}, {"time": ""})
    text = browse.calendar(df, F.col("ordinal"))
    assert text.count("BEGIN:VEVENT") == 2 and "DTSTART:20240115T073000" in text and "DTSTART;VALUE=DATE:20240115" in text
    assert "SUMMARY:A\\, B\\; C\\\\D" in text and "DESCRIPTION:x\\ny\\nhttps://u" in text and text.endswith("END:VCALENDAR")


def test_reports(spark):
    df = make(spark, {"price": None}, {"price": 0.0}, {"price": 20.0})
    text = report.weekly_report(df, "2024-01-01", "now")
    assert "- **Total Events Saved:** 2" in text and "- Free: 1" in text and "- 0-5€: 1" in text
    results = spark.createDataFrame([("s", "u", True, None, 3, 4, 1, 0, ["m"]), ("t", "v", False, "down", 0, 0, 0, 0, None)], "site string, url string, success boolean, error string, phase1_events long, agent_events long, missed_events long, sub_urls long, missed_titles array<string>")
    assert "- **Error:** down" in report.validation_report(results, 3, "now") and "Rest day" in report.validation_report(results.limit(0), 3, "now")


def page(spark, body, name="html"):
    return spark.createDataFrame([("https://p.example/list", body)], f"source_url string, {name} string")


def test_jsonld_shapes(spark):
    nodes = [
        {"@type": "Event", "name": "A", "startDate": "2024-05-06T19:30:00", "location": {"name": "V"}, "offers": {"price": "12.5"}},
        {"@graph": [{"@type": ["Thing", "MusicEvent"], "location": [{"name": "W"}], "offers": [{"price": 3}]}, {"@type": "Place", "name": "no"}]},
        {"@type": "DanceEvent", "name": "C", "location": "X", "offers": {"price": "n/a"}},
    ]
    html = f'<script type="application/ld+json">{json.dumps(nodes)}</script><script type="application/ld+json">broken</script>'
    got = extract.jsonld(page(spark, html), "2024-01-15").orderBy("ordinal").collect()
    assert [(r.title, r.date, r.time, r.price, r.venue) for r in got] == [("A", "2024-05-06", "19:30", 12.5, "V"), ("Untitled event", "2024-01-15", "", 3.0, "W"), ("C", "2024-01-15", "", None, "X")]
    assert list(got[0].asDict())[:9] == list(LISTING_FIELDS)


def test_jsonld_at_any_depth(spark):
    deep = {"@type": "Event", "name": 'deep ]"['}
    for k in range(12):
        deep = [deep] if k % 2 else {"@graph": [deep, {"@type": "Event", "name": f"g{k}"}]}
    html = f'<script type="application/ld+json">{json.dumps(deep)}</script><script type="application/ld+json">{{"@type": "Event", "name": "flat"}}</script>'
    got = extract.jsonld(page(spark, html), "2024-01-15").orderBy("ordinal").collect()
    assert [r.title for r in got] == ['deep ]"[', "g0", "g2", "g4", "g6", "g8", "g10", "flat"]


def test_heuristic_keeps_the_outermost(spark):
    html = '<div class="event-list-x"><div class="views-row"><h2>Night of songs</h2><span class="event-price">12,50 €</span><a href="/e/1">go</a></div></div>'
    got = extract.heuristic(page(spark, html), "2024-01-15").collect()
    assert [(r.title, r.price, r.url) for r in got] == [("Night of songs", 12.5, "https://p.example/e/1")]


def test_heuristic_prefers_slugs_to_noise(spark):
    html = '<li class="teaser"><a href="/events/big-show-7">Big Show 19:30 today, Eintritt frei</a></li>'
    r = extract.heuristic(page(spark, html), "2024-01-15").first()
    assert (r.title, r.price, r.time) == ("Big Show", 0.0, "19:30")


def test_cards(spark):
    html = '<div data-testid="event-card"><h3>A</h3><time>Jan 20, 2024</time><span class="price">€5</span><a href="/x">l</a></div><div data-testid="event-card"><span class="cost">€50</span></div>'
    got = extract.meetup_cards(page(spark, html), "2024-01-15").collect()
    assert [(r.title, r.date, r.price, r.url, r.venue) for r in got] == [("A", "2024-01-20", 5.0, "https://meetup.com/x", "Online")]
    got = extract.ticket_cards(page(spark, "<article><h2>B</h2><p class='price'>ab 7,50</p></article>"), "2024-01-15").collect()
    assert [(r.title, r.price, r.description) for r in got] == [("B", 7.5, "Event at Berlin on ")]


def test_markdown(spark):
    body = "short\n[Concert tonight](https://a.example/1) 2024-02-03 20:00 12 €\n[Concert Tonight](https://a.example/2) 5 €\n## Talk on things, gratis\nno signal here at all\n"
    got = extract.markdown_generic(page(spark, body, "markdown"), "2024-01-15").orderBy("ordinal").collect()
    assert [(r.title, r.price, r.date) for r in got] == [("Concert tonight", 12.0, "2024-02-03"), ("Talk on things, gratis", 0.0, "2024-01-15")]
    line = "x ![Image 3: Art Show](https://i) 19:00 from 12,50 € more"
    r = extract.markdown_programme(page(spark, line, "markdown"), "2024-01-15").first()
    assert (r.title, r.time, r.price, r.venue) == ("Art Show", "19:00", 12.5, "Various")
    body = "[Dear thing](https://a/1) rsvp 20 €\n[Dear thing](https://a/2) rsvp 5 €"
    assert [r.url for r in extract.markdown_meetup(page(spark, body, "markdown"), "2024-01-15").collect()] == ["https://a/2"]
    assert [r.price for r in extract.markdown_tickets(page(spark, "Great tickets here", "markdown"), "2024-01-15").collect()] == [0.0]


def test_cascade(spark):
    rows = [("a", '<script type="application/ld+json">{"@type":"Event","name":"J"}</script>', None, "[Some thing](https://x) 5 €"), ("b", "<title>Just a moment</title><p class=event>Show tonight 5 € here</p>", None, "[Only this](https://x) 5 €"), ("c", None, None, None)]
    pages = spark.createDataFrame(rows, "source_url string, html string, rendered string, markdown string")
    got = extract.cascade(pages, "2024-01-15").orderBy("source_url").collect()
    assert [(r.source_url, r.title, r.tier) for r in got] == [("a", "J", 0), ("b", "Only this", 4)]


def test_answers(spark):
    schema = T.StructType([T.StructField("title", T.StringType())])
    rows = [('[{"title":"a"}]', ["a"]), ('```json\n{"events":[{"title":"b"}]}\n```', ["b"]), ('see: [{"title":"c"}] ok', ["c"]), ("nothing", None)]
    df = spark.createDataFrame([(i, x) for i, (x, _) in enumerate(rows)], "i int, x string").select("i", extract.json_array("x", schema).alias("a")).orderBy("i")
    assert [r.a and [e.title for e in r.a] for r in df.collect()] == [w for _, w in rows]
    df = spark.createDataFrame([('x {"a": {"b": 1}} y }',), ('{bad ```json\n{"c": 2}\n```',), (None,), ("none",)], "x string")
    assert [r[0] for r in df.select(extract.json_object("x")).collect()] == ['{"a": {"b": 1}}', '{"c": 2}', None, None]


def test_selectors():
    root = dom.read('<ul><li class="a b" data-x="one two">t</li><li>u</ul><p>x<br>y</p>')
    assert [x.text() for x in dom.select(root, "li")] == ["t", "u"]
    assert len(list(dom.select(root, "li.b"))) == 1 and len(list(dom.select(root, '[data-x*="two"], p'))) == 2 and not list(dom.select(root, "ul li"))


def test_empty_tables(spark):
    empty = make(spark)
    assert scoring.score_and_rank(empty).count() == 0 and report.run_totals(empty).first().processed == 0
    assert scoring.numbered(scoring.scored(empty), scoring.rank_order()).count() == 0
    assert report.category_distribution(empty).first().category_distribution == {}
