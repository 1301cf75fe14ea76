from __future__ import annotations

import json

from handbill.operators import merge
from handbill.plans import flows
from handbill.sources import http, readers, sinks
from handbill.streaming import ingest
from test_operators import make


def write(folder, name, content):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content), encoding="utf-8")


def doc(*events):
    return {"source": "s", "scraped_at": "now", "event_count": len(events), "events": [{"date": "2024-01-15", "time": "19:00", "source_url": "https://s"} | e for e in events]}


def test_folder_of_documents(spark, tmp_path):
    write(tmp_path, "raw_b.json", doc({"title": "B", "price": "abc"}))
    write(tmp_path, "raw_a.json", doc({"title": "A", "price": 5}, {"title": "A2", "price": "7.5"}))
    write(tmp_path, "raw_c.json", doc())
    write(tmp_path, "raw_d.json", "{broken")
    rows = readers.envelopes(spark, str(tmp_path))
    assert readers.corrupt(rows.cache()).count() == 1
    got = readers.read_listings(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r.site, r.title, r.price) for r in got] == [("a", "A", 5.0), ("a", "A2", 7.5), ("b", "B", None)]
    write(tmp_path / "html", "c.html", "<p>" + "x" * 20000)
    failed = readers.failed_with_pages(rows, readers.read_pages(spark, str(tmp_path / "html"))).collect()
    assert [(r.site, len(r.html)) for r in failed] == [("c", 12000)]


def test_documents_round_trip(spark, tmp_path):
    df = make(spark, {"title": "A"}, {"title": "B", "price": None})
    path = str(tmp_path / "out")
    sinks.write_document(sinks.scrape_document(df, "s", "now"), path)
    got = readers.read_document(spark, path).orderBy("ordinal").collect()
    assert [(r.title, r.price) for r in got] == [("A", 5.0), ("B", None)]
    write(tmp_path, "list.json", [{"title": "L"}])
    assert readers.published(spark, str(tmp_path / "list.json")).first().title == "L"
    assert readers.published(spark, str(tmp_path / "none.json")).count() == 0
    ranked = flows.publication(df)
    body = json.loads(sinks.scored_document(ranked).first().value)
    assert body["count"] == 2 and body["events"][0]["score"] == 25
    merged = json.loads(sinks.merged_document(merge.merge_recovered(df, make(spark, {"title": "C"})), 1).first().value)
    assert [e["title"] for e in merged["events"]] == ["A", "B", "C"] and merged["recovered_count"] == 1
    assert json.loads(sinks.published_document(df, "now").first().value)["category_distribution"] == {"": 2}


def test_config(spark):
    assert readers.key_values("# c\nA=b=c\n\nnope\n D = e ") == {"A": "b=c", "D": "e"}
    config = {"urls": [{"name": "n", "url": "u", "script": "x", "categories": ["a"]}, {"url": "u", "script": "y"}], "categories": {"m": {"keywords": ["k", "l"]}}}
    assert readers.dictionary(spark, readers.categories_of(config)).count() == 2
    assert merge.script_of(spark.createDataFrame([("u",)], "url string"), readers.source_config(spark, config)).first().script == "x"


def test_page_source(spark):
    class Fake(http.PageSource):
        get = staticmethod(lambda url: None if "bad" in url else f"<p>{url}</p>")

    spark.dataSource.register(Fake)
    rows = spark.read.format("pages_http").option("urls", "https://a\nhttps://bad").load().collect()
    assert sorted((r.source_url, r.html) for r in rows) == [("https://a", "<p>https://a</p>"), ("https://bad", None)]


def test_stream_into_the_store(spark, tmp_path):
    raw, store, check = tmp_path / "raw", str(tmp_path / "store"), str(tmp_path / "check")
    write(raw, "raw_a.json", doc({"title": "A", "price": 5}, {"title": "A", "price": 6}, {"title": "Dear", "price": 99}))
    ingest.ingest(spark, str(raw), store, check).awaitTermination()
    write(raw, "raw_b.json", doc({"title": "A", "price": 7}, {"title": "Live band", "price": 1, "time": None}))
    ingest.ingest(spark, str(raw), store, check).awaitTermination()
    got = sorted((r.title, r.price, r.is_recursive, r.category) for r in readers.read_store(spark, store).collect())
    assert got == [("A", 7.0, True, "unknown"), ("Live band", 1.0, False, "music")]
    assert readers.for_publication(readers.read_store(spark, store), "2024-01-15").count() == 2


def test_validation(spark):
    store = make(spark, {"title": "A"}).drop("url", "venue", "ordinal")
    agent = make(spark, {"title": "a"}, {"title": "New"})
    results = spark.createDataFrame([(True, 1, 2, 1, 0)], "success boolean, phase1_events long, agent_events long, missed_events long, sub_urls long")
    missed, after, totals = flows.validation(agent, store, results)
    assert [r.title for r in missed.collect()] == ["New"] and after.count() == 2 and totals.first().successful == 1
