from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from handbill.operators import extract
from handbill.operators.storage import shared_dir
from handbill.sources import readers, sinks


def test_configuration_in_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    (tmp_path / "c.yaml").write_text("categories:\n  music:\n    keywords:\n      - band\n      - DJ\n    priority: 1\n  empty:\nurls:\n  - name: A\n    url: https://a.example\n    script: a.py\n")
    config = readers.read_config(spark, str(tmp_path / "c.yaml"))
    assert readers.categories_of(config) == {"music": ["band", "DJ"], "empty": []}
    assert [tuple(r) for r in readers.dictionary(spark, readers.categories_of(config)).collect()] == [("configured", 0, "music", "band"), ("configured", 0, "music", "DJ")]
    assert [tuple(r) for r in readers.source_config(spark, config).collect()] == [(0, "A", "https://a.example", "a.py", [])]


def test_a_strategy_of_ones_own(spark, monkeypatch):
    def titles(pages, as_of, body):
        rows = pages.select("source_url", F.col(body).alias("title"))
        return extract.jsonld(pages.limit(0), as_of, body).unionByName(rows.withColumn("ordinal", F.lit(0).cast("long")), allowMissingColumns=True)

    monkeypatch.setattr(extract, "EXTRACTORS", dict(extract.EXTRACTORS))
    extract.register("titles", titles, "html", -1)
    pages = spark.createDataFrame([("u", "x", None, None)], "source_url string, html string, rendered string, markdown string")
    assert [(r.title, r.tier) for r in extract.cascade(pages, "2024-01-15").collect()] == [("x", -1)]


def test_cards_in_cards_are_read_once(spark):
    page = "<div class=event>" * 3000 + "Concert on 2024-01-20 for 5 €" + "</div>" * 3000
    got = extract.heuristic(spark.createDataFrame([("u", page)], "source_url string, html string"), "2024-01-15").collect()
    assert [(r.date, r.price, r.ordinal) for r in got] == [("2024-01-20", 5.0, 0)]


def test_store_lines_and_patch(spark, tmp_path):
    rows = spark.createDataFrame([(0, "t", "2024-01-02", None, 1.5, "c", "d", "u", "v", "s")], "ordinal long, title string, date string, time string, price double, category string, description string, url string, venue string, source_url string")
    sinks.write_lines(rows, str(tmp_path / "lines"))
    assert [r.title for r in spark.read.json(str(tmp_path / "lines")).collect()] == ["t"]
    assert sinks.improvement_patch([{"pattern_name": 'a "b"', "description": "c\\d"}], ["r"]) == 'missed_patterns:\n  - pattern_name: "a \\"b\\""\n    description: "c\\\\d"\nrecommendations:\n  - "r"\n'
    sinks.create_store(spark, "made_store")
    assert spark.table("made_store").count() == 0
    spark.sql("DROP TABLE made_store")


def test_shared_folder_is_the_sessions(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")
