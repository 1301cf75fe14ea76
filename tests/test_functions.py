from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from handbill.functions import dates, prices, text, titles


def one(spark, f, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"{n} {'double' if isinstance(v, float) else 'string'}" for n, v in zip(names, values, strict=True)))
    return df.select(f(*map(F.col, names)).alias("r")).first().r


@pytest.mark.parametrize(("line", "want"), [("Eintritt frei, sonst 12 €", 0.0), ("12,50 €", 12.5), ("€ 8", 8.0), ("9 EUR", 9.0), ("tba", None), ("1.234,50 €", 234.5), ("Gratis!", 0.0), ("freed 5 €", 5.0)])
def test_parse_price(spark, line, want):
    assert one(spark, prices.parse_price, line) == want


@pytest.mark.parametrize(("line", "want"), [("tba", 0.0), ("7,5 €", 7.5), ("FREE or 3 €", 0.0)])
def test_parse_ticket_price(spark, line, want):
    assert one(spark, prices.parse_ticket_price, line) == want


@pytest.mark.parametrize(("line", "want"), [
    ("12.7.26", "2026-07-12"), ("12.07.2026", "2026-07-12"), ("32.13.2024", "2024-13-32"), ("16. July 19:00", "2026-07-16"), ("12 Oct 2026", "2026-07-01"), ("July 4", "2026-07-01"),
    ("3. Mai", "2027-05-03"), ("on 2026-01-02", "2026-01-02"), ("5. März 2027", "2027-03-05"), ("31. April 2026", "2026-07-01"), ("", "2026-07-01"),
])
def test_parse_date(spark, line, want):
    assert one(spark, lambda c: dates.parse_date(c, "2026-07-01"), line) == want


@pytest.mark.parametrize(("line", "want"), [("Jan 15, 2024", "2024-01-15"), ("January 15, 2024", "2024-01-15"), ("15 Jan 2024", "2024-01-15"), ("2024-01-15", "2024-01-15"), ("Jan 15", "2026-07-01")])
def test_parse_meetup_date(spark, line, want):
    assert one(spark, lambda c: dates.parse_meetup_date(c, "2026-07-01"), line) == want


@pytest.mark.parametrize(("line", "want"), [("Beginn 19.30 Uhr", "19:30"), ("none", ""), ("12.07.2026 19.30 Uhr", "12:07")])
def test_parse_time(spark, line, want):
    assert one(spark, dates.parse_time, line) == want


def test_clock(spark):
    assert one(spark, dates.parse_clock, "at 7:30 pm sharp") == "7:30 pm"


@pytest.mark.parametrize(("url", "want"), [("/events/rising-spaces-the-first-exhibition-11/", "Rising Spaces The First Exhibition"), ("/events/one", None), ("https://x/a-b?c=d-e", "A B"), ("", None)])
def test_slug(spark, url, want):
    assert one(spark, titles.title_from_slug, url) == want


@pytest.mark.parametrize(("p", "want"), [(None, "Check site"), (0.0, "Free"), (12.5, "€12.5"), (10.0, "€10"), (0.125, "€0.12"), (2.675, "€2.67"), (1234.5, "€1234.5")])
def test_price_label(spark, p, want):
    df = spark.createDataFrame([(p,)], "p double")
    assert df.select(prices.price_label("p").alias("r")).first().r == want


@pytest.mark.parametrize(("p", "want"), [(None, 5), (0.0, 40), (0.004, 25), (10.0, 25), (10.01, 10), (15.0, 10), (15.01, 0), (-1.0, 25)])
def test_price_score(spark, p, want):
    assert spark.createDataFrame([(p,)], "p double").select(prices.price_score("p").alias("r")).first().r == want


def test_strip_takes_all_white_space(spark):
    assert one(spark, text.strip, "\t  a b\n ") == "a b"


@pytest.mark.parametrize(("href", "want"), [
    ("/e/1", "https://a.example/e/1"), ("e/1", "https://a.example/x/e/1"), ("//b.example/z", "https://b.example/z"), ("https://c.example", "https://c.example"), ("?q=1", "https://a.example/x/y?q=1"),
    ("#t", "https://a.example/x/y?p=2#t"), ("../up", "https://a.example/up"), ("", "https://a.example/x/y?p=2"), ("mailto:a@b", "mailto:a@b"),
])
def test_absolute_url(spark, href, want):
    assert one(spark, text.absolute_url, href, "https://a.example/x/y?p=2") == want


def test_cycle_and_weeks(spark):
    row = spark.range(1).select(dates.cycle_day("2024-01-15").alias("n"), *(dates.shown(d).alias(f"w{i}") for i, d in enumerate((*dates.next_week("2024-01-15"), *dates.current_week("2024-01-15"))))).first()
    assert tuple(row) == (9, "2024-01-22", "2024-01-28", "2024-01-14", "2024-01-20")
