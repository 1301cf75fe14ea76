"""Schemas: a listing, a scrape's envelope, a stored row; and the rank that keeps the order of rows."""

from __future__ import annotations

from pyspark.sql import types as T

#: The nine fields of a listing, in their order.
LISTING_FIELDS = ("title", "date", "time", "price", "category", "description", "url", "venue", "source_url")

LISTING = T.StructType([T.StructField(f, T.DoubleType() if f == "price" else T.StringType()) for f in LISTING_FIELDS])

#: As read: a price may be a number or a text.
RAW_LISTING = T.StructType([T.StructField(f, T.StringType()) for f in LISTING_FIELDS])

ENVELOPE = T.StructType([
    T.StructField("source", T.StringType()), T.StructField("site_name", T.StringType()), T.StructField("scraped_at", T.StringType()),
    T.StructField("event_count", T.LongType()), T.StructField("events", T.ArrayType(RAW_LISTING)), T.StructField("_corrupt_record", T.StringType()),
])

#: A row of the store: its key is (title, date, time, source_url), where a null time equals nothing.
STORED = T.StructType([
    T.StructField("title", T.StringType(), False), T.StructField("date", T.StringType(), False), T.StructField("time", T.StringType()), T.StructField("price", T.DoubleType()),
    T.StructField("category", T.StringType()), T.StructField("description", T.StringType()), T.StructField("source_url", T.StringType()), T.StructField("scraper_script", T.StringType()),
    T.StructField("is_recursive", T.BooleanType()), T.StructField("created_at", T.TimestampType()), T.StructField("updated_at", T.TimestampType()),
])
