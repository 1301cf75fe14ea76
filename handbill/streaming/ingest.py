"""Continuous ingestion, an extension: new scrape documents are scored and put in the store batch by batch.

First-wins dedup is by order, not by arrival, so each micro-batch runs the same operators as a batch and the store's key decides across batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import categories, dedup, filters, merge
from ..schema import ENVELOPE, LISTING_FIELDS, STORED
from ..sources.readers import read_store
from ..sources.sinks import _files, replace_store


def documents_stream(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.readStream.schema(ENVELOPE).option("multiLine", True).option("pathGlobFilter", "raw_*.json").json(path)
    rows = rows.select("source", F.col("_metadata.file_path").alias("path"), F.posexplode("events").alias("position", "e"))
    fields = [(F.col("e.price").try_cast("double") if f == "price" else F.col(f"e.{f}")).alias(f) for f in LISTING_FIELDS]
    return rows.select("path", F.col("position").cast("long").alias("position"), *fields)


def to_store(batch: DataFrame, store: DataFrame, script: str = "") -> DataFrame:
    """One run over the store: the price filter, categories for listings without any, repeats, then the upsert."""
    rows = batch.where(filters.affordable()).withColumn("category", categories.with_category("category", categories.store_category()))
    rows = dedup.is_recursive(rows, store).withColumns({"scraper_script": F.lit(script), "created_at": F.current_timestamp(), "updated_at": F.current_timestamp()})
    return merge.upsert_replace(store, rows.select(*STORED.fieldNames(), "ordinal")).select(*STORED.fieldNames())


def ingest(spark: SparkSession, path: str, store_path: str, checkpoint: str) -> StreamingQuery:
    """Runs over all documents that are new, then stops; run again, it goes on where it stopped."""

    def put(batch: DataFrame, _: int) -> None:
        from pyspark.sql import Window

        files, p = _files(batch.sparkSession, store_path)
        store = read_store(batch.sparkSession, store_path) if files.exists(p) else batch.sparkSession.createDataFrame([], STORED)
        nth = F.row_number().over(Window.partitionBy("path").orderBy("position"))
        rows = batch.withColumn("ordinal", F.struct("path", nth)).drop("path", "position")
        replace_store(to_store(rows, store), store_path)

    return documents_stream(spark, path).writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
