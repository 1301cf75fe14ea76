"""The corpus pipeline: language ID, line dedup, near dedup, mixing, packing; each stage reads what the one before it wrote.

In all stages texts of any length are read whole, further columns are kept whatever their names (packing returns only its own), and an empty table gives an
empty one. The tables that a stage makes on its way are deleted when its result is written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from handbill.llm import langid, lines, minhash, mixing, packing
from handbill.llm.common import MADE, discard, stored, sweep


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are in a learned language go on; those without letters (null and empty texts too), or of no language by 0.35, go. Repeated rows are
    judged alike; a null lang is not learned; a null doc_id is one that may be learned; of languages that tie the first one counts."""
    return langid.accepted(docs, langid.fit(docs))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of runs of 3 lines or 50 words go, then those of passages of 50 words that are no whole lines, and documents without any text then (null and
    empty ones too). Later is by doc_id, null first, then by a hash of the text; rows that repeat both are one document and change alike."""
    return lines.deduplicated(docs).where(F.col("text").rlike(r"[^\x20\x09-\x0D]"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of documents that share 80% of their five-word shingles, the one of the smallest doc_id stays; rows that repeat its doc_id stay with
    it. Null and empty texts and null ids are linked with nothing and stay."""
    return minhash.deduplicated(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of weights 1, 2, 3 by source takes them. A null source is one of its own, repeated rows are dealt each, a null text has no words."""
    return mixing.mix(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's bucket, batch and slot, by its words; repeated rows are packed each, null ids first, a null text has no words."""
    return packing.packed(docs)


STAGES = [("language", language), ("line dedup", line_dedup), ("near dedup", near_dedup), ("mixture", mixture), ("packing", pack)]

#: The classifier and the cube method can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = None
    for name, stage in STAGES:
        made = len(MADE)
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        sweep(spark, MADE[made:], keep=docs)
        if before is not None:
            discard(before)
        before = docs
    return docs
