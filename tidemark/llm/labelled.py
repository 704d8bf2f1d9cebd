"""A bounded sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def fold(key: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo the number of folds."""
    return F.crc32(key.cast("string")) % folds


def sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held_out: int, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, text, label) of at most ``rows`` labelled ids outside the held-out fold, one row per id.

    The ids are the first by hash, so the sample depends neither on the labels nor on row order. An id
    labelled more than once takes its largest label, one with several rows the text with the smallest hash; each
    task hands on one text per id, so a repeated id is not gathered. The chosen ids are broadcast: their number is bounded.
    """
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label")).filter("key IS NOT NULL AND label IS NOT NULL")
    known = known.filter(fold(F.col("key"), folds) != held_out).groupBy("key").agg(F.max("label").alias("label"))
    chosen = known.orderBy(F.xxhash64("key"), "key").limit(rows)
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    found = texts.join(F.broadcast(chosen), "key")
    # Ordered by the hash, then by the text itself: nothing is left to row order.
    single = found.groupBy("key", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    return single.select("key", "least.text", "label")
