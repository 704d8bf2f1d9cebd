"""The training-data pipeline over documents: stages that each call one operator.

A stage takes (spark, docs, sf_dir) and returns the documents it keeps, with the columns it was given; the
last returns their token ids. Between stages the documents are written to the shared folder and read back, so a
lost executor costs at most the stage it was lost in.

Null text counts as empty, and becomes empty text when lines are dropped. Repeated rows are documents like others, until
near-duplicates are dropped: of equal rows one stays. Empty tables pass through. Columns beside ``doc_id`` and ``text``
are carried untouched (``n_chars``, where present, follows the text).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, labelled, line_dedup, simhash, toxicity
from tidemark.llm.common import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below one half; the lexicon is learned from labelled documents."""
    lexicon = toxicity.learn(labelled.sample(docs, table(spark, sf_dir, "labels"), "toxic", 5, 0, toxicity.ROWS))
    return toxicity.score(docs, lexicon).filter(F.col("score") < 0.5).select("row.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without the lines that at least ten of them hold."""
    kept = line_dedup.drop_common_lines(docs, min_docs=10, min_chars=1)
    changed = {"text": F.col("kept").alias("text"), "n_chars": F.length("kept").cast("long").alias("n_chars")}
    return kept.select(*[changed.get(name, F.col(f"row.`{name}`")) for name in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    numbered = stored(docs.select(F.struct("*").alias("doc"), F.monotonically_increasing_id().alias("place")), "numbered")
    found = simhash.near_duplicates(numbered.select("doc.doc_id", "doc.text", "place"), shingle=4, bits=4)
    chosen = F.min(F.struct(F.col("row.doc_id").isNull().alias("unnamed"), "row.doc_id", "row.place")).alias("chosen")
    stays = found.groupBy("group").agg(chosen).select(F.col("chosen.place").alias("place"))
    return numbered.join(stays, "place", "left_semi").select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), window=10, keep=docs.columns)
    return found.filter(F.col("n_hit") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, their number and digest, and the digest of the text they decode to."""
    vocabulary = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return bpe.digests(bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN), ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_shared_lines),
    ("simhash", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("byte_bpe", encode),
]

# Hashes, learned lexicons and tokenizers are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
