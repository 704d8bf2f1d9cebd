"""Lines that many documents share, found with levelled sorted runs and dropped from every document.

``LineRuns`` keeps how many documents hold each line, as runs: tables sorted by line hash. A batch
anti-joins the runs for the lines already known to be common (their count can change nothing any more) and
adds the rest as a run of level 0. Once a level has ``fanout`` runs they are merged into one run of the next level, so
n batches leave about log n runs. A run is written before it is listed, and merged runs replace their
parts only after they are complete: a lost executor or a failed batch leaves the listed runs whole.

A line's key is the line without white space (U+0020, U+0009 to U+000D) at its ends, A-Z lower-cased, as a
128-bit hash. A document counts once for a line however often it holds it; repeated rows are documents
of their own. Null or empty text is one empty line, which is never dropped while ``min_chars`` is 1 or
more. An empty table gives no rows. Other columns travel in one struct, so their names cannot clash.
"""

from __future__ import annotations

import uuid

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.llm.common import per_batch, stored, text_key, utf8
from tidemark.session import workspace

SPACE = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key, or None for a key too short to be dropped."""
    key = line.strip(SPACE).lower()
    if len(key) < min_chars or min_chars > 1 and len(key.decode("utf-8", "replace")) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """Document counts of line hashes ``h binary`` as levelled sorted runs below ``folder``.

    ``runs`` lists (level, path); pass the list of an earlier object to go on from it.
    """

    def __init__(self, spark: SparkSession, folder: str, common: int, fanout: int = 4, runs: list[tuple[int, str]] | None = None):
        self.spark, self.folder, self.common, self.fanout = spark, folder, common, fanout
        self.runs = list(runs or [])

    def _write(self, counts: DataFrame, level: int) -> tuple[int, str]:
        path = f"{self.folder}/level={level}/run-{uuid.uuid4().hex}"  # never the name of a run that was, or is not listed
        counts.repartitionByRange("h").sortWithinPartitions("h").write.parquet(path)
        return level, path

    def _read(self, runs: list[tuple[int, str]]) -> DataFrame:
        return self.spark.read.schema("h binary, n long").parquet(*[path for _, path in runs])

    def counts(self) -> DataFrame:
        """(h, n) over all runs."""
        if not self.runs:
            return self.spark.createDataFrame([], "h binary, n long")
        return self._read(self.runs).groupBy("h").agg(F.sum("n").alias("n"))

    def common_lines(self) -> DataFrame:
        return self.counts().filter(F.col("n") >= self.common).select("h")

    def add(self, counts: DataFrame) -> None:
        """Take in a batch's (h, n): documents of the batch that hold the line."""
        if self.runs:
            counts = counts.join(self.common_lines().hint("merge"), "h", "left_anti")
        self.runs.append(self._write(counts.select("h", "n"), 0))
        level = 0
        while len(parts := [run for run in self.runs if run[0] == level]) >= self.fanout:
            merged = self._write(self._read(parts).groupBy("h").agg(F.sum("n").alias("n")), level + 1)
            self.runs = [run for run in self.runs if run not in parts] + [merged]
            level += 1


def _framed(docs: DataFrame, text: str) -> DataFrame:
    """(row, text, k): the other columns as one struct, the text, and 128 bits that stand for it."""
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    return docs.select(F.struct(*rest).alias("row"), body.alias("text")).withColumn("k", text_key(F.col("text")))


def document_lines(docs: DataFrame, text: str = "text", min_chars: int = 1) -> DataFrame:
    """(k, h): the distinct line keys of each row, by the key of its text."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, hashes = [], []
            for i, value in enumerate(utf8(batch.column(0))):
                keys = {line_key(line, min_chars) for line in value.split(b"\n")}
                keys.discard(None)
                at += [i] * len(keys)
                hashes += keys
            return pa.RecordBatch.from_arrays([batch.column(1).take(pa.array(at, pa.int64())), pa.array(hashes, pa.binary())], ["k", "h"])

        return each

    return per_batch(_framed(docs, text).select("text", "k"), "k struct<a long, b long>, h binary", make)


def drop_common_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, text: str = "text", batches: int = 4, fanout: int = 4) -> DataFrame:
    """(row, kept, n_lines, n_dropped): each row without its text, its text without the lines that at
    least ``min_docs`` documents hold, and its numbers of lines before and dropped."""
    spark = docs.sparkSession
    lines = stored(document_lines(docs, text, min_chars).withColumn("batch", F.spark_partition_id() % batches), "lines")
    runs = LineRuns(spark, workspace(spark, "line-runs"), min_docs, fanout)
    for batch in range(batches):
        runs.add(lines.filter(F.col("batch") == batch).groupBy("h").agg(F.count("*").alias("n")))
    common = stored(runs.common_lines(), "common-lines")
    # Only texts that hold a common line are listed, each with the ones it holds: at most its own lines.
    held = stored(lines.join(common, "h", "left_semi").groupBy("k").agg(F.collect_set("h").alias("drop")), "held-lines")
    framed = _framed(docs, text)
    joined = framed.join(held, "k", "left").select("row", "text", "drop")
    schema = T.StructType([framed.schema["row"], T.StructField("kept", T.StringType()), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept, n_lines, n_dropped = [], [], []
            for value, drop in zip(utf8(batch.column(1)), batch.column(2), strict=True):
                lines = value.split(b"\n")
                n_lines.append(len(lines))
                if drop.is_valid:
                    common = set(drop.as_py())
                    lines = [line for line in lines if line_key(line, min_chars) not in common]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            text = pa.array(kept, pa.binary()).cast(pa.string())
            return pa.RecordBatch.from_arrays([batch.column(0), text, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], schema.names)

        return each

    return per_batch(joined, schema, make)
