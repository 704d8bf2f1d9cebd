"""Helpers shared by the text operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import workspace

PIECE_BYTES = 4 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame, name: str) -> DataFrame:
    """The rows written to and read back from the shared folder: this cuts the lineage, gives the
    optimizer a true size, and keeps the rows when an executor is lost."""
    path = workspace(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Inside, what a query shuffled goes from the disks when the query ends. For queries that end before they return, as writes do."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased and nothing else. Pure ASCII text takes the fast built-in."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; null counts as empty."""
    text = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def per_batch(frame: DataFrame, schema: str | T.StructType, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """mapInArrow with state per task: ``make`` runs once in the task and returns the batch function.

    Batches are worked on in pieces of about PIECE_BYTES, which bounds what a worker holds besides its input.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each, pool = make(), pa.default_memory_pool()
        for batch in batches:
            step = max(1, batch.num_rows * PIECE_BYTES // max(batch.nbytes, 1))
            for first in range(0, batch.num_rows, step):
                yield each(batch.slice(first, step))
            pool.release_unused()

    return frame.mapInArrow(run, schema)


def utf8(column: pa.Array) -> Iterator[bytes]:
    """The UTF-8 bytes of each text, null as empty, without building strings."""
    for value in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()):
        yield value.as_py() or b""
