"""File streams: arrivals, keyed upserts and per-batch quality results."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.keyed import latest_per_key
from tidemark.operators.loads.full import failed_rules
from tidemark.operators.quality.checks import Check, run_checks
from tidemark.sources.stored import StoredTable

BatchWriter = Callable[[DataFrame, int], None]


def file_stream(spark: SparkSession, path: str, schema: T.StructType, file_format: str = "parquet",
                files_per_batch: int | None = None, archive: str | None = None) -> DataFrame:
    """Files as they arrive below ``path`` (a glob is allowed).

    ``archive`` moves each file there once its batch is complete.
    """
    reader = spark.readStream.schema(schema).format(file_format)
    if file_format == "csv":
        reader = reader.option("header", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.load(path)


def run_available(stream: DataFrame, checkpoint: str, write_batch: BatchWriter) -> None:
    """Process what has arrived, batch by batch, and return.

    The checkpoint remembers the files already read, so calling this again handles
    only newer ones: it takes the place of a saved high-water mark.
    """
    query = (
        stream.writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def batch_folder(path: str, batch: int) -> str:
    """Folder of one micro-batch. A batch that is repeated after a failure replaces it."""
    return f"{path}/batch_id={batch}"


def append_arrivals(path: str) -> BatchWriter:
    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(batch_folder(path, batch))

    return write


def append_newest(path: str, keys: Sequence[str], order_by: Sequence[str], compact_after: int = 16) -> BatchWriter:
    """Keep the newest row per key of each micro-batch.

    A batch only adds its own folder, however large the state has become; readers
    reduce over the folders with ``current_state``. Beyond ``compact_after`` folders of batches they are folded together, so
    what a batch commits is bounded. A repeated batch replaces its folder, and if that was
    compacted away meanwhile, the newest row per key is the same with it.
    """
    def write(rows: DataFrame, batch: int) -> None:
        own, table = f"batch-{batch}", StoredTable(rows.sparkSession, path)
        version = table.newest()
        if sum(entry.kind != "base" for entry in version.entries) >= compact_after:
            compact_state(rows.sparkSession, path, keys, order_by)
            version = table.newest()
        staged = table.stage(latest_per_key(rows, keys, order_by), kind=own, version=version)
        staged.publish(lambda entry: entry.kind != own)

    return write


def current_state(spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The newest row per key over all batches."""
    return latest_per_key(StoredTable(spark, path).read(), keys, order_by)


def compact_state(spark: SparkSession, path: str, keys: Sequence[str], order_by: Sequence[str]) -> None:
    """Fold all batches into one folder; the stream goes on at the same path."""
    table = StoredTable(spark, path)
    version = table.newest()
    table.rewrite(latest_per_key(table.read(version=version), keys, order_by), version=version)


def check_batches(path: str, checks: Sequence[Check], rules: Mapping[str, str], as_of: str) -> BatchWriter:
    """Judge each micro-batch: results, accepted rows and quarantined rows side by side."""
    def write(rows: DataFrame, batch: int) -> None:
        judged = rows.withColumn("reject_reasons", failed_rules(rules)).persist()
        run_checks(judged.drop("reject_reasons"), checks, as_of).write.mode("overwrite").parquet(
            batch_folder(f"{path}/results", batch)
        )
        judged.filter(F.size("reject_reasons") == 0).drop("reject_reasons").write.mode("overwrite").parquet(
            batch_folder(f"{path}/accepted", batch)
        )
        judged.filter(F.size("reject_reasons") > 0).write.mode("overwrite").parquet(
            batch_folder(f"{path}/quarantine", batch)
        )
        judged.unpersist()

    return write
