"""Incremental loads behind a saved high-water mark, and the upserts they end in."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.keyed import first_per_key, latest_per_key
from tidemark.operators.loads.full import moment
from tidemark.operators.quality.relations import duplicate_gate
from tidemark.operators.quality.results import QualityError
from tidemark.sources.stored import StoredTable, Version
from tidemark.sources.tables import reduce_union

EPOCH = "1970-01-01 00:00:00"


def last_watermark(marks: DataFrame, pipeline: str, table: str) -> DataFrame:
    """One row: the highest mark of a successful run, NULL before the first."""
    mine = marks.filter(
        (F.col("pipeline_name") == pipeline) & (F.col("table_name") == table) & (F.col("status") == "success")
    )
    return mine.agg(F.max("watermark_value").alias("last_watermark"))


def watermark_or_epoch(marks: DataFrame, pipeline: str, table: str) -> Column:
    mark = last_watermark(marks, pipeline, table).scalar()
    return F.coalesce(mark.cast("timestamp_ntz"), moment(EPOCH))


def changed_between(source: DataFrame, changed_at: str, low: Column, high: Column,
                    buffer: str | None = None) -> DataFrame:
    """Rows changed after ``low`` and up to ``high``.

    ``buffer`` is an interval such as ``2 DAYS`` by which the lower bound is moved
    back, to pick up rows that arrived late; the upsert absorbs the repeats.
    """
    start = low if buffer is None else low - F.expr(f"INTERVAL {buffer}")
    changed = F.col(changed_at)
    return source.filter((changed > start) & (changed <= high))


def new_watermark(source: DataFrame, changed_at: str, execution_date: Column) -> DataFrame:
    """The highest change time up to the execution date, or that date when there is none."""
    seen = source.filter(F.col(changed_at) <= execution_date)
    return seen.agg(F.coalesce(F.max(changed_at), execution_date).alias("new_watermark"))


def watermark_row(spark: SparkSession, pipeline: str, table: str, value: Column, execution_date: Column,
                  records: Column) -> DataFrame:
    return spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(table).alias("table_name"),
        value.cast("timestamp_ntz").alias("watermark_value"),
        execution_date.cast("timestamp_ntz").alias("execution_date"),
        F.lit("success").alias("status"),
        records.cast("bigint").alias("records_processed"),
    )


def batch_statistics(source: DataFrame, changed_at: str, low: Column, high: Column) -> DataFrame:
    return changed_between(source, changed_at, low, high).agg(F.count(F.lit(1)).alias("records_loaded"))


def upsert(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Target rows replaced or extended by the latest batch row of each key."""
    return replace_rows(target, latest_per_key(batch, keys, order_by), keys)


def replace_rows(target: DataFrame, newest: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows replaced or extended by ``newest``.

    Both sides have one row per key, so a frequent key does not burden the join.
    """
    newest = newest.select(*target.columns)
    return target.join(newest.select(*keys), list(keys), "left_anti").unionByName(newest)


def insert_ignore(target: DataFrame, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Target rows plus the first batch row of each key the target lacks."""
    first = first_per_key(batch, keys, order_by).select(*target.columns)
    return target.unionByName(first.join(target.select(*keys), list(keys), "left_anti"))


def upsert_keeping(target: DataFrame, batch: DataFrame, key: str, replaced: Sequence[str], stamp: str,
                   now: Column) -> DataFrame:
    """Type 1 dimension load: overwrite some attributes, keep the others.

    ``batch`` has one row per key. Rows it touches get the ``stamp`` column set.
    """
    incoming = batch.withColumnsRenamed({c: f"new_{c}" for c in batch.columns if c != key})
    incoming = incoming.withColumn("__in_batch", F.lit(True))
    present = target.withColumn("__in_target", F.lit(True))
    joined = present.join(incoming, key, "full")
    columns = []
    for name in target.columns:
        if name == key:
            columns.append(F.col(key))
        elif name == stamp:
            columns.append(F.when(F.col("__in_batch"), now).otherwise(F.col(stamp)).alias(stamp))
        elif f"new_{name}" not in incoming.columns:
            columns.append(F.col(name))
        else:
            take_new = F.col("__in_target").isNull()
            if name in replaced:
                take_new = take_new | F.col("__in_batch").isNotNull()
            columns.append(F.when(take_new, F.col(f"new_{name}")).otherwise(F.col(name)).alias(name))
    return joined.select(*columns)


def merged(table: StoredTable, keys: Sequence[str], choose: Callable[[str], bool] = lambda part: True,
           version: Version | None = None) -> DataFrame:
    """The rows of an incrementally loaded table, or of the chosen parts: its base, replaced by what later batches brought.

    Parts that no batch has touched since the last compaction are read as they are, without a join.
    """
    version = version or table.newest()
    deltas = [entry for entry in version.entries if entry.kind == "delta" and choose(entry.part)]
    touched = {entry.part for entry in deltas}
    base = [table.read(lambda entry, within=within: entry.kind != "delta" and choose(entry.part) and (entry.part in touched) == within, version)
            for within in (False, True)]
    if not deltas:
        return base[0]
    # Folder names sort by version; a later batch wins whatever its change times are.
    numbered = [
        table.read(lambda entry, folder=folder: choose(entry.part) and entry.folder.startswith(folder), version).withColumn("__batch", F.lit(number))
        for number, folder in enumerate(sorted({entry.folder.split("/")[0] for entry in deltas}))
    ]
    newest = latest_per_key(reduce_union(numbered), keys, ["__batch"]).drop("__batch")
    return base[0].unionByName(replace_rows(base[1], newest, keys))


def upsert_batch(table: StoredTable, batch: DataFrame, keys: Sequence[str], order_by: Sequence[str], place: Column | None = None) -> None:
    """Add a batch to the table; costs what the batch costs, since the folders before it stay as they are.

    The batch is written, checked for duplicate keys, and only then becomes part of the table. ``place`` is the part
    a row belongs to, an expression of its keys such as a range of ids or a period: the batch touches the parts it
    has rows for and no others.
    """
    staged = table.stage(latest_per_key(batch, keys, order_by), place, "delta")
    gate = duplicate_gate(staged.read(), keys).first()
    if not gate.passed:
        raise QualityError(f"{gate.duplicate_keys} duplicate key(s) in {table.path}")
    if staged.entries:
        staged.publish()


def compact(table: StoredTable, keys: Sequence[str], after: int = 0, place: Column | None = None) -> bool:
    """Fold the batches into the base once there are more than ``after`` of them. Only the parts they touch are read and rewritten."""
    version = table.newest()
    deltas = [entry for entry in version.entries if entry.kind == "delta"]
    if len({entry.folder.split("/")[0] for entry in deltas}) <= after:
        return False
    touched = {entry.part for entry in deltas}
    staged = table.stage(merged(table, keys, touched.__contains__, version), place, version=version)
    staged.publish(lambda entry: entry.part not in touched)
    return True


def run_incremental(spark: SparkSession, source: DataFrame, changed_at: str, target_path: str, marks_path: str,
                    keys: Sequence[str], pipeline: str, table: str, execution_date: str,
                    buffer: str | None = None, compact_after: int = 8, place: Column | None = None) -> int:
    """One incremental run: extract, upsert, check, and only then save the mark.

    A run that fails on the way leaves the old mark, so the next one repeats its rows,
    which the upsert absorbs; so does one that another run overtook (StaleTableError). Returns the number of changed rows.
    """
    # One value, fetched so that the scan of the source is pruned by a plain constant.
    saved = last_watermark(spark.read.parquet(marks_path), pipeline, table).first().last_watermark
    low = F.lit(saved) if saved else moment(EPOCH)
    high = moment(execution_date)
    target = StoredTable(spark, target_path)
    upsert_batch(target, changed_between(source, changed_at, low, high, buffer), keys, [changed_at], place)
    compact(target, keys, compact_after, place)
    changed = changed_between(source, changed_at, low, high)
    batch_found = changed.agg(F.count(F.lit(1)).alias("records"), F.max(changed_at).alias("newest")).first()
    mark = F.lit(batch_found.newest) if batch_found.records else new_watermark(source, changed_at, high).scalar()
    row = watermark_row(spark, pipeline, table, mark, high, F.lit(batch_found.records))
    row.write.mode("append").parquet(marks_path)
    return batch_found.records
