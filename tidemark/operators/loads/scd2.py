"""Versioned dimensions: every change of a key opens a new dated row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from tidemark.functions.columns import OPEN_END, record_hash
from tidemark.functions.keyed import latest_per_key, lookup_join
from tidemark.operators.loads.full import end_of_day
from tidemark.session import workspace
from tidemark.sources.stored import StoredTable


def _day(value: str) -> Column:
    return F.lit(value).cast("date")


def stage_snapshot(source: DataFrame, key: str, changed_at: str, day: str, order_by: Sequence[str] = ()) -> DataFrame:
    """The newest snapshot per key known at the end of ``day``."""
    known = source.filter(F.col(changed_at) <= end_of_day(day))
    return latest_per_key(known, [key], [changed_at, *order_by])


def surrogate_key(key: str) -> Column:
    """A key for the version: a key has one version per start day, so both together are
    unique, without a counter shared between tasks and without hash collisions."""
    return F.concat_ws("@", F.col(key).cast("string"), F.col("valid_from").cast("string"))


def as_versions(rows: DataFrame, key: str, attributes: Sequence[str], valid_from: Column, compat: bool = False) -> DataFrame:
    """Current versions of ``rows`` that start on ``valid_from``."""
    return rows.select(
        key,
        *attributes,
        valid_from.alias("valid_from"),
        _day(OPEN_END).alias("valid_to"),
        F.lit(True).alias("is_current"),
        record_hash(attributes, compat).alias("record_hash"),
    ).withColumn("surrogate_key", surrogate_key(key))


def detect_changes(staged: DataFrame, current: DataFrame, key: str, attributes: Sequence[str],
                   compat: bool = False) -> DataFrame:
    """Staged rows that are new or differ from the current version; ``is_new`` tells which."""
    hashed = staged.select(key, *attributes, record_hash(attributes, compat).alias("record_hash"))
    old = current.select(key, F.col("record_hash").alias("__old_hash"))
    joined = hashed.join(old, key, "left")
    is_new = F.col("__old_hash").isNull()
    changed = joined.filter(is_new | (F.col("record_hash") != F.col("__old_hash")))
    return changed.select(key, *attributes, "record_hash", is_new.alias("is_new"))


def _judged(versions: DataFrame, staged: DataFrame, key: str, attributes: Sequence[str], day: str, compat: bool) -> DataFrame:
    """What the load for ``day`` does to each key, from keys, dates and hashes alone.

    Attributes stay where they are: only a key, two dates and a hash per row are exchanged, combined before the shuffle
    into numbers of fixed size. ``covers_from`` and ``covers_to`` are the version the day falls into, ``ends`` is
    the last day of a version opened on it, ``acts`` whether there is one.
    """
    on, before = _day(day), F.date_sub(_day(day), 1)

    def halves(text: Column) -> list[Column]:
        """128 bits that stand for a hash, as two numbers."""
        return [F.xxhash64(text), F.xxhash64(F.lit(1), text)]

    covers = on.between(F.col("valid_from"), F.col("valid_to"))
    first, second = halves(F.col("record_hash"))
    old = versions.select(
        key, F.lit(False).alias("staged"), "valid_from", "valid_to", "is_current", covers.alias("covers"), first.alias("h1"), second.alias("h2"))
    first, second = halves(record_hash(attributes, compat))
    new = staged.select(
        key, F.lit(True).alias("staged"), *[F.lit(None).cast("date").alias(c) for c in ("valid_from", "valid_to")],
        F.lit(False).alias("is_current"), F.lit(False).alias("covers"), first.alias("h1"), second.alias("h2"))
    compared = F.col("staged") | F.col("covers")

    def of_covering(name: str) -> Column:
        return F.max(F.when(F.col("covers"), F.col(name)))

    judged = old.unionByName(new).groupBy(key).agg(
        F.bool_or("staged").alias("present"), F.count_if(~F.col("staged")).alias("n_old"),
        of_covering("valid_from").alias("covers_from"), of_covering("valid_to").alias("covers_to"),
        of_covering("is_current").alias("covers_current"),
        F.min(F.when(F.col("valid_from") > on, F.col("valid_from"))).alias("following"),
        *[F.min(F.when(compared, F.col(h))).alias(f"min_{h}") for h in ("h1", "h2")],
        *[F.max(F.when(compared, F.col(h))).alias(f"max_{h}") for h in ("h1", "h2")],
        F.count_if(F.col("valid_to") == before).alias("n_expired"), F.count_if("is_current").alias("n_current"),
    )
    same = F.col("covers_from").isNotNull() & (F.col("min_h1") == F.col("max_h1")) & (F.col("min_h2") == F.col("max_h2"))
    # Up to the end of the version it falls into, else to the day before the next one, else open.
    ends = F.coalesce("covers_to", F.date_sub("following", 1), _day(OPEN_END))
    return judged.select(key, "covers_from", "covers_current", "n_old", "n_expired", "n_current",
                         ends.alias("ends"), (F.col("present") & ~same).alias("acts"))


def apply_changes(versions: DataFrame, staged: DataFrame, key: str, attributes: Sequence[str], day: str,
                  compat: bool = False) -> DataFrame:
    """The versions after the load for ``day``.

    ``versions`` may be the whole table or only its rows that end on ``day`` or later;
    others pass through. A staged row that differs from the version its day falls into ends that
    version the day before and takes over to its end, so a load for an earlier day goes
    between the versions around it. A version that starts on the day itself is replaced, since closing it
    would end it before it began.

    Keys that change are found first and written to the shared folder, so that their number is known: while they fit a
    broadcast, neither side's attributes are shuffled. Both inputs are read twice; store what a
    chain of loads passes on.
    """
    on, changed = _day(day), workspace(versions.sparkSession, "scd2-changes")
    judged = _judged(versions, staged, key, attributes, day, compat)
    acting = judged.filter("acts").select(key, F.col("covers_from").alias("__covers"), F.col("ends").alias("__ends"))
    acting.write.parquet(changed)
    acting = versions.sparkSession.read.schema(acting.schema).parquet(changed)
    order = [key, *attributes, "valid_from", "valid_to", "is_current", "record_hash", "surrogate_key"]
    ended = F.coalesce(F.col("valid_from") == F.col("__covers"), F.lit(False))
    kept = versions.join(acting, key, "left").filter(~(ended & (F.col("valid_from") == on)))
    kept = kept.withColumns({
        "valid_to": F.when(ended, F.date_sub(on, 1)).otherwise(F.col("valid_to")), "is_current": F.col("is_current") & ~ended,
    })
    opened = as_versions(staged, key, attributes, on, compat).join(acting, key)
    opened = opened.withColumns({"valid_to": F.col("__ends"), "is_current": F.col("__ends") == _day(OPEN_END)})
    return kept.select(*order).unionByName(opened.select(*order))


def catch_up(source: DataFrame, key: str, changed_at: str, attributes: Sequence[str], days: Sequence[str],
             order_by: Sequence[str] = (), compat: bool = False) -> DataFrame:
    """The table that loading each of ``days`` in turn would build from scratch.

    One pass instead of one per day: each change counts for the first load that sees it,
    the newest one per key and load stays, and a version opens where the hash differs
    from the load before. The window sees at most one row per key and load.
    """
    ordered = sorted(days)
    seen_by = F.coalesce(*[F.when(F.col(changed_at) <= end_of_day(d), _day(d)) for d in ordered])
    dated = source.withColumn("valid_from", seen_by).filter("valid_from IS NOT NULL")
    newest = latest_per_key(dated, [key, "valid_from"], [changed_at, *order_by])
    hashed = newest.withColumn("record_hash", record_hash(attributes, compat))
    by_load = Window.partitionBy(key).orderBy("valid_from")
    before = F.lag("record_hash").over(by_load)
    opened = hashed.withColumn("__before", before).filter(
        F.col("__before").isNull() | (F.col("__before") != F.col("record_hash"))
    )
    following = F.lead("valid_from").over(by_load)
    closed = opened.withColumn("__next", following)
    return closed.select(
        key,
        *attributes,
        "valid_from",
        F.coalesce(F.date_sub("__next", 1), _day(OPEN_END)).alias("valid_to"),
        F.col("__next").isNull().alias("is_current"),
        "record_hash",
        surrogate_key(key).alias("surrogate_key"),
    )


def processing_log(versions: DataFrame, staged: DataFrame, key: str, attributes: Sequence[str], day: str, pipeline: str,
                   table: str, compat: bool = False) -> DataFrame:
    """New, changed, expired and total current records of the load for ``day``, in one pass over its inputs."""
    judged = _judged(versions, staged, key, attributes, day, compat)
    ends = F.col("acts") & F.col("covers_from").isNotNull()
    closes = ends & (F.col("covers_from") != _day(day))
    opens = (F.col("acts") & (F.col("ends") == _day(OPEN_END))).cast("long")
    current = F.col("n_current") - (ends & F.col("covers_current")).cast("long") + opens
    counted = judged.agg(
        F.count_if(F.col("acts") & (F.col("n_old") == 0)).alias("new_records"),
        F.count_if(F.col("acts") & (F.col("n_old") > 0)).alias("changed_records"),
        F.coalesce(F.sum(F.col("n_expired") + closes.cast("long")), F.lit(0)).alias("expired_records"),
        F.coalesce(F.sum(F.coalesce(current, F.col("n_current") + opens)), F.lit(0)).alias("total_current_records"),
    )
    return counted.select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(table).alias("table_name"),
        _day(day).alias("execution_date"),
        "new_records", "changed_records", "expired_records", "total_current_records",
        F.lit("success").alias("status"),
        F.localtimestamp().alias("created_at"),
    )


def latest_log(logs: DataFrame, pipeline: str, day: str) -> DataFrame:
    """The newest log row of a pipeline for one day."""
    mine = logs.filter((F.col("pipeline_name") == pipeline) & (F.col("execution_date") == _day(day)))
    return mine.orderBy(F.desc("created_at")).limit(1)


def run_load(spark: SparkSession, path: str, staged: DataFrame, key: str, attributes: Sequence[str], day: str,
             compat: bool = False) -> None:
    """Apply one day to a table stored by ``valid_to``.

    Read and replaced are the folders that end the day before or later: for the newest day the open
    versions and those the same day's load closed before, for an earlier day also what was closed since.
    A repeated load changes nothing, and a load that fails leaves the table as it was.
    """
    table = StoredTable(spark, path)
    version, before = table.newest(), str(date.fromisoformat(day) - timedelta(days=1))
    touched = {entry.part for entry in version.entries if entry.part >= before}
    affected = table.read(lambda entry: entry.part in touched, version)
    table.replace(apply_changes(affected, staged, key, attributes, day, compat), "valid_to", touched, version)


def write_versions(versions: DataFrame, path: str) -> None:
    """Store versions by ``valid_to``, as the whole table."""
    StoredTable(versions.sparkSession, path).rewrite(versions, "valid_to")


def read_versions(spark: SparkSession, path: str) -> DataFrame:
    return StoredTable(spark, path).read()


def current_view(versions: DataFrame, key: str, count: int | None = None) -> DataFrame:
    ordered = versions.filter("is_current").orderBy(key)
    return ordered if count is None else ordered.limit(count)


def key_history(versions: DataFrame, key: str, value: Column) -> DataFrame:
    """All versions of one key, newest first. The filter on the key reaches a stored or a computed table alike."""
    return versions.filter(F.col(key) == value).orderBy(F.desc("valid_from"))


def change_counts(versions: DataFrame, key: str) -> DataFrame:
    return versions.groupBy(key).agg((F.count(F.lit(1)) - 1).alias("num_changes"))


def valid_on(versions: DataFrame, day: str) -> DataFrame:
    return versions.filter(_day(day).between(F.col("valid_from"), F.col("valid_to")))


def _by_period(facts: DataFrame, versions: DataFrame, day: str, days: int) -> tuple[DataFrame, DataFrame]:
    """Facts with the period of their day, and versions once per period they reach into, between the facts' first and last day."""
    def period(moment: Column) -> Column:
        return F.floor(F.unix_date(moment) / F.lit(days))

    on, begin, end = F.to_date(day), F.to_date("valid_from"), F.to_date("valid_to")
    first, last = (F.lit(moment).cast("date") for moment in facts.agg(F.min(on), F.max(on)).first())
    met = versions.filter((begin <= last) & (end >= first) & (begin <= end))
    periods = F.sequence(period(F.greatest(begin, first)), period(F.least(end, last)))
    return facts.withColumn("__period", period(on)), met.withColumn("__period", F.explode(periods))


def as_of_join(facts: DataFrame, versions: DataFrame, key: str, day: str, how: str = "left", period_days: int | None = None,
               skewed: bool = False) -> DataFrame:
    """Facts with the attributes their key had on the fact's day.

    By key alone a fact meets all versions of its key. With ``period_days`` it meets those that are valid in its own period of so
    many days: at most ``period_days`` where each version begins on a day of its own, plus the one that was valid before. Facts are not
    repeated; versions are, once per period, so a key has at most as many rows as versions and periods together, as long as its versions do
    not overlap. The facts' first and last day bound the open versions; they are found by one pass over that column. The facts of a frequent
    key are spread by its periods, and with ``skewed`` beyond that. NULL keys and days meet nothing either way.
    """
    within = F.col(day).between(F.col("valid_from"), F.col("valid_to"))
    if period_days is None:
        return lookup_join(facts, versions, [key], how, residual=within, skewed=skewed)
    numbered, repeated = _by_period(facts, versions, day, period_days)
    return lookup_join(numbered, repeated, [key, "__period"], how, residual=within, skewed=skewed).drop("__period")
