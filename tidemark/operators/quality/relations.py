"""Checks that look at more than one row: references, calendars, versioned dimensions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.columns import OPEN_END
from tidemark.sources.tables import reduce_union


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys without a dimension row, with their row count.

    Facts shrink to one row per key before they meet the dimension, so the size of a
    key group does not matter to the join.
    """
    counted = fact.filter(F.col(fact_key).isNotNull()).groupBy(fact_key).agg(F.count(F.lit(1)).alias("row_count"))
    known = dim.select(F.col(dim_key).alias(fact_key))
    return counted.join(known, fact_key, "left_anti")


def orphan_summary(fact: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], name: str = "fact") -> DataFrame:
    """Per foreign key: rows, NULL keys, orphan keys and orphan rows."""
    rows = []
    for fact_key, (dim, dim_key) in dims.items():
        per_key = fact.groupBy(fact_key).agg(F.count(F.lit(1)).alias("n"))
        known = dim.select(F.col(dim_key).alias("__known")).distinct()
        joined = per_key.join(known, F.col(fact_key) == F.col("__known"), "left")
        lost = F.col(fact_key).isNotNull() & F.col("__known").isNull()
        rows.append(
            joined.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
                F.coalesce(F.sum(F.when(F.col(fact_key).isNull(), F.col("n"))), F.lit(0)).alias("null_rows"),
                F.count_if(lost).alias("orphan_keys"),
                F.coalesce(F.sum(F.when(lost, F.col("n"))), F.lit(0)).alias("orphan_rows"),
            ).select(F.lit(name).alias("table_name"), F.lit(fact_key).alias("key_column"), "*")
        )
    return reduce_union(rows)


def date_gaps(df: DataFrame, day: str) -> DataFrame:
    """Calendar days missing between the first and the last day present."""
    present = df.select(F.to_date(day).alias("date")).filter("date IS NOT NULL").distinct()
    ends = present.agg(F.min("date").alias("first"), F.max("date").alias("last"))
    calendar = ends.select(F.explode(F.sequence("first", "last", F.expr("INTERVAL 1 DAY"))).alias("date"))
    return calendar.join(present, "date", "left_anti")


def duplicate_gate(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Number of repeated keys and whether a load may go on (none at all)."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.count_if(F.col("n") > 1).alias("duplicate_keys")).withColumn(
        "passed", F.col("duplicate_keys") == 0
    )


def volume_gate(df: DataFrame, error: Column, max_error_rate: float = 0.03, min_rows: int = 800) -> DataFrame:
    """Row count, error rate and the PASS/FAIL decision for downstream work."""
    found = df.agg(F.count(F.lit(1)).alias("record_count"), F.count_if(error).alias("error_count"))
    rate = F.when(F.col("record_count") > 0, F.col("error_count") / F.col("record_count")).otherwise(F.lit(0.0))
    met = (F.col("error_rate") < max_error_rate) & (F.col("record_count") >= min_rows)
    gated = found.withColumn("error_rate", rate).withColumn("quality_threshold_met", met)
    return gated.withColumn("quality_gate", F.when(F.col("quality_threshold_met"), "PASS").otherwise("FAIL"))


def pass_gate(df: DataFrame, gate: DataFrame) -> DataFrame:
    """``df`` when the one-row gate is open, otherwise no rows."""
    return df.filter(gate.select("quality_threshold_met").scalar())


def _starts(versions: DataFrame, key: str) -> DataFrame:
    """One row per key and start day: a key has at most one per calendar day, however
    many versions it has, so the windows below stay small under any skew."""
    return versions.groupBy(key, "valid_from").agg(
        F.max("valid_to").alias("last_end"), F.count(F.lit(1)).alias("started")
    )


def several_current(versions: DataFrame, key: str) -> DataFrame:
    """Keys with more than one current version."""
    counted = versions.filter("is_current").groupBy(key).agg(F.count(F.lit(1)).alias("current_count"))
    return counted.filter("current_count > 1")


def overlapping_starts(versions: DataFrame, key: str) -> DataFrame:
    """Start days on which a version with an earlier start is still valid."""
    earlier = Window.partitionBy(key).orderBy("valid_from").rowsBetween(Window.unboundedPreceding, -1)
    return (
        _starts(versions, key)
        .withColumn("earlier_end", F.max("last_end").over(earlier))
        .filter(F.col("earlier_end") >= F.col("valid_from"))
    )


def overlap_pairs(versions: DataFrame, key: str) -> DataFrame:
    """Per key the number of version pairs that overlap and start on different days.

    Counted by a sweep over days, without forming pairs: at each start day the versions
    begun earlier and not yet ended each overlap the versions starting there. Needs
    ``valid_from <= valid_to`` on every row.
    """
    begins = versions.groupBy(key, F.col("valid_from").alias("day")).agg(F.count(F.lit(1)).alias("begun"))
    ends = versions.groupBy(key, F.date_add("valid_to", 1).alias("day")).agg(F.count(F.lit(1)).alias("ended"))
    events = (
        begins.withColumn("ended", F.lit(0).cast("bigint"))
        .unionByName(ends.withColumn("begun", F.lit(0).cast("bigint")))
        .groupBy(key, "day")
        .agg(F.sum("begun").alias("begun"), F.sum("ended").alias("ended"))
    )
    so_far = Window.partitionBy(key).orderBy("day")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    open_before = F.coalesce(F.sum("begun").over(before), F.lit(0)) - F.sum("ended").over(
        so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    swept = events.withColumn("pairs", F.col("begun") * open_before)
    return swept.groupBy(key).agg(F.sum("pairs").alias("overlapping_pairs")).filter("overlapping_pairs > 0")


def history_gaps(versions: DataFrame, key: str) -> DataFrame:
    """Places where a version ends more than a day before the next one starts."""
    following = Window.partitionBy(key).orderBy("valid_from")
    return (
        _starts(versions, key)
        .withColumn("next_from", F.lead("valid_from").over(following))
        .filter(F.col("next_from") > F.date_add("last_end", 1))
    )


def version_integrity(versions: DataFrame, key: str) -> DataFrame:
    """One row per integrity rule of a versioned dimension: failures and severity."""
    sentinel = F.lit(OPEN_END).cast("date")
    row_rules = versions.agg(
        F.count_if(F.col("is_current") != (F.col("valid_to") == sentinel)).alias("sentinel"),
        F.count_if(F.col("valid_from") > F.col("valid_to")).alias("order"),
    ).select(
        F.inline(
            F.array(
                F.struct(F.lit("open_end_is_current").alias("rule"), F.lit("ERROR").alias("severity"),
                         F.col("sentinel").alias("failures")),
                F.struct(F.lit("start_before_end").alias("rule"), F.lit("ERROR").alias("severity"),
                         F.col("order").alias("failures")),
            )
        )
    )

    def counted(rule: str, severity: str, found: DataFrame) -> DataFrame:
        return found.agg(F.count(F.lit(1)).alias("failures")).select(
            F.lit(rule).alias("rule"), F.lit(severity).alias("severity"), "failures"
        )

    checks = reduce_union([
        counted("one_current_version", "ERROR", several_current(versions, key)),
        counted("no_overlap", "WARNING", overlapping_starts(versions, key)),
        counted("no_gap", "INFO", history_gaps(versions, key)),
        row_rules,
    ])
    return checks.withColumn("passed", F.col("failures") == 0)
