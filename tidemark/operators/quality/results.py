"""The one row layout every check reports in, and what follows from its severity."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

SEVERITIES = ("INFO", "WARNING", "ERROR", "CRITICAL")
BLOCKING = ("ERROR", "CRITICAL")

RESULT_COLUMNS = (
    "table_name string, check_type string, check_id string, severity string, passed boolean, value double, "
    "expected double, threshold double, rows_checked bigint, rows_failed bigint, failure_rate double, "
    "message string, metadata string, execution_date timestamp_ntz, created_at timestamp_ntz"
)


class QualityError(Exception):
    """A check of severity ERROR or CRITICAL failed."""


@dataclass(frozen=True)
class Verdict:
    """What a check makes of its metrics, all as column expressions."""

    passed: Column
    value: Column
    rows_checked: Column
    rows_failed: Column
    message: Column
    metadata: Mapping[str, Column] = field(default_factory=dict)


def check_settings(table: str, severity: str, threshold: float | None) -> None:
    """Raise with everything that is wrong with a check's settings."""
    faults = {
        "no table is named": not (table or "").strip(),
        f"severity {severity!r} is none of {', '.join(SEVERITIES)}": severity not in SEVERITIES,
        f"threshold {threshold} lies outside [0, 1]": threshold is not None and not 0.0 <= threshold <= 1.0,
    }
    if any(faults.values()):
        raise ValueError("; ".join(text for text, wrong in faults.items() if wrong))


def apply_threshold(passed: Column, value: Column, threshold: Column) -> Column:
    """A threshold replaces the check's own verdict, unless there is no value to compare."""
    return F.coalesce(value >= threshold, passed)


def result_struct(table: str, check_type: str, check_id: str, severity: str, threshold: float | None,
                  verdict: Verdict, as_of: Column, created_at: Column) -> Column:
    limit = F.lit(threshold).cast("double")
    passed = apply_threshold(verdict.passed, verdict.value, limit)
    checked, failed = verdict.rows_checked.cast("bigint"), verdict.rows_failed.cast("bigint")
    rate = F.when(checked > 0, failed * F.lit(100.0) / checked).otherwise(F.lit(0.0))
    details = [column.alias(name) for name, column in verdict.metadata.items()]
    metadata = F.to_json(F.struct(*details)) if details else F.lit("{}")
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check_type).alias("check_type"),
        F.lit(check_id).alias("check_id"),
        F.lit(severity).alias("severity"),
        passed.alias("passed"),
        verdict.value.cast("double").alias("value"),
        F.lit(1.0).alias("expected"),
        limit.alias("threshold"),
        checked.alias("rows_checked"),
        failed.alias("rows_failed"),
        rate.alias("failure_rate"),
        F.when(~passed, verdict.message).alias("message"),
        metadata.alias("metadata"),
        as_of.cast("timestamp_ntz").alias("execution_date"),
        created_at.cast("timestamp_ntz").alias("created_at"),
    )


def with_threshold(results: DataFrame, threshold: Column) -> DataFrame:
    """Re-judge stored results by another threshold column."""
    return results.withColumn("threshold", threshold).withColumn(
        "passed", apply_threshold(F.col("passed"), F.col("value"), F.col("threshold"))
    )


def blocking_failures(results: DataFrame) -> DataFrame:
    return results.filter(~F.col("passed") & F.col("severity").isin(*BLOCKING))


def enforce(results: DataFrame) -> None:
    """Raise when a check of severity ERROR or CRITICAL failed, naming all that did.

    Results are those of one run: one row per check.
    """
    failed = blocking_failures(results).select("severity", "message").collect()
    if failed:
        raise QualityError("; ".join(f"{row.severity}: {row.message}" for row in failed))
