"""Summaries over check results: report, gate, alerts and history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from tidemark.operators.quality.results import SEVERITIES, enforce
from tidemark.sources.stored import StoredTable


def quality_report(results: DataFrame, by: str | None = "table_name") -> DataFrame:
    """Totals, failures by severity, score and gate, per table or (``by=None``) over all.

    The gate fails on a CRITICAL failure only.
    """
    failed = ~F.col("passed")
    by_severity = [
        F.count_if(failed & (F.col("severity") == s)).alias(f"{s.lower()}_failures") for s in reversed(SEVERITIES)
    ]
    grouped = results.groupBy(by) if by else results.groupBy()
    report = grouped.agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if("passed").alias("passed_checks"),
        F.count_if(failed).alias("failed_checks"),
        *by_severity,
    )
    score = F.when(F.col("total_checks") > 0, F.col("passed_checks") * F.lit(100.0) / F.col("total_checks"))
    return report.withColumn("overall_quality_score", F.round(F.coalesce(score, F.lit(0.0)), 2)).withColumn(
        "quality_gate", F.when(F.col("critical_failures") == 0, "PASS").otherwise("FAIL")
    )


def report_alerts(report: DataFrame) -> DataFrame:
    """An alert text for every report with failed checks."""
    text = F.format_string(
        "Quality score %.2f%%, failed checks %d/%d, critical %d, warning %d, gate %s",
        "overall_quality_score", "failed_checks", "total_checks", "critical_failures", "warning_failures",
        "quality_gate",
    )
    return report.filter("failed_checks > 0").withColumn("alert", text)


def check_alerts(results: DataFrame) -> DataFrame:
    """One alert row per failed check."""
    impact = F.format_string("%d of %d rows failed (%.2f%%)", "rows_failed", "rows_checked", "failure_rate")
    return results.filter(~F.col("passed")).select(
        "check_type", "table_name", "severity", "failure_rate", "rows_checked", "rows_failed", "message",
        impact.alias("impact"), "execution_date",
    )


def store_results(results: DataFrame, path: str, run: str) -> None:
    """Store the results of one run; the same run again replaces what it stored."""
    StoredTable(results.sparkSession, path).replace(results.withColumn("run_id", F.lit(run)), "run_id", [run])


def read_results(spark: SparkSession, path: str, runs: Callable[[str], bool] = lambda run: True) -> DataFrame:
    """The stored results of the runs whose id ``runs`` accepts; the folders of other runs are neither listed nor scanned."""
    return StoredTable(spark, path).read(lambda entry: runs(entry.part))


def record(results: DataFrame, path: str, run: str) -> None:
    """Store results, failed ones too, and then raise on blocking failures."""
    store_results(results, path, run)
    enforce(read_results(results.sparkSession, path, lambda stored: stored == run))


def latest_results(stored: DataFrame, count: int = 10) -> DataFrame:
    """The newest stored results."""
    newest = stored.orderBy(F.desc("created_at"), "table_name", "check_type").limit(count)
    return newest.select("table_name", "check_type", "severity", "passed", "failure_rate", "created_at")


def score_trend(stored: DataFrame) -> DataFrame:
    """Quality score per table and run, with its change since the run before.

    The window runs over one row per run, not over the single results.
    """
    runs = stored.groupBy("table_name", "execution_date").agg(
        F.count(F.lit(1)).alias("total_checks"), F.count_if("passed").alias("passed_checks")
    )
    scored = runs.withColumn("score", F.col("passed_checks") * F.lit(100.0) / F.col("total_checks"))
    order = Window.partitionBy("table_name").orderBy("execution_date")
    return scored.withColumn("score_change", F.col("score") - F.lag("score").over(order))
