"""Declarative suites: check lists from JSON, and expectation lists."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.quality.checks import (
    Check, Completeness, Freshness, NullRate, Schema, Uniqueness, run_checks,
)
from tidemark.sources.tables import reduce_union

# The names a suite may call each kind of check by.
CHECK_NAMES = {
    "schema": ("schema", "SchemaValidator", "SchemaValidationOperator"),
    "completeness": ("completeness", "CompletenessChecker", "CompletenessCheckOperator"),
    "freshness": ("freshness", "FreshnessChecker", "FreshnessCheckOperator"),
    "uniqueness": ("uniqueness", "UniquenessChecker", "UniquenessCheckOperator"),
    "null_rate": ("null_rate", "NullRateChecker", "NullRateCheckOperator"),
}


def check_kind(name: str) -> str:
    for kind, names in CHECK_NAMES.items():
        if name in names:
            return kind
    raise ValueError(f"unknown check {name!r}")


def _first(entry: Mapping, *names, default=None):
    for name in names:
        if entry.get(name) is not None:
            return entry[name]
    return default


def _columns(value) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _schema(entry: Mapping, common: dict) -> Check:
    if "expected_schema" in entry:
        columns = entry["expected_schema"]["columns"]
    else:
        types = entry.get("expected_types") or {}
        columns = [
            {"name": n, **({"type": types[n]} if n in types else {})} for n in entry["expected_columns"]
        ]
    flags = ("check_types", "check_nullability", "check_column_order", "allow_extra_columns", "castable")
    return Schema(columns=columns, **{f: entry[f] for f in flags if f in entry}, **common)


def _completeness(entry: Mapping, common: dict) -> Check:
    tolerance = entry.get("tolerance_percent")
    if tolerance is None and entry.get("row_count_tolerance") is not None:
        tolerance = entry["row_count_tolerance"] * 100.0
    same = (
        "partition_column", "partition_value", "compare_with_previous", "comparison_tolerance_percent",
    )
    return Completeness(
        expected_count=_first(entry, "expected_count", "expected_row_count"),
        min_count=_first(entry, "min_count", "min_row_count"),
        max_count=_first(entry, "max_count", "max_row_count"),
        tolerance_percent=tolerance,
        **{name: entry[name] for name in same if name in entry},
        **common,
    )


def _freshness(entry: Mapping, common: dict) -> Check:
    hours = entry.get("max_age_hours")
    if hours is None and entry.get("max_age_seconds") is not None:
        hours = entry["max_age_seconds"] / 3600.0
    return Freshness(
        columns=_columns(_first(entry, "timestamp_columns", "timestamp_column")),
        max_age_hours=hours,
        max_age_minutes=entry.get("max_age_minutes"),
        sla_hours=entry.get("sla_hours"),
        **common,
    )


def _uniqueness(entry: Mapping, common: dict) -> Check:
    same = ("max_duplicate_percentage", "exclude_nulls", "case_sensitive", "trim_whitespace", "null_as_distinct",
            "digest_keys", "return_duplicates")
    return Uniqueness(
        columns=_columns(_first(entry, "key_columns", "unique_columns")),
        **{name: entry[name] for name in same if name in entry},
        **common,
    )


def _null_rate(entry: Mapping, common: dict) -> Check:
    columns = _first(entry, "columns", "column_name")
    limits = None
    if isinstance(columns, Mapping):  # rates from 0 to 1 per column
        limits = {name: rate * 100.0 for name, rate in columns.items()}
    same = ("max_null_percentage", "expect_not_null", "pooled")
    return NullRate(
        columns=_columns(columns if not isinstance(columns, Mapping) else columns.keys()),
        limits=limits,
        **{name: entry[name] for name in same if name in entry},
        **common,
    )


BUILDERS: dict[str, Callable[[Mapping, dict], Check]] = {
    "schema": _schema,
    "completeness": _completeness,
    "freshness": _freshness,
    "uniqueness": _uniqueness,
    "null_rate": _null_rate,
}

# Severity of a suite entry that names none.
DEFAULT_SEVERITY = {
    "schema": "CRITICAL",
    "completeness": "WARNING",
    "freshness": "WARNING",
    "uniqueness": "CRITICAL",
    "null_rate": "WARNING",
}


def build_check(entry: Mapping) -> Check:
    kind = check_kind(_first(entry, "check", "operator", "type"))
    common = {
        "table": _first(entry, "table", "table_name"),
        "severity": _first(entry, "severity", default=DEFAULT_SEVERITY[kind]),
        "threshold": entry.get("threshold"),
        "where": _first(entry, "where", "where_clause"),
    }
    return BUILDERS[kind](entry, common)


def load_suite(text: str) -> list[Check]:
    """Checks from a JSON list, or from an object with a ``checks`` list."""
    config = json.loads(text)
    return [build_check(entry) for entry in (config["checks"] if isinstance(config, dict) else config)]


def run_suite(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], as_of: str, history: DataFrame | None = None
) -> DataFrame:
    """Results of a whole suite; each table is scanned once per distinct filter."""
    by_table: dict[str, list[Check]] = {}
    for check in checks:
        by_table.setdefault(check.table, []).append(check)
    return reduce_union(
        [run_checks(tables[name], members, as_of, history=history) for name, members in by_table.items()]
    )


# An expectation turns its arguments into a condition every row must meet.
EXPECTATIONS: dict[str, Callable[[Mapping], Column]] = {}


def register_expectation(name: str, condition: Callable[[Mapping], Column]) -> None:
    EXPECTATIONS[name] = condition


def _between(kwargs: Mapping) -> Column:
    column = F.col(kwargs["column"])
    low, high = kwargs.get("min_value"), kwargs.get("max_value")
    inside = F.lit(True)
    if low is not None:
        inside = inside & (column >= F.lit(low))
    if high is not None:
        inside = inside & (column <= F.lit(high))
    return inside


register_expectation("expect_column_values_to_be_between", _between)
UNIQUE = "expect_column_values_to_be_unique"
ORDERED = "expect_table_columns_to_match_ordered_list"


def load_expectations(text: str) -> list[dict]:
    """Expectations from a JSON list or an object with an ``expectations`` list."""
    config = json.loads(text)
    if isinstance(config, Mapping) and "expectations" in config:
        config = config["expectations"]
        if isinstance(config, Mapping):
            config = config["expectations"]
    if not isinstance(config, list):
        raise ValueError("expected a list of expectations or an object holding one")
    return config


def read_expectations(spark: SparkSession, path: str) -> list[dict]:
    """The expectations of one JSON file, or of all files of a folder in order of their names."""
    files = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    texts = [row.value for row in files.orderBy("file").collect()]
    if not texts:
        raise FileNotFoundError(path)
    return [expectation for text in texts for expectation in load_expectations(text)]


def run_expectations(df: DataFrame, expectations: Sequence[Mapping]) -> DataFrame:
    """One row per expectation: position, type, success, rows seen and unexpected rows.

    Row conditions share one scan. NULLs meet any row condition and are left out of
    uniqueness; a row is unexpected there when its value occurs more than once.
    """
    shared, unique_frames = [], []
    layout = ("position", "expectation_type", "success", "element_count", "unexpected_count")

    def row(position: int, kind: str, success: Column, seen: Column, unexpected: Column) -> Column:
        values = (F.lit(position), F.lit(kind), success, seen.cast("bigint"), unexpected.cast("bigint"))
        return F.struct(*[v.alias(n) for v, n in zip(values, layout, strict=True)])

    metrics, rows = [F.count(F.lit(1)).alias("rows")], []
    for position, expectation in enumerate(expectations, start=1):
        kind, kwargs = expectation["expectation_type"], expectation.get("kwargs", {})
        if kind == UNIQUE:
            keys = df.select(F.col(kwargs["column"]).alias("v")).filter("v IS NOT NULL").groupBy("v")
            totals = keys.agg(F.count(F.lit(1)).alias("n")).agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("seen"),
                F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("bad"),
            )
            found = row(position, kind, F.col("bad") == 0, F.col("seen"), F.col("bad"))
            unique_frames.append(totals.select(F.inline(F.array(found))))
        elif kind == ORDERED:
            same = list(kwargs["column_list"]) == df.columns
            rows.append(row(position, kind, F.lit(same), F.col("rows"), F.lit(0)))
        elif kind in EXPECTATIONS:
            metrics.append(F.count_if(~EXPECTATIONS[kind](kwargs)).alias(f"bad{position}"))
            bad = F.col(f"bad{position}")
            rows.append(row(position, kind, bad == 0, F.col("rows"), bad))
        else:
            raise ValueError(f"unknown expectation {kind!r}")
    if rows:
        shared.append(df.agg(*metrics).select(F.inline(F.array(*rows))))
    return reduce_union(shared + unique_frames)


def expectation_statistics(results: DataFrame) -> DataFrame:
    """Evaluated, successful and unsuccessful expectations, success rate and a summary text."""
    totals = results.agg(
        F.count(F.lit(1)).alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.sort_array(
            F.collect_list(F.when(~F.col("success"), F.struct("position", "expectation_type")))
        ).alias("failed"),
    )
    evaluated, good = F.col("evaluated_expectations"), F.col("successful_expectations")
    rate = F.when(evaluated > 0, good * F.lit(100.0) / evaluated).otherwise(F.lit(0.0))
    named = F.transform("failed", lambda f: f["expectation_type"])
    summary = F.format_string(
        "%s: %d of %d expectations met (%.1f%%)",
        F.when((good == evaluated) & (evaluated > 0), "PASSED").otherwise("FAILED"), good, evaluated, rate,
    )
    return totals.select(
        ((good == evaluated) & (evaluated > 0)).alias("success"),
        evaluated,
        good,
        (evaluated - good).alias("unsuccessful_expectations"),
        rate.alias("success_percent"),
        F.concat_ws("; failed: ", summary, F.when(F.size(named) > 0, F.concat_ws(", ", named))).alias("summary"),
    )
