"""The checks: each declares aggregates over its table and a verdict on them.

``run_checks`` puts the aggregates of all checks that read the same rows into one
``agg``, predicates included, so a suite costs one scan, and one more per partition that a check names. Uniqueness needs a shuffle on
its own key and runs as a separate aggregation.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import (
    ADDRESS, CASTABLE, age_hours, named_family, percent, type_family,
)
from tidemark.operators.quality.results import Verdict, check_settings, result_struct
from tidemark.sources.tables import reduce_union

Metrics = Callable[[str], Column]


def _rows(*conditions: Column | None) -> Column:
    """The number of rows that meet all the conditions given."""
    given = [condition for condition in conditions if condition is not None]
    return F.count_if(reduce(lambda a, b: a & b, given)) if given else F.count(F.lit(1))


def _score(condition: Column) -> Column:
    return F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0))


@dataclass(frozen=True, kw_only=True)
class Check:
    table: str
    severity: str = "ERROR"
    threshold: float | None = None
    where: str | None = None

    kind = "check"

    def __post_init__(self) -> None:
        check_settings(self.table, self.severity, self.threshold)

    def scope(self) -> tuple[str | tuple[str, object], ...]:
        """The row filters of this check: a predicate, and (column, value) pairs that name partitions."""
        return (self.where,) if self.where else ()

    def within(self) -> Column | None:
        return F.expr(f"({self.where})") if self.where else None

    def identity(self) -> str:
        """What tells this check from others of its kind on the table: its rows and columns, not its limits."""
        return json.dumps([self.kind, [str(part) for part in self.scope()], list(getattr(self, "columns_named", lambda: ())())])

    def metrics(self, df: DataFrame, within: Column | None = None) -> dict[str, Column]:
        """Aggregates over ``df``, restricted to the rows ``within``."""
        raise NotImplementedError

    def verdict(self, m: Metrics, df: DataFrame, as_of: Column, history: DataFrame | None) -> Verdict:
        raise NotImplementedError


@dataclass(frozen=True, kw_only=True)
class Schema(Check):
    """Columns, types, nullability and order against an expectation.

    ``columns`` lists ``{"name", "type", "nullable"}``, of which only the name must be
    given. Names, types and order are compared on the DataFrame's schema. With ``castable`` a text column satisfies a
    non-text type when every value casts to it, which is what landing files need.
    File formats declare every column nullable, so nullability is judged by the rows:
    a column expected not null must hold no NULL.
    """

    columns: Sequence[Mapping]
    check_types: bool = True
    check_nullability: bool = False
    check_column_order: bool = False
    allow_extra_columns: bool = False
    castable: bool = False

    kind = "schema"

    def __post_init__(self) -> None:
        super().__post_init__()
        if not self.columns:
            raise ValueError("at least one expected column is required")
        for column in self.columns:
            if "name" not in column:
                raise ValueError(f"an expected column needs a name: {column}")

    def _present(self, df: DataFrame) -> dict[str, Mapping]:
        return {c["name"]: c for c in self.columns if c["name"] in df.columns}

    def _cast_target(self, df: DataFrame, column: Mapping) -> str | None:
        if not (self.castable and self.check_types and "type" in column):
            return None
        actual = type_family(df.schema[column["name"]].dataType)
        expected = named_family(column["type"])
        return CASTABLE.get(expected) if actual == "VARCHAR" and expected != actual else None

    def metrics(self, df: DataFrame, within: Column | None = None) -> dict[str, Column]:
        found = {"rows": _rows(within)}
        for position, (name, column) in enumerate(self._present(df).items()):
            target = self._cast_target(df, column)
            if target:
                bad = F.col(name).isNotNull() & F.col(name).try_cast(target).isNull()
                found[f"cast{position}"] = _rows(within, bad)
            if self.check_nullability and not column.get("nullable", True):
                found[f"null{position}"] = _rows(within, F.col(name).isNull())
        return found

    def verdict(self, m, df, as_of, history):
        wanted = [c["name"] for c in self.columns]
        missing = [n for n in wanted if n not in df.columns]
        extra = [] if self.allow_extra_columns else [n for n in df.columns if n not in wanted]
        common = [n for n in wanted if n in df.columns]
        misplaced = self.check_column_order and common != [n for n in df.columns if n in wanted]

        mismatches, nulls = [], []
        rows = m("rows")
        for position, (name, column) in enumerate(self._present(df).items()):
            if self.check_types and "type" in column:
                actual = type_family(df.schema[name].dataType)
                target = self._cast_target(df, column)
                detail = F.struct(F.lit(name).alias("column"), F.lit(named_family(column["type"])).alias("expected"), F.lit(actual).alias("actual"))
                if target:
                    mismatches.append(F.when(m(f"cast{position}") > 0, detail))
                elif actual != named_family(column["type"]):
                    mismatches.append(detail)
            if self.check_nullability and not column.get("nullable", True):
                nulls.append(F.when(m(f"null{position}") > 0, F.lit(name)))

        def listed(found: list[Column], kind: str) -> Column:
            return F.array_compact(F.array(*found)) if found else F.array().cast(f"array<{kind}>")

        bad_types = listed(mismatches, "struct<column:string,expected:string,actual:string>")
        bad_nulls = listed(nulls, "string")
        fixed = not missing and not extra and not misplaced
        passed = F.lit(fixed) & (F.size(bad_types) == 0) & (F.size(bad_nulls) == 0)
        parts = []
        if missing:
            parts.append(F.lit("columns not found: " + ", ".join(missing)))
        if extra:
            parts.append(F.lit("unexpected columns: " + ", ".join(extra)))
        if misplaced:
            parts.append(F.lit("column order differs"))
        parts.append(F.when(F.size(bad_types) > 0, F.format_string("type differs in %d column(s)", F.size(bad_types))))
        parts.append(
            F.when(F.size(bad_nulls) > 0, F.format_string("NULLs in %d required column(s)", F.size(bad_nulls)))
        )
        return Verdict(
            passed=passed,
            value=_score(passed),
            rows_checked=rows,
            rows_failed=F.lit(0),
            message=F.concat_ws("; ", *parts),
            metadata={
                "missing_columns": F.array(*[F.lit(n) for n in missing]).cast("array<string>"),
                "extra_columns": F.array(*[F.lit(n) for n in extra]).cast("array<string>"),
                "type_mismatches": bad_types,
                "nullability_mismatches": bad_nulls,
                "total_columns": F.lit(len(df.columns)),
                "expected_columns": F.lit(len(wanted)),
            },
        )


@dataclass(frozen=True, kw_only=True)
class Completeness(Check):
    """Row count against an expected number, bounds, or the previous run.

    A tolerance always yields bounds around the expected count; ``min_count`` and
    ``max_count`` tighten them. Without a tolerance the expected count must be met exactly.
    """

    expected_count: int | None = None
    min_count: int | None = None
    max_count: int | None = None
    tolerance_percent: float | None = None
    partition_column: str | None = None
    partition_value: object = None
    compare_with_previous: bool = False
    comparison_tolerance_percent: float | None = None

    kind = "completeness"

    def scope(self):
        parts = list(super().scope())
        if self.partition_column and self.partition_value is not None:
            parts.append((self.partition_column, self.partition_value))
        return tuple(parts)

    def bounds(self) -> tuple[int | None, int | None]:
        lows = [self.min_count] if self.min_count is not None else []
        highs = [self.max_count] if self.max_count is not None else []
        if self.expected_count is not None:
            slack = int(self.expected_count * (self.tolerance_percent or 0.0) / 100.0)
            lows.append(self.expected_count - slack)
            highs.append(self.expected_count + slack)
        return max(lows, default=None), min(highs, default=None)

    def metrics(self, df, within=None):
        return {"rows": _rows(within)}

    def previous_count(self, history: DataFrame, as_of: Column) -> Column:
        """The row count of the latest earlier result of the same check: same table, filter and partition."""
        earlier = history.filter(
            (F.col("table_name") == self.table) & (F.col("check_id") == self.identity())
            & (F.col("execution_date") < as_of)
        )
        order = F.struct("execution_date", "created_at", "rows_checked")
        return earlier.agg(F.max_by("rows_checked", order).alias("rows")).scalar()

    def verdict(self, m, df, as_of, history):
        rows = m("rows")
        low, high = self.bounds()
        enough = rows >= low if low is not None else F.lit(True)
        few = rows <= high if high is not None else F.lit(True)
        passed = enough & few
        metadata = {
            "actual_count": rows,
            "expected_count": F.lit(self.expected_count).cast("bigint"),
            "min_count": F.lit(low).cast("bigint"),
            "max_count": F.lit(high).cast("bigint"),
        }
        drifted = F.lit(False)
        if self.compare_with_previous and history is not None:
            before = self.previous_count(history, as_of)
            change = F.when(before > 0, (rows - before) * F.lit(100.0) / before).when(
                before.isNotNull(), F.lit(0.0)
            )
            metadata["previous_count"] = before
            metadata["percent_change"] = F.round(change, 2)
            if self.comparison_tolerance_percent is not None:
                drifted = F.coalesce(F.abs(change) > self.comparison_tolerance_percent, F.lit(False))
        passed = passed & ~drifted
        if self.expected_count:
            value = F.least(F.lit(1.0), rows / F.lit(self.expected_count))
        else:
            value = _score(passed)
        messages = [
            F.when(~enough, F.format_string("%d rows, at least %d wanted", rows, F.lit(low or 0))),
            F.when(~few, F.format_string("%d rows, at most %d wanted", rows, F.lit(high or 0))),
            F.when(drifted, F.format_string("%d rows, too far from the run before", rows)),
        ]
        return Verdict(passed, value, rows, F.lit(0), F.concat_ws("; ", *messages), metadata)


@dataclass(frozen=True, kw_only=True)
class Freshness(Check):
    """Age of the newest timestamp at ``as_of``; no timestamp at all is a failure."""

    columns: Sequence[str]
    max_age_hours: float | None = None
    max_age_minutes: float | None = None
    sla_hours: float | None = None

    kind = "freshness"

    def __post_init__(self):
        super().__post_init__()
        if not self.columns:
            raise ValueError("a timestamp column is required")

    def columns_named(self):
        return self.columns

    def limit(self) -> float | None:
        if self.max_age_hours is None and self.max_age_minutes is not None:
            return self.max_age_minutes / 60.0
        return self.max_age_hours

    def metrics(self, df, within=None):
        moments = [F.col(c).cast("timestamp_ntz") for c in self.columns]
        newest = {f"newest{n}": F.max(m if within is None else F.when(within, m)) for n, m in enumerate(moments)}
        return {"rows": _rows(within), **newest}

    def verdict(self, m, df, as_of, history):
        moments = [m(f"newest{n}") for n in range(len(self.columns))]
        newest = F.greatest(*moments) if len(moments) > 1 else moments[0]
        raw = age_hours(newest, as_of)
        age = F.round(raw, 2)
        limit = self.limit()
        fresh = age <= limit if limit is not None else F.lit(True)
        passed = F.coalesce(newest.isNotNull() & fresh, F.lit(False))
        if limit:
            value = F.round(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1.0 - age / F.lit(float(limit)))), 3)
        else:
            value = _score(passed)
        each = [moment.cast("string").alias(c) for c, moment in zip(self.columns, moments, strict=True)]
        metadata = {
            "timestamps": F.struct(*each),
            "max_timestamp": newest.cast("string"),
            "age_hours": age,
            "age_minutes": F.round(raw * 60, 2),
            "no_data": newest.isNull(),
            "future": newest > as_of,
        }
        if self.sla_hours is not None:
            metadata["sla_compliant"] = age <= self.sla_hours
            metadata["sla_hours"] = F.lit(float(self.sla_hours))
        stale = F.format_string("newest row is %.1f hours old, limit %s", age, F.lit(f"{limit}"))
        message = F.when(newest.isNull(), F.lit(f"no timestamp in {self.table}")).otherwise(stale)
        value = F.when(newest.isNull(), F.lit(0.0)).otherwise(value)
        return Verdict(passed, value, m("rows"), F.lit(0), message, metadata)


@dataclass(frozen=True, kw_only=True)
class NullRate(Check):
    """Share of NULLs in one or more columns, all counted in the same pass.

    ``limits`` may set a percentage per column; the others use ``max_null_percentage``.
    ``pooled`` judges the rate over all cells by ``max_null_percentage`` instead of each column.
    """

    columns: Sequence[str]
    max_null_percentage: float = 100.0
    limits: Mapping[str, float] | None = None
    expect_not_null: bool = False
    pooled: bool = False

    kind = "null_rate"

    def __post_init__(self):
        super().__post_init__()
        if not self.columns:
            raise ValueError("at least one column is required")

    def columns_named(self):
        return self.columns

    def limit(self, column: str) -> float:
        if self.expect_not_null:
            return 0.0
        return float((self.limits or {}).get(column, self.max_null_percentage))

    def metrics(self, df, within=None):
        nulls = {f"null{n}": _rows(within, F.col(c).isNull()) for n, c in enumerate(self.columns)}
        some = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])
        return {"rows": _rows(within), "some": _rows(within, some), **nulls}

    def verdict(self, m, df, as_of, history):
        rows = m("rows")
        counts = [m(f"null{n}") for n in range(len(self.columns))]
        rates = [percent(count, rows) for count in counts]
        cells = rows * len(counts)
        total = reduce(lambda a, b: a + b, counts)
        if self.pooled:
            limit = 0.0 if self.expect_not_null else float(self.max_null_percentage)
            over = [F.when(percent(total, cells) > limit, F.lit("all columns"))]
        else:
            over = [
                F.when(rate > self.limit(c), F.lit(c)) for c, rate in zip(self.columns, rates, strict=True)
            ]
        failed = F.array_compact(F.array(*over))
        empty = rows == 0
        passed = F.when(empty, F.lit(not self.expect_not_null)).otherwise(F.size(failed) == 0)
        average = reduce(lambda a, b: a + b, [1.0 - r / 100.0 for r in rates]) / len(rates)
        message = F.when(empty, F.lit(f"{self.table} has no rows")).otherwise(
            F.format_string(
                "too many NULLs in %d column(s): %s", F.size(failed), F.concat_ws(", ", failed)
            )
        )
        by_name = [F.round(r, 2).alias(c) for c, r in zip(self.columns, rates, strict=True)]
        counted = [n.alias(c) for c, n in zip(self.columns, counts, strict=True)]
        return Verdict(
            passed=passed,
            value=F.when(empty, F.lit(0.0)).otherwise(F.round(average, 3)),
            rows_checked=rows,
            rows_failed=m("some"),
            message=message,
            metadata={
                "null_counts": F.struct(*counted),
                "null_rates": F.struct(*by_name),
                "failed_columns": failed,
                "null_rate": F.round(percent(total, cells), 4),
            },
        )


@dataclass(frozen=True, kw_only=True)
class Rule(Check):
    """A row predicate such as a domain, a range or an arithmetic identity.

    As with a table constraint only a predicate that is false counts; NULL passes.
    """

    name: str
    predicate: str

    @property
    def kind(self) -> str:
        return f"rule:{self.name}"

    def metrics(self, df, within=None):
        return {"rows": _rows(within), "broken": _rows(within, ~F.expr(f"({self.predicate})"))}

    def verdict(self, m, df, as_of, history):
        rows, broken = m("rows"), m("broken")
        passed = broken == 0
        share = F.when(rows > 0, 1.0 - broken / rows).otherwise(F.lit(1.0))
        message = F.format_string("%d row(s) break rule %s", broken, F.lit(self.name))
        return Verdict(passed, F.round(share, 3), rows, broken, message, {"predicate": F.lit(self.predicate)})


def email_rule(table: str, column: str, **settings) -> Rule:
    return Rule(table=table, name=f"{column}_format", predicate=f"{column} rlike r'{ADDRESS}'", **settings)


@dataclass(frozen=True, kw_only=True)
class Uniqueness(Check):
    """Surplus rows per key.

    NULL keys are left out by default. Otherwise NULLs equal each other, unless
    ``null_as_distinct`` lets every row with a NULL key part stand for itself.
    ``digest_keys`` counts text keys by their SHA-256, so that long texts are not sent
    through the shuffle. ``return_duplicates`` puts the most repeated keys, ``listed`` of them, into the metadata.
    """

    columns: Sequence[str]
    max_duplicate_percentage: float = 0.0
    exclude_nulls: bool = True
    null_as_distinct: bool = False
    case_sensitive: bool = True
    trim_whitespace: bool = False
    digest_keys: bool = False
    return_duplicates: bool = False
    listed: int = 100

    kind = "uniqueness"

    def __post_init__(self):
        super().__post_init__()
        if not self.columns:
            raise ValueError("key columns must contain at least one column")
        for column in self.columns:
            if not column.replace("_", "a").isalnum() or column[0].isdigit():
                raise ValueError(f"not a column name: {column!r}")

    def columns_named(self):
        return self.columns

    def key(self, column: str) -> Column:
        key = F.col(column)
        if self.trim_whitespace:
            key = F.trim(key)
        return key if self.case_sensitive else F.upper(key)

    def per_key(self, df: DataFrame, digest: bool = False) -> DataFrame:
        """Row count ``n`` per normalised key; partial counts keep a frequent key cheap."""
        if self.where:
            df = df.filter(F.expr(self.where))
        if self.exclude_nulls:
            df = df.dropna(subset=list(self.columns))
        texts = {f.name for f in df.schema.fields if digest and type_family(f.dataType) == "VARCHAR"}
        keys = df.select(*[
            (F.sha2(self.key(c), 256) if c in texts else self.key(c)).alias(c) for c in self.columns
        ])
        return keys.groupBy(*self.columns).agg(F.count(F.lit(1)).alias("n"))

    def totals(self, df: DataFrame) -> DataFrame:
        surplus = F.col("n") - 1
        if self.null_as_distinct:
            partial = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in self.columns])
            surplus = F.when(partial, F.lit(0)).otherwise(surplus)
        return self.per_key(df, self.digest_keys).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(surplus), F.lit(0)).alias("surplus"),
            F.count_if(surplus > 0).alias("keys"),
        )

    def verdict(self, m, df, as_of, history):
        rows, surplus = m("rows"), m("surplus")
        rate = percent(surplus, rows)
        message = F.format_string(
            "%d surplus row(s), %.2f%% of all, limit %s%%",
            surplus, rate, F.lit(f"{self.max_duplicate_percentage}"),
        )
        metadata = {
            "key_columns": F.lit(json.dumps(list(self.columns))),
            "duplicate_count": surplus,
            "duplicate_keys": m("keys"),
            "duplicate_percentage": F.round(rate, 2),
        }
        if self.return_duplicates:
            top = self.duplicates(df, self.listed).agg(
                F.reverse(F.array_sort(F.collect_list(F.struct("count", *self.columns)))).alias("top"))
            metadata["duplicates"] = top.scalar()
        return Verdict(
            passed=rate <= self.max_duplicate_percentage,
            value=F.round(1.0 - rate / 100.0, 3),
            rows_checked=rows,
            rows_failed=surplus,
            message=message,
            metadata=metadata,
        )

    def duplicates(self, df: DataFrame, limit: int = 100) -> DataFrame:  # a top-k report
        """The most repeated keys, in their normalised form."""
        repeated = self.per_key(df).filter("n > 1").withColumnRenamed("n", "count")
        return repeated.orderBy(F.desc("count"), *self.columns).limit(limit)


def run_checks(
    df: DataFrame,
    checks: Sequence[Check],
    as_of: str | Column,
    created_at: str | Column | None = None,
    history: DataFrame | None = None,
) -> DataFrame:
    """One result row per check on one table. ``history`` feeds comparisons with earlier runs."""
    def moment(value):
        return F.lit(value).cast("timestamp_ntz") if isinstance(value, str) else value

    now = moment(as_of)
    created = now if created_at is None else moment(created_at)

    def report(check: Check, prefix: str = "") -> Column:
        found = check.verdict(lambda name: F.col(prefix + name), df, now, history)
        return result_struct(check.table, check.kind, check.identity(), check.severity, check.threshold, found, now, created)

    frames = []
    scopes: dict[tuple, list[Check]] = {}
    for check in checks:
        if isinstance(check, Uniqueness):
            frames.append(check.totals(df).select(F.inline(F.array(report(check)))))
        else:
            # Partitions are read on their own, so that they can be pruned; predicates are counted in one scan.
            partition = tuple(part for part in check.scope() if not isinstance(part, str))
            scopes.setdefault(partition, []).append(check)
    for partition, members in scopes.items():
        rows = reduce(lambda d, part: d.filter(F.col(part[0]) == F.lit(part[1])), partition, df)
        wanted = [
            metric.alias(f"c{n}_{name}")
            for n, check in enumerate(members)
            for name, metric in check.metrics(df, check.within()).items()
        ]
        reports = [report(check, f"c{n}_") for n, check in enumerate(members)]
        frames.append(rows.agg(*wanted).select(F.inline(F.array(*reports))))
    return reduce_union(frames)


def null_rates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Null count and percentage per column, one row each, from one scan."""
    counted = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col(c).isNull()).alias(f"n{n}") for n, c in enumerate(columns)],
    )
    rows = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{n}").alias("null_count")) for n, c in enumerate(columns)]
    return counted.select("total", F.inline(F.array(*rows))).select(
        "column_name",
        F.col("total").alias("total_count"),
        "null_count",
        F.round(percent(F.col("null_count"), F.col("total")), 2).alias("null_percentage"),
    )
