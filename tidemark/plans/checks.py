"""Data-quality queries."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from tidemark.operators.quality import relations, reporting, results, suites
from tidemark.operators.quality.checks import (
    Completeness, Freshness, NullRate, Rule, Schema, Uniqueness, email_rule, null_rates, run_checks,
)
from tidemark.plans.generators import ids
from tidemark.plans.registry import plain, query
from tidemark.session import workspace
from tidemark.sources import generate, star
from tidemark.sources.tables import reduce_union

AS_OF = "2024-01-31 00:00:00"
VERDICT = (
    "table_name", "check_type", "severity", "passed", "value", "rows_checked", "rows_failed", "failure_rate", "message",
)


def verdicts(found, **details):
    """The comparable result columns, plus fields taken out of the JSON metadata."""
    extra = [F.get_json_object("metadata", f"$.{name}").cast(kind).alias(name) for name, kind in details.items()]
    return found.select(*VERDICT, *extra)


def _row(table, kind, severity, passed, value, checked, failed, message, more=""):
    """SQL for one result row over a one-row source."""
    rate = f"CASE WHEN {checked} > 0 THEN {failed} * 100.0::DOUBLE / {checked} ELSE 0.0::DOUBLE END"
    return f"""
        SELECT '{table}' AS table_name, '{kind}' AS check_type, '{severity}' AS severity, {passed} AS passed,
               CAST({value} AS DOUBLE) AS value, CAST({checked} AS BIGINT) AS rows_checked,
               CAST({failed} AS BIGINT) AS rows_failed, {rate} AS failure_rate,
               CASE WHEN NOT ({passed}) THEN {message} END AS message{more}
    """


def orders_with_gaps(spark, folder):
    """Orders whose lowest priority is missing."""
    orders = star.table(spark, folder, "orders")
    return orders.withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))


GAPPY = "(SELECT * REPLACE (nullif(o_orderpriority, '5-LOW') AS o_orderpriority) FROM orders)"

SCHEMA_PASSED = "(bad_prices = 0 AND nulls = 0 AND FALSE)"


@query("dq_schema", f"""
    WITH m AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus = 'P') AS bad_prices,
                      COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS nulls FROM {GAPPY})
    {_row("orders", "schema", "CRITICAL", SCHEMA_PASSED, "0.0", "n", "0",
          "concat_ws('; ', 'columns not found: email', 'unexpected columns: o_custkey', "
          "CASE WHEN bad_prices > 0 THEN 'type differs in 1 column(s)' END, "
          "CASE WHEN nulls > 0 THEN 'NULLs in 1 required column(s)' END)", """,
           '["email"]' AS missing_columns, '["o_custkey"]' AS extra_columns,
           CASE WHEN bad_prices > 0 THEN '[{"column":"o_totalprice","expected":"NUMERIC","actual":"VARCHAR"}]' ELSE '[]' END
               AS type_mismatches,
           CASE WHEN nulls > 0 THEN '["o_orderpriority"]' ELSE '[]' END AS nullability_mismatches""")} FROM m""")
def dq_schema(spark, folder):
    """Orders as a text landing file: prices of pending orders are not numbers."""
    landed = orders_with_gaps(spark, folder).select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.col("o_orderdate").cast("string").alias("o_orderdate"), "o_orderpriority",
    )
    expected = [
        {"name": "o_orderkey", "type": "bigint", "nullable": False},
        {"name": "o_totalprice", "type": "numeric"},
        {"name": "o_orderdate", "type": "timestamp without time zone"},
        {"name": "o_orderpriority", "type": "text", "nullable": False},
        {"name": "email", "type": "text"},
    ]
    check = Schema(table="orders", severity="CRITICAL", columns=expected, check_nullability=True, castable=True)
    return verdicts(run_checks(landed, [check], AS_OF), missing_columns="string", extra_columns="string",
                    type_mismatches="string", nullability_mismatches="string")


def _count_message(low, high):
    return (f"concat_ws('; ', CASE WHEN n < {low} THEN printf('%d rows, at least {low} wanted', n) END, "
            f"CASE WHEN n > {high} THEN printf('%d rows, at most {high} wanted', n) END)")


def _bounded(name, severity, low, high, source, expected=None):
    passed = f"(n BETWEEN {low} AND {high})"
    value = f"least(1.0::DOUBLE, n / {expected}::DOUBLE)" if expected else f"CASE WHEN {passed} THEN 1 ELSE 0 END"
    row = _row(name, "completeness", severity, passed, value, "n", "0", _count_message(low, high))
    return f"{row} FROM (SELECT COUNT(*) AS n FROM {source})"


@query("dq_completeness", " UNION ALL ".join([
    _bounded("lineitem", "ERROR", 57000, 63000, "lineitem", 60000),
    _bounded("lineitem", "WARNING", 25000, 1000000000, "lineitem WHERE l_returnflag = 'R'"),
    _bounded("lineitem", "INFO", 27000, 33000, "lineitem WHERE l_linestatus = 'F'", 30000),
]))
def dq_completeness(spark, folder):
    checks = [
        Completeness(table="lineitem", expected_count=60000, tolerance_percent=5.0),
        Completeness(table="lineitem", severity="WARNING", where="l_returnflag = 'R'", min_count=25000,
                     max_count=1000000000),
        Completeness(table="lineitem", severity="INFO", expected_count=30000, tolerance_percent=10.0,
                     partition_column="l_linestatus", partition_value="F"),
    ]
    return verdicts(run_checks(star.table(spark, folder, "lineitem"), checks, AS_OF))


PREVIOUS_PASSED = "(abs((n - p) * 100.0::DOUBLE / p) <= 10)"


@query("dq_completeness_prev", f"""
    WITH m AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderdate < '2000-06-01') AS p FROM orders)
    {_row("orders", "completeness", "WARNING", PREVIOUS_PASSED, f"CASE WHEN {PREVIOUS_PASSED} THEN 1 ELSE 0 END",
          "n", "0", "printf('%d rows, too far from the run before', n)",
          ", p AS previous_count, round((n - p) * 100.0::DOUBLE / p, 2) AS percent_change")} FROM m""")
def dq_completeness_prev(spark, folder):
    orders = star.table(spark, folder, "orders")
    earlier = orders.filter(F.col("o_orderdate") < F.lit("2000-06-01").cast("timestamp_ntz"))
    oldest = orders.filter(F.col("o_orderdate") < F.lit("1999-06-01").cast("timestamp_ntz"))
    plain_check = Completeness(table="orders", min_count=1)
    # Other checks of the same kind and table are stored beside it, and one run is stored twice.
    pending = Completeness(table="orders", where="o_orderstatus = 'P'", min_count=1)
    path = workspace(spark, "completeness_results")
    for rows, day in ((earlier, "2000-06-01"), (oldest, "1999-06-01"), (earlier, "2000-06-01")):
        reporting.store_results(run_checks(rows, [plain_check, pending], f"{day} 00:00:00"), path, day)
    history = reporting.read_results(spark, path)
    check = Completeness(table="orders", severity="WARNING", compare_with_previous=True,
                         comparison_tolerance_percent=10.0)
    found = run_checks(orders, [check], AS_OF, history=history)
    return verdicts(found, previous_count="bigint", percent_change="double")


AGE = "round(date_diff('microsecond', newest, TIMESTAMP '2024-01-31') / 3.6e9::DOUBLE, 2)"


def _fresh(source, limit, severity, sla):
    passed = f"({AGE} <= {limit})"
    value = f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, 1.0 - {AGE} / {limit}::DOUBLE)), 3)"
    message = f"printf('newest row is %.1f hours old, limit {limit}.0', {AGE})"
    more = f", {AGE} AS age_hours, {AGE} <= {sla} AS sla_compliant"
    row = _row("events", "freshness", severity, passed, value, "n", "0", message, more)
    return f"{row} FROM (SELECT MAX(ts) AS newest, COUNT(*) AS n FROM {source})"


@query("dq_freshness", " UNION ALL ".join([
    _fresh("events", 24, "ERROR", 48),
    _fresh("events WHERE ts < '2024-01-20'", 240, "WARNING", 100),
]))
def dq_freshness(spark, folder):
    checks = [
        Freshness(table="events", columns=["ts"], max_age_hours=24.0, sla_hours=48),
        Freshness(table="events", severity="WARNING", columns=["ts", "seen"], max_age_minutes=14400.0, sla_hours=100,
                  where="ts < TIMESTAMP_NTZ'2024-01-20'"),
    ]
    events = star.table(spark, folder, "events").withColumn("seen", F.col("ts"))
    return verdicts(run_checks(events, checks, AS_OF), age_hours="double", sla_compliant="boolean")


def _unique(table, severity, source, keys, limit=0.0):
    pct = "CASE WHEN n > 0 THEN d * 100.0::DOUBLE / n ELSE 0.0::DOUBLE END"
    message = f"printf('%d surplus row(s), %.2f%% of all, limit {limit}%%', d, {pct})"
    row = _row(table, "uniqueness", severity, f"({pct} <= {limit})", f"round(1.0 - ({pct}) / 100.0::DOUBLE, 3)",
               "n", "d", message)
    return f"""{row} FROM (SELECT CAST(SUM(k) AS BIGINT) AS n, CAST(SUM(k) - COUNT(*) AS BIGINT) AS d
                           FROM (SELECT COUNT(*) AS k FROM {source} GROUP BY {keys}))"""


@query("dq_uniqueness", " UNION ALL ".join([
    _unique("lineitem", "CRITICAL", "lineitem", "l_orderkey, l_linenumber"),
    _unique("documents", "WARNING", "documents", "upper(trim(text, ' '))", 10.0),
    _unique("orders", "INFO", "orders WHERE nullif(o_orderpriority, '5-LOW') IS NOT NULL",
            "o_custkey, o_orderpriority", 60.0),
]))
def dq_uniqueness(spark, folder):
    return verdicts(reduce_union([
        run_checks(star.table(spark, folder, "lineitem"), [
            Uniqueness(table="lineitem", severity="CRITICAL", columns=["l_orderkey", "l_linenumber"])], AS_OF),
        run_checks(star.table(spark, folder, "documents"), [
            Uniqueness(table="documents", severity="WARNING", columns=["text"], max_duplicate_percentage=10.0,
                       case_sensitive=False, trim_whitespace=True, digest_keys=True)], AS_OF),
        run_checks(orders_with_gaps(spark, folder), [
            Uniqueness(table="orders", severity="INFO", columns=["o_custkey", "o_orderpriority"],
                       max_duplicate_percentage=60.0)], AS_OF),
    ]))


@query("dq_duplicate_keys", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem GROUP BY ALL HAVING COUNT(*) > 1
    ORDER BY count DESC, l_orderkey, l_linenumber LIMIT 100""")
def dq_duplicate_keys(spark, folder):
    check = Uniqueness(table="lineitem", columns=["l_orderkey", "l_linenumber"])
    return check.duplicates(star.table(spark, folder, "lineitem"))


NULL_PCT = "(d * 100.0::DOUBLE / n)"


@query("dq_null_rate", f"""
    {_row("orders", "null_rate", "ERROR", f"({NULL_PCT} <= 10)", f"round(1.0 - {NULL_PCT} / 100.0::DOUBLE, 3)", "n", "d",
          "'too many NULLs in 1 column(s): o_orderpriority'")}
    FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS d FROM {GAPPY})""")
def dq_null_rate(spark, folder):
    check = NullRate(table="orders", columns=["o_orderpriority"], max_null_percentage=10.0)
    return verdicts(run_checks(orders_with_gaps(spark, folder), [check], AS_OF))


GAP_COLUMNS = ("o_orderkey", "o_orderstatus", "o_orderpriority")


@query("dq_null_rates", " UNION ALL ".join(f"""
    SELECT '{c}' AS column_name, COUNT(*) AS total_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count,
           round(COUNT(*) FILTER (WHERE {c} IS NULL) * 100.0::DOUBLE / COUNT(*), 2) AS null_percentage
    FROM {GAPPY}""" for c in GAP_COLUMNS))
def dq_null_rates(spark, folder):
    return null_rates(orders_with_gaps(spark, folder), GAP_COLUMNS)


@query("dq_required_columns", f"""
    {_row("orders", "null_rate", "CRITICAL", "(d * 100.0::DOUBLE / (n * 3) <= 5.0)",
          "round((3.0 - d / n::DOUBLE) / 3.0::DOUBLE, 3)", "n", "d",
          "'too many NULLs in 1 column(s): all columns'",
          ", round(d * 100.0::DOUBLE / (n * 3), 4) AS null_rate")}
    FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS d FROM {GAPPY})""")
def dq_required_columns(spark, folder):
    check = NullRate(table="orders", severity="CRITICAL", columns=GAP_COLUMNS, max_null_percentage=5.0, pooled=True)
    return verdicts(run_checks(orders_with_gaps(spark, folder), [check], AS_OF), null_rate="double")


SALE_RULES = {
    "quantity_positive": "quantity > 0",
    "price_positive": "unit_price > 0",
    "discount_in_range": "discount >= 0 AND discount <= quantity * unit_price",
    "total_adds_up": "total_amount = quantity * unit_price - discount",
    "customer_in_range": "customer_id BETWEEN 1 AND 1000",
}
WRONG_SALES = """(
    SELECT *, CAST(quantity * unit_price - CASE WHEN i % 201 = 0 THEN 0 ELSE discount END AS DECIMAL(12,2)) AS total_amount
    FROM (SELECT i, CASE WHEN i % 50 <> 0 THEN 1 + i % 1000 END AS customer_id,
                 CASE WHEN i % 100 = 0 THEN -(1 + i % 10) ELSE 1 + i % 10 END AS quantity,
                 CAST(10 + (i % 50) * 5 AS DECIMAL(10,2)) AS unit_price, CAST((i % 20) * 2.5 AS DECIMAL(10,2)) AS discount
          FROM (SELECT o_orderkey AS i FROM orders)))"""


def _rule(table, name, predicate, source):
    row = _row(table, f"rule:{name}", "ERROR", "(d = 0)", "round(1.0::DOUBLE - d / n::DOUBLE, 3)", "n", "d",
               f"printf('%d row(s) break rule {name}', d)")
    return f"{row} FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE NOT ({predicate})) AS d FROM {source})"


@query("dq_rules", " UNION ALL ".join(_rule("sales", n, p, WRONG_SALES) for n, p in SALE_RULES.items()))
def dq_rules(spark, folder):
    facts = generate.sales(ids(spark, folder, "orders", "o_orderkey"), wrong_total_every=201)
    checks = [Rule(table="sales", name=n, predicate=p) for n, p in SALE_RULES.items()]
    return verdicts(run_checks(facts, checks, AS_OF))


MIXED_EMAILS = """(
    SELECT replace(lower(replace(c_name, '#', '.')) || '@example.com',
                   CASE WHEN c_mktsegment = 'MACHINERY' THEN '@' ELSE '~' END, ' at ') AS email FROM customer)"""


ONE_ADDRESS = "email LIKE '_%@_%._%' AND email NOT LIKE '%@%@%' AND email NOT LIKE '% %' AND email NOT LIKE '%.' AND email NOT LIKE '%..%'"


@query("dq_email_format", _rule("customer", "email_format", ONE_ADDRESS, MIXED_EMAILS))
def dq_email_format(spark, folder):
    """Addresses of machinery customers are spelled out and hence malformed."""
    customers = star.dim_customer(spark, folder)
    spelled = F.replace("email", F.when(F.col("segment") == "MACHINERY", "@").otherwise("~"), F.lit(" at "))
    checks = [email_rule("customer", "email")]
    return verdicts(run_checks(customers.withColumn("email", spelled), checks, AS_OF))


def _orphans(table, key, dim):
    return f"""
        SELECT '{table}' AS table_name, '{key}' AS key_column, COUNT(*) AS rows_checked,
               COUNT(*) FILTER (WHERE {key} IS NULL) AS null_rows,
               COUNT(DISTINCT {key}) FILTER (WHERE {key} NOT IN {dim}) AS orphan_keys,
               COUNT(*) FILTER (WHERE {key} NOT IN {dim}) AS orphan_rows
        FROM (SELECT nullif(l_suppkey, 13) AS l_suppkey, l_partkey FROM lineitem)"""


@query("dq_orphans", " UNION ALL ".join([
    _orphans("lineitem", "l_partkey", "(SELECT p_partkey FROM part WHERE p_brand <> 'Brand#13')"),
    _orphans("lineitem", "l_suppkey", "(SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)"),
]))
def dq_orphans(spark, folder):
    """Line items against the parts of all brands but one and the suppliers in credit."""
    lines = star.table(spark, folder, "lineitem").withColumn(
        "l_suppkey", F.nullif("l_suppkey", F.lit(13).cast("bigint"))
    )
    return relations.orphan_summary(lines, {
        "l_partkey": (star.table(spark, folder, "part").filter("p_brand <> 'Brand#13'"), "p_partkey"),
        "l_suppkey": (star.table(spark, folder, "supplier").filter("s_acctbal > 0"), "s_suppkey"),
    }, "lineitem")


@query("dq_orphan_keys", """
    SELECT l_partkey, COUNT(*) AS row_count FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#13') GROUP BY l_partkey""")
def dq_orphan_keys(spark, folder):
    parts = star.table(spark, folder, "part").filter("p_brand <> 'Brand#13'")
    return relations.orphan_keys(star.table(spark, folder, "lineitem"), "l_partkey", parts, "p_partkey")


@query("dq_date_gaps", """
    SELECT strftime(date, '%Y-%m-%d') AS date FROM (
        SELECT CAST(unnest(generate_series(MIN(CAST(o_orderdate AS DATE)), MAX(CAST(o_orderdate AS DATE)), INTERVAL 1 DAY))
                    AS DATE) AS date FROM orders)
    WHERE date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""")
def dq_date_gaps(spark, folder):
    return plain(relations.date_gaps(star.table(spark, folder, "orders"), "o_orderdate"))


@query("duplicate_gate", """
    SELECT COUNT(*) FILTER (WHERE n > 1) AS duplicate_keys, COUNT(*) FILTER (WHERE n > 1) = 0 AS passed
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_gate(spark, folder):
    return relations.duplicate_gate(star.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("dq_gate", """
    WITH m AS (SELECT COUNT(*) AS record_count, COUNT(*) FILTER (WHERE value > 300) AS error_count FROM events)
    SELECT record_count, error_count, error_count / record_count::DOUBLE AS error_rate,
           error_count / record_count::DOUBLE < 0.03 AND record_count >= 800 AS quality_threshold_met,
           CASE WHEN error_count / record_count::DOUBLE < 0.03 AND record_count >= 800
                THEN 'PASS' ELSE 'FAIL' END AS quality_gate
    FROM m""")
def dq_gate(spark, folder):
    return relations.volume_gate(star.table(spark, folder, "events"), F.col("value") > 300)


@query("dq_gated_rows", """
    WITH m AS (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE value > 300) AS e FROM events)
    SELECT event_type, COUNT(*) AS passed_rows FROM events
    WHERE (SELECT e / n::DOUBLE < 0.03 AND n >= 800 FROM m) GROUP BY event_type""")
def dq_gated_rows(spark, folder):
    events = star.table(spark, folder, "events")
    open_rows = relations.pass_gate(events, relations.volume_gate(events, F.col("value") > 300))
    return open_rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("passed_rows"))


SUITE = json.dumps([
    {"check": "schema", "table": "orders",
     "expected_columns": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
     "expected_types": {"o_orderkey": "bigint", "o_totalprice": "double precision"}},
    {"check": "completeness", "table": "orders", "expected_row_count": 15000, "row_count_tolerance": 0.05},
    {"check": "null_rate", "table": "orders", "columns": {"o_orderstatus": 0.0, "o_orderpriority": 0.1}},
    {"check": "freshness", "table": "events", "timestamp_column": "ts", "max_age_seconds": 86400, "severity": "ERROR"},
    {"check": "uniqueness", "table": "lineitem", "unique_columns": ["l_orderkey", "l_linenumber"]},
    {"check": "uniqueness", "table": "customer", "unique_columns": "c_name"},
])
SUITE_PASSED_RATE = "(n = 0 OR (s = 0 AND p * 100.0::DOUBLE / n <= 10))"
SUITE_SQL = f"""
    WITH results AS (
        {_row("orders", "schema", "CRITICAL", "TRUE", "1.0", "n", "0", "''")} FROM (SELECT COUNT(*) AS n FROM orders)
        UNION ALL {_bounded("orders", "WARNING", 14250, 15750, "orders", 15000)}
        UNION ALL
        {_row("orders", "null_rate", "WARNING", SUITE_PASSED_RATE,
              "round(((1.0 - s / n::DOUBLE) + (1.0 - p / n::DOUBLE)) / 2, 3)", "n", "e",
              "'too many NULLs in 1 column(s): o_orderpriority'")}
        FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderstatus IS NULL) AS s,
                     COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS p,
                     COUNT(*) FILTER (WHERE o_orderstatus IS NULL OR o_orderpriority IS NULL) AS e FROM {GAPPY})
        UNION ALL
        {_row("events", "freshness", "ERROR", f"({AGE} <= 24)",
              f"round(least(1.0::DOUBLE, greatest(0.0::DOUBLE, 1.0 - {AGE} / 24::DOUBLE)), 3)", "n", "0",
              f"printf('newest row is %.1f hours old, limit 24.0', {AGE})")}
        FROM (SELECT MAX(ts) AS newest, COUNT(*) AS n FROM events)
        UNION ALL {_unique("lineitem", "CRITICAL", "lineitem", "l_orderkey, l_linenumber")}
        UNION ALL {_unique("customer", "CRITICAL", "customer", "c_name")}
    )
"""


def suite_results(spark, folder):
    tables = {
        "orders": orders_with_gaps(spark, folder),
        **{name: star.table(spark, folder, name) for name in ("events", "lineitem", "customer")},
    }
    return suites.run_suite(tables, suites.load_suite(SUITE), AS_OF)


@query("dq_suite_json", f"{SUITE_SQL} SELECT * FROM results")
def dq_suite_json(spark, folder):
    return verdicts(suite_results(spark, folder))


FAILURES = ", ".join(
    f"COUNT(*) FILTER (WHERE NOT passed AND severity = '{s}') AS {s.lower()}_failures"
    for s in reversed(results.SEVERITIES)
)
REPORT_SQL = f"""
    {SUITE_SQL}, report AS (
    SELECT table_name, COUNT(*) AS total_checks, COUNT(*) FILTER (WHERE passed) AS passed_checks,
           COUNT(*) FILTER (WHERE NOT passed) AS failed_checks, {FAILURES},
           round(COUNT(*) FILTER (WHERE passed) * 100.0::DOUBLE / COUNT(*), 2) AS overall_quality_score,
           CASE WHEN COUNT(*) FILTER (WHERE NOT passed AND severity = 'CRITICAL') = 0
                THEN 'PASS' ELSE 'FAIL' END AS quality_gate
    FROM results GROUP BY table_name)
"""


@query("dq_report", f"{REPORT_SQL} SELECT * FROM report")
def dq_report(spark, folder):
    return reporting.quality_report(suite_results(spark, folder))


OVERALL_SQL = REPORT_SQL.replace("GROUP BY table_name", "GROUP BY ALL").replace("SELECT table_name,", "SELECT")


@query("dq_report_overall", f"{OVERALL_SQL} SELECT * FROM report")
def dq_report_overall(spark, folder):
    return reporting.quality_report(suite_results(spark, folder), by=None)


@query("dq_alerts", f"""{SUITE_SQL}
    SELECT check_type, table_name, severity, failure_rate, rows_checked, rows_failed, message,
           printf('%d of %d rows failed (%.2f%%)', rows_failed, rows_checked, failure_rate) AS impact
    FROM results WHERE NOT passed""")
def dq_alerts(spark, folder):
    return reporting.check_alerts(suite_results(spark, folder)).drop("execution_date")


@query("dq_report_alerts", f"""{REPORT_SQL}
    SELECT *, printf('Quality score %.2f%%, failed checks %d/%d, critical %d, warning %d, gate %s', overall_quality_score,
                     failed_checks, total_checks, critical_failures, warning_failures, quality_gate) AS alert
    FROM report WHERE failed_checks > 0""")
def dq_report_alerts(spark, folder):
    return reporting.report_alerts(reporting.quality_report(suite_results(spark, folder)))


@query("dq_threshold", f"""{SUITE_SQL}
    SELECT table_name, check_type, value, 0.85::DOUBLE AS threshold, coalesce(value >= 0.85, passed) AS passed,
           severity IN ('ERROR', 'CRITICAL') AND NOT coalesce(value >= 0.85, passed) AS blocks
    FROM results""")
def dq_threshold(spark, folder):
    """The suite judged by a common threshold, and which failures would stop a load."""
    judged = results.with_threshold(suite_results(spark, folder), F.lit(0.85))
    blocks = F.col("severity").isin(*results.BLOCKING) & ~F.col("passed")
    return judged.select("table_name", "check_type", "value", "threshold", "passed", blocks.alias("blocks"))


RUNS = ("1997-01-01", "1998-01-01", "1999-01-01", "2000-01-01", "2001-01-01")


def stored_runs(spark, folder):
    """Stored results of yearly runs over the orders known at each date, one of them repeated."""
    orders = orders_with_gaps(spark, folder)
    checks = [
        Completeness(table="orders", severity="WARNING", min_count=7500),
        NullRate(table="orders", columns=["o_orderpriority"], max_null_percentage=20.0),
    ]
    path = workspace(spark, "check_results")
    for day in (*RUNS, RUNS[2]):
        known = orders.filter(F.col("o_orderdate") < F.lit(day).cast("timestamp_ntz"))
        reporting.store_results(run_checks(known, checks, f"{day} 00:00:00"), path, day)
    return reporting.read_results(spark, path)


RUN_SQL = " UNION ALL ".join(f"""
    SELECT TIMESTAMP '{day}' AS created_at, 'orders' AS table_name, kind AS check_type, severity, passed, failure_rate
    FROM (SELECT COUNT(*) AS n, COUNT(*) FILTER (WHERE o_orderpriority IS NULL) AS d FROM {GAPPY}
          WHERE o_orderdate < '{day}'),
    LATERAL (SELECT 'completeness' AS kind, 'WARNING' AS severity, n >= 7500 AS passed, 0.0::DOUBLE AS failure_rate
             UNION ALL SELECT 'null_rate', 'ERROR', d * 100.0::DOUBLE / n <= 20, d * 100.0::DOUBLE / n)""" for day in RUNS)


@query("dq_history", f"SELECT * FROM ({RUN_SQL}) ORDER BY created_at DESC, table_name, check_type LIMIT 8")
def dq_history(spark, folder):
    return reporting.latest_results(stored_runs(spark, folder), 8)


@query("dq_score_trend", f"""
    SELECT *, score - lag(score) OVER (PARTITION BY table_name ORDER BY execution_date) AS score_change
    FROM (SELECT table_name, created_at AS execution_date, COUNT(*) AS total_checks,
                 COUNT(*) FILTER (WHERE passed) AS passed_checks,
                 COUNT(*) FILTER (WHERE passed) * 100.0::DOUBLE / COUNT(*) AS score
          FROM ({RUN_SQL}) GROUP BY 1, 2)""")
def dq_score_trend(spark, folder):
    return reporting.score_trend(stored_runs(spark, folder))


EXPECTATIONS = json.dumps({"expectations": [
    {"expectation_type": "expect_table_columns_to_match_ordered_list",
     "kwargs": {"column_list": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]}},
    {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "l_orderkey"}},
    {"expectation_type": "expect_column_values_to_be_between",
     "kwargs": {"column": "l_quantity", "min_value": 1, "max_value": 40}},
    {"expectation_type": "expect_column_values_to_be_between",
     "kwargs": {"column": "l_discount", "min_value": 0, "max_value": 1}},
]})
EXPECTED_SQL = """
    WITH found AS (
        SELECT 1 AS position, 'expect_table_columns_to_match_ordered_list' AS expectation_type, COUNT(*) AS element_count,
               CAST(0 AS BIGINT) AS unexpected_count FROM lineitem
        UNION ALL
        SELECT 2, 'expect_column_values_to_be_unique', CAST(SUM(n) AS BIGINT),
               CAST(coalesce(SUM(n) FILTER (WHERE n > 1), 0) AS BIGINT)
        FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey)
        UNION ALL
        SELECT 3, 'expect_column_values_to_be_between', COUNT(*), COUNT(*) FILTER (WHERE l_quantity NOT BETWEEN 1 AND 40)
        FROM lineitem
        UNION ALL
        SELECT 4, 'expect_column_values_to_be_between', COUNT(*), COUNT(*) FILTER (WHERE l_discount NOT BETWEEN 0 AND 1)
        FROM lineitem)
"""


def expectation_results(spark, folder):
    lines = star.table(spark, folder, "lineitem")
    return suites.run_expectations(lines, suites.load_expectations(EXPECTATIONS))


@query("dq_expectations", f"{EXPECTED_SQL} SELECT *, unexpected_count = 0 AS success FROM found")
def dq_expectations(spark, folder):
    return expectation_results(spark, folder)


@query("dq_expectation_statistics", f"""{EXPECTED_SQL}, s AS (
    SELECT COUNT(*) AS evaluated, COUNT(*) FILTER (WHERE unexpected_count = 0) AS good,
           string_agg(expectation_type, ', ' ORDER BY position) FILTER (WHERE unexpected_count > 0) AS failed FROM found)
    SELECT good = evaluated AS success, evaluated AS evaluated_expectations, good AS successful_expectations,
           evaluated - good AS unsuccessful_expectations, good * 100.0::DOUBLE / evaluated AS success_percent,
           concat_ws('; failed: ', printf('%s: %d of %d expectations met (%.1f%%)',
                     CASE WHEN good = evaluated THEN 'PASSED' ELSE 'FAILED' END, good, evaluated,
                     good * 100.0::DOUBLE / evaluated), failed) AS summary
    FROM s""")
def dq_expectation_statistics(spark, folder):
    return suites.expectation_statistics(expectation_results(spark, folder))
