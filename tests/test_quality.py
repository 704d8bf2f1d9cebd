"""Behaviour of the checks on small inputs."""

import json

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.quality import relations, reporting, results, suites
from tidemark.operators.quality.checks import (
    Check, Completeness, Freshness, NullRate, Rule, Schema, Uniqueness, email_rule, null_rates, run_checks,
)

NOW = "2024-06-01 12:00:00"


def one(df, check, **options):
    return run_checks(df, [check], NOW, **options).first()


def details(row):
    return json.loads(row.metadata)


@pytest.fixture(scope="module")
def sales(spark):
    """Four sales: a missing customer, a negative quantity and a repeated transaction."""
    return spark.createDataFrame(
        [
            (1, "TXN_001", 101, 5, 10.0, 50.0),
            (2, "TXN_002", None, 3, 20.0, 60.0),
            (3, "TXN_003", 103, -2, 15.0, -30.0),
            (4, "TXN_003", 104, 1, 15.0, 15.0),
        ],
        "sale_id int, transaction_id string, customer_id int, quantity int, unit_price double, total_amount double",
    )


def test_threshold_and_severity_are_validated():
    with pytest.raises(ValueError):
        Check(table="t", threshold=1.5)
    with pytest.raises(ValueError):
        Check(table="t", severity="FATAL")
    with pytest.raises(ValueError):
        Check(table="  ")


def test_threshold_replaces_the_verdict(sales):
    strict = Uniqueness(table="s", columns=["transaction_id"])
    assert not one(sales, strict).passed
    lenient = Uniqueness(table="s", columns=["transaction_id"], threshold=0.7)
    assert one(sales, lenient).passed
    harsh = NullRate(table="s", columns=["customer_id"], max_null_percentage=50.0, threshold=0.9)
    assert not one(sales, harsh).passed


@pytest.mark.parametrize("count,passed", [(949, False), (950, True), (1050, True), (1051, False)])
def test_tolerance_edges(spark, count, passed):
    check = Completeness(table="t", expected_count=1000, tolerance_percent=5.0)
    row = one(spark.range(count), check)
    assert row.passed is passed
    assert row.value == min(1.0, count / 1000)


def test_tolerance_holds_next_to_a_minimum(spark):
    check = Completeness(table="t", expected_count=1000, tolerance_percent=20.0, min_count=10)
    assert check.bounds() == (800, 1200)
    assert one(spark.range(1100), check).passed
    assert not one(spark.range(1201), check).passed


def test_exact_count_without_tolerance(spark):
    check = Completeness(table="t", expected_count=10)
    assert one(spark.range(10), check).passed
    row = one(spark.range(9), check)
    assert not row.passed
    assert row.message == "9 rows, at least 10 wanted"


def test_partition_and_filter(sales):
    check = Completeness(table="s", expected_count=1, where="quantity > 0", partition_column="transaction_id",
                         partition_value="TXN_003")
    assert one(sales, check).passed


def test_partition_value_is_data_not_sql(sales):
    check = Completeness(table="s", min_count=1, partition_column="transaction_id", partition_value="x' OR '1'='1")
    assert one(sales, check).rows_checked == 0


def test_change_against_previous_run(spark):
    before = run_checks(spark.range(1000), [Completeness(table="t", min_count=1)], "2024-05-31 12:00:00")
    check = Completeness(table="t", compare_with_previous=True, comparison_tolerance_percent=10.0)
    row = one(spark.range(1200), check, history=before)
    assert details(row)["percent_change"] == 20.0
    assert not row.passed
    # A check of other rows of the table is another check.
    other = Completeness(table="t", where="id < 10")
    mixed = before.unionByName(run_checks(spark.range(1000), [other], "2024-05-31 18:00:00"))
    assert details(one(spark.range(1200), check, history=mixed))["percent_change"] == 20.0
    # The very first run has nothing to compare with.
    assert one(spark.range(1200), check, history=before.limit(0)).passed


def test_freshness(spark):
    data = spark.sql("SELECT TIMESTAMP_NTZ'2024-06-01 06:00:00' AS a, TIMESTAMP_NTZ'2024-05-30 12:00:00' AS b")
    fresh = one(data, Freshness(table="t", columns=["a"], max_age_hours=24, sla_hours=2))
    assert fresh.passed
    assert fresh.value == 0.75
    assert details(fresh)["age_hours"] == 6.0
    assert details(fresh)["age_minutes"] == 360.0
    assert details(fresh)["sla_compliant"] is False
    stale = one(data, Freshness(table="t", columns=["b"], max_age_minutes=60))
    assert not stale.passed
    assert stale.value == 0.0
    assert "48.0 hours" in stale.message
    assert one(data, Freshness(table="t", columns=["b", "a"], max_age_hours=24)).passed


def test_freshness_without_data_fails(spark):
    empty = spark.createDataFrame([], "a timestamp_ntz")
    row = one(empty, Freshness(table="t", columns=["a"], max_age_hours=1))
    assert not row.passed
    assert row.value == 0.0
    assert details(row)["no_data"] is True
    assert row.message == "no timestamp in t"


def test_future_data_is_flagged(spark):
    data = spark.sql("SELECT TIMESTAMP_NTZ'2024-06-02 06:00:00' AS a")
    row = one(data, Freshness(table="t", columns=["a"], max_age_hours=24))
    assert row.value == 1.0
    assert details(row)["future"] is True


def test_uniqueness_counts_surplus_rows(sales):
    row = one(sales, Uniqueness(table="s", columns=["transaction_id"]))
    assert (row.rows_checked, row.rows_failed, row.failure_rate) == (4, 1, 25.0)
    assert row.message == "1 surplus row(s), 25.00% of all, limit 0.0%"
    assert one(sales, Uniqueness(table="s", columns=["transaction_id"], max_duplicate_percentage=25.0)).passed


def test_uniqueness_normalises_keys(spark):
    df = spark.createDataFrame([("a ",), ("a",), ("A",)], "k string")
    assert one(df, Uniqueness(table="t", columns=["k"])).passed
    assert one(df, Uniqueness(table="t", columns=["k"], trim_whitespace=True)).rows_failed == 1
    both = Uniqueness(table="t", columns=["k"], trim_whitespace=True, case_sensitive=False)
    assert one(df, both).rows_failed == 2
    assert rows(both.duplicates(df)) == [("A", 3)]
    hashed = Uniqueness(table="t", columns=["k"], trim_whitespace=True, case_sensitive=False, digest_keys=True)
    assert one(df, hashed).rows_failed == 2


def test_uniqueness_and_nulls(spark):
    df = spark.createDataFrame([(1, None), (1, None), (None, None), (1, 2)], "a int, b int")
    assert one(df, Uniqueness(table="t", columns=["a", "b"])).rows_checked == 1
    equal = one(df, Uniqueness(table="t", columns=["a", "b"], exclude_nulls=False))
    assert (equal.rows_checked, equal.rows_failed) == (4, 1)
    apart = one(df, Uniqueness(table="t", columns=["a", "b"], exclude_nulls=False, null_as_distinct=True))
    assert apart.rows_failed == 0


def test_uniqueness_rejects_expressions():
    with pytest.raises(ValueError):
        Uniqueness(table="t", columns=["a; drop"])
    with pytest.raises(ValueError):
        Uniqueness(table="t", columns=[])


def test_null_rates(sales):
    row = one(sales, NullRate(table="s", columns=["customer_id"], max_null_percentage=10.0))
    assert not row.passed
    assert (row.value, row.failure_rate) == (0.75, 25.0)
    several = one(sales, NullRate(table="s", columns=["sale_id", "customer_id"], max_null_percentage=10.0))
    assert details(several)["failed_columns"] == ["customer_id"]
    assert details(several)["null_rates"] == {"sale_id": 0.0, "customer_id": 25.0}
    assert several.value == 0.875
    limits = NullRate(table="s", columns=["sale_id", "customer_id"], max_null_percentage=0.0,
                      limits={"customer_id": 30.0})
    assert one(sales, limits).passed
    assert not one(sales, NullRate(table="s", columns=["customer_id"], expect_not_null=True)).passed
    pooled = NullRate(table="s", columns=["sale_id", "customer_id"], max_null_percentage=12.5, pooled=True)
    assert one(sales, pooled).passed
    assert rows(null_rates(sales, ["sale_id", "customer_id"])) == [
        ("customer_id", 4, 1, 25.0), ("sale_id", 4, 0, 0.0),
    ]


def test_null_rate_of_empty_table(sales):
    empty = sales.limit(0)
    row = one(empty, NullRate(table="s", columns=["customer_id"]))
    assert (row.passed, row.value) == (True, 0.0)
    assert not one(empty, NullRate(table="s", columns=["customer_id"], expect_not_null=True)).passed


def test_rules(sales):
    row = one(sales, Rule(table="s", name="positive", predicate="quantity > 0"))
    assert (row.check_type, row.rows_failed, row.value) == ("rule:positive", 1, 0.75)
    # NULL passes, as with a constraint.
    assert one(sales, Rule(table="s", name="known", predicate="customer_id > 0")).passed


def test_email_rule(spark):
    df = spark.createDataFrame([("a@b.io",), ("no-at.example",), (None,), ("x@y",)], "email string")
    assert one(df, email_rule("t", "email")).rows_failed == 2


def test_schema(sales):
    columns = [{"name": n, "type": t} for n, t in (
        ("sale_id", "integer"), ("transaction_id", "character varying"), ("customer_id", "bigint"),
        ("quantity", "integer"), ("unit_price", "double precision"), ("total_amount", "numeric"))]
    assert one(sales, Schema(table="s", columns=columns, check_column_order=True)).passed
    missing = one(sales.drop("quantity"), Schema(table="s", columns=columns))
    assert details(missing)["missing_columns"] == ["quantity"]
    extra = sales.withColumn("extra_col", F.lit(1))
    assert details(one(extra, Schema(table="s", columns=columns)))["extra_columns"] == ["extra_col"]
    assert one(extra, Schema(table="s", columns=columns, allow_extra_columns=True)).passed
    swapped = [columns[1], columns[0], *columns[2:]]
    assert not one(sales, Schema(table="s", columns=swapped, check_column_order=True)).passed
    assert one(sales, Schema(table="s", columns=swapped)).passed
    wrong = [{**columns[0], "type": "text"}, *columns[1:]]
    assert details(one(sales, Schema(table="s", columns=wrong)))["type_mismatches"] == [
        {"column": "sale_id", "expected": "VARCHAR", "actual": "INTEGER"}]
    assert one(sales, Schema(table="s", columns=wrong, check_types=False)).passed
    strict = [{**c, "nullable": False} for c in columns]
    row = one(sales, Schema(table="s", columns=strict, check_nullability=True))
    assert details(row)["nullability_mismatches"] == ["customer_id"]


def test_schema_of_landed_text(spark):
    df = spark.createDataFrame([("1", "2024-01-01"), ("x", "2024-02-30"), (None, None)], "n string, d string")
    columns = [{"name": "n", "type": "integer"}, {"name": "d", "type": "date"}]
    row = one(df, Schema(table="t", columns=columns, castable=True))
    assert details(row)["type_mismatches"] == [
        {"column": "n", "expected": "INTEGER", "actual": "VARCHAR"}, {"column": "d", "expected": "DATE", "actual": "VARCHAR"}]
    assert one(df.filter("n = '1'"), Schema(table="t", columns=columns, castable=True)).passed


def test_enforce_raises_on_blocking_failures_only(sales):
    failing = {"table": "s", "columns": ["transaction_id"]}
    for severity in ("INFO", "WARNING"):
        results.enforce(run_checks(sales, [Uniqueness(severity=severity, **failing)], NOW))
    for severity in ("ERROR", "CRITICAL"):
        with pytest.raises(results.QualityError, match=severity):
            results.enforce(run_checks(sales, [Uniqueness(severity=severity, **failing)], NOW))


def test_suite_scans_once_per_filter(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "id % 7 AS v", "TIMESTAMP_NTZ'2024-06-01 00:00:00' AS ts").write.parquet(path)
    checks = [
        Completeness(table="t", min_count=1),
        NullRate(table="t", columns=["id", "v"]),
        Rule(table="t", name="r", predicate="v < 7"),
        Freshness(table="t", columns=["ts"], max_age_hours=24),
        Completeness(table="t", min_count=1, where="v = 3"),
        Rule(table="t", name="s", predicate="id >= 0", where="v = 3"),
        Freshness(table="t", columns=["ts"], max_age_hours=24, where="v = 4"),
        Completeness(table="t", expected_count=14, partition_column="v", partition_value=3),
    ]
    found = run_checks(spark.read.parquet(path), checks, NOW)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 2  # all rows once, and the partition
    assert "EqualTo(v,3)" in plan
    assert [r.rows_checked for r in found.collect()] == [100, 100, 100, 100, 14, 14, 14, 14]
    assert all(r.passed for r in found.collect())


def test_result_layout(sales):
    found = run_checks(sales, [Rule(table="s", name="r", predicate="quantity > 0")], NOW)
    expected = results.RESULT_COLUMNS.split(", ")
    assert [f"{n} {t}" for n, t in found.dtypes] == expected


def test_report_alerts_and_gate(sales):
    found = run_checks(sales, [
        Uniqueness(table="s", severity="CRITICAL", columns=["transaction_id"]),
        Rule(table="s", severity="WARNING", name="positive", predicate="quantity > 0"),
        Completeness(table="s", min_count=1),
    ], NOW)
    report = reporting.quality_report(found).first()
    assert (report.total_checks, report.passed_checks, report.overall_quality_score) == (3, 1, 33.33)
    assert (report.critical_failures, report.warning_failures, report.quality_gate) == (1, 1, "FAIL")
    assert reporting.check_alerts(found).count() == 2
    clean = found.filter("passed")
    assert reporting.quality_report(clean).first().quality_gate == "PASS"
    assert reporting.report_alerts(reporting.quality_report(clean)).count() == 0


def test_results_can_be_stored_and_read_back(spark, sales, tmp_path):
    path = str(tmp_path / "results")
    for day in ("2024-06-01", "2024-06-02"):
        for _ in range(2):  # a repeated run replaces itself
            reporting.store_results(run_checks(sales, [Completeness(table="s", min_count=1)], f"{day} 00:00:00"), path, day)
    stored = reporting.read_results(spark, path)
    assert stored.count() == 2
    newest = reporting.latest_results(stored, 1).first()
    assert str(newest.created_at) == "2024-06-02 00:00:00"
    # Of the runs that are not asked for no file is read.
    late = reporting.read_results(spark, path, lambda run: run > "2024-06-01")
    assert rows(late, "run_id") == [("2024-06-02",)]
    assert len(late.inputFiles()) < len(stored.inputFiles())
    assert reporting.read_results(spark, path, lambda run: False).count() == 0


def test_failures_are_stored_before_they_raise(spark, sales, tmp_path):
    path = str(tmp_path / "recorded")
    found = run_checks(sales, [Uniqueness(table="s", severity="CRITICAL", columns=["transaction_id"])], NOW)
    with pytest.raises(results.QualityError):
        reporting.record(found, path, "r1")
    assert not reporting.read_results(spark, path).first().passed


def test_suite_names_and_units():
    by_code = suites.load_suite(json.dumps([
        {"operator": "CompletenessChecker", "table_name": "t", "expected_count": 100, "tolerance_percent": 5},
        {"operator": "FreshnessChecker", "table_name": "t", "timestamp_column": "ts", "max_age_hours": 2},
        {"operator": "UniquenessChecker", "table_name": "t", "key_columns": ["a"], "severity": "INFO"},
    ]))
    by_schema = suites.load_suite(json.dumps({"checks": [
        {"type": "CompletenessCheckOperator", "table": "t", "expected_row_count": 100, "row_count_tolerance": 0.05},
        {"type": "FreshnessCheckOperator", "table": "t", "timestamp_column": "ts", "max_age_seconds": 7200},
        {"type": "NullRateCheckOperator", "table": "t", "columns": {"a": 0.05}},
    ]}))
    assert by_code[0].bounds() == by_schema[0].bounds() == (95, 105)
    assert by_code[1].limit() == by_schema[1].limit() == 2.0
    assert by_code[2].severity == "INFO"
    assert by_schema[2].limit("a") == 5.0
    with pytest.raises(ValueError):
        suites.load_suite('[{"check": "other", "table": "t"}]')


def test_expectations(spark, sales, tmp_path):
    listed = [
        {"expectation_type": "expect_column_values_to_be_unique", "kwargs": {"column": "transaction_id"}},
        {"expectation_type": "expect_column_values_to_be_between", "kwargs": {"column": "quantity", "min_value": 1}},
        {"expectation_type": "expect_table_columns_to_match_ordered_list", "kwargs": {"column_list": sales.columns}},
    ]
    found = suites.run_expectations(sales, listed)
    assert rows(found, "position", "success", "unexpected_count") == [(1, False, 2), (2, False, 1), (3, True, 0)]
    stats = suites.expectation_statistics(found).first()
    assert (stats.evaluated_expectations, stats.successful_expectations, stats.success) == (3, 1, False)
    assert stats.summary.startswith("FAILED: 1 of 3 expectations met (33.3%)")
    suites.register_expectation("expect_positive", lambda kwargs: F.col(kwargs["column"]) > 0)
    own = suites.run_expectations(sales, [{"expectation_type": "expect_positive", "kwargs": {"column": "sale_id"}}])
    assert own.first().success
    with pytest.raises(ValueError):
        suites.run_expectations(sales, [{"expectation_type": "expect_other"}])
    path = tmp_path / "suite.json"
    path.write_text(json.dumps({"expectations": listed}, indent=1))
    assert suites.read_expectations(spark, str(path)) == listed
    with pytest.raises(ValueError):
        suites.load_expectations('{"other": 1}')


def test_orphans(spark, sales):
    customers = spark.createDataFrame([(101,), (103,)], "id int")
    row = relations.orphan_summary(sales, {"customer_id": (customers, "id")}, "s").first()
    assert (row.rows_checked, row.null_rows, row.orphan_keys, row.orphan_rows) == (4, 1, 1, 1)
    assert rows(relations.orphan_keys(sales, "customer_id", customers, "id")) == [(104, 1)]


def test_orphans_with_repeated_dimension_rows(spark, sales):
    customers = spark.createDataFrame([(101,), (101,), (103,)], "id int")
    row = relations.orphan_summary(sales, {"customer_id": (customers, "id")}).first()
    assert (row.rows_checked, row.orphan_rows) == (4, 1)


def test_gate_opens_and_closes(spark):
    df = spark.range(1000).withColumn("bad", F.col("id") < 29)
    open_gate = relations.volume_gate(df, F.col("bad"))
    assert open_gate.first().quality_gate == "PASS"
    assert relations.pass_gate(df, open_gate).count() == 1000
    few = df.limit(700)
    assert relations.pass_gate(few, relations.volume_gate(few, F.lit(False))).count() == 0
    assert relations.volume_gate(df, F.col("id") < 30).first().quality_gate == "FAIL"


def test_date_gaps(spark):
    df = spark.sql("SELECT explode(array(DATE'2024-01-01', DATE'2024-01-04', DATE'2024-01-04')) AS d")
    assert [str(r[0]) for r in rows(relations.date_gaps(df, "d"))] == ["2024-01-02", "2024-01-03"]


def test_schema_knows_spark_and_database_names(spark):
    df = spark.sql("SELECT 1 AS i, 'a' AS s, 1.50BD AS d, 2.5D AS f, TIMESTAMP_NTZ'2024-01-01' AS t")
    for names in (("int", "string", "decimal(10,2)", "double", "timestamp_ntz"),
                  ("integer", "character varying(20)", "numeric(10,2)", "double precision", "timestamp without time zone")):
        columns = [{"name": c, "type": n} for c, n in zip(df.columns, names, strict=True)]
        assert one(df, Schema(table="t", columns=columns)).passed, names


def test_pooled_rate_has_its_own_limit(spark):
    df = spark.sql("SELECT * FROM VALUES (1, CAST(null AS INT)), (2, 3) AS t(b, a)")
    pooled = NullRate(table="t", columns=["a", "b"], max_null_percentage=1.0, limits={"a": 50.0}, pooled=True)
    assert not one(df, pooled).passed


def test_enforce_names_every_failure(sales):
    failing = [Completeness(table=f"t{n}", min_count=10**9) for n in range(25)]
    with pytest.raises(results.QualityError) as raised:
        results.enforce(run_checks(sales, failing, NOW))
    assert str(raised.value).count("ERROR") == 25


def test_all_files_of_a_suite_folder_are_read(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / f"{name}.json").write_text(json.dumps([{"expectation_type": f"expect_{name}", "kwargs": {}}]))
    assert [e["expectation_type"] for e in suites.read_expectations(spark, str(tmp_path))] == ["expect_a", "expect_b"]


def test_duplicates_in_the_result(spark):
    df = spark.createDataFrame([(k,) for k in (1, 1, 1, 2, 2, 3)], "k int")
    entry = {"type": "uniqueness", "table": "t", "key_columns": ["k"], "return_duplicates": True}
    row = one(df, suites.build_check(entry))
    assert details(row)["duplicates"] == [{"count": 3, "k": 1}, {"count": 2, "k": 2}]


def test_address_shape(spark):
    good = ["a@b.c", "a.b+c@d-e.f.gh", "é@ü.de"]
    bad = ["", "a", "@b.c", "a@", "a@b", "a@b.", "a@.c", "a@b..c", "a@b@c.d", "a b@c.d", "a at b.c", "a@b.c d"]
    df = spark.createDataFrame([(value,) for value in [*good, *bad]], "email string")
    assert rows(df.filter(email_rule("t", "email").predicate)) == sorted((value,) for value in good)
