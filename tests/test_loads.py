"""Load patterns: results, and that running twice changes nothing."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.loads import full, incremental, scd2
from tidemark.operators.quality import relations
from tidemark.operators.quality import relations
from tidemark.operators.quality.results import QualityError
from tidemark.sources import tables
from tidemark.sources.stored import StaleTableError, StoredTable


def source(spark, *changes):
    return spark.createDataFrame(
        [(k, v, f"2024-01-{d:02d} 00:00:00") for k, v, d in changes], "k int, v string, at string"
    ).withColumn("at", F.col("at").cast("timestamp_ntz"))


def test_full_load_takes_the_end_of_the_day(spark):
    df = source(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3))
    loaded = full.full_load(df, "at", "2024-01-01", "2024-01-01 08:00:00")
    assert rows(loaded, "k") == [(1,), (2,)]
    assert loaded.columns == ["k", "v", "created_at", "updated_at"]


def test_full_load_twice_replaces(spark, tmp_path):
    df = source(spark, (1, "a", 1), (2, "b", 2))
    path = str(tmp_path / "staging")
    for _ in range(2):
        log = full.run_full_load(df, "at", "2024-01-05", path, "p", "t").first()
    assert (log.records_extracted, log.records_loaded, log.records_rejected) == (2, 2, 0)
    assert spark.read.parquet(path).count() == 2


def test_watermark_falls_back(spark):
    marks = spark.createDataFrame([], "pipeline_name string, table_name string, watermark_value timestamp_ntz, status string")
    low = incremental.watermark_or_epoch(marks, "p", "t")
    assert str(spark.range(1).select(low).first()[0]) == "1970-01-01 00:00:00"
    df = source(spark, (1, "a", 5))
    until = full.moment("2024-01-03 00:00:00")
    assert str(incremental.new_watermark(df, "at", until).first()[0]) == "2024-01-03 00:00:00"


def test_failed_runs_do_not_move_the_watermark(spark):
    marks = spark.sql(
        "SELECT 'p' AS pipeline_name, 't' AS table_name, status, watermark_value FROM VALUES "
        "('success', TIMESTAMP_NTZ'2024-01-01'), ('failed', TIMESTAMP_NTZ'2024-01-09') AS v(status, watermark_value)"
    )
    assert str(incremental.last_watermark(marks, "p", "t").first()[0]) == "2024-01-01 00:00:00"


def test_changed_between_is_half_open_and_buffered(spark):
    df = source(spark, (1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4))
    low, high = full.moment("2024-01-02 00:00:00"), full.moment("2024-01-03 00:00:00")
    assert rows(incremental.changed_between(df, "at", low, high), "k") == [(3,)]
    assert rows(incremental.changed_between(df, "at", low, high, "1 DAY"), "k") == [(2,), (3,)]


def test_upsert_twice_equals_once(spark):
    target = source(spark, (1, "old", 1), (2, "kept", 1))
    batch = source(spark, (1, "mid", 2), (1, "new", 3), (3, "added", 2))
    once = incremental.upsert(target, batch, ["k"], ["at"])
    assert rows(once, "k", "v") == [(1, "new"), (2, "kept"), (3, "added")]
    twice = incremental.upsert(once, batch, ["k"], ["at"])
    assert rows(once) == rows(twice)


def test_insert_ignore(spark):
    target = source(spark, (1, "old", 1))
    batch = source(spark, (1, "ignored", 2), (2, "second", 3), (2, "first", 2))
    assert rows(incremental.insert_ignore(target, batch, ["k"], ["at"]), "k", "v") == [(1, "old"), (2, "first")]


def test_type_one_keeps_other_attributes(spark):
    target = spark.sql("SELECT 1 AS k, 'n' AS name, 'c' AS country, TIMESTAMP_NTZ'2024-01-01' AS updated_at")
    batch = spark.sql("SELECT * FROM VALUES (1, 'N', 'X'), (2, 'M', 'Y') AS v(k, name, country)")
    now = full.moment("2024-02-01 00:00:00")
    result = incremental.upsert_keeping(target, batch, "k", ["name"], "updated_at", now)
    assert rows(result, "k", "name", "country") == [(1, "N", "c"), (2, "M", "Y")]
    assert {str(r.updated_at) for r in result.collect()} == {"2024-02-01 00:00:00"}


def test_type_one_can_set_a_value_to_null(spark):
    target = spark.sql("SELECT 1 AS k, 'n' AS name, TIMESTAMP_NTZ'2024-01-01' AS updated_at")
    batch = spark.sql("SELECT 1 AS k, CAST(NULL AS STRING) AS name")
    now = full.moment("2024-02-01 00:00:00")
    assert incremental.upsert_keeping(target, batch, "k", ["name"], "updated_at", now).first().name is None


def stored_target(spark, path, df):
    StoredTable(spark, f"{path}/target").rewrite(df)
    start = full.moment("2024-01-01 00:00:00")
    incremental.watermark_row(spark, "p", "t", start, start, F.lit(0)).write.parquet(f"{path}/marks")
    return f"{path}/target", f"{path}/marks"


def run(spark, df, paths, day, **options):
    return incremental.run_incremental(spark, df, "at", paths[0], paths[1], ["k"], "p", "t", f"{day} 00:00:00", **options)


def held(spark, paths):
    return rows(incremental.merged(StoredTable(spark, paths[0]), ["k"]), "k", "v")


def files(folder):
    return {str(p): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_incremental_table(spark, tmp_path):
    changes = [(1, "a", 1), (2, "b", 1), (5, "e", 1)]
    paths = stored_target(spark, tmp_path, source(spark, *changes))
    later = source(spark, *changes, (1, "a2", 3), (6, "f", 4), (7, "g", 9))
    before = files(tmp_path / "target" / "data")
    assert run(spark, later, paths, "2024-01-05") == 2
    expected = [(1, "a2"), (2, "b"), (5, "e"), (6, "f")]
    assert held(spark, paths) == expected
    after = files(tmp_path / "target" / "data")
    assert before.items() <= after.items()
    # The same execution date again: nothing new, nothing changed.
    assert run(spark, later, paths, "2024-01-05") == 0
    assert held(spark, paths) == expected and files(tmp_path / "target" / "data").keys() >= after.keys()
    marks = spark.read.parquet(paths[1])
    assert str(incremental.last_watermark(marks, "p", "t").first()[0]) == "2024-01-04 00:00:00"
    assert run(spark, later, paths, "2024-01-10") == 1


def test_batches_fold_into_the_base(spark, tmp_path):
    paths = stored_target(spark, tmp_path, source(spark, (1, "a", 1), (2, "b", 1)))
    for day in range(2, 7):
        run(spark, source(spark, (1, f"a{day}", day), (day + 10, "n", day)), paths, f"2024-01-{day + 1:02d}", compact_after=3)
    table = StoredTable(spark, paths[0])
    assert sum(e.kind == "delta" for e in table.entries()) <= 3
    expected = held(spark, paths)
    assert sorted(expected) == [(1, "a6"), (2, "b"), *[(d + 10, "n") for d in range(2, 7)]]
    assert table.remove_old_folders() > 0 and held(spark, paths) == expected


def test_failed_check_leaves_table_and_mark(spark, tmp_path, monkeypatch):
    paths = stored_target(spark, tmp_path, source(spark, (1, "a", 1), (5, "x", 1)))
    monkeypatch.setattr(incremental, "latest_per_key", lambda df, *_: df)
    with pytest.raises(QualityError):
        run(spark, source(spark, (5, "y", 3), (5, "z", 3)), paths, "2024-01-05")
    monkeypatch.undo()
    assert spark.read.parquet(paths[1]).count() == 1
    assert held(spark, paths) == [(1, "a"), (5, "x")]


@pytest.mark.parametrize("stop", ["before the switch", "after the switch"])
def test_a_stopped_run_loses_nothing(spark, tmp_path, monkeypatch, stop):
    paths = stored_target(spark, tmp_path, source(spark, (1, "a", 1), (2, "b", 1)))
    batch = source(spark, (1, "a2", 3), (6, "f", 4))
    real = StoredTable.commit

    def commit(self, *args):
        if stop == "after the switch":
            real(self, *args)
        raise RuntimeError("lost")

    monkeypatch.setattr(StoredTable, "commit", commit)
    with pytest.raises(RuntimeError):
        run(spark, batch, paths, "2024-01-05")
    monkeypatch.undo()
    expected = [(1, "a2"), (2, "b"), (6, "f")]
    assert held(spark, paths) == (expected if stop == "after the switch" else [(1, "a"), (2, "b")])
    assert run(spark, batch, paths, "2024-01-05") == 2
    assert held(spark, paths) == expected


def test_stored_table_partitions(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    df = spark.createDataFrame([(1, "a b/c"), (2, None), (3, "2024-01-01"), (4, "007")], "k int, p string")
    table.rewrite(df, "p")
    before = files(tmp_path / "t" / "data")
    table.replace(spark.createDataFrame([(9, "007")], "k int, p string"), "p")
    assert before.items() <= files(tmp_path / "t" / "data").items()
    assert rows(table.read(), "k", "p") == [(1, "a b/c"), (2, None), (3, "2024-01-01"), (9, "007")]
    assert rows(table.read(lambda e: e.part == "007"), "k") == [(9,)]
    table.replace(df.limit(0), "p", ["a b/c"])
    assert rows(table.read(), "k") == [(2,), (3,), (9,)]
    table.rewrite(df.limit(0))
    assert table.read().count() == 0 and table.read().columns == ["k", "p"]
    with pytest.raises(ValueError):
        StoredTable(spark, str(tmp_path / "none")).read()


def test_promotion(spark):
    staged = spark.createDataFrame(
        [(1, 10, 5, False), (2, 99, 5, False), (3, None, -1, False), (4, 10, None, False), (5, 10, 5, True)],
        "id int, customer_id int, quantity int, is_processed boolean",
    )
    customers = spark.createDataFrame([(10,), (10,)], "c int")
    judged = full.judge_staging(staged, {"positive": "quantity > 0"}, {"customer_id": (customers, "c")})
    accepted, rejected = full.promote(judged)
    assert rows(accepted, "id") == [(1,), (4,)]
    assert rows(rejected, "id", "reject_reasons") == [(2, ["unknown_customer_id"]), (3, ["positive"])]
    # A row that arrives after the judging stays unprocessed.
    late = staged.union(spark.createDataFrame([(6, 10, 5, False)], staged.schema))
    marked = full.mark_processed(late, judged, ["id"])
    again = full.judge_staging(marked, {"positive": "quantity > 0"}, {})
    assert rows(again, "id") == [(6,)]


def test_promotions_add_up(spark, tmp_path):
    path = str(tmp_path / "promoted")

    def promote(batch, *ids):
        staged = spark.createDataFrame([(n, n - 2, False) for n in ids], "id int, quantity int, is_processed boolean")
        judged = full.judge_staging(staged, {"positive": "quantity > 0"}, {})
        log = full.write_promotion(judged, path, ["id"], batch, "p", "t", "2024-01-01 00:00:00").first()
        return log.records_extracted, log.records_loaded, log.records_rejected

    for _ in range(2):
        assert promote("first", *range(6), 5) == (6, 3, 3)
    # A key that an earlier batch brought is not inserted again; the earlier batch stays.
    for _ in range(2):
        assert promote("second", 1, 5, 8) == (2, 1, 1)
    stored = full.read_promoted(spark, path)
    assert rows(stored.filter("outcome = 'accepted'"), "id", "batch") == [(3, "first"), (4, "first"), (5, "first"), (8, "second")]
    assert rows(stored.filter("outcome = 'rejected'"), "id", "batch") == [(0, "first"), (1, "first"), (1, "second"), (2, "first")]


ATTRIBUTES = ["name", "city"]


def people(spark, *data):
    return spark.createDataFrame(list(data), "k int, name string, city string")


def versions_of(df):
    return [
        (r.k, r.name, r.city, str(r.valid_from), str(r.valid_to), r.is_current)
        for r in df.orderBy("k", "valid_from").collect()
    ]


def seed(spark, *data, day="2024-01-01", compat=False):
    return scd2.as_versions(people(spark, *data), "k", ATTRIBUTES, F.lit(day).cast("date"), compat)


def test_versions_open_close_and_pass_through(spark):
    first = seed(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", "z"))
    second = scd2.apply_changes(first, people(spark, (1, "a", "X"), (2, "b", "y"), (4, "d", "w")), "k", ATTRIBUTES, "2024-02-01")
    assert versions_of(second) == [
        (1, "a", "x", "2024-01-01", "2024-01-31", False),
        (1, "a", "X", "2024-02-01", "9999-12-31", True),
        (2, "b", "y", "2024-01-01", "9999-12-31", True),
        (3, "c", "z", "2024-01-01", "9999-12-31", True),
        (4, "d", "w", "2024-02-01", "9999-12-31", True),
    ]
    third = scd2.apply_changes(second, people(spark, (1, "a", "x")), "k", ATTRIBUTES, "2024-03-01")
    assert [v[3:] for v in versions_of(third) if v[0] == 1] == [
        ("2024-01-01", "2024-01-31", False), ("2024-02-01", "2024-02-29", False), ("2024-03-01", "9999-12-31", True),
    ]
    assert third.select("surrogate_key").distinct().count() == third.count()
    assert all(r.passed for r in relations.version_integrity(third, "k").collect())


def test_same_load_twice_changes_nothing(spark):
    first = seed(spark, (1, "a", "x"))
    staged = people(spark, (1, "a", "y"), (2, "b", "z"))
    once = scd2.apply_changes(first, staged, "k", ATTRIBUTES, "2024-02-01")
    assert versions_of(scd2.apply_changes(once, staged, "k", ATTRIBUTES, "2024-02-01")) == versions_of(once)


def test_second_change_on_one_day_replaces_the_version(spark):
    first = seed(spark, (1, "a", "x"))
    once = scd2.apply_changes(first, people(spark, (1, "a", "y")), "k", ATTRIBUTES, "2024-02-01")
    twice = scd2.apply_changes(once, people(spark, (1, "a", "z")), "k", ATTRIBUTES, "2024-02-01")
    assert versions_of(twice) == [
        (1, "a", "x", "2024-01-01", "2024-01-31", False), (1, "a", "z", "2024-02-01", "9999-12-31", True),
    ]


def test_hash_keeps_column_borders(spark):
    shifted = people(spark, (1, "ab", "c"), (2, "a", "bc"), (3, None, "q"), (4, "", "q"))
    hashes = {r.k: r.h for r in shifted.select("k", scd2.record_hash(ATTRIBUTES).alias("h")).collect()}
    assert len(set(hashes.values())) == 4
    plain = {r.k: r.h for r in shifted.select("k", scd2.record_hash(ATTRIBUTES, True).alias("h")).collect()}
    assert plain[1] == plain[2]
    assert plain[3] == plain[4]


def test_staging_keeps_the_newest_snapshot(spark):
    df = source(spark, (1, "old", 1), (1, "new", 2), (1, "later", 9), (2, "b", 1))
    assert rows(scd2.stage_snapshot(df, "k", "at", "2024-01-03"), "k", "v") == [(1, "new"), (2, "b")]


def test_catch_up_equals_daily_loads(spark):
    draw = random.Random(9)
    feed = source(spark, *[(draw.randint(1, 12), draw.choice("abc"), draw.randint(1, 27)) for _ in range(120)])
    feed = feed.withColumn("n", F.xxhash64("k", "v", "at"))
    days = ["2024-01-03", "2024-01-09", "2024-01-10", "2024-01-20"]
    daily = None
    for day in days:
        staged = scd2.stage_snapshot(feed, "k", "at", day, ["n"])
        start = F.lit(day).cast("date")
        daily = (scd2.as_versions(staged, "k", ["v"], start) if daily is None
                 else scd2.apply_changes(daily, staged, "k", ["v"], day))
    once = scd2.catch_up(feed, "k", "at", ["v"], days, ["n"])
    assert rows(once.select(*daily.columns)) == rows(daily)


def test_stored_versions(spark, tmp_path):
    path = str(tmp_path / "dim")
    scd2.write_versions(seed(spark, (1, "a", "x"), (2, "b", "y"), (3, "c", "z")), path)
    scd2.run_load(spark, path, people(spark, (1, "a", "X")), "k", ATTRIBUTES, "2024-02-01")
    # Another load for the same day closes a further version in the same folder.
    scd2.run_load(spark, path, people(spark, (2, "b", "Y")), "k", ATTRIBUTES, "2024-02-01")
    expected = [
        (1, "a", "x", "2024-01-01", "2024-01-31", False), (1, "a", "X", "2024-02-01", "9999-12-31", True),
        (2, "b", "y", "2024-01-01", "2024-01-31", False), (2, "b", "Y", "2024-02-01", "9999-12-31", True),
        (3, "c", "z", "2024-01-01", "9999-12-31", True),
    ]
    assert versions_of(scd2.read_versions(spark, path)) == expected
    scd2.run_load(spark, path, people(spark, (2, "b", "Y")), "k", ATTRIBUTES, "2024-02-01")
    assert versions_of(scd2.read_versions(spark, path)) == expected


def test_backdated_loads(spark, tmp_path):
    path = str(tmp_path / "dim")
    scd2.write_versions(seed(spark, (1, "a", "x"), (2, "b", "y")), path)
    scd2.run_load(spark, path, people(spark, (1, "a", "Z"), (3, "c", "late")), "k", ATTRIBUTES, "2024-03-01")
    for _ in range(2):
        scd2.run_load(spark, path, people(spark, (1, "a", "M"), (2, "b", "N"), (3, "c", "early")), "k", ATTRIBUTES, "2024-02-01")
    assert versions_of(scd2.read_versions(spark, path)) == [
        (1, "a", "x", "2024-01-01", "2024-01-31", False), (1, "a", "M", "2024-02-01", "2024-02-29", False),
        (1, "a", "Z", "2024-03-01", "9999-12-31", True),
        (2, "b", "y", "2024-01-01", "2024-01-31", False), (2, "b", "N", "2024-02-01", "9999-12-31", True),
        (3, "c", "early", "2024-02-01", "2024-02-29", False), (3, "c", "late", "2024-03-01", "9999-12-31", True),
    ]
    checks = relations.version_integrity(scd2.read_versions(spark, path), "k").collect()
    assert all(row.passed for row in checks)


def test_log_counts(spark):
    first = seed(spark, (1, "a", "x"), (2, "b", "y"))
    staged = people(spark, (1, "a", "X"), (3, "c", "z"))
    log = scd2.processing_log(first, staged, "k", ATTRIBUTES, "2024-02-01", "p", "t").first()
    assert (log.new_records, log.changed_records, log.expired_records, log.total_current_records) == (1, 1, 1, 3)


def test_overlaps_and_gaps_against_pairs(spark):
    """The sweep and the running maximum against all pairs, on random intervals."""
    draw = random.Random(5)
    data = []
    for n in range(160):
        start = draw.randint(0, 30)
        data.append((n, draw.randint(1, 6) if n % 3 else 1, start, start + draw.randint(0, 6)))
    df = spark.createDataFrame(data, "n int, k int, a int, b int").selectExpr(
        "n", "k", "date_add(DATE'2024-01-01', a) AS valid_from", "date_add(DATE'2024-01-01', b) AS valid_to",
        "false AS is_current")
    pairs, late = {}, set()
    for n, k, a, b in data:
        for m, j, c, d in data:
            if n != m and k == j and a < c and c <= b:
                pairs[k] = pairs.get(k, 0) + 1
                late.add((k, c))
    assert rows(relations.overlap_pairs(df, "k")) == sorted(pairs.items())
    assert relations.overlapping_starts(df, "k").count() == len(late)


def test_several_current(spark):
    df = seed(spark, (1, "a", "x"), (1, "b", "y"), (2, "c", "z"))
    assert rows(relations.several_current(df, "k")) == [(1, 2)]


def test_as_of_join(spark):
    versions = scd2.apply_changes(
        seed(spark, (1, "a", "x")), people(spark, (1, "a", "y")), "k", ATTRIBUTES, "2024-02-01")
    facts = spark.sql("SELECT * FROM VALUES (1, DATE'2024-01-31'), (1, DATE'2024-02-01'), (1, DATE'2023-01-01'), "
                      "(NULL, DATE'2024-02-01') AS v(k, sold)")
    joined = scd2.as_of_join(facts, versions.select("k", "city", "valid_from", "valid_to"), "k", "sold")
    assert rows(joined, "k", "sold", "city")[0][2] is None
    assert [r[2] for r in rows(joined, "k", "sold", "city")] == [None, None, "x", "y"]


@pytest.fixture(scope="module")
def crowded(spark):
    """A key with a version a day and half of the facts, one with few long versions, one open, one without versions."""
    versions = spark.sql("""
        SELECT 1 AS k, concat('v', id) AS city, date_add(DATE'2020-01-01', CAST(id AS INT)) AS valid_from, date_add(DATE'2020-01-01', CAST(id AS INT)) AS valid_to FROM range(1000)
        UNION ALL SELECT 2, 'old', DATE'1960-03-01', DATE'2020-06-30' UNION ALL SELECT 2, 'new', DATE'2020-07-01', DATE'9999-12-31'
        UNION ALL SELECT 3, 'open', DATE'2021-02-03', DATE'9999-12-31' UNION ALL SELECT 4, 'wrong', DATE'2021-02-03', DATE'2020-02-03'
        UNION ALL SELECT 5, 'no end', DATE'2020-01-01', NULL UNION ALL SELECT NULL, 'no key', DATE'1960-01-01', DATE'9999-12-31'""")
    facts = spark.sql("""
        SELECT id, CASE WHEN id % 2 = 0 THEN 1 ELSE CAST(id % 13 AS INT) END AS k, date_add(DATE'2019-12-01', CAST(id % 1100 AS INT)) AS sold FROM range(3000)
        UNION ALL SELECT 9001, NULL, DATE'2020-01-01' UNION ALL SELECT 9002, 1, NULL UNION ALL SELECT 9003, 2, DATE'1965-01-01'
        UNION ALL SELECT 9003, 2, DATE'1965-01-01'""")
    return facts, versions


@pytest.mark.parametrize("how", ["left", "inner", "left_anti"])
@pytest.mark.parametrize("days", [1, 30, 5000])
def test_as_of_join_by_period_gives_the_same_rows(spark, crowded, how, days):
    expected = rows(scd2.as_of_join(*crowded, "k", "sold", how))
    assert rows(scd2.as_of_join(*crowded, "k", "sold", how, period_days=days)) == expected


def test_as_of_join_by_period_meets_few_versions(spark, crowded):
    facts, versions = crowded
    by_key = facts.join(versions, "k").count()
    numbered, repeated = scd2._by_period(facts, versions, "sold", 30)
    pairs = numbered.join(repeated, ["k", "__period"])
    assert pairs.groupBy("id", "k", "sold").count().agg(F.max("count")).first()[0] <= 31
    assert by_key > 1_400_000 and 20 * pairs.count() < by_key
    # A key's rows: its versions and the periods between the first and the last fact.
    assert numbered.count() == facts.count()
    for k, n in repeated.groupBy("k").count().filter("k IS NOT NULL").collect():
        assert n <= versions.filter(F.col("k") == k).count() + (1 + (22 + 35 + 3) * 366 // 30)


def test_as_of_join_by_period_spreads_a_skewed_key(spark, crowded):
    facts, versions = crowded
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = scd2.as_of_join(facts, versions, "k", "sold", period_days=30, skewed=True)
        assert "__salt" in joined._jdf.queryExecution().toString()
        found = rows(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert found == rows(scd2.as_of_join(facts, versions, "k", "sold"))


def test_as_of_join_by_period_of_empty_tables(spark, crowded):
    facts, versions = crowded
    assert scd2.as_of_join(facts.limit(0), versions, "k", "sold", period_days=7).collect() == []
    found = scd2.as_of_join(facts, versions.limit(0), "k", "sold", period_days=7)
    assert found.count() == facts.count() and found.filter("city IS NOT NULL").count() == 0


def test_month_folders(spark, tmp_path):
    path = str(tmp_path / "by_month")
    df = source(spark, (1, "a", 1), (2, "b", 2))
    tables.write_by_month(df, path, "at")
    tables.write_by_month(source(spark, (3, "c", 3)).withColumn("at", F.col("at") + F.expr("INTERVAL 40 DAYS")), path, "at")
    stored = StoredTable(spark, path).read()
    assert rows(stored, "k", "year", "month") == [(1, 2024, 1), (2, 2024, 1), (3, 2024, 2)]


def test_table_writers(spark, tmp_path):
    df = spark.range(3)
    path = str(tmp_path / "appended")
    tables.append_rows(df, path)
    tables.append_rows(df, path)
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        tables.append_rows(df.limit(0), path)
    tables.truncate_and_load(df, path)
    assert spark.read.parquet(path).count() == 3
    tables.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).count() == 3


@pytest.mark.parametrize("name", ["", "a b", "a;b", "a.b.c", "a'--"])
def test_table_names(spark, name):
    with pytest.raises(ValueError):
        tables.valid_table_name(spark, name)
    assert tables.valid_table_name(spark, "sales.fact_1") == "sales.fact_1"


def test_bound_parameters(spark):
    df = spark.createDataFrame([("a' OR 1=1 --",), ("b",)], "s string")
    found = tables.run_query(spark, "SELECT s FROM {t} WHERE s = :s", {"t": df}, s="a' OR 1=1 --")
    assert found.count() == 1


def test_series(spark):
    assert tables.day_series(spark, "2024-02-28", "2024-03-01").count() == 3
    assert [r.i for r in tables.number_series(spark, 2, 4).collect()] == [2, 3, 4]


def numbered(spark, first, count, p="a"):
    return spark.range(first, first + count).select(F.col("id").cast("int").alias("k"), F.lit(p).alias("p"))


def test_of_two_stagings_of_one_state_the_second_is_refused(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.rewrite(numbered(spark, 0, 3))
    one, two = (table.stage(numbered(spark, first, 3), kind="delta") for first in (10, 20))
    one.publish()
    with pytest.raises(StaleTableError):
        two.publish()
    assert [r[0] for r in rows(table.read(), "k")] == [0, 1, 10, 11, 12, 2]
    # Staged again against what is there now, nothing is lost or doubled.
    table.stage(two.read(), kind="delta").publish()
    assert table.read().count() == 9


def test_a_staging_overtaken_by_a_rewrite_is_refused(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.rewrite(numbered(spark, 0, 3))
    staged = table.stage(numbered(spark, 10, 2), kind="delta")
    table.rewrite(numbered(spark, 100, 5))
    with pytest.raises(StaleTableError):
        staged.publish()
    assert table.read().count() == 5


def test_versions_that_appear_at_the_same_moment_do_not_replace_each_other(spark, tmp_path, monkeypatch):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.rewrite(numbered(spark, 0, 3))
    one, two = (table.stage(numbered(spark, first, 3), kind="delta") for first in (10, 20))
    # Neither sees the other when it looks; the file's name decides.
    monkeypatch.setattr(StoredTable, "_numbers", lambda self: [1])
    one.publish()
    with pytest.raises(StaleTableError):
        two.publish()
    monkeypatch.undo()
    assert table.newest().number == 2 and sorted(r.k for r in table.read().collect()) == [0, 1, 2, 10, 11, 12]


def test_clean_up_leaves_staged_folders_alone(spark, tmp_path):
    table = StoredTable(spark, str(tmp_path / "t"))
    table.rewrite(numbered(spark, 0, 3))
    table.rewrite(numbered(spark, 5, 3))
    staged = table.stage(numbered(spark, 10, 2), kind="delta")
    assert table.remove_old_folders() == 1
    staged.publish()
    assert sorted(r.k for r in table.read().collect()) == [5, 6, 7, 10, 11]
    left = table.stage(numbered(spark, 20, 2), kind="delta")
    assert table.remove_old_folders(abandoned_after_hours=-1) == 1 and len(table.newest().entries) == 2
    assert left.entries[0].folder not in table._names("data")


def test_a_batch_touches_the_parts_of_its_keys_only(spark, tmp_path):
    """Ten parts of ten keys; a batch with keys of two of them adds to two, and folding it reads and rewrites two."""
    place, table = F.floor(F.col("k") / 10), StoredTable(spark, str(tmp_path / "t"))
    base = spark.range(100).select(F.col("id").cast("int").alias("k"), F.lit("old").alias("v"), F.lit(1).alias("at"))
    table.rewrite(base, place)
    assert len(table.entries()) == 10
    batch = spark.createDataFrame([(12, "new", 2), (12, "newer", 3), (57, "new", 2), (59, "new", 2)], "k int, v string, at int")
    incremental.upsert_batch(table, batch, ["k"], ["at"], place)
    assert {e.part for e in table.entries() if e.kind == "delta"} == {"1", "5"}
    expected = [(k, "newer" if k == 12 else "new" if k in (57, 59) else "old") for k in range(100)]
    assert sorted((r.k, r.v) for r in incremental.merged(table, ["k"]).collect()) == expected

    def parts_of(frame):
        return {bytes.fromhex(name.split("__part=x")[1].split("/")[0]).decode() for name in frame.inputFiles()}

    assert parts_of(incremental.merged(table, ["k"], {"1", "5"}.__contains__)) == {"1", "5"}
    before = files(tmp_path / "t" / "data")
    assert incremental.compact(table, ["k"], place=place)
    added = files(tmp_path / "t" / "data").keys() - before.keys()
    assert len({name.split("__part=")[1].split("/")[0] for name in added}) == 2
    kept = {e.part: e.folder for e in table.entries()}
    assert len(kept) == 10 and sum(folder.startswith("v00000001") for folder in kept.values()) == 8
    assert sorted((r.k, r.v) for r in incremental.merged(table, ["k"]).collect()) == expected


def test_attributes_of_unchanged_keys_are_not_shuffled(spark):
    """Keys, dates and hashes are exchanged; the versions themselves meet a broadcast of the changed keys."""
    versions = scd2.as_versions(spark.range(1000).select(F.col("id").alias("k"), F.lit("x").alias("a")), "k", ["a"], F.lit("2024-01-01").cast("date"))
    versions = spark.createDataFrame(versions.collect(), versions.schema)
    staged = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") < 5, "y").otherwise("x").alias("a"))
    judged = scd2._judged(versions, staged, "k", ["a"], "2024-02-01", False)
    exchanges = [line for line in judged._jdf.queryExecution().executedPlan().toString().splitlines() if "HashAggregate" in line]
    assert exchanges and "SortAggregate" not in judged._jdf.queryExecution().executedPlan().toString()
    after = scd2.apply_changes(versions, staged, "k", ["a"], "2024-02-01")
    plan = after._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and plan.count("BroadcastHashJoin") >= 2
    assert after.count() == 1005 and after.filter("is_current").count() == 1000
