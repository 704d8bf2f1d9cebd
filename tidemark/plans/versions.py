"""Versioned-dimension queries over a customer feed taken from the orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.columns import record_hash
from tidemark.functions.keyed import lookup_join
from tidemark.operators.loads import full, scd2
from tidemark.operators.quality import relations
from tidemark.plans.registry import plain, query
from tidemark.session import workspace
from tidemark.sources import star

KEY = "customer_id"
ATTRIBUTES = ["customer_key", "customer_name", "email", "country", "segment"]
DAYS = ("1997-12-31", "1999-06-30", "2000-06-30", "2001-06-30")
SHOWN = [KEY, *ATTRIBUTES, "valid_from", "valid_to", "is_current", "record_hash"]


def staged(spark, folder, day):
    """The newest state per customer; one row per customer meets the dimension."""
    newest = scd2.stage_snapshot(
        star.customer_snapshots(spark, folder), KEY, "extract_timestamp", day, ["change_id"]
    )
    fixed = star.dim_customer(spark, folder).drop("segment")
    return newest.select(KEY, "segment").join(fixed, KEY).select(KEY, *ATTRIBUTES)


def loaded(spark, folder, days=DAYS, handed_on=lambda frame, name: frame):
    """The dimension after one load per day, day by day; ``handed_on`` may write what the next load reads."""
    first, *later = days
    versions = scd2.as_versions(staged(spark, folder, first), KEY, ATTRIBUTES, F.lit(first).cast("date"))
    for day in later:
        versions = scd2.apply_changes(handed_on(versions, "versions"), handed_on(staged(spark, folder, day), "staged"), KEY, ATTRIBUTES, day)
    return versions


def written(frame, name):
    """The rows by way of the shared folder: they are read more than once."""
    path = workspace(frame.sparkSession, name)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def history(spark, folder, days=DAYS):
    """The same dimension in one pass over the feed.

    Changes are compared by segment, the only attribute that varies; the fixed ones
    join last, when a customer is down to a few rows.
    """
    built = scd2.catch_up(
        star.customer_snapshots(spark, folder), KEY, "extract_timestamp", ["segment"], days, ["change_id"]
    )
    fixed = star.dim_customer(spark, folder).drop("segment")
    complete = lookup_join(built.drop("record_hash"), fixed, [KEY], unique=True)
    return complete.withColumn("record_hash", record_hash(ATTRIBUTES))


MARKED = ", ".join(f"CASE WHEN {c} IS NULL THEN 'N' ELSE 'V' || {c} END" for c in ATTRIBUTES)
DAY_LIST = ", ".join(f"DATE '{d}'" for d in DAYS)
VERSIONS = f"""
    WITH days AS (SELECT unnest([{DAY_LIST}]) AS ds),
    snaps AS (
        SELECT ds, o_custkey AS customer_id, o_orderpriority AS segment FROM (
            SELECT *, row_number() OVER (PARTITION BY ds, o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders JOIN days ON o_orderdate <= ds + 1) WHERE rn = 1),
    changed AS (
        SELECT ds, customer_id, segment FROM (
            SELECT *, lag(segment) OVER (PARTITION BY customer_id ORDER BY ds) AS before FROM snaps)
        WHERE before IS NULL OR before <> segment),
    attributed AS (
        SELECT customer_id, c_name AS customer_key, c_name AS customer_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS country, segment, ds AS valid_from,
               coalesce(lead(ds) OVER (PARTITION BY customer_id ORDER BY ds) - 1, DATE '9999-12-31') AS valid_to,
               lead(ds) OVER (PARTITION BY customer_id ORDER BY ds) IS NULL AS is_current
        FROM changed JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    versions AS (SELECT *, md5(concat_ws(chr(31), {MARKED})) AS record_hash FROM attributed)
"""
SHOWN_SQL = ", ".join(f"strftime({c}, '%Y-%m-%d') AS {c}" if c.startswith("valid") else c for c in SHOWN)


@query("scd2_apply", f"{VERSIONS} SELECT {SHOWN_SQL} FROM versions")
def scd2_apply(spark, folder):
    return plain(loaded(spark, folder, handed_on=written).select(*SHOWN))


@query("scd2_catch_up", f"{VERSIONS} SELECT {SHOWN_SQL} FROM versions")
def scd2_catch_up(spark, folder):
    return plain(history(spark, folder).select(*SHOWN))


@query("scd2_table", f"{VERSIONS} SELECT {SHOWN_SQL} FROM versions")
def scd2_table(spark, folder):
    """The stored form, with the last load run twice."""
    path = workspace(spark, "dim_customer_scd2")
    scd2.write_versions(loaded(spark, folder, DAYS[:1]), path)
    for day in (*DAYS[1:], DAYS[-1]):
        scd2.run_load(spark, path, written(staged(spark, folder, day), "staged"), KEY, ATTRIBUTES, day)
    return plain(scd2.read_versions(spark, path).select(*SHOWN))


LATE = DAYS[2]
IN_ORDER = VERSIONS.replace(DAY_LIST, ", ".join(f"DATE '{d}'" for d in DAYS if d != LATE))


@query("scd2_backdated", f"""{IN_ORDER}, late AS (
        SELECT o_custkey AS customer_id, o_orderpriority AS segment FROM (
            SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
            FROM orders WHERE o_orderdate <= DATE '{LATE}' + 1) WHERE rn = 1),
    around AS (
        SELECT l.customer_id, l.segment, v.segment AS covering, v.valid_to AS covered_to,
               (SELECT min(n.valid_from) FROM versions n WHERE n.customer_id = l.customer_id AND n.valid_from > DATE '{LATE}') AS following
        FROM late l LEFT JOIN versions v ON v.customer_id = l.customer_id AND DATE '{LATE}' BETWEEN v.valid_from AND v.valid_to),
    acting AS (SELECT * FROM around WHERE covering IS NULL OR covering <> segment),
    opened AS (
        SELECT customer_id, c_name AS customer_key, c_name AS customer_name,
               lower(replace(c_name, '#', '.')) || '@example.com' AS email, n_name AS country, segment,
               DATE '{LATE}' AS valid_from, coalesce(covered_to, following - 1, DATE '9999-12-31') AS valid_to
        FROM acting JOIN customer ON customer_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
    result AS (
        SELECT * REPLACE (
            CASE WHEN acts THEN DATE '{LATE}' - 1 ELSE valid_to END AS valid_to, is_current AND NOT acts AS is_current)
        FROM (SELECT *, DATE '{LATE}' BETWEEN valid_from AND valid_to
                        AND customer_id IN (SELECT customer_id FROM acting) AS acts FROM versions)
        UNION ALL
        SELECT customer_id, customer_key, customer_name, email, country, segment, valid_from, valid_to,
               valid_to = DATE '9999-12-31', md5(concat_ws(chr(31), {MARKED})), false FROM opened)
    SELECT {SHOWN_SQL.replace("strftime(valid", "strftime(result.valid")} FROM result""")
def scd2_backdated(spark, folder):
    """Loads out of order: the day before the last comes last, and twice."""
    path = workspace(spark, "dim_customer_backdated")
    scd2.write_versions(loaded(spark, folder, DAYS[:1]), path)
    for day in (DAYS[1], DAYS[3], LATE, LATE):
        scd2.run_load(spark, path, staged(spark, folder, day), KEY, ATTRIBUTES, day)
    return plain(scd2.read_versions(spark, path).select(*SHOWN))


@query("scd2_seed", f"""
    SELECT c_custkey AS customer_id, c_name AS customer_key, '2020-01-01' AS valid_from, '9999-12-31' AS valid_to,
           TRUE AS is_current, md5(concat_ws(chr(31), 'V' || c_name, 'V' || c_name,
               'V' || lower(replace(c_name, '#', '.')) || '@example.com', 'V' || n_name, 'V' || c_mktsegment)) AS record_hash
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def scd2_seed(spark, folder):
    seeded = scd2.as_versions(star.dim_customer(spark, folder), KEY, ATTRIBUTES, F.lit("2020-01-01").cast("date"))
    return plain(seeded.select(KEY, "customer_key", "valid_from", "valid_to", "is_current", "record_hash"))


@query("scd2_plain_hash", """
    SELECT c_custkey AS customer_id, md5(c_name || c_name || lower(replace(c_name, '#', '.')) || '@example.com'
           || n_name || coalesce(nullif(c_mktsegment, 'MACHINERY'), '')) AS record_hash
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def scd2_plain_hash(spark, folder):
    """The hash without separators, as stored by older loads."""
    customers = star.dim_customer(spark, folder).withColumn("segment", F.nullif("segment", F.lit("MACHINERY")))
    hashed = scd2.as_versions(customers, KEY, ATTRIBUTES, F.lit("2020-01-01").cast("date"), compat=True)
    return hashed.select(KEY, "record_hash")


@query("scd2_changes", f"""{VERSIONS}
    SELECT customer_id, segment, NOT EXISTS (SELECT 1 FROM changed b WHERE b.customer_id = a.customer_id AND b.ds < a.ds)
           AS is_new
    FROM changed a WHERE ds = DATE '{DAYS[2]}'""")
def scd2_changes(spark, folder):
    before = loaded(spark, folder, DAYS[:2]).filter("is_current")
    changes = scd2.detect_changes(staged(spark, folder, DAYS[2]), before, KEY, ATTRIBUTES)
    return changes.select(KEY, "segment", "is_new")


@query("scd2_stats", f"""{VERSIONS}
    SELECT 'customer_versions' AS pipeline_name, 'warehouse.dim_customer' AS table_name, '{DAYS[2]}' AS execution_date,
           (SELECT COUNT(*) FROM changed a WHERE ds = DATE '{DAYS[2]}'
             AND customer_id NOT IN (SELECT customer_id FROM changed WHERE ds < DATE '{DAYS[2]}')) AS new_records,
           (SELECT COUNT(*) FROM changed a WHERE ds = DATE '{DAYS[2]}'
             AND customer_id IN (SELECT customer_id FROM changed WHERE ds < DATE '{DAYS[2]}')) AS changed_records,
           (SELECT COUNT(*) FROM versions WHERE valid_to = DATE '{DAYS[2]}' - 1) AS expired_records,
           (SELECT COUNT(DISTINCT customer_id) FROM changed WHERE ds <= DATE '{DAYS[2]}') AS total_current_records,
           'success' AS status""")
def scd2_stats(spark, folder):
    before, incoming = loaded(spark, folder, DAYS[:2]), staged(spark, folder, DAYS[2])
    log = scd2.processing_log(before, incoming, KEY, ATTRIBUTES, DAYS[2], "customer_versions", "warehouse.dim_customer")
    return plain(scd2.latest_log(log, "customer_versions", DAYS[2]).drop("created_at"))


def damaged(spark, folder):
    """Closed versions of urgent customers end too late, those of low priority too early."""
    closed = ~F.col("is_current")
    return history(spark, folder).withColumn(
        "valid_to",
        F.when(closed & (F.col("segment") == "1-URGENT"), F.date_add("valid_to", 400))
        .when(closed & (F.col("segment") == "5-LOW"), F.date_sub("valid_to", 100))
        .otherwise(F.col("valid_to")),
    )


DAMAGED = f"""{VERSIONS}, damaged AS (
    SELECT * REPLACE (CASE WHEN NOT is_current AND segment = '1-URGENT' THEN valid_to + 400
                           WHEN NOT is_current AND segment = '5-LOW' THEN valid_to - 100
                           ELSE valid_to END AS valid_to) FROM versions)
"""


@query("scd2_integrity", f"""{DAMAGED}, found AS (
    SELECT 'one_current_version' AS rule, 'ERROR' AS severity,
           (SELECT COUNT(*) FROM (SELECT 1 FROM damaged WHERE is_current GROUP BY customer_id HAVING COUNT(*) > 1)) AS failures
    UNION ALL
    SELECT 'no_overlap', 'WARNING', COUNT(*) FROM damaged a WHERE EXISTS (
        SELECT 1 FROM damaged b WHERE b.customer_id = a.customer_id AND b.valid_from < a.valid_from
           AND b.valid_to >= a.valid_from)
    UNION ALL
    SELECT 'no_gap', 'INFO', COUNT(*) FROM (
        SELECT valid_to, lead(valid_from) OVER (PARTITION BY customer_id ORDER BY valid_from) AS following FROM damaged)
    WHERE following > valid_to + 1
    UNION ALL
    SELECT 'open_end_is_current', 'ERROR', COUNT(*) FROM damaged WHERE is_current <> (valid_to = DATE '9999-12-31')
    UNION ALL
    SELECT 'start_before_end', 'ERROR', COUNT(*) FROM damaged WHERE valid_from > valid_to)
    SELECT rule, severity, failures, failures = 0 AS passed FROM found""")
def scd2_integrity(spark, folder):
    return relations.version_integrity(damaged(spark, folder), KEY)


@query("scd2_overlap_pairs", f"""{DAMAGED}
    SELECT a.customer_id, COUNT(*) AS overlapping_pairs
    FROM damaged a JOIN damaged b ON a.customer_id = b.customer_id AND a.valid_from < b.valid_from
     AND a.valid_from <= b.valid_to AND a.valid_to >= b.valid_from
    GROUP BY a.customer_id""")
def scd2_overlap_pairs(spark, folder):
    return relations.overlap_pairs(damaged(spark, folder), KEY)


@query("scd2_current", f"{VERSIONS} SELECT {SHOWN_SQL} FROM versions WHERE is_current ORDER BY customer_id LIMIT 10")
def scd2_current(spark, folder):
    return plain(scd2.current_view(history(spark, folder).select(*SHOWN), KEY, 10))


@query("scd2_history", f"""{VERSIONS} SELECT {SHOWN_SQL} FROM versions
    WHERE customer_id = (SELECT MIN(customer_id) FROM versions) ORDER BY versions.valid_from DESC""")
def scd2_history(spark, folder):
    known = star.customer_snapshots(spark, folder).filter(F.col("extract_timestamp") <= full.end_of_day(DAYS[-1]))
    smallest = F.lit(known.agg(F.min(KEY).alias("k")).first().k)
    return plain(scd2.key_history(history(spark, folder).select(*SHOWN), KEY, smallest))


@query("scd2_change_count", f"{VERSIONS} SELECT customer_id, COUNT(*) - 1 AS num_changes FROM versions GROUP BY customer_id")
def scd2_change_count(spark, folder):
    return scd2.change_counts(history(spark, folder), KEY)


@query("scd2_valid_on", f"""{VERSIONS} SELECT {SHOWN_SQL} FROM versions
    WHERE DATE '1999-12-31' BETWEEN versions.valid_from AND versions.valid_to""")
def scd2_valid_on(spark, folder):
    return plain(scd2.valid_on(history(spark, folder).select(*SHOWN), "1999-12-31"))


AS_OF_SQL = f"""{VERSIONS}
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, segment, strftime(valid_from, '%Y-%m-%d') AS valid_from
    FROM orders LEFT JOIN versions ON o_custkey = customer_id AND CAST(o_orderdate AS DATE) BETWEEN valid_from AND valid_to"""


def orders_as_of(spark, folder, period_days=None):
    facts = star.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias(KEY), F.to_date("o_orderdate").alias("sold_on")
    )
    versions = history(spark, folder).select(KEY, "segment", "valid_from", "valid_to")
    joined = scd2.as_of_join(facts, versions, KEY, "sold_on", period_days=period_days)
    return plain(joined.select("order_id", KEY, "segment", "valid_from"))


@query("scd2_asof_join", AS_OF_SQL)
def scd2_asof_join(spark, folder):
    return orders_as_of(spark, folder)


@query("scd2_asof_periods", AS_OF_SQL)
def scd2_asof_periods(spark, folder):
    """The same, each order meeting only the versions of its own half-year."""
    return orders_as_of(spark, folder, period_days=183)
