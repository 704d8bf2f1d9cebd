"""Landing-file and stream queries; the files are written from the supplied tables first."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.quality.checks import Completeness, NullRate, Rule
from tidemark.plans.registry import plain, query
from tidemark.session import workspace
from tidemark.sources import landing, star
from tidemark.streaming import loads as streams


def landed_rows(orders):
    return orders.select(
        F.concat(F.lit("TXN-"), F.col("o_orderkey").cast("string")).alias("transaction_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderpriority").alias("product_id"),
        F.month("o_orderdate").alias("quantity"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
    )


LANDED = """
    SELECT 'TXN-' || o_orderkey AS transaction_id, CAST(o_custkey AS VARCHAR) AS customer_id,
           o_orderpriority AS product_id, CAST(month(o_orderdate) AS INTEGER) AS quantity, o_totalprice AS amount,
           o_orderstatus FROM orders
"""


DROPS = {"csv": "F", "json": "O", "parquet": "P"}


def land(spark, folder, *formats):
    """One drop of files per format, each of the orders of one status."""
    path = workspace(spark, "landing")
    orders = star.table(spark, folder, "orders")
    for suffix in formats:
        rows = landed_rows(orders.filter(F.col("o_orderstatus") == DROPS[suffix]))
        rows.write.option("header", "true").format(suffix).save(f"{path}/sales_data_{DROPS[suffix]}.{suffix}")
    return path


def land_orders(spark, folder):
    """All orders as CSV, one drop per status; a blank in the folder's name must not matter."""
    path = f"{workspace(spark, 'landing')}/all orders"
    rows = star.table(spark, folder, "orders")
    for status in DROPS.values():
        drop = landed_rows(rows.filter(F.col("o_orderstatus") == status))
        drop.write.option("header", "true").csv(f"{path}/sales_data_{status}.csv")
    return path


def land_all(spark, folder):
    """Drops in all accepted formats, and one in a format nobody reads."""
    path = land(spark, folder, *DROPS)
    landed_rows(star.table(spark, folder, "orders")).select("transaction_id").write.text(f"{path}/notes.txt")
    return path


@query("csv_landing", f"""
    SELECT transaction_id, customer_id, product_id, quantity, amount FROM ({LANDED})""")
def csv_landing(spark, folder):
    path = f"{land_orders(spark, folder)}/{landing.LANDING_PATTERN}"
    return plain(landing.read_landing(spark, path, landing.landing_schema(), "csv").drop("filepath"))


@query("landing_formats", f"""
    SELECT format, COUNT(*) AS records, CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amount FROM (
        SELECT *, CASE o_orderstatus WHEN 'F' THEN '.csv' WHEN 'O' THEN '.json' ELSE '.parquet' END AS format FROM ({LANDED}))
    GROUP BY format""")
def landing_formats(spark, folder):
    """Every accepted format by its own reader; the text file is passed over."""
    rows = landing.read_all_formats(spark, land_all(spark, folder), landing.landing_schema())
    by_format = rows.groupBy(landing.file_suffix(F.col("filepath")).alias("format"))
    return plain(by_format.agg(F.count(F.lit(1)).alias("records"), F.sum("amount").alias("amount")))


@query("file_metadata", """
    WITH files AS (
        SELECT strftime(o_orderdate, '%Y-%m') AS month,
               'transaction_id' || chr(10) || string_agg('TXN-' || o_orderkey, chr(10) ORDER BY o_orderkey) || chr(10) AS content
        FROM orders GROUP BY 1)
    SELECT month, CAST(strlen(content) AS BIGINT) AS file_size_bytes, '.csv' AS file_format, TRUE AS is_supported_format,
           'process_small_file' AS route, sha256(content) AS file_hash FROM files""")
def file_metadata(spark, folder):
    """A file per order month, its lines in order, so that its content is known; half of them hashed in pieces."""
    path = workspace(spark, "monthly files")
    orders = star.table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderkey",
        F.concat(F.lit("TXN-"), F.col("o_orderkey").cast("string")).alias("transaction_id"))
    files = orders.repartition("month").sortWithinPartitions("month", "o_orderkey").drop("o_orderkey")
    files.write.partitionBy("month").csv(path, header=True)
    found = landing.with_route(landing.file_metadata(spark, path, whole=2000))
    month = F.regexp_extract("filepath", "month=([^/]+)/", 1).alias("month")
    return found.select(month, "file_size_bytes", "file_format", "is_supported_format", "route", "file_hash")


@query("file_records", """
    SELECT CAST(COUNT(*) AS BIGINT) AS estimated_records, CAST(COUNT(*) AS BIGINT) AS records_processed,
           TRUE AS counts_agree FROM orders""")
def file_records(spark, folder):
    """Line estimates against the records read, file by file."""
    path = f"{land_orders(spark, folder)}/{landing.LANDING_PATTERN}"
    estimated = landing.with_chunks(landing.line_estimates(spark, path).filter(
        landing.file_suffix(F.col("filepath")) == ".csv"))
    read = landing.read_landing(spark, path, landing.landing_schema(), "csv")
    both = estimated.join(landing.processed_records(read), "filepath", "left")
    agree = F.col("estimated_records") == F.coalesce("records_processed", F.lit(0))
    return both.agg(
        F.sum("estimated_records").alias("estimated_records"),
        F.sum("records_processed").alias("records_processed"),
        F.bool_and(agree).alias("counts_agree"),
    )


@query("file_dedupe", "SELECT COUNT(*) AS new_records FROM orders WHERE o_orderdate >= '1998-01-01'")
def file_dedupe(spark, folder):
    """Old rows were processed before, and the new ones arrive twice."""
    path = workspace(spark, "redelivery")
    orders = star.table(spark, folder, "orders")
    before = F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz")
    old, new = landed_rows(orders.filter(before)), landed_rows(orders.filter(~before))
    for name, rows in (("first", old), ("second/again", old), ("second/new", new), ("second/copy", new)):
        rows.write.csv(f"{path}/{name}.csv", header=True)
    ledger = landing.file_metadata(spark, f"{path}/first.csv")
    ledger = ledger.select(landing.content_id(ledger).alias("content_id"))
    arrived = landing.file_metadata(spark, f"{path}/second").filter("is_supported_format")
    fresh = landing.unseen_files(arrived, ledger)
    lines = landing.line_estimates(spark, f"{path}/second")
    counted = lines.join(fresh.select("filepath"), "filepath", "left_semi")
    return counted.agg(F.sum("estimated_records").alias("new_records"))


@query("stream_files", f"""
    SELECT transaction_id, customer_id, product_id, quantity, amount FROM ({LANDED})""")
def stream_files(spark, folder):
    """Arrivals by stream, a file per batch; the second run finds nothing new."""
    path, out = land_orders(spark, folder), workspace(spark, "arrivals")
    stream = streams.file_stream(spark, f"{path}/{landing.LANDING_PATTERN}", landing.landing_schema(), "csv", files_per_batch=1)
    for _ in range(2):
        streams.run_available(stream, f"{out}/checkpoint", streams.append_arrivals(f"{out}/rows"))
    return plain(spark.read.parquet(f"{out}/rows").drop("batch_id"))


EVENT_FILES = 4


def event_stream(spark, folder):
    """The events as files of which each batch takes one; users recur in all of them."""
    events = star.table(spark, folder, "events")
    path = workspace(spark, "event_files")
    events.repartition(EVENT_FILES, F.xxhash64("event_id")).write.parquet(path)
    return streams.file_stream(spark, path, events.schema, files_per_batch=1)


@query("stream_upsert", """
    SELECT event_id, CAST(ts AS TIMESTAMP) AS ts, user_id, event_type, value, props FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_upsert(spark, folder):
    out = workspace(spark, "user_state")
    order = ["ts", "event_id"]
    streams.run_available(event_stream(spark, folder), f"{out}/checkpoint",
                          streams.append_newest(f"{out}/state", ["user_id"], order))
    return streams.current_state(spark, f"{out}/state", ["user_id"], order)


EVENT_CHECKS = [
    Completeness(table="events", min_count=1),
    NullRate(table="events", columns=["user_id", "value"], max_null_percentage=0.0),
    Rule(table="events", name="value_in_range", predicate="value BETWEEN 0 AND 300"),
]
EVENT_RULES = {"value_in_range": "value BETWEEN 0 AND 300"}


@query("stream_quality", """
    SELECT 'completeness' AS item, COUNT(*) AS rows_checked, CAST(0 AS BIGINT) AS rows_failed FROM events
    UNION ALL SELECT 'null_rate', COUNT(*), 0 FROM events
    UNION ALL SELECT 'rule:value_in_range', COUNT(*), COUNT(*) FILTER (WHERE value NOT BETWEEN 0 AND 300) FROM events
    UNION ALL SELECT 'accepted', COUNT(*) FILTER (WHERE value BETWEEN 0 AND 300), 0 FROM events
    UNION ALL SELECT 'quarantine', COUNT(*) FILTER (WHERE value NOT BETWEEN 0 AND 300), 0 FROM events""")
def stream_quality(spark, folder):
    out = workspace(spark, "event_quality")
    writer = streams.check_batches(out, EVENT_CHECKS, EVENT_RULES, "2024-01-31 00:00:00")
    streams.run_available(event_stream(spark, folder), f"{out}/checkpoint", writer)
    totals = spark.read.parquet(f"{out}/results").groupBy(F.col("check_type").alias("item")).agg(
        F.sum("rows_checked").alias("rows_checked"), F.sum("rows_failed").alias("rows_failed")
    )
    for part in ("accepted", "quarantine"):
        rows = spark.read.parquet(f"{out}/{part}")
        totals = totals.unionByName(rows.agg(F.count(F.lit(1)).alias("rows_checked")).select(
            F.lit(part).alias("item"), "rows_checked", F.lit(0).cast("bigint").alias("rows_failed")))
    return totals
