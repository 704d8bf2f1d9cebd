"""Load-pattern queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.keyed import lookup_join
from tidemark.operators.loads import full, incremental
from tidemark.plans.checks import SALE_RULES, WRONG_SALES
from tidemark.plans.generators import ids
from tidemark.plans.registry import plain, query
from tidemark.session import workspace
from tidemark.sources import generate, star
from tidemark.sources.stored import StoredTable
from tidemark.sources.tables import write_by_month

PIPELINE, TABLE = "sales_load", "warehouse.fact_sales"


def order_source(spark, folder):
    return star.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


@query("load_full", """
    SELECT o_orderkey, o_custkey, o_totalprice, TIMESTAMP '1998-06-30 06:00:00' AS created_at,
           CAST(o_orderdate AS TIMESTAMP) AS updated_at
    FROM orders WHERE o_orderdate <= DATE '1998-06-30' + 1""")
def load_full(spark, folder):
    return full.full_load(order_source(spark, folder), "o_orderdate", "1998-06-30", "1998-06-30 06:00:00")


@query("load_log", """
    SELECT 'order_load' AS pipeline_name, 'staging.orders' AS table_name, TIMESTAMP '1998-06-30' AS execution_date,
           'full' AS load_type, COUNT(*) AS records_extracted, COUNT(*) AS records_loaded,
           CAST(0 AS BIGINT) AS records_rejected, 'success' AS status
    FROM orders WHERE o_orderdate <= DATE '1998-06-30' + 1""")
def load_log(spark, folder):
    path = workspace(spark, "load_log")
    log = full.run_full_load(order_source(spark, folder), "o_orderdate", "1998-06-30", path, "order_load",
                             "staging.orders")
    return log.drop("start_time", "end_time")


def yearly_marks(spark, folder):
    """A watermark table with one run per order year; runs since 2000 failed."""
    orders = star.table(spark, folder, "orders")
    return orders.groupBy(F.year("o_orderdate").alias("year")).agg(F.max("o_orderdate").alias("watermark_value")).select(
        F.lit(PIPELINE).alias("pipeline_name"),
        F.lit(TABLE).alias("table_name"),
        "watermark_value",
        F.when(F.col("year") < 2000, "success").otherwise("failed").alias("status"),
    )


@query("load_watermark", """
    WITH w AS (SELECT MAX(o_orderdate) AS low FROM orders WHERE year(o_orderdate) < 2000),
         n AS (SELECT coalesce(MAX(o_orderdate), DATE '2000-12-31') AS high FROM orders
               WHERE o_orderdate <= DATE '2000-12-31')
    SELECT CAST(low AS TIMESTAMP) AS last_watermark, CAST(high AS TIMESTAMP) AS new_watermark,
           (SELECT COUNT(*) FROM orders WHERE o_orderdate > low AND o_orderdate <= high) AS records_loaded
    FROM w, n""")
def load_watermark(spark, folder):
    source = order_source(spark, folder)
    # The two marks are fetched, as a run does, so that each costs one scan and prunes the next.
    saved = incremental.last_watermark(yearly_marks(spark, folder), PIPELINE, TABLE).first().last_watermark
    low = full.moment(str(saved or incremental.EPOCH))
    high = full.moment(str(incremental.new_watermark(source, "o_orderdate", full.moment("2000-12-31 00:00:00")).first()[0]))
    found = incremental.batch_statistics(source, "o_orderdate", low, high)
    return found.select(low.alias("last_watermark"), high.alias("new_watermark"), "records_loaded")


LINE_KEYS = ["transaction_id"]
LOW, HIGH = "1999-01-01 00:00:00", "2000-07-01 00:00:00"


def line_source(spark, folder):
    """Line items as changing sales: the same order line may be shipped, hence restated, again."""
    return star.table(spark, folder, "lineitem").select(
        F.concat_ws("-", F.lit("TXN"), F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
        .alias("transaction_id"),
        F.col("l_shipdate").alias("last_modified"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_orderkey").alias("order_id"),
    )


def loaded_until(spark, folder, moment):
    known = line_source(spark, folder).filter(F.col("last_modified") <= full.moment(moment))
    return incremental.latest_per_key(known, LINE_KEYS, ["last_modified"])


LATEST_LINES = f"""
    SELECT transaction_id, last_modified, product_id, supplier_id, quantity, total_amount, return_flag, order_id FROM (
        SELECT *, row_number() OVER (PARTITION BY transaction_id ORDER BY last_modified DESC, product_id DESC,
                  supplier_id DESC, quantity DESC, total_amount DESC, return_flag DESC) AS rn
        FROM (SELECT 'TXN-' || l_orderkey || '-' || l_linenumber AS transaction_id,
                     CAST(l_shipdate AS TIMESTAMP) AS last_modified, l_partkey AS product_id, l_suppkey AS supplier_id,
                     l_quantity AS quantity, l_extendedprice AS total_amount, l_returnflag AS return_flag,
                     l_orderkey AS order_id FROM lineitem)
        WHERE last_modified <= TIMESTAMP '{HIGH}') WHERE rn = 1"""


@query("load_incremental", LATEST_LINES)
def load_incremental(spark, folder):
    source = line_source(spark, folder)
    batch = incremental.changed_between(source, "last_modified", full.moment(LOW), full.moment(HIGH))
    return incremental.upsert(loaded_until(spark, folder, LOW), batch, LINE_KEYS, ["last_modified"])


@query("load_late_buffer", LATEST_LINES)
def load_late_buffer(spark, folder):
    """Rows of flag N from the last thirty days before the mark came late; the buffer picks them up."""
    source = line_source(spark, folder)
    late = (F.col("last_modified") > full.moment(LOW) - F.expr("INTERVAL 30 DAYS")) & (F.col("return_flag") == "N")
    on_time = source.filter((F.col("last_modified") <= full.moment(LOW)) & ~late)
    target = incremental.latest_per_key(on_time, LINE_KEYS, ["last_modified"])
    batch = incremental.changed_between(source, "last_modified", full.moment(LOW), full.moment(HIGH), "30 DAYS")
    return incremental.upsert(target, batch, LINE_KEYS, ["last_modified"])


@query("load_incremental_table", LATEST_LINES)
def load_incremental_table(spark, folder):
    """The stored form: a base and two runs behind a saved mark."""
    source = line_source(spark, folder)
    path = workspace(spark, "incremental")
    target, marks = f"{path}/fact_sales", f"{path}/watermarks"
    first = source.filter(F.col("last_modified") <= full.moment("1996-01-01 00:00:00"))
    StoredTable(spark, target).rewrite(incremental.latest_per_key(first, LINE_KEYS, ["last_modified"]))
    start = full.moment("1996-01-01 00:00:00")
    incremental.watermark_row(spark, PIPELINE, TABLE, start, start, F.lit(0)).write.parquet(marks)
    for moment in (LOW, HIGH):
        incremental.run_incremental(spark, source, "last_modified", target, marks, LINE_KEYS, PIPELINE, TABLE, moment)
    return incremental.merged(StoredTable(spark, target), LINE_KEYS)


@query("scd1_upsert", """
    WITH t AS (SELECT * FROM customer WHERE c_acctbal >= 0), b AS (SELECT * FROM customer WHERE c_acctbal <= 5000)
    SELECT coalesce(t.c_custkey, b.c_custkey) AS customer_id,
           CASE WHEN b.c_custkey IS NULL THEN t.c_name ELSE upper(b.c_name) END AS customer_name,
           CASE WHEN t.c_custkey IS NULL THEN 'unknown' ELSE n_name END AS country,
           coalesce(t.c_mktsegment, lower(b.c_mktsegment)) AS segment,
           CASE WHEN b.c_custkey IS NULL THEN TIMESTAMP '2000-01-01' ELSE TIMESTAMP '2001-01-01' END AS updated_at
    FROM t FULL JOIN b ON t.c_custkey = b.c_custkey LEFT JOIN nation ON t.c_nationkey = n_nationkey""")
def scd1_upsert(spark, folder):
    customers = star.dim_customer(spark, folder).select("customer_id", "customer_name", "country", "segment")
    balance = star.table(spark, folder, "customer").select(F.col("c_custkey").alias("customer_id"), "c_acctbal")
    known = customers.join(balance.filter("c_acctbal >= 0"), "customer_id", "left_semi")
    target = known.withColumn("updated_at", full.moment("2000-01-01 00:00:00"))
    batch = customers.join(balance.filter("c_acctbal <= 5000"), "customer_id", "left_semi").select(
        "customer_id", F.upper("customer_name").alias("customer_name"), F.lit("unknown").alias("country"),
        F.lower("segment").alias("segment"),
    )
    return incremental.upsert_keeping(target, batch, "customer_id", ["customer_name"], "updated_at",
                                      full.moment("2001-01-01 00:00:00"))


@query("backfill_source", """
    SELECT c_custkey AS customer_id, CASE WHEN c_acctbal > 0 THEN 'source' ELSE 'warehouse' END AS origin,
           c_mktsegment AS segment FROM customer""")
def backfill_source(spark, folder):
    """Customers missing from the source table are filled in from the warehouse dimension."""
    customer = star.table(spark, folder, "customer")
    columns = [F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("segment")]
    source = customer.filter("c_acctbal > 0").select(columns[0], F.lit("source").alias("origin"), columns[1])
    warehouse = star.dim_customer(spark, folder).select("customer_id", F.lit("warehouse").alias("origin"), "segment")
    return incremental.insert_ignore(source, warehouse, ["customer_id"], ["origin"])


RULE_REASONS = ", ".join(f"CASE WHEN NOT ({p}) THEN '{n}' END" for n, p in SALE_RULES.items())


def staged_sales(spark, folder):
    facts = generate.sales(ids(spark, folder, "orders", "o_orderkey"), wrong_total_every=201)
    return facts.withColumn("is_processed", F.lit(False))


def judged_sales(spark, folder):
    parts = star.table(spark, folder, "part").filter("p_brand <> 'Brand#13'")
    customers = star.table(spark, folder, "customer").filter("c_mktsegment <> 'MACHINERY'")
    return full.judge_staging(staged_sales(spark, folder), SALE_RULES, {
        "product_id": (parts, "p_partkey"), "customer_id": (customers, "c_custkey"),
    })


JUDGED = f"""
    SELECT 'TXN-' || lpad(CAST(i AS VARCHAR), 8, '0') AS transaction_id,
           concat_ws(',', {RULE_REASONS},
               CASE WHEN 1 + (i * 7) % 500 NOT IN (SELECT p_partkey FROM part WHERE p_brand <> 'Brand#13')
                    THEN 'unknown_product_id' END,
               CASE WHEN customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'MACHINERY')
                    THEN 'unknown_customer_id' END) AS reasons,
           CAST(total_amount AS DOUBLE) AS total_amount FROM {WRONG_SALES}"""


@query("promote_staging", f"SELECT transaction_id, total_amount FROM ({JUDGED}) WHERE reasons = ''")
def promote_staging(spark, folder):
    accepted, _ = full.promote(judged_sales(spark, folder))
    return plain(accepted.select("transaction_id", "total_amount"))


@query("reject_staging", f"SELECT transaction_id, reasons FROM ({JUDGED}) WHERE reasons <> ''")
def reject_staging(spark, folder):
    _, rejected = full.promote(judged_sales(spark, folder))
    return rejected.select("transaction_id", F.array_join("reject_reasons", ",").alias("reasons"))


@query("promotion_log", f"""
    SELECT outcome, COUNT(*) AS stored, CAST(SUM(total_amount) AS DOUBLE) AS amount,
           (SELECT COUNT(*) FROM ({JUDGED}) WHERE reasons = '') AS records_loaded,
           (SELECT COUNT(*) FROM ({JUDGED}) WHERE reasons <> '') AS records_rejected
    FROM (SELECT CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome,
                 CAST(total_amount AS DECIMAL(18,2)) AS total_amount FROM ({JUDGED}))
    GROUP BY outcome""")
def promotion_log(spark, folder):
    """Both outcomes as stored by one pass, next to the counts of the load log."""
    path = workspace(spark, "promotion")
    log = full.write_promotion(judged_sales(spark, folder), path, ["transaction_id"], "b1", PIPELINE, TABLE,
                               "2024-10-15 00:00:00").first()
    stored = full.read_promoted(spark, path).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("stored"), F.sum("total_amount").cast("double").alias("amount"))
    return stored.select(
        "outcome", "stored", "amount", F.lit(log.records_loaded).cast("bigint").alias("records_loaded"),
        F.lit(log.records_rejected).cast("bigint").alias("records_rejected"),
    )


@query("promote_batches", f"""
    SELECT transaction_id, outcome, CASE WHEN outcome = 'rejected' OR i % 2 = 0 THEN 'even' ELSE 'odd' END AS batch, total_amount
    FROM (SELECT transaction_id, CAST(substr(transaction_id, 5) AS BIGINT) AS i, total_amount,
                 CASE WHEN reasons = '' THEN 'accepted' ELSE 'rejected' END AS outcome FROM ({JUDGED}))
    UNION ALL
    SELECT transaction_id, 'rejected', 'odd', total_amount FROM ({JUDGED}) WHERE reasons <> ''""")
def promote_batches(spark, folder):
    """Two batches, the first delivered twice; the second repeats all rejected rows and a third of the first."""
    path = workspace(spark, "promotion_batches")
    judged = judged_sales(spark, folder)
    number = F.substring("transaction_id", 5, 20).cast("bigint")
    rejected = F.size("reject_reasons") > 0
    batches = {"even": (number % 2 == 0) | rejected, "odd": (number % 2 == 1) | (number % 3 == 0) | rejected}
    for batch in ("even", "odd", "even"):
        full.write_promotion(judged.filter(batches[batch]), path, ["transaction_id"], batch, PIPELINE, TABLE,
                             "2024-10-15 00:00:00")
    return plain(full.read_promoted(spark, path).select("transaction_id", "outcome", "batch", "total_amount"))


def sold_lines(spark, folder):
    lines = star.table(spark, folder, "lineitem").select(
        F.col("l_partkey").alias("product_id"), "l_returnflag", F.col("l_extendedprice").cast("decimal(12,2)").alias("amount")
    )
    products = star.dim_product(spark, folder).select("product_id", "category")
    return lookup_join(lines, products, ["product_id"], unique=True)


@query("category_load", """
    SELECT p_type AS category, COUNT(*) AS loaded, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_returnflag <> 'R' GROUP BY p_type""")
def category_load(spark, folder):
    path = workspace(spark, "categories")
    full.load_categories(sold_lines(spark, folder), "category", F.col("l_returnflag") != "R", path)
    stored = StoredTable(spark, path).read().groupBy("category")
    return plain(stored.agg(F.count(F.lit(1)).alias("loaded"), F.sum("amount").alias("amount")))


@query("category_etl", """
    WITH c AS (
        SELECT p_type AS category, COUNT(*) AS extracted, COUNT(*) FILTER (WHERE l_returnflag <> 'R') AS transformed,
               COUNT(*) FILTER (WHERE l_returnflag = 'R') AS rejected,
               SUM(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag <> 'R') AS loaded_amount
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_type),
    a AS (SELECT * FROM c UNION ALL
          SELECT 'ALL', CAST(SUM(extracted) AS BIGINT), CAST(SUM(transformed) AS BIGINT), CAST(SUM(rejected) AS BIGINT),
                 SUM(loaded_amount) FROM c)
    SELECT category, extracted, transformed, rejected, CAST(loaded_amount AS DOUBLE) AS loaded_amount,
           transformed * 100.0::DOUBLE / extracted AS data_quality_rate FROM a""")
def category_etl(spark, folder):
    totals = full.category_totals(sold_lines(spark, folder), "category", F.col("l_returnflag") != "R", "amount")
    return plain(full.category_fan_in(totals, "category"))


@query("partitioned_write", """
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month, COUNT(*) AS orders_stored,
           CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM orders GROUP BY 1, 2""")
def partitioned_write(spark, folder):
    """Written twice, the second time only from 1999 on: earlier months must stay."""
    path = workspace(spark, "orders_by_month")
    orders = order_source(spark, folder)
    write_by_month(orders, path, "o_orderdate")
    write_by_month(orders.filter(F.year("o_orderdate") >= 1999), path, "o_orderdate")
    amount = F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("amount")
    stored = StoredTable(spark, path).read().groupBy("year", "month").agg(F.count(F.lit(1)).alias("orders_stored"), amount)
    return plain(stored)
