"""Report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import reports
from tidemark.plans.registry import plain, query
from tidemark.sources import star
from tidemark.sources.tables import row_counts, run_query

LINES = """
    SELECT o_custkey AS customer_id, o_orderdate, c_mktsegment AS segment,
           p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CAST(l_quantity AS BIGINT) AS quantity,
           CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - CAST(CAST(l_extendedprice AS DECIMAL(18,2))
                * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS total_amount
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    JOIN customer ON o_custkey = c_custkey
    JOIN part ON l_partkey = p_partkey
"""
REVENUE = "CAST(SUM(total_amount) AS DOUBLE)"


def enriched(spark, folder):
    return reports.enrich_sales(
        star.fact_sales(spark, folder), star.dim_customer(spark, folder), star.dim_product(spark, folder),
        star.dim_date(spark, folder),
    )


@query("sales_by_category", f"""
    WITH s AS ({LINES})
    SELECT category, COUNT(*) AS num_orders, CAST(SUM(quantity) AS BIGINT) AS total_quantity,
           {REVENUE} AS total_revenue, {REVENUE} / COUNT(*) AS avg_order_value
    FROM s GROUP BY category ORDER BY total_revenue DESC, category""")
def sales_by_category(spark, folder):
    return plain(reports.sales_by_category(enriched(spark, folder)))


@query("sales_by_segment", f"""
    WITH s AS ({LINES})
    SELECT segment, COUNT(*) AS num_orders, {REVENUE} AS total_revenue, {REVENUE} / COUNT(*) AS avg_order_value
    FROM s GROUP BY segment ORDER BY total_revenue DESC, segment""")
def sales_by_segment(spark, folder):
    return plain(reports.sales_by_segment(enriched(spark, folder)))


@query("monthly_trend", f"""
    WITH s AS ({LINES})
    SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month,
           COUNT(*) AS num_orders, {REVENUE} AS total_revenue
    FROM s GROUP BY 1, 2 ORDER BY year DESC, month DESC LIMIT 12""")
def monthly_trend(spark, folder):
    return plain(reports.monthly_trend(enriched(spark, folder)))


@query("top_products", f"""
    WITH s AS ({LINES})
    SELECT product_id, product_name, category, {REVENUE} AS total_revenue,
           CAST(SUM(quantity) AS BIGINT) AS total_quantity
    FROM s GROUP BY 1, 2, 3 ORDER BY SUM(total_amount) DESC, product_id LIMIT 10""")
def top_products(spark, folder):
    return plain(reports.top_products(enriched(spark, folder)))


WORDS = r"""
    SELECT unnest(regexp_split_to_array(lower(trim(text, ' ')), '[ \t\n\x0B\f\r]+')) AS word FROM documents
"""


@query("word_count", f"""
    SELECT word, COUNT(*) AS count FROM ({WORDS}) WHERE word <> '' GROUP BY word""")
def word_count(spark, folder):
    return reports.word_count(star.table(spark, folder, "documents"), "text")


@query("word_totals", f"""
    SELECT COUNT(*) AS total_words, COUNT(DISTINCT word) AS unique_words FROM ({WORDS}) WHERE word <> ''""")
def word_totals(spark, folder):
    return reports.word_totals(reports.word_count(star.table(spark, folder, "documents"), "text"))


@query("customer_summary", """
    SELECT COUNT(*) AS total_customers, COUNT(nullif(c_mktsegment, 'MACHINERY')) AS customers_with_email,
           COUNT(DISTINCT n_name) AS countries
    FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def customer_summary(spark, folder):
    # Machinery customers stand for those without an address.
    customers = star.dim_customer(spark, folder)
    with_gaps = customers.withColumn("email", F.when(F.col("segment") != "MACHINERY", F.col("email")))
    return reports.customer_summary(with_gaps)


STACKED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")


@query("table_counts", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in STACKED))
def table_counts(spark, folder):
    return row_counts({name: star.table(spark, folder, name) for name in STACKED})


PROFILED = {
    "customer": "c_acctbal < 0",
    "part": None,
    "orders": "o_orderstatus = 'P'",
    "lineitem": "l_returnflag = 'R'",
}


@query("dataset_profile", " UNION ALL ".join(f"""
    SELECT '{name}' AS table_name, COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE {condition or 'FALSE'}) AS defect_rows,
           round(COUNT(*) FILTER (WHERE {condition or 'FALSE'}) * 100.0::DOUBLE / COUNT(*), 2) AS defect_percent
    FROM {name}""" for name, condition in PROFILED.items()))
def dataset_profile(spark, folder):
    return reports.dataset_profile(
        {name: (star.table(spark, folder, name), condition) for name, condition in PROFILED.items()}
    )


@query("duplicate_summary", """
    SELECT CAST(SUM(n) AS BIGINT) AS total_rows, COUNT(*) AS unique_keys,
           CAST(SUM(n) - COUNT(*) AS BIGINT) AS duplicates
    FROM (SELECT COUNT(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""")
def duplicate_summary(spark, folder):
    return reports.duplicate_summary(star.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("having_duplicates", """
    SELECT l_orderkey, l_linenumber, COUNT(*) AS count FROM lineitem
    GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1""")
def having_duplicates(spark, folder):
    return reports.repeated_keys(star.table(spark, folder, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("filtered_counts", """
    SELECT COUNT(*) AS total_rows, COUNT(*) FILTER (WHERE l_returnflag = 'R') AS returned,
           COUNT(*) FILTER (WHERE l_discount = 0) AS undiscounted,
           COUNT(*) FILTER (WHERE l_quantity BETWEEN 10 AND 20 AND l_linestatus = 'O') AS mid_open
    FROM lineitem""")
def filtered_counts(spark, folder):
    return reports.counts_where(star.table(spark, folder, "lineitem"), {
        "returned": "l_returnflag = 'R'",
        "undiscounted": "l_discount = 0",
        "mid_open": "l_quantity BETWEEN 10 AND 20 AND l_linestatus = 'O'",
    })


@query("min_max", """
    SELECT MIN(o_totalprice) AS min_o_totalprice, MAX(o_totalprice) AS max_o_totalprice,
           MIN(o_orderkey) AS min_o_orderkey, MAX(o_orderkey) AS max_o_orderkey FROM orders""")
def min_max(spark, folder):
    return reports.value_range(star.table(spark, folder, "orders"), ["o_totalprice", "o_orderkey"])


@query("distinct_values", "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark, folder):
    return star.table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("param_query", """
    SELECT o_orderpriority, COUNT(*) AS orders_found FROM orders
    WHERE o_orderstatus = 'F' AND o_totalprice > 100000.0 GROUP BY o_orderpriority""")
def param_query(spark, folder):
    return run_query(
        spark,
        "SELECT o_orderpriority, COUNT(*) AS orders_found FROM {orders} "
        "WHERE o_orderstatus = :status AND o_totalprice > :floor GROUP BY o_orderpriority",
        {"orders": star.table(spark, folder, "orders")},
        status="F", floor=100000.0,
    )
