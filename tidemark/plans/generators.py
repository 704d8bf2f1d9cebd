"""Generator queries: the ids come from the supplied tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.loads.incremental import insert_ignore
from tidemark.plans.registry import plain, query
from tidemark.sources import generate, star


def ids(spark, folder, name, key):
    return star.table(spark, folder, name).select(F.col(key).alias("i"))


def _list(words):
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _pick(words, position):
    return f"{_list(words)}[({position}) % {len(words)} + 1]"


CALENDAR = """
    SELECT CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_id, strftime(date, '%Y-%m-%d') AS date,
           CAST(year(date) AS INTEGER) AS year, CAST(quarter(date) AS INTEGER) AS quarter,
           CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
           CAST({week} AS INTEGER) AS week, CAST(isodow(date) AS INTEGER) AS day_of_week,
           dayname(date) AS day_name, isodow(date) IN (6, 7) AS is_weekend,
           strftime(date, '%m-%d') IN ('01-01', '07-04', '12-25') AS is_holiday
    FROM ({days})
"""
ORDER_DAYS = """
    SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS first, MAX(CAST(o_orderdate AS DATE)) AS last FROM orders)
"""


@query("gen_date_dim", CALENDAR.format(week="weekofyear(date)", days=ORDER_DAYS))
def gen_date_dim(spark, folder):
    return plain(star.dim_date(spark, folder))


@query("gen_date_dim_sunday_weeks", CALENDAR.format(week="strftime(date, '%U')", days=ORDER_DAYS))
def gen_date_dim_sunday_weeks(spark, folder):
    days = generate.days_covered(star.table(spark, folder, "orders"), "o_orderdate")
    return plain(generate.date_dimension(days, iso_weeks=False))


FIRST = _pick(generate.FIRST_NAMES, "i")
LAST = _pick(generate.LAST_NAMES, "i // 20")


@query("gen_customers", f"""
    SELECT 'CUST-' || lpad(CAST(i AS VARCHAR), 5, '0') AS customer_key, {FIRST} || ' ' || {LAST} AS customer_name,
           CASE WHEN i % 50 <> 0
                THEN lower({FIRST} || '.' || {LAST}) || CAST(i AS VARCHAR) || '@example.com' END AS email,
           {_pick(generate.COUNTRIES, "i")} AS country,
           CASE WHEN i % 10 < 2 THEN 'Enterprise' WHEN i % 10 < 6 THEN 'SMB' ELSE 'Consumer' END AS segment
    FROM (SELECT c_custkey AS i FROM customer)""")
def gen_customers(spark, folder):
    return generate.customers(ids(spark, folder, "customer", "c_custkey"))


@query("gen_products", f"""
    SELECT 'PROD-' || {_pick(generate.PRODUCT_LETTERS, "i")} || lpad(CAST(i // 10 AS VARCHAR), 3, '0') AS product_key,
           {_pick(generate.PRODUCT_GRADES, "i")} || ' ' || {_pick(generate.PRODUCT_KINDS, "i // 10")} AS product_name,
           {_pick(generate.CATEGORIES, "i")} AS category, {_pick(generate.SUBCATEGORIES, "i // 5")} AS subcategory,
           CAST(5 + (i % 100) * 5 AS DOUBLE) AS unit_price
    FROM (SELECT p_partkey AS i FROM part)""")
def gen_products(spark, folder):
    return plain(generate.products(ids(spark, folder, "part", "p_partkey")))


def _sale_sql(key, customer, step, first, spread, quantity, price, discount, undiscounted, extra=""):
    gross = f"({quantity}) * ({price})"
    return f"""
        SELECT {key} AS transaction_id, {customer} AS customer_id, 1 + (i * {step}) % 500 AS product_id,
               CAST(strftime(DATE '{first}' + CAST(i % {spread} AS INTEGER), '%Y%m%d') AS INTEGER) AS sale_date_id,
               CAST({quantity} AS INTEGER) AS quantity, CAST({price} AS DOUBLE) AS unit_price,
               CAST({discount} AS DOUBLE) AS discount,
               CAST({gross} AS DOUBLE) - CASE WHEN {undiscounted} THEN 0.0::DOUBLE
                                              ELSE CAST({discount} AS DOUBLE) END AS total_amount{extra}
    """


SALES = _sale_sql(
    "'TXN-' || lpad(CAST(i AS VARCHAR), 8, '0')",
    "CASE WHEN i % 50 <> 0 THEN 1 + i % 1000 END", 7, "2020-01-01", 1826,
    "CASE WHEN i % 100 = 0 THEN -(1 + i % 10) ELSE 1 + i % 10 END", "10 + (i % 50) * 5", "(i % 20) * 2.5",
    "i % 200 = 0") + " FROM (SELECT o_orderkey AS i FROM orders)"
REPEATED = _sale_sql(
    "'TXN-' || lpad(CAST(i % 1000 AS VARCHAR), 8, '0')", "1 + i % 1000", 11, "2020-01-01", 365,
    "1 + i % 5", "15 + (i % 30) * 5", "(i % 10) * 2.0", "FALSE") + " FROM (SELECT c_custkey AS i FROM customer)"
STAGED = _sale_sql(
    "'TXN-STAGE-' || lpad(CAST(i AS VARCHAR), 6, '0')", "1 + i % 1000", 13, "2024-10-01", 15,
    "1 + i % 5", "20 + (i % 40) * 5", "(i % 15) * 3.0", "FALSE",
    ", 'POS_SYSTEM' AS source_system, FALSE AS is_processed") + " FROM (SELECT o_orderkey AS i FROM orders)"


@query("gen_sales", SALES)
def gen_sales(spark, folder):
    return plain(generate.sales(ids(spark, folder, "orders", "o_orderkey")))


@query("gen_sales_with_duplicates", f"{SALES} UNION ALL {REPEATED}")
def gen_sales_with_duplicates(spark, folder):
    first = generate.sales(ids(spark, folder, "orders", "o_orderkey"))
    again = generate.repeated_sales(ids(spark, folder, "customer", "c_custkey"))
    return plain(first.unionByName(again))


@query("gen_staging", STAGED)
def gen_staging(spark, folder):
    return plain(generate.staging_sales(ids(spark, folder, "orders", "o_orderkey")))


@query("gen_scd_rows", """
    SELECT 'CUST-' || lpad(CAST(i AS VARCHAR), 3, '0') AS customer_key, 'Customer ' || i AS customer_name,
           'customer' || i || '@example.com' AS email,
           CASE i % 3 WHEN 0 THEN 'USA' WHEN 1 THEN 'Canada' ELSE 'UK' END AS country,
           CASE i % 3 WHEN 0 THEN 'Enterprise' WHEN 1 THEN 'SMB' ELSE 'Consumer' END AS segment
    FROM (SELECT c_custkey AS i FROM customer)""")
def gen_scd_rows(spark, folder):
    return generate.scd_rows(ids(spark, folder, "customer", "c_custkey"))


def _drawn(tag, seed=42):
    shift = seed * 69621 + generate.DRAWS.index(tag) * 40692
    prime = generate.DRAW_PRIME
    start = f"(((i % {prime}) * 48271 + {shift}) % {prime})"
    squared = f"(({start} * {start} + {shift}) % {prime})"
    return f"((({squared} * {squared} + {start}) % {prime}) / {prime}::DOUBLE)"


def _below(tag, count):
    return f"CAST(floor({_drawn(tag)} * {count}) AS INTEGER)"


DRAWN_SALES = f"""
    SELECT lpad(CAST(number AS VARCHAR), 8, '0') AS number, customer_id, product_id,
           CAST(strftime(DATE '2024-01-01' + day, '%Y%m%d') AS INTEGER) AS sale_date_id, quantity,
           CAST(unit_price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS discount,
           CAST(quantity * unit_price - CASE WHEN wrong THEN 0 ELSE discount END AS DOUBLE) AS total_amount
    FROM (SELECT CASE WHEN {_drawn("duplicate")} < {{duplicates}} THEN CAST(floor({_drawn("earlier")} * i) AS BIGINT)
                      ELSE i END AS number,
                 CASE WHEN {_drawn("orphan")} >= {{orphans}} THEN 1 + {_below("customer", 100)} END AS customer_id,
                 1 + {_below("product", 50)} AS product_id, {_below("day", 366)} AS day,
                 CASE WHEN {_drawn("negative")} < {{negatives}} THEN -(1 + {_below("returned", 5)})
                      ELSE 1 + {_below("quantity", 10)} END AS quantity,
                 {_below("price", 100)} AS unit_price, {_below("discount", 10)} AS discount,
                 {_drawn("wrong")} < {{wrong}} AS wrong
          FROM (SELECT o_orderkey AS i FROM orders))
"""


@query("gen_sales_at_rates", f"SELECT 'TXN-' || number AS transaction_id, * EXCLUDE (number) FROM ("
       + DRAWN_SALES.format(duplicates=0.03, orphans=0.02, negatives=0.01, wrong=0.005) + ")")
def gen_sales_at_rates(spark, folder):
    return plain(generate.sales_at_rates(ids(spark, folder, "orders", "o_orderkey")))


def _drawn_word(words, tag):
    return f"{_list(words)}[{_below(tag, len(words))} + 1]"


@query("gen_customers_at_rate", f"""
    SELECT 'CUST-' || lpad(CAST(i AS VARCHAR), 5, '0') AS customer_key, first || ' ' || last AS customer_name,
           CASE WHEN email >= 0.02 THEN lower(first || '.' || last) || i || '@example.com' END AS email, country,
           CASE WHEN segment < 0.2 THEN 'Enterprise' WHEN segment < 0.6 THEN 'SMB' ELSE 'Consumer' END AS segment
    FROM (SELECT i, {_drawn_word(generate.FIRST_NAMES, "first")} AS first, {_drawn_word(generate.LAST_NAMES, "last")} AS last,
                 {_drawn("email")} AS email, {_drawn_word(generate.COUNTRIES, "country")} AS country,
                 {_drawn("segment")} AS segment FROM (SELECT c_custkey AS i FROM customer))""")
def gen_customers_at_rate(spark, folder):
    return generate.customers_at_rate(ids(spark, folder, "customer", "c_custkey"))


@query("gen_staging_at_rates", f"SELECT 'TXN-STAGE-' || number AS transaction_id, * EXCLUDE (number), "
       "'POS_SYSTEM' AS source_system, FALSE AS is_processed FROM ("
       + DRAWN_SALES.format(duplicates=0, orphans=0, negatives=0, wrong=0) + ")")
def gen_staging_at_rates(spark, folder):
    return plain(generate.staging_at_rates(ids(spark, folder, "orders", "o_orderkey")))


@query("insert_ignore", f"""
    WITH s AS ({SALES}), r AS ({REPEATED}),
    first AS (
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY transaction_id
                ORDER BY customer_id, product_id, sale_date_id, quantity, unit_price, discount, total_amount) AS rn
            FROM r) WHERE rn = 1)
    SELECT * FROM s UNION ALL SELECT * FROM first WHERE transaction_id NOT IN (SELECT transaction_id FROM s)""")
def insert_ignore_query(spark, folder):
    target = generate.sales(ids(spark, folder, "orders", "o_orderkey"))
    batch = generate.repeated_sales(ids(spark, folder, "customer", "c_custkey"))
    return plain(insert_ignore(target, batch, ["transaction_id"], ["customer_id"]))


@query("extend_date_dim", CALENDAR.format(week="weekofyear(date)", days="""
    SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT MIN(CAST(o_orderdate AS DATE)) AS first, MAX(CAST(o_orderdate AS DATE)) AS last FROM orders)
    UNION
    SELECT CAST(unnest(generate_series(first, last, INTERVAL 1 DAY)) AS DATE) AS date
    FROM (SELECT MIN(CAST(l_shipdate AS DATE)) AS first, MAX(CAST(l_shipdate AS DATE)) AS last FROM lineitem)"""))
def extend_date_dim(spark, folder):
    """The order calendar, extended by the days of the shipments it does not cover."""
    shipped = generate.days_covered(star.table(spark, folder, "lineitem"), "l_shipdate")
    return plain(insert_ignore(star.dim_date(spark, folder), generate.date_dimension(shipped), ["date_id"], ["date"]))
