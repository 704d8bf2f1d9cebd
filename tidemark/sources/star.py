"""The star schema the reports and checks work on, over the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.functions.columns import date_key
from tidemark.functions.keyed import lookup_join
from tidemark.sources.generate import date_dimension, days_covered


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    named = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("country"))
    return lookup_join(customer, named, ["c_nationkey"]).select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_key"),
        F.col("c_name").alias("customer_name"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        "country",
        F.col("c_mktsegment").alias("segment"),
    )


def dim_product(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.concat(F.lit("PROD-"), F.col("p_partkey").cast("string")).alias("product_key"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("subcategory"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("unit_price"),
    )


def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return date_dimension(days_covered(table(spark, folder, "orders"), "o_orderdate"))


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with exact amounts: gross, discount and total.

    All of them stay within 18 digits, up to which decimals are computed as plain longs.
    """
    gross = F.col("l_extendedprice").cast("decimal(12,2)")
    discount = (gross * F.col("l_discount").cast("decimal(4,2)")).cast("decimal(16,4)")
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        gross.alias("gross_amount"),
        discount.alias("discount"),
        (gross - discount).cast("decimal(16,4)").alias("total_amount"),
    )


def sale_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        date_key(F.col("o_orderdate")).alias("sale_date_id"),
    )


def fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item with its customer, product and date keys."""
    lines, orders = sale_lines(spark, folder), sale_orders(spark, folder)
    sold = lookup_join(lines, orders, ["order_id"])
    return sold.withColumn(
        "transaction_id",
        F.concat_ws("-", F.lit("TXN"), F.col("order_id").cast("string"), F.col("line_number").cast("string")),
    )


def customer_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """A change feed for the customer dimension: every order restates its customer,
    whose segment is taken to be the priority of that order."""
    orders = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("segment"),
        F.col("o_orderdate").alias("extract_timestamp"),
        F.col("o_orderkey").alias("change_id"),
    )
    return orders
