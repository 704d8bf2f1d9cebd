"""Sales and text reports, and small table summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.columns import percent
from tidemark.functions.keyed import lookup_join
from tidemark.sources.tables import reduce_union


def enrich_sales(fact: DataFrame, customers: DataFrame, products: DataFrame, dates: DataFrame,
                 skewed: Sequence[str] = ()) -> DataFrame:
    """Facts with their dimension attributes; a fact lacking any dimension row is dropped.

    ``skewed`` names key columns known to be dominated by few keys. It decides how rows are spread, never which
    rows come out.
    """
    calendar = dates.select(F.col("date_id").alias("sale_date_id"), "year", "month")
    sides = {
        "customer_id": customers.select("customer_id", "segment", "country"),
        "product_id": products.select("product_id", "product_name", "category"),
        "sale_date_id": calendar,
    }
    enriched = fact
    for key, side in sides.items():
        enriched = lookup_join(enriched, side, [key], unique=True, skewed=key in skewed)
    return enriched


def _orders() -> Column:
    return F.count(F.lit(1)).alias("num_orders")


def _quantity() -> Column:
    return F.sum("quantity").alias("total_quantity")


def _revenue() -> Column:
    return F.sum("total_amount").alias("total_revenue")


def _with_average(report: DataFrame) -> DataFrame:
    average = F.col("total_revenue").cast("double") / F.col("num_orders")
    return report.withColumn("avg_order_value", average)


def sales_by_category(enriched: DataFrame) -> DataFrame:
    report = enriched.groupBy("category").agg(_orders(), _quantity(), _revenue())
    return _with_average(report).orderBy(F.desc("total_revenue"), "category")


def sales_by_segment(enriched: DataFrame) -> DataFrame:
    report = enriched.groupBy("segment").agg(_orders(), _revenue())
    return _with_average(report).orderBy(F.desc("total_revenue"), "segment")


def monthly_trend(enriched: DataFrame, months: int = 12) -> DataFrame:
    report = enriched.groupBy("year", "month").agg(_orders(), _revenue())
    return report.orderBy(F.desc("year"), F.desc("month")).limit(months)


def top_products(enriched: DataFrame, count: int = 10) -> DataFrame:
    report = enriched.groupBy("product_id", "product_name", "category").agg(_revenue(), _quantity())
    return report.orderBy(F.desc("total_revenue"), "product_id").limit(count)


def words(lines: DataFrame, text: str = "value") -> DataFrame:
    """One row per word: lower case, split on white space, empty strings left out."""
    split = F.split(F.lower(F.trim(F.col(text))), r"\s+")
    return lines.select(F.explode(split).alias("word")).filter("word <> ''")


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    counted = words(lines, text).groupBy("word").agg(F.count(F.lit(1)).alias("count"))
    return counted.orderBy(F.desc("count"), "word")


def word_totals(counts: DataFrame) -> DataFrame:
    return counts.agg(F.sum("count").alias("total_words"), F.count(F.lit(1)).alias("unique_words"))


def customer_summary(customers: DataFrame) -> DataFrame:
    return customers.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.count("email").alias("customers_with_email"),
        F.count_distinct("country").alias("countries"),
    )


def counts_where(df: DataFrame, conditions: Mapping[str, Column | str]) -> DataFrame:
    """Row count plus one conditional count per named condition, in one pass."""
    def condition(c):
        return F.expr(c) if isinstance(c, str) else c

    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(condition(c)).alias(name) for name, c in conditions.items()],
    )


def dataset_profile(tables: Mapping[str, tuple[DataFrame, Column | str | None]]) -> DataFrame:
    """Rows, defective rows and their percentage per table, stacked."""
    rows = []
    for name, (frame, defect) in tables.items():
        found = counts_where(frame, {"defect_rows": F.lit(False) if defect is None else defect})
        rows.append(
            found.select(
                F.lit(name).alias("table_name"),
                "total_rows",
                "defect_rows",
                F.round(percent(F.col("defect_rows"), F.col("total_rows")), 2).alias("defect_percent"),
            )
        )
    return reduce_union(rows)


def duplicate_summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, distinct keys and surplus rows, by one key aggregation."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"), F.count(F.lit(1)).alias("unique_keys")
    ).withColumn("duplicates", F.col("total_rows") - F.col("unique_keys"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys on more than one row, with their row count."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counted.filter(F.col("count") > 1)


def value_range(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    ends = [end for c in columns for end in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return df.agg(*ends)
