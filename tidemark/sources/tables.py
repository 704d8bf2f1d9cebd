"""Readers and writers for warehouse tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.sources.stored import StoredTable

def valid_table_name(spark: SparkSession, name: str) -> str:
    """A name of one or two parts, as Spark's own parser reads it."""
    try:
        parts = list(spark._jsparkSession.sessionState().sqlParser().parseMultipartIdentifier(name).mkString(".").split("."))
    except ParseException as error:
        raise ValueError(f"not a table name: {name!r}") from error
    if len(parts) > 2 or "`" in name:
        raise ValueError(f"not a table name: {name!r}")
    return name


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    column: str,
    lower: str,
    upper: str,
    partitions: int,
    fetch_size: int = 10_000,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A database table, read as ``partitions`` ranges of ``column``.

    The bounds only place the cuts; rows outside them land in the end ranges.
    """
    return (
        spark.read.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", valid_table_name(spark, table))
        .option("partitionColumn", column)
        .option("lowerBound", lower)
        .option("upperBound", upper)
        .option("numPartitions", partitions)
        .option("fetchsize", fetch_size)
        .load()
    )


def append_jdbc(
    df: DataFrame, url: str, table: str, *, batch_size: int = 1000, properties: Mapping[str, str] | None = None
) -> None:
    """Append rows to a database table, ``batch_size`` rows per statement."""
    (
        df.write.format("jdbc")
        .options(**(properties or {}))
        .option("url", url)
        .option("dbtable", valid_table_name(df.sparkSession, table))
        .option("batchsize", batch_size)
        .mode("append")
        .save()
    )


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text files as one row per line, column ``value``."""
    return spark.read.text(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a Parquet table; an empty input is an error, as for a bulk insert."""
    if df.isEmpty():
        raise ValueError("nothing to insert")
    df.write.mode("append").parquet(path)


def truncate_and_load(df: DataFrame, path: str) -> None:
    """Replace the whole content of a staging table."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)


def write_by_month(df: DataFrame, path: str, day: str) -> None:
    """Replace the months ``df`` has rows for in a stored table partitioned by month; other months keep their files."""
    dated = df.withColumns({"year": F.year(day), "month": F.month(day), "year_month": F.date_format(day, "yyyy-MM")})
    StoredTable(df.sparkSession, path).replace(dated, "year_month")


def run_query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], **parameters) -> DataFrame:
    """A SQL text over named DataFrames (``{name}``) with bound parameters (``:name``)."""
    return spark.sql(sql, args=parameters, **tables)


def observed_write(df: DataFrame, path: str, mode: str, partitions: Sequence[str] = (), **metrics: Column) -> dict:
    """Write Parquet and return aggregates gathered during that same pass."""
    observation = Observation()
    columns = [metric.alias(name) for name, metric in metrics.items()]
    # Counted after the exchange, in the tasks that write: a task of an earlier stage
    # that is repeated for a lost executor would be counted twice.
    placed = df.hint("rebalance", *partitions) if partitions else df
    observed = placed.observe(observation, F.count(F.lit(1)).alias("rows"), *columns)
    observed.write.mode(mode).partitionBy(*partitions).parquet(path)
    return observation.get


def day_series(spark: SparkSession, first: str, last: str) -> DataFrame:
    """One row per calendar day, both ends included."""
    return spark.sql(
        "SELECT explode(sequence(:first :: date, :last :: date, INTERVAL 1 DAY)) AS date",
        args={"first": first, "last": last},
    )


def number_series(spark: SparkSession, first: int, last: int) -> DataFrame:
    return spark.range(first, last + 1).withColumnRenamed("id", "i")


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table name and row count, stacked."""
    counted: Sequence[DataFrame] = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce_union(counted)


def reduce_union(frames: Sequence[DataFrame]) -> DataFrame:
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return union
