"""Name to query and name to SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles and dates as text, for output shared with other engines."""
    def shown(field: T.StructField):
        if isinstance(field.dataType, T.DecimalType):
            return F.col(field.name).cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return F.date_format(field.name, "yyyy-MM-dd").alias(field.name)
        return F.col(field.name)

    return df.select(*[shown(f) for f in df.schema.fields])
