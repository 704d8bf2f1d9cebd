"""Full loads, staging promotion and the per-category pipeline."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.functions.columns import percent
from tidemark.functions.keyed import first_per_key, lookup_join
from tidemark.sources.stored import StoredTable
from tidemark.sources.tables import observed_write, reduce_union

LOAD_LOG = (
    "pipeline_name string, table_name string, execution_date timestamp_ntz, load_type string, "
    "records_extracted bigint, records_loaded bigint, records_rejected bigint, "
    "start_time timestamp_ntz, end_time timestamp_ntz, status string"
)


def moment(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def end_of_day(day: str) -> Column:
    """Midnight after ``day``: a load for that day takes rows up to this moment."""
    return F.date_add(F.lit(day).cast("date"), 1).cast("timestamp_ntz")


def full_load(source: DataFrame, changed_at: str, day: str, loaded_at: str) -> DataFrame:
    """The source as known at the end of ``day``, stamped with the load and change times."""
    known = source.filter(F.col(changed_at) <= end_of_day(day))
    kept = [c for c in source.columns if c != changed_at]
    return known.select(*kept, moment(loaded_at).alias("created_at"), F.col(changed_at).alias("updated_at"))


def log_row(spark: SparkSession, pipeline: str, table: str, execution_date: str, load_type: str,
            extracted: int, loaded: int, rejected: int = 0, status: str = "success") -> DataFrame:
    """One load-log row, to be appended after the load has been written."""
    return spark.range(1).select(
        F.lit(pipeline).alias("pipeline_name"),
        F.lit(table).alias("table_name"),
        moment(execution_date).alias("execution_date"),
        F.lit(load_type).alias("load_type"),
        F.lit(extracted).cast("bigint").alias("records_extracted"),
        F.lit(loaded).cast("bigint").alias("records_loaded"),
        F.lit(rejected).cast("bigint").alias("records_rejected"),
        moment(execution_date).alias("start_time"),
        F.localtimestamp().alias("end_time"),
        F.lit(status).alias("status"),
    )


def run_full_load(source: DataFrame, changed_at: str, day: str, path: str, pipeline: str, table: str) -> DataFrame:
    """Replace the staging table and return its log row; rows are counted while written."""
    loaded = full_load(source, changed_at, day, f"{day} 00:00:00")
    written = observed_write(loaded, path, "overwrite")["rows"]
    return log_row(source.sparkSession, pipeline, table, f"{day} 00:00:00", "full", written, written)


def failed_rules(rules: Mapping[str, str]) -> Column:
    """Names of the predicates a row breaks (false, as opposed to NULL)."""
    broken = [F.when(~F.expr(f"({p})"), F.lit(name)) for name, p in rules.items()]
    return F.array_compact(F.array(*broken))


def judge_staging(staged: DataFrame, rules: Mapping[str, str],
                  references: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Unprocessed rows with ``reject_reasons``: broken rules and unknown references.

    A missing reference key is allowed, as a nullable foreign key would allow it.
    """
    judged = staged.filter(~F.col("is_processed")).withColumn("reject_reasons", failed_rules(rules))
    for column, (dim, dim_key) in references.items():
        known = dim.select(F.col(dim_key).alias(column)).distinct().withColumn("__known", F.lit(True))
        judged = lookup_join(judged, known, [column], "left", unique=True)
        unknown = F.col(column).isNotNull() & F.col("__known").isNull()
        reasons = F.when(
            unknown, F.concat("reject_reasons", F.array(F.lit(f"unknown_{column}")))
        ).otherwise(F.col("reject_reasons"))
        judged = judged.withColumn("reject_reasons", reasons).drop("__known")
    return judged


def promote(judged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows for the fact table, and rejected rows with their reasons."""
    accepted = judged.filter(F.size("reject_reasons") == 0).drop("reject_reasons", "is_processed")
    return accepted, judged.filter(F.size("reject_reasons") > 0)


def write_promotion(judged: DataFrame, path: str, keys: Sequence[str], batch: str, pipeline: str, table: str,
                    execution_date: str) -> DataFrame:
    """Store one batch of judged rows and return its log row.

    Accepted rows are inserted unless another batch brought their key before, rejected
    rows are kept with their reasons. Batches are folders of their own: other batches stay, and the same
    batch again replaces itself. Of repeated keys within the batch one row is inserted.
    """
    spark = judged.sparkSession
    target = StoredTable(spark, path)
    good = F.size("reject_reasons") == 0
    accepted = first_per_key(judged.filter(good), keys, [])
    version = target.newest()
    if any(entry.part != batch for entry in version.entries):
        known = target.read(lambda entry: entry.part != batch, version).filter("outcome = 'accepted'").select(*keys)
        accepted = accepted.join(known, list(keys), "left_anti")
    outcome = accepted.withColumn("outcome", F.lit("accepted")).unionByName(
        judged.filter(~good).withColumn("outcome", F.lit("rejected")))
    is_good = F.col("outcome") == "accepted"
    counts = target.replace(outcome.withColumn("batch", F.lit(batch)), "batch", [batch], version, loaded=F.count_if(is_good),
                            rejected=F.count_if(~is_good))
    return log_row(spark, pipeline, table, execution_date, "incremental", counts["rows"], counts["loaded"], counts["rejected"])


def read_promoted(spark: SparkSession, path: str) -> DataFrame:
    """All batches' rows with ``outcome`` and ``batch``."""
    return StoredTable(spark, path).read()


def mark_processed(staged: DataFrame, judged: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The staging table after promotion: rows that were judged are marked, rows that came later are not."""
    done = judged.select(*keys).distinct().withColumn("__judged", F.lit(True))
    joined = staged.join(done, list(keys), "left")
    marked = F.col("is_processed") | F.coalesce("__judged", F.lit(False))
    return joined.withColumn("is_processed", marked).select(*staged.columns)


def category_totals(df: DataFrame, category: str, valid: Column, amount: str) -> DataFrame:
    """Extracted, transformed, rejected and loaded value per category, in one aggregation."""
    return df.groupBy(category).agg(
        F.count(F.lit(1)).alias("extracted"),
        F.count_if(valid).alias("transformed"),
        (F.count(F.lit(1)) - F.count_if(valid)).alias("rejected"),
        F.sum(F.when(valid, F.col(amount))).alias("loaded_amount"),
    )


def load_categories(df: DataFrame, category: str, valid: Column, path: str) -> None:
    """Write the valid rows into one folder per category; categories without rows stay as they are."""
    StoredTable(df.sparkSession, path).replace(df.filter(valid), category)


def category_fan_in(totals: DataFrame, category: str) -> DataFrame:
    """The category rows and an ``ALL`` row, each with its data quality rate."""
    everything = totals.agg(
        *[F.sum(c).alias(c) for c in totals.columns if c != category]
    ).select(F.lit("ALL").alias(category), "*")
    rate = percent(F.col("transformed"), F.col("extracted"))
    return reduce_union([totals, everything]).withColumn("data_quality_rate", rate)

