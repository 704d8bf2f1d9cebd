"""Files that arrive in a landing folder: metadata, routing, reading, reprocessing guard."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.keyed import first_per_key

# Accepted suffixes, and the size in MB from which a file counts as large.
SUPPORTED_FORMATS = (".csv", ".json", ".parquet")
LARGE_FILE_MB = 10.0
CHUNK_ROWS = 1000
# Files up to this size are hashed as one value; larger ones are read piece by piece. The hash is the same.
WHOLE_FILE_BYTES = 256 * 1024 * 1024
PIECE_BYTES = 8 * 1024 * 1024

LANDING_PATTERN = "sales_data_*.csv"


def landing_schema() -> T.StructType:
    return T.StructType.fromDDL(
        "transaction_id STRING, customer_id STRING, product_id STRING, quantity INT, amount DECIMAL(12,2)"
    )


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def file_suffix(path: Column) -> Column:
    """The last suffix of the file name in lower case, empty without one."""
    return F.lower(F.regexp_extract(file_name(path), r"(\.[^.]+)$", 1))


def plain_path(path: Column) -> Column:
    """One spelling of a file's path, whichever reader names it: not URI-encoded, one slash after a local scheme."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, "^file:/+", "file:/")


def _source_file() -> Column:
    return plain_path(F.col("_metadata.file_path"))


def _hashed_in_pieces(files: DataFrame) -> DataFrame:
    """``files`` with the SHA-256 of content too large for one value; a task holds one piece at a time."""
    schema = T.StructType([*files.schema.fields, T.StructField("file_hash", T.StringType())])

    def run(batches):
        for batch in batches:
            hashes = []
            for uri in batch.column(0).to_pylist():
                # Local names may hold blanks, which a URI may not.
                local = uri.startswith("file:")
                system, name = (pyarrow.fs.LocalFileSystem(), uri.removeprefix("file:")) if local else pyarrow.fs.FileSystem.from_uri(uri)
                digest = hashlib.sha256()
                with system.open_input_stream(name) as stream:
                    while piece := stream.read(PIECE_BYTES):
                        digest.update(piece)
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(hashes, pa.string())], schema.names)

    return files.repartition(F.col("path")).mapInArrow(run, schema)


def file_metadata(spark: SparkSession, path: str, whole: int = WHOLE_FILE_BYTES) -> DataFrame:
    """Name, path, size, SHA-256, format and support flag of every file below ``path``.

    The content is read and hashed on the executors, one task per group of files, and
    dropped at once; files above ``whole`` bytes are read in pieces.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    kept = ["path", "length", "modificationTime"]
    small = files.filter(F.col("length") <= whole).select(*kept, F.sha2("content", 256).alias("file_hash"))
    large = _hashed_in_pieces(files.filter(F.col("length") > whole).select(*kept))
    # The binary reader names files without encoding.
    found = small.unionByName(large).withColumn("path", F.regexp_replace("path", "^file:/+", "file:/"))
    suffix = file_suffix(F.col("path"))
    return found.select(
        file_name(F.col("path")).alias("filename"),
        F.col("path").alias("filepath"),
        F.col("length").alias("file_size_bytes"),
        F.round(F.col("length") / F.lit(1024.0 * 1024.0), 2).alias("file_size_mb"),
        "file_hash",
        suffix.alias("file_format"),
        suffix.isin(*SUPPORTED_FORMATS).alias("is_supported_format"),
        F.col("modificationTime").alias("modified_at"),
    )


def _suffix_glob(file_format: str) -> str:
    """Names with this suffix in either case, as ``file_suffix`` judges them."""
    return "*." + "".join(f"[{c.lower()}{c.upper()}]" for c in file_format)


def line_estimates(spark: SparkSession, path: str, header: bool = True, names: str = "*") -> DataFrame:
    """Records per text file: its lines less the header. Large files are read in splits."""
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", names).text(path)
    counted = lines.groupBy(_source_file().alias("filepath")).agg(F.count(F.lit(1)).alias("lines"))
    return counted.select("filepath", (F.col("lines") - F.lit(1 if header else 0)).alias("estimated_records"))


def with_route(files: DataFrame) -> DataFrame:
    """The processing path per file: error, unsupported, small or large."""
    size = F.col("file_size_mb")
    return files.withColumn(
        "route",
        F.when(F.col("filepath").isNull() | size.isNull(), "handle_error")
        .when(~F.col("is_supported_format"), "handle_unsupported_format")
        .when(size < LARGE_FILE_MB, "process_small_file")
        .otherwise("process_large_file"),
    )


def with_chunks(files: DataFrame) -> DataFrame:
    """Chunks of 1,000 records per file, at least one."""
    return files.withColumn("chunks", F.greatest(F.lit(1), F.expr(f"estimated_records div {CHUNK_ROWS}")))


def read_landing(spark: SparkSession, path: str, schema: T.StructType, file_format: str) -> DataFrame:
    """Rows of one accepted format with the file they came from."""
    if f".{file_format}" not in SUPPORTED_FORMATS:
        raise ValueError(f"unsupported file format: {file_format!r}")
    reader = spark.read.schema(schema).option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", _suffix_glob(file_format))
    if file_format == "csv":
        reader = reader.option("header", "true")
    return reader.format(file_format).load(path).select("*", _source_file().alias("filepath"))


def read_all_formats(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of every accepted file below ``path``; other files are passed over."""
    frames = [read_landing(spark, path, schema, suffix[1:]) for suffix in SUPPORTED_FORMATS]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


def processed_records(rows: DataFrame) -> DataFrame:
    return rows.groupBy("filepath").agg(F.count(F.lit(1)).alias("records_processed"))


def content_id(files: DataFrame) -> Column:
    """Identity of a file's content, whatever its size, name and time."""
    return files["file_hash"]


def record_estimates(spark: SparkSession, path: str) -> DataFrame:
    """Records per accepted file without parsing it: lines of text, less the header of CSV; row counts of Parquet footers."""
    lines = line_estimates(spark, path, True, _suffix_glob("csv")).unionByName(
        line_estimates(spark, path, False, _suffix_glob("json")))
    footers = processed_records(read_landing(spark, path, T.StructType([]), "parquet"))
    return lines.unionByName(footers.withColumnRenamed("records_processed", "estimated_records"))


def processing_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per supported file: how it is routed, its records as estimated and as read, its chunks and its hash.

    The status is ``success`` where both counts agree, else ``mismatch`` (a blank line, for one, is counted but not read).
    """
    files = with_route(file_metadata(spark, path)).filter("is_supported_format")
    counts = {"estimated_records": record_estimates(spark, path), "records_processed": processed_records(read_all_formats(spark, path, schema))}
    for name, found in counts.items():
        files = files.join(found, "filepath", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    status = F.when(F.col("estimated_records") == F.col("records_processed"), "success").otherwise("mismatch")
    return with_chunks(files).select(
        "filepath", "route", "estimated_records", "records_processed", "chunks", "file_hash", status.alias("status"))


def unseen_files(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """One file per content that the ledger of processed contents does not hold yet."""
    single = first_per_key(files.withColumn("content_id", content_id(files)), ["content_id"], ["filepath"])
    return single.join(ledger.select("content_id"), "content_id", "left_anti")
