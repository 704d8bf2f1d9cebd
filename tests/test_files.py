"""Landing files, file streams and generators."""

import hashlib

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions.columns import sunday_week
from tidemark.operators import reports
from tidemark.operators.quality.checks import Completeness
from tidemark.session import workspace
from tidemark.sources import generate, landing, tables
from tidemark.sources.stored import StoredTable
from tidemark.streaming import loads as streams

HEADER = "transaction_id,customer_id,product_id,quantity,amount\n"


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "sales_data_1.csv").write_text(HEADER + "T1,C1,P1,2,10.50\nT2,C2,P2,1,3.00\nT3,C1,P3,1,7.25\n")
    (tmp_path / "sales_data_2.json").write_text('{"transaction_id": "T4", "quantity": 1}\n')
    (tmp_path / "README.TXT").write_text("one\ntwo\n")
    return tmp_path


def test_metadata(spark, folder):
    found = {r.filename: r for r in landing.with_route(landing.file_metadata(spark, str(folder))).collect()}
    csv = found["sales_data_1.csv"]
    content = (folder / "sales_data_1.csv").read_bytes()
    assert csv.file_hash == hashlib.sha256(content).hexdigest()
    assert csv.file_size_bytes == len(content)
    assert (csv.file_format, csv.route) == (".csv", "process_small_file")
    assert (found["README.TXT"].file_format, found["README.TXT"].route) == (".txt", "handle_unsupported_format")


def test_large_files_have_the_same_hash(spark, folder, monkeypatch):
    monkeypatch.setattr(landing, "PIECE_BYTES", 7)
    (folder / "a b+c").mkdir()
    (folder / "a b+c" / "again.csv").write_bytes((folder / "sales_data_1.csv").read_bytes())
    whole = landing.file_metadata(spark, str(folder))
    pieces = landing.file_metadata(spark, str(folder), whole=20)
    assert rows(whole, "filepath", "file_hash") == rows(pieces, "filepath", "file_hash")
    # The same content under another name is known, whatever its size.
    ledger = whole.filter("filename = 'sales_data_1.csv'").select(landing.content_id(whole).alias("content_id"))
    assert rows(landing.unseen_files(pieces, ledger), "filename") == [("README.TXT",), ("sales_data_2.json",)]


def test_paths_agree_between_readers(spark, folder):
    (folder / "a b+c%d").mkdir()
    (folder / "a b+c%d" / "x é.csv").write_bytes((folder / "sales_data_1.csv").read_bytes())
    found = {r.filepath for r in landing.file_metadata(spark, str(folder)).collect()}
    assert {r.filepath for r in landing.line_estimates(spark, str(folder)).collect()} == found
    read = landing.read_landing(spark, str(folder), landing.landing_schema(), "csv")
    assert {r.filepath for r in read.collect()} == {p for p in found if p.endswith(".csv")}
    results = {r.filepath: r for r in landing.processing_results(spark, str(folder), landing.landing_schema()).collect()}
    assert results.keys() == {p for p in found if not p.endswith(".TXT")}
    assert all(r.file_hash and r.chunks == 1 and r.records_processed in (1, 3) for r in results.values())


def test_results_of_all_files_whatever_the_case_of_their_suffix(spark, folder):
    line = '{"transaction_id": "T5", "quantity": 1}\n'
    (folder / "X.CSV").write_bytes((folder / "sales_data_1.csv").read_bytes())
    (folder / "Y.Json").write_text(line * 2)
    (folder / "blank.csv").write_text(HEADER + "T1,C1,P1,2,10.50\n\nT2,C2,P2,1,3.00\n")
    (folder / "long.json").write_text(line * 2500)
    (folder / "none.csv").write_text(HEADER)
    landed = landing.read_landing(spark, str(folder), landing.landing_schema(), "csv").drop("filepath")
    for name, part in (("Z.PARQUET", landed), ("z0.parquet", landed.limit(0))):
        part.coalesce(1).write.parquet(str(folder / "parts" / name))
        (folder / name).write_bytes(next((folder / "parts" / name).glob("part-*")).read_bytes())
    found = landing.processing_results(spark, str(folder), landing.landing_schema())
    results = {r.filepath.split("/")[-1]: r for r in found.filter("filepath NOT LIKE '%/parts/%'").collect()}
    assert {n: (r.estimated_records, r.records_processed, r.chunks, r.status) for n, r in results.items()} == {
        "sales_data_1.csv": (3, 3, 1, "success"), "sales_data_2.json": (1, 1, 1, "success"), "X.CSV": (3, 3, 1, "success"),
        "Y.Json": (2, 2, 1, "success"), "blank.csv": (3, 2, 1, "mismatch"), "long.json": (2500, 2500, 2, "success"),
        "none.csv": (0, 0, 1, "success"), "Z.PARQUET": (8, 8, 1, "success"), "z0.parquet": (0, 0, 1, "success"),
    }


def test_routes(spark):
    files = spark.createDataFrame(
        [("a.csv", 9.99, True), ("b.csv", 10.0, True), ("c.txt", 50.0, False), (None, None, None)],
        "filepath string, file_size_mb double, is_supported_format boolean")
    assert [r.route for r in landing.with_route(files).collect()] == [
        "process_small_file", "process_large_file", "handle_unsupported_format", "handle_error"]


def test_records_and_chunks(spark, folder):
    lines = landing.with_chunks(landing.line_estimates(spark, str(folder / "*.csv"))).first()
    assert (lines.estimated_records, lines.chunks) == (3, 1)
    many = spark.createDataFrame([(2500,)], "estimated_records bigint")
    assert landing.with_chunks(many).first().chunks == 2
    read = landing.read_landing(spark, str(folder), landing.landing_schema(), "csv")
    assert landing.processed_records(read).first().records_processed == 3
    assert landing.read_all_formats(spark, str(folder), landing.landing_schema()).count() == 4
    with pytest.raises(ValueError):
        landing.read_landing(spark, str(folder), landing.landing_schema(), "xml")


def test_reprocessing_guard(spark, folder):
    (folder / "sales_data_copy.csv").write_bytes((folder / "sales_data_1.csv").read_bytes())
    files = landing.file_metadata(spark, str(folder)).filter("is_supported_format")
    empty = spark.createDataFrame([], "content_id string")
    assert landing.unseen_files(files, empty).count() == 2
    ledger = files.filter("filename = 'sales_data_1.csv'").select(landing.content_id(files).alias("content_id"))
    assert rows(landing.unseen_files(files, ledger), "filename") == [("sales_data_2.json",)]


def test_arrival_stream_reads_each_file_once(spark, tmp_path):
    arriving, out = tmp_path / "in", str(tmp_path / "out")
    arriving.mkdir()
    stream = streams.file_stream(spark, f"{arriving}/sales_data_*.csv", landing.landing_schema(), "csv")
    (arriving / "sales_data_1.csv").write_text(HEADER + "T1,C1,P1,2,10.50\n")
    (arriving / "other.csv").write_text(HEADER + "T9,C1,P1,2,10.50\n")
    for _ in range(2):
        streams.run_available(stream, f"{out}/checkpoint", streams.append_arrivals(f"{out}/rows"))
    assert rows(spark.read.parquet(f"{out}/rows"), "transaction_id") == [("T1",)]
    (arriving / "sales_data_2.csv").write_text(HEADER + "T2,C1,P1,2,10.50\n")
    streams.run_available(stream, f"{out}/checkpoint", streams.append_arrivals(f"{out}/rows"))
    assert rows(spark.read.parquet(f"{out}/rows"), "transaction_id") == [("T1",), ("T2",)]


def test_archived_files_leave_the_landing_folder(spark, tmp_path):
    arriving, archive, out = tmp_path / "in", tmp_path / "archive", str(tmp_path / "out")
    arriving.mkdir()
    stream = streams.file_stream(
        spark, f"{arriving}/sales_data_*.csv", landing.landing_schema(), "csv", 1, str(archive))
    for n in range(4):
        (arriving / f"sales_data_{n}.csv").write_text(HEADER + f"T{n},C1,P1,2,10.50\n")
    streams.run_available(stream, f"{out}/checkpoint", streams.append_arrivals(f"{out}/rows"))
    assert spark.read.parquet(f"{out}/rows").count() == 4
    assert len(list(archive.rglob("*.csv"))) >= 2
    assert len(list(archive.rglob("*.csv"))) + len(list(arriving.glob("*.csv"))) == 4


def test_repeated_batch_replaces_itself(spark, tmp_path):
    write = streams.append_arrivals(str(tmp_path))
    for _ in range(2):
        write(spark.range(5), 0)
    write(spark.range(2), 1)
    assert spark.read.parquet(str(tmp_path)).count() == 7


def change_files(spark, path, parts=4):
    df = spark.range(400).select(
        (F.col("id") % 37).alias("k"), F.col("id").alias("t"), F.concat(F.lit("v"), F.col("id").cast("string")).alias("v"))
    df.repartitionByRange(parts, "t").write.parquet(path)
    return df


def test_upsert_stream_equals_batch(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = change_files(spark, path)
    stream = streams.file_stream(spark, path, df.schema, files_per_batch=1)
    streams.run_available(stream, f"{out}/checkpoint", streams.append_newest(f"{out}/state", ["k"], ["t"]))
    state = streams.current_state(spark, f"{out}/state", ["k"], ["t"])
    table = StoredTable(spark, f"{out}/state")
    assert len(table.entries()) == 4
    expected = rows(streams.latest_per_key(df, ["k"], ["t"]))
    assert rows(state) == expected
    streams.compact_state(spark, f"{out}/state", ["k"], ["t"])
    assert len(table.entries()) == 1 and rows(streams.current_state(spark, f"{out}/state", ["k"], ["t"])) == expected
    # The stream goes on at the same path, and a repeated batch changes nothing.
    again = df.limit(50)
    newer = df.withColumn("t", F.col("t") + 1000)
    for _ in range(2):
        streams.append_newest(f"{out}/state", ["k"], ["t"])(again, 2)
    streams.append_newest(f"{out}/state", ["k"], ["t"])(newer, 9)
    assert rows(streams.current_state(spark, f"{out}/state", ["k"], ["t"])) == rows(streams.latest_per_key(newer, ["k"], ["t"]))


def test_quality_stream_splits_rows(spark, tmp_path):
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = change_files(spark, path)
    stream = streams.file_stream(spark, path, df.schema, files_per_batch=2)
    writer = streams.check_batches(out, [Completeness(table="t", min_count=1)], {"low": "t < 300"}, "2024-01-01 00:00:00")
    streams.run_available(stream, f"{out}/checkpoint", writer)
    assert spark.read.parquet(f"{out}/results").groupBy().sum("rows_checked").first()[0] == 400
    assert spark.read.parquet(f"{out}/accepted").count() == 300
    assert spark.read.parquet(f"{out}/quarantine").count() == 100


def test_word_count_of_text_files(spark, tmp_path):
    (tmp_path / "lines.txt").write_text("Spark is fast\n  spark  IS general \n\n")
    counts = reports.word_count(tables.read_lines(spark, str(tmp_path)))
    assert [(r.word, r["count"]) for r in counts.collect()] == [("is", 2), ("spark", 2), ("fast", 1), ("general", 1)]
    totals = reports.word_totals(counts).first()
    assert (totals.total_words, totals.unique_words) == (6, 4)


def test_enriched_sales_drop_orphans(spark, tmp_path):
    def stored(name, df):
        df.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    fact = spark.createDataFrame(
        [(1, 1, 20240101, 1), (None, 1, 20240101, 1), (1, 9, 20240101, 1), (1, 1, 19990101, 1)],
        "customer_id int, product_id int, sale_date_id int, quantity int").withColumn("total_amount", F.lit(5))
    customers = spark.createDataFrame([(1, "SMB", "UK")], "customer_id int, segment string, country string")
    products = spark.createDataFrame([(1, "Widget", "Home")], "product_id int, product_name string, category string")
    dates = generate.date_dimension(tables.day_series(spark, "2024-01-01", "2024-01-31"))
    enriched = reports.enrich_sales(fact, stored("customers", customers), stored("products", products), dates)
    assert enriched.count() == 1
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan


def test_calendar(spark):
    days = {str(r.date): r for r in generate.date_dimension(tables.day_series(spark, "2020-01-01", "2026-12-31")).collect()}
    assert len(days) == 2557
    newyear = days["2021-01-01"]
    assert (newyear.date_id, newyear.week, newyear.day_of_week, newyear.month_name, newyear.is_holiday) == (
        20210101, 53, 5, "January", True)
    assert days["2024-06-01"].is_weekend
    assert sum(d.is_holiday for d in days.values()) == 21
    import datetime
    weeks = tables.day_series(spark, "2020-01-01", "2026-12-31").select("date", sunday_week(F.col("date")).alias("w"))
    assert all(r.w == int(datetime.date.strftime(r.date, "%U")) for r in weeks.collect())


def test_defect_rates(spark):
    facts = generate.sales(tables.number_series(spark, 1, 100_000))
    found = facts.agg(
        F.count_if(F.col("customer_id").isNull()).alias("orphans"), F.count_if(F.col("quantity") < 0).alias("negative"),
        F.count_if(F.expr("total_amount <> quantity * unit_price - discount")).alias("wrong")).first()
    assert (found.orphans, found.negative, found.wrong) == (2000, 1000, 0)
    wrong = generate.sales(tables.number_series(spark, 1, 100_000), wrong_total_every=201)
    assert wrong.filter("total_amount <> quantity * unit_price - discount").count() > 400
    people = generate.customers(tables.number_series(spark, 1, 1000))
    assert people.filter("email IS NULL").count() == 20
    assert rows(people.groupBy("segment").count()) == [("Consumer", 400), ("Enterprise", 200), ("SMB", 400)]


def test_drawn_rates_do_not_depend_on_partitioning(spark):
    ids = tables.number_series(spark, 1, 20_000)
    once = generate.sales_at_rates(ids)
    again = generate.sales_at_rates(ids.repartition(7))
    assert once.exceptAll(again).count() == 0
    found = once.agg(
        F.avg(F.col("customer_id").isNull().cast("int")).alias("orphans"),
        F.avg((F.col("quantity") < 0).cast("int")).alias("negative"),
        (1 - F.count_distinct("transaction_id") / F.count(F.lit(1))).alias("duplicates")).first()
    assert abs(found.orphans - 0.02) < 0.005
    assert abs(found.negative - 0.01) < 0.004
    assert abs(float(found.duplicates) - 0.03) < 0.006
    clean = generate.sales_at_rates(ids, null_customer_rate=0, negative_quantity_rate=0, duplicate_rate=0)
    assert clean.filter("customer_id IS NULL OR quantity < 0").count() == 0
    assert clean.select("transaction_id").distinct().count() == 20_000


def test_drawn_customers_and_staging(spark):
    ids = tables.number_series(spark, 1, 20_000)
    people = generate.customers_at_rate(ids, null_email_rate=0.1)
    shares = {r.segment: r["count"] / 20_000 for r in people.groupBy("segment").count().collect()}
    assert abs(shares["Enterprise"] - 0.2) < 0.02 and abs(shares["SMB"] - 0.4) < 0.02
    assert abs(people.filter("email IS NULL").count() / 20_000 - 0.1) < 0.01
    staged = generate.staging_at_rates(ids)
    assert staged.filter("customer_id IS NULL OR quantity < 1 OR is_processed").count() == 0
    assert staged.filter("total_amount <> quantity * unit_price - discount").count() == 0
    assert staged.first().transaction_id.startswith("TXN-STAGE-")


def test_workspace_uses_the_shared_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert workspace(spark, "x").startswith(folder)
    assert workspace(spark, "x") != workspace(spark, "x")
