import cases
from pyspark.sql import functions as F

from tidemark.llm import line_dedup
from tidemark.llm.common import UPPER, LOWER
from tidemark.session import workspace


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans(UPPER, LOWER))


def brute(rows, min_docs, min_chars=1):
    held = {}
    for i, row in enumerate(rows):
        for key in {key_of(line) for line in (row.text or "").split("\n")}:
            held.setdefault(key, set()).add(i)
    common = {key for key, docs in held.items() if len(docs) >= min_docs and len(key) >= min_chars}
    out = []
    for row in rows:
        lines = (row.text or "").split("\n")
        kept = [line for line in lines if key_of(line) not in common]
        out.append((str(row.doc_id), "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out)


def test_against_brute_force(spark):
    docs = cases.documents(spark)
    for min_docs, min_chars in ((10, 1), (2, 5), (3, 0)):
        found = line_dedup.drop_common_lines(docs, min_docs, min_chars).select("row.doc_id", "kept", "n_lines", "n_dropped").collect()
        expected = brute(docs.collect(), min_docs, min_chars)
        assert sorted((str(a), b, c, d) for a, b, c, d in found) == expected
        assert any(row[3] for row in expected)


def test_runs_of_many_batches_are_levelled_and_exact(spark):
    runs = line_dedup.LineRuns(spark, workspace(spark, "runs"), common=6, fanout=3)
    total = {}
    for batch in range(10):
        counts = [(bytes([i]), 1 + (i + batch) % 3) for i in range(batch, batch + 20)]
        for key, n in counts:
            total[key] = total.get(key, 0) + n
        runs.add(spark.createDataFrame(counts, "h binary, n long"))
    levels = [level for level, _ in runs.runs]
    assert max(levels) == 2 and all(levels.count(level) < 3 for level in levels)
    common = {bytes(r.h) for r in runs.common_lines().collect()}
    assert common == {key for key, n in total.items() if n >= 6}
    again = line_dedup.LineRuns(spark, workspace(spark, "runs"), common=6, fanout=3, runs=runs.runs)
    assert {bytes(r.h) for r in again.common_lines().collect()} == common


def test_a_run_is_sorted(spark):
    runs = line_dedup.LineRuns(spark, workspace(spark, "runs"), common=2)
    runs.add(spark.range(1000).select(F.sha2(F.col("id").cast("string"), 256).cast("binary").alias("h"), F.lit(1).cast("long").alias("n")))
    parts = spark.read.parquet(runs.runs[0][1]).groupBy(F.input_file_name().alias("f")).agg(F.collect_list("h").alias("h")).collect()
    for part in parts:
        keys = [bytes(key) for key in part.h]
        assert keys == sorted(keys)


def test_empty_table(spark):
    assert line_dedup.drop_common_lines(cases.empty(spark)).collect() == []


def test_runs_go_on_after_compaction(spark, tmp_path):
    """A new object takes over the listed runs, also when merging has left fewer of them than were written."""
    def batch(n):
        return spark.createDataFrame([(bytes([line]), 1) for line in range(n)], "h binary, n long")

    runs = line_dedup.LineRuns(spark, str(tmp_path), common=3)
    for n in (5, 4, 3, 2):
        runs.add(batch(n))
    assert len(runs.runs) == 1
    later = line_dedup.LineRuns(spark, str(tmp_path), common=3, runs=runs.runs)
    for n in (5, 6, 1, 1, 1):
        later.add(batch(n))
    assert sorted(bytes(r.h)[0] for r in later.common_lines().collect()) == [0, 1, 2, 3, 4]
    counts = {bytes(r.h)[0]: r.n for r in later.counts().collect()}
    assert counts[5] == 1 and counts[4] == 3
