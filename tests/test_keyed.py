"""Per-key reductions and salted joins against plain formulations."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.functions import keyed


@pytest.fixture(scope="module")
def sides(spark):
    """900 facts, a third on key 7, some without a key, some unknown to the keyed side."""
    draw = random.Random(1)
    facts = [(n, 7 if n % 3 == 0 else (None if n % 29 == 0 else draw.randint(0, 60)), n % 11) for n in range(900)]
    # Exact copies of one fact as well.
    facts += [(5000, 7, 1)] * 200
    dim = [(k, f"name {k}") for k in range(50)]
    return (
        spark.createDataFrame(facts, "id bigint, k bigint, day int").repartition(5),
        spark.createDataFrame(dim, "k bigint, name string"),
    )


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(sides, how):
    facts, dim = sides
    plain = facts.join(dim, "k", how).select("id", "k", "day", *(["name"] if how in ("inner", "left") else []))
    salted = keyed.lookup_join(facts, dim, ["k"], how, skewed=True, salts=8, limit=0)
    assert "__salt" not in salted.columns
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_with_residual(spark, sides, how):
    facts, _ = sides
    spans = spark.createDataFrame(
        [(k, start, start + 4) for k in range(50) for start in (0, 5)], "k bigint, first int, last int"
    )
    within = F.col("day").between(F.col("first"), F.col("last"))
    salted = keyed.lookup_join(facts, spans, ["k"], how, residual=within, skewed=True, salts=8, limit=0)
    plain = keyed.lookup_join(facts, spans, ["k"], how, residual=within, limit=2**63)
    assert rows(salted.select("id", "k", "first")) == rows(plain.select("id", "k", "first"))


def test_hot_keys_are_few_and_complete(sides):
    facts, _ = sides
    seven = facts.filter("k = 7").select(F.xxhash64("k")).first()[0]
    assert keyed.hot_keys(facts, ["k"], share=0.05) == [seven]
    assert keyed.hot_keys(facts.limit(0), ["k"]) == []


def test_salted_join_spreads_the_hot_key(spark, sides):
    facts, dim = sides
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = keyed.lookup_join(facts, dim, ["k"], "inner", skewed=True, salts=64, limit=0)
        tasks = joined.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(tasks) == 4  # every shuffle partition holds some of it


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_small_side_is_broadcast(spark, sides, tmp_path):
    facts, dim = sides
    dim.write.parquet(str(tmp_path / "dim"))
    small = spark.read.parquet(str(tmp_path / "dim"))
    assert "BroadcastHashJoin" in plan_of(keyed.lookup_join(facts, small, ["k"]))
    # A join inside the side inflates the estimate; the inputs are still small.
    wide = small.join(small.withColumnRenamed("name", "again"), "k")
    size = keyed.estimated_bytes(wide)
    assert keyed.input_bytes(wide) < size
    plan = plan_of(keyed.lookup_join(facts, wide, ["k"], unique=True, limit=size - 1))
    assert "__salt" not in plan
    # Nothing is counted or salted unless the caller says that the key is skewed.
    assert "__salt" not in plan_of(keyed.lookup_join(facts, wide, ["k"], limit=size - 1))
    assert "__salt" in plan_of(keyed.lookup_join(facts, wide, ["k"], limit=size - 1, skewed=True))


def test_latest_and_first_per_key(spark):
    draw = random.Random(3)
    data = [(draw.randint(0, 9), draw.randint(0, 5), draw.randint(0, 3), str(n)) for n in range(300)]
    df = spark.createDataFrame(data, "k int, t int, u int, v string")
    best, least = {}, {}
    for k, t, u, v in data:
        best[k] = max(best.get(k, (t, u, v)), (t, u, v))
        least[k] = min(least.get(k, (t, u, v)), (t, u, v))
    latest = {r.k: (r.t, r.u, r.v) for r in keyed.latest_per_key(df, ["k"], ["t"]).collect()}
    first = {r.k: (r.t, r.u, r.v) for r in keyed.first_per_key(df, ["k"], ["t"]).collect()}
    assert latest == best
    assert first == least


def test_latest_per_key_combines_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("t"))
    plan = plan_of(keyed.latest_per_key(df, ["k"], ["t"]))
    assert "partial_max" in plan
    assert "Window" not in plan


def test_latest_per_key_with_columns_that_cannot_be_compared(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 2, map('a', 1)), (1, 3, map('b', 2)), (2, 1, null) AS t(k, t, m)")
    assert rows(keyed.latest_per_key(df, ["k"], ["t"]), "k", "t") == [(1, 3), (2, 1)]
    assert keyed.latest_per_key(df, ["k"], ["t"]).filter("k = 1").first().m == {"b": 2}
