"""Per-key reductions and key joins that stay balanced when one key is very frequent."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T


def _pick(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], largest: bool) -> DataFrame:
    # A struct's min or max is combined on the map side, so unlike row_number() over a window no task ever
    # holds all rows of one key. The remaining columns take part in the comparison, which makes the choice total.
    order = [c for c in order_by if c not in keys]
    fields = order + [c for c in df.columns if c not in keys and c not in order]
    maps = {f.name for f in df.schema.fields if f.name in fields and _holds_map(f.dataType)}
    if not fields:
        return df.select(*keys).distinct().select(*df.columns)
    if maps:
        # Maps cannot be compared; they are carried beside a ranking that has their text instead.
        ranking = F.struct(*[F.to_json(c) if c in maps else F.col(c) for c in fields])
        row = (F.max_by if largest else F.min_by)(F.struct(*fields), ranking)
    else:
        row = (F.max if largest else F.min)(F.struct(*fields))
    picked = df.groupBy(*keys).agg(row.alias("__row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"__row.{c}").alias(c) for c in df.columns])


def _holds_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_holds_map(field.dataType) for field in kind.fields)
    return isinstance(kind, T.MapType | T.VariantType) or isinstance(kind, T.ArrayType) and _holds_map(kind.elementType)


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order_by``, then by the other columns."""
    return _pick(df, keys, order_by, largest=True)


def first_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key: the smallest by ``order_by`` (NULLs first), then by the other columns."""
    return _pick(df, keys, order_by, largest=False)


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate, the one its own broadcast decision uses."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def input_bytes(df: DataFrame) -> int:
    """The size of the tables ``df`` is read from, each in the columns it needs."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(n).stats().sizeInBytes()) for n in range(leaves.size()))


def broadcast_limit(df: DataFrame) -> int:
    conf = df.sparkSession._jsparkSession.sessionState().conf()
    return int(conf.autoBroadcastJoinThreshold())


def _key_hash(on: Sequence[str]) -> Column:
    return F.xxhash64(*on)


def hot_keys(df: DataFrame, on: Sequence[str], count: int = 100, share: float = 1e-3) -> list[int]:
    """Hashes of the keys that hold about ``share`` of the rows or more, ``count`` at most.

    One pass with a mergeable sketch. A wrong guess changes how rows are spread, never which rows there are.
    """
    keyed = df.select(*on).dropna(subset=list(on)).select(_key_hash(on).alias("h"))
    found = keyed.agg(F.expr(f"approx_top_k(h, {count}, {100 * count})").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [row["item"] for row in found.top or [] if row["count"] >= max(2, share * found.n)]


def _equi(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str, residual: Column | None):
    renamed = dim.withColumnsRenamed({k: f"__{k}" for k in on})
    conditions = [F.col(k) == F.col(f"__{k}") for k in on]
    if residual is not None:
        conditions.append(residual)
    joined = facts.join(renamed, reduce(lambda a, b: a & b, conditions), how)
    return joined.drop(*[f"__{k}" for k in on])


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    residual: Column | None = None,
    unique: bool = False,
    skewed: bool = False,
    salts: int = 256,
    limit: int | None = None,
) -> DataFrame:
    """Join a fact side to a keyed side; ``how``: inner, left, left_semi or left_anti.

    A keyed side under the broadcast threshold is broadcast by Spark. Inside a ``unique`` side,
    with one row per key, joins add columns but no rows; the optimizer multiplies their sizes, so there the
    inputs are measured instead, with room for computed columns. Beyond the threshold the
    join shuffles both sides once and the adaptive planner splits large partitions. A caller who knows that
    ``on`` is skewed may say so: then the frequent keys are looked up first, their fact rows spread over ``salts``
    partitions and their keyed rows repeated. ``residual`` sees both sides by column name, so apart from the keys
    the names must differ.
    """
    on = list(on)
    limit = broadcast_limit(dim) if limit is None else limit
    if estimated_bytes(dim) <= limit:
        return _equi(facts, dim, on, how, residual)
    if unique and 4 * input_bytes(dim) <= limit:
        return _equi(facts, F.broadcast(dim), on, how, residual)
    hot = hot_keys(facts, on) if skewed else []
    if not hot:
        return _equi(facts, dim, on, how, residual)
    is_hot = F.coalesce(_key_hash(on).isin(hot), F.lit(False))
    # The row's own content and its partition: the same again when a task is retried.
    spread = F.pmod(F.xxhash64(F.spark_partition_id(), *[F.col(c) for c in facts.columns]), F.lit(salts))
    flagged = facts.withColumn("__salt", F.when(is_hot, spread).otherwise(F.lit(0).cast("bigint")))
    every = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
    none = F.array(F.lit(0).cast("bigint"))
    repeated = dim.withColumn("__salt", F.explode(F.when(is_hot, every).otherwise(none)))
    return _equi(flagged, repeated, [*on, "__salt"], how, residual).drop("__salt")
