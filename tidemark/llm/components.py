"""Connected components of a link table, by alternating stars.

Each round relinks every node's neighbours to the smallest node it knows, first those above it, then those
below. Rounds are written to the shared folder, so a lost executor costs one round. A node with a very
large neighbourhood is never gathered: its minimum is a combined aggregate, and the join that hands the
minimum out has one row per node on one side, so its other side can be split.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import stored


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    if larger:
        near = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b"), F.col("a")))
    else:
        near = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    low = near.groupBy("u").agg(F.min("v").alias("m"))
    if larger:
        low = low.withColumn("m", F.least("m", "u"))
    out = near.join(low, "u")
    if larger:
        out = out.filter("v > u").select("v", "m")
    else:
        out = out.select("v", "m").union(low.select("u", "m"))
    return out.filter("v <> m").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the links (a, b): root is the smallest node reachable.

    Roots themselves are not listed. Links with a null end and self-links are ignored; repeated links are
    one link; no links give no rows.
    """
    edges = stored(edges.filter("a <> b").select("a", "b").distinct(), "links")
    state = _state(edges)
    while state[0]:
        edges = stored(reduce(_star, (True, False), edges), "stars")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
