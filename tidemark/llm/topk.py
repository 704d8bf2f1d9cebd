"""Exact top-k inner products by a dual-tree search over one cover tree.

Queries and candidates are indexed by the same tree. Its nested centres (``LEAVES`` at most) are chosen on a
bounded sample, level by level with radii that shrink by ``SHRINK``; every vector then goes to its nearest
leaf, and each node's covering radii, one for queries and one for candidates, are taken over all vectors below it.
For a query node (centre a, radius r) and a candidate node (centre b, radius s) no inner product exceeds
``a.b + r|b| + s|a| + rs``. First each query leaf meets the leaves with the best bounds, which gives every query a kth score;
then node pairs are descended from the root, dropping a pair whose bound is below the worst kth score of its query
group. Only the tree is handled by the driver. Vectors meet in blocks of bounded size, dealt out by leaf and hash, so a
leaf with a third of all vectors is many blocks.

Equal vectors are one vector with its k + 1 smallest ids, and equal queries are searched once, so copies cost nothing.

A component x becomes floor(scale * x). Vectors that are null or have a null or non-finite component, and rows
without an id, take no part. Shorter vectors count as filled up with zeros. A repeated row is one candidate, and an id is
never its own candidate. Ties go to the smaller id. Empty tables give no rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import per_batch, stored

SAMPLE = 2048  # vectors the centres are chosen from
LEAVES = 192  # at most; small tables have a leaf for PER_LEAF vectors
PER_LEAF = 2048
SHRINK = 1.3
BLOCK = 2048  # candidates of a block, about
GROUP = 256  # queries of a block, about
FIRST = 3  # leaves each query group meets before any pruning


class Tree(NamedTuple):
    """``levels[l]`` holds the centres of level l as rows of ``centres``; ``parents[l]`` their parents' places in level l - 1."""

    centres: np.ndarray
    levels: list[np.ndarray]
    parents: list[np.ndarray]

    def path(self) -> np.ndarray:
        """For each leaf its ancestors, from the root's level down, as rows of ``centres``."""
        at = np.arange(len(self.levels[-1]))
        steps = []
        for level in range(len(self.levels) - 1, -1, -1):
            steps.append(self.levels[level][at])
            if level:
                at = self.parents[level][at]
        return np.stack(steps[::-1], axis=1)


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    squares = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2.0 * (a @ b.T)
    return np.sqrt(np.maximum(squares, 0.0))


def grow(sample: np.ndarray, leaves: int = LEAVES) -> Tree:
    """A cover tree's upper levels: centres of a level are further apart than its radius, and stay centres below."""
    centres = [0]
    nearest = distances(sample, sample[:1])[:, 0]
    radius = float(nearest.max())
    levels, parents = [np.array([0])], [np.array([0])]
    while len(centres) < min(leaves, len(sample)) and nearest.max() > 0:
        radius /= SHRINK
        if nearest.max() <= radius:
            continue
        above = np.array(centres)
        while len(centres) < leaves and nearest.max() > radius:
            # The point farthest from all centres so far; it is farther than the radius.
            new = int(nearest.argmax())
            centres.append(new)
            nearest = np.minimum(nearest, distances(sample, sample[new:new + 1])[:, 0])
        own = distances(sample[centres], sample[above])
        parents.append(np.where(np.arange(len(centres)) < len(above), np.arange(len(centres)), own.argmin(axis=1)))
        levels.append(np.array(centres))
    kept = np.array(centres)
    place = {row: i for i, row in enumerate(kept.tolist())}
    return Tree(sample[kept], [np.array([place[row] for row in level.tolist()]) for level in levels], parents)


class Shape(NamedTuple):
    """Components of a vector and the smallest integer type that holds them all."""

    size: int
    kind: str

    @staticmethod
    def of(size: int, low: int, high: int) -> Shape:
        kind = next(kind for kind in ("i1", "i2", "i4", "i8") if np.iinfo(kind).min <= low and high <= np.iinfo(kind).max)
        return Shape(max(size, 1), f"<{kind}")

    def unpack(self, vectors: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(vectors), self.kind).reshape(-1, self.size)


def quantised(vectors: DataFrame, key: str, vector: str, scale: float) -> DataFrame:
    """(id, vec): usable rows once each, components as integers."""
    sound = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound)
    return rows.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double")).cast("long")).alias("vec")).distinct()


def _packed(items: DataFrame, shape: Shape) -> DataFrame:
    """The vectors as bytes, filled up with zeros."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            vecs = [np.pad(np.asarray(v.as_py(), shape.kind), (0, shape.size - len(v))).tobytes() for v in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(vecs, pa.binary())], ["id", "vec"])

        return each

    return per_batch(items, "id long, vec binary", make)


def _placed(distinct: DataFrame, tree: Tree, shape: Shape) -> DataFrame:
    """The rows with their leaf and their distance to each centre on the way to it."""
    shared = distinct.sparkSession.sparkContext.broadcast((tree.centres, tree.levels[-1], tree.path()))

    def make():
        centres, leaves, path = shared.value

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            far = distances(shape.unpack(batch.column(0).to_pylist()).astype(np.float64), centres)
            leaf = far[:, leaves].argmin(axis=1)
            steps = np.take_along_axis(far, path[leaf], axis=1)
            return pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(leaf, pa.int32()), pa.array(steps.tolist(), pa.list_(pa.float64()))], [*batch.schema.names, "leaf", "steps"],
            )

        return each

    return per_batch(distinct, "vec binary, ids array<long>, asked boolean, leaf int, steps array<double>", make)


class Bounds:
    """Upper bounds of inner products between query nodes and candidate nodes, and the descent over pairs."""

    def __init__(self, tree: Tree, asked: dict[int, list[float]], held: dict[int, list[float]]):
        self.tree, self.asked, self.held = tree, asked, held
        depth, path = len(tree.levels), tree.path()
        self.norms = np.sqrt((tree.centres * tree.centres).sum(axis=1))
        self.products = tree.centres @ tree.centres.T
        self.radii: list[list[dict[int, float]]] = []
        self.children: list[dict[int, list[int]]] = [{} for _ in range(depth)]
        for radii in (asked, held):
            nodes: list[dict[int, float]] = [{} for _ in range(depth)]
            for leaf, far in radii.items():
                for level in range(depth):
                    centre = int(path[leaf, level])
                    nodes[level][centre] = max(nodes[level].get(centre, 0.0), far[level])
            self.radii.append(nodes)
        self.below = [{} for _ in range(depth)]
        for level in range(depth):
            for leaf in range(len(path)):
                self.below[level].setdefault(int(path[leaf, level]), []).append(leaf)
                if level + 1 < depth:
                    under = self.children[level].setdefault(int(path[leaf, level]), [])
                    if int(path[leaf, level + 1]) not in under:
                        under.append(int(path[leaf, level + 1]))
        self.leaf_of = {int(path[leaf, -1]): leaf for leaf in range(len(path))}
        self.path = path

    def bound(self, level: int, query: int, other: int, candidate: int) -> float:
        r, s = self.radii[0][level][query], self.radii[1][other][candidate]
        value = self.products[query, candidate] + r * self.norms[candidate] + s * self.norms[query] + r * s
        return value + 1e-6 * (1.0 + abs(value))

    def first(self, sizes: dict[int, int], need: int) -> set[tuple[int, int]]:
        """For each query leaf the candidate leaves of best bound, at least FIRST and enough for ``need`` vectors."""
        last, pairs = len(self.tree.levels) - 1, set()
        for leaf in self.asked:
            centre = int(self.path[leaf, last])
            ranked = sorted(self.held, key=lambda other: (-self.products[centre, int(self.path[other, last])], other))
            taken = 0
            for n, other in enumerate(ranked):
                if n >= FIRST and taken >= need:
                    break
                pairs.add((leaf, other))
                taken += sizes[other]
        return pairs

    def open_pairs(self, worst: dict[int, float]) -> set[tuple[int, int]]:
        """Leaf pairs left when node pairs are descended from the root and pruned by the worst kth score."""
        last = len(self.tree.levels) - 1
        group = [{node: min(worst.get(leaf, np.inf) for leaf in leaves) for node, leaves in level.items()} for level in self.below]
        root = int(self.path[0, 0])
        found, stack = set(), [(0, root, 0, root)] if self.asked and self.held else []
        while stack:
            level, query, other, candidate = stack.pop()
            if query not in self.radii[0][level] or candidate not in self.radii[1][other]:
                continue
            if self.bound(level, query, other, candidate) < group[level][query]:
                continue
            if level == last and other == last:
                found.add((self.leaf_of[query], self.leaf_of[candidate]))
            elif other == last or level < last and self.radii[0][level][query] >= self.radii[1][other][candidate]:
                stack += [(level + 1, child, other, candidate) for child in self.children[level][query]]
            else:
                stack += [(level, query, other + 1, child) for child in self.children[other][candidate]]
        return found


def _blocks(rows: DataFrame, sizes: dict[int, int], size: int, prefix: str, kept: list[str]) -> DataFrame:
    """Rows gathered by leaf and part; a leaf has as many parts as keep a block near ``size`` rows."""
    parts = F.from_json(F.lit("{" + ",".join(f'"{leaf}":{max(1, -(-n // size))}' for leaf, n in sorted(sizes.items())) + "}"), "map<string,int>")
    part = F.pmod(F.xxhash64("vec"), F.element_at(parts, F.col("leaf").cast("string")))
    return rows.groupBy(F.col("leaf").alias(f"{prefix}leaf"), part.alias(f"{prefix}part")).agg(F.collect_list(F.struct(*kept)).alias(f"{prefix}rows"))


def _meet(queries: DataFrame, candidates: DataFrame, pairs: set[tuple[int, int]], shape: Shape, k: int) -> DataFrame:
    """(vec, id, score): the k best candidates of each query in each pair of blocks, without those below the
    query's own ``kth`` score so far."""
    spark = queries.sparkSession
    listed = F.broadcast(spark.createDataFrame(pa.table({"qleaf": pa.array([a for a, _ in pairs], pa.int32()), "cleaf": pa.array([b for _, b in pairs], pa.int32())})))
    wanted = queries.select("qleaf", "qpart").join(listed, "qleaf").join(candidates.select("cleaf", "cpart"), "cleaf")
    rows = wanted.join(queries, ["qleaf", "qpart"]).join(candidates, ["cleaf", "cpart"]).select("cleaf", "cpart", "qrows", "crows")

    def make():
        last: dict = {}

        def candidates_of(key, members):
            if key not in last:
                last.clear()
                rows = sorted(members.as_py(), key=lambda row: row["ids"][0])
                vecs = shape.unpack([row["vec"] for row in rows])
                last[key] = vecs, [row["ids"] for row in rows], np.array([row["ids"][0] for row in rows])
            return last[key]

        def best(scores):
            """Places of the k best, ties by place."""
            n = scores.shape[1]
            if np.abs(scores).max(initial=0) * n < 2 ** 62:
                keyed = scores * n + (n - 1 - np.arange(n))
                if n > k:
                    return np.argpartition(-keyed, k - 1, axis=1)[:, :k]
            return np.argsort(-scores, axis=1, kind="stable")[:, :k]

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            vecs, ids, found = [], [], []
            for i in range(batch.num_rows):
                held, every, smallest = candidates_of((batch.column(0)[i].as_py(), batch.column(1)[i].as_py()), batch.column(3)[i])
                asked = batch.column(2)[i].as_py()
                query = shape.unpack([row["vec"] for row in asked])
                scores = products(query, held)
                places = best(scores)
                top = np.take_along_axis(scores, places, axis=1)
                enough = top >= np.array([row["kth"] for row in asked])[:, None]
                if len(every) == sum(map(len, every)):
                    vecs += [asked[row]["vec"] for row in np.nonzero(enough)[0].tolist()]
                    ids.append(smallest[places[enough]])
                    found.append(top[enough])
                    continue
                for row, at, values in zip(asked, places.tolist(), top.tolist(), strict=True):
                    ranked = sorted((-value, one) for place, value in zip(at, values, strict=True) if value >= row["kth"] for one in every[place])[:k]
                    vecs += [row["vec"]] * len(ranked)
                    ids.append(np.array([one for _, one in ranked], np.int64))
                    found.append(np.array([-value for value, _ in ranked], np.int64))
            return pa.RecordBatch.from_arrays(
                [pa.array(vecs, pa.binary()), *[pa.array(np.concatenate(part) if part else np.zeros(0, np.int64), pa.int64()) for part in (ids, found)]],
                ["vec", "id", "score"],
            )

        return each

    def products(a, b):
        """Exact integer products, in floating point where that is exact."""
        a, b = a.astype(np.int64), b.astype(np.int64)
        peak = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * shape.size
        if peak < 2 ** 53:
            kind = np.float32 if peak < 2 ** 24 else np.float64
            return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)
        return a @ b.T

    return per_batch(rows, "vec binary, id long, score long", make)


def _leading(rows: DataFrame, by: str, k: int, order: list[Column]) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("rank") <= k)


def top_k(vectors: DataFrame, k: int = 20, every: int = 20, scale: float = 64.0, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row whose id is divisible by ``every`` its k best other rows."""
    spark = vectors.sparkSession
    best_first = [F.desc("score"), F.asc("id")]
    items = stored(quantised(vectors, key, vector, scale), "vectors")
    found = items.agg(F.max(F.size("vec")).alias("size"), F.min(F.array_min("vec")).alias("low"), F.max(F.array_max("vec")).alias("high"), F.count("*").alias("n")).first()
    if not found.n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shape = Shape.of(found.size, found.low or 0, found.high or 0)
    items = stored(_packed(items, shape), "vectors-packed")
    asked = F.col("id") % every == 0
    # One more than k, since a query's own id is dropped only at the end.
    few = _leading(items, "vec", k + 1, [F.asc("id")]).groupBy("vec").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    queries = items.filter(asked)
    distinct = few.join(queries.select("vec").distinct().withColumn("asked", F.lit(True)), "vec", "left").select("vec", "ids", F.coalesce("asked", F.lit(False)).alias("asked"))
    distinct = stored(distinct, "vectors-distinct")

    sample = distinct.select("vec").orderBy(F.xxhash64("vec"), "vec").limit(SAMPLE).toArrow()
    tree = grow(shape.unpack(sample.column(0).to_pylist()).astype(np.float64), min(LEAVES, 8 + found.n // PER_LEAF))
    placed = stored(_placed(distinct, tree, shape), "vectors-placed")
    depth = len(tree.levels)
    radii = placed.groupBy("leaf").agg(
        F.count("*").alias("n"), F.count_if("asked").alias("n_asked"),
        F.array(*[F.max(F.get("steps", F.lit(i))) for i in range(depth)]).alias("held"),
        F.array(*[F.max(F.when(F.col("asked"), F.get("steps", F.lit(i)))) for i in range(depth)]).alias("far"),
    ).collect()
    sizes = {row.leaf: row.n for row in radii}
    bounds = Bounds(tree, {row.leaf: row.far for row in radii if row.n_asked}, {row.leaf: row.held for row in radii})

    held = stored(_blocks(placed, sizes, BLOCK, "c", ["vec", "ids"]), "blocks")
    asked_sizes = {row.leaf: row.n_asked for row in radii if row.n_asked}
    no_score = F.lit(-(2 ** 63)).cast("long")
    groups = stored(_blocks(placed.filter("asked").withColumn("kth", no_score), asked_sizes, GROUP, "q", ["vec", "kth"]), "query-blocks")
    first = bounds.first(sizes, k + 1)
    near = stored(_leading(_meet(groups, held, first, shape, k + 1), "vec", k + 1, best_first), "near")
    kth = near.groupBy("vec").agg(F.when(F.count("*") > k, F.min("score")).otherwise(no_score).alias("kth"))
    reached = stored(placed.filter("asked").select("vec", "leaf").join(kth, "vec"), "kth-scores")
    worst = reached.groupBy("leaf").agg(F.min(F.col("kth").cast("double")).alias("kth"))
    rest = bounds.open_pairs({row.leaf: row.kth for row in worst.collect()}) - first
    best = near.drop("rank")
    if rest:
        again = stored(_blocks(reached, asked_sizes, GROUP, "q", ["vec", "kth"]), "query-blocks-again")
        best = best.union(_meet(again, held, rest, shape, k + 1))
    top = stored(_leading(best, "vec", k + 1, best_first).drop("rank"), "top")
    own = queries.select(F.col("id").alias("query_id"), "vec").join(top, "vec").filter("id <> query_id")
    return _leading(own, "query_id", k, best_first).select("query_id", "rank", F.col("id").alias("vec_id"), "score")
