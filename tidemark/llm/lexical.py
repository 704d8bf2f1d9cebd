"""Ranked lexical search: the k best documents of every query item.

Documents are indexed in segments, pieces of a few MB of text, each an inverted list per term: the places of
the documents that hold it, ascending, with its occurrences. Only terms of the items are listed; numbers of documents and of
terms, and how many documents hold a term, are counted over all documents. Every segment is searched on its own, with
the scores reached so far in the task as a bar, and the tasks' best are merged.

A search is half term at a time, half document at a time. The short lists of an item are summed into accumulators, term
by term. The accumulators then are one more iterator, bounded by their highest sum, beside the long lists, each bounded
by its highest contribution. Windows of documents are walked in order: iterators whose bounds together cannot reach the
bar propose nothing; documents the others propose are looked up in them, highest bound first, and dropped as
soon as their sum and the bounds left cannot reach it. A bar is never raised beyond the kth score, and equal scores pass.

Items come in blocks of about ``block_bytes`` of text, each block searched against all documents, so that
a task holds one block's terms. Null text, and text without a term, belongs to no result and is not counted. Every row is a document
of its own, repeated rows and ids too; equal scores go by ascending key, null keys last. Repeated items are items
of their own; an item without terms, or an empty table, gives no rows. Only the named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import repeat
from typing import Any, NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import per_batch, stored, utf8

# A term is a run of ASCII letters and digits and anything beyond ASCII; other bytes become blanks, A-Z lower case.
FOLDED = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256)).lower()
WINDOW = 512  # documents walked with one bar
SHORT = 16  # a list is short if it holds at most one in so many of the segment's documents
SPREAD = 64  # first groups an item's candidates are merged in

TOTALS = ("n_docs", "n_terms")
LISTS = {"lengths": T.LongType(), "terms": T.IntegerType(), "ends": T.IntegerType(), "places": T.IntegerType(), "counts": T.IntegerType()}


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(FOLDED).split()


class Statistics(NamedTuple):
    n_docs: int
    n_terms: int
    weights: np.ndarray  # by term number


def weight(n_docs: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))


def build(docs: DataFrame, terms: list[bytes], key: str, text: str) -> DataFrame:
    """One row per segment: its keys, lengths and lists (``terms`` ascending, list i ends at ``ends[i]``)."""
    shared = docs.sparkSession.sparkContext.broadcast(terms)
    frame = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    listed = T.ArrayType(frame.schema["key"].dataType)
    schema = T.StructType([T.StructField("keys", listed), *[T.StructField(name, T.LongType()) for name in TOTALS],
                           *[T.StructField(name, T.ArrayType(kind)) for name, kind in LISTS.items()]])

    def make():
        number = {term: i for i, term in enumerate(shared.value)}.get

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            size, held = [], []
            for value in utf8(batch.column(1)):
                found = terms_of(value)
                size.append(len(found))
                held.append(np.fromiter(map(number, found, repeat(-1)), np.int64, len(found)))
            term, doc = np.concatenate(held), np.repeat(np.arange(len(size)), size)
            known = term >= 0
            pair, count = np.unique(term[known] * len(size) + doc[known], return_counts=True)
            term, doc = np.divmod(pair, len(size))
            holders, place = np.unique(doc, return_inverse=True)
            present, first = np.unique(term, return_index=True)
            lengths = np.array(size, np.int64)
            totals = [pa.array([int(n)], pa.int64()) for n in (np.count_nonzero(lengths), lengths.sum())]
            ends = np.append(first[1:], len(term)) if len(term) else first
            lists = {"lengths": lengths[holders], "terms": present, "ends": ends, "places": place, "counts": count}
            columns = [pa.array([lists[name].tolist()], pa.list_(pa.int64() if name == "lengths" else pa.int32())) for name in LISTS]
            taken = batch.column(0).take(pa.array(holders, pa.int64()))
            keys = pa.ListArray.from_arrays(pa.array([0, len(taken)], pa.int32()), taken)
            return pa.RecordBatch.from_arrays([keys, *totals, *columns], schema.names)

        return each

    return per_batch(frame, schema, make)


class Segment:
    """A segment with the contribution of every list entry."""

    def __init__(self, row: dict[str, pa.Array], stats: Statistics):
        self.keys = row["keys"]
        lengths, self.terms, ends, self.places, count = (row[name].to_numpy().astype(np.int64) for name in LISTS)
        sizes, which = np.unique(lengths, return_inverse=True)
        # By Python's integers: the product may leave 64 bits.
        norm = np.array([10 + 90 * int(n) * stats.n_docs // stats.n_terms for n in sizes], np.int64)[which]
        of = np.repeat(stats.weights[self.terms], np.diff(ends, prepend=0)) if len(ends) else count
        self.gains = of * (1_000_000_000 * count // (1000 * count + 8 * norm[self.places])) if len(count) else count
        starts = np.append(0, ends[:-1]) if len(ends) else ends
        self.spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        self.bounds = np.maximum.reduceat(self.gains, starts) if len(starts) else self.gains
        self.position = {term: i for i, term in enumerate(self.terms.tolist())}

    def accumulated(self, lists: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Places and sums of the documents in ``lists``, term by term."""
        sums = np.zeros(len(self.keys), np.int64)
        for i in lists:
            a, b = self.spans[i]
            sums[self.places[a:b]] += self.gains[a:b]
        places = np.flatnonzero(sums)
        return places, sums[places]

    def search(self, terms: list[int], k: int, bar: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(bar, places, scores) by window: every document with a score of at least ``bar``, which rises with the
        kth best seen here, never beyond it."""
        present = [self.position[t] for t in terms if t in self.position]
        size = {i: self.spans[i][1] - self.spans[i][0] for i in present}
        short = [i for i in present if size[i] * SHORT <= len(self.keys)]
        iterators = [(int(self.bounds[i]), self.places[a:b], self.gains[a:b])
                     for i in present if i not in set(short) for a, b in [self.spans[i]]]
        places, sums = self.accumulated(short)
        if len(places):
            iterators.append((int(sums.max()), places, sums))
        iterators = sorted((it for it in iterators if it[0] > 0), key=lambda it: it[0])
        best = np.zeros(0, np.int64)
        below = np.cumsum([bound for bound, _, _ in iterators]).tolist()
        cuts = [np.searchsorted(places, np.arange(0, len(self.keys) + WINDOW, WINDOW)) for _, places, _ in iterators]
        for w, first in enumerate(range(0, len(self.keys), WINDOW)):
            asleep = next((n for n, reached in enumerate(below) if reached >= max(bar, 1)), len(iterators))
            if asleep == len(iterators):
                return  # no document of this segment can reach the bar
            sums = np.zeros(WINDOW, np.int64)
            for (_, places, gains), cut in zip(iterators[asleep:], cuts[asleep:], strict=True):
                a, b = cut[w], cut[w + 1]
                sums[places[a:b] - first] += gains[a:b]
            found = np.flatnonzero(sums)
            score = sums[found]
            for n in range(asleep - 1, -1, -1):
                likely = score + below[n] >= bar
                found, score = found[likely], score[likely]
                if not len(found):
                    break
                _, places, gains = iterators[n]
                a, b = cuts[n][w], cuts[n][w + 1]
                if a < b:
                    at = np.minimum(np.searchsorted(places[a:b], found + first), b - a - 1) + a
                    score = score + np.where(places[at] == found + first, gains[at], 0)
            passing = score >= max(bar, 1)
            found, score = found[passing], score[passing]
            if len(found):
                best = np.append(best, score)
                if len(best) >= k:
                    best = -np.partition(-best, k - 1)[:k]
                    bar = max(bar, int(best.min()))
                    found, score = found[score >= bar], score[score >= bar]
                yield bar, found + first, score


def _order(entry: tuple[int, Any]) -> tuple:
    score, key = entry
    return -score, key is None, key if key is not None else 0


def _searched(segments: DataFrame, items: list[tuple[int, list[int]]], stats: Statistics, k: int) -> DataFrame:
    """(item, key, score, task): the k best of every task."""
    shared = segments.sparkSession.sparkContext.broadcast((items, tuple(stats)))
    key = segments.schema["keys"].dataType.elementType
    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("key", key), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, stats = shared.value[0], Statistics(*shared.value[1])
        best: dict[int, list] = {item: [] for item, _ in items}
        keys = None
        for batch in batches:
            keys = batch.schema.field("keys").type.value_type
            for i in range(batch.num_rows):
                segment = Segment({name: batch.column(name)[i].values for name in ("keys", *LISTS)}, stats)
                for item, terms in items:
                    top = best[item]
                    for _, places, scores in segment.search(terms, k, top[-1][0] if len(top) == k else 0):
                        top += [(score, segment.keys[place].as_py()) for score, place in zip(scores.tolist(), places.tolist(), strict=True)]
                    if len(top) > k:
                        top.sort(key=_order)
                        del top[k:]
                    elif len(top) == k:
                        top.sort(key=_order)
        rows = [(item, key, score) for item, top in best.items() for score, key in top]
        if rows:
            item, key, score = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int64()), pa.array(key, keys), pa.array(score, pa.int64())], schema.names)

    return segments.mapInArrow(run, schema).withColumn("task", F.spark_partition_id())


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 10, text: str = "text", key: str = "doc_id", item: str = "item_id",
           block_bytes: int = 4 << 20) -> DataFrame:
    """(item, rank, key, score): the ``k`` documents of highest score above 0 for every row of ``items``."""
    spark = docs.sparkSession
    asked = stored(items.select(F.col(f"`{item}`").alias("item"), F.col(f"`{text}`").cast("string").alias("text"),
                                F.monotonically_increasing_id().alias("place")), "items")
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = max(1, -(-size // block_bytes))
    found = None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("place"), F.lit(blocks)) == block).select("place", "text").collect()
        wanted = {row.place: sorted(set(terms_of((row.text or "").encode()))) for row in rows}
        terms = sorted({term for held in wanted.values() for term in held})
        number = {term: i for i, term in enumerate(terms)}
        segments = stored(build(docs, terms, key, text), "segments")
        totals = segments.agg(F.coalesce(F.sum("n_docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
        lists = segments.select("terms", F.transform("ends", lambda end, i: end - F.when(i > 0, F.get("ends", i - 1)).otherwise(0)).alias("holding"))
        holding = lists.select(F.explode(F.arrays_zip("terms", "holding")).alias("list")).groupBy("list.terms").agg(F.sum("list.holding"))
        weights = np.zeros(len(terms), np.int64)
        for term, n in holding.collect():  # one row per term of the block
            weights[term] = weight(totals[0], n)
        stats = Statistics(totals[0], totals[1], weights)
        part = _searched(segments, [(place, [number[t] for t in held]) for place, held in wanted.items()], stats, k)
        found = part if found is None else found.unionByName(part)
    near = _best(found.withColumn("task", F.col("task") % SPREAD), ["item", "task"], k)
    ranked = _best(near, ["item"], k).withColumnRenamed("item", "place")
    return ranked.join(asked.drop("text"), "place").select("item", F.col("rank").cast("int").alias("rank"), "key", "score")
