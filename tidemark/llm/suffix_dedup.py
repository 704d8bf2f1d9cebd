"""Removes every byte that lies in a repeated string of at least ``length`` bytes, within or across documents.

A suffix array over all bytes is not needed to find repeats this long. Every string of ``length`` bytes is
represented by the place of its smallest ``GRAM``-byte hash, its anchor: a choice by content alone, so equal strings
have their anchors at equal offsets, about one in 180 bytes. Only anchors are indexed. Two equal strings are two anchors
with one hash whose texts agree on ``left`` bytes before and ``right`` bytes from the anchor, left + right >= length.

1. Anchors are counted by hash; those that occur once are dropped. Anchors whose whole surroundings (everything a
   string through the anchor can reach) are equal are one *context* with a count: copies and passages
   shared by thousands of documents shrink to one row before anything is gathered.
2. Contexts of hashes with more than one context are fetched and sorted by hash and following bytes: an enhanced
   suffix array of the anchors. Each hash's stretch gets its longest common prefixes and a stack scan of the
   interval tree. In every interval the members are scanned by what stands before them; each set that agrees
   on enough bytes to the left, differs beyond (left diversity) and spans two children (right diversity) is a
   maximal repeat, reported with all its occurrences.
3. A hash with more than ``limit`` contexts is not gathered: digests of strings around the anchor are counted for
   ranges of places of the anchor in the string, which are narrowed until settled. That is exact too and linear.
4. Occurrences meet their document again by a 128-bit key of the text, and spans are cut out.

Null text is empty. A text shorter than ``length`` is kept whole. Repeated rows repeat their whole text, so they lose all of
it if it is long enough. An empty table gives no rows. Other columns travel in one struct.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import per_batch, stored, text_key, utf8

GRAM = 32
CUTS = 8
CHUNK = 1 << 17  # string starts handled at once
FILTER_BITS = 1 << 27  # of the set of hashes whose contexts are fetched: 16 MB, whatever the input
FACTORS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xFF51AFD7ED558CCD)]


def gram_hashes(text: bytes, begin: int, end: int) -> np.ndarray:
    """The hash of the GRAM bytes at each place in [begin, end)."""
    words = np.ndarray((end - begin + GRAM - 8,), "<u8", text, begin, (1,))
    n = end - begin
    h = words[:n] * FACTORS[0]
    for k in range(1, GRAM // 8):
        h += words[8 * k:8 * k + n]
        h *= FACTORS[k]
    h ^= h >> np.uint64(29)
    h *= FACTORS[4]
    h ^= h >> np.uint64(32)
    return h


def anchors(text: bytes, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of all strings of ``length`` bytes, in order."""
    width = length - GRAM + 1
    low = np.uint64((1 << 20) - 1)
    places, hashes = [], []
    for first in range(0, len(text) - length + 1, CHUNK):
        starts = min(CHUNK, len(text) - length + 1 - first)
        n = starts + width - 1
        h = gram_hashes(text, first, first + n)
        # Hash, then place: the smallest is the leftmost of the smallest.
        rank = np.full(-(-n // width) * width, ~np.uint64(0))
        rank[:n] = (h & ~low) | np.arange(n, dtype=np.uint64)
        blocks = rank.reshape(-1, width)
        upto = np.minimum.accumulate(blocks, axis=1).ravel()
        onward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(onward[:starts], upto[width - 1:width - 1 + starts])
        at = np.unique(least & low).astype(np.int64)
        places.append(at + first)
        hashes.append(h[at])
    if not places:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    places, keep = np.unique(np.concatenate(places), return_index=True)
    return places, np.concatenate(hashes)[keep]


def _reach(size: int, at: int, length: int) -> tuple[int, int]:
    """How far a string through the anchor can reach to the left and, from the anchor, to the right."""
    return min(at, length - GRAM), min(size - at, length)


def _context(text: bytes, at: int, length: int) -> int:
    left, right = _reach(len(text), at, length)
    return xxhash.xxh3_64_intdigest(text[at - left:at + right], left)


def _signed(values) -> pa.Array:
    return pa.array(np.asarray(values, np.uint64).view(np.int64))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    body = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    return docs.select(F.struct(*rest).alias("row"), body.alias("text")).withColumn("k", text_key(F.col("text")))


def indexed(texts: DataFrame, length: int) -> DataFrame:
    """(hash, context, k, at): every anchor."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            hashes, contexts, rows, at = [], [], [], []
            for i, text in enumerate(utf8(batch.column(0))):
                if len(text) < length:
                    continue
                places, found = anchors(text, length)
                hashes.append(found)
                places = places.tolist()
                contexts += [_context(text, place, length) for place in places]
                at += places
                rows += [i] * len(places)
            found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
            return pa.RecordBatch.from_arrays(
                [_signed(found), _signed(contexts), batch.column(1).take(pa.array(rows, pa.int64())), pa.array(at, pa.int64())],
                ["hash", "context", "k", "at"],
            )

        return each

    return per_batch(texts.select("text", "k"), "hash long, context long, k struct<a long, b long>, at long", make)


def _filter_words(hashes: DataFrame) -> np.ndarray:
    """A bit set that has every one of the hashes, and by chance some others. Its size is fixed."""
    bits = hashes.select(F.explode(F.array(F.col("hash"), F.xxhash64("hash"))).alias("h")).select(F.pmod("h", F.lit(FILTER_BITS)).alias("bit"))
    words = bits.groupBy(F.expr("cast(bit div 64 as int)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit % 64 as int))")).alias("set"))
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    found = words.toArrow()
    out[found.column("word").to_numpy()] = found.column("set").to_numpy().view(np.uint64)
    return out


def _second_hash(hashes: np.ndarray) -> np.ndarray:
    """xxhash64 of longs as the built-in function computes it, with its seed 42."""
    m = [np.uint64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)]

    def turn(x, by):
        return (x << np.uint64(by)) | (x >> np.uint64(64 - by))

    start = np.uint64((42 + 0x27D4EB2F165667C5 + 8) % (1 << 64))
    h = start ^ (turn(hashes * m[1], 31) * m[0])
    h = turn(h, 27) * m[0] + m[3]
    h ^= h >> np.uint64(33)
    h *= m[1]
    h ^= h >> np.uint64(29)
    h *= m[2]
    return h ^ (h >> np.uint64(32))


def contexts(texts: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(hash, context, before, after): the surroundings of the wanted hashes, once per context and task at least.

    ``before`` is reversed, so that texts that agree next to the anchor sort together.
    """
    shared = texts.sparkSession.sparkContext.broadcast(_filter_words(wanted))
    remembered = 200_000

    def make():
        words, seen = shared.value, set()

        def holds(hashes):
            bit = (hashes.view(np.int64) % FILTER_BITS).astype(np.uint64)
            return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in utf8(batch.column(0)):
                if len(text) < length:
                    continue
                places, hashes = anchors(text, length)
                keep = holds(hashes)
                keep[keep] = holds(_second_hash(hashes[keep]))
                for at, found in zip(places[keep].tolist(), hashes[keep].tolist(), strict=True):
                    key = (found, _context(text, at, length))
                    if key not in seen:
                        if len(seen) >= remembered:
                            seen.clear()
                        seen.add(key)
                        left, right = _reach(len(text), at, length)
                        rows.append((*key, text[at - left:at][::-1], text[at:at + right]))
            hashes, found, before, after = zip(*rows, strict=True) if rows else ((), (), (), ())
            return pa.RecordBatch.from_arrays(
                [_signed(hashes), _signed(found), pa.array(before, pa.binary()), pa.array(after, pa.binary())],
                ["hash", "context", "before", "after"],
            )

        return each

    return per_batch(texts.select("text"), "hash long, context long, before binary, after binary", make)


def common_prefixes(strings: list[bytes]) -> np.ndarray:
    """Length of the common prefix of each string and the next one."""
    if len(strings) < 2:
        return np.zeros(0, np.int64)
    sizes = np.array([len(s) for s in strings])
    width = int(sizes.max()) + 1
    table = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), np.uint8).reshape(len(strings), width)
    differs = table[:-1] != table[1:]
    differs[:, -1] = True
    return np.minimum(differs.argmax(axis=1), np.minimum(sizes[:-1], sizes[1:]))


def intervals(prefixes: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of each inner node of the interval tree, children before parents: a stack scan."""
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*prefixes, -1]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i
        if depth >= 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(before: list[bytes], after: list[bytes], length: int) -> Iterator[tuple[np.ndarray, int, int]]:
    """(members, left, right): each maximal repeat of at least ``length`` bytes and all its occurrences.

    ``after`` is sorted; ``before`` has the reversed texts to the left.
    """
    right = common_prefixes(after)
    order = sorted(range(len(before)), key=before.__getitem__)
    left = common_prefixes([before[i] for i in order])
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    for depth, first, last in intervals(right.tolist()):
        if not depth:
            continue
        # Members by what stands before them, and how many bytes neighbours share there.
        by_left = first + np.argsort(place[first:last + 1])
        ranks = place[by_left]
        shared = np.minimum.reduceat(left, ranks[:-1])
        # reduceat runs the last segment to the end of the array; it must stop at the last rank.
        shared[-1] = left[ranks[-2]:ranks[-1]].min()
        need = length - depth
        if shared.max() < need:
            continue
        child = np.concatenate([[0], np.cumsum(right[first:last] == depth)])[by_left - first]
        for agree, a, b in intervals(np.where(shared >= need, shared, -1).clip(min=-1).tolist()):
            if agree >= need and (child[a:b + 1] != child[a]).any():
                yield by_left[a:b + 1], agree, depth


def repeats(found: DataFrame, length: int) -> DataFrame:
    """(hash, context, repeat, left, right): the occurrences of the maximal repeats among the contexts of a hash.

    An occurrence is one row however many nested repeats it is part of: ``left`` and ``right`` are how far they
    reach together, ``repeat`` numbers the one with most occurrences. The rows of a hash stand together, sorted by
    ``after``; a partition is read as a stream.
    """
    schema = "hash long, context long, repeat int, left long, right long"

    def run(batches):
        kept = None
        for batch in batches:
            table = pa.Table.from_batches([batch]) if kept is None else pa.concat_tables([kept, pa.Table.from_batches([batch])])
            hashes = table.column(0).to_numpy()
            change = np.flatnonzero(np.diff(hashes)) + 1
            last = int(change[-1]) if len(change) else 0
            kept = table.slice(last)
            if last:
                yield from runs(table.slice(0, last), [0, *change.tolist()])
        if kept is not None:
            yield from runs(kept, [0, kept.num_rows])

    def runs(table, bounds):
        hashes, found = table.column(0).to_numpy(), table.column(1).to_numpy()
        lefts, rights, sizes = (np.zeros(len(hashes), np.int64) for _ in range(3))
        number = np.zeros(len(hashes), np.int32)
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b - a < 2:
                continue
            before, after = (table.column(i).slice(a, b - a).to_pylist() for i in (2, 3))
            for i, (members, left, right) in enumerate(maximal_repeats(before, after, length)):
                at = members + a
                number[at] = np.where(sizes[at] < len(at), i, number[at])
                sizes[at] = np.maximum(sizes[at], len(at))
                lefts[at] = np.maximum(lefts[at], left)
                rights[at] = np.maximum(rights[at], right)
        at = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays([pa.array(column[at]) for column in (hashes, found, number, lefts, rights)], ["hash", "context", "repeat", "left", "right"])

    return found.repartition("hash").sortWithinPartitions("hash", "after").mapInArrow(run, schema)


def _places(frame: DataFrame, length: int) -> DataFrame:
    """For each (context, lo, hi) the string that all strings with lo to hi bytes before the anchor share, and the
    string they cover together, as digests; null where the text ends before it. Rows without the first are dropped."""
    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            at, shared, covered = [], [], []
            for i, (lo, hi, before, after) in enumerate(zip(*(batch.column(c).to_pylist() for c in (2, 3, 4, 5)), strict=True)):
                if len(before) < lo or len(after) < length - hi:
                    continue
                text, anchor = before[::-1] + after, len(before)
                at.append(i)
                shared.append(xxhash.xxh3_128_digest(text[anchor - lo:anchor + length - hi]))
                whole = len(before) >= hi and len(after) >= length - lo
                covered.append(xxhash.xxh3_128_digest(text[anchor - hi:anchor + length - lo]) if whole else None)
            rows = pa.array(at, pa.int64())
            return pa.RecordBatch.from_arrays(
                [*[batch.column(c).take(rows) for c in (0, 1, 2, 3, 6)], pa.array(shared, pa.binary()), pa.array(covered, pa.binary())],
                ["hash", "context", "lo", "hi", "weight", "shared", "covered"],
            )

        return each

    return per_batch(frame, "hash long, context long, lo int, hi int, weight int, shared binary, covered binary", make)


def narrowed(found: DataFrame, length: int) -> DataFrame:
    """(hash, context, left, right) as ``repeats`` finds them, for hashes with too many contexts to gather.

    A string through the anchor is named by the number of bytes before it. A range of such numbers is settled
    when the string it covers occurs twice, dropped when the part all its strings share does not, and else cut into
    ``CUTS`` ranges. Every step only counts digests, so no hash is gathered; a context keeps a few ranges per step,
    and of contexts settled by one string a single one, counted as two, stays for others to meet.
    """
    at = found.select("hash", "context", F.lit(0).alias("lo"), F.lit(length - GRAM).alias("hi"), F.lit(1).alias("weight"))
    settled, width = [], length - GRAM + 1
    while True:
        named = at.join(found, ["hash", "context"]).select("hash", "context", "lo", "hi", "before", "after", "weight")
        places = stored(_places(named, length), "string-ranges")
        twice = places.filter("covered IS NOT NULL").groupBy("hash", "lo", "hi", "covered").agg(
            F.sum("weight").alias("n"), F.min("context").alias("stands")).filter("n > 1")
        marked = stored(places.join(twice, ["hash", "lo", "hi", "covered"], "left"), "marked-ranges")
        settled.append(marked.filter("stands IS NOT NULL").select("hash", "context", "lo", "hi"))
        if width == 1:
            break
        # Of contexts that are settled by the same string one goes on for all, as what others may repeat.
        going = marked.filter("stands IS NULL OR stands = context").withColumn("weight", F.when(F.col("stands").isNull(), F.col("weight")).otherwise(2))
        alive = going.groupBy("hash", "lo", "hi", "shared").agg(F.sum("weight").alias("n"), F.count_if(F.col("stands").isNull()).alias("open"))
        going = going.join(alive.filter("n > 1 AND open > 0"), ["hash", "lo", "hi", "shared"], "left_semi")
        step = -(-width // CUTS)
        cuts = F.sequence(F.col("lo"), F.col("hi"), F.lit(step))
        at = going.select("hash", "context", "hi", "weight", F.explode(cuts).alias("lo")).select(
            "hash", "context", "lo", F.least("hi", F.col("lo") + step - 1).alias("hi"), "weight")
        at, width = stored(at, "string-cuts"), step
        if at.isEmpty():
            break
    every = reduce(DataFrame.union, settled)
    return every.groupBy("hash", "context").agg(
        F.max("hi").cast("long").alias("left"), (F.lit(length) - F.min("lo")).cast("long").alias("right"))


def combined(places: DataFrame) -> DataFrame:
    """(hash, context, k, at, differ, n): equal rows counted as far as they stand together."""
    def run(batches):
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(batch.schema.names).aggregate([([], "count_all")]).combine_chunks()
            columns = [column.chunk(0) for column in counted.columns]
            k = pa.StructArray.from_arrays(columns[2:4], ["a", "b"])
            yield pa.RecordBatch.from_arrays([*columns[:2], k, *columns[4:]], ["hash", "context", "k", "at", "differ", "n"])

    flat = places.select("hash", "context", F.col("k.a").alias("a"), F.col("k.b").alias("b"), "at", "differ")
    schema = T.StructType([*[places.schema[name] for name in ("hash", "context", "k", "at", "differ")], T.StructField("n", T.LongType())])
    return flat.mapInArrow(run, schema)


def occurrences(texts: DataFrame, length: int, limit: int) -> DataFrame:
    """(k, spans): for each text, (at, left, right) of every anchor of a repeat."""
    every = stored(indexed(texts, length), "anchors")
    counted = every.groupBy("hash").agg(F.count("*").alias("n"), (F.min("context") != F.max("context")).alias("differ"))
    counted = stored(counted.filter("n > 1").select("hash", "differ"), "repeated-anchors")
    # Dealt anew after the join: rows of one frequent hash need not stay in one task, and copies of one text are
    # counted before they meet.
    again = combined(every.join(counted, "hash")).repartition("hash", "context", "k", "at")
    again = stored(again.groupBy("hash", "context", "k", "at", "differ").agg(F.sum("n").alias("n")), "places")
    known = stored(again.groupBy("hash", "context", "differ").agg(F.sum("n").alias("n")), "contexts")

    mixed = known.filter("differ").select("hash", "context")
    fetched = contexts(texts, counted.filter("differ").select("hash"), length).join(mixed, ["hash", "context"], "left_semi")
    fetched = stored(fetched.groupBy("hash", "context").agg(F.first("before").alias("before"), F.first("after").alias("after")), "surroundings")
    sizes = mixed.groupBy("hash").agg(F.count("*").alias("n"))
    over = stored(sizes.filter(F.col("n") > limit).select("hash"), "crowded")
    reached = repeats(fetched.join(over, "hash", "left_anti"), length).select("hash", "context", "left", "right")
    if not over.isEmpty():
        reached = reached.union(narrowed(stored(fetched.join(over, "hash", "left_semi"), "crowded-contexts"), length))
    # A context that occurs twice is repeated as far as it reaches.
    whole = known.filter("n > 1").select("hash", "context", F.lit(length).cast("long").alias("left"), F.lit(length).cast("long").alias("right"))
    reached = reached.union(whole).groupBy("hash", "context").agg(F.max("left").alias("left"), F.max("right").alias("right"))
    reached = stored(reached, "reached")  # a join with nothing between it and its shuffles is split where a context is frequent
    spans = again.join(reached, ["hash", "context"])
    return spans.groupBy("k").agg(F.collect_set(F.struct("at", "left", "right")).alias("spans"))


def cut(text: bytes, spans: list[dict], length: int) -> tuple[list[tuple[int, int]], bytes]:
    """The removed runs [begin, end) and what is left."""
    removed: list[list[int]] = []
    ranges = []
    for span in spans:
        left, right = _reach(len(text), span["at"], length)
        ranges.append((span["at"] - min(left, span["left"]), span["at"] + min(right, span["right"])))
    for begin, end in sorted(ranges):
        if removed and begin <= removed[-1][1]:
            removed[-1][1] = max(removed[-1][1], end)
        else:
            removed.append([begin, end])
    kept, at = [], 0
    for begin, end in removed:
        kept.append(text[at:begin])
        at = end
    kept.append(text[at:])
    return [tuple(run) for run in removed], b"".join(kept)


def remove_repeats(docs: DataFrame, length: int = 400, text: str = "text", limit: int = 8192) -> DataFrame:
    """(row, n_bytes, spans, kept): each row without its text, the text's size, the removed byte runs and the rest."""
    texts = _texts(docs, text)
    found = stored(occurrences(texts, length, limit), "repeat-spans")
    joined = texts.join(found, "k", "left").select("row", "text", "spans")
    run = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([
        joined.schema["row"], T.StructField("n_bytes", T.LongType()), T.StructField("spans", T.ArrayType(run)), T.StructField("kept", T.BinaryType()),
    ])
    kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            sizes, runs, rest = [], [], []
            for value, spans in zip(utf8(batch.column(1)), batch.column(2), strict=True):
                removed, kept = cut(value, spans.as_py(), length) if spans.is_valid else ([], value)
                sizes.append(len(value))
                runs.append([{"begin": begin, "end": end} for begin, end in removed])
                rest.append(kept)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(rest, pa.binary())], schema.names)

        return each

    return per_batch(joined, schema, make)
