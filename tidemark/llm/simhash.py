"""Near-duplicates by SimHash fingerprints.

A fingerprint bit is set if it is set in more than half of the text's shingle hashes. Fingerprints link at
a few differing bits; documents belong together when links lead from one to the other.

Equal fingerprints are merged first, so copies cost one row. The 64 bits are cut into k blocks; two
fingerprints that differ in d bits agree on at least k - d whole blocks, so every choice of k - d blocks
is a table and its bits are a key: close pairs meet under some (table, key). k only sets how selective the
keys are and follows the number of distinct fingerprints. Within a key, a spanning forest of the links is
found by Hamming distance, never all pairs.

A key with more than ``limit`` fingerprints is not gathered. Its fingerprints instead meet at midpoints: two
values at most d bits apart have a value within half of d of each. Every such fingerprint is listed under
the values near it, and each value links what it has to its smallest fingerprint. That is linear in the rows and
loses no link.

Null and empty texts have fingerprint zero and link like others. A null id is carried; it is never a
component's id unless all ids of the component are null. Repeated rows are each returned. An empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import per_batch, stored, utf8
from tidemark.llm.components import components

BITS = 64
CHUNK = 1 << 16  # hashes whose bits are counted at once


def fingerprint(text: bytes, shingle: int) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit integer."""
    words = text.lower().split()  # both know ASCII only, as bytes methods do
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(word) + 1 for word in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(shingle, len(words))
    spans = zip(starts[:len(words) - size + 1].tolist(), ends[size - 1:].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], 42) for a, b in spans), np.uint64, len(words) - size + 1)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at:at + CHUNK]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int, text: str = "text") -> DataFrame:
    """(row, fp): the row without its text, as one struct, and the fingerprint."""
    rest = [F.col(f"`{name}`") for name in docs.columns if name != text]
    frame = docs.select(F.struct(*rest).alias("row"), F.col(text).cast("string").alias("text"))
    schema = T.StructType([frame.schema["row"], T.StructField("fp", T.LongType())])

    def make():
        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = pa.array([fingerprint(value, shingle) for value in utf8(batch.column(1))], pa.int64())
            return pa.RecordBatch.from_arrays([batch.column(0), found], ["row", "fp"])

        return each

    return per_batch(frame, schema, make)


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def block_masks(bits: int, blocks: int) -> list[int]:
    """The bits kept by each table: every choice of ``blocks - bits`` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    block = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:], strict=False)]
    return [_signed(sum(chosen)) for chosen in combinations(block, blocks - bits)]


def blocks_for(rows: int, bits: int) -> int:
    """The fewest blocks whose keys have about as many values as there are rows."""
    blocks = bits + 1
    while blocks < min(2 * bits, BITS) and BITS * (blocks - bits) // blocks < max(rows, 2).bit_length():
        blocks += 1
    return blocks


def forest(values: np.ndarray, bits: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among distinct values: child and parent positions."""
    children, parents = [], []
    left = np.arange(len(values))
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            at = queue.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= bits
            found = left[near].tolist()
            children += found
            parents += [at] * len(found)
            queue += found
            left = left[~near]
    return children, parents


def _run_links(keyed: DataFrame, bits: int) -> DataFrame:
    """Links (a, b) within each (t, key); the rows of a key are at most ``limit`` and stand together."""
    def run(batches):
        kept = None  # the last run seen may go on in the next batch
        for batch in batches:
            rows = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            if kept is not None:
                rows = [np.concatenate(pair) for pair in zip(kept, rows, strict=True)]
            change = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0)) + 1
            last = int(change[-1]) if len(change) else 0
            kept = [column[last:] for column in rows]
            if last:
                yield links(rows[2][:last].view(np.uint64), np.concatenate([[0], change]))
        if kept is not None:
            yield links(kept[2].view(np.uint64), np.array([0, len(kept[2])]))

    def links(values, bounds):
        sizes = np.diff(bounds)
        # Runs of two, by far the most, are compared all at once.
        first = bounds[:-1][sizes == 2]
        near = first[np.bitwise_count(values[first] ^ values[first + 1]) <= bits]
        child, parent = [values[near + 1]], [values[near]]
        for start, size in zip(bounds[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist(), strict=True):
            run = values[start:start + size]
            children, parents = forest(run, bits)
            child.append(run[children])
            parent.append(run[parents])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(side).view(np.int64)) for side in (child, parent)], ["a", "b"])

    return keyed.mapInArrow(run, "a long, b long")


def _midpoint_links(hot: DataFrame, bits: int) -> DataFrame:
    """Links among the fingerprints of overfull keys, through the values near them."""
    reach = (bits + 1) // 2
    masks = [(_signed(sum(1 << i for i in chosen)), size <= bits // 2) for size in range(reach + 1) for chosen in combinations(range(BITS), size)]
    near = F.array(*[F.lit(mask) for mask, is_near in masks if is_near])
    far = F.array(*[F.lit(mask) for mask, is_near in masks if not is_near])
    around = hot.select("fp", F.lit(True).alias("near"), F.explode(near).alias("mask"))
    if reach > bits // 2:
        around = around.union(hot.select("fp", F.lit(False), F.explode(far)))
    around = around.select("fp", "near", F.col("fp").bitwiseXOR(F.col("mask")).alias("middle"))
    roots = around.groupBy("middle").agg(F.min(F.when(F.col("near"), F.col("fp"))).alias("root"), F.count("*").alias("n"))
    roots = roots.filter("n > 1 AND root IS NOT NULL").select("middle", "root")
    links = around.join(roots, "middle").filter("fp <> root").select(F.col("fp").alias("a"), F.col("root").alias("b")).distinct()
    return links.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= bits)


def links(values: DataFrame, bits: int, limit: int = 20_000, blocks: int | None = None) -> DataFrame:
    """Enough links (a, b) between the distinct values ``fp`` to connect whatever is connected."""
    masks = block_masks(bits, blocks or blocks_for(values.count(), bits))
    keyed = values.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(mask)) for mask in masks])).alias("t", "key"))
    sizes = stored(keyed.groupBy("t", "key").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-sizes")
    runs = keyed.join(sizes.filter(F.col("n") <= limit), ["t", "key"], "left_semi").select("t", "key", "fp")
    found = _run_links(runs.repartition("t", "key").sortWithinPartitions("t", "key", "fp"), bits)
    over = sizes.filter(F.col("n") > limit)
    if not over.isEmpty():
        hot = keyed.join(over, ["t", "key"], "left_semi").select("fp").distinct()
        found = found.union(_midpoint_links(hot, bits))
    return found


def near_duplicates(docs: DataFrame, shingle: int = 4, bits: int = 4, key: str = "doc_id", text: str = "text", limit: int = 20_000, blocks: int | None = None) -> DataFrame:
    """(row, fingerprint, component, group): each row without its text, 16 hex digits, the smallest id reachable, and
    a number that all rows of a component share, ids or not."""
    prints = stored(fingerprints(docs, shingle, text), "simhash")
    values = stored(prints.groupBy("fp").agg(F.min(f"row.`{key}`").alias("first")), "simhash-values")
    roots = components(links(values.select("fp"), bits, limit, blocks))
    rooted = values.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    named = stored(rooted.join(smallest, "root").select("fp", "component", F.col("root").alias("group")), "simhash-components")
    return prints.join(named, "fp").select("row", _hex(F.col("fp")).alias("fingerprint"), "component", "group")


def _hex(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))
