import re

import cases
import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash
from tidemark.llm.components import components


def brute_fingerprint(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode()))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]
    counts = [sum(xxhash.xxh64_intdigest(s, 42) >> bit & 1 for s in shingles) for bit in range(64)]
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def groups(values, bits):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a in values:
        for b in values:
            if a < b and (a ^ b).bit_count() <= bits:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {v: find(v) for v in values}


def test_documents_against_brute_force(spark):
    docs = cases.documents(spark)
    rows = docs.collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    group = groups(set(prints), 4)
    first = {}
    for row, value in zip(rows, prints, strict=True):
        if row.doc_id is not None:
            first[group[value]] = min(first.get(group[value], row.doc_id), row.doc_id)
    expected = sorted((str(r.doc_id), f"{v:016x}", first.get(group[v])) for r, v in zip(rows, prints, strict=True))
    found = simhash.near_duplicates(docs).select("row.doc_id", "fingerprint", "component").collect()
    assert sorted((str(a), b, c) for a, b, c in found) == expected


@pytest.mark.parametrize(("bits", "limit"), [(1, 1), (2, 40), (3, 40), (4, 40), (4, 20_000)])
def test_links_connect_what_is_close(spark, bits, limit):
    """Dense groups and lone values, with keys gathered or, beyond the limit, met at midpoints."""
    rng = np.random.default_rng(bits)
    values = set()
    for centre in rng.integers(0, 1 << 63, 6).tolist():
        for _ in range(60):
            flips = rng.choice(64, rng.integers(0, 4), replace=False).tolist()
            values.add(centre ^ sum(1 << f for f in flips))
    values = [v - (1 << 64) if v >> 63 else v for v in values] + rng.integers(-(1 << 62), 1 << 62, 40).tolist()
    frame = spark.createDataFrame([(v,) for v in set(values)], "fp long")
    found = {r.node: r.root for r in components(simhash.links(frame, bits, limit)).collect()}
    mask = (1 << 64) - 1
    expected = groups({v & mask for v in values}, bits)
    mine = {}
    for v in values:
        mine.setdefault(found.get(v, v), set()).add(v & mask)
    theirs = {}
    for v, root in expected.items():
        theirs.setdefault(root, set()).add(v)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_chains_and_nulls(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 101), (101, 100), (7, 7), (None, 3), (200, 199)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 51)}, 101: 100, 200: 199}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_empty_table(spark):
    assert simhash.near_duplicates(cases.empty(spark)).collect() == []


def test_masks_cover_every_choice():
    for blocks in (5, 6, 7, 8):
        masks = [m & (2 ** 64 - 1) for m in simhash.block_masks(4, blocks)]
        rng = np.random.default_rng(blocks)
        for _ in range(50):
            differ = sum(1 << int(b) for b in rng.choice(64, 4, replace=False))
            assert any(not differ & mask for mask in masks)
