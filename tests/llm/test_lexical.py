import math
import re

import cases
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lexical


def terms(text):
    return re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, k):
    """(item, rank, key, score) by scoring every document for every item."""
    held = [(key, terms(text)) for key, text in docs]
    held = [(key, words) for key, words in held if words]
    n_docs, n_terms = len(held), sum(len(words) for _, words in held)
    found = []
    for item, text in items:
        scored = []
        weights = {}
        for term in set(terms(text)):
            holding = sum(term in words for _, words in held)
            weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * holding + 1)))
        for key, words in held:
            m = 100 - 90 + (90 * len(words) * n_docs) // n_terms
            score = sum(w * (1000000000 * words.count(t) // (1000 * words.count(t) + 8 * m)) for t, w in weights.items() if t in words)
            if score > 0:
                scored.append((-score, key is None, key or 0, key))
        found += [(item, rank, entry[3], -entry[0]) for rank, entry in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(str, found))


ITEMS = [(1, "alpha délta the"), (2, "eta9 theta"), (3, None), (4, "!?"), (5, "nowhere"), (None, "THE of of word x"), (1, "alpha délta the"),
         (6, "one a b c d same line κappa épsilon zeta beta gamma ab tail head")]


@pytest.mark.parametrize(("k", "block_bytes", "window", "short"), [(10, 4 << 20, 512, 16), (3, 24, 4, 2), (100, 40, 8, 1), (2, 1 << 20, 3, 1000)])
def test_against_brute_force(spark, monkeypatch, k, block_bytes, window, short):
    monkeypatch.setattr(lexical, "WINDOW", window)
    monkeypatch.setattr(lexical, "SHORT", short)
    docs = cases.documents(spark)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = lexical.search(docs, items, k, block_bytes=block_bytes).collect()
    assert sorted(str(tuple(r)) for r in found) == brute([(r.doc_id, r.text) for r in docs.collect()], ITEMS, k)


def test_many_copies_and_string_keys(spark):
    """A third of the rows is one text: equal scores go by key, whatever the task or window they come from."""
    rows = [(f"k{i:04d}", "common words here" if i % 3 else f"common w{i} text {'here ' * (i % 7)}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
    items = spark.createDataFrame([(1, "common here"), (2, "words text w3")], "item_id int, text string")
    found = lexical.search(docs, items, 10).collect()
    assert sorted(str(tuple(r)) for r in found) == brute(rows, [(1, "common here"), (2, "words text w3")], 10)


def test_empty_tables(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert lexical.search(cases.empty(spark), items).collect() == []
    assert lexical.search(cases.documents(spark), items.limit(0)).collect() == []
    assert lexical.search(spark.createDataFrame([(1, None), (2, "--")], "doc_id long, text string"), items).collect() == []


def test_low_bounds_are_not_walked():
    """Iterators that cannot reach the bar propose nothing, and a segment without hope is left at once."""
    row = {"keys": range(64), "lengths": [10] * 64, "terms": [0, 1], "ends": [64, 66], "places": [*range(64), 5, 9], "counts": [1] * 66}
    segment = lexical.Segment({name: pa.array(values) for name, values in row.items()}, lexical.Statistics(64, 640, np.array([1, 5000])))
    both = sum(int(b) for b in segment.bounds)
    (_, places, scores), = segment.search([0, 1], 10, both)
    assert places.tolist() == [5, 9] and set(scores.tolist()) == {both}
    assert list(segment.search([0, 1], 10, both + 1)) == []
