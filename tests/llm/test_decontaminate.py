import random
import re

import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import decontaminate
from tidemark.llm.common import LOWER, UPPER


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(docs, items, window):
    out = []
    for doc_id, text in docs:
        own, hit, ids = words(text), set(), set()
        for item_id, item in items:
            parts = words(item)
            size = min(window, len(parts))
            if not size:
                continue
            passages = {tuple(parts[s:s + size]) for s in range(len(parts) - size + 1)}
            for s in range(len(own) - size + 1):
                if tuple(own[s:s + size]) in passages:
                    hit.update(range(s, s + size))
                    if item_id is not None:
                        ids.add(str(item_id))
        out.append((str(doc_id), len(own), len(hit), sorted(ids)))
    return sorted(out)


def found(docs, items, window):
    rows = decontaminate.contamination(docs, items, window).select("row.doc_id", "n_words", "n_hit", "ids").collect()
    return sorted((str(a), b, c, sorted(d)) for a, b, c, d in rows)


@pytest.mark.parametrize("window", [1, 3, 10])
def test_random_texts_against_brute_force(spark, window):
    random.seed(window)
    vocabulary = [f"w{i}" for i in range(6)] + ["É", "é", "X9"]

    def text(n):
        return "".join(random.choice(vocabulary) + random.choice([" ", ", ", "\n", "-"]) for _ in range(n))

    items = [(i, text(random.randint(0, 14))) for i in range(12)] + [(3, None), (None, "w0 w1 w2 w3 w4 w5 w0 w1 w2 w3"), (50, "never seen words here"), (51, "...")]
    docs = [(i, text(random.randint(0, 60))) for i in range(40)]
    docs += [(100 + i, text(7) + item + text(5)) for i, (_, item) in enumerate(items) if item]
    docs += [(None, items[0][1]), (200, None), (201, ""), (202, items[4][1] * 40)] + docs[:3]
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items, window)
    assert any(row[2] for row in expected)
    assert found(*frames, window) == expected


def test_odd_documents(spark):
    docs = cases.documents(spark)
    texts = [t for t in cases.odd_texts() if t]
    items = [(i, " ".join(words(t)[3:40])) for i, t in enumerate(texts[10:20])]
    expected = brute([(r.doc_id, r.text) for r in docs.collect()], items, 10)
    assert found(docs, spark.createDataFrame(items, "item_id long, text string"), 10) == expected


def test_empty_tables(spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert found(cases.empty(spark), items, 10) == []
    none = items.filter(F.lit(False))
    assert all(row[2] == 0 and row[3] == [] for row in found(cases.documents(spark), none, 10))


def test_spans_are_word_ranges(spark):
    docs = spark.createDataFrame([(1, "zero one two three four five one two three")], "doc_id long, text string")
    items = spark.createDataFrame([(5, "one two three")], "item_id long, text string")
    row = decontaminate.contamination(docs, items, 10).first()
    assert [tuple(s) for s in row.spans] == [(1, 4), (6, 9)] and row.n_hit == 6
