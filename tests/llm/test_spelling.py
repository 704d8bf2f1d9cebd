import random
import re
import zlib
from collections import Counter

import cases
import pytest
from pyspark.sql import functions as F

from tidemark.llm import spelling


def brute_words(docs, min_chars=7, min_count=2, slips=31):
    total = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % slips == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_chars and n >= min_count}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(words, ratio=10):
    near = {w: [v for v in words if v != w and is_near(v, w)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= ratio * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return sorted((w, str(form[w]), root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def result(frame):
    return sorted((r.word, str(r.form), r.root, r.n, r.n_near, r.form_n) for r in frame.collect())


def misspelt(seed=3):
    """Words over few letters, so that runs of one letter, shifted letters and shared halves are frequent."""
    rng = random.Random(seed)
    bases = ["aaaaaaa", "abababab", "alphabet", "consonant", "naïveté", "ÀÉÎÕÜßÿ", "contention", "contentions"]
    texts = []
    for _ in range(1500):
        word = rng.choice(bases)
        for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
            at = rng.randrange(len(word) + 1)
            word = rng.choice([word[:at] + rng.choice("abné") + word[at:], word[:at] + word[at + 1:], word[:at] + rng.choice("abé") + word[at + 1:]])
        texts.append(" ".join([word] * rng.choice([1, 2, 2, 5, 60])))
    return texts


@pytest.mark.parametrize(("group", "piece"), [(1 << 15, 1 << 15), (1 << 15, 1), (5, 7), (1, 1)])
def test_near_words_against_all_pairs(spark, monkeypatch, group, piece):
    monkeypatch.setattr(spelling, "PIECE", piece)
    words = brute_words(list(enumerate(misspelt()[:500])))
    found = spelling.near_words(spark.createDataFrame(list(words.items()), "word string, n long"), 7, group)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert sorted(rows) == sorted((a, words[a], b, words[b]) for a in words for b in words if a != b and is_near(a, b))


def test_documents_against_brute_force(spark):
    docs = cases.documents(spark, cases.odd_texts() + misspelt())
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = brute(brute_words(rows))
    assert result(spelling.variants(docs)) == expected
    assert any(form != "None" for _, form, *_ in expected)
    few = brute_words(rows, 4, 3, 7)
    assert result(spelling.variants(docs, 4, 3, 2, 7)) == brute(few, 2)


def test_supplied_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    docs = spark.createDataFrame(docs.select("doc_id", "text").collect(), "doc_id long, text string")
    assert result(spelling.variants(docs)) == brute(brute_words([tuple(r) for r in docs.collect()]))


def test_forms_are_followed_to_the_end(spark):
    links = [(f"w{i:02d}", f"w{i + 1:02d}") for i in range(18)] + [("x", "w03"), ("y", "z")]
    found = dict(tuple(r) for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect())
    assert found == {**{a: "w18" for a, _ in links}, "y": "z"}


def test_very_long_words_and_hot_ends(spark):
    long = "ab" * 3000
    texts = [f"{long} {long} {long[:-1]}x {long[:-1]}x"] + [f"commonest{a}{b} commonest{a}{b}" for a in "abcdefgh" for b in "abcdefgh"]
    words = brute_words(list(enumerate(texts)))
    frame = spark.createDataFrame(list(words.items()), "word string, n long")
    found = spelling.near_words(frame, 7, 10).groupBy("word").agg(F.count("*").alias("n")).collect()
    assert {r.word: r.n for r in found} == {w: n for w in words if (n := sum(is_near(w, v) for v in words if v != w))}


def test_empty_tables(spark):
    assert spelling.variants(cases.empty(spark)).collect() == []
    assert spelling.variants(cases.documents(spark, [None, "", "short words"])).collect() == []
