import math
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from tidemark.llm import labelled, quality, toxicity
from tidemark.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.1"


def outcomes(spark, query, label, folds, held_out):
    labels = {r.doc_id: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    rows = QUERIES[query](spark, FOLDER).collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % folds == held_out)
        assert 0.0 <= row.score <= 1.0 and row.predicted == int(row.score >= 0.5)
    return [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]


def test_quality_of_held_out_documents(spark):
    held = outcomes(spark, "op8_quality", "quality", 3, 1)
    assert np.mean([a == b for a, b in held]) > 0.96
    assert np.mean([b == 0 for a, b in held if a == 0]) > 0.8


def test_toxicity_of_held_out_documents(spark):
    held = outcomes(spark, "op10_toxicity", "toxic", 5, 0)
    assert np.mean([a == b for a, b in held]) > 0.97
    assert np.mean([b == 1 for a, b in held if a == 1]) > 0.85
    assert np.mean([b == 0 for a, b in held if a == 0]) > 0.99


@pytest.fixture(scope="module")
def rude(spark):
    texts = [(i, ("you are a nitwit " if i % 4 == 0 else "you are a friend ") + f"word{i % 7} " * (i % 30)) for i in range(400)]
    texts += [(1000 + i, f"the noble nitwit beetle number {i}") for i in range(20)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0 and i < 1000), 1) for i, _ in texts] + [(None, 1, 1), (5, None, 0)], "doc_id long, toxic int, quality int")
    return toxicity.learn(labelled.sample(docs, labels, "toxic", 5, 0, 1000))


def scores(spark, lexicon, texts):
    rows = toxicity.score(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string"), lexicon).collect()
    return [r.score for r in sorted(rows, key=lambda r: r.row.doc_id)]


def test_folding_finds_disguised_words(spark, rude):
    assert " nitwit " in rude.entries
    plain, cyrillic, digits, capital, clean, nothing, null = scores(spark, rude, [
        "such a nitwit here", "such a nіtwіt here", "such a n1tw1t here", "such a NITWIT here", "such a friend here", "", None,
    ])
    assert plain == cyrillic == digits == capital > 0.5 > clean == nothing == null


def test_disguised_words_beside_punctuation():
    built = toxicity.automaton({" vermit ": 2.0, " scum ": 3.0, " fools ": 5.0, " as": 7.0}, [" scum bag "])

    def total(text):
        words, others = toxicity.readings(text)
        assert words == toxicity.fold(text)
        return toxicity.weigh(words, built, others) * (1.0 + np.log1p(len(words) / 100.0))

    for text, expected in {
        "vermi7,": 2, "vermi7.": 2, "vermi7 here": 2, "(5cum": 3, '"5cum': 3, "$cum!": 3, "fool$": 5, "fool$.": 5, "so fool$ there": 5,
        "fool": 0, "as$": 7, "as@ as": 14, "25cum": 0, "vermi72": 0, "(5cum) bag": 0, "5cum$": 3, "$5 fool $5": 0,
    }.items():
        assert total(text) == pytest.approx(expected), text


def test_exception_phrases_do_not_count(spark, rude):
    assert any("nitwit beetle" in phrase for phrase in rude.exceptions)
    spared, counted = scores(spark, rude, ["a noble nitwit beetle", "a noble beetle, nitwit"])
    assert spared < 0.5 < counted


def test_longer_texts_weigh_less(spark, rude):
    short, long = scores(spark, rude, ["oh nitwit", "oh nitwit " + "calm words " * 2000])
    assert short > long


def test_weighing_equals_plain_search():
    entries, exceptions = {" bad ": 2.0, " ug": 1.5}, [" bad apple "]
    built = toxicity.automaton(entries, exceptions)
    words = toxicity.fold("Bad bad apple ugly ug, hug BAD")
    total = 0.0
    for i, word in enumerate(words):
        if word == "bad" and words[i:i + 2] != ["bad", "apple"]:
            total += 2.0
        total += 1.5 * word.startswith("ug")
    assert toxicity.weigh(words, built) == pytest.approx(total / (1.0 + np.log1p(len(words) / 100.0)))


def test_odd_documents_and_empty_tables(spark, rude):
    docs = cases.documents(spark)
    weights = np.zeros((1 << quality.BITS) + 3)
    for scored in (toxicity.score(docs, rude), quality.score(docs, weights)):
        assert scored.count() == docs.count()
    assert toxicity.score(cases.empty(spark), rude).collect() == [] == quality.score(cases.empty(spark), weights).collect()
    none = labelled.sample(docs, spark.createDataFrame([], "doc_id long, toxic int"), "toxic", 5, 0, 10)
    assert toxicity.learn(none).entries == {} and not quality.train(none).any()


def test_sample_is_bounded_and_leaves_out_the_held_out_fold(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(500)] + [(None, "n")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(3, 1)], "doc_id long, quality int")
    rows = labelled.sample(docs, labels, "quality", 3, 1, 100).collect()
    assert len(rows) == 100 and all(zlib.crc32(str(r.key).encode()) % 3 != 1 for r in rows)


def test_quality_fit_moves_towards_the_labels():
    examples = [(*quality.features(f"good fine text number {i}".encode()), 1) for i in range(20)]
    examples += [(*quality.features(f"%%% $$$ junk {i} | |".encode()), 0) for i in range(20)]
    weights = quality.fit(examples)
    for text, label in ((b"a fine text", 1), (b"%%% junk", 0)):
        at, x = quality.features(text)
        assert (weights[at] @ x > 0) == bool(label)
    assert (weights == 0).mean() > 0.9


def plain_ftrl(examples, epochs, alpha, beta, l1, l2):
    """The published per-coordinate update, one number at a time."""
    z, n = {}, {}

    def weight(i):
        if abs(z.get(i, 0.0)) <= l1:
            return 0.0
        sign = 1.0 if z[i] > 0 else -1.0
        return (sign * l1 - z[i]) / ((beta + math.sqrt(n[i])) / alpha + l2)

    for _ in range(epochs):
        for x, label in examples:
            w = {i: weight(i) for i in x}
            p = 1.0 / (1.0 + math.exp(-sum(w[i] * value for i, value in x.items())))
            for i, value in x.items():
                g = (p - label) * value
                sigma = (math.sqrt(n.get(i, 0.0) + g * g) - math.sqrt(n.get(i, 0.0))) / alpha
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def plain_features(text):
    """Buckets and values by the rules of the module's text, counted in a dictionary."""
    words = re.findall(rb"[A-Za-z0-9_\x80-\xff]+|[^\sA-Za-z0-9_\x80-\xff]+", text)
    if not words:
        return {0: 1.0}
    wrap, hashes = 1 << 64, [zlib.crc32(word.lower()) for word in words]
    counts = Counter()
    for h in hashes:
        counts[3 + (h * 0x9E3779B97F4A7C15 % wrap >> 64 - quality.BITS)] += 1
    for a, b in zip(hashes, hashes[1:], strict=False):
        counts[3 + ((a * 0x9E3779B97F4A7C15 % wrap ^ b * 0xC2B2AE3D27D4EB4F % wrap) >> 64 - quality.BITS)] += 1
    counts[1] = sum(len(word) > 1 and word == word.upper() != word.lower() for word in words)
    counts[2] = sum(a == b for a, b in zip(hashes, hashes[1:], strict=False))
    norm = math.sqrt(sum(math.log1p(c) ** 2 for c in counts.values()))
    return {0: 1.0, **{i: math.log1p(c) / norm for i, c in counts.items()}}


def test_quality_against_a_plain_fit(spark):
    texts = [(text or "").encode() for text in cases.odd_texts(6)] + [b"LOUD LOUD words!! -- here", b"%%% $$$ %%% | |"]
    labels = [len(text) % 2 for text in texts]
    expected = plain_ftrl([(plain_features(t), y) for t, y in zip(texts, labels, strict=True)],
                          quality.EPOCHS, quality.ALPHA, quality.BETA, quality.L1, quality.L2)
    weights = quality.fit([(*quality.features(t), y) for t, y in zip(texts, labels, strict=True)])
    assert {i: pytest.approx(w, abs=1e-9) for i, w in expected.items() if w} == dict(zip(np.flatnonzero(weights).tolist(), weights[weights != 0], strict=True))
    rows = spark.createDataFrame([(i, t.decode()) for i, t in enumerate(texts)], "doc_id int, text string")
    for row in quality.score(rows, weights).collect():
        margin = sum(expected.get(i, 0.0) * value for i, value in plain_features(texts[row.row.doc_id]).items())
        assert row.score == pytest.approx(1.0 / (1.0 + math.exp(-margin)), abs=1e-9)


def test_sample_has_one_row_per_id(spark):
    texts = [(i, f"t{i}") for i in range(50)] + [(3, f"other {i % 9}") for i in range(400)] + [(4, None)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id long, toxic int")
    found = [sorted(labelled.sample(rows, labels, "toxic", 50, 99, 40).collect()) for rows in (docs, docs.repartition(7))]
    assert found[0] == found[1] and len(found[0]) == len({r.key for r in found[0]}) == 40
    assert all((r.key, r.text or None) in texts and r.label == r.key % 2 for r in found[0])


def test_a_lexicon_of_any_number_of_entries(spark):
    """More telling words, and more spared phrases, than any list was once cut to."""
    letters = "bcdfghjklmnprstvwz"
    words = [a + "u" + b + "o" + c for a in letters for b in letters for c in letters][:2400]
    plain = " ".join(f"{word[::-1]}plain" for word in words[:50])
    toxic, clean = " ".join(words), [plain + f" text {'q' * (i % 5)}" for i in range(90)]
    rows = [(str(i), toxic, 1) for i in range(4)] + [(str(10 + i), text, 0) for i, text in enumerate(clean)]
    lexicon = toxicity.learn(spark.createDataFrame(rows, "key string, text string, label int"))
    assert len(lexicon.entries) > 2000
    docs = spark.createDataFrame([(1, words[2399] + " " + words[2398]), (2, "text plain")], "doc_id int, text string")
    found = {r.row.doc_id: r.score for r in toxicity.score(docs, lexicon).collect()}
    assert found[1] > found[2]
