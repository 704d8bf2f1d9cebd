import random

import cases
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import suffix_dedup


def brute(texts, length):
    seen = {}
    for text in texts:
        for s in range(len(text) - length + 1):
            seen[text[s:s + length]] = seen.get(text[s:s + length], 0) + 1
    out = []
    for text in texts:
        runs = []
        for s in range(len(text) - length + 1):
            if seen[text[s:s + length]] > 1:
                if runs and s <= runs[-1][1]:
                    runs[-1][1] = s + length
                else:
                    runs.append([s, s + length])
        out.append([tuple(run) for run in runs])
    return out


def check(spark, texts, length, limit):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    rows = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs, length, limit=limit).select("row.doc_id", "n_bytes", "spans", "kept").collect()}
    raw = [(t or "").encode() for t in texts]
    expected = brute(raw, length)
    for i, (text, runs) in enumerate(zip(raw, expected, strict=True)):
        assert rows[i].n_bytes == len(text)
        assert [tuple(s) for s in rows[i].spans] == runs, i
        assert bytes(rows[i].kept) == b"".join(text[a:b] for a, b in zip([0, *[e for _, e in runs]], [*[s for s, _ in runs], len(text)], strict=True))
    return sum(map(len, expected))


@pytest.mark.parametrize("limit", [1, 8192])
@pytest.mark.parametrize("length", [40, 60])
def test_pasted_passages_against_brute_force(spark, length, limit):
    random.seed(length)

    def noise(n, letters="abcdefgh é"):
        return "".join(random.choice(letters) for _ in range(n))

    passages = [noise(n) for n in (30, 39, 45, 61, 90, 200)]
    texts = [None, "", "short", noise(length - 1), "a" * 500, "a" * 300, "ab" * 200, "b" + "a" * 200, noise(700, "ab"), noise(700, "ab")]
    for _ in range(60):
        texts.append("".join(random.choice([noise(random.randint(0, 80)), random.choice(passages)]) for _ in range(random.randint(1, 6))))
    near = noise(400)
    texts += [near[:k] + "#" + near[k + 1:] for k in range(0, 400, 23)] + [texts[20]] * 3
    assert check(spark, texts, length, limit) > 50


def test_odd_documents(spark):
    assert check(spark, cases.odd_texts(), 400, 8192) > 10


def test_other_columns_and_repeated_rows(spark):
    docs = cases.documents(spark)
    found = suffix_dedup.remove_repeats(docs)
    assert found.count() == docs.count()
    assert found.select("row.*").columns == [c for c in docs.columns if c != "text"]
    assert suffix_dedup.remove_repeats(cases.empty(spark)).collect() == []


def test_second_hash_is_the_built_in_one(spark):
    values = [0, 1, -1, 2 ** 62, -(2 ** 63), 123456789]
    built_in = [r[0] for r in spark.createDataFrame([(v,) for v in values], "v long").select(F.xxhash64("v")).collect()]
    assert suffix_dedup._second_hash(np.array(values, np.int64).view(np.uint64)).view(np.int64).tolist() == built_in


def test_maximal_repeats_list_all_occurrences():
    # Three texts share "MIDDLE" with the same 4 bytes before; two of them share more on the right.
    after = sorted([b"MIDDLEaaXX", b"MIDDLEaaYY", b"MIDDLEbbZZ"])
    before = [b"wxyzQ", b"wxyzR", b"wxyzS"]
    found = {(tuple(sorted(m.tolist())), left, right) for m, left, right in suffix_dedup.maximal_repeats(before, after, 10)}
    assert found == {((0, 1, 2), 4, 6), ((0, 1), 4, 8)}


def test_anchors_do_not_depend_on_the_chunk(monkeypatch):
    text = np.random.default_rng(5).integers(0, 4, 30_000).astype(np.uint8).tobytes()
    whole = suffix_dedup.anchors(text, 100)
    monkeypatch.setattr(suffix_dedup, "CHUNK", 1000)
    parts = suffix_dedup.anchors(text, 100)
    assert whole[0].tolist() == parts[0].tolist() and whole[1].tolist() == parts[1].tolist()


@pytest.mark.parametrize("limit", [2, 8192])
def test_one_text_in_a_third_of_the_rows(spark, limit):
    random.seed(9)
    hot = "".join(random.choice("abcdefgh ") for _ in range(300))
    others = ["".join(random.choice("abcdefgh ") for _ in range(120)) + (hot[50:150] if i % 5 == 0 else "") for i in range(60)]
    assert check(spark, [hot] * 30 + others, 60, limit) >= 42
