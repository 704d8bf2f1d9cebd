import hashlib

import cases
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from tidemark.llm import bpe

RANKS = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(RANKS)


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def test_perfect_hash_is_minimal_and_exact(vocabulary):
    slots = [vocabulary.whole.slot(key) for key in RANKS]
    assert sorted(slots) == list(range(len(RANKS)))
    assert all(vocabulary.whole.slot(key + b"\xff\xfe!") == -1 for key in list(RANKS)[:2000])
    assert bpe.PerfectHash([]).slot(b"a") == -1


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_library(text):
    vocabulary, library = _both()
    import numpy as np

    assert np.frombuffer(bpe.encoder(vocabulary, public_tokenizers.PATTERN)(text), np.int32).tolist() == library.encode_ordinary(text)


def _both(made=[]):  # noqa: B006
    if not made:
        made += [bpe.Vocabulary(RANKS), tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})]
    return made


def test_white_space_of_every_kind(vocabulary, library):
    encode = bpe.encoder(vocabulary, public_tokenizers.PATTERN)
    for code in [*range(0x100), 0x1680, 0x180E, *range(0x2000, 0x2010), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]:
        for text in (chr(code), f"a{chr(code)}b", f"a {chr(code)} b{chr(code) * 2}", f"{chr(code)}'s 12"):
            ids = encode(text)
            assert [int.from_bytes(ids[i:i + 4], "little") for i in range(0, len(ids), 4)] == library.encode_ordinary(text), hex(code)


def test_documents_round_trip(spark, vocabulary, library):
    docs = cases.documents(spark, [*cases.odd_texts(), "q" * 20_000, "<|endoftext|>"])
    found = bpe.digests(bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN), vocabulary)).collect()
    expected = []
    for row in docs.collect():
        ids = library.encode_ordinary(row.text or "")
        expected.append((row.doc_id, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row.text or "").encode()).hexdigest()))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_empty_table(spark, vocabulary):
    assert bpe.digests(bpe.decode(bpe.encode(cases.empty(spark), vocabulary, public_tokenizers.PATTERN), vocabulary)).collect() == []


def test_one_pass_equals_two(spark, vocabulary):
    """Kept columns may have the names of the results; extra ones are not kept."""
    docs = cases.documents(spark).withColumnRenamed("k", "ids").withColumnRenamed("fp", "decoded")
    keep = ("doc_id", "ids", "decoded")
    once = bpe.round_trip(docs, vocabulary, public_tokenizers.PATTERN, keep=keep).collect()
    twice = bpe.decode(bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, keep=keep), vocabulary).collect()
    assert sorted(map(str, once)) == sorted(map(str, twice))
    assert {(r.row.ids, r.row.decoded) for r in once} == {(2, 1)}


def test_a_full_memo_keeps_what_is_asked_for_again(vocabulary, library):
    memo = bpe.Memo(vocabulary, 20)
    encode = bpe.encoder(vocabulary, public_tokenizers.PATTERN, memo)
    for i in range(300):
        text = f"again word{i} zq{i}x {'long' * 40}"
        assert [*memoryview(encode(text)).cast("i")] == library.encode_ordinary(text)
        assert len(memo) <= 10 and len(memo.old) <= 10
    assert "again" in memo or "again" in memo.old
    assert not any(len(piece) > bpe.LONG for piece in memo)


def test_an_unknown_id_is_an_error(vocabulary):
    import pyarrow as pa

    pieces = bpe.Pieces({b"a": 0, b"bc": 2})
    assert pieces.decode(pa.array([[0, 2], [], [2]], pa.list_(pa.int32())).slice(1)).to_pylist() == [b"", b"bc"]
    with pytest.raises(ValueError):
        pieces.decode(pa.array([[1]], pa.list_(pa.int32())))
