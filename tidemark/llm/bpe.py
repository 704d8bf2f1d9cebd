"""Byte-level BPE encoding and decoding over documents.

Two tiers resolve a pre-token. A minimal perfect hash over the vocabulary's byte strings answers for whole
pre-tokens that are tokens themselves; every other one is merged by a heap of ranked neighbours over a
doubly linked list of its bytes. Both tiers are small arrays which the driver builds from the rank file and
broadcasts; their size is the vocabulary's, whatever the input.

Null text counts as empty and gives no tokens. Rows are independent: repeated rows give repeated results,
an empty table an empty one. Kept columns travel in one struct, so their names cannot clash.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Sequence
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import per_batch

# The white space of the splitting engine, spelled out: Python's own class also holds U+001C to U+001F.
WHITE_SPACE = r"\t-\r \x85\xa0  -     　"
MEMO = 1_000_000  # pre-tokens a worker process remembers
LONG = 64  # longer pre-tokens are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 and rank. ``path`` is a file on the driver."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def splitting_pattern(pattern: str) -> str:
    return pattern.replace(r"[^\s", f"[^{WHITE_SPACE}").replace(r"(?!\S)", f"(?![^{WHITE_SPACE}])").replace(r"\s", f"[{WHITE_SPACE}]")


class PerfectHash:
    """A minimal perfect hash by displacement: n keys, n slots, one 32-bit displacement per bucket.

    Buckets are placed from the largest down: a bucket's displacement is the first seed that sends all its
    keys to free slots. Buckets of one key name their slot directly (as a negative number).
    """

    def __init__(self, keys: Sequence[bytes]):
        n = len(keys)
        self.table = [0] * n
        self.keys: list[bytes | None] = [None] * n
        buckets: dict[int, list[bytes]] = {}
        for key in keys:
            buckets.setdefault(xxhash.xxh64_intdigest(key, 0) % n, []).append(key)
        alone = []
        for bucket, members in sorted(buckets.items(), key=lambda item: -len(item[1])):
            if len(members) == 1:
                alone.append((bucket, members[0]))
                continue
            seed = 1
            while True:
                slots = [xxhash.xxh64_intdigest(key, seed) % n for key in members]
                if len(set(slots)) == len(slots) and all(self.keys[slot] is None for slot in slots):
                    break
                seed += 1
            self.table[bucket] = seed
            for slot, key in zip(slots, members, strict=True):
                self.keys[slot] = key
        free = (slot for slot, key in enumerate(self.keys) if key is None)
        for (bucket, key), slot in zip(alone, free, strict=False):
            self.table[bucket] = -slot - 1
            self.keys[slot] = key

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1 for a string that is not one of the keys."""
        n = len(self.keys)
        if not n:
            return -1
        seed = self.table[xxhash.xxh64_intdigest(key, 0) % n]
        slot = -seed - 1 if seed < 0 else xxhash.xxh64_intdigest(key, seed) % n
        return slot if self.keys[slot] == key else -1


class Vocabulary:
    """What a task needs to encode: the perfect hash, ranks by slot, ranks of merges."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.whole = PerfectHash(list(ranks))
        self.rank_of_slot = [ranks[key] for key in self.whole.keys]

    def plain(self) -> dict:
        """The same as built-in types, for a broadcast."""
        return {"ranks": self.ranks, "table": self.whole.table, "keys": self.whole.keys}

    @classmethod
    def of(cls, plain: dict) -> Vocabulary:
        own = cls({})
        own.ranks, own.whole.table, own.whole.keys = plain["ranks"], plain["table"], plain["keys"]
        own.rank_of_slot = [own.ranks[key] for key in own.whole.keys]
        return own

    def encode_piece(self, piece: bytes) -> list[int]:
        slot = self.whole.slot(piece)
        return [self.rank_of_slot[slot]] if slot >= 0 else self.merge(piece)

    def merge(self, piece: bytes) -> list[int]:
        """Merge the neighbours of lowest rank, leftmost first, until no two neighbours form a token."""
        rank_of, n = self.ranks.get, len(piece)
        parts = [piece[i:i + 1] for i in range(n)]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = [rank_of(piece[i:i + 2]) for i in range(n - 1)] + [None]  # rank of a part joined to the next one
        heap = [rank * n + i for i, rank in enumerate(pair) if rank is not None]  # rank, then place, as one number
        heapify(heap)
        while heap:
            rank, i = divmod(heappop(heap), n)
            if pair[i] != rank:  # merged away, or one of the two has grown
                continue
            j = after[i]
            parts[i] += parts[j]
            pair[i] = pair[j] = None
            after[i] = k = after[j]
            if k < n:
                before[k] = i
                pair[i] = rank = rank_of(parts[i] + parts[k])
                if rank is not None:
                    heappush(heap, rank * n + i)
            h = before[i]
            if h >= 0:
                pair[h] = rank = rank_of(parts[h] + parts[i])
                if rank is not None:
                    heappush(heap, rank * n + h)
        ids, i = [], 0
        while i < n:
            ids.append(rank_of(parts[i]))
            i = after[i]
        return ids


class Memo(dict):
    """Pre-token to packed ids. What is asked for again outlives a full generation; long pre-tokens are not kept."""

    def __init__(self, vocabulary: Vocabulary, size: int = MEMO):
        self.ids_of, self.size, self.old = vocabulary.encode_piece, size // 2, {}

    def __missing__(self, piece: str) -> bytes:
        packed = self.old.get(piece)
        if packed is None:
            packed = np.array(self.ids_of(piece.encode()), np.int32).tobytes()
            if len(piece) > LONG:
                return packed
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[piece] = packed
        return packed


def encoder(vocabulary: Vocabulary, pattern: str, memo: Memo | None = None) -> Callable[[str], bytes]:
    """Text to its ids as packed 32-bit integers."""
    split, known = regex.compile(splitting_pattern(pattern)).findall, (Memo(vocabulary) if memo is None else memo).__getitem__

    def encode(text: str) -> bytes:
        return b"".join(map(known, split(text)))

    return encode


class Pieces:
    """The bytes of every id in one array, so that decoding is a gather."""

    def __init__(self, ranks: dict[bytes, int]):
        pieces: list[bytes | None] = [None] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            pieces[rank] = token
        self.pieces = pa.array(pieces, pa.binary())

    def decode(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of each list of ids. An id that is none of the vocabulary's is an error."""
        ends = ids.offsets.to_numpy()
        found = self.pieces.take(ids.values[ends[0]:ends[-1]])
        if found.null_count:
            raise ValueError("an id is not in the vocabulary")
        # The gathered pieces lie behind one another: only the borders between texts are needed.
        _, borders, data = found.buffers()
        borders = np.frombuffer(borders, np.int32, len(found) + 1, found.offset * 4) if borders else np.zeros(1, np.int32)
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(borders[ends - ends[0]].astype(np.int32)), data or pa.py_buffer(b"")])


def _held(shared: dict, name: str, make: Callable[[], object]) -> object:
    """Kept beside a broadcast value, so that the tasks of a worker process share it."""
    if name not in shared:
        shared[name] = make()
    return shared[name]


def _encoded(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str, keep: Sequence[str], decoded: bool) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.plain())
    row, body = F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text")
    frame = docs.select(row, body)
    schema = T.StructType([frame.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    if decoded:
        schema = schema.add("decoded", T.BinaryType())

    def make():
        own = _held(shared.value, "vocabulary", lambda: Vocabulary.of(shared.value))
        to_ids = encoder(own, pattern, _held(shared.value, "memo", lambda: Memo(own)))
        pieces = _held(shared.value, "pieces", lambda: Pieces(shared.value["ranks"]))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            packed = [to_ids(value.as_py()) for value in batch.column(1)]
            ends = np.cumsum([0] + [len(ids) // 4 for ids in packed])
            values = np.frombuffer(b"".join(packed), np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0), ids, *([pieces.decode(ids)] if decoded else [])], schema.names)

        return each

    return per_batch(frame, schema, make)


def encode(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(row, ids): the ``keep`` columns of each row, and the token ids of its whole text."""
    return _encoded(docs, vocabulary, pattern, text, keep, decoded=False)


def round_trip(docs: DataFrame, vocabulary: Vocabulary, pattern: str, text: str = "text", keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(row, ids, decoded): what ``decode`` makes of ``encode``, without a second way through Python."""
    return _encoded(docs, vocabulary, pattern, text, keep, decoded=True)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """The rows of ``encode`` with ``decoded binary``, the bytes their ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary.plain())
    frame = encoded.select("row", "ids")
    schema = T.StructType([*frame.schema.fields, T.StructField("decoded", T.BinaryType())])

    def make():
        pieces = _held(shared.value, "pieces", lambda: Pieces(shared.value["ranks"]))

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([*batch.columns, pieces.decode(batch.column(1))], schema.names)

        return each

    return per_batch(frame, schema, make)


def digests(decoded: DataFrame, ids: bool = False) -> DataFrame:
    """The kept columns, the token ids if wanted, their number and digest, and the digest of the decoded bytes."""
    return decoded.select(
        "row.*", *(["ids"] if ids else []),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
