"""Spelling variants: the words of a corpus that differ by one code point, each led to the commonest of them.

Words are counted over all documents. Two words are near if one inserted, deleted or replaced code point turns one into the
other. Of two near words at least one half of each stands unchanged in the other, at the same end, so the vocabulary is
dealt twice, by its first and by its last code points (as many as the shortest half has). What is dealt together is
indexed in pieces, and every word is searched in its piece by a search scheme: its half must match exactly, and
is then extended over the other half with exactly one error.

A piece's index is an FM-index over its words joined by delimiters. Words of the first deal are held reversed and those of the
second as they are, so that a backward step reads on to the right in the one and to the left in the other: both
directions of a bidirectional index, each kept where its scheme runs. A search is an interval of suffix ranks; a step
narrows the intervals of all words of the piece at once. Delimiters are ranked by the word they precede, so the
interval left at the end numbers the words themselves.

Words dealt together that are more than ``GROUP`` go to pieces by hash: each part is indexed once per part that is
searched in it, so that no task holds more than two parts. Null text holds no words; a null id counts as empty text in a
word's hash; repeated rows count again; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import per_batch, stored, utf8

GROUP = 32_768  # words that share their dealt end and are indexed as one
PIECE = 32_768  # rows from which the next group starts a new piece


def count_words(docs: DataFrame, min_chars: int, min_count: int, slips: int, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n): runs of letters, of which one in ``slips`` (by the hash of id and run) lost a letter."""
    frame = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("key"), F.col(f"`{text}`").cast("string").alias("text"))

    def make():
        runs = re.compile(f"[a-zÀ-ÿ]{{{min_chars},}}").findall

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            total = Counter()
            for key, value in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
                seed = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs(value.lower().decode())).items():
                    h = zlib.crc32(word.encode(), seed)
                    if h % slips == 0:
                        gone = h % len(word)
                        word = word[:gone] + word[gone + 1:]
                        if len(word) < min_chars:
                            continue
                    total[word] += n
            return pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        return each

    counted = per_batch(frame, "word string, n long", make)
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


class FmIndex:
    """The suffix ranks of ``words`` (code points; matched from their first on), without the suffixes."""

    def __init__(self, words: list[str]):
        reverse = [word[::-1] for word in words]
        self.order = sorted(range(len(words)), key=reverse.__getitem__)
        text = "\0" + "\0".join(reverse[i] for i in self.order) + "\0"
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        self.letters, code = np.unique(points, return_inverse=True)
        n = self.n = len(code)
        ends = np.flatnonzero(code == 0)
        # Prefix doubling. Delimiters are told apart from the start: the last is the least, the others follow their words' order.
        rank = code + len(ends)
        rank[ends] = np.append(np.arange(1, len(ends)), 0)
        width = 1
        while True:
            pair = rank * (n + len(ends) + len(self.letters)) + np.append(rank[width:], np.zeros(min(width, n), np.int64))[:n]
            suffixes = np.argsort(pair, kind="stable")
            ordered = pair[suffixes]
            differs = np.append(False, ordered[1:] != ordered[:-1])
            rank = np.empty(n, np.int64)
            rank[suffixes] = np.cumsum(differs)
            if differs[1:].all():
                break
            width *= 2
        self.before = code[suffixes - 1]  # the letter before each suffix, by rank
        by_letter = np.argsort(self.before, kind="stable")
        self.occurs = self.before[by_letter] * (n + 1) + by_letter
        self.words = len(words)

    def codes(self, text: str) -> np.ndarray:
        """Letter numbers of ``text``; letters that no word holds have none (-1)."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.minimum(np.searchsorted(self.letters, points), len(self.letters) - 1)
        return np.where(self.letters[at] == points, at, -1)

    def step(self, letter: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The intervals [lo, hi) after one more letter."""
        lo, hi = (np.searchsorted(self.occurs, letter * (self.n + 1) + bound) for bound in (lo, hi))
        return lo, np.where(letter < 0, lo, hi)

    def branches(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(which, letter, lo, hi): all letters the intervals can go on with. Equal intervals are looked at once."""
        node, which = np.unique(lo * (self.n + 1) + hi, return_inverse=True)
        first, last = np.divmod(node, self.n + 1)
        size = last - first
        owner = np.repeat(np.arange(len(node)), size)
        within = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        edge = np.unique(owner * len(self.letters) + self.before[first[owner] + within])
        owner, letter = np.divmod(edge, len(self.letters))
        owner, letter = owner[letter > 0], letter[letter > 0]
        to_lo, to_hi = self.step(letter, first[owner], last[owner])
        begin = np.searchsorted(owner, np.arange(len(node) + 1))
        count = (begin[1:] - begin[:-1])[which]
        asked = np.repeat(np.arange(len(which)), count)
        edge = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + begin[which][asked]
        return asked, letter[edge], to_lo[edge], to_hi[edge]

    def near(self, queries: list[str], exact: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) numbers of all words one error away, the error beyond the first ``exact`` letters."""
        flat = np.append(self.codes("".join(queries)), 0)
        size, exact = np.array([len(q) for q in queries], np.int64), np.array(exact, np.int64)
        start = np.cumsum(size) - size
        query = np.arange(len(queries))  # without an error so far; all have read `at` letters
        lo, hi = np.zeros(len(query), np.int64), np.full(len(query), self.words + 1)
        erred = [np.zeros(0, np.int64)] * 4  # query, letters read, lo, hi
        found = [np.zeros((2, 0), np.int64)]
        at = 0
        while len(query) or len(erred[0]):
            # Those that have erred go one letter on; after the last one the delimiter must follow.
            q, read, e_lo, e_hi = erred
            done = read == size[q]
            e_lo, e_hi = self.step(np.where(done, 0, flat[np.minimum(start[q] + read, len(flat) - 1)]), e_lo, e_hi)
            ended = np.flatnonzero(done & (e_lo < e_hi))
            count = (e_hi - e_lo)[ended]
            words = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(e_lo[ended], count) - 1
            found.append(np.stack([np.repeat(q[ended], count), words]))
            going = ~done & (e_lo < e_hi)
            erred = [column[going] for column in (q, read + 1, e_lo, e_hi)]
            if len(query):
                more = at < size[query]
                here = np.where(more, flat[np.minimum(start[query] + at, len(flat) - 1)], -2)
                after = np.where(at + 1 < size[query], flat[np.minimum(start[query] + at + 1, len(flat) - 1)], -2)
                open_ = np.flatnonzero(at >= exact[query])
                asked, letter, b_lo, b_hi = self.branches(lo[open_], hi[open_])
                asked = open_[asked]
                other = letter != here[asked]  # a letter put before its like is the same as one put behind it
                asked, b_lo, b_hi = asked[other], b_lo[other], b_hi[other]
                replaced = more[asked]
                lacking = open_[more[open_] & (here[open_] != after[open_])]
                new = [
                    (query[asked], np.full(len(asked), at), b_lo, b_hi),  # the word has one letter more here
                    (query[asked[replaced]], np.full(replaced.sum(), at + 1), b_lo[replaced], b_hi[replaced]),
                    (query[lacking], np.full(len(lacking), at + 1), lo[lacking], hi[lacking]),
                ]
                erred = [np.concatenate(parts) for parts in zip(erred, *new, strict=True)]
                lo, hi = self.step(here, lo, hi)
                kept = more & (lo < hi)
                query, lo, hi = query[kept], lo[kept], hi[kept]
                at += 1
        query, word = np.unique(np.concatenate(found, axis=1), axis=1)
        return query, np.array(self.order, np.int64)[word]


def searched(dealt: Iterator[pa.RecordBatch], schema: list[str]) -> Iterator[pa.RecordBatch]:
    """The near words within each group of rows (side, route, a, b, word, n, role), sorted by group."""
    def piece(side: int, rows: list[tuple]) -> pa.RecordBatch:
        words = [(word if side == 0 else word[::-1], word, n, role) for word, n, role in rows]
        targets, queries = ([row for row in words if row[3] != role] for role in (1, 0))
        columns = [pa.array([], pa.string()), pa.array([], pa.int64())] * 2
        if targets and queries:
            exact = [len(q[0]) // 2 if side == 0 else (len(q[0]) + 1) // 2 for q in queries]
            query, near = FmIndex([row[0] for row in targets]).near([row[0] for row in queries], exact)
            columns = [pa.array([rows[i][field] for i in found.tolist()], kind) for rows, found in ((queries, query), (targets, near))
                       for field, kind in ((1, pa.string()), (2, pa.int64()))]
        return pa.RecordBatch.from_arrays(columns, schema)

    held, group, side = [], None, None
    for batch in dealt:
        columns = [column.to_pylist() for column in batch.columns]
        for s, route, a, b, word, n, role in zip(*columns, strict=True):
            if (s, route, a, b) != group:
                if held and (len(held) >= PIECE or s != side):
                    yield piece(side, held)
                    held = []
                group, side = (s, route, a, b), s
            held.append((word, n, role))
    if held:
        yield piece(side, held)


def near_words(words: DataFrame, min_chars: int, group: int | None = None) -> DataFrame:
    """(word, n, near, near_n): every ordered pair of near words of ``words`` (word, n), all of ``min_chars`` or more."""
    group, end = group or GROUP, min_chars // 2
    sides = F.array(F.struct(F.lit(0).alias("side"), F.left("word", F.lit(end)).alias("route")),
                    F.struct(F.lit(1).alias("side"), F.right("word", F.lit(end)).alias("route")))
    dealt = words.select("word", "n", F.explode(sides).alias("to")).select("to.*", "word", "n")
    large = dealt.groupBy("side", "route").count().filter(F.col("count") > group)
    parts = large.select("side", "route", F.ceil(F.col("count") / group).cast("int").alias("parts"))
    placed = dealt.join(stored(parts, "large-routes"), ["side", "route"], "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own, parts = F.pmod(F.xxhash64("word"), F.col("parts")).cast("int"), F.col("parts")
    # Role 0: indexed only, 1: searched only, 2: both. Part a is indexed and part b searched.
    other = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(own.alias("a"), i.alias("b"), F.when(i == own, 2).otherwise(0).alias("role")))
    asks = F.transform(F.sequence(F.lit(0), parts - 1), lambda i: F.struct(i.alias("a"), own.alias("b"), F.lit(1).alias("role")))
    roles = F.concat(other, F.filter(asks, lambda to: to["a"] != own))
    rows = placed.select("side", "route", "word", "n", F.explode(roles).alias("to")).select("side", "route", "to.a", "to.b", "word", "n", "to.role")
    names = ["word", "n", "near", "near_n"]
    together = rows.repartition("side", "route", "a", "b").sortWithinPartitions("side", "route", "a", "b")
    found = together.mapInArrow(lambda batches: searched(batches, names), "word string, n long, near string, near_n long")
    return found.repartition("word").dropDuplicates(["word", "near"])  # halves that both match report a pair twice


def roots(links: DataFrame) -> DataFrame:
    """(word, root): where following ``links`` (word, form) ends. Every round doubles the steps taken; links lead to larger
    counts only, so there is no circle."""
    reached = stored(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("word").alias("root"), F.col("root").alias("further"))
        longer = reached.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        longer = stored(longer, "roots")
        reached = longer.select("word", "root")
        if longer.filter("moved").isEmpty():
            return reached


def variants(docs: DataFrame, min_chars: int = 7, min_count: int = 2, ratio: int = 10, slips: int = 31,
             text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, form, root, n, n_near, form_n): a word's form is its commonest near word (ties: the first in code-point order), if that
    occurs at least ``ratio`` times as often; its root is where forms end, or the word itself."""
    words = stored(count_words(docs, min_chars, min_count, slips, text, key), "words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near"))).alias("best")
    near = near_words(words, min_chars).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    led = F.col("best.less") <= -ratio * F.col("n")
    near = stored(near.select("word", "n_near", F.when(led, F.col("best.near")).alias("form"), F.when(led, -F.col("best.less")).alias("form_n")), "near-words")
    ends = roots(near.filter("form IS NOT NULL"))
    return words.join(near, "word", "left").join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
