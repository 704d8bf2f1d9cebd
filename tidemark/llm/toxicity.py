"""Toxicity scores from a weighted lexicon, matched by an Aho-Corasick automaton over folded text.

Folding lower-cases, replaces look-alike letters of other scripts, reads digits and signs inside words as the letters
they stand for, and puts one space between words. At a word's edge they count where no letter or digit follows or precedes;
a closing ``$`` or ``@`` may be mere punctuation, so the word is tried without it and, if nothing matches, with it as a
letter. 2, 6, 8, 9 and ``|`` are read as no letter. An entry is a word (`` word ``) or a word stem (`` stem``), so matches start
at a word. Exception phrases are matched by the same automaton: entries inside one do not count. The weights found are
added up and divided by a slowly growing measure of the text's length; a logistic curve turns that into a score.

The lexicon is learned from a bounded sample of labelled documents (``ROWS`` ids): words and stems are counted per
class by Spark, those that a likelihood-ratio test singles out are kept, and phrases that
hold an entry yet occur only in harmless texts become exceptions. Scoring is a projection over whole texts.

Null and empty texts hold nothing and get the lowest score. Repeated rows get equal scores, an empty table no rows. Where
nothing can be learned (no labelled row, labels of one class, no telling term) the lexicon is empty and all scores are
equal and below one half: that nothing matched is no evidence of toxicity.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Sequence
from itertools import accumulate
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import per_batch, stored

ROWS = 8000  # labelled ids the lexicon is learned from, at most
STEMS = range(3, 9)  # lengths of word stems
HELD = 100_000  # terms a task counts before it hands them on
LEAST = 4  # toxic documents an entry must occur in
UNMATCHED = -math.log(3.0)  # highest margin of an empty lexicon, a score of 0.25

# Letters of other scripts that look like Latin ones, and what digits and signs stand for.
LOOKALIKES = str.maketrans({
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "ѕ": "s", "і": "i", "ј": "j", "ԁ": "d", "ԛ": "q", "ԝ": "w", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o",
    "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɡ": "g", "ⅼ": "l",
})
SIGNS = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
SIGN = re.compile(r"(?<=[^\W\d_])[013457@$!]+(?=[^\W\d_])|(?<![^\W_])[013457@$]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+(?![^\W_])")
CLOSED = re.compile(r"([^\W\d_]+)([@$]*)(?![^\W_])|[^\W\d_]+")
WORD = re.compile(r"[^\W\d_]+")


class Lexicon(NamedTuple):
    entries: dict[str, float]
    exceptions: list[str]
    slope: float
    intercept: float


def _signs_read(text: str) -> str:
    text = text.lower()
    if not text.isascii():
        text = text.translate(LOOKALIKES)
    return SIGN.sub(lambda found: found[0].translate(SIGNS), text)


def fold(text: str) -> list[str]:
    """The folded words of a text."""
    return WORD.findall(_signs_read(text))


def readings(text: str) -> tuple[list[str], list[tuple[int, str]]]:
    """The folded words, and for those closed by signs their place and the word with the signs as letters."""
    text = _signs_read(text)
    if "$" not in text and "@" not in text:
        return WORD.findall(text), []
    found = list(CLOSED.finditer(text))
    others = [(i, (one[1] + one[2]).translate(SIGNS)) for i, one in enumerate(found) if one[2]]
    return [one[1] or one[0] for one in found], others


def automaton(entries: dict[str, float], exceptions: list[str]):
    """None if there is nothing to match."""
    built = ahocorasick.Automaton()
    for phrase in exceptions:
        built.add_word(phrase, (len(phrase), None))
    for entry, weight in entries.items():
        built.add_word(entry, (len(entry), weight))
    if not len(built):
        return None
    built.make_automaton()
    return built


def _hits(words: list[str], built) -> tuple[set[int], list[tuple[int, float]]]:
    """Where entries start in the joined words, and those outside exception phrases with their weights."""
    hits, spared = [], []
    for end, (size, weight) in built.iter(f" {' '.join(words)} "):
        (spared if weight is None else hits).append((end - size + 1, end, weight))
    starts = {hit[0] for hit in hits}
    if spared:
        hits = [hit for hit in hits if not any(a <= hit[0] and hit[1] <= b for a, b, _ in spared)]
    return starts, [(start, weight) for start, _, weight in hits]


def weigh(words: list[str], built, others: Sequence[tuple[int, str]] = ()) -> float:
    """The weights of the entries outside exception phrases, by length. Where a word matches nothing, its other reading may."""
    if built is None or not words:
        return 0.0
    starts, hits = _hits(words, built)
    total = sum(weight for _, weight in hits)
    if others:
        places = list(accumulate((len(word) + 1 for word in words), initial=0))
        for i, other in others:
            if places[i] not in starts:
                before = words[max(i - 1, 0):i]
                at = sum(len(word) + 1 for word in before)
                total += sum(weight for start, weight in _hits([*before, other, *words[i + 1:i + 2]], built)[1] if start == at)
    return total / (1.0 + math.log1p(len(words) / 100.0))


def terms(words: set[str]) -> set[str]:
    """What might become an entry: each word, and its stems."""
    found = {f" {word} " for word in words if len(word) >= min(STEMS)}
    found.update(f" {word[:size]}" for word in words for size in STEMS if size <= len(word))
    return found


def _counted(sample: DataFrame, of) -> DataFrame:
    """(term, toxic, clean): documents of each class in which ``of(folded words)`` holds the term."""
    def run(batches):
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label in zip(batch.column(0), batch.column(1), strict=True):
                counts[label.as_py() > 0].update(of(fold(text.as_py())))
                if len(counts[0]) + len(counts[1]) > HELD:  # what a task holds; Spark adds the parts up
                    yield packed(*counts)
                    counts = (Counter(), Counter())
        yield packed(*counts)

    def packed(clean, toxic):
        found = list(clean.keys() | toxic.keys())
        sides = [pa.array([side[term] for term in found], pa.int64()) for side in (toxic, clean)]
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), *sides], ["term", "toxic", "clean"])

    counted = sample.select("text", "label").mapInArrow(run, "term string, toxic long, clean long")
    return counted.groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def _evidence(rate: float) -> Column:
    """Twice the gain in log-likelihood of a term's own rate over the common one, of its rows ``toxic`` and ``clean``."""
    n = F.col("toxic") + F.col("clean")
    own = sum((F.when(F.col(k) > 0, F.col(k) * F.ln(F.col(k) / n)).otherwise(0.0) for k in ("toxic", "clean")), F.lit(0.0))
    return 2.0 * (own - F.col("toxic") * math.log(rate) - F.col("clean") * math.log(1.0 - rate))


def choose(counted: list[tuple[str, int, int, float]], rate: float) -> dict[str, float]:
    """Entries and weights of (term, toxic, clean, evidence). Of a word and its stems only the most telling is kept, the longest if equal."""
    ranked = [(-evidence, -len(term), term, math.log((toxic + 0.5) / (clean + 0.5) * (1.0 - rate) / rate))
              for term, toxic, clean, evidence in counted]
    chosen: dict[str, float] = {}
    related: set[str] = set()  # chosen terms and all their beginnings
    for _, _, term, weight in sorted(ranked):
        beginnings = [term[:size] for size in range(2, len(term) + 1)]
        if term in related or any(part in chosen for part in beginnings) or term.rstrip() in chosen:
            continue
        chosen[term] = weight
        related.update(beginnings)
    return chosen


def _empty(n_toxic: int, n_clean: int) -> Lexicon:
    """A lexicon that matches nothing, so that its score says at most the share of toxic rows, and never toxic."""
    return Lexicon({}, [], 1.0, min(math.log((n_toxic + 0.5) / (n_clean + 0.5)), UNMATCHED))


def learn(sample: DataFrame) -> Lexicon:
    """A lexicon from rows (key, text, label), which the caller has bounded."""
    sample = stored(sample.select("text", "label"), "toxicity-sample")
    sizes = dict(sample.groupBy((F.col("label") > 0).alias("toxic")).count().collect())
    n_toxic, n_clean = sizes.get(True, 0), sizes.get(False, 0)
    if not n_toxic or not n_clean:
        return _empty(n_toxic, n_clean)
    rate = n_toxic / (n_toxic + n_clean)
    counted = stored(_counted(sample, lambda words: terms(set(words))), "toxicity-terms")
    telling = counted.filter((F.col("toxic") >= LEAST) & (F.col("toxic") > 2 * F.col("clean")))
    # More evidence than the best of so many terms would show by chance: the bar rises with the terms, and no number is cut off.
    distinct = counted.filter((F.col("toxic") + F.col("clean")) >= LEAST).count()
    best = telling.withColumn("evidence", _evidence(rate)).filter(F.col("evidence") > 2.0 * math.log(max(distinct, 2))).collect()
    entries = choose([tuple(row) for row in best], rate)
    if not entries:
        return _empty(n_toxic, n_clean)
    matcher = {"entries": entries}

    def phrases(words: list[str]) -> set[str]:
        """Each match with the word before or after it."""
        built = matcher.get("built") or matcher.setdefault("built", automaton(matcher["entries"], []))
        if built is None:
            return set()
        hit = [any(True for _ in built.iter(f" {word} ")) for word in words]
        return {f" {a} {b} " for a, b, h, k in zip(words, words[1:], hit, hit[1:], strict=False) if h or k}

    spared = _counted(sample, phrases).filter((F.col("toxic") == 0) & (F.col("clean") >= LEAST))
    exceptions = sorted(row.term for row in spared.collect())
    weighed = _weighed(sample, entries, exceptions).collect()
    slope, intercept = _curve(np.array([row.weight for row in weighed]), np.array([float(row.label > 0) for row in weighed]))
    return Lexicon(entries, exceptions, slope, intercept)


def _weighed(sample: DataFrame, entries: dict[str, float], exceptions: list[str]) -> DataFrame:
    def make():
        built = automaton(entries, exceptions)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = []
            for text in batch.column(0):
                words, others = readings(text.as_py())
                found.append(weigh(words, built, others))
            return pa.RecordBatch.from_arrays([pa.array(found, pa.float64()), batch.column(1)], ["weight", "label"])

        return each

    return per_batch(sample.select("text", "label"), "weight double, label int", make)


def _curve(weights: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a regularised logistic curve, by Newton's steps, over log(1 + weight)."""
    x = np.stack([np.log1p(weights), np.ones_like(weights)], axis=1)
    at = np.zeros(2)
    penalty = np.diag([0.05, 1e-4])
    for _ in range(40):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - labels) + penalty @ at
        at = at - np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + penalty, slope)
    return float(at[0]), float(at[1])


def score(docs: DataFrame, lexicon: Lexicon, text: str = "text") -> DataFrame:
    """(row, score): each whole row as one struct, and the probability of being toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(tuple(lexicon))
    frame = docs.select(F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"))
    schema = T.StructType([frame.schema["row"], T.StructField("score", T.DoubleType())])
    at = docs.columns.index(text)

    def make():
        entries, exceptions, slope, intercept = shared.value
        built = automaton(entries, exceptions)

        def each(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch.column(0).field(at)
            read = (readings(text.as_py() or "") for text in texts)
            margins = np.array([slope * math.log1p(weigh(words, built, others)) + intercept for words, others in read])
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-np.clip(margins, -30, 30))))], ["row", "score"])

        return each

    return per_batch(frame, schema, make)
