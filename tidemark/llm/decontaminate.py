"""Documents that hold passages of benchmark items, as a prefix-filtered set join.

An item's windows are its runs of ``window`` words (an item of fewer words is one window). A window that occurs
whole needs all its words, so under an order of words by rarity one prefix word, its rarest, is enough to find
candidates. Words are counted over all documents; a window with a word that no document has is dropped at
once. Neighbouring windows mostly share their rarest word at one place, an anchor, and are joined as one
row. The offset of the anchor in the window and the length of window and document bound where the window may stand (no
room, no candidate); whole windows are then compared word by word.

Only built-in expressions are used. The documents' words are exploded next to a semi join with the anchors' words,
so only rows with an anchor word, with the few words around it, are ever shuffled. Results come back by a 128-bit key
of the text; equal texts share one result, and their group is reduced before it is shuffled.

Null or empty text has no words. A null item text has no windows; an item with a null id marks words but is not
listed. Repeated items are one item, repeated rows are each returned. Empty tables give no hits, or no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import ascii_lower, stored, text_key

BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"  # what separates words once A-Z are lower-cased


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(ascii_lower(F.coalesce(text.cast("string"), F.lit(""))), BETWEEN), "")


def anchors(items: DataFrame, docs: DataFrame, window: int, key: str, item_text: str, text: str) -> DataFrame:
    """(word, at, starts, size, words, ids): per item text and place of a rarest word, the windows it stands for."""
    split = items.select(F.col(key).alias("id"), words_of(F.col(item_text)).alias("words")).filter(F.size("words") > 0)
    texts = stored(split.groupBy("words").agg(F.collect_set("id").alias("ids")).withColumn("item", text_key(F.array_join("words", " "))), "items")
    places = texts.select("item", F.size("words").alias("n"), F.posexplode("words").alias("at", "word")).withColumn("size", F.least("n", F.lit(window)))
    vocabulary = stored(places.select("word").distinct(), "item-words")
    counts = docs.select(F.explode(words_of(F.col(text))).alias("word")).join(vocabulary, "word", "left_semi").groupBy("word").agg(F.count("*").alias("seen"))
    ranked = places.join(counts, "word", "left").withColumn("rank", F.struct(F.coalesce("seen", F.lit(0)).alias("seen"), "word", "at"))
    spread = ranked.withColumn("start", F.explode(F.sequence(F.greatest(F.lit(0), F.col("at") - F.col("size") + 1), F.least(F.col("at"), F.col("n") - F.col("size")))))
    rarest = spread.groupBy("item", "size", "start").agg(F.min("rank").alias("rarest")).filter("rarest.seen > 0")
    grouped = rarest.groupBy("item", "size", F.col("rarest.word").alias("word"), F.col("rarest.at").alias("at")).agg(F.sort_array(F.collect_list("start")).alias("starts"))
    return stored(grouped.join(texts, "item").select("word", "at", "starts", "size", "words", "ids"), "anchors")


def hits(docs: DataFrame, found: DataFrame, window: int, text: str) -> DataFrame:
    """(k, spans, ids): by key of the text, the word spans [begin, end) of its windows and the items they are from."""
    split = docs.select(text_key(F.col(text).cast("string")).alias("k"), words_of(F.col(text)).alias("own"))
    places = split.select("k", "own", F.posexplode("own").alias("pos", "word")).join(stored(found.select("word").distinct(), "anchor-words"), "word", "left_semi")
    # The anchor and up to window - 1 words on either side; ``before`` is the number of those on its left.
    before = F.least(F.col("pos"), F.lit(window - 1))
    near = places.select("k", "word", "pos", before.alias("before"), F.slice("own", F.col("pos") - before + 1, before + window).alias("near"))
    rows = near.join(found, "word")

    def stands(start: Column) -> Column:
        left = F.col("at") - start
        first = F.col("before") - left  # of the window, in ``near``
        fits = (first >= 0) & (first + F.col("size") <= F.size("near"))
        return fits & (F.slice("near", F.greatest(first, F.lit(0)) + 1, F.col("size")) == F.slice("words", start + 1, F.col("size")))

    def span(start: Column) -> Column:
        begin = F.col("pos") - F.col("at") + start
        return F.struct(begin.alias("begin"), (begin + F.col("size")).alias("end"))

    true = rows.select("k", "pos", "at", "size", "ids", F.filter("starts", stands).alias("starts")).filter(F.size("starts") > 0)
    true = true.select("k", "ids", F.transform("starts", span).alias("spans"))
    return true.groupBy("k").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("spans")))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_set("ids"))).alias("ids"),
    )


def covered(spans: Column) -> Column:
    """The number of words in the union of spans sorted by their beginning."""
    def add(state: Column, span: Column) -> Column:
        fresh = F.greatest(F.lit(0), span["end"] - F.greatest(state["end"], span["begin"]))
        return F.struct(F.greatest(state["end"], span["end"]).alias("end"), (state["n"] + fresh).alias("n"))

    return F.aggregate(spans, F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")), add, lambda state: state["n"])


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, key: str = "item_id", item_text: str = "text", text: str = "text", keep: Sequence[str] | None = None) -> DataFrame:
    """(row, n_words, n_hit, ids, spans) per document: ``row`` holds the ``keep`` columns (all but the text)."""
    keep = [name for name in docs.columns if name != text] if keep is None else keep
    found = stored(hits(docs, anchors(items, docs, window, key, item_text, text), window, text), "hits")
    own = docs.select(
        F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"), text_key(F.col(text).cast("string")).alias("k"),
        F.size(words_of(F.col(text))).cast("long").alias("n_words"),
    )
    return own.join(found, "k", "left").select(
        "row", "n_words",
        F.coalesce(covered(F.col("spans")), F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce(F.array_sort(F.transform("ids", lambda i: i.cast("string"))), F.array().cast("array<string>")).alias("ids"),
        "spans",
    )
