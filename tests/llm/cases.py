"""Documents with every odd case the operators promise to handle."""

import random

from pyspark.sql import types as T

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
    # Names that operators use inside.
    T.StructField("row", T.StringType()), T.StructField("fp", T.LongType()), T.StructField("k", T.IntegerType()),
    T.StructField("n_words", T.StringType()), T.StructField("score", T.StringType()), T.StructField("component", T.StringType()),
])


def odd_texts(seed: int = 1) -> list[str | None]:
    random.seed(seed)
    words = ["Alpha", "beta", "GAMMA", "délta", "Épsilon", "zeta", "eta9", "theta-x", "ι", "κappa", "the", "of"]

    def prose(n):
        return "".join(random.choice(words) + random.choice([" ", " ", " ", ", ", "\n", "\t", "  "]) for _ in range(n))

    shared = prose(90)
    texts = [None, "", "", " \t\n", "\n\n", "one", "one", "ONE", "a b c", "a b c d", "word " * 400, "x" * 3000, "ab" * 900]
    texts += [prose(random.randint(1, 160)) for _ in range(30)]
    texts += [shared] * 12 + [shared + " tail"] + ["head " + shared for _ in range(3)]
    texts += [prose(20) + shared + prose(20) for _ in range(8)]
    texts += [prose(6) + "\n  The SAME line \n" + prose(6) for _ in range(11)]
    texts += [prose(12_000)]  # very long beside the others
    return texts


def documents(spark, texts=None):
    texts = odd_texts() if texts is None else texts
    rows = [(None if i == 7 else i, text, "r", 1, 2, "w", "s", "c") for i, text in enumerate(texts)]
    rows += rows[20:22]  # repeated rows
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
