"""URL verdicts: host rules first, then a logistic regression on hashed character n-grams of host and path.

The regression is trained from a small labelled table (``MAX_LABELLED`` rows at most): whole-batch
gradient steps, each one aggregate over the labelled rows; only the gradient, one number per bucket,
comes to the driver. Judging is a projection over the URLs with the rules and weights as literals:
nothing is shuffled and only the URL column is read.

A null URL, or one without ``://``, has an empty host and path; it fits no rule and is judged by the
regression's intercept. Very long URLs are judged whole, in time linear in their length. Repeated rows are
each judged; an empty table gives no rows. Columns beside the key and the URL are not read.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import ascii_lower

BUCKETS = 4096
SIZES = (3, 4)
EPOCHS = 16
STEP = 1.0
MAX_LABELLED = 20_000

# A starting table of URLs to block (1) and to allow (0).
LABELLED = [
    ("http://www.casino-royal.test/en/1", 1), ("https://win-casino.test/slots/77", 1), ("http://online-poker.test/en/play.html", 1),
    ("https://free-bets.test/de/44", 1), ("http://best-bets.test/odds/9", 1), ("http://m.sport-betting.test/fr/31", 1),
    ("https://cheap-pills.test/buy/9", 1), ("http://pills-online.test/en/viagra.html", 1), ("https://no-prescription-meds.test/en/8", 1),
    ("http://adult-video.test/xxx/3", 1), ("https://www.adult-chat.test/fr/16", 1), ("http://xxx-live.test/cam/5", 1),
    ("https://ads-click.test/track?id=4", 1), ("http://m.track-ads.test/en/pixel.gif", 1), ("http://popup-ads.test/de/12", 1),
    ("http://spam-link.test/en/12", 1), ("https://link-farm.test/page/2", 1), ("https://www.seo-spam.test/es/farm/31", 1),
    ("https://payday-loans.test/apply/now", 1), ("http://fast-cash.test/en/win-money.html", 1), ("http://free-gift.test/claim/prize", 1),
    ("http://replica-watch.test/sale/1", 1), ("https://crypto-win.test/double/5", 1), ("http://torrent-crack.test/free-download", 1),
    ("http://lottery-prize.test/en/winner/6", 1), ("https://jackpot-slots.test/fr/2", 1), ("http://www.hot-dating.test/de/8", 1),
    ("https://www.library.test/en/catalogue/33", 0), ("http://history.test/de/archive/12", 0), ("https://news.test/fr/article/812.html", 0),
    ("http://blog.gardening.test/en/roses/3", 0), ("https://docs.project.test/guide/install", 0), ("https://university.test/en/courses/7", 0),
    ("http://www.museum.test/fr/collection/44", 0), ("https://m.weather.test/de/today", 0), ("http://recipes.test/es/soup/91.html", 0),
    ("https://science.test/en/physics/6", 0), ("http://music.test/en/concert/2", 0), ("https://wiki.test/en/Tree", 0),
    ("http://blog.travel.test/fr/paris/19", 0), ("https://forum.code.test/t/1841", 0), ("https://www.bakery.test/de/brot/5", 0),
    ("http://theatre.test/en/programme/11", 0), ("https://maps.test/es/city/8", 0), ("http://school.test/en/lessons/4/", 0),
    ("https://www.hospital.test/de/contact", 0), ("http://books.test/fr/author/16", 0), ("https://m.thenation.test/en/1048", 0),
    ("http://on.the.river.test/en/walks", 0), ("https://tration.test/en/3917", 0), ("http://www.retions.test/de/6652", 0),
    ("https://blog.inthand.test/fr/7424.html", 0), ("http://another.test/es/4163", 0),
    ("https://quiet.garden.test/en/1", 0), ("http://www.citycouncil.test/en/services/14", 0), ("https://photos.test/de/album/61", 0),
    ("https://observatory.test/stars/2", 0), ("http://m.railway.test/fr/timetable", 0), ("https://letters.test/en/1877/", 0),
    ("http://choir.test/es/9", 0), ("https://www.mathematics.test/en/proof/5", 0), ("https://river.test/en/1034.html", 0),
    ("http://bread.test/fr/4", 0), ("https://orchard.test/de/apfel", 0), ("http://www.theatre.test/en/4811?page=2", 0),
    ("https://stone.test/en/2290#top", 0), ("http://northern.test/en/7", 0), ("https://blog.distant.test/es/88", 0),
    ("http://thing.test/fr/903", 0), ("https://m.reading.test/en/51/", 0), ("http://ingredient.test/de/640", 0),
    ("https://www.hands.test/en/2", 0), ("http://nothing.test/en/1502", 0), ("https://notary.test/fr/3", 0),
]


def host_of(url: Column) -> Column:
    """From the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    return ascii_lower(F.regexp_extract(_rest(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _grams(text: Column, kind: str) -> Column:
    """The buckets of the n-grams of a text with its ends marked, repeats included."""
    def sized(chars: Column, size: int) -> Column:
        def bucket(i: Column) -> Column:
            return F.pmod(F.xxhash64(F.lit(kind), *[F.get(chars, i + k) for k in range(size)]), F.lit(BUCKETS)).cast("int")

        grams = F.transform(F.sequence(F.lit(0), F.size(chars) - size), bucket)
        return F.when(F.size(chars) >= size, grams).otherwise(F.array().cast("array<int>"))

    def of(chars: Column) -> Column:
        return F.concat(*[sized(chars, size) for size in SIZES])

    # The characters are bound once, as the only element of an array; else each n-gram would split the text anew.
    marked = F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))
    return F.get(F.transform(marked, of), 0)


def features(urls: DataFrame) -> DataFrame:
    """``grams array<int>`` beside the columns ``host`` and ``path``."""
    return urls.withColumn("grams", F.concat(_grams(F.col("host"), "host"), _grams(F.col("path"), "path")))


# Columns that ``judge`` makes.
OWN = ("host", "path", "grams", "rule", "verdict", "score")


def _score(grams: Column, weights: Sequence[float]) -> Column:
    """The probability to be blocked. The last weight is the intercept."""
    table = F.from_json(F.lit(json.dumps(list(weights))), "array<double>")
    total = F.aggregate(grams, F.lit(0.0), lambda total, gram: total + F.get(table, gram))
    scaled = F.when(F.size(grams) > 0, total / F.sqrt(F.size(grams).cast("double"))).otherwise(0.0)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(scaled + F.lit(float(weights[-1])))))


def labelled_table(spark: SparkSession, rows: Sequence[tuple[str, int]] = LABELLED) -> DataFrame:
    """(url, label) of a list."""
    packed = json.dumps([{"url": url, "label": label} for url, label in rows])
    return spark.range(1).select(F.inline(F.from_json(F.lit(packed), "array<struct<url string, label int>>")))


def train(labelled: DataFrame, epochs: int = EPOCHS, l2: float = 1e-3) -> list[float]:
    """Weights by bucket and the intercept, by whole-batch steps scaled by past gradients."""
    # The first by hash: which rows are taken does not depend on their order.
    rows = labelled.select("url", "label").filter("url IS NOT NULL AND label IS NOT NULL")
    rows = rows.orderBy(F.xxhash64("url"), "url", "label").limit(MAX_LABELLED)
    rows = features(rows.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("label").cast("double").alias("label")))
    rows = rows.select("grams", "label").filter(F.size("grams") > 0).cache()
    weights, past = [0.0] * (BUCKETS + 1), [1e-8] * (BUCKETS + 1)
    count = max(rows.count(), 1)
    for _ in range(epochs):
        missed = rows.select("grams", (_score(F.col("grams"), weights) - F.col("label")).alias("miss"))
        steps = missed.select(
            F.explode(F.concat("grams", F.array(F.lit(BUCKETS)))).alias("bucket"),
            F.col("miss"), (F.col("miss") / F.sqrt(F.size("grams").cast("double"))).alias("scaled"),
        ).groupBy("bucket").agg(F.sum(F.when(F.col("bucket") == BUCKETS, F.col("miss")).otherwise(F.col("scaled"))).alias("slope"))
        for bucket, slope in steps.collect():
            slope = slope / count + (l2 * weights[bucket] if bucket < BUCKETS else 0.0)
            past[bucket] += slope * slope
            weights[bucket] -= STEP * slope / math.sqrt(past[bucket])
    rows.unpersist()
    return [round(weight, 9) for weight in weights]


def judge(urls: DataFrame, rules: Sequence[tuple[str, str, str]], weights: Sequence[float], url: str = "url", keep: Sequence[str] = ("page_id",)) -> DataFrame:
    """The ``keep`` columns, host, path, rule, verdict and score of each URL.

    A kept column that bears the name of one made here (``OWN``) comes back as ``kept_`` and its name.
    ``rules`` are (verdict, host, path prefix). A rule fits its host and the hosts below it; of those that
    fit the longest decides. Rules become one expression each, so the list should stay in the hundreds.
    """
    kept = [F.col(f"`{name}`").alias(f"kept_{name}" if name.lower() in OWN else name) for name in keep]
    address = F.col(f"`{url}`").cast("string")
    rows = features(urls.select(*kept, host_of(address).alias("host"), path_of(address).alias("path")))
    names = [f"`{name}`" for name in rows.columns[:len(keep)]]
    rule = verdict = None
    for action, host, prefix in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((F.col("host") == host) | F.col("host").endswith(f".{host}")) & F.col("path").startswith(prefix)
        rule = F.when(fits, F.lit(host + prefix)) if rule is None else rule.when(fits, F.lit(host + prefix))
        verdict = F.when(fits, F.lit(action)) if verdict is None else verdict.when(fits, F.lit(action))
    score = _score(F.col("grams"), weights)
    learned = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return rows.withColumn("score", score).select(
        *names, "host", "path",
        (F.lit(None).cast("string") if rule is None else rule).alias("rule"),
        (learned if verdict is None else F.coalesce(verdict, learned)).alias("verdict"),
        "score",
    )
