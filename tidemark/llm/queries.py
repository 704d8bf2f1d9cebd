"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import bpe, decontaminate, labelled, lexical, line_dedup, mixing, quality, simhash, spelling, suffix_dedup, topk, toxicity, url_filter, warc
from tidemark.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


@query("op1_url_filter")
def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    weights = url_filter.train(url_filter.labelled_table(spark))
    return url_filter.judge(table(spark, folder, "pages"), URL_RULES, weights)


@query("op6_byte_bpe")
def op6_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    vocabulary = bpe.Vocabulary(bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return bpe.digests(bpe.round_trip(table(spark, folder, "documents"), vocabulary, public_tokenizers.PATTERN))


def _text_sql(html: str) -> str:
    text = html
    for pattern in warc.DROPPED:
        text = f"regexp_replace({text}, '{pattern}', ' ', 'g')"
    text = f"regexp_replace(regexp_replace({text}, '{warc.BLOCK}', chr(10), 'g'), '{warc.TAG}', '', 'g')"
    for entity, char in warc.ENTITIES:
        text = "replace({}, '{}', '{}')".format(text, entity, char.replace("'", "''"))
    return f"trim(regexp_replace(regexp_replace({text}, '[ \\t\\r]+', ' ', 'g'), ' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))"


def _uuid_sql(*parts: str) -> str:
    name = f"sha256({' || chr(10) || '.join(parts)})"
    return "'<urn:uuid:' || " + " || '-' || ".join(f"substr({name}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))) + " || '>'"


OP9_SQL = f"""
WITH source AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
    'sha256:' || sha256(coalesce(html, '')) AS source_payload_digest
  FROM pages
), named AS (
  SELECT *, {_uuid_sql("'response'", "target_uri", "source_payload_digest")} AS refers_to, {_text_sql("payload")} AS text,
    trim(regexp_replace(regexp_extract(payload, '(?is)<title[^>]*>(.*?)</title', 1), '\\s+', ' ', 'g'), ' ') AS title,
    regexp_extract(payload, '(?i)<html[^>]*\\blang=["'']?([a-zA-Z-]+)', 1) AS language,
    len(regexp_extract_all(payload, '(?i)<a\\s[^>]*\\bhref=')) AS links
  FROM source
), built AS (
  SELECT *, 'sha256:' || sha256(text) AS text_digest FROM named
), blocks AS (
  SELECT *, {_uuid_sql("'conversion'", "refers_to", "text_digest")} AS conversion_id,
    'title: ' || title || chr(13) || chr(10) || 'language: ' || language || chr(13) || chr(10)
    || 'outlinks: ' || links || chr(13) || chr(10)
    || 'source-content-type: text/html; charset=utf-8' || chr(13) || chr(10)
    || 'source-content-length: ' || strlen(payload) || chr(13) || chr(10)
    || 'source-payload-digest: ' || source_payload_digest || chr(13) || chr(10)
    || 'text-digest: ' || text_digest || chr(13) || chr(10) AS metadata
  FROM built
), digested AS (
  SELECT *, 'sha256:' || sha256(metadata) AS metadata_digest FROM blocks
)
SELECT page_id, 'metadata' AS warc_type, {_uuid_sql("'metadata'", "refers_to", "metadata_digest")} AS record_id,
  refers_to, conversion_id AS concurrent_to, target_uri, 'application/warc-fields' AS content_type,
  CAST(strlen(metadata) AS BIGINT) AS content_length, metadata_digest AS block_digest, source_payload_digest
FROM digested
UNION ALL
SELECT page_id, 'conversion', conversion_id, refers_to, NULL, target_uri, 'text/plain; charset=utf-8',
  CAST(strlen(text) AS BIGINT), text_digest, source_payload_digest
FROM digested
"""


@query("op9_warc", OP9_SQL)
def op9_warc(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.derive(warc.responses(table(spark, folder, "pages")))
    return records.select(
        F.col("key").alias("page_id"), "warc_type", "record_id", "refers_to", "concurrent_to", "target_uri", "content_type",
        "content_length", "block_digest", "source_payload_digest",
    )


@query("op2_simhash")
def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"), shingle=4, bits=4)
    return found.select("row.doc_id", "fingerprint", F.col("component").alias("component_id"))


SPACE_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3_SQL = f"""
WITH numbered AS (
  SELECT row_number() OVER () AS n, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT n, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM numbered
), keyed AS (
  SELECT *, {LOWER_SQL.format(f"trim(line, {SPACE_SQL})")} AS key FROM lines
), common AS (
  SELECT key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT n) >= 10
), judged AS (
  SELECT k.*, c.key IS NOT NULL AS dropped FROM keyed k LEFT JOIN common c USING (key)
)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY n
"""


@query("op3_line_dedup", OP3_SQL)
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.drop_common_lines(table(spark, folder, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query("op8_quality")
def op8_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    weights = quality.train(labelled.sample(docs, table(spark, folder, "labels"), "quality", 3, 1, quality.ROWS))
    return _judged(quality.score(docs, weights), 3, 1)


@query("op10_toxicity")
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return _judged(toxicity.score(docs, toxicity_lexicon(spark, folder)), 5, 0)


def toxicity_lexicon(spark: SparkSession, folder: str) -> toxicity.Lexicon:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    return toxicity.learn(labelled.sample(docs, labels, "toxic", 5, 0, toxicity.ROWS))


def _judged(scored: DataFrame, folds: int, held_out: int) -> DataFrame:
    key = F.col("row.doc_id")
    return scored.select(
        key.alias("doc_id"), F.coalesce(labelled.fold(key, folds) == held_out, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


WORDS_SQL = "coalesce(regexp_extract_all(" + LOWER_SQL.format("text") + ", '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"

OP5_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS n, doc_id, {WORDS_SQL} AS words FROM documents
), items AS (
  SELECT DISTINCT item_id, {WORDS_SQL} AS words FROM benchmark
), sized AS (
  SELECT item_id, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0
), starts AS (
  SELECT item_id, words, size, unnest(range(1, len(words) - size + 2)) AS s FROM sized
), windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[s:s + size - 1], ' ') AS passage FROM starts
), places AS (
  SELECT n, words, size, unnest(range(1, len(words) - size + 2)) AS s
  FROM docs, (SELECT DISTINCT size FROM windows) WHERE len(words) >= size
), found AS (
  SELECT n, s, p.size, item_id
  FROM (SELECT n, s, size, array_to_string(words[s:s + size - 1], ' ') AS passage FROM places) p JOIN windows USING (size, passage)
), hit AS (
  SELECT n, count(DISTINCT place) AS n_hit FROM (SELECT n, unnest(range(s, s + size)) AS place FROM found) GROUP BY n
), listed AS (
  SELECT n, count(*) AS n_items, sha256(string_agg(id, ',' ORDER BY id)) AS items_sha256
  FROM (SELECT DISTINCT n, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY n
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (n) LEFT JOIN listed USING (n)
"""


@query("op5_decontamination", OP5_SQL)
def op5_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "benchmark")
    found = decontaminate.contamination(docs, items, window=10)
    return found.select(
        "row.doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("ids", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(table(spark, folder, "documents").select("doc_id", "text"), length=400)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, span: n + span["end"] - span["begin"])
    return found.select(
        "row.doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


OP4_SQL = """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.vec AS DOUBLE[]), CAST(c.vec AS DOUBLE[])) AS BIGINT) AS score
  FROM usable q JOIN usable c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM scored
)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 20
"""


@query("op4_topk", OP4_SQL)
def op4_topk(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_k(table(spark, folder, "embeddings"), k=20, every=20, scale=64.0)


TERMS_SQL = "coalesce(regexp_extract_all(" + LOWER_SQL.format("text") + ", '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+'), [])"

OP13_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS p, doc_id, {TERMS_SQL} AS words FROM documents
), total AS (
  SELECT count(*) AS n_docs, sum(len(words)) AS n_terms FROM docs WHERE len(words) > 0
), items AS (
  SELECT row_number() OVER () AS q, item_id, list_distinct({TERMS_SQL}) AS words FROM benchmark
), wanted AS (
  SELECT q, unnest(words) AS term FROM items
), counted AS (
  SELECT p, doc_id, n, term, count(*) AS tf
  FROM (SELECT p, doc_id, len(words) AS n, unnest(words) AS term FROM docs)
  WHERE term IN (SELECT term FROM wanted) GROUP BY ALL
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM counted, total GROUP BY term
), gains AS (
  SELECT p, doc_id, term, CAST(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))) AS BIGINT) AS gain
  FROM counted JOIN weights USING (term), total
), scored AS (
  SELECT q, p, any_value(doc_id) AS doc_id, CAST(sum(gain) AS BIGINT) AS score FROM wanted JOIN gains USING (term) GROUP BY q, p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS place FROM scored WHERE score > 0
)
SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked JOIN items USING (q) WHERE place <= 10
"""


@query("op13_lexical_search", OP13_SQL)
def op13_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    found = lexical.search(table(spark, folder, "documents"), table(spark, folder, "benchmark"), k=10)
    return found.select(F.col("item").alias("item_id"), "rank", F.col("key").alias("doc_id"), "score")


@query("op11_spelling_variants")
def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"), min_chars=7, min_count=2, ratio=10, slips=31)


@query("op12_context_mixing")
def op12_context_mixing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = mixing.scores(docs, labelled.fold(F.col("doc_id"), 10) == 0)
    return found.select(
        "row.doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte",
    )
