"""The operators as checked queries over the whole tables, with SQL counterparts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textloom.llm import collocations, decontaminate, hard_negatives, html_text, language_id, licenses, line_dedup, near_dup, packing, quality, token_files, toxicity, warc
from textloom.llm.common import table
from textloom.llm.tokens import path_of

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
WORD_BPE = "word_bpe_49k.json"


def _query(job: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[job.__name__] = job
    return job


@_query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_rows(table(spark, sf_dir, "documents"), path_of(WORD_BPE), end_id=2)


@_query
def op2_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", near_dup.hex_fingerprint().alias("fingerprint"), "component_id")


@_query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"), path_of(WORD_BPE), end_id=1)


@_query
def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    found = warc.archive_pages(pages).lookup(pages, with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op10_warc_index"] = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
  SELECT digest, min(page_id) AS first FROM payloads WHERE n >= 100 GROUP BY digest
)
SELECT page_id, n AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.digest = f.digest
"""


@_query
def op1_positional_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLES["op1_positional_decontamination"] = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, len(x) AS k, x AS gram FROM (
    SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: w[i : i + 9])) AS x FROM items WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT k FROM windows),
places AS (
  SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM words, sizes WHERE len(w) >= k
), hits AS (
  SELECT DISTINCT p.doc_id, p.i, p.k, v.item_id FROM (SELECT doc_id, k, i, w[i : i + k - 1] AS gram FROM places) p
  JOIN windows v ON v.k = p.k AND v.gram = p.gram
), covered AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@_query
def op3_html_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


@_query
def op4_license_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licences(table(spark, sf_dir, "documents"))


@_query
def op8_counterfactual_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query
def op5_histogram_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents")).drop("text_hash")


def _sql_list(words: Iterable[str]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_SHARE = "list_transform({x}, lambda v: v::DOUBLE / list_sum({x}))"
_DISTANCE = """sqrt(greatest(list_sum(list_transform(list_zip({p}, {q}), lambda z:
  (CASE WHEN z[1] > 0 THEN z[1] * log2(z[1] / ((z[1] + z[2]) / 2)) ELSE 0 END)
  + (CASE WHEN z[2] > 0 THEN z[2] * log2(z[2] / ((z[1] + z[2]) / 2)) ELSE 0 END))) / 2, 0))"""


def _distance_sql(left: str, right: str) -> str:
    return _DISTANCE.format(p=_SHARE.format(x=left), q=_SHARE.format(x=right))


_LISTS = "MAP {'en': {en}, 'fr': {fr}, 'de': {de}, 'es': {es}}"
for _lang in ("en", "fr", "de", "es"):
    _LISTS = _LISTS.replace(f"{{{_lang}}}", _sql_list(quality.COMMON[_lang]))
ORACLES["op5_histogram_divergence"] = rf"""
WITH texts AS (
  SELECT doc_id, lang, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         regexp_extract_all(lower(coalesce(text, '')), '\p{{L}}+') AS lw,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT *, list_transform(range(1, greatest(len(w) - 2, 0) + 1), lambda i: array_to_string(w[i : i + 2], ' ')) AS grams FROM texts
), places AS (
  SELECT doc_id, unnest(range(1, len(grams) + 1)) AS i, unnest(grams) AS g FROM windows
), repeated AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS j FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM places) WHERE c > 1
  ) GROUP BY doc_id
), counts AS (
  SELECT w.doc_id, lang, t, lw, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(r.n, 0) AS n_repeat_words, {_LISTS} AS lists
  FROM windows w LEFT JOIN repeated r USING (doc_id)
), listed AS (
  SELECT *, CASE WHEN lang IN ('en', 'fr', 'de', 'es') THEN lang ELSE
    list_extract(['en', 'fr', 'de', 'es'], list_position(hits, list_max(hits))) END AS list
  FROM (SELECT *, list_transform(['en', 'fr', 'de', 'es'], lambda k: len(list_filter(lw, lambda x: list_contains(lists[k], x)))) AS hits FROM counts)
), shaped AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    [length(t) - word_chars, word_chars - list_sum(rest)] || rest AS classes,
    list_transform(lists[list], lambda k: len(list_filter(lw, lambda x: x = k))) || [len(list_filter(lw, lambda x: NOT list_contains(lists[list], x)))] AS words
  FROM (SELECT *, list_transform(['[^A-Z]', '[^0-9]', '[^.,;:!?''"()-]', '[^#*$%&|<>]', '[\x00-\x7F]', '[^+/=@\[\\\]^_`{{}}~\x00-\x08\x0E-\x1F\x7F]'],
          lambda p: length(regexp_replace(t, p, '', 'g'))) AS rest FROM listed)
), refs AS (
  SELECT list AS k, sum(n_words) AS ref_n,
    [{", ".join(f"sum(classes[{i}])" for i in range(1, quality.N_CLASSES + 1))}] AS rc, [{", ".join(f"sum(words[{i}])" for i in range(1, 22))}] AS rw
  FROM shaped WHERE NOT base_failed AND 10 * n_symbols <= n_words GROUP BY list
), judged AS (
  SELECT *, CASE WHEN ref_n >= {quality.LEAST_REFERENCE} AND length(t) >= {quality.LEAST_CHARS} THEN round({_distance_sql("classes", "rc")}, 6) END AS class_distance,
    CASE WHEN ref_n >= {quality.LEAST_REFERENCE} AND len(lw) >= {quality.LEAST_LETTER_WORDS} THEN round({_distance_sql("words", "rw")}, 6) END AS word_distance
  FROM shaped LEFT JOIN refs ON k = list
)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed, class_distance, word_distance,
       NOT base_failed AND coalesce(class_distance, 0) <= {quality.MOST_CLASS_DISTANCE} AND coalesce(word_distance, 0) <= {quality.MOST_WORD_DISTANCE} AS kept
FROM judged
"""


@_query
def op7_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents"), most_bits=None).select("doc_id", "text", "n_lines", "n_removed")


@_query
def op11_son_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op11_son_collocations"] = rf"""
WITH pieces AS (
  SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS p FROM documents)
), sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
grams AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM pieces, (SELECT unnest([1, 2, 3, 4, 5]) AS k) WHERE len(w) >= k)
), f AS MATERIALIZED (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS w, count(*) AS a FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 100
), longer AS (
  SELECT DISTINCT lang, a, array_to_string(w[i : i + j - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, k - j + 2)) AS i FROM (SELECT *, unnest(range(2, k)) AS j FROM f WHERE k > 2))
), cuts AS (
  SELECT f.lang, f.phrase, f.a, j, p.a AS l, q.a AS r, n, CAST((1000::HUGEINT * f.a * n) // (p.a::HUGEINT * q.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM f WHERE k > 1) f
  JOIN f p ON p.lang = f.lang AND p.phrase = array_to_string(f.w[1 : j], ' ')
  JOIN f q ON q.lang = f.lang AND q.phrase = array_to_string(f.w[j + 1 :], ' ')
  JOIN sizes s ON s.lang = f.lang
  WHERE NOT EXISTS (FROM longer b WHERE b.lang = f.lang AND b.phrase = f.phrase AND 100 * b.a >= 100 * f.a)
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT * FROM (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM best
) WHERE rank <= 2000
"""


@_query
def op12_centroid_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify_languages(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", F.col("nearest").alias("lang_pred"), "score", "rejected")


@_query
def op13_str_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


ORACLES["op13_str_hard_negatives"] = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
