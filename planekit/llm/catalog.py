"""The registered queries of the subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planekit.llm.common import text_at
from planekit.llm.decontaminate import judge
from planekit.llm.exact_dedup import dedup_exact
from planekit.llm.hard_negatives import mine_hard_negatives
from planekit.llm.langid import identify
from planekit.llm.license_scan import scan_licenses
from planekit.llm.line_dedup import dedup_lines
from planekit.llm.lm_scoring import score
from planekit.llm.piece_coding import encode
from planekit.llm.pii import BASE, find_personal_data, spans_text
from planekit.llm.quality_rules import judge_quality
from planekit.llm.simhash import hex_fingerprint, near_duplicates
from planekit.llm.spelling import group_variants
from planekit.llm.url_filter import judge_urls


def op1_exact_dedup(spark: SparkSession, d: str) -> DataFrame:
    return dedup_exact(text_at("documents", spark, d))


def op2_license_scan(spark: SparkSession, d: str) -> DataFrame:
    out = scan_licenses(text_at("documents", spark, d))
    spans = F.array_join(F.transform("found", lambda f: F.concat_ws(
        ":", f["license"], f["first"].cast("string"), f["end"].cast("string"))), ",")
    return out.select("doc_id", "license", "coverage", F.size("found").cast("long").alias("n_found"),
                      spans.alias("spans"))


def op3_sentencepiece(spark: SparkSession, d: str) -> DataFrame:
    out = encode(text_at("documents", spark, d), with_ids=False)
    hashes = F.array_join(F.transform("n_best", lambda s: s["ids_sha256"]), ",")
    return out.select("doc_id", "n_chars", "n_pieces", "ids_sha256", "round_trip",
                      F.element_at("n_best", 1)["score"].alias("best_score"),
                      F.element_at("n_best", -1)["score"].alias("last_score"),
                      F.size("n_best").cast("long").alias("n_segmentations"), F.sha2(hashes, 256).alias("n_best_sha256"))


def op4_pii(spark: SparkSession, d: str) -> DataFrame:
    found = find_personal_data(text_at("documents", spark, d))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.array_sort(F.concat("base", "further"))).alias("spans"))


def op5_line_dedup(spark: SparkSession, d: str) -> DataFrame:
    out = dedup_lines(text_at("documents", spark, d))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op6_language_id(spark: SparkSession, d: str) -> DataFrame:
    return identify(text_at("documents", spark, d))


def op7_lm_scoring(spark: SparkSession, d: str) -> DataFrame:
    return score(text_at("documents", spark, d))


def op8_url_filter(spark: SparkSession, d: str) -> DataFrame:
    return judge_urls(text_at("pages", spark, d))


def op9_simhash(spark: SparkSession, d: str) -> DataFrame:
    out = near_duplicates(text_at("documents", spark, d))
    return out.select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op10_decontamination(spark: SparkSession, d: str) -> DataFrame:
    out = judge(text_at("documents", spark, d), text_at("benchmark", spark, d))
    return out.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_hard_negatives(spark: SparkSession, d: str) -> DataFrame:
    rows = text_at("embeddings", spark, d)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 100 == 0)


def op12_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    out = judge_quality(text_at("documents", spark, d))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_spelling_variants(spark: SparkSession, d: str) -> DataFrame:
    return group_variants(text_at("documents", spark, d))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_exact_dedup, op2_license_scan, op3_sentencepiece, op4_pii, op5_line_dedup, op6_language_id, op7_lm_scoring, op8_url_filter, op9_simhash, op10_decontamination,
                            op11_hard_negatives, op12_quality_rules, op13_spelling_variants)}

ORACLE: dict[str, str] = {
    "op1_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) = 1 AS kept,
       text_sha256
FROM d""",
    "op5_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM lines),
frequent AS (
  SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40
  GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT keyed.*, f.k IS NOT NULL AND doc_id <> keeper AS gone FROM keyed LEFT JOIN frequent f USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op10_decontamination": r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM documents),
b AS (
  SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '') AS words FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, size, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i
        FROM (SELECT *, least(len(words), 13) AS size FROM b WHERE len(words) > 0))),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS i FROM d CROSS JOIN sizes WHERE len(words) >= size)),
hits AS (SELECT doc_id, item_id, i, size FROM dw JOIN bw USING (size, win)),
per AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
its AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM d LEFT JOIN per USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_hard_negatives": r"""
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id OR a.label <> b.label WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
  SELECT anchor_id, positive_id, id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS r
  FROM p JOIN s USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, r::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE r <= 10""",
    "op12_quality_rules": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS win
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
rep AS (
  SELECT doc_id, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p
        FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS c FROM wins) WHERE c > 1)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, t, w, l, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         len(l)::BIGINT AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN rep USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
            OR word_chars < 3 * n_words OR word_chars > 10 * n_words OR 10 * n_symbols > n_words
            OR 10 * n_dup_lines > 3 * n_lines
            OR len(list_filter(w, lambda x: regexp_matches(x, '\p{L}'))) < 0.8 * n_words
            OR len(list_filter(l, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣▪●]'))) > 0.9 * n_lines
            OR len(list_filter(l, lambda x: regexp_matches(x, '(?:\.\.\.|…)[\x20\x09-\x0D]*$'))) > 0.3 * n_lines
            OR contains(lower(t), 'lorem ipsum')) AS kept
FROM m""",
}
