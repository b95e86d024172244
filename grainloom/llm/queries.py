"""The ten queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from grainloom.llm import jaccard_join, licenses, media, mixing, packing, quality_classifier, quality_rules, sharding, token_counts, warc
from grainloom.llm.common import scratch, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token totals of all documents by source, language and tokenizer, through loads, a revision and a deletion in a ledger."""
    return token_counts.rollup(table(spark, sf_dir, "documents"), scratch(spark, "token-counts"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset; null texts are empty."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the class of its near duplicates and its number of links."""
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op4_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text stored as a picture with its tile, read back, with digests of what was read; null texts are empty."""
    return media.kept(table(spark, sf_dir, "documents"), scratch(spark, "media"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and templates of every whole text; null texts are empty."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards of near-equal bytes, equal texts together."""
    return sharding.shard(table(spark, sf_dir, "documents"), 8)


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from labels of rows that aren't held out."""
    return quality_classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the rules for every document; null texts have none."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document, with its source's target."""
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op10_warc_bundles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of seekable archives, read back: response, or revisit of an equal payload."""
    return warc.stored(table(spark, sf_dir, "pages"), scratch(spark, "warc"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_token_counts, op2_best_fit_packing, op3_ngram_jaccard_join, op4_media_columns, op5_license_scan, op6_sharding, op7_quality_classifier, op8_quality_rules, op9_source_mixing, op10_warc_bundles)
    return {f.__name__: f for f in every}


def _rules_sql() -> str:
    stops = ", ".join(f"'{w}'" for w in sorted(dict.fromkeys(quality_rules.STOP_WORDS.split())))
    tests = []
    for r in quality_rules.RULES:
        tests += [f"{r.measure} >= {r.low}"] * (r.low is not None) + [f"{r.measure} <= {r.high}"] * (r.high is not None)
    return f"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, words[i:i+4] AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w WHERE len(words) >= 5)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows) WHERE n > 1),
repeats AS (
  SELECT r, sum(least(5, i - coalesce(before, -5))) AS n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS before FROM twice) GROUP BY r),
m AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(repeats.n, 0)::BIGINT AS n_repeat_words,
         length(text) - length(replace(text, '!', '')) AS shouts, len(lines) AS n_lines,
         len(list_filter(words, lambda x: regexp_matches(x, '^[^\\p{{Ll}}]*\\p{{Lu}}[^\\p{{Ll}}]*$'))) AS upper_words,
         len(list_filter(words, lambda x: lower(x) IN ({stops}))) AS stops,
         len(list_filter(lines, lambda x: ends_with(x, '...') OR ends_with(x, '…'))) AS ellipses,
         len(list_filter(lines, lambda x: ltrim(x)[1] IN ('-', '*', '•', '·'))) AS bullets
  FROM w LEFT JOIN repeats USING (r)),
ratios AS (
  SELECT *, CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS mean_word_chars, CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbols_per_word,
         CASE WHEN n_words > 0 THEN shouts / n_words ELSE 0 END AS shouts_per_word, CASE WHEN n_words > 0 THEN upper_words / n_words ELSE 0 END AS upper_word_ratio,
         CASE WHEN n_words > 0 THEN (stops + 1) / n_words ELSE 0 END AS stop_ratio, CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_ratio,
         CASE WHEN n_lines > 0 THEN ellipses / n_lines ELSE 0 END AS ellipsis_line_ratio, CASE WHEN n_lines > 0 THEN bullets / n_lines ELSE 0 END AS bullet_line_ratio,
         (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, (NOT base_failed AND {' AND '.join(tests)}) AS kept FROM ratios"""


_WARC_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS payload_digest FROM p),
t AS (SELECT *, CASE WHEN payload_bytes >= {warc.LEAST} THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to FROM t"""


def oracle_sql() -> dict[str, str]:
    """Trained, sampled, packed and tokenized results have no SQL; tests hold those against brute force."""
    return {"op8_quality_rules": _rules_sql(), "op10_warc_bundles": _WARC_SQL}
