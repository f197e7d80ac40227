"""Queries over the operators of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, decontaminate, line_dedup, near_dedup, pii, quality, sharding, substring_dedup, token_counts, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    hist = token_counts.length_histogram(_table(spark, sf_dir, "documents"), _vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return token_counts.with_suffix_sums(hist)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record is rebuilt from the archive, and what is returned comes from its bytes."""
    archive = warc.write_archive(_table(spark, sf_dir, "pages"))
    rows = warc.parse_records(warc.read_archive(spark, archive))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_components(_table(spark, sf_dir, "documents"), size=3, percent=85)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.drop_repeats(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.external_shuffle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return rows.select("doc_id", "size", crc.alias("text_crc32"), F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality.plan_order(docs, quality.RULES)
    rows = quality.cascade(docs, rules, stats=quality.STATS, base=quality.BASE_RULES)
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.encode(docs, _vocabulary("word_bpe_49k.json"), ("n_tokens", "ids_sha256", "decoded_sha256")).drop("text")


#: Setting that holds the key of pseudonyms; Spark redacts settings with this word in their name.
PII_KEY = "spark.vestigo.pii.secret"


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document that holds a personal value, with its text after the change."""
    rows = pii.pseudonymise(_table(spark, sf_dir, "documents").select("doc_id", "text"), spark.conf.get(PII_KEY, "vestigo"))
    kinds = F.array_sort(F.array_distinct(F.col("pii.kind")))
    return rows.filter(F.size("pii") > 0).select("doc_id", F.size("pii").cast("long").alias("n_values"), F.array_join(kinds, ",").alias("kinds"), "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_line_dedup": op2_line_dedup,
    "op3_warc": op3_warc,
    "op4_decontamination": op4_decontamination,
    "op5_near_dedup": op5_near_dedup,
    "op6_substring_dedup": op6_substring_dedup,
    "op7_sharding": op7_sharding,
    "op8_quality": op8_quality,
    "op9_bpe": op9_bpe,
    "op10_pii": op10_pii,
}

ORACLES: dict[str, str] = {
    "op2_line_dedup": r"""
WITH texts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
lines AS (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM texts),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
common AS (SELECT key, max(doc_id) AS last_doc FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.last_doc AS goes FROM keyed k LEFT JOIN common c ON k.key = c.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op3_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest, payload FROM p),
h AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS holder FROM d)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
    CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN payload_bytes >= 1000 AND page_id <> holder THEN holder END AS refers_to
FROM h""",
    "op4_decontamination": r"""
WITH words AS (SELECT doc_id AS id, TRUE AS doc, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    UNION ALL SELECT item_id, FALSE, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') FROM benchmark),
grams AS (SELECT DISTINCT id, doc, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT id, doc, w, unnest(range(1, greatest(len(w) - 3, 1))) AS i FROM words)),
sizes AS (SELECT id AS item_id, count(*) AS n FROM grams WHERE NOT doc GROUP BY id)
SELECT d.id AS doc_id, i.id AS item_id, s.n AS n_shingles, count(*) AS n_shared, count(*) / s.n AS containment
FROM grams d JOIN grams i ON d.g = i.g AND d.doc AND NOT i.doc JOIN sizes s ON s.item_id = i.id
GROUP BY d.id, i.id, s.n HAVING 100 * count(*) >= 80 * s.n""",
    "op8_quality": r"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
grams AS (SELECT doc_id, i, array_to_string(w[i:i+7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 6, 1))) AS i FROM t)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM grams) WHERE n > 1),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(ls) AS line FROM t),
dups AS (SELECT doc_id, CAST(sum(n - 1) AS BIGINT) AS n FROM (SELECT doc_id, line, count(*) AS n FROM lines
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id, line) GROUP BY doc_id),
marks AS (SELECT doc_id, count(*) AS n, count(*) FILTER (regexp_matches(line, '^[\x20\x09-\x0D]*(-|[*]|•)')) AS bullets,
    count(*) FILTER (regexp_matches(line, '([.][.][.]|…)[\x20\x09-\x0D]*$')) AS ellipses FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
pairs AS (SELECT doc_id, max(n) AS n FROM (SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, w[i] || ' ' || w[i + 1] AS g FROM (SELECT doc_id, w, unnest(range(1, len(w))) AS i FROM t)) GROUP BY doc_id, g) GROUP BY doc_id),
s AS (SELECT t.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    coalesce(dups.n, 0) AS n_dup_lines, CAST(coalesce(cover.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]'))) AS n_upper, length(text) - length(replace(text, '!', '')) AS n_exclamations,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]'))) AS n_alpha, coalesce(marks.n, 0) AS n_word_lines, coalesce(bullets, 0) AS bullets,
    coalesce(ellipses, 0) AS ellipses, coalesce(pairs.n, 0) AS top_pair,
    len(list_filter(w, lambda x: translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') IN ('the', 'of', 'and', 'to', 'a', 'in', 'that', 'is', 'der', 'die', 'und', 'den', 'das', 'ist', 'zu',
        'la', 'de', 'et', 'le', 'les', 'un', 'une', 'des', 'que', 'el', 'los', 'en', 'y'))) AS n_function
    FROM t LEFT JOIN cover ON cover.doc_id = t.doc_id LEFT JOIN dups ON dups.doc_id = t.doc_id LEFT JOIN marks ON marks.doc_id = t.doc_id LEFT JOIN pairs ON pairs.doc_id = t.doc_id),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND 10 * n_symbols <= n_words AND word_chars >= 3 * n_words AND word_chars <= 12 * n_words
    AND 2 * n_dup_lines <= n_lines AND 2 * n_upper <= n_words AND 5 * n_exclamations <= n_words AND 10 * n_alpha >= 8 * n_words
    AND 10 * bullets <= 9 * n_word_lines AND 10 * ellipses <= 3 * n_word_lines AND (top_pair < 5 OR 10 * top_pair <= n_words)
    AND (n_words < 50 OR n_function > 0) AS kept
FROM b""",
}
