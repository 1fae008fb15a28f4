"""The registered queries of this subpackage: thin, over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioforge.llm import decontam, license_scan, lz_fingerprint, mixing, quality, simhash, suffix_dedup, token_counts, toxicity, url_filter
from folioforge.llm.common import table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op2_lz_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz_fingerprint.edit_report(table(spark, sf_dir, "documents"))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op4_quality_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeats_report(table(spark, sf_dir, "documents"))


def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicate_report(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.suffix_sums(token_counts.length_histogram(table(spark, sf_dir, "documents")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_license_scan, op2_lz_fingerprints, op3_mix_sources, op4_quality_resampling, op5_benchmark_decontamination, op6_url_filter, op7_suffix_array_dedup, op8_simhash_near_dedup, op9_toxicity, op10_token_counts)}


#: Words and windows of op5 as lists: every window of a document meets the benchmark's.
OP5_SQL = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(13, len(w)) AS n FROM bw WHERE len(w) > 0),
bp AS (SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM bs)),
dp AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM bp) WHERE len(w) >= n)),
m AS (SELECT doc_id, i, dp.n, item_id FROM dp JOIN bp ON dp.n = bp.n AND dp.g = bp.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM m WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated FROM dw LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)"""

#: All 50-byte windows of op7, with the first document that has each.
OP7_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS g FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM d WHERE length(x) >= 100)),
r AS (SELECT doc_id, i FROM w JOIN (SELECT g, min(doc_id) AS f FROM w GROUP BY g) USING (g) WHERE f < doc_id),
s AS (SELECT doc_id, i, CASE WHEN i > max(i + 50) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 1 ELSE 0 END AS new FROM r),
k AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s),
u AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM k GROUP BY doc_id, run),
e AS (SELECT doc_id, a, b, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS z FROM u),
c AS (SELECT doc_id, sum(b - a)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head, max(b) AS last FROM e JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, (length(x) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN c USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op5_benchmark_decontamination": OP5_SQL, "op7_suffix_array_dedup": OP7_SQL}
