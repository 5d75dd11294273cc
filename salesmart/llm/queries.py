"""The registered queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from salesmart.llm import bpe, decontamination, html_text, licenses, lm_scoring, near_dedup
from salesmart.llm import periodic_runs, phrases, pii, quality, secret_scan, sharding, toxicity
from salesmart.llm.common import read_table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_documents(spark, sf_dir))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secret_digest(_documents(spark, sf_dir))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.bpe_digest(_documents(spark, sf_dir))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_contamination(
        _documents(spark, sf_dir), read_table(spark, sf_dir, "benchmark")
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_documents(_documents(spark, sf_dir), 24)


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(_documents(spark, sf_dir))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_main_text(read_table(spark, sf_dir, "pages"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_documents(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_documents(spark, sf_dir))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_documents(spark, sf_dir), read_table(spark, sf_dir, "labels"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_documents(spark, sf_dir))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digest(_documents(spark, sf_dir))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_lm_scoring": op1_lm_scoring,
        "op2_secret_scan": op2_secret_scan,
        "op3_bpe": op3_bpe,
        "op4_decontamination": op4_decontamination,
        "op5_sharding": op5_sharding,
        "op6_pii": op6_pii,
        "op7_html_text": op7_html_text,
        "op8_quality": op8_quality,
        "op9_near_dedup": op9_near_dedup,
        "op10_license_scan": op10_license_scan,
        "op11_toxicity": op11_toxicity,
        "op12_phrases": op12_phrases,
        "op13_periodic_runs": op13_periodic_runs,
    }


_OP8 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS host
  FROM documents
),
words AS (
  SELECT rid, [x FOR x IN regexp_split_to_array(t, '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM docs
),
grams AS (
  SELECT rid, i, list_slice(ws, i, i + 7) AS gram
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 6)) AS i FROM words WHERE len(ws) >= 8)
),
starts AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM grams) WHERE n > 1
),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n_repeat_words
  FROM starts, (SELECT unnest(range(0, 8)) AS k) GROUP BY rid
),
lines AS (
  SELECT rid, host, t, line,
         regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                        '[\x20\x09-\x0D]+', ' ', 'g') AS norm
  FROM (SELECT rid, host, t, unnest(string_split(t, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
),
dup AS (
  SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY rid
),
texts AS (SELECT host, count(DISTINCT t) AS n_texts FROM docs GROUP BY host),
frequent AS (
  SELECT l.host, l.norm
  FROM (SELECT host, norm, count(DISTINCT t) AS n FROM lines GROUP BY host, norm) l
  JOIN texts USING (host) WHERE n > 10 AND n > n_texts * 0.05
),
removed AS (
  SELECT rid, count(*) AS n_removed_lines,
         sum(len(regexp_split_to_array(norm, ' '))) AS n_removed_words
  FROM lines JOIN frequent USING (host, norm) GROUP BY rid
),
stats AS (
  SELECT doc_id, len(ws) AS n_words,
         CAST(coalesce(length(array_to_string(ws, '')), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words,
         coalesce(n_removed_lines, 0) AS n_removed_lines,
         CAST(coalesce(n_removed_words, 0) AS BIGINT) AS n_removed_words
  FROM docs JOIN words USING (rid) LEFT JOIN covered USING (rid) LEFT JOIN dup USING (rid)
  LEFT JOIN removed USING (rid)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
         AND n_words - n_removed_words >= 20 AS kept
FROM stats
"""


_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
words AS (
  SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS ws FROM pieces
),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, m, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase
  FROM (SELECT lang, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
        FROM words, (SELECT unnest([1, 2, 3]) AS m) WHERE len(ws) >= m)
),
counts AS (
  SELECT lang, m, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10
),
cuts AS (
  SELECT lang, m, phrase, f AS a, k,
         array_to_string(list_slice(string_split(phrase, ' '), 1, k), ' ') AS head,
         array_to_string(list_slice(string_split(phrase, ' '), k + 1, m), ' ') AS tail
  FROM counts, (SELECT unnest([1, 2]) AS k) WHERE k < m
),
scored AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, x.f AS l, y.f AS r,
         CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
  JOIN counts y ON y.lang = c.lang AND y.phrase = c.tail
),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
),
inside AS (
  SELECT lang, phrase, max(f) AS longer FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '),
                            array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase
    FROM counts WHERE m = 3) GROUP BY lang, phrase
),
kept AS (
  SELECT o.* FROM lowest o LEFT JOIN inside i ON i.lang = o.lang AND i.phrase = o.phrase
  WHERE i.longer IS NULL OR 100 * i.longer < 50 * o.a
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
) JOIN totals USING (lang) WHERE rank <= 2000
"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op8_quality": _OP8, "op12_phrases": _OP12}
