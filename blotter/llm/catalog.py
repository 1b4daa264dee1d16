"""Registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from blotter.llm.decontamination import find_contamination
from blotter.llm.frames import read_table
from blotter.llm.hard_negatives import mine, relabelled
from blotter.llm.katz import katz_scores
from blotter.llm.line_dedup import dedup_lines
from blotter.llm.mixing import mix_sources
from blotter.llm.ngram_join import ngram_components
from blotter.llm.pu_quality import pu_quality
from blotter.llm.quality_rules import quality_rules
from blotter.llm.secret_scan import scan_secrets
from blotter.llm.simhash_trie import simhash_components
from blotter.llm.substring_dedup import repeated_paragraphs
from blotter.llm.warc import archive_pages
from blotter.llm.whitening import whiten


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.drop("text_hash")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_paragraphs(read_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return dedup_lines(documents, count_as="removed_lines")


def op6_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(spark, read_table(spark, sf_dir, "documents"))


def op7_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(spark, read_table(spark, sf_dir, "pages"))


def op8_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(spark, read_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(spark, relabelled(read_table(spark, sf_dir, "embeddings")))


def op13_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_decontamination,
        op3_secret_scan,
        op4_substring_dedup,
        op5_line_dedup,
        op6_katz_scores,
        op7_warc_archive,
        op8_pu_quality,
        op9_source_mix,
        op10_ngram_join,
        op11_whitening,
        op12_hard_negatives,
        op13_simhash_trie,
    )
}

#: Lines that repeated chunks take: i numbers lines from 1, upto counts a
#: text's characters up to a line's end, line breaks included.
REPEATED_LINES_SQL = """
WITH line AS (
  SELECT doc_id, i, x, length(x) AS n, ('0x' || substr(md5(x), 1, 8))::BIGINT AS h,
         sum(length(x) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS upto
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i
        FROM documents WHERE text IS NOT NULL)
), rolled AS (
  SELECT *, (31 * h + lead(h) OVER w) % 4294967291 AS r, n + 1 + lead(n) OVER w AS pair_chars
  FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), marked AS (
  SELECT *, r IS NOT NULL AND (pair_chars >= 100 OR r <= greatest(coalesce(lag(r) OVER w, 4294967291), coalesce(lead(r) OVER w, 4294967291))) AS starts
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), bounds AS (
  SELECT *, coalesce(lag(starts) OVER (PARTITION BY doc_id ORDER BY i), false) AS stops FROM marked
), runs AS (
  SELECT a.doc_id, a.i AS first, min(b.i) AS last FROM bounds a JOIN line b ON b.doc_id = a.doc_id AND b.i > a.i AND b.upto - a.upto + a.n >= 40
  WHERE a.starts GROUP BY a.doc_id, a.i
  UNION
  SELECT b.doc_id, max(a.i) AS first, b.i AS last FROM bounds b JOIN line a ON a.doc_id = b.doc_id AND b.i > a.i AND b.upto - a.upto + a.n >= 40
  WHERE b.stops GROUP BY b.doc_id, b.i
), text_lines AS (
  SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL
), chunk AS (
  SELECT doc_id, first, last, array_to_string(lines[first:last], chr(10)) AS body FROM runs JOIN text_lines USING (doc_id)
), later AS (
  SELECT doc_id, first, last FROM chunk QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, first) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM later
), kept AS (
  SELECT doc_id, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE g.i IS NULL), '') AS kept_text, count(g.i) AS removed
  FROM line LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id
)
"""

ORACLES: dict[str, str] = {
    "op5_line_dedup": REPEATED_LINES_SQL
    + "SELECT d.doc_id, k.kept_text AS text, coalesce(k.removed, 0) AS removed_lines FROM documents d LEFT JOIN kept k USING (doc_id)",
    # Payload groups by their bytes; base32 from 20-bit pieces of the SHA-1.
    "op7_warc_archive": """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS body FROM pages
), h AS (
  SELECT page_id, body, octet_length(body) AS n, sha1(body) AS hex, max(page_id) OVER (PARTITION BY body) AS keeper FROM p
), d AS (
  SELECT *, list_transform(range(8), lambda i: ('0x' || substr(hex, 1 + 5 * i, 5))::BIGINT) AS parts,
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567' AS abc FROM h
)
SELECT page_id, n::BIGINT AS payload_bytes,
       array_to_string(list_transform(parts, lambda v: substr(abc, 1 + (v // 32768), 1) || substr(abc, 1 + (v // 1024) % 32, 1)
                                      || substr(abc, 1 + (v // 32) % 32, 1) || substr(abc, 1 + v % 32, 1)), '') AS payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM d
""",
    # Rows of one id are told apart by their place; scores are exact in doubles.
    "op12_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), met AS (
  SELECT a.uid, a.vec_id AS anchor_id, v.uid AS other_uid, v.vec_id AS other, v.label = a.label AS same, list_dot_product(a.q, v.q)::BIGINT AS score
  FROM v a JOIN v ON a.uid <> v.uid WHERE a.vec_id % 100 = 0
), positive AS (
  SELECT * FROM met WHERE same QUALIFY row_number() OVER (PARTITION BY uid ORDER BY score DESC, other NULLS LAST, other_uid) <= 5
)
SELECT p.anchor_id, p.other AS positive_id,
       row_number() OVER (PARTITION BY p.uid, p.other_uid ORDER BY n.score DESC, n.other NULLS LAST, n.other_uid)::INTEGER AS rank,
       n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN met n ON n.uid = p.uid AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
""",
}
