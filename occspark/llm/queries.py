"""The ten queries, one per operator, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.shared import cut, scratch, spread
from .ann import nearest_neighbours
from .html import extract_main_text
from .licenses import RULES, SENTENCES, scan_licenses, sentence_pattern
from .linededup import MIN_PAGES, RATIO, drop_boilerplate_lines
from .lmscore import score_documents
from .packing import pack_documents
from .quality import apply_quality_rules
from .simhash import simhash_components
from .tokencounts import TokenRollup, document_deltas, token_counts
from .transducer import piece_digest


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = apply_quality_rules(docs, carry_text=False, with_excess=True)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "host_rejected", F.round("host_excess", 9).alias("host_excess"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    joined = {c: F.array_join(c, ",") for c in ("sentence_ids", "licenses", "unmatched_ids")}
    return scan_licenses(docs).drop("text").withColumns(joined | {"n_sentences": F.size("sentence_ids").cast("long")})


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_read(spark, sf_dir, "pages"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed of four batches: all documents, later exact copies taken back, blank ends stripped, and a repeat.

    Every document is counted whole, and a second time stripped where it ends in blanks.
    """
    docs = _read(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    stripped = F.regexp_replace("text", "^[ \\t\\n\\r]+|[ \\t\\n\\r]+$", "")
    both = docs.withColumn("revised", F.when(stripped != F.col("text"), stripped)).withColumn("copy_of", F.md5("text"))
    counted = cut(token_counts(both.drop("revised")).withColumn("revision", F.lit(False)).unionByName(token_counts(both.filter("revised is not null").drop("text").withColumnRenamed("revised", "text")).withColumn("revision", F.lit(True))))
    first = counted.filter("not revision")
    # Written down, so that the join below shuffles both sides anew and can split the key of many copies.
    kept = cut(first.filter("copy_of is not null").groupBy("copy_of").agg(F.min("doc_id").alias("kept_id")))
    copies = first.join(kept, "copy_of").filter("doc_id <> kept_id")
    original = copies.select("doc_id").distinct()
    revised = counted.filter("revision").join(original, "doc_id", "left_anti")
    replaced = first.join(revised.select("doc_id"), "doc_id", "left_semi")
    rollup = TokenRollup(spark, scratch(spark, "rollup"))
    insert = document_deltas(first, 1)
    rollup.commit("0-insert", insert)
    rollup.commit("1-retract-copies", document_deltas(copies, -1))
    rollup.commit("2-revise", document_deltas(replaced, -1).unionByName(document_deltas(revised, 1)))
    rollup.commit("0-insert", insert)
    return rollup.totals()


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_read(spark, sf_dir, "documents"))


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_read(spark, sf_dir, "documents"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digest(_read(spark, sf_dir, "documents"))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    out = drop_boilerplate_lines(docs)
    return out.select("doc_id", "n_lines", "n_dropped_lines", F.length("text").cast("long").alias("n_chars_kept"), F.md5("text").alias("text_md5"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_license_scan": op2_license_scan,
    "op3_html_extraction": op3_html_extraction,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_sentencepiece": op8_sentencepiece,
    "op9_nearest_neighbours": op9_nearest_neighbours,
    "op10_line_dedup": op10_line_dedup,
}

_BLANK = "[ \\t\\n\\x0B\\f\\r]"

OP1_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t FROM documents
), l AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)
  WHERE length(regexp_replace(line, '{_BLANK}+', '', 'g')) > 0 GROUP BY doc_id
), w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(t, '{_BLANK}+'), lambda x: x <> '') AS ws FROM d
), g AS (
  SELECT doc_id, p, ws[p] || ' ' || ws[p + 1] || ' ' || ws[p + 2] AS gram
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS p FROM w)
), r AS (
  SELECT doc_id, count(DISTINCT p + o) AS n_repeat_words
  FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, gram) AS c FROM g), (SELECT unnest([0, 1, 2]) AS o)
  WHERE c > 1 GROUP BY doc_id
), m AS (
  SELECT d.doc_id, d.source, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (doc_id) LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)
), f AS (
  SELECT *, n_words < 50 AS f1, 100 * n_repeat_words > 50 * n_words AS f2, 100 * n_symbols > 10 * n_words AS f3,
    100 * n_dup_lines > 30 * n_lines AS f4, word_chars < 3 * n_words OR word_chars > 10 * n_words AS f5
  FROM m
), c AS (
  SELECT source, rule, count(*)::DOUBLE AS n, sum(failed::INT)::DOUBLE AS k
  FROM (SELECT source, unnest([1, 2, 3, 4, 5]) AS rule, unnest([f1, f2, f3, f4, f5]) AS failed FROM f) GROUP BY ALL
), p AS (
  SELECT rule, avg(k / n) AS mean, var_pop(k / n) AS var FROM c GROUP BY rule
), s AS (
  SELECT rule, mean, CASE WHEN var > 1e-12 AND mean * (1 - mean) / var > 1 THEN mean * (1 - mean) / var - 1 ELSE 20.0 END AS strength FROM p
), h AS (
  SELECT source, bool_or(rate > 0.5 OR rate - 2e0 * sqrt(rate * (1e0 - rate) / (n + strength + 1e0)) > greatest(2e0 * mean, mean + 0.05e0)) AS host_rejected, round(max(rate - mean), 9) AS host_excess
  FROM (SELECT *, (k + mean * strength) / (n + strength) AS rate FROM c JOIN s USING (rule)) GROUP BY source
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, f1 OR f2 AS base_failed,
  NOT (f1 OR f2) AND NOT (host_rejected AND (f1 OR f2 OR f3 OR f4 OR f5)) AS kept, host_rejected, host_excess
FROM f JOIN h ON f.source IS NOT DISTINCT FROM h.source
"""


def _op2_sql() -> str:
    known = ", ".join(f"'{s}': '{i}'" for s, i in SENTENCES.items())
    state = "'<' || array_to_string(ids, '><') || '>'"
    for name, sequence in RULES:
        state = f"replace({state}, '<{'><'.join(sequence)}>', '<={name}>')"
    return rf"""
WITH s AS (
  SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '[;:]*[.!?][.!?;:]*([ \t\n\r]+|\z)', chr(10) || chr(10), 'g'), '[;:]+([ \t\n\r]+|\z)|;', chr(10), 'g'), chr(10)) AS lines FROM documents
), t AS (
  SELECT doc_id, array_to_string(list_transform(lines, lambda x: trim(lower(regexp_replace(x, '[^A-Za-z0-9.]+', ' ', 'g')))), chr(10)) AS said FROM s
), i AS (
  SELECT doc_id, list_transform(regexp_extract_all(said, '{sentence_pattern(SENTENCES)}'), lambda x: MAP {{{known}}}[replace(x, chr(10), ' ')]) AS ids FROM t
), p AS (
  SELECT doc_id, ids, list_filter(regexp_split_to_array({state}, '[<>]+'), lambda x: x <> '') AS parts FROM i
), o AS (
  SELECT doc_id, ids, list_filter(parts, lambda x: starts_with(x, '=')) AS taken, list_filter(parts, lambda x: NOT starts_with(x, '=')) AS rest FROM p
)
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
  array_to_string(list_transform(list_filter(taken, lambda x, k: list_position(taken, x) = k), lambda x: substring(x, 2)), ',') AS licenses,
  array_to_string(rest, ',') AS unmatched_ids, len(ids)::BIGINT AS n_sentences
FROM o
"""


OP10_SQL = rf"""
WITH d AS (
  SELECT *, row_number() OVER () AS page FROM documents
), l AS (
  SELECT page, source, i, line, trim(regexp_replace(line, '{_BLANK}', ' ', 'g')) AS key
  FROM (SELECT page, source, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM d)
), n AS (
  SELECT source, count(*) AS pages FROM documents GROUP BY source
), b AS (
  SELECT l.source, key FROM l JOIN n ON l.source IS NOT DISTINCT FROM n.source WHERE key <> ''
  GROUP BY l.source, key, pages HAVING count(DISTINCT page) >= {MIN_PAGES} AND count(DISTINCT page) > {RATIO}::DOUBLE * pages
), k AS (
  SELECT l.*, b.key IS NOT NULL AS gone FROM l LEFT JOIN b ON l.source IS NOT DISTINCT FROM b.source AND l.key = b.key
), o AS (
  SELECT page, count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped_lines,
    coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS kept
  FROM k GROUP BY page
)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped_lines, 0) AS n_dropped_lines,
  CASE WHEN d.text IS NOT NULL THEN length(kept) END AS n_chars_kept, CASE WHEN d.text IS NOT NULL THEN md5(kept) END AS text_md5
FROM d LEFT JOIN o USING (page)
"""

ORACLE_SQL = {"op1_quality_rules": OP1_SQL, "op2_license_scan": _op2_sql(), "op10_line_dedup": OP10_SQL}
