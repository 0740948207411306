"""Catalogue entries of the training-data problems and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardmill.frames import read_table
from wardmill.llm import leaks, mixture, pieces, pii, sentences, term_counts


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return term_counts.found(read_table(spark, d, "rare_terms"))


def p3_counts(spark: SparkSession, d: str) -> DataFrame:
    return term_counts.marked(read_table(spark, d, "rare_terms"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.found(read_table(spark, d, "documents"))


def p4_sentences(spark: SparkSession, d: str) -> DataFrame:
    return sentences.sentences(read_table(spark, d, "documents"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return pii.found(read_table(spark, d, "content_sections"), read_table(spark, d, "responses"))


def p5_redacted(spark: SparkSession, d: str) -> DataFrame:
    return pii.redact(read_table(spark, d, "content_sections"), read_table(spark, d, "responses"))


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return leaks.found(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p6_near(spark: SparkSession, d: str) -> DataFrame:
    return leaks.find_leaks(read_table(spark, d, "documents"), read_table(spark, d, "eval_items"))


def p7_mix(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(read_table(spark, d, "documents"), read_table(spark, d, "source_weights"))[0]


def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixture.mix(read_table(spark, d, "documents"), read_table(spark, d, "source_weights"))[1]


def p8_pieces(spark: SparkSession, d: str) -> DataFrame:
    return pieces.split_notes(read_table(spark, d, "documents"), read_table(spark, d, "split_limits"))


QUERIES = {f.__name__: f for f in (p3_found, p3_counts, p4_found, p4_sentences, p5_found, p5_redacted, p6_found, p6_near, p7_mix, p7_shares, p8_pieces)}

_COUNTS = """
WITH r AS (SELECT term_id, any_value(tokens) AS tokens FROM rare_terms GROUP BY term_id),
t AS (SELECT term_id, lower(trim(u.tok, ' ' || chr(9) || chr(10) || chr(13) || chr(160) || chr(12288))) AS token FROM r, unnest(r.tokens) AS u(tok)),
k AS (SELECT * FROM t WHERE token <> ''),
n AS (SELECT count(DISTINCT term_id) AS n_records FROM k),
c AS (SELECT token, count(*) AS occurrences, count(DISTINCT term_id) AS records FROM k GROUP BY token),
m AS (SELECT c.*, n_records, records <= 2 AS too_rare, records * 100 > n_records * 2 AS too_common FROM c, n)"""

SQL = {
    "p3_counts": _COUNTS + " SELECT CAST(row_number() OVER (ORDER BY token) - 1 AS BIGINT) AS token_id, * FROM m",
    "p3_found": _COUNTS + " SELECT token, 'too_rare' AS mark FROM m WHERE too_rare UNION ALL SELECT token, 'too_common' AS mark FROM m WHERE too_common",
}
