"""Catalogue entries of the general data problems, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.frames import read_table
from wardmill.operators import nested, rejects


def _shredded(spark: SparkSession, d: str, levels=nested.CLINICAL, **more) -> nested.Shredded:
    return nested.Shredded(nested.shred(read_table(spark, d, "responses"), "response_id", "payload", [F.col("received_at")], levels, **more), "response_id", levels)


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, nested.CLINICAL_KEYS).nodes()


def p1_responses(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, keep=("response",), root=nested.ROOT).table("response")


def p1_sections(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, keep=("section",)).table("section")


def p1_concepts(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, keep=("concept",)).table("concept")


def p1_schemes(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, keep=("sab",)).table("sab")


def p1_codes(spark: SparkSession, d: str) -> DataFrame:
    return _shredded(spark, d, keep=("vocab",)).table("vocab")


def p1_paths(spark: SparkSession, d: str) -> DataFrame:
    """The repeated ancestors that the payloads hold, found from their paths, with their columns."""
    return nested.ancestors(read_table(spark, d, "responses"), "payload")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    both = [rejects.rejected(read_table(spark, d, s.name), s) for s in (rejects.TERMS, rejects.RULES)]
    return both[0].unionByName(both[1]).select("table_name", "line_id", "reason")


def p2_terms(spark: SparkSession, d: str) -> DataFrame:
    return rejects.accepted(read_table(spark, d, "term_lines"), rejects.TERMS).withColumn("tui", F.array_join("tui", ","))


def p2_rules(spark: SparkSession, d: str) -> DataFrame:
    return rejects.accepted(read_table(spark, d, "rule_lines"), rejects.RULES)


QUERIES = {f.__name__: f for f in (p1_found, p1_responses, p1_paths, p1_sections, p1_concepts, p1_schemes, p1_codes, p2_found, p2_terms, p2_rules)}

_FIELD = r"""("(?:[^"]|"")*"|[^"|][^|]*|)"""
_LINES = """
WITH l AS (SELECT DISTINCT line_id, regexp_replace(line, '\\r$', '') AS s FROM {table}
           WHERE line IS NOT NULL),
     k AS (SELECT line_id, s, regexp_full_match(s, '(?s){f}(?:\\|{f})*') AS quoted_well,
                  regexp_extract_all('|' || s, '(?s)\\|{f}', 1) AS f
           FROM l WHERE trim(s, ' ' || chr(9)) <> '' AND NOT starts_with(s, '#') AND NOT starts_with(s, '//'))"""
_CLEAN = """CASE WHEN starts_with({x}, '"') THEN replace({x}[2:-2], '""', '"') ELSE {x} END"""


def _lines(table: str) -> str:
    return _LINES.format(table=table, f=_FIELD)


def _found_sql(table: str, n: int, tests: str) -> str:
    return f"""SELECT '{table}' AS table_name, line_id, reason FROM ({_lines(table)}
SELECT line_id, CASE WHEN NOT quoted_well THEN 'quoting' WHEN len(f) <> {n} THEN 'column_count' {tests} END AS reason FROM k) WHERE reason IS NOT NULL"""


_UNQUOTED = {i: _CLEAN.format(x=f"f[{i}]") for i in range(1, 8)}
_TERM_TESTS = f"""WHEN NOT regexp_full_match(trim({_UNQUOTED[1]}), '[Cc][0-9]{{7}}') THEN 'bad_cui'
 WHEN NOT regexp_full_match(trim({_UNQUOTED[2]}), '[Tt][0-9]{{3}}|\\[ *[Tt][0-9]{{3}} *(?:, *[Tt][0-9]{{3}} *)*\\]') THEN 'bad_tui'
 WHEN trim({_UNQUOTED[6]}) = '' THEN 'empty_str'
 WHEN regexp_matches(s, '[\\x00-\\x1f\\x7f-\\x{{9f}}\\x{{fffd}}]') THEN 'bad_chars'"""
_RULE_TESTS = f"""WHEN {_UNQUOTED[1]} = '' OR NOT regexp_full_match({_UNQUOTED[1]} || {_UNQUOTED[2]}, '[\\p{{L}}''’-]*') THEN 'bad_rule'"""

_TERM_COLUMNS = {"cui": f"upper(trim({_UNQUOTED[1]}))", "tui": f"upper(regexp_replace({_UNQUOTED[2]}, '[\\[\\]\\s]', '', 'g'))", **{c: _UNQUOTED[i] for i, c in enumerate(("tty", "code", "sab", "str", "pref"), 3)}}
SQL = {
    "p2_terms": f"""SELECT line_id, arg_min(r, r.loaded_at).file_path AS file_path, arg_min(r, r.loaded_at).line_no AS line_no, {", ".join(f"any_value(r.{c}) AS {c}" for c in _TERM_COLUMNS)} FROM (SELECT line_id, {{'loaded_at': t.loaded_at, 'file_path': regexp_replace(regexp_replace(t.file_path, '/+', '/', 'g'), '^\\./', ''), 'line_no': t.line_no, {", ".join(f"'{c}': {x}" for c, x in _TERM_COLUMNS.items())}}} AS r FROM (
{_lines("term_lines")} SELECT *, CASE WHEN NOT quoted_well THEN 'quoting' WHEN len(f) <> 7 THEN 'column_count' {_TERM_TESTS} END AS reason FROM k) JOIN term_lines t USING (line_id) WHERE reason IS NULL) GROUP BY line_id""",
    "p2_found": _found_sql("term_lines", 7, _TERM_TESTS) + "\nUNION ALL\n" + _found_sql("rule_lines", 2, _RULE_TESTS),
    "p2_rules": f"""SELECT line_id, any_value(file_path) AS file_path, any_value(line_no) AS line_no, any_value(suffix) AS suffix, any_value(replacement) AS replacement FROM (
{_lines("rule_lines")} SELECT k.line_id, regexp_replace(regexp_replace(t.file_path, '/+', '/', 'g'), '^\\./', '') AS file_path, t.line_no, {_UNQUOTED[1]} AS suffix, {_UNQUOTED[2]} AS replacement
FROM k JOIN rule_lines t USING (line_id) WHERE quoted_well AND len(f) = 2 AND {_UNQUOTED[1]} <> '' AND regexp_full_match({_UNQUOTED[1]} || {_UNQUOTED[2]}, '[\\p{{L}}''’-]*')) GROUP BY line_id""",
}
