"""Bar-separated lines: sound ones as typed records, the others with a located reason.

A recursive-descent grammar reads ``record := field ('|' field)*``, ``field := quoted | bare``. When a
quoted field isn't closed, the parser records where it broke and resumes at the next anchor, a place
where a record is known to start: in a table of lines that is the next row, in a whole file the next
line whose head passes the scheme's anchor test. So one broken quote costs one record.

Defined cases: null and blank lines, and lines that begin with ``#`` or ``//``, are skipped; one
carriage return at the end isn't part of a line; lines that share an id are one; an empty table gives
empty results.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmill.frames import first_per_key

_CUI = re.compile(r"[Cc][0-9]{7}\Z")
_TUI = re.compile(r"[Tt][0-9]{3}\Z")
_BAD_CHAR = re.compile("[\x00-\x1f\x7f-\x9f�]")
_PLAIN_RULE = re.compile(r"[A-Za-z'\-]*\Z")


def _term_reason(fields: list[str], line: str) -> tuple[str, int] | None:
    if not _CUI.match(fields[0].strip()):
        return "bad_cui", 0
    t = fields[1].strip()
    many = t[1:-1].split(",") if t[:1] == "[" and t[-1:] == "]" else [t]
    if not all(_TUI.match(x.strip()) for x in many):
        return "bad_tui", 1
    if not fields[5].strip():
        return "empty_str", 5
    if _BAD_CHAR.search(line):
        return "bad_chars", next(i for i, f in enumerate([*fields, line]) if _BAD_CHAR.search(f))
    return None


def _rule_reason(fields: list[str], line: str) -> tuple[str, int] | None:
    if not fields[0]:
        return "bad_rule", 0
    for i, f in enumerate(fields):
        if not _PLAIN_RULE.match(f) and not all(c in "-'’" or unicodedata.category(c)[0] == "L" for c in f):
            return "bad_rule", i
    return None


@dataclass(frozen=True)
class Scheme:
    """Columns of a file, the test of a parsed record, and the head that only a record's start has."""

    name: str
    columns: tuple[str, ...]
    test: Callable[[list[str], str], tuple[str, int] | None]
    anchor: re.Pattern[str]


TERMS = Scheme("term_lines", ("CUI", "TUI", "TTY", "CODE", "SAB", "STR", "PREF"), _term_reason, re.compile(r"\s*[Cc][0-9]{7}\s*\|\s*(?:[Tt][0-9]{3}|\[[^\]|]*\])\s*\|"))
RULES = Scheme("rule_lines", ("suffix", "replacement"), _rule_reason, re.compile(r"[^\W\d_][^|\s]*\|[^|\s]*\s*$", re.M))


class Broken(Exception):
    """A syntax error at a character of the line."""

    def __init__(self, at: int, why: str):
        super().__init__(why)
        self.at = at


def read_record(s: str, i: int, end: int) -> tuple[list[str], list[int]]:
    """record := field ('|' field)*, up to ``end``. The fields and where each begins."""
    fields, begins = [], []
    while True:
        begins.append(i)
        value, i = read_quoted(s, i, end) if s.startswith('"', i, end) else read_bare(s, i, end)
        fields.append(value)
        if i == end:
            return fields, begins
        i += 1  # the bar


def read_bare(s: str, i: int, end: int) -> tuple[str, int]:
    j = s.find("|", i, end)
    j = end if j < 0 else j
    return s[i:j], j


def read_quoted(s: str, i: int, end: int, behind: str = "|") -> tuple[str, int]:
    j, parts = i + 1, []
    while True:
        k = s.find('"', j, end)
        if k < 0:
            raise Broken(i, "quote not closed")
        parts.append(s[j:k])
        if s.startswith('"', k + 1, end):
            parts.append('"')
            j = k + 2
            continue
        if k + 1 != end and s[k + 1] not in behind:
            raise Broken(k + 1, "text after the closing quote")
        return "".join(parts), k + 1


def judge(line: str | None, scheme: Scheme) -> tuple[str, list[str] | None, int] | None:
    """None for a skipped line; else (reason or '', fields of a sound line, where it broke)."""
    if line is None:
        return None
    if line.endswith("\r"):
        line = line[:-1]
    if not line.strip() or line.startswith(("#", "//")):
        return None
    try:
        fields, begins = read_record(line, 0, len(line))
    except Broken as e:
        return "quoting", None, e.at
    return graded(fields, begins, line, scheme)


def graded(fields: list[str], begins: list[int], line: str, scheme: Scheme, begin: int = 0) -> tuple[str, list[str] | None, int]:
    """(reason or '', fields, where it broke) of a record that is sound in its syntax. Line breaks in quoted fields are no bad characters."""
    if len(fields) != len(scheme.columns):
        return "column_count", None, begins[min(len(begins), len(scheme.columns) + 1) - 1] - begin
    bad = scheme.test(fields, line.replace("\r\n", " ").replace("\n", " ") if "\n" in line else line)
    return (bad[0], None, begins[min(bad[1], len(begins) - 1)] - begin) if bad else ("", fields, 0)


def parse_file(text: str, scheme: Scheme) -> Iterator[tuple[int, str, list[str] | None, int]]:
    """(line number, reason or '', fields, offset of the error) of the records of a whole file.

    A quoted field may hold line breaks here, which stay as they are. The record must end before the next
    line that starts like a record (the anchor): if a quote isn't closed by then, or text follows its close,
    the record is broken and reading resumes at the next line. The next anchor is looked for once, so a file
    is read in linear time as long as its records are short.
    """
    n, i, size, anchor = 0, 0, len(text), -1
    while i < size:
        n += 1
        end = text.find("\n", i)
        end = size if end < 0 else end
        took, got = 0, judge(text[i:end], scheme)
        if got and got[0] == "quoting" and end < size:
            if anchor <= i:
                anchor = _next_anchor(text, end + 1, scheme)
            try:
                fields, begins, far = read_lines(text, i, anchor - 1)
                got, took, end = graded(fields, begins, text[i:far], scheme, i), text.count("\n", i, far), far
            except Broken:
                pass
        if got:
            yield n, got[0], got[1], i + got[2]
        n, i = n + took, end + 1


def _next_anchor(text: str, i: int, scheme: Scheme) -> int:
    """The place of the next line, from ``i`` on, that starts like a record; behind the text if there is none."""
    while i < len(text):
        if scheme.anchor.match(text, i):
            return i
        j = text.find("\n", i)
        if j < 0:
            break
        i = j + 1
    return len(text) + 1


def read_lines(s: str, i: int, end: int) -> tuple[list[str], list[int], int]:
    """A record from i on that may cross lines inside quotes: fields, where they begin, and where it ends."""
    fields, begins = [], []
    while True:
        begins.append(i)
        if s.startswith('"', i, end):
            value, i = read_quoted(s, i, end, "|\r\n")
        else:
            j = min((k for k in (s.find("|", i, end), s.find("\n", i, end)) if k >= 0), default=end)
            value, i = s[i:j], j
        fields.append(value)
        if i >= end or s[i] != "|":
            if fields[-1].endswith("\r"):
                fields[-1] = fields[-1][:-1]
            while i < end and s[i] == "\r":
                i += 1
            return fields, begins, i
        i += 1


def parse_files(df: DataFrame, path: str, text: str, scheme: Scheme) -> DataFrame:
    """path, line_no, reason (null if sound), error_at, fields of the records of whole files, one file (or block of whole lines) a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(k, *r) for k, content in enumerate(b.column(1).to_pylist()) for r in parse_file(content or "", scheme)]
            at, no, reason, fields, where = zip(*rows) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int32())), pa.array(no, pa.int32()), pa.array([r or None for r in reason], pa.string()), pa.array([w if r else None for r, w in zip(reason, where)], pa.int32()), pa.array(fields, pa.list_(pa.string()))], names=[path, "line_no", "reason", "error_at", "fields"])

    return df.select(path, text).mapInArrow(run, f"`{path}` {df.schema[path].dataType.simpleString()}, line_no int, reason string, error_at int, fields array<string>")


def read_files(spark: SparkSession, path: str, scheme: Scheme) -> DataFrame:
    """``parse_files`` of the files under a path; a file is read by one task."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file_path"), F.col("value").alias("content"))
    return parse_files(files, "file_path", "content", scheme)


def parse_lines(df: DataFrame, scheme: Scheme) -> DataFrame:
    """Each line that isn't skipped: line_id, file_path, line_no, line, fields (null if broken), reason (null if sound), error_at."""
    base = df.select("line_id", F.regexp_replace(F.regexp_replace("file_path", "/+", "/"), r"^\./", "").alias("file_path"), "line_no", "line", "loaded_at")
    kind = base.schema["loaded_at"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, fields, reasons, where = [], [], [], []
            for k, line in enumerate(b.column(3).to_pylist()):
                got = judge(line, scheme)
                if got is not None:
                    at.append(k)
                    reasons.append(got[0] or None)
                    fields.append(got[1])
                    where.append(got[2] if got[0] else None)
            yield pa.RecordBatch.from_arrays([*[c.take(pa.array(at, pa.int32())) for c in b.columns], pa.array(fields, pa.list_(pa.string())), pa.array(reasons, pa.string()), pa.array(where, pa.int32())], names=[*b.schema.names, "fields", "reason", "error_at"])

    return base.mapInArrow(run, f"line_id long, file_path string, line_no int, line string, loaded_at {kind}, fields array<string>, reason string, error_at int")


def rejected(df: DataFrame, scheme: Scheme) -> DataFrame:
    """The lines that can't be loaded, once per line_id: table_name, line_id, file_path, line_no, line, reason, error_at."""
    bad = parse_lines(df, scheme).filter(F.col("reason").isNotNull()).drop("fields")
    return first_per_key(bad, "line_id", [F.col("loaded_at")]).select(F.lit(scheme.name).alias("table_name"), "line_id", "file_path", "line_no", "line", "reason", "error_at")


def accepted(df: DataFrame, scheme: Scheme) -> DataFrame:
    """The sound lines as typed columns, once per line_id. CUI and TUI come upper-case and without outer spaces, TUI as a list."""
    good = parse_lines(df, scheme).filter(F.col("reason").isNull()).drop("reason", "error_at", "line")
    good = first_per_key(good, "line_id", [F.col("loaded_at")])
    cols = []
    for i, c in enumerate(scheme.columns):
        v = F.col("fields")[i]
        if c == "CUI":
            v = F.upper(F.trim(v))
        elif c == "TUI":
            v = F.transform(F.split(F.regexp_replace(v, r"[\[\]\s]", ""), ","), F.upper)
        cols.append(v.alias(c.lower()))
    return good.select("line_id", "file_path", "line_no", *cols)
