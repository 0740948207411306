"""Tokenizers: the clinical one for notes, the simpler one for vocabulary terms, and token shapes."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Word parts that decide where a token ends.
_PARTED = {"cannot": (3, 3), "gonna": (3, 2), "gotta": (3, 2), "lemme": (3, 2), "wanna": (3, 2), "whaddya": (3, 2, 2), "whatcha": (3, 1, 3)}
_PREFIXES = frozenset("e- a- u- x- agro- ante- anti- arch- be- bi- bio- co- counter- cross- cyber- de- eco- ex- extra- inter- intra- macro- mega- micro- mid- mini- multi- neo- non- over- pan- para- peri- post- pre- pro- pseudo- quasi- re- semi- sub- super- tri- ultra- un- uni- vice- electro- gasto- homo- hetero- ortho- phospho-".split())
_SUFFIXES = frozenset("-esque -ette -fest -fold -gate -itis -less -most -o-torium -rama -wise".split())
_KEPT = frozenset("mm-hm mm-mm o-kay uh-huh uh-oh".split())
_CONTRACTED = ("'s", "'ve", "'re", "'ll", "'d", "'n", "n't")


@dataclass(frozen=True)
class Token:
    begin: int
    end: int
    text: str
    kind: str  # word, number, punct, symbol, newline
    shape: str


def low(s: str) -> str:
    """Lower case letter by letter, so that no offset moves."""
    return s.lower() if s.isascii() else "".join(x if len(x := c.lower()) == 1 else c for c in s)


@functools.lru_cache(1 << 13)
def shape(s: str) -> str:
    return "".join("d" if unicodedata.category(c) == "Nd" else "X" if c.isupper() else "x" for c in s)


def _class(c: str) -> str:
    k = unicodedata.category(c)
    return "number" if k == "Nd" else "word" if k[0] == "L" else "punct" if k[0] == "P" else "symbol"


_alnum = str.isalnum
_PHONE = re.compile(r"(?:\(\d{3}\) ?|\d{3}[-./])\d{3}[-.]\d{4}(?![\w])|\d{3}-\d{4}(?![\w-])|\d{2}-\d{3}(?![\w-])")
_POSTAL = re.compile(r"\d{5}-\d{4}(?![\w-])")
_URL = re.compile(r"(?:https?://|ftp://|mailto:)\S+", re.I)
_EMAIL = re.compile(r"[A-Za-z0-9_+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_ABBREV = re.compile(r"(?:[^\W\d_]\.)+(?:[^\W\d_]\.?)?")
_NUMBER = re.compile(r"\d{1,3}(?:,\d{3})+(?:\.\d+)?(?!\w)|\d+\.\d+(?!\w)")


def _hyphenated(word: str, first: int) -> int:
    """The length of the token that a word with a hyphen at ``first`` begins with: more than ``first`` if the hyphen is kept."""
    ends, at = [], first
    while len(ends) < 2 and at < len(word):
        at = next((k for k in range(at + 1, len(word)) if not _alnum(word[k])), len(word))
        ends.append(at)
    second, third = ends[0], ends[-1]
    double = second < len(word) and word[second] == "-"
    tail = double and word[second:third] in _SUFFIXES
    if double and word[first:third] in _SUFFIXES:
        return third
    if word[first:second] in _SUFFIXES or word[:second] in _KEPT and tail:
        return third if tail else second
    if word[: first + 1] in _PREFIXES:
        return third if tail or double and word[first + 1 : third] in _KEPT else second
    return second if word[:second] in _KEPT else first


def tokenize(text: str, offset: int = 0) -> list[Token]:
    """Tokens of one sentence; ``offset`` is where it begins in the document."""
    out: list[Token] = []
    n, i = len(text), 0

    def emit(a: int, b: int, kind: str) -> int:
        s = text[a:b]
        out.append(Token(offset + a, offset + b, low(s), kind, shape(s)))
        return b

    def mixed(a: int, b: int) -> str:
        return "word" if any(unicodedata.category(c)[0] == "L" for c in text[a:b]) else "number"

    while i < n:
        c = text[i]
        if c in " \t":
            i += 1
        elif c in "\r\n":
            i = emit(i, i + (2 if text.startswith("\r\n", i) else 1), "newline")
        elif i == n - 1:
            i = emit(i, i + 1, "symbol")
        elif text[i + 1] in " \t\r\n":
            i = emit(i, i + 1, _class(c))
        elif not _alnum(c):
            if c == "." and (m := re.compile(r"\.\d+").match(text, i)):
                i = emit(i, m.end(), "number")
            elif text.startswith("...", i):
                i = emit(i, i + 3, "punct")
            elif c == "'" and low(text[i : i + 4]) in ("'tis", "'twa"):
                i = emit(i, i + 2, "word")
            else:
                i = emit(i, i + 1, "punct" if c in "-'" else _class(c))
        else:
            stop = next((k for k in range(i, n) if text[k] in " \t\r\n"), n)
            j = next((k for k in range(i, stop) if not _alnum(text[k])), stop)
            word = low(text[i:j])
            if j == stop and word in _PARTED:
                for size in _PARTED[word]:
                    i = emit(i, i + size, "word")
            elif j == stop:
                i = emit(i, j, mixed(i, j))
            elif text[j] in "'’" and (m := next((x for x in _CONTRACTED if low(text[j : j + len(x)]).replace("’", "'") == x and not _alnum(text[j + len(x) : j + len(x) + 1] or " ")), None)):
                i = emit(emit(i, j, mixed(i, j)), j + len(m), "word")
            elif text[j] in "'’" and word.endswith("n") and low(text[j + 1 : j + 2]) == "t" and not _alnum(text[j + 2 : j + 3] or " ") and j - 1 > i:
                i = emit(emit(i, j - 1, "word"), j + 2, "word")
            elif m := _PHONE.match(text, i) or _POSTAL.match(text, i):
                i = emit(i, m.end(), "number")
            elif m := _URL.match(text, i) or _EMAIL.match(text, i):
                i = emit(i, m.end(), "word")
            elif (m := _ABBREV.match(text, i)) and m.end() - i > 2 and not _alnum(text[m.end() : m.end() + 1] or " "):
                i = emit(i, m.end(), "word")
            elif text[j] == "-" and (e := _hyphenated(low(text[i:stop]), j - i)) > j - i:
                i = emit(i, i + e, mixed(i, i + e))
            elif m := _NUMBER.match(text, i):
                i = emit(i, m.end(), "number")
            else:
                i = emit(i, j, mixed(i, j))
    return out


def term_tokens(term: str) -> list[str]:
    """Tokens of a vocabulary term. They differ from those of notes: phone-like or dotted texts fall apart."""
    out: list[str] = []
    for part in term.lower().split():
        held = ""
        for k, c in enumerate(part):
            rest = part[k + 1 :]
            right = re.match(r"\w*", rest)[0]
            if _alnum(c):
                held += c
            elif c == "-" and held and (held + "-" in _PREFIXES or "-" + right in _SUFFIXES):
                held += c
            elif c == "'" and rest == "s" or c == "." and len(rest) == 1 and rest.isdigit():
                out += [held] * bool(held)
                held = c
            else:
                out += [held] * bool(held) + [c]
                held = ""
        out += [held] * bool(held)
    return out


TOKEN = "array<struct<begin:int,end:int,text:string,kind:string,shape:string>>"


def with_tokens(df: DataFrame, text: str = "text", offset: str | None = None) -> DataFrame:
    """The frame with a column ``tokens``; one Arrow pass, no shuffle. A null text has no tokens."""
    kind = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32()), ("text", pa.string()), ("kind", pa.string()), ("shape", pa.string())]))
    at, off = df.columns.index(text), df.columns.index(offset) if offset else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            offsets = b.column(off).to_pylist() if off is not None else [0] * len(texts)
            made = [[vars(t) for t in tokenize(x or "", o or 0)] for x, o in zip(texts, offsets)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, kind)], names=[*b.schema.names, "tokens"])

    return df.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + f", tokens {TOKEN}")


def simple_tokens(text: Column) -> Column:
    """ASCII words and numbers in lower case, natively."""
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def plain_tokens(text: Column) -> Column:
    """Words and numbers of any script in lower case, natively: runs of letters, marks and digits."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def shape_of(text: Column) -> Column:
    """The shape of a token, natively."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(text, r"[^\p{Lu}\p{Nd}]", "x"), r"\p{Lu}", "X"), r"\p{Nd}", "d")
