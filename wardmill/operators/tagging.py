"""Part-of-speech tagging, lemmas and model-based sentence detection.

The models are resources: with one, its layout is used; without, a documented deterministic fallback.
"""

from __future__ import annotations

import functools
import math
import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---- tagger

_FALLBACK = (("cd", r"\d.*"), ("vbg", r".+ing"), ("vbd", r".+ed"), ("rb", r".+ly"), ("jj", r".+(?:ic|al|ous|ive|ful|less)"), ("nns", r".+[^s]s"))
# Closed classes of the fallback tagger.
_CLOSED = {"dt": "a an the this that these those no any".split(), "in": "of in on at by with without for from to since".split(), "cc": "and or but nor".split(), "prp": "i he she it we they you".split(), "vbz": "is has does takes denies reports".split(), "vb": "take stop give start be".split(), "vbp": "are have do".split(), "vbd": "was were had did".split()}
_TAG_OF = {w: t for t, ws in _CLOSED.items() for w in ws}


@functools.lru_cache(1 << 13)
def _fallback_tag(w: str) -> str:
    return _TAG_OF.get(w) or next((t for t, p in _FALLBACK if re.fullmatch(p, w)), "nn" if w[:1].isalnum() else w)


def fallback_tags(words: Sequence[str]) -> list[str]:
    """Tags from closed word classes and endings."""
    return [_fallback_tag(w) for w in words]


def context(words: Sequence[str], tags: Sequence[str], i: int) -> list[str]:
    """The features of a word: itself, its affixes, its shape, its neighbours and the two tags before it."""
    w = words[i]
    raw = w.encode()
    out = ["default", f"w={w}"]
    out += [f"suf={raw[-k:].decode('utf-8', 'ignore')}" for k in range(1, min(4, len(raw)) + 1)] + [f"pre={raw[:k].decode('utf-8', 'ignore')}" for k in range(1, min(4, len(raw)) + 1)]
    out += ["h"] * ("-" in w) + ["c"] * any(c.isupper() for c in w) + ["d"] * any(c.isdigit() for c in w)
    if i:
        out += [f"p={words[i - 1]}", f"t={tags[i - 1]}"]
        if i > 1:
            out += [f"pp={words[i - 2]}", f"t2={tags[i - 2]},{tags[i - 1]}"]
    if i + 1 < len(words):
        out.append(f"n={words[i + 1]}")
        if i + 2 < len(words):
            out.append(f"nn={words[i + 2]}")
    return out


def tag(words: Sequence[str], model: dict | None = None, beam: int = 3) -> list[str]:
    """The best tag sequence of a beam search over a maximum-entropy model {outcomes, weights: feature -> {outcome: w}, prior}."""
    if model is None:
        return fallback_tags(words)
    outcomes = model["outcomes"]
    held: list[tuple[float, list[str]]] = [(0.0, [])]
    for i in range(len(words)):
        grown = []
        for score, tags in held:
            z = [model.get("prior", 0.0)] * len(outcomes)
            for f in context(words, tags, i):
                for o, v in model["weights"].get(f, {}).items():
                    z[outcomes.index(o)] += v
            top = max(z)
            total = math.log(sum(math.exp(v - top) for v in z)) + top
            least = sorted(z, reverse=True)[: beam][-1]
            grown += [(score + v - total, [*tags, o]) for o, v in zip(outcomes, z) if v >= least]
        held = sorted(grown, key=lambda x: -x[0])[:beam]
    return held[0][1] if held else []


# ---- lemmas


def pos_class(tag_: str) -> str:
    t = tag_.lower()
    return "noun" if t.startswith("nn") else "verb" if t.startswith("vb") or t == "md" else "adj" if t.startswith("jj") else "adv" if t.startswith("rb") else ""


@functools.lru_cache(1 << 13)
def normal_form(form: str) -> str:
    """URLs, numbers and repeated punctuation reduced to one spelling."""
    if re.match(r"(?:https?|ftp)://|www\.", form):
        return "#url#"
    if re.fullmatch(r"[+-]?[\d.,:/%-]*\d[\d.,:/%-]*", form):
        return "0"
    form = re.sub(r"\d+", "0", form)
    return re.sub(r"([^\w\s])\1{2,}", r"\1\1", form)


def lemma(form: str, tag_: str, exceptions: dict[str, dict[str, str]], rules: dict[str, list[tuple[str, str]]], bases: dict[str, frozenset[str]], abbreviations: dict[str, str] | None = None) -> str:
    """Number words, then exceptions of the class, then suffix rules that give a known base form, then abbreviations, else the form."""
    w = normal_form(form.lower())
    if tag_.upper() == "CD" and w in bases.get("cardinal", ()):
        return "#crd#"
    if w in bases.get("ordinal", ()) or w in ("0st", "0nd", "0rd", "0th"):
        return "#ord#"
    k = pos_class(tag_)
    if w in exceptions.get(k, {}):
        return exceptions[k][w]
    for suffix, replacement in rules.get(k, ()):
        if w.endswith(suffix) and (base := w[: len(w) - len(suffix)] + replacement) in bases.get(k, ()):
            return base
    return (abbreviations or {}).get(f"{w}_{tag_.upper()}", w)


def with_exceptions(df: DataFrame, form: str, exceptions: DataFrame) -> DataFrame:
    """The frame with ``lemma``: the base of its form in a table of exceptions (form, base), else the form in lower case.

    The table is joined, so it may have any size; the optimizer broadcasts it if it is small.
    """
    table = exceptions.groupBy(F.lower("form").alias("__form")).agg(F.min("base").alias("__base"))
    return df.join(table, F.lower(df[form]) == table["__form"], "left").withColumn("lemma", F.coalesce("__base", F.lower(F.col(form)))).drop("__form", "__base")


def lemma_column(form: Column, tag_: Column, exceptions: dict[str, dict[str, str]], rules: dict[str, list[tuple[str, str]]], bases: dict[str, frozenset[str]], abbreviations: dict[str, str] | None = None) -> Column:
    """``lemma`` in Arrow batches; each distinct pair of form and tag of a batch is worked out once."""

    @F.pandas_udf("string")
    def run(forms, tags):
        known: dict[tuple, str | None] = {}
        for pair in set(zip(forms, tags)):
            known[pair] = lemma(pair[0], pair[1] or "", exceptions, rules, bases, abbreviations) if pair[0] is not None else None
        return forms.__class__([known[p] for p in zip(forms, tags)], dtype=object)

    return run(form, tag_)


def tag_column(words: Column, model: dict | None = None) -> Column:
    """The tags of an array of lower-case words, in Arrow batches; equal sentences of a batch are read once."""

    @F.pandas_udf("array<string>")
    def run(column):
        known: dict[tuple, list[str]] = {}
        keys = [tuple(w) if w is not None else () for w in column]
        for k in set(keys):
            known[k] = tag(list(k), model)
        return column.__class__([known[k] for k in keys], dtype=object)

    return run(words)


# ---- sentences


def split_fallback(text: str) -> list[tuple[int, int]]:
    """Sentences end at . ! ? before white space, and at line ends; spans are trimmed."""
    out, a = [], 0
    for m in re.finditer(r"(?<=[.!?])\s+|\n+", text):
        out.append((a, m.start()))
        a = m.end()
    out.append((a, len(text)))
    return [(a + len(text[a:b]) - len(text[a:b].lstrip()), a + len(text[a:b].rstrip())) for a, b in out if text[a:b].strip()]


def fallback_ends(text: Column) -> Column:
    """The ends of the sentences of ``split_fallback``, natively. White space stands for what Java's \\s matches."""
    parts = F.split(F.regexp_replace(F.regexp_replace(text, r"(\n+)", "$1\x02"), r"(?<=[.!?])(\s+)", "$1\x02"), "\x02")
    walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("ends")), lambda s, p: F.struct((s["at"] + F.length(p)).alias("at"), F.when(F.trim(F.regexp_replace(p, r"\s", "")) == "", s["ends"]).otherwise(F.array_append(s["ends"], s["at"] + F.length(F.regexp_replace(p, r"\s+$", "")))).alias("ends")))
    return walked["ends"]


def char_features(text: str, i: int, previous: str) -> list[str]:
    """Classes and identities of the characters around i, the words around it, and the previous outcome."""
    out = [f"prev={previous}", "bias"]
    for k in range(-3, 4):
        c = text[i + k] if 0 <= i + k < len(text) else ""
        out += [f"char{k}={c}", f"class{k}={unicodedata.category(c) if c else ''}"]
    left, right = text[:i].split()[-1:], text[i + 1 :].split()[:1]
    out += [f"left={left[0].lower()}"] * len(left) + [f"right={right[0].lower()}", f"cap={right[0][:1].isupper()}"] * bool(right)
    return out


def split_model(text: str, model: dict | None = None) -> list[tuple[int, int]]:
    """Sentence spans by a linear begin/inside/outside classifier over characters {weights: feature -> [B, I, O]}; without a model the fallback."""
    if model is None:
        return split_fallback(text)
    out: list[tuple[int, int]] = []
    begin, previous = -1, "O"
    for i, c in enumerate(text):
        if previous != "O" and c.isalnum():
            label = "I"
        else:
            z = [0.0, 0.0, 0.0]
            for f in char_features(text, i, previous):
                for k, v in enumerate(model["weights"].get(f, (0, 0, 0))):
                    z[k] += v
            label = "BIO"[max(range(3), key=lambda k: z[k])]
        if label == "O" and begin >= 0 or label == "B" and begin >= 0:
            out.append((begin, i))
            begin = -1
        if label == "B" or label == "I" and begin < 0:
            begin = i
        previous = label
    if begin >= 0:
        out.append((begin, len(text)))
    return [(a + len(text[a:b]) - len(text[a:b].lstrip()), a + len(text[a:b].rstrip())) for a, b in out if text[a:b].strip()]
