"""Smoking status of sentences and documents."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill import resources as R
from wardmill.frames import spread
from wardmill.functions.tokens import tokenize
from wardmill.operators.attributes import is_negative

#: From the strongest to the weakest.
STATUSES = ("CURRENT_SMOKER", "PAST_SMOKER", "SMOKER", "NON_SMOKER", "UNKNOWN")


_OPENERS = frozenset("no none never quit smoked :".split())


def adjusted(sentences: Sequence[tuple[int, int, str]], openers: frozenset[str] = _OPENERS, quirks: bool = False) -> list[tuple[int, int, str]]:
    """Sentences (begin, end, text) in order of their spans; one that ends with a colon takes in the next if that begins with a status word.

    With ``quirks`` the two are joined without the white space between, and a pair that isn't joined gives
    its second sentence twice.
    """
    out: list[tuple[int, int, str]] = []
    held: tuple[int, int, str] | None = None
    for b, e, s in sorted(sentences):
        if held is not None and held[2].rstrip().endswith(":"):
            words = [t.text for t in tokenize(s.lstrip())[:1]]
            if words and words[0] in openers:
                held = (held[0], e, held[2] + ("" if quirks else " " * max(0, b - held[1])) + s)
                continue
            out.append(held)
            if quirks:
                out.append((b, e, s))
            held = (b, e, s)
            continue
        if held is not None:
            out.append(held)
        held = (b, e, s)
    if held is not None:
        out.append(held)
    return out


def merge_sentences(sentences: Sequence[str], openers: frozenset[str] = _OPENERS, quirks: bool = False) -> list[str]:
    """``adjusted`` for sentences that stand a space apart."""
    at, placed = 0, []
    for s in sentences:
        placed.append((at, at + len(s), s))
        at += len(s) + 1
    return [s for _, _, s in adjusted(placed, openers, quirks)]


def svm_predict(x: Sequence[float], model: dict) -> float:
    """A libsvm model's answer: one-against-one votes for classes, a sum for regression."""

    def kernel(v: Sequence[float]) -> float:
        dot = sum(a * b for a, b in zip(x, v))
        k, g, c0 = model.get("kernel", "linear"), model.get("gamma", 1.0), model.get("coef0", 0.0)
        if k == "poly":
            return (g * dot + c0) ** model.get("degree", 3)
        if k == "rbf":
            return math.exp(-g * sum((a - b) ** 2 for a, b in zip(x, v)))
        if k == "sigmoid":
            return math.tanh(g * dot + c0)
        if k == "precomputed":
            return x[int(v[0])]
        return dot

    ks = [kernel(v) for v in model["vectors"]]
    if "labels" not in model:
        return sum(c * k for c, k in zip(model["coefficients"][0], ks)) - model["rho"][0]
    starts, n = [0], len(model["labels"])
    for c in model["counts"]:
        starts.append(starts[-1] + c)
    votes, p = [0] * n, 0
    for i in range(n):
        for j in range(i + 1, n):
            s = sum(model["coefficients"][j - 1][k] * ks[k] for k in range(starts[i], starts[i + 1])) + sum(model["coefficients"][i][k] * ks[k] for k in range(starts[j], starts[j + 1])) - model["rho"][p]
            votes[i if s > 0 else j] += 1
            p += 1
    return model["labels"][max(range(n), key=lambda k: (votes[k], -k))]


def svm_labels(x: np.ndarray, model: dict) -> np.ndarray:
    """``svm_predict`` of many rows by matrix products."""
    vectors, g, c0 = np.asarray(model["vectors"], float), model.get("gamma", 1.0), model.get("coef0", 0.0)
    kind = model.get("kernel", "linear")
    if kind == "precomputed":
        ks = x[:, vectors[:, 0].astype(int)]
    elif kind == "rbf":
        ks = np.exp(-g * ((x**2).sum(axis=1)[:, None] + (vectors**2).sum(axis=1) - 2 * x @ vectors.T))
    else:
        dot = x @ vectors.T
        ks = (g * dot + c0) ** model.get("degree", 3) if kind == "poly" else np.tanh(g * dot + c0) if kind == "sigmoid" else dot
    weights = np.asarray(model["coefficients"], float)
    if "labels" not in model:
        return ks @ weights[0] - model["rho"][0]
    starts = np.concatenate([[0], np.cumsum(model["counts"])])
    n, p = len(model["labels"]), 0
    votes = np.zeros((len(x), n), int)
    for i in range(n):
        for j in range(i + 1, n):
            a, b = slice(starts[i], starts[i + 1]), slice(starts[j], starts[j + 1])
            first = ks[:, a] @ weights[j - 1, a] + ks[:, b] @ weights[i, b] - model["rho"][p] > 0
            votes[:, i] += first
            votes[:, j] += ~first
            p += 1
    return np.asarray(model["labels"])[votes.argmax(axis=1)]


def svm_column(x: Column, model: dict) -> Column:
    """The label of each row's feature array."""

    @F.pandas_udf("int")
    def run(column):
        return column.__class__(svm_labels(np.stack(column.to_list()), model) if len(column) else [], dtype="int32")

    return run(x)


_DATE = re.compile(r"19\d\d|20\d\d|[1-9]0s|\d{1,2}[/-]\d{1,2}")


def smoker_features(words: Sequence[str], sentence: str, go_words: Sequence[str] = R.SMOKING_GO_WORDS) -> list[float]:
    """Presence of each go-word (pairs are joined by a low line) and of a date."""
    words = [w for x in words for w in re.sub("-{2,}", " ", x).split() if w not in R.SMOKING_STOP_WORDS]
    have = set(words) | {f"{a}_{b}" for a, b in zip(words, words[1:])}
    dated = any(_DATE.search(x) for x in re.sub(r"[.?!:;()',\"{}<>#+]", " ", sentence).split())
    return [float(w in have) for w in go_words] + [float(dated)]


def smoker_kind(words: Sequence[str], model: dict | None = None, sentence: str | None = None) -> str:
    """CURRENT, PAST or SMOKER. With a model, an SVM over ``smoker_features`` (of its own ``words``, if it names some); else by cue words."""
    if model:
        label = svm_predict(smoker_features(words, " ".join(words) if sentence is None else sentence, model.get("words", R.SMOKING_GO_WORDS)), model)
        return {1: "CURRENT_SMOKER", 2: "PAST_SMOKER", 3: "SMOKER"}.get(int(label), "UNKNOWN")
    have = set(words)
    if have & {"quit", "quits", "stopped", "former", "past", "previously", "ex-smoker", "exsmoker", "discontinued", "ago"}:
        return "PAST_SMOKER"
    return "CURRENT_SMOKER" if have & {"currently", "continues", "still", "smokes", "current"} else "SMOKER"


def sentence_status(sentence: str, model: dict | None = None, quirks: bool = True) -> str:
    """The status that one sentence states.

    ``quirks``: phrases such as "smoke detector" don't exclude a sentence.
    """
    tokens = tokenize(sentence)
    words = [t.text for t in tokens]
    low = sentence.lower()
    if not any(w in R.SMOKING_KNOWN for w in words):
        return "UNKNOWN"
    if not quirks and any(p in low for p in ("smoke detector", "tobacco distributor")):
        return "UNKNOWN"
    if any(p in low for p in R.NON_SMOKER):
        return "NON_SMOKER"
    negative = False
    for phrase in R.SMOKER:
        at = -1
        while (at := low.find(phrase, at + 1)) >= 0:
            negative = negative or is_negative(tokens, at, at + len(phrase), 7, 7, R.SMOKING_BOUNDARY)
    if negative and not contradictions(sentence):
        return "NON_SMOKER"
    return smoker_kind([t.text for t in tokens if t.kind == "word"], model, sentence)


def contradictions(sentence: str) -> int:
    """Words between marks and spaces that contradict a negation."""
    return sum(w in R.SMOKING_CONTRADICTION for w in re.split(r"\W+", sentence.lower()))


def strongest(statuses: Sequence[str]) -> str:
    return next((s for s in STATUSES if s in statuses), "UNKNOWN")


def document(text: str, spans: Sequence[tuple[int, int]], model: dict | None = None, quirks: bool = False) -> dict:
    """The status of a note and its sentences, as the response has them; ``spans`` are its sentences."""
    listed = [(sentence_status(s, model), s, b, e) for b, e, s in adjusted([(b, e, text[b:e]) for b, e in spans], quirks=quirks)]
    return {"smokingStatus": strongest([x[0] for x in listed]), "sentences": [{"Status": k, "Text": [s.lower(), b, e]} for k, s, b, e in listed]}


def _statuses(texts: list[str | None], model: dict | None) -> list[str]:
    """Statuses of a batch; equal sentences are read once."""
    known: dict[str | None, str] = {}
    for x in texts:
        if x not in known:
            known[x] = sentence_status(x or "", model)
    return [known[x] for x in texts]


def with_status(df: DataFrame, key: list[str], text: str, model: dict | None = None) -> DataFrame:
    """key..., status: one Arrow pass over sentences."""
    fields = [df.schema[k] for k in key]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(_statuses(b.column(len(key)).to_pylist(), model), pa.string())], names=[*key, "status"])

    return spread(df.select(*key, text)).mapInArrow(run, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields) + ", status string")


def rank(status: Column) -> Column:
    out = F.lit(0)
    for i, s in enumerate(STATUSES):
        out = F.when(status == s, len(STATUSES) - i).otherwise(out)
    return out


def document_status(sentences: DataFrame, key: str) -> DataFrame:
    """key, smoking_status: the strongest status of a document's sentences."""
    return sentences.groupBy(key).agg(F.coalesce(F.max_by("status", rank(F.col("status"))), F.lit("UNKNOWN")).alias("smoking_status"))
