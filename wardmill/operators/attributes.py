"""Attributes of annotations: polarity, medication attributes, laboratory values.

Native parts are DataFrame expressions; the automata run in one Arrow pass over token arrays.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Collection, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardmill import resources as R
from wardmill.frames import spread
from wardmill.functions import machines as M
from wardmill.functions.tokens import Token, low, tokenize

# ---- polarity


def scope(tokens: Sequence[Token], begin: int, end: int, left: int = 20, right: int = 10, boundary=R.BOUNDARY) -> tuple[list[Token], list[Token]]:
    """The tokens left and right of a span that its negation may come from, up to a boundary word."""
    first = next((i for i, t in enumerate(tokens) if t.begin >= begin), len(tokens))
    last = max((i for i, t in enumerate(tokens) if t.begin >= begin and t.end <= end), default=-1)
    before: list[Token] = []
    for t in reversed(tokens[:first]):
        if len(before) == left or t.text in boundary:
            break
        before.append(t)
    after: list[Token] = []
    for t in tokens[last + 1 :]:
        if len(after) == right or t.text in boundary:
            break
        after.append(t)
    return before[::-1], after


_EOS = Token(0, 0, "<eos>", "eos", "")


def is_negative(tokens: Sequence[Token], begin: int, end: int, left: int = 20, right: int = 10, boundary=R.BOUNDARY) -> bool:
    return any(M.negated([*side, _EOS]) for side in scope(tokens, begin, end, left, right, boundary))


def negated_words(words: Column) -> Column:
    """The negation automata over an array of lower-case words (an end mark is added), natively as a fold.

    The transitions are those of ``machines.NEGATION``: a state is the place of its line in the table, the
    machines' states are one struct, and a hit stays.
    """
    parsed = []
    for m in M.NEGATION:
        lines = [line.split() for line in m.table.strip().split("\n")]
        number = {"START": 0, **{x[0]: i for i, x in enumerate(lines) if x[0] != "START"}, "END": -1}
        parsed.append([(number[state], [(rule.rpartition(">")[0], number[rule.rpartition(">")[2]]) for rule in rules]) for state, *rules in lines])

    def holds(name: str, x: Column) -> Column:
        if name == "any":
            return F.lit(True)
        if name[0] == "!":
            return ~holds(name[1:], x)
        return x == name[1:-1] if name[0] == "'" else x.isin(sorted(M.words_of(name)))

    def step(s: Column, x: Column) -> Column:
        fields = []
        for k, table in enumerate(parsed):
            now = s[f"m{k}"]
            to = F.when(now == -1, -1)
            for state, rules in table:
                for name, target in rules:
                    to = to.when((now == state) & holds(name, x), target)
            fields.append(to.otherwise(0).alias(f"m{k}"))
        return F.struct(*fields)

    zero = F.struct(*[F.lit(0).alias(f"m{k}") for k in range(len(parsed))])
    hit = lambda s: functools.reduce(lambda p, q: p | q, [s[f"m{k}"] == -1 for k in range(len(parsed))])
    return F.aggregate(F.concat(words, F.array(F.lit("<eos>"))), zero, step, hit)


def negated_arrays(words: Column) -> Column:
    """The same as ``negated_words`` in one Arrow pass: cheaper where there are many spans."""

    @F.pandas_udf("boolean")
    def run(column):
        seen: dict[tuple, bool] = {}
        out = []
        for ws in column:
            key = tuple(ws)
            if key not in seen:
                seen[key] = M.negated([*[Token(0, 0, w, "word", "") for w in key], _EOS])
            out.append(seen[key])
        return column.__class__(out, dtype=bool)

    return run(words)


def side_words(tokens: Column, at: Column, left: bool, most: int) -> Column:
    """Words left (nearest last) or right of a token position, natively, up to ``most`` and to a boundary word."""
    words = F.slice(tokens, F.greatest(at - most, F.lit(0)) + 1, F.least(at, F.lit(most))) if left else F.slice(tokens, at + 1, most)
    near = F.reverse(words) if left else words
    stop = F.array_position(F.transform(near, lambda x: x.isin(sorted(R.BOUNDARY))), True).cast("int")
    cut = F.when(stop > 0, F.slice(near, 1, stop - 1)).otherwise(near)
    return F.reverse(cut) if left else cut


# ---- medications


def drug_spans(tokens: Sequence[Token], intended: bool = False) -> list[M.Span]:
    """All attribute spans of a sentence, in order. Later automata see the results of earlier ones as single tokens.

    ``intended``: word lists that only match words behind a digit match plain words, as they seem meant to
    (change of status, durations, ranges and fractions in words).
    """
    run = lambda ms, ts: M.run_all([m.meant() for m in ms] if intended else ms, ts)
    time = run(M.TIME, tokens)
    fraction = run(M.FRACTION_STRENGTH, tokens)
    decimal = M.DECIMAL_STRENGTH.run(tokens)
    status = run(M.STATUS, tokens)
    ranges = run(M.RANGE_STRENGTH, tokens)
    on_range = M.merged(tokens, ranges)
    units = run(M.STRENGTH_UNIT, on_range)
    forms = M.FORM.run(tokens)
    as_units = [M.Span(s.begin, s.end, "combined" if s.value == "combined" else "strength_unit") for s in units]
    strength = M.STRENGTH.run(M.merged(M.merged(tokens, as_units), fraction))
    dosage = M.DOSAGE.run(M.merged(M.merged(tokens, forms), as_units))
    suffix = M.SUFFIX_STRENGTH.run(M.merged(tokens, as_units))
    route = run(M.ROUTES, tokens)
    every = run(M.FREQUENCY_UNITS, M.merged(tokens, time))
    frequency = [_frequency(tokens, s) for s in M.FREQUENCY.run(M.merged(M.merged(tokens, every), ranges))]
    duration = run(M.DURATION, on_range)
    out = [*time, *fraction, *decimal, *status, *ranges, *units, *forms, *strength, *dosage, *suffix, *route, *every, *frequency, *duration]
    return sorted(out, key=lambda s: (s.begin, s.end, s.kind, s.value))


def _frequency(tokens: Sequence[Token], s: M.Span) -> M.Span:
    """A frequency narrowed to the word or number that tells how often, with that number."""
    inside = [t for t in tokens if s.begin <= t.begin and t.end <= s.end]
    for word, n in R.FREQUENCY.items():
        if t := next((t for t in inside if t.text == word), None):
            return M.Span(t.begin, t.end, "frequency", str(float(n)))
    for t in inside:
        if t.text in R.HYPHENATED_FREQUENCY:
            return M.Span(t.begin, t.end, "frequency", str(float(R.HYPHENATED_FREQUENCY[t.text])))
    t = next((t for t in inside if t.text.isdigit()), None)
    return M.Span(t.begin, t.end, "frequency", t.text) if t else M.Span(s.begin, s.end, "frequency")


#: Attributes and the kinds of spans they come from.
_DRUG_KINDS = (("strength", "strength"), ("unit", "strength_unit"), ("form", "form"), ("dosage", "dosage"), ("route", "route"), ("frequency", "frequency"), ("frequency_unit", "frequency_unit"), ("status", "status"), ("duration", "duration"))


def drug_places(tokens: Sequence[Token], drugs: Sequence[tuple[int, int]], reach: int = 10, intended: bool = False) -> list[dict[str, M.Span | None]]:
    """For each drug span, in order, the first span of each kind between it and the next drug, at most ``reach`` tokens on."""
    spans, out = drug_spans(tokens, intended), []
    drugs = sorted(drugs)
    for k, (_, e) in enumerate(drugs):
        following = [i for i, t in enumerate(tokens) if t.begin >= e]
        last = tokens[min(following[0] + reach, len(tokens) - 1)].end if following else e
        stop = min(last, drugs[k + 1][0] if k + 1 < len(drugs) else last)
        out.append({name: next((s for s in spans if s.kind == kind and s.begin >= e and s.end <= stop), None) for name, kind in _DRUG_KINDS})
    return out


def drug_attributes(text: str, tokens: Sequence[Token], drugs: Sequence[tuple[int, int]], reach: int = 10, intended: bool = False) -> list[dict]:
    """``drug_places`` as text: route and status by name, the frequency as a number where it is known."""
    out = []
    for (b, e), places in zip(sorted(drugs), drug_places(tokens, drugs, reach, intended)):
        row = {"begin": b, "end": e, **{k: None if s is None else low(text[s.begin : s.end]) for k, s in places.items()}}
        for k in ("route", "status"):
            row[k] = places[k].value if places[k] else None
        every, number = places["frequency_unit"], places["frequency"]
        row["frequency"] = (number.value or row["frequency"]) if number else every.value or None if every else None
        out.append(row)
    return out


def drug_bag(text: str, begin: int, places: dict[str, M.Span | None]) -> dict:
    """A drug's attributes as the response has them; ``text`` is the sentence, ``begin`` its place in the note."""
    of = lambda s: text[s.begin - begin : s.end - begin]
    triple = lambda s, t=None: [] if s is None else [of(s) if t is None else t, s.begin, s.end]
    every, number = places["frequency_unit"], places["frequency"]
    bag: dict = {"medFrequencyUnit": triple(every)}
    if number:
        bag["medFrequencyNumber"] = triple(number, number.value or None)
    elif not every:
        bag["medFrequencyNumber"] = []
    elif every.value:
        bag["medFrequencyNumber"] = triple(every, every.value)
    bag |= {"medStrengthNum": triple(places["strength"]), "medStrengthUnit": triple(places["unit"]), "medStatusChange": places["status"].value if places["status"] else None}
    bag |= {k: of(places[n]) if places[n] else None for k, n in (("medDosage", "dosage"), ("medForm", "form"), ("medDuration", "duration"))}
    return bag | {"medRoute": places["route"].value if places["route"] else None}


DRUG_SCHEMA = "begin int, end int, strength string, unit string, form string, dosage string, route string, frequency string, frequency_unit string, status string, duration string"


def with_drug_attributes(df: DataFrame, key: str, text: str, drug: str, intended: bool = False) -> DataFrame:
    """key and one row per occurrence of the drug in the sentence, with its attributes. One Arrow pass."""
    names = [x.split()[0] for x in DRUG_SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: dict[str, list] = {"k": [], **{n: [] for n in names}}
            for k, s, d in zip(*[c.to_pylist() for c in b.columns]):
                if not s or not d:
                    continue
                low, at, places = s.lower(), -1, []
                while (at := low.find(d.lower(), at + 1)) >= 0:
                    places.append((at, at + len(d)))
                for r in drug_attributes(s, tokenize(s), places, intended=intended):
                    rows["k"].append(k)
                    for n in names:
                        rows[n].append(r[n])
            kinds = [b.schema.field(0).type, pa.int32(), pa.int32(), *[pa.string()] * 9]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows.values(), kinds)], names=[key, *names])

    return spread(df.select(key, text, drug)).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, {DRUG_SCHEMA}")


# ---- laboratory values


def viterbi(features: list[set[str]], model: dict) -> list[int]:
    """Best states of a linear-chain CRF with presence features; missing initial weights are minus infinity."""
    n = len(model["states"])
    initial = np.array([*model["initial_weights"], *[-np.inf] * n][:n])
    final = np.array(model["final_weights"])
    default = np.array([[c["default_weight"] for c in row] for row in model["transitions"]])
    weights = np.array([[c["weights"] for c in row] for row in model["transitions"]])
    score, back = initial, []
    for f in features:
        ids = [model["features"][x] for x in f if x in model["features"]]
        step = default + weights[:, :, ids].sum(axis=2)
        total = score[:, None] + step
        back.append(total.argmax(axis=0))
        score = total.max(axis=0)
    if not features:
        return []
    state = int((score + final).argmax())
    out = [state]
    for b in reversed(back[1:]):
        state = int(b[state])
        out.append(state)
    return out[::-1]


@functools.cache
def _unit_starts(units: frozenset[str]) -> frozenset[str]:
    """The units and their beginnings: a path in the tree of units."""
    return frozenset(u[:k] for u in units for k in range(1, len(u) + 1))


def split_units(tokens: Sequence[Token], units: frozenset[str]) -> list[Token]:
    """Tokens with ``45mg`` parted into a number and a unit (or the beginning of one, as in ``5k`` of ``5k/ul``)."""
    paths, out = _unit_starts(units), []
    for t in tokens:
        digits, rest = M._split_number(t)
        k = len(digits)
        if t.kind != "number" and digits and rest and t.text[k:] in paths:
            out += [Token(t.begin, t.begin + k, digits, "number", t.shape[:k]), Token(t.begin + k, t.end, t.text[k:], "word", t.shape[k:])]
        else:
            out.append(t)
    return out


def lab_sequence(text: str, tokens: Sequence[Token], mentions: Sequence[tuple[int, int]], special: str = "normal", units: frozenset[str] = R.LAB_UNITS, begin: int = 0) -> list[tuple[str, int, int, Token | None]]:
    """(kind, begin, end, token) in order: mentions, values (numbers, ranges, fractions, the special word) and other tokens.

    A mention, range or fraction is one element; dates are left out. Of the special word only the first in
    the sentence counts.
    """
    tokens = split_units(tokens, units)
    dates, ranges, fractions = M.date_spans(tokens), M.LAB_RANGE.run(tokens), M.LAB_FRACTION.run(tokens)
    where = low(text).find(special) if special else -1
    word = (begin + where, begin + where + len(special)) if where >= 0 else None
    covers = lambda s, t: s.begin <= t.begin and t.end <= s.end
    todo, out, until = sorted(mentions), [], -1
    for t in tokens:
        if t.begin < until:
            continue
        if m := next((m for m in todo if m[0] <= t.begin and t.end <= m[1]), None):
            todo.remove(m)
            out.append(("mention", *m, None))
            until = m[1]
            continue
        if any(covers(s, t) for s in dates):
            continue
        if s := next((s for s in (*ranges, *fractions) if covers(s, t)), None):
            if t.end == s.end:
                out.append(("value", s.begin, s.end, None))
            continue
        if t.kind == "number":
            out.append(("value", t.begin, t.end, t))
        elif word and t.begin <= word[0] < t.end:
            out.append(("value", *word, None))
            until, word = word[1], None
        else:
            out.append(("token", t.begin, t.end, t))
    return out


def lab_values(text: str, tokens: Sequence[Token], special: str = "normal", units: frozenset[str] = R.LAB_UNITS) -> list[M.Span]:
    """Numbers, ranges, fractions and the word ``normal``, without parts of dates; units are left out."""
    return [M.Span(b, e, "value") for kind, b, e, _ in lab_sequence(text, tokens, [], special, units) if kind == "value"]


@functools.cache
def _longest(units: frozenset[str]) -> int:
    return max(map(len, units), default=0)


def unit_after(text: str, end: int, units: frozenset[str] = R.LAB_UNITS) -> tuple[int, int] | None:
    """The longest unit that begins right behind a value, white space skipped."""
    a = end
    while a < len(text) and text[a].isspace():
        a += 1
    most = _longest(units)
    rest = low(text[a : a + most + 1])
    n = next((n for n in range(min(most, len(rest)), 0, -1) if rest[:n] in units and not rest[n : n + 1].isalnum()), 0)
    return (a, a + n) if n else None


def unit_column(rest: Column, units: Collection[str] = R.LAB_UNITS) -> Column:
    """The longest unit at the beginning of a text (white space skipped), natively; null if there is none."""
    head = F.lower(F.ltrim(rest))
    most = max(map(len, units), default=0)
    lengths = F.sequence(F.least(F.lit(most), F.length(head)), F.lit(0), F.lit(-1))
    fits = lambda n: (n > 0) & F.substring(head, F.lit(1), n).isin(sorted(units)) & ~F.substring(head, n + 1, F.lit(1)).rlike(r"[\p{L}\p{N}]")
    n = F.get(F.filter(lengths, fits), F.lit(0))
    return F.when(n.isNotNull(), F.substring(head, F.lit(1), n))


def pair_features(sequence: Sequence[tuple[str, int, int, Token | None]], mention: int, value: int, tags: Sequence[str] | None = None) -> set[str]:
    """Features of a mention and a value by their places in the sequence; what lies between them counts.

    Numeric and boolean features count by presence. ``tags`` are the part-of-speech tags of the elements
    (of tokens), else the closed class of conjunctions stands in.
    """
    out, terms, values = {"LV_DISTANCE", "LV_TERMS_BETWEEN", "LV_VALUES_BETWEEN", "LV_IS_CLOSEST"}, 0, 0
    lo, hi = sorted((mention, value))
    for k in range(lo + 1, hi):
        kind, _, _, t = sequence[k]
        if kind == "mention":
            terms += 1
            out.add(f"LV_POINT_TERM_{terms}")
        elif kind == "value":
            values += 1
            out.add(f"LV_POINT_VALUE_{values}")
        elif t is not None:
            if t.kind == "newline":
                out.add("LV_NEW_LINE")
                continue
            if t.kind == "punct":
                out.add(f"LV_PUNCTUATION_{t.text}")
            if (tags[k] == "cc") if tags else t.text in ("and", "or", "but", "nor"):
                out.add(f"LV_CONJ_{t.text.upper()}")
    return out


def link_labs(text: str, mentions: Sequence[tuple[int, int]], model: dict | None = None, reach: int = 15, far: int = 50, most: int = 11, units: frozenset[str] = R.LAB_UNITS, tokens: Sequence[Token] | None = None, begin: int = 0) -> list[dict]:
    """For each mention of a sentence the value that the CRF links to it and the unit behind it.

    All pairs of a mention and a value, at most ``far`` elements apart and ``most`` values a mention, the
    right-most first, are one chain; of several linked values the left-most stays. Without a model the
    nearest value to the right within reach, with no other mention between, is taken: a deterministic
    fallback. ``tokens`` may be given with offsets in a note where the sentence begins at ``begin``.
    """
    sequence = lab_sequence(text, tokenize(text) if tokens is None else tokens, mentions, units=units, begin=begin)
    named = [i for i, x in enumerate(sequence) if x[0] == "mention"]
    values = [i for i, x in enumerate(sequence) if x[0] == "value"]
    chosen: dict[int, int] = {}
    if model:
        pairs = [(m, v) for m in named for v in [v for v in values if abs(m - v) <= far][:most][::-1]]
        states = viterbi([pair_features(sequence, m, v) for m, v in pairs], model)
        for (m, v), s in zip(pairs, states):
            if model["states"][s] == "LINKED" and abs(m - v) < reach:
                chosen[m] = v
    else:
        for m in named:
            stop = next((n for n in named if n > m), len(sequence))
            v = next((v for v in values if m < v < min(stop, m + reach)), None)
            if v is not None:
                chosen[m] = v
    out = []
    for m in named:
        _, b, e, _ = sequence[m]
        row = {"begin": b, "end": e, "value": None, "unit": None, "value_at": None, "unit_at": None}
        if m in chosen:
            _, vb, ve, _ = sequence[chosen[m]]
            row |= {"value": text[vb - begin : ve - begin], "value_at": (vb, ve)}
            if u := unit_after(text, ve - begin, units):
                row |= {"unit": text[u[0] : u[1]], "unit_at": (u[0] + begin, u[1] + begin)}
        out.append(row)
    return out


def with_lab_values(df: DataFrame, key: str, text: str, lab: str, model: dict | None = None, units: Collection[str] = R.LAB_UNITS) -> DataFrame:
    """key, begin, end, value, unit for every occurrence of the lab name in the sentence. One Arrow pass.

    ``units`` is the list of units, in any case.
    """
    known = frozenset(x.lower() for x in units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(5)]
            for k, s, name in zip(*[c.to_pylist() for c in b.columns]):
                if not s or not name:
                    continue
                low, at, places = s.lower(), -1, []
                while (at := low.find(name.lower(), at + 1)) >= 0:
                    places.append((at, at + len(name)))
                for r in link_labs(s, places, model, units=known):
                    for column, v in zip(rows, (k, r["begin"], r["end"], r["value"], r["unit"])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (b.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.string()))], names=[key, "begin", "end", "value", "unit"])

    return spread(df.select(key, text, lab)).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, begin int, end int, value string, unit string")


# ---- any set of automata over sentences


def with_spans(df: DataFrame, key: str, text: str, machines: list[M.Machine] | Callable[[Sequence[Token]], list[M.Span]]) -> DataFrame:
    """key, kind, value, begin, end, span: what the automata, or a function over tokens, find in each text."""
    find = machines if callable(machines) else lambda ts: [x for m in machines for x in m.run(ts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[list] = [[] for _ in range(6)]
            for k, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = tokenize(s or "")
                for x in find(tokens):
                    for column, v in zip(rows, (k, x.kind, x.value, x.begin, x.end, s[x.begin : x.end])):
                        column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(rows, (b.schema.field(0).type, pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string()))], names=[key, "kind", "value", "begin", "end", "span"])

    return spread(df.select(key, text)).mapInArrow(run, f"{key} {df.schema[key].dataType.simpleString()}, kind string, value string, begin int, end int, span string")
