"""One driver for all token automata, and their declarative transition tables.

The tables state which word leads where, as fixed values: results must be the same everywhere. A machine is text: ``STATE condition>STATE condition>STATE``, one line a state. The first rule that holds
wins; every state ends with an unwritten rule back to START. A span runs from the token after the last START to
the token that reaches END; END- ends it a token earlier, and a rule into SKIP drops the first token.
With ``quirks`` (the default) a match right behind another begins where the former began, since the
place of START isn't renewed by an emission.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from wardmill import resources as R
from wardmill.functions.tokens import Token


@dataclass(frozen=True)
class Span:
    begin: int
    end: int
    kind: str
    value: str = ""


Condition = Callable[[Token], bool]
_SETS = {k.lower(): v for k, v in vars(R).items() if isinstance(v, (frozenset, dict)) and k.isupper()}
_SETS["months"] = frozenset(R.MONTHS)
_SETS["months3"] = frozenset(m[:3] for m in R.MONTHS) | {"sept"}
_SETS["number_word"] = R.NUMERATOR
_SETS["eosany"] = R.MODAL | R.REG_VERB
_SETS["neg_any"] = R.NEG_PARTICLE | R.NEG_DET
_SETS["range_word"] = frozenset("to through thru".split())
_SETS["day_night"] = frozenset(["am", "pm"])


def words_of(name: str) -> frozenset[str]:
    """The words of a set by its name in the tables."""
    return frozenset(_SETS[name])


def _split_number(t: Token) -> tuple[str, str]:
    k = 0
    while k < len(t.text) and t.text[k].isdigit():
        k += 1
    return t.text[:k], t.text[k:].removeprefix("-") if k else ""


@functools.cache
def condition(name: str) -> Condition:
    """One of the kinds of test: any, num, 'literal', int<lo>-<hi>, a word set, tail:<set>, @<composite>, clock, daynight; with ! (not), & (and), | (or).

    A literal of one mark asks for punctuation, any other for a word. ``tail:`` strips leading digits and a
    hyphen from a token that begins with a digit and asks for the rest. ``clock`` parts hour and minute at a
    semicolon, as the reference behaviour does, so it never holds for 8:30.
    """
    if "|" in name:
        some = [condition(x) for x in name.split("|")]
        return lambda t: any(f(t) for f in some)
    if "&" in name:
        every = [condition(x) for x in name.split("&")]
        return lambda t: all(f(t) for f in every)
    if name == "any":
        return lambda t: True
    if name == "num":
        return lambda t: t.kind == "number"
    if name[0] == "'":
        text = name[1:-1]
        kind = "word" if len(text) > 1 or text.isalnum() else "punct"
        return lambda t: t.kind == kind and t.text == text
    if name[0] == "!":
        inner = condition(name[1:])
        return lambda t: not inner(t)
    if name[0] == "@":  # a composite token put in place by an earlier machine
        return lambda t: t.kind == name[1:]
    if name == "clock":
        return lambda t: len(x := t.text.split(";")) == 2 and all(y.isdigit() for y in x) and 1 <= int(x[0]) <= 12 and int(x[1]) <= 59
    if name == "daynight":
        return lambda t: 3 <= len(t.text) <= 4 and t.text[:3] in ("a.m", "p.m")
    if name[:3] == "int":
        lo, hi = map(int, name[3:].split("-"))
        return lambda t: t.text.isdigit() and len(t.text) < 6 and lo <= int(t.text) <= hi
    if name[:4] == "tail":
        words = _SETS[name[5:]]
        return lambda t: bool(_split_number(t)[0]) and _split_number(t)[1] in words
    words = _SETS[name]
    return lambda t: t.text in words


class Machine:
    def __init__(self, kind: str, table: str, value: str = ""):
        self.kind, self.table, self.value, self.rules = kind, table, value, {}
        self._known: dict[tuple[str, str, str], str] = {}
        self._idle: set[tuple[str, str]] = set()
        self._meant: Machine | None = None
        for line in table.strip().split("\n"):
            state, *rules = line.split()
            self.rules[state] = [(condition(r.rpartition(">")[0]), r.rpartition(">")[2]) for r in rules]

    def step(self, state: str, t: Token) -> str:
        """Where a token leads. Conditions read its text and kind alone, so the ways met so far are kept."""
        key = (state, t.kind, t.text)
        to = self._known.get(key)
        if to is None:
            to = next((to for holds, to in self.rules.get(state, ()) if holds(t)), "START")
            if len(self._known) < 20_000:
                self._known[key] = to
        return to

    def idle(self, seen: dict[tuple[str, str], Token]) -> bool:
        """Whether none of the tokens (by kind and text) leads on from START, so that there are no spans."""
        if self._idle.issuperset(seen):
            return True
        for key, t in seen.items():
            if key not in self._idle:
                if self.step("START", t) != "START":
                    return False
                if len(self._idle) < 20_000:
                    self._idle.add(key)
        return True

    def run(self, tokens: Sequence[Token], quirks: bool = True) -> list[Span]:
        out, state, start, skip = [], "START", -1, 0
        known = self._known.get
        for i, t in enumerate(tokens):
            if state == "START":
                start, skip = i - 1, 0
            state = known((state, t.kind, t.text)) or self.step(state, t)
            if state == "START":
                start = i
            elif state.startswith("SKIP"):
                skip = 1
            if state in ("END", "END-"):
                first, last = start + 1 + skip, i - (state == "END-")
                if first <= last:
                    out.append(Span(tokens[first].begin, tokens[last].end, self.kind, self.value))
                state = "START"
        return out

    def meant(self) -> Machine:
        """The machine as its word lists intend it: ``tail:`` sets, which ordinary words never meet, as plain sets."""
        if self._meant is None:
            self._meant = Machine(self.kind, self.table.replace("tail:", ""), self.value)
        return self._meant

    def fires(self, tokens: Sequence[Token]) -> bool:
        state = "START"
        for t in tokens:
            state = self.step(state, t)
            if state.startswith("END"):
                return True
        return False


def run_all(machines: Sequence[Machine], tokens: Sequence[Token]) -> list[Span]:
    """The spans of several machines, one after the other; those that nothing starts aren't run."""
    seen = {(t.kind, t.text): t for t in tokens}
    return [s for m in machines if not m.idle(seen) for s in m.run(tokens)]


def merged(tokens: Sequence[Token], spans: Sequence[Span]) -> list[Token]:
    """Tokens with each span as one composite token of its kind."""
    if not spans:
        return list(tokens)
    at = {s.begin: s for s in sorted(spans, key=lambda s: s.end)}
    out, until = [], -1
    for t in tokens:
        if t.begin < until:
            continue
        s = at.get(t.begin)
        if s:
            out.append(Token(s.begin, s.end, "", s.kind, ""))
            until = s.end
        else:
            out.append(t)
    return out


# The transitions of the automata.
NEGATION = [
    Machine("negation", """
START neg_verb>VERB neg_colloc>COLLOC eosany>MODAL neg_any>PART
MODAL neg_colloc>COLLOC neg_any>PART any>ANY
ANY neg_any>PART
COLLOC 'out'>OUT
OUT any>END
PART !neg_colloc>END
VERB !neg_colloc>END"""),
    Machine("negation", """
START neg_det>DET neg_prep>PREP
PREP any>END
DET reg_noun>NOUN any>END
NOUN any>END"""),
    Machine("negation", """
START neg_adj>ADJ
ADJ neg_prep>PREP
PREP any>END"""),
    Machine("negation", "START neg_adj>END"),
]

DATES = [
    Machine("date", """
START months>MONTH months3>SHORT
MONTH int1-31>DAY
SHORT '.'>DOT int1-31>DAY
DOT int1-31>DAY
DAY ','>COMMA int1900-2100>END
COMMA int1900-2100>END"""),
    Machine("date", """
START months|months3>MONTH
MONTH '.'>DOT int1900-2100>END int1-31>END
DOT int1900-2100>END int1-31>END"""),
    Machine("date", """
START int1-12>MONTH
MONTH '/'>S1 '-'>S1
S1 int1-31>DAY
DAY '/'>S2 '-'>S2
S2 int1900-2100>END int0-99>END"""),
    Machine("date", """
START int1-12>MONTH
MONTH '/'>S '-'>S
S int1-31>END"""),
]
LAB_RANGE = Machine("range", """
START num|number_word>A
A '-'>DASH
DASH num|number_word>END""")  # fmt: skip
LAB_FRACTION = Machine("fraction", """
START num>A number_word>W denominator>END
A '/'>SLASH denominator>END
SLASH num>END
W denominator>END""")  # fmt: skip
TIME = [
    Machine("time", """
START int1-12>H clock>H
H day_night>END daynight>P
P '.'>END"""),
    Machine("time", """
START int0-23>H
H ':'>C
C int0-59>END"""),
]
FRACTION_STRENGTH = [
    Machine("fraction", """
START num>A tail:numerator>A
A '.'>DOT '/'>S '-'>R
DOT num>HY
HY '-'>R
R num>END
S num>END"""),
    Machine("fraction", """
START num>A tail:numerator>W tail:denominator>END
A '/'>S tail:denominator>END
S num>END
W tail:denominator>END"""),
]
DECIMAL_STRENGTH = Machine("decimal", """
START int0-0>Z
Z '.'>D
D num>N
N '-'>END-""")  # fmt: skip
RANGE_STRENGTH = [
    Machine("range", """
START num>L tail:hyphenated_range>END tail:numerator>L
L '-'>DASH
DASH num>END tail:numerator>END"""),
    Machine("range", """
START num>L
L '.'>DOT
DOT num>DEC
DEC '-'>DASH
DASH num>END @fraction>END"""),
    Machine("range", """
START tail:numerator>L
L '-'>DASH tail:range_word>R
DASH num>END tail:numerator>END tail:range_word>MID
MID '-'>R
R num>END tail:numerator>END"""),
]
STRENGTH_UNIT = [
    Machine("strength_unit", """
START strength_unit|'%'>END '-'>SKIP
SKIP strength_unit>END"""),
    Machine("strength_unit", "START tail:strength_unit>END", "combined"),
]
FORM = Machine("form", "START form>END")
STRENGTH = Machine("strength", """
START @combined>END num|strength_number>N @fraction>F
F @strength_unit>END- '/'>START any>N
N '.'>N '-'>N @strength_unit>END-""")  # fmt: skip
DOSAGE = Machine("dosage", """
START num|dosage_number>N
N @form>END- '('>P 'of'>OF '-'>DASH
P @form>END-
OF 'a'>A
A @form>END-
DASH num>N2
N2 @form>END-""")  # fmt: skip
SUFFIX_STRENGTH = Machine("suffix", """
START @strength>S
S '/'>SL
SL hour_suffix|day_suffix>END""")  # fmt: skip
ROUTES = [
    Machine("route", "START topical>END route_middle>M 'p'>P\nM topical>END\nP '.'>D\nD 'v'>E\nE '.'>END", "Topical"),
    Machine("route", "START oral|nebulized>END route_middle>M 'p'>P\nM oral|nebulized>END\nP '.'>D\nD 'o'>E\nE '.'>END", "Enteral_Oral"),
    Machine("route", "START gastric>END", "Enteral_Gastric"),
    Machine("route", "START rectal>END", "Enteral_Rectal"),
    Machine("route", "START inject>END", "Parenteral_Intravenous"),
    Machine("route", "START transdermal>END", "Parenteral_Transdermal"),
]


def _dotted(*letters: str) -> str:
    """The lines that read the rest of a dotted abbreviation whose first letter led to <letter>1."""
    first, out = letters[0], []
    for k in range(1, len(letters)):
        out += [f"{first}{2 * k - 1} '.'>{first}{2 * k}", f"{first}{2 * k} '{letters[k]}'>{first}{2 * k + 1}"]
    return "\n".join([*out, f"{first}{2 * len(letters) - 1} '.'>END"])


FREQUENCY_UNITS = [
    Machine("frequency_unit", """
START 'q'>Q 'o'>o1 'h'>h1 int1-12>CLOCK @time>END 'bed'>B 'per'>B daily>END per_day>END tail:per_day>END
CLOCK 'a'>a1 'p'>p1
B daily>END 'time'>END
Q '.'>QD
QD 'd'>LAST
LAST '.'>END
""" + "\n".join([_dotted("o", "d"), _dotted("h", "s"), _dotted("a", "m"), _dotted("p", "m")])),
    Machine("frequency_unit", """
START 'b'>b1 'q'>H int12-12>H 'twelve'>H twice_a_day>END
H hour_suffix>END twice_a_day>END
""" + _dotted("b", "i", "d"), "2.0"),
    Machine("frequency_unit", """
START 't'>t1 'q'>E int8-8>E three_a_day>END !int1-7&num>R post_eight|'eight'>E
R '-'>TO
E '-'>TO 'to'>TO hour_suffix>END
TO int9-10|'nine'|'ten'>U
U hour_suffix>END
""" + _dotted("t", "i", "d"), "3.0"),
    Machine("frequency_unit", """
START 'q'>Q four_a_day>END int6-6>S !int1-5&num>R post_six|'six'>S
Q '.'>QD 'six'>S int6-6>S four_a_day>S
R '-'>TO
S '-'>TO 'to'>TO hour_suffix>END four_a_day>END
TO int7-10|'seven'|'eight'|'nine'|'ten'>U
U hour_suffix>END
QD 'd'>D1 'i'>I1
D1 '.'>D2
D2 's'>LAST
I1 '.'>I2
I2 'd'>LAST
LAST '.'>END""", "4.0"),
    Machine("frequency_unit", """
START six_a_day>END int4-4>R int5-5|'five'>F
R '-'>TO
TO int5-10>F
F hour_suffix>END""", "5.0"),
    Machine("frequency_unit", """
START six_a_day>END int4-4>F !int1-3&num>R post_four|'four'>F
R '-'>TO
F '-'>TO 'to'>TO
TO int5-8|'five'|'six'|'seven'|'eight'>U
U hour_suffix>END""", "6.0"),
    Machine("frequency_unit", "START 'q'>q1 'a'>A 'at'>A 'per'>A per_week>END\nA tail:per_week>END\n" + _dotted("q", "w", "k")),
    Machine("frequency_unit", "START 'as'>AS prn>END 'p'>p1\nAS 'needed'>END '-'>HY\nHY 'needed'>END\n" + _dotted("p", "r", "n")),
    Machine("frequency_unit", "START 'q'>q1 other_day>END 'every-other'>EO\nEO daily>END\n" + _dotted("q", "a", "d")),
    Machine("frequency_unit", "START 'q'>q1 other_hour>END\n" + _dotted("q", "o", "d")),
    *[Machine("frequency_unit", f"START '/'>SKIP\nSKIP {x}_suffix>END") for x in ("hour", "day", "week", "month", "year")],
]
FREQUENCY = Machine("frequency", """
START @range>F frequency|int0-5>F hyphenated_frequency>END
F frequency_middle|num>M frequency>W hyphenated_frequency>END @frequency_unit>END-
W frequency_middle>T
M frequency_middle>N @frequency_unit>END-
T @frequency_unit>DROP
N @frequency_unit>END-""")  # fmt: skip
STATUS = [
    Machine("status", "START tail:single_start>END tail:multi_then>T tail:first_start>S '['>B\nT tail:first_start>S tail:single_start>END\nS tail:second_dual>END\nB tail:single_start>E\nE 'section'>L\nL tail:single_start>END", "start"),
    Machine("status", "START tail:multi_then>T tail:single_stop>END tail:first_stop>S '['>B\nT tail:single_stop>S tail:first_stop>S\nS tail:second_dual>END tail:second_off>END\nB tail:single_stop>E\nE 'section'>L\nL tail:single_stop>END", "stop"),
    Machine("status", "START tail:multi_then>T tail:single_increase>END tail:first_increase>S\nT tail:single_increase>END tail:first_increase>S\nS tail:second_dual>END", "increase"),
    Machine("status", "START tail:multi_then>T tail:first_increase>S\nT tail:first_increase>S\nS tail:second_from>END", "increasefrom"),
    Machine("status", "START tail:multi_then>T tail:single_decrease>END tail:first_decrease>S\nT tail:single_decrease>END tail:first_decrease>S\nS tail:second_dual>END", "decrease"),
    Machine("status", "START tail:multi_then>T tail:first_decrease>S\nT tail:first_decrease>S\nS tail:second_from>END", "decreasefrom"),
    Machine("status", "START tail:multi_then>T tail:single_no_change>END tail:first_no_change>S tail:no_change>D\nT tail:first_no_change>S tail:single_no_change>END\nS tail:second_dual>END\nD tail:change_word>END", "noChange"),
    Machine("status", "START tail:multi_then>END 'followed'>F tail:change_word>END\nF 'by'>END", "change"),
    Machine("status", "START tail:single_sum>END", "add"),
    Machine("status", "START tail:single_max>END tail:first_max>S\nS tail:second_max>END", "maximum"),
]
DURATION = [
    Machine("duration", """
START tail:duration_lead>L
L @range>M tail:duration_number>M '-'>D1 num>M tail:duration_combined>END
M @range>X tail:duration_number>X '-'>D1 tail:period>END
D1 tail:duration_number>M
X tail:duration_number>END tail:period>END"""),
    Machine("duration", """
START tail:duration_lead>L
L tail:duration_more>M num>F
M @range>A tail:duration_more>F tail:duration_number>A num>A
F @range>T tail:duration_number>T num>T
A tail:period>END
T tail:period>END"""),
]
#: Built but never run by the pipeline, as in the reference behaviour.
SUBSECTIONS = [
    Machine("subsection", "START tail:probable_begin>M\nM tail:probable_next>END tail:probable_middle>W\nW tail:probable_end>END", "probable"),
    Machine("subsection", "START tail:history_begin>M\nM tail:history_next>END tail:history_middle>W ':'>END\nW tail:history_next>END ':'>END", "history"),
    Machine("subsection", "START tail:confirmed_begin>M 'p'>p1\nM tail:confirmed_next>END\np1 '.'>p2\np2 'r'>p3\np3 '.'>p4\np4 'n'>p5\np5 '.'>M", "confirmed"),
]


def date_spans(tokens: Sequence[Token]) -> list[Span]:
    """Dates in order; one that reaches into the next is dropped, the last always stays."""
    found = sorted(run_all(DATES, tokens), key=lambda s: (s.end, s.begin))
    return [s for k, s in enumerate(found) if k + 1 == len(found) or s.end < found[k + 1].begin]


def negated(words: Sequence[Token]) -> bool:
    seen = {(t.kind, t.text): t for t in words}
    return any(not m.idle(seen) and m.fires(words) for m in NEGATION)
