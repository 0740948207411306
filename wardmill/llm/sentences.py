"""Sentence units of notes in any language.

Document-centred disambiguation: whether a word before a period is an abbreviation, and whether the
capitalised word after it is a name, is settled by unambiguous occurrences elsewhere: first in the same
document (the word followed by a period and a lower-case word or a comma; the next word in lower case),
then in the whole corpus. No list of abbreviations is kept. The corpus says of each word that stands before
a period how often a lower-case word, a number or a comma follows, and how often the capitalised word
behind it is one that starts sentences (it often stands behind ! and ?). A word
behind whose period almost only names and codes follow never ends a sentence; one that lower-case words
follow often, but starters too, may. Terminators, quotation marks and white space follow the script.

The corpus is read once, in Arrow batches that count for themselves; counts and tests are distributed, and
the criteria are counts and ratios that don't move with the size of the corpus. What passes them is sent
to the tasks if it is at most ``MOST_WORDS``; beyond, each document gets the words that stand in it by a
join. The documents are split where they lie. Two jobs run while the frame is built.

Defined cases: null, empty and blank texts give no units; offsets are code points; a text in which
nothing ends a unit is one unit; an opening quotation mark without its partner in the same paragraph
is ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.frames import spread
from wardmill.session import checkpoint

#: Occurrences that make evidence.
LEAST = 3
#: Different names and codes behind a word (or any behind whose own period a sentence can't end) that say something even if nothing goes on in lower case.
ALONE = 8
#: A word is an abbreviation if so large a share of its periods goes on in lower case, with a number or a comma.
GOES_ON_SHARE = 0.1
#: A word starts sentences if it starts so large a share of those behind ! and ?.
OFTEN = 1 / 2_000
#: It never ends a sentence if so small a share of the capitalised words behind it are starters.
STARTER_SHARE = 0.25
#: Words of evidence that are sent to the tasks at most (some 20 MB).
MOST_WORDS = 500_000

MONTHS_DE = frozenset("Januar Jänner Februar März April Mai Juni Juli August September Oktober November Dezember".split())
PAIRS = {"„": "“”", "“": "”", "«": "»", "‹": "›", "「": "」", "『": "』", '"': '"'}
OPENERS = "\"'“„«‹「『(（[【¿¡"
GOES_ON = frozenset(",，、;；:：—–-)）]】.。/")
PARTICLES = frozenset("とってはがをにものでへや")

_EVENT = re.compile(r'["“„«‹「『]|[.!?…。！？।॥؟۔]+[)\]）】]*|(?<=[ก-๏๚๛])\s+(?=[ก-๏๚๛])')
_LIST = re.compile(r"(?:[-*•–▪◦·‣]|\(?(\d{1,3})[.)]|\(?[a-z]\))\s+\S")
_LABEL = re.compile(r"[^\W\d_][^:：,;!?\"“«。！？।؟，]{0,38}[:：]\s*[^\s:\"“„«「].{0,60}\Z")
_LABEL_VALUE = re.compile(r"[:：]\s*(?:[<>~±+]?\s*\.?\d\S*(?:\s\S{1,8}){0,2}|\S+(?:\s\S+){0,2})\Z")
_DATA = re.compile(r"[0-9A-Za-z+/=_-]+\Z")
_LETTERS = re.compile(r"[^\W\d_]{3,}")
_END = frozenset('.!?…。！？।॥؟۔"”“»」』)）;；,，、')
_CJK = re.compile(r"[぀-ヿ㐀-鿿豈-﫿]")
_THAI = re.compile(r"[ก-๏๚๛]")
_EVIDENCE = re.compile(r"\.,|\. (?=[a-zß-öø-ÿа-яё])")


#: Lower-case words met before a period that the corpus doesn't take for abbreviations (a cache).
_plain: set[str] = set()
_plain_of: object = None


@dataclass(frozen=True)
class Corpus:
    """What the whole corpus says: words that never end a sentence, abbreviations that may, words that start sentences."""

    never: frozenset[str] = field(default_factory=frozenset)
    abbreviations: frozenset[str] = field(default_factory=frozenset)
    starters: frozenset[str] = field(default_factory=frozenset)


def last_word(text: str, lo: int, p: int) -> str:
    """The word that ends at p, without opening marks."""
    parts = text[max(lo, p - 16) : p].split()
    if not parts or text[p - 1].isspace():
        return ""
    w = parts[-1]
    for c in "(/（[“„«\"'":
        if c in w and c != "/":
            w = w.rsplit(c, 1)[1]
    return w


class Document:
    def __init__(self, text: str, corpus: Corpus):
        self.text, self.corpus = text, corpus
        self.lower = False  # whether the running text at hand has no capitals
        self._abbreviations: set[str] | None = None
        self._danda = "।" in text

    @property
    def abbreviations(self) -> set[str]:
        """Words that the document itself follows with a period and then a lower-case word or a comma."""
        if self._abbreviations is None:
            found = set()
            for line in self.text.split("\n"):
                if line.islower():
                    continue
                for m in _EVIDENCE.finditer(line):
                    p = m.start()
                    if p and line[p - 1] not in '.)"':
                        found.add(last_word(line, 0, p))
            self._abbreviations = found
        return self._abbreviations

    def common(self, word: str) -> bool:
        """Whether a capitalised word is an ordinary one: the document has it in lower case, or the corpus starts sentences with it."""
        return word.lower() in self.corpus.starters or f" {word.lower()} " in self.text

    def ends(self, lo: int, p: int, after: int, hi: int) -> bool:
        """Whether the terminators at p (their run, brackets included, ends at ``after``) end a sentence."""
        text = self.text
        mark, q = text[p], after
        while q < hi and text[q].isspace():
            q += 1
        if q >= hi:
            return True
        spaced, nxt = q > after, text[q]
        if mark in "。！？।॥؟۔":
            return nxt not in GOES_ON
        if mark == "…" or text.startswith("..", p):
            if not spaced or _CJK.match(nxt):
                return False
            return self.starts(q, hi) if self.lower else not nxt.islower()
        if mark in "!?":
            return nxt not in GOES_ON and bool(spaced or _CJK.match(nxt) or _CJK.match(text[p - 1]))
        if not spaced:  # a missing space between two sentences
            return after == p + 1 and nxt.isupper() and text[q + 1 : q + 2].islower() and p - lo >= 3 and text[p - 3 : p].isalpha() and text[p - 3 : p].islower()
        if nxt in ",;:":
            return False
        c, k = nxt, q
        while c in OPENERS and k + 1 < hi:
            k += 1
            c = text[k]
        if after > p + 1 and text[p + 1 : after].strip("."):  # a bracket closes behind the period
            return not c.islower() or self.lower
        w = last_word(text, lo, p)
        if not w:
            return True
        before = w[-1]
        if "ऀ" <= before <= "ॿ" and self._danda:
            return False
        if w.isdigit():
            if len(w) <= 2 and text[k : k + 9].split() and text[k : k + 9].split()[0].rstrip(".,") in MONTHS_DE:
                return False
            return self.lower or not c.islower()
        if c.islower() and not self.lower:
            return "؀" <= before <= "ۿ" and w not in ("د", "م")
        return self.after_word(w, lo, p, q, k, c, hi)

    def starts(self, q: int, hi: int) -> bool:
        word = re.match(r"[\w']*", self.text[q : min(hi, q + 24)])[0]
        return word in self.corpus.starters or not word

    def after_word(self, w: str, lo: int, p: int, q: int, k: int, c: str, hi: int) -> bool:
        """Whether a sentence ends behind the word w, its period and a capital, a digit or (in text without capitals) any letter."""
        text, corpus = self.text, self.corpus
        following = re.match(r"\w*", text[k : min(hi, k + 24)])[0]
        if len(w) == 1 and w.isalpha():  # an initial, or a unit behind a number
            if "؀" <= w <= "ۿ":
                return False
            counted = text[max(lo, p - 3) : p - 1].strip()[-1:].isdigit()
            if not counted:
                if w.islower():
                    return False
                return len(following) > 1 and following[:1].isupper() and self.common(following)
            return self.starts(q, hi) if self.lower else True
        if self.lower:
            if w in corpus.never or w.capitalize() in corpus.never:
                return False
            return self.starts(q, hi) if w in corpus.abbreviations or w.capitalize() in corpus.abbreviations or "." in w else True
        if w in corpus.never:
            return False
        own = w in self.abbreviations
        if w in corpus.abbreviations or re.fullmatch(r"(?:[^\W\d_]\.)+[^\W\d_]", w):
            # an abbreviation that may end a sentence: a number goes on; a capitalised word doesn't
            return not c.isdigit() or "." in w
        if own:  # only this document shows that it is one
            return not c.isdigit() and (not following or self.common(following))
        if c.isupper() and len(_plain) < 100_000 and w.isalpha() and len(w) > 2 and w.islower():
            _plain.add(w)
        return True

    def quoted(self, p: int, hi: int) -> int:
        """The place behind the partner of the quotation mark at p, or -1."""
        text, mark = self.text, self.text[p]
        if mark == '"':
            if p and not (text[p - 1].isspace() or text[p - 1] in "([（—–-/"):
                return -1
            j = p
            while (j := text.find('"', j + 1, hi)) >= 0:
                if not text[j - 1].isspace() and (j + 1 >= hi or not text[j + 1].isalnum()):
                    return j + 1
            return -1
        found = [j for c in PAIRS[mark] if (j := text.find(c, p + 1, hi)) >= 0]
        return min(found) + 1 if found else -1

    def quotation_ends(self, begin: int, p: int, close: int, hi: int) -> bool:
        """Whether a sentence ends behind the quotation p..close."""
        text, i = self.text, close - 2
        while i > p and text[i].isspace():
            i -= 1
        if text[i] not in ".!?…。！？।؟":
            return False
        q = close
        while q < hi and text[q].isspace():
            q += 1
        if q >= hi:
            return True
        c = text[q]
        if c in GOES_ON:
            return False
        if _CJK.match(c):
            return c not in PARTICLES
        if c.islower():
            return self.lower and bool(text[begin:p].strip())
        return q > close or not c.isalnum()

    def prose(self, lo: int, hi: int, out: list[tuple[int, int]]) -> None:
        text, begin, skip = self.text, lo, lo
        block = text[lo:hi]
        self.lower = block.lower() == block
        abbreviations = self.abbreviations
        for m in _EVENT.finditer(text, lo, hi):
            p, after = m.span()
            if p < skip:
                continue
            c = text[p]
            if c == "." and after == p + 1:
                following = text[after : after + 2]
                if following[:1].isdigit():  # a decimal
                    continue
                if len(following) == 2 and following[0] == " ":
                    if following[1].islower() and not self.lower and text[p - 1] < "\u0530":
                        continue
                    if following[1].isupper() and (w := text[max(lo, p - 14) : p].rpartition(" ")[2]) in _plain and w not in abbreviations:
                        add(text, begin, after, out)
                        begin = after + 1
                        continue
            if c in PAIRS:
                close = self.quoted(p, hi)
                if close < 0:
                    continue
                skip = close
                if not self.quotation_ends(begin, p, close, hi):
                    continue
                after = close
                while after < hi and text[after] in ")）]】":
                    after += 1
            elif c.isspace():
                after = p
            elif not self.ends(begin, p, after, hi):
                continue
            else:
                while after < hi and text[after] in "”»」』’" and c not in PAIRS:
                    after += 1
            add(text, begin, after, out)
            begin = after
        add(text, begin, hi, out)

    def units(self) -> list[tuple[int, int]]:
        text, out = self.text, []
        lines, at = [], 0
        for raw in re.split(r"\r\n|[\n\r\x0b\x0c\x85  ]", text) if "\r" in text or " " in text else text.split("\n"):
            lines.append((at, at + len(raw), raw.strip()))
            at += len(raw) + (2 if text.startswith("\r\n", at + len(raw)) else 1)
        lo = hi = -1  # the running text so far
        number = 0
        for i, (a, b, s) in enumerate(lines):
            if not s:
                if lo >= 0:
                    self.prose(lo, hi, out)
                lo, number = -1, 0
                continue
            if len(s) >= 20 and " " not in s and _DATA.match(s):
                if lo >= 0:
                    self.prose(lo, hi, out)
                lo = -1
                add(text, a, b, out)
                continue
            if len(s) <= 160 and (lo < 0 or text[hi - 1 : hi] in _END or self.complete(lo, hi)):
                alone, number = self.alone(s, number, lo >= 0, lines[i + 1][2] if i + 1 < len(lines) else "")
                if alone:
                    if lo >= 0:
                        self.prose(lo, hi, out)
                    lo = -1
                    add(text, a, b, out)
                    continue
            if lo < 0:
                lo = a
            hi = a + len(text[a:b].rstrip())
        if lo >= 0:
            self.prose(lo, hi, out)
        return out

    def complete(self, lo: int, hi: int) -> bool:
        return bool(_THAI.match(self.text[hi - 1]))

    def alone(self, s: str, number: int, within: bool, below: str) -> tuple[bool, int]:
        """Whether the line is a unit of its own; the number of a numbered item."""
        m = _LIST.match(s)
        if m:
            n = int(m[1]) if m[1] else 0
            if not n or s[0] == "(" or n == number + 1 or not within:
                return True, n
        last = s[-1]
        if last in ":：":
            body = s[:-1].rstrip()
            return len(body) <= 45 and len(body.split()) <= 6 and not any(c in body for c in ',.;!?"“«„'), 0
        if _LABEL.match(s) and _LABEL_VALUE.search(s) and len(re.split("[:：]", s, maxsplit=1)[0].split()) <= 4 and (last not in "!?。！？।؟…”»」" and not re.search(r"[^\W\d_]{3,}\s+[^\W\d_]{2,}\s+[^\W\d_]+.*[.]\Z", s.split(":", 1)[-1])):
            return True, 0
        if last in _END and last not in ")）":
            return False, 0
        if not _LETTERS.search(s) and not _CJK.search(s) and not _THAI.search(s) or re.fullmatch(r"\S*\d\S*", s):
            return not within or bool(re.search(r"\d", s)), 0
        if _THAI.search(s):
            return False, 0
        if _CJK.search(s):
            return len(s) <= 12, 0
        short = len(s) <= 40 and len(s.split()) <= 6
        return short and (not below or not below[:1].islower() or self.lower) and not (self.lower and len(s) > 30), 0


def add(text: str, a: int, b: int, out: list[tuple[int, int]]) -> None:
    while a < b and text[a].isspace():
        a += 1
    while b > a and text[b - 1].isspace():
        b -= 1
    if a < b:
        out.append((a, b))


def split(text: str | None, corpus: Corpus = Corpus()) -> list[tuple[int, int]]:
    global _plain, _plain_of
    if corpus is not _plain_of:
        _plain, _plain_of = set(), corpus
    return Document(text, corpus).units() if text else []


_BEFORE = re.compile(r"(?<!\w)((?:[^\W\d_]{1,3}\.){0,4}[^\W\d_]{1,12})\.(?=(,)|[ \n]([^\W_]\w*\.?))")
_BEHIND = re.compile(r"[!?][ \n]+([^\W\d_]\w*)")


def _observe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, next, n) of a batch: a word before a period and what follows it (a capitalised word in lower case, with its own period if it has one, ``0`` for what goes on; letters without case say nothing); and starters with an empty word."""
    for b in batches:
        seen: Counter = Counter()
        for text in b.column(0).to_pylist():
            if not text:
                continue
            lines = [x for x in text.split("\n") if not x.islower()]
            for line in lines:
                for w, comma, follows in _BEFORE.findall(line):
                    first = follows[:1]
                    if first.isupper():
                        seen[w, follows.lower()] += 1
                    elif comma or first.islower() or first.isdigit():
                        seen[w, "0"] += 1
                for x in _BEHIND.findall(line):
                    seen["", x.lower()] += 1
        words, follows = zip(*seen) if seen else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(follows, pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "next", "n"])


def evidence(documents: DataFrame) -> DataFrame:
    """word, kind (never, abbreviation or starter): what the counts over all documents say. One scan."""
    seen = checkpoint(spread(documents.select("text")).mapInArrow(_observe, "word string, next string, n long").groupBy("word", "next").agg(F.sum("n").alias("n")))
    behind = seen.filter("word = ''")
    often = F.greatest(F.lit(LEAST), behind.agg(F.sum("n")).scalar() * F.lit(OFTEN))
    starters = behind.filter(F.col("n") >= often).select(F.col("next").alias("s"))
    pairs = seen.filter("word <> ''")
    capital = pairs.filter("next <> '0'").join(starters, F.col("next") == F.col("s"), "left").groupBy("word").agg(F.sum("n").alias("capitals"), F.sum(F.when(F.col("s").isNotNull(), F.col("n")).otherwise(0)).alias("starts"), F.sum(F.when(F.col("next").endswith("."), F.col("n")).when(F.col("s").isNull(), 1).otherwise(0)).alias("names"))
    on = pairs.filter("next = '0'").select("word", F.col("n").alias("on"))
    both = capital.join(on, "word", "full").fillna(0, ["capitals", "starts", "names", "on"])
    few = F.col("starts") < STARTER_SHARE * F.col("capitals")
    never = (F.col("names") >= ALONE) & few | (F.col("on") >= LEAST) & ((F.col("capitals") == 0) | few)
    abbreviation = (F.col("on") >= LEAST) & (F.col("on") >= GOES_ON_SHARE * (F.col("on") + F.col("capitals")))
    kinds = both.select("word", F.when(never, "never").when(abbreviation, "abbreviation").alias("kind")).filter("kind IS NOT NULL")
    # of the starters only those matter that stand behind a period somewhere
    used = starters.join(pairs.select(F.col("next").alias("s")).distinct(), "s").select(F.col("s").alias("word"), F.lit("starter").alias("kind"))
    return kinds.unionByName(used)


def corpus_of(rows: Iterable[tuple[str, str]]) -> Corpus:
    by: dict[str, set[str]] = {"never": set(), "abbreviation": set(), "starter": set()}
    for word, kind in rows:
        by[kind].add(word)
    return Corpus(*(frozenset(by[k]) for k in ("never", "abbreviation", "starter")))


def _words_in(text: str | None) -> list[str]:
    """The words of a text that evidence may be asked for, as written, capitalised and in lower case."""
    out: set[str] = set()
    for w in re.findall(r"[^\W\d_](?:\.?[^\W\d_])*", text or ""):
        if len(w) < 25:
            out |= {w, w.lower(), w.capitalize()}
    return sorted(out)


def _with_own_evidence(base: DataFrame, words: DataFrame) -> DataFrame:
    """doc_id, text, evidence (array of word, kind): the evidence on the words of each document, by a join on the word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_words_in(t) for t in b.column(1).to_pylist()], pa.list_(pa.string()))], names=["doc_id", "text", "words"])

    held = base.mapInArrow(run, "doc_id long, text string, words array<string>").withColumn("__row", F.xxhash64("doc_id", "text"))
    met = held.select("__row", F.explode("words").alias("word")).distinct().join(words, "word").groupBy("__row").agg(F.collect_list(F.struct("word", "kind")).alias("evidence"))
    return held.drop("words").join(met, "__row", "left").select("doc_id", "text", "evidence")


def sentences(documents: DataFrame, with_text: bool = True, most_words: int = MOST_WORDS) -> DataFrame:
    """doc_id, sent_no, sent_begin, sent_end and, if wanted, sentence: the units of every document in order."""
    base = documents.select("doc_id", "text")
    words = checkpoint(evidence(base))
    small = words.count() <= most_words
    sent = documents.sparkSession.sparkContext.broadcast(corpus_of((r.word, r.kind) for r in words.collect())) if small else None
    schema = "doc_id long, sent_no int, sent_begin int, sent_end int" + ", sentence string" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, nos, begins, ends, texts = [], [], [], [], []
            own = b.column(2).to_pylist() if sent is None else None
            for k, (doc_id, text) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist())):
                corpus = sent.value if own is None else corpus_of((e["word"], e["kind"]) for e in own[k] or ())
                units = split(text, corpus)
                ids += [doc_id] * len(units)
                nos += range(len(units))
                begins += [u[0] for u in units]
                ends += [u[1] for u in units]
                if with_text:
                    texts += [text[x:y] for x, y in units]
            arrays = [pa.array(ids, pa.int64()), pa.array(nos, pa.int32()), pa.array(begins, pa.int32()), pa.array(ends, pa.int32())] + [pa.array(texts, pa.string())] * with_text
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "sent_no", "sent_begin", "sent_end"] + ["sentence"] * with_text)

    return (spread(base) if small else _with_own_evidence(base, words)).mapInArrow(run, schema)


def found(documents: DataFrame) -> DataFrame:
    """doc_id, sent_begin, sent_end."""
    return sentences(documents, with_text=False).drop("sent_no")
