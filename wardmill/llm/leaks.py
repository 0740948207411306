"""Evaluation passages inside training documents.

A passage leaks if a window of the item (12 consecutive words, or 20 consecutive letters or digits for
languages written without spaces) stands in the document with at most ``budget`` edits. By the
pigeonhole principle a window with ``budget`` edits that holds ``budget + 1`` whole pieces of the item
has one of them unharmed: items are cut on a grid fine enough that every window does. All pieces are
looked for at once with one automaton; each exact hit names the windows around it, and what comes out is
verified with Myers' bit-parallel distance over words (or characters): the run of equal units around a hit
first, as one window, then the others that lack no more units than the budget allows.

The items are a stated query set: they are sent to the tasks in blocks of bounded size, one pass over
the documents per block (they are read for it while the frame is built); a process builds the index of a
block once. The documents never leave their partitions.

Defined cases: null and empty texts, on either side, and items shorter than a window give no rows;
repeated items are compared once each and the least distance per (document, item) comes out; repeated
documents come out once per id; an item that differs in case, punctuation or spacing counts as equal.
"""

from __future__ import annotations

import itertools
import re
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardmill.frames import spread

_WORD = re.compile(r"[^\W_]+")
_UNSPACED = re.compile("[぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003134f]")
WINDOWS = {"words": 12, "chars": 20}
#: Languages whose passages are compared by letter.
UNSPACED_LANGS = ("zh",)
#: Characters of item text in one pass over the documents.
BLOCK_CHARS = 8_000_000


def grid(window: int, budget: int) -> int:
    """The longest piece of which every window holds budget + 1 whole ones."""
    return max(1, (window + 1) // (budget + 2))


def myers(pattern: list, text: list, most: int) -> int:
    """Least edit distance of the pattern to any stretch of the text, or most + 1."""
    m = len(pattern)
    peq: dict = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    ones, top = (1 << m) - 1, 1 << m - 1
    pv, mv, score = ones, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & ones
        mh = pv & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph = ph << 1 & ones
        mh = mh << 1 & ones
        pv = mh | ~(xv | ph) & ones
        mv = ph & xv
        if score < best:
            best = score
    return min(best, most + 1)


class Index:
    """The pieces of a block of items, by mode (words or chars)."""

    def __init__(self, items: list[tuple[int, str, str | None]], budget: int):
        self.budget, self.items = budget, {"words": [], "chars": []}
        #: Whether a document without a letter of an unspaced script can't share a window with any of these items.
        self.telling = True
        pieces: dict[str, dict[str, list[tuple[int, int]]]] = {"words": {}, "chars": {}}
        for item_id, text, lang in items:
            words = _WORD.findall(text.casefold())
            mode = "chars" if (lang or "").lower().split("-")[0] in UNSPACED_LANGS else "words"
            seq = list("".join(words)) if mode == "chars" else words
            window, step = WINDOWS[mode], grid(WINDOWS[mode], budget)
            if len(seq) < window:
                continue
            if mode == "chars":
                before = [0, *itertools.accumulate(bool(_UNSPACED.match(c)) for c in seq)]
                self.telling &= all(b - a > budget for a, b in zip(before, before[window:]))
            k = len(self.items[mode])
            self.items[mode].append((item_id, seq))
            for at in range(0, len(seq) - step + 1, step):
                piece = "".join(seq[at : at + step]) if mode == "chars" else " " + " ".join(seq[at : at + step]) + " "
                pieces[mode].setdefault(piece, []).append((k, at))
        self.automata = {}
        for mode, found in pieces.items():
            if found:
                a = ahocorasick.Automaton()
                for piece, places in found.items():
                    a.add_word(piece, (len(piece), places))
                a.make_automaton()
                self.automata[mode] = a

    def hits(self, text: str) -> dict[int, tuple[int, int, int]]:
        """item_id -> (distance, first unit in the item, first unit in the document)."""
        out: dict[int, tuple[int, int, int]] = {}
        words = None
        if "words" in self.automata:
            words = _WORD.findall(text.casefold())
            if len(words) >= WINDOWS["words"] - self.budget:
                line = " " + " ".join(words) + " "
                self._search("words", line, words, out)
        if "chars" in self.automata and (not self.telling or _UNSPACED.search(text)):
            line = "".join(words if words is not None else _WORD.findall(text.casefold()))
            self._search("chars", line, line, out)
        return out

    def _search(self, mode: str, line: str, units, out: dict) -> None:
        window, budget, seen = WINDOWS[mode], self.budget, set()
        step = grid(window, budget)
        last, count = 0, 0
        for end, (size, places) in self.automata[mode].iter(line):
            begin = end - size + 1
            if mode == "words":  # the number of the word there, counted on from the last hit
                if begin < last:
                    last, count = 0, 0
                count += line.count(" ", last, begin)
                last, at = begin, count
            else:
                at = begin
            near = None
            for k, piece_at in places:
                item_id, seq = self.items[mode][k]
                known = out.get(item_id, (budget + 1, 0, 0))[0]
                if not known:
                    continue
                left, right = 0, step  # the run of equal units around the piece
                while left < min(piece_at, at) and units[at - left - 1] == seq[piece_at - left - 1]:
                    left += 1
                while piece_at + right < len(seq) and at + right < len(units) and units[at + right] == seq[piece_at + right]:
                    right += 1
                if left + right >= window:
                    d = myers(seq[piece_at - left : piece_at - left + window], units[at - left : at - left + window], 0)
                    if not d:
                        out[item_id] = (d, piece_at - left, at - left)
                        continue
                if known <= 1 or not budget:  # less than 1 needs a run
                    continue
                if near is None:
                    near = set(units[max(0, at - window - budget) : at + step + window + budget])
                first = max(0, piece_at + step - window)
                lacks = [u not in near for u in seq[first : piece_at + window]]
                for s in range(first, min(piece_at, len(seq) - window) + 1):
                    d0 = at - piece_at + s
                    if sum(lacks[s - first : s - first + window]) >= known or (k, s, d0) in seen:
                        continue
                    seen.add((k, s, d0))
                    d = myers(seq[s : s + window], units[max(0, d0 - budget) : max(0, d0 + window + budget)], budget)
                    if d < known:
                        known = d
                        out[item_id] = (d, s, max(d0, 0))
                        if d <= 1:
                            break


#: The index of the block that the process read last.
_built: dict[tuple[int, int], Index] = {}


class _Sent(NamedTuple):
    """A block of items in the tasks, and a number of its own."""

    number: int
    items: Broadcast


def _index(number: int, block: list[tuple[int, str, str | None]], budget: int) -> Index:
    if (number, budget) not in _built:
        _built.clear()
        _built[number, budget] = Index(block, budget)
    return _built[number, budget]


def _blocks(items: DataFrame) -> Iterator[list[tuple[int, str, str | None]]]:
    block, size = [], 0
    for r in items.select("item_id", "text", "lang").filter(F.col("text").isNotNull() & F.col("item_id").isNotNull()).toLocalIterator():
        if size + len(r.text) > BLOCK_CHARS and block:
            yield block
            block, size = [], 0
        block.append((r.item_id, r.text, r.lang))
        size += len(r.text)
    if block:
        yield block


def find_leaks(documents: DataFrame, items: DataFrame, budget: int = 1) -> DataFrame:
    """doc_id, item_id, distance, item_at, doc_at: each item with a window in the document within the budget.

    Positions count words, or letters and digits for the unspaced languages.
    """
    spark = documents.sparkSession
    schema = "doc_id long, item_id long, distance int, item_at int, doc_at int"
    out = None
    for block in _blocks(items):
        sent = _Sent(uuid.uuid4().int, spark.sparkContext.broadcast(block))

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index = _index(sent.number, sent.items.value, budget)
            for b in batches:
                rows: list[list] = [[], [], [], [], []]
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if text:
                        for item_id, (d, s, at) in index.hits(text).items():
                            for column, v in zip(rows, (doc_id, item_id, d, s, at)):
                                column.append(v)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()))], names=["doc_id", "item_id", "distance", "item_at", "doc_at"])

        part = spread(documents.select("doc_id", "text")).mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return spark.createDataFrame([], schema)
    best = F.min(F.struct("distance", "item_at", "doc_at")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.*")


def found(documents: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, item_id: an unharmed window, that is a shared run of at least 12 words (20 letters or digits)."""
    return find_leaks(documents, items).filter("distance = 0").select("doc_id", "item_id")
