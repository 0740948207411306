"""Notes above a token limit, cut into pieces at natural boundaries.

For each note and profile, dynamic programming over boundary positions minimises the sum of cut
penalties and of squared deviations from the balanced piece size, subject to the limit and to exactly
``overlap_tokens`` tokens shared by neighbours. Positions are graded by what the tokens beside them
hold: blank line, line, sentence, clause, word, character. All positions of clauses and above are weighed;
words and characters, whose price no balance makes up for, are offered where coarser positions lie too far
apart for a feasible cut. Of the positions offered none is left out, and the minimum is exact. Notes are
independent and are cut where they lie; nothing is shuffled. The few limits are collected while the frame
is built.

Sizes are tokens of the whole note under the given public tokenizer. A cut never parts a character.

Defined cases: null, empty and short notes have no pieces; a limit that isn't above the overlap raises
an error; a token run without any boundary is cut between characters, or, if characters of several
tokens leave no such place, with a few more shared tokens than asked.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from wardmill.frames import spread
from wardmill.llm import tokenizers as tk

#: Grades of a position and what cutting there costs.
BLANK, LINE, SENTENCE, CLAUSE, WORD, CHAR, NONE = range(7)
PENALTY = (0.0, 0.15, 0.3, 1.0, 2.5, 8.0, 1e6)
_PRICE = np.array(PENALTY)
IMBALANCE = 1.0
# Words whose period doesn't end a sentence.
TITLES = "Dr Mr Mrs Ms Prof Sgt Lt St Sr Sra Dra Hr Fig No vs approx incl etc ca env aprox bzw Ref Resp Sat Temp pt Cf".split()


@functools.cache
def _classes(name: str, folder: str) -> dict:
    texts = tk.token_bytes(name, folder)
    out = {k: np.zeros(len(texts), bool) for k in ("lines2", "line", "space", "blank", "sentence", "wide", "clause", "closer", "lead", "cjk", "title", "thai")}
    titles = {t.encode() for t in TITLES}
    for i, b in enumerate(texts):
        s = b.decode("utf-8", "ignore")
        body = s.rstrip("\"'”’»)]）」』")
        out["lines2"][i] = s.count("\n") > 1
        out["line"][i] = "\n" in s
        out["space"][i] = s[:1].isspace()
        out["blank"][i] = bool(s) and s.isspace()
        out["sentence"][i] = body[-1:] in tuple(".!?…")
        out["wide"][i] = body[-1:] in tuple("。！？।؟॥")
        out["clause"][i] = body[-1:] in tuple(",;:，；：、،")
        out["closer"][i] = bool(s) and not body
        out["lead"][i] = b[:1] < b"\x80" or b[:1] >= b"\xc0"
        out["cjk"][i] = "぀" <= s[:1] <= "鿿" or "฀" <= s[:1] <= "๿"
        out["thai"][i] = "฀" <= s.strip()[:1] <= "๿"
        out["title"][i] = b.strip() in titles
    out["plain"] = texts.index(b"a")
    return out


def grades(ids: np.ndarray, name: str = tk.DEFAULT, folder: str = tk.FOLDER) -> np.ndarray:
    """The grade of the position before each token; the first and those within a character aren't cuts."""
    return many_grades([ids], name, folder)[0]


def many_grades(notes: list[np.ndarray], name: str = tk.DEFAULT, folder: str = tk.FOLDER) -> list[np.ndarray]:
    """``grades`` of several notes in one pass over their tokens, parted by a token that is neither mark nor space."""
    c = _classes(name, folder)
    part = np.array([c["plain"], c["plain"]])
    ids = np.concatenate([x for n in notes for x in (part, n)]).astype(np.int64)
    here, prev, before = ids[2:], ids[1:-1], ids[:-2]
    lead, space = c["lead"][here], c["space"][here]
    line = c["line"][prev] & ~c["line"][here]
    blank = line & (c["lines2"][prev] | c["line"][before] & c["blank"][prev])
    closer = c["closer"][prev]
    stop = (c["sentence"][prev] | closer & c["sentence"][before]) & space & ~c["title"][before]
    wide = c["wide"][prev] | closer & c["wide"][before] | c["thai"][here] & space
    clause = c["clause"][prev] & (space | c["cjk"][here])
    word = space | c["blank"][prev] | c["cjk"][here]
    inner = ~c["line"][here]
    g = np.full(len(here), CHAR, np.int8)
    for holds, grade in ((word, WORD), (clause & inner, CLAUSE), ((stop | wide) & inner & ~c["closer"][here], SENTENCE), (line, LINE), (blank, BLANK), (~lead, NONE)):
        g[holds] = grade
    out, at = [], 0
    for n in notes:
        one = g[at : at + len(n)]
        one[:1] = NONE
        out.append(one)
        at += len(n) + 2
    return out


def candidates(g: np.ndarray, step: int) -> np.ndarray:
    """All positions of clauses and above; where these lie more than a step apart, all finer ones between."""
    n = len(g)
    at = np.flatnonzero(g <= CLAUSE)
    for grade in (WORD, CHAR):
        edges = np.concatenate([[0], at, [n]])
        gaps = np.flatnonzero(edges[1:] - edges[:-1] > step)
        if not len(gaps):
            break
        at = np.sort(np.concatenate([at, *[a + 1 + np.flatnonzero(g[a + 1 : b] == grade) for a, b in zip(edges[gaps].tolist(), edges[gaps + 1].tolist())]]))
    return at


def offers(g: np.ndarray, at: np.ndarray, limit: int, overlap: int) -> tuple[list[int], list[int], list[float]]:
    """Positions, where the piece after each begins, and what cutting there costs."""
    starts = at - overlap
    moved = (g[starts] == NONE) & (starts > 0)
    for i in np.flatnonzero(moved):  # a character has four tokens at most
        near = [x for x in range(starts[i] - 1, max(starts[i] - 4, at[i] - limit, -1), -1) if g[x] != NONE or not x]
        starts[i] = near[0] if near else starts[i]
    prices = _PRICE[g[at]] + (0.5 * moved if overlap else 0.0)
    return at.tolist(), starts.tolist(), prices.tolist()


def cuts(g: np.ndarray, limit: int, overlap: int) -> list[tuple[int, int]]:
    """(first token, end) of the pieces of a note whose positions are graded ``g``.

    The deviation is a convex function of a piece's end less its begin, so of two cuts the later, once it
    is the better one to come from, stays so. ``queue`` holds the cuts that are best from some end on,
    ``since`` those ends; each cut goes in and out once, so all positions are weighed in linear time.
    """
    n, step = len(g), limit - overlap
    if n <= limit:
        return [(0, n)]
    target = (n - overlap) / -(-(n - overlap) // step) + overlap
    at = candidates(g, step)
    places, starts, prices = offers(g, at[at > overlap], limit, overlap)
    places, starts, prices = [0, *places, n], [0, *starts, n], [0.0, *prices, 0.0]
    cost, back, queue, since = [0.0], [-1], [0], [0.0]
    head, j, half = 0, 1, target * target / (2 * IMBALANCE)
    while j < len(places):
        p, last = places[j], len(queue) - 1
        while head < last and since[head + 1] < p:
            head += 1
        i = queue[head]
        s = starts[i]
        if p - s > limit:  # out of reach of all cuts before: whatever position lies between, else a hard cut, here only
            a = max(places[j - 1], overlap) + 1
            more = a + np.flatnonzero(g[a : s + limit + 1] < NONE)
            more = more if len(more) else np.array([s + limit])
            for column, x in zip((places, starts, prices), offers(g, more, limit, overlap)):
                column[j:j] = x
            continue
        d = (p - s) / target - 1
        c = cost[i] + IMBALANCE * d * d + prices[j]
        cost.append(c)
        back.append(i)
        s = starts[j]
        while True:
            k = queue[-1]
            gap = s - starts[k]
            if gap <= 0:
                if c >= cost[k]:
                    break
                if last == head:
                    queue[-1] = j
                    break
            else:
                x = target + (s + starts[k]) / 2 + (c - cost[k]) * half / gap
                if x > starts[k] + limit:
                    x = starts[k] + limit
                if last == head or x > since[-1]:
                    queue.append(j)
                    since.append(x)
                    break
            queue.pop()
            since.pop()
            last -= 1
        j += 1
    out, j = [], len(places) - 1
    while j > 0:
        out.append((starts[back[j]], places[j]))
        j = back[j]
    return out[::-1]


def split_notes(documents: DataFrame, limits: DataFrame, tokenizer: str = tk.DEFAULT, folder: str = tk.FOLDER) -> DataFrame:
    """doc_id, profile, piece_no, token_begin, token_end, piece: the notes above a profile's limit in pieces.

    ``limits`` is a table of a few profiles and goes to the tasks as a parameter.
    """
    profiles = [(r.profile, r.max_tokens, r.overlap_tokens or 0) for r in limits.select("profile", "max_tokens", "overlap_tokens").dropna(subset=["profile", "max_tokens"]).distinct().orderBy("profile").collect()]
    for name, most, overlap in profiles:
        if overlap >= most or overlap < 0:
            raise ValueError(f"profile {name}: the overlap must be below the limit")
    least = min((m for _, m, _ in profiles), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, lengths = tk.encoding(tokenizer, folder), tk.token_lengths(tokenizer, folder)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                out: list[list] = [[] for _ in range(6)]
                notes, held = [], []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    if text and profiles and len(text) * 4 > least:
                        ids = enc.encode_ordinary(text)
                        if len(ids) > least:
                            notes.append(np.array(ids, np.int64))
                            held.append((doc_id, text))
                for (doc_id, text), ids, g in zip(held, notes, many_grades(notes, tokenizer, folder) if notes else []):
                    raw = text.encode("utf-8", "replace")
                    ends = np.concatenate([[0], np.cumsum(lengths[ids])]).tolist()
                    for name, most, overlap in profiles:
                        if len(ids) > most:
                            found = cuts(g, most, overlap)
                            out[0] += [doc_id] * len(found)
                            out[1] += [name] * len(found)
                            out[2] += range(len(found))
                            out[3] += [s for s, _ in found]
                            out[4] += [e for _, e in found]
                            out[5] += [raw[ends[s] : ends[e]].decode("utf-8", "replace") for s, e in found]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.string()))], names=["doc_id", "profile", "piece_no", "token_begin", "token_end", "piece"])

    return spread(documents.select("doc_id", "text")).mapInArrow(run, "doc_id long, profile string, piece_no int, token_begin int, token_end int, piece string")
