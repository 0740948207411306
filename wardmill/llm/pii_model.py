"""Character-level bidirectional LSTM with CRF transitions, in numpy: training and decoding."""

from __future__ import annotations

import functools
import os

import numpy as np

from wardmill.llm.pii_corpus import KINDS, Maker

PATH = os.path.join(os.path.dirname(__file__), "pii_model.npz")
TAGS = ("O", *[p + k for k in KINDS for p in ("B-", "I-")])
K = len(TAGS)
_KNOWN = "\n !\"#$%&'()*+,-./0123456789:;<=>?@ABCDEFGHIJKLMNOPQRSTUVWXYZ[\\]^_`abcdefghijklmnopqrstuvwxyz{|}~"
CHARS = 1 + len(_KNOWN) + 5  # pad, the known ones, other: lower, upper, letter, digit, rest
WINDOW, STRIDE = 192, 128


def _code(c: str) -> int:
    i = _KNOWN.find(c)
    if i >= 0:
        return i + 1
    if c.isspace():
        return _KNOWN.find(" ") + 1
    k = 0 if c.islower() else 1 if c.isupper() else 2 if c.isalpha() else 3 if c.isdigit() else 4
    return 1 + len(_KNOWN) + k


_TABLE = np.array([_code(chr(i)) for i in range(0x3000)], np.int16)


def encode(text: str) -> np.ndarray:
    return encode_all([text])[0]


def encode_all(texts: list[str]) -> list[np.ndarray]:
    """Codes of many texts, read as one."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.where(points < 0x3000, _TABLE[np.minimum(points, 0x2FFF)], 1 + len(_KNOWN) + 2).astype(np.int16)
    return np.split(codes, np.cumsum([len(t) for t in texts])[:-1]) if texts else []


def allowed() -> np.ndarray:
    """Transitions the tags permit: I only after B or I of its kind."""
    ok = np.ones((K, K), bool)
    for j in range(2, K, 2):
        ok[:, j] = False
        ok[j - 1, j] = ok[j, j] = True
    return ok


def init(embed: int = 24, hidden: int = 40, seed: int = 1) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
    p = {"E": f(CHARS, embed) * np.float32(3), "out": f(2 * hidden, K), "bo": np.zeros(K, np.float32), "T": np.zeros((K, K), np.float32)}
    for d in "fb":
        p["W" + d], p["U" + d] = f(embed, 4 * hidden), f(hidden, 4 * hidden)
        p["b" + d] = np.concatenate([np.zeros(hidden), np.ones(hidden), np.zeros(2 * hidden)]).astype(np.float32)
    return p


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


def lstm(x: np.ndarray, table: np.ndarray, U: np.ndarray, keep: bool = False):
    """x: codes, time first. The hidden states, and with ``keep`` what the way back needs."""
    L, B = x.shape
    H = U.shape[0]
    h, c = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
    hs = np.empty((L, B, H), np.float32)
    saved = []
    for t in range(L):
        z = table[x[t]]
        z += h @ U
        g = np.tanh(z[:, 3 * H :])
        s = _sigmoid(z[:, : 3 * H])
        before = c
        c = s[:, H : 2 * H] * c + s[:, :H] * g
        tc = np.tanh(c)
        if keep:
            saved.append((h, before, s, g, tc))
        h = s[:, 2 * H :] * tc
        hs[t] = h
    return (hs, saved) if keep else hs


def back(x, table_grad, U, saved, dhs):
    L, B = x.shape
    H = U.shape[0]
    dU = np.zeros_like(U)
    dzs = np.empty((L, B, 4 * H), np.float32)
    dh, dc = np.zeros((B, H), np.float32), np.zeros((B, H), np.float32)
    for t in range(L - 1, -1, -1):
        h, before, s, g, tc = saved[t]
        dh = dh + dhs[t]
        o = s[:, 2 * H :]
        dc = dc + dh * o * (1 - tc * tc)
        dz = dzs[t]
        dz[:, :H] = dc * g
        dz[:, H : 2 * H] = dc * before
        dz[:, 2 * H : 3 * H] = dh * tc
        dz[:, : 3 * H] *= s * (1 - s)
        dz[:, 3 * H :] = dc * s[:, :H] * (1 - g * g)
        dU += h.T @ dz
        dh = dz @ U.T
        dc = dc * s[:, H : 2 * H]
    hot = np.zeros((table_grad.shape[0], L * B), np.float32)
    hot[x.reshape(-1), np.arange(L * B)] = 1
    table_grad += hot @ dzs.reshape(L * B, 4 * H)
    return dU


def fast_lstm(x: np.ndarray, live: np.ndarray, table: np.ndarray, U: np.ndarray) -> np.ndarray:
    """The hidden states of ``lstm`` as (time, sequence, unit); x: codes, time first.

    The sequences come longest first, and only the first ``live[t]`` of them have a character at step t, so
    none is padded. A sigmoid is a tanh of half its argument: one tanh a step does for all gates.
    """
    L, B = x.shape
    H = U.shape[0]
    half = np.repeat(np.float32([0.5, 0.5, 0.5, 1]), H)
    table, U = table * half, U * half
    hs, c = np.zeros((L, B, H), np.float32), np.zeros((B, H), np.float32)
    m = np.empty((B, 4 * H), np.float32)
    h = np.zeros((B, H), np.float32)
    for t in range(L):
        n = live[t]
        z = table.take(x[t, :n], axis=0, mode="clip")
        z += np.matmul(h[:n], U, out=m[:n])
        np.tanh(z, out=z)
        z[:, : 3 * H] += 1
        i, f, o, g = (z[:, k * H : (k + 1) * H] for k in range(4))
        now = c[:n]
        now *= f
        i *= g
        now += i
        now *= np.float32(0.5)
        h = hs[t]
        np.tanh(now, out=h[:n])
        o *= np.float32(0.5)
        h[:n] *= o
    return hs


def emissions(p: dict, codes: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Scores (time, tag, sequence) of sequences given longest first, and how many have a character at each time.

    Both directions begin at their own end of a sequence, the backward one behind two characters of
    padding. Behind its end a sequence scores as certainly outside.
    """
    size = np.array([len(c) for c in codes])
    L, B, H = int(size[0]), len(codes), p["Uf"].shape[0]
    x, y = np.zeros((L, B), np.int16), np.zeros((L + 2, B), np.int16)
    for j, c in enumerate(codes):
        x[: len(c), j] = c
        y[2 : len(c) + 2, j] = c[::-1]
    live = B - np.searchsorted(size[::-1], np.arange(L), side="right")
    forth = fast_lstm(x, live, p["E"] @ p["Wf"] + p["bf"], p["Uf"])
    back = fast_lstm(y, np.concatenate([[B, B], live]), p["E"] @ p["Wb"] + p["bb"], p["Ub"])
    # the backward state of the character at t stands at len + 1 - t
    at = np.maximum(size + 1 - np.arange(L)[:, None], 0)
    back = back[at, np.arange(B)]
    e = np.matmul(forth.reshape(L * B, H), p["out"][:H])
    e += np.matmul(back.reshape(L * B, H), p["out"][H:])
    e += p["bo"]
    e = np.ascontiguousarray(e.reshape(L, B, K).transpose(0, 2, 1))
    for t in range(int(size[-1]), L):
        e[t, 0, live[t] :] = 0
        e[t, 1:, live[t] :] = -1e6
    return e, live


def loss_and_gradient(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Negative log-likelihood a character of tag sequences y, and its gradient."""
    L, B = x.shape
    H = p["Uf"].shape[0]
    tf, tb = p["E"] @ p["Wf"] + p["bf"], p["E"] @ p["Wb"] + p["bb"]
    hf, sf = lstm(x, tf, p["Uf"], True)
    hb, sb = lstm(x[::-1], tb, p["Ub"], True)
    h = np.concatenate([hf, hb[::-1]], axis=2)
    e = h @ p["out"] + p["bo"]
    # forward and backward in probabilities, normalised at each step
    top = e.max(axis=2, keepdims=True)
    q = np.exp(e - top)
    A = np.exp(p["T"]) * allowed()
    start = np.array([0.0 if t and t % 2 == 0 else 1.0 for t in range(K)], np.float32)
    a = np.empty_like(q)
    n = np.empty((L, B, 1), np.float32)
    v = q[0] * start
    for t in range(L):
        if t:
            v = (a[t - 1] @ A) * q[t]
        n[t] = v.sum(axis=1, keepdims=True)
        a[t] = v / n[t]
    b = np.empty_like(q)
    b[L - 1] = 1
    dA = np.zeros_like(A)
    for t in range(L - 1, 0, -1):
        w = q[t] * b[t] / n[t]
        dA += a[t - 1].T @ w
        b[t - 1] = w @ A.T
    gold = np.take_along_axis(e, y[:, :, None], 2).sum() + p["T"][y[:-1], y[1:]].sum()
    total = float(np.log(n).sum() + top.sum())
    scale = np.float32(1.0 / (L * B))
    de = a * b
    np.put_along_axis(de, y[:, :, None], np.take_along_axis(de, y[:, :, None], 2) - 1, 2)
    de *= scale
    dT = A * dA
    np.subtract.at(dT, (y[:-1], y[1:]), 1)
    g = {"T": (dT * scale).astype(np.float32), "out": h.reshape(L * B, -1).T @ de.reshape(L * B, K), "bo": de.sum(axis=(0, 1))}
    dh = de @ p["out"].T
    gf, gb = np.zeros_like(tf), np.zeros_like(tb)
    g["Uf"] = back(x, gf, p["Uf"], sf, dh[:, :, :H])
    g["Ub"] = back(x[::-1], gb, p["Ub"], sb, dh[::-1, :, H:])
    g["Wf"], g["Wb"], g["bf"], g["bb"] = p["E"].T @ gf, p["E"].T @ gb, gf.sum(axis=0), gb.sum(axis=0)
    g["E"] = gf @ p["Wf"].T + gb @ p["Wb"].T
    return (total - float(gold)) * float(scale), g


def example(maker: Maker, length: int) -> tuple[np.ndarray, np.ndarray]:
    text, spans = maker.text()
    x, y = np.zeros(length, np.int16), np.zeros(length, np.int64)
    codes = encode(text)
    tags = np.zeros(len(codes), np.int64)
    for a, b, kind in spans:
        k = 1 + 2 * KINDS.index(kind)
        tags[a] = k
        tags[a + 1 : b] = k + 1
    n = min(length, len(codes))
    x[:n], y[:n] = codes[:n], tags[:n]
    return x, y


def _work(seed: int, pipe, batch: int) -> None:
    maker = Maker(seed)
    while True:
        p = pipe.recv()
        if p is None:
            return
        length = maker.one([64, 96, 96, 128, 160])
        made = [example(maker, length) for _ in range(batch)]
        x, y = np.stack([m[0] for m in made], 1), np.stack([m[1] for m in made], 1)
        pipe.send(loss_and_gradient(p, x, y))


def train(path: str = PATH, minutes: float = 5, workers: int = 8, batch: int = 64, rate: float = 4e-3, hidden: int = 40, most_steps: int = 20_000, start: dict | None = None, first_seed: int = 100) -> dict:
    """Fits on generated spans: at most most_steps x workers x batch texts. Gradients are taken in processes and averaged."""
    import multiprocessing as mp
    import time

    ctx = mp.get_context("fork")
    p = start or init(hidden=hidden)
    pipes, procs = [], []
    for w in range(workers):
        here, there = ctx.Pipe()
        q = ctx.Process(target=_work, args=(first_seed + w, there, batch), daemon=True)
        q.start()
        pipes.append(here)
        procs.append(q)
    m, v = {k: np.zeros_like(a) for k, a in p.items()}, {k: np.zeros_like(a) for k, a in p.items()}
    began, step, shown = time.time(), 0, 0.0
    while (spent := (time.time() - began) / 60 / minutes) < 1 and step < most_steps:
        for c in pipes:
            c.send(p)
        got = [c.recv() for c in pipes]
        step += 1
        lr = rate * min(1, step / 50) * (0.5 + 0.5 * np.cos(np.pi * spent)) + 1e-5
        g = {k: sum(x[1][k] for x in got) / len(got) for k in p}
        size = np.sqrt(sum(float((a * a).sum()) for a in g.values()))
        clip = min(1.0, 0.5 / (size + 1e-9))
        for k in p:
            d = g[k] * clip
            m[k] = 0.9 * m[k] + 0.1 * d
            v[k] = 0.99 * v[k] + 0.01 * d * d
            p[k] = (p[k] - lr * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        if time.time() - shown > 20:
            shown = time.time()
            print(step, f"{np.mean([x[0] for x in got]):.5f}", f"{size:.4f}", flush=True)
    for c in pipes:
        c.send(None)
    np.savez_compressed(path, **{k: a.astype(np.float32) for k, a in p.items()})
    return p


@functools.cache
def load(path: str = PATH) -> dict[str, np.ndarray]:
    with np.load(path) as f:
        return {k: f[k] for k in f.files}


def surely_outside(p: dict) -> float:
    """A margin of O at every character with which no other path can win: twice the most a transition can gain."""
    T = p["T"][allowed()]
    return 2 * max(0.0, float(T.max() - p["T"][0, 0]))


def viterbi(p: dict, e: np.ndarray) -> np.ndarray:
    """Best tags (time, sequence) of sequences of one length; e: time, tag, sequence.

    O and the B tags can follow any tag, an I tag only B or I of its kind. No back pointers are kept: the
    way back first asks whether O led to the tag that was reached, and only where it didn't for the others.
    """
    L, _, B = e.shape
    T = np.where(allowed(), p["T"], np.float32(-1e9)).astype(np.float32)
    free, begins, inner = np.array([0, *range(1, K, 2)]), np.arange(1, K, 2), np.arange(2, K, 2)
    to_free = np.ascontiguousarray(T[:, free])[:, :, None]
    from_begin, from_inner = T[begins, inner][:, None], T[inner, inner][:, None]
    v, best = np.empty((L, K, B), np.float32), np.empty((L, K, B), np.float32)
    v[0] = e[0]
    v[0, inner] = -1e9
    sums, top = np.empty((K, len(free), B), np.float32), np.empty((len(free), B), np.float32)
    for t in range(1, L):
        last, now = v[t - 1], best[t]
        np.add(last[:, None, :], to_free, out=sums)
        np.maximum.reduce(sums, axis=0, out=top)
        now[free] = top
        now[inner] = np.maximum(last[begins] + from_begin, last[inner] + from_inner)
        np.add(now, e[t], out=v[t])
    tags = np.empty((L, B), np.int8)
    tags[L - 1] = v[L - 1].argmax(axis=0)
    every = np.arange(B)
    for t in range(L - 1, 0, -1):
        to = tags[t]
        tags[t - 1] = 0
        other = np.flatnonzero(v[t - 1, 0] + T[0, to] != best[t, to, every])
        if len(other):
            tags[t - 1, other] = (v[t - 1][:, other] + T[:, to[other]]).argmax(axis=0)
    return tags


def spans_of(tags: np.ndarray) -> list[list[tuple[int, int, str]]]:
    """The spans of each sequence from its tags (time, sequence)."""
    L, B = tags.shape
    out: list[list[tuple[int, int, str]]] = [[] for _ in range(B)]
    goes_on = (tags > 0) & (tags % 2 == 0)
    stops = np.where(goes_on, L, np.arange(L)[:, None])
    following = np.full((L + 1, B), L)
    following[:L] = np.minimum.accumulate(stops[::-1], axis=0)[::-1]  # the next place that doesn't go on
    t, j = np.nonzero(tags % 2 == 1)
    for b, k, e, s in zip(t.tolist(), tags[t, j].tolist(), following[t + 1, j].tolist(), j.tolist()):
        out[s].append((b, e, KINDS[(k - 1) // 2]))
    return out


#: Characters of text that are scored in one go.
BLOCK_CHARS = 32_000


def decode(p: dict, texts: list[str]) -> list[list[tuple[int, int, str]]]:
    """Spans of each text. Texts longer than a window are scored in overlapping windows; the scores are
    blended with weights that fall toward the windows' edges, and one Viterbi pass reads the whole text.
    Short texts are read in blocks of like lengths and of about ``BLOCK_CHARS`` characters."""
    codes = encode_all(texts)
    out: list[list] = [[] for _ in texts]
    size = np.array([len(c) for c in codes], np.int64)
    for i in np.flatnonzero(size > WINDOW).tolist():
        out[i] = _long(p, codes[i])
    order = np.argsort(-size, kind="stable")
    order = order[(size[order] > 0) & (size[order] <= WINDOW)]
    at, outside = 0, -surely_outside(p)
    while at < len(order):
        part = order[at : at + max(64, BLOCK_CHARS // int(size[order[at]]))]
        at += len(part)
        e, _ = emissions(p, [codes[i] for i in part])
        unsure = np.flatnonzero((e[:, 1:].max(axis=1) - e[:, 0]).max(axis=0) > outside)
        if len(unsure):
            for u, found in zip(unsure.tolist(), spans_of(viterbi(p, np.ascontiguousarray(e[:, :, unsure])))):
                out[part[u]] = found
    return out


def _long(p: dict, code: np.ndarray) -> list[tuple[int, int, str]]:
    n = len(code)
    starts = list(range(0, max(1, n - WINDOW + STRIDE), STRIDE))
    weight = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)
    e, w = np.zeros((n, K), np.float32), np.zeros((n, 1), np.float32)
    for at in range(0, len(starts), 256):
        part = starts[at : at + 256]  # only the last window of a text is shorter than the others
        scores, _ = emissions(p, [code[s : s + WINDOW] for s in part])
        for j, s in enumerate(part):
            m = min(WINDOW, n - s)
            ramp = weight.copy()
            if s == 0:
                ramp[: WINDOW // 2] = WINDOW // 2
            if s + WINDOW >= n:
                ramp[WINDOW // 2 :] = WINDOW // 2
            e[s : s + m] += scores[:m, :, j] * ramp[:m, None]
            w[s : s + m] += ramp[:m, None]
    return spans_of(viterbi(p, (e / w)[:, :, None]))[0]


if __name__ == "__main__":
    import sys

    again = len(sys.argv) > 2  # goes on from the weights that are there
    train(minutes=float(sys.argv[1]) if len(sys.argv) > 1 else 8, start=dict(load()) if again else None, first_seed=7_000 if again else 100)
