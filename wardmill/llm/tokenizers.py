"""Public tokenizers, read from a folder that is a parameter; nothing of them is kept here."""

from __future__ import annotations

import base64
import functools
import os

import numpy as np
import tiktoken

FOLDER = os.environ.get("WARDMILL_TOKENIZERS", "/opt/tokenizers")
DEFAULT = "byte_bpe_multi_50k.tiktoken"
# Fixed value: the pre-tokenisation pattern that the vocabulary's publisher gives.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@functools.cache
def encoding(name: str = DEFAULT, folder: str = FOLDER) -> tiktoken.Encoding:
    """One encoder per process."""
    with open(os.path.join(folder, name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def token_bytes(name: str = DEFAULT, folder: str = FOLDER) -> list[bytes]:
    e = encoding(name, folder)
    out = [b""] * e.n_vocab
    for t, i in e._mergeable_ranks.items():
        out[i] = t
    return out


@functools.cache
def token_lengths(name: str = DEFAULT, folder: str = FOLDER) -> np.ndarray:
    return np.array([len(t) for t in token_bytes(name, folder)], np.int64)
