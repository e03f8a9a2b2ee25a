"""Vectorised words and hashes of UTF-8 bytes, shared by the operators that work inside tasks.

Texts travel as Arrow batches; everything here works on one text, or on some
texts of a batch, as a numpy array of bytes. Temporary arrays stay near
``PIECE`` bytes times eight whatever the length of a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np

PIECE = 1 << 20
#: Bytes from which on a word is hashed by BLAKE2b: sums of odd powers modulo 2**64 tell long regular words badly apart.
LONG_WORD = 64
WHITE = bytes([0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D])


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit values whose output bits all depend on all input bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def mixed(x: np.ndarray) -> np.ndarray:
    return _mixed(x.astype(np.uint64, copy=False))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        more = min(have, n - have)
        step = np.uint64(pow(base, have, 1 << 64))
        out[have : have + more] = out[:more] * step
        have += more
    return out


BASE = 0x9E3779B97F4A7C15
BYTE_VALUE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE))
POWERS = powers(BASE, LONG_WORD)

#: Bytes of words that end at ASCII white space.
NOT_WHITE = np.ones(256, bool)
NOT_WHITE[list(WHITE)] = False
#: Bytes of words made of digits, letters and anything beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x41:0x5B] = ALNUM[0x80:] = True


def lowered(text: str | None) -> np.ndarray:
    """UTF-8 bytes with A-Z lower-cased; null is empty."""
    return np.frombuffer((text or "").encode().lower(), np.uint8)


def spans(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    if not len(mask):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turns = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    if mask[0]:
        turns = np.concatenate([[0], turns])
    if mask[-1]:
        turns = np.concatenate([turns, [len(mask)]])
    return turns[0::2], turns[1::2]


def _span_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    within = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    value = BYTE_VALUE[data[np.repeat(starts, lengths) + within]] * POWERS[within]
    return _mixed(np.add.reduceat(value, first) + lengths.astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, piece by piece."""
    lengths = ends - starts
    out = np.zeros(len(starts), np.uint64)
    short = lengths <= LONG_WORD
    for i in np.flatnonzero(~short):
        digest = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        out[i] = int.from_bytes(digest, "little")
    at = np.flatnonzero(short)
    s, n = starts[at], lengths[at]
    total = np.cumsum(n)
    lo = 0
    while lo < len(at):
        base = total[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(total, base + PIECE, "right")))
        out[at[lo:hi]] = _span_hashes(data, s[lo:hi], n[lo:hi])
        lo = hi
    return out


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n words; with fewer words, one for the whole sequence; none for none."""
    if not len(words):
        return np.zeros(0, np.uint64)
    n = min(n, len(words))
    out = np.zeros(len(words) - n + 1, np.uint64)
    for i in range(n):
        out = out * np.uint64(BASE) + words[i : len(words) - n + 1 + i]
    return _mixed(out + np.uint64(n))


def texts(column) -> Iterator[str]:
    """The strings of an Arrow column one by one, null as an empty text."""
    for value in column:
        yield value.as_py() or ""
