"""Suffix order of a byte string by two-stage sorting, and common prefixes of neighbours.

Stage one sorts directly only the suffixes that are smaller than their
successors. Stage two goes through the buckets of the first byte in ascending
order and induces the others: a suffix larger than its successor stands, within
its bucket, in the order of its successor. Depth ends at ``length`` bytes:
suffixes that agree so far stand next to each other in any order.
"""

from __future__ import annotations

import numpy as np

from adlift.llm.textbytes import spans


def _words(data: np.ndarray, pad: int) -> np.ndarray:
    """The eight bytes from each position as one number; zeros follow the end."""
    out = np.concatenate([data, np.zeros(pad + 8, np.uint8)]).astype(np.uint64)
    for step in (1, 2, 4):
        out = (out[:-step] << np.uint64(8 * step)) | out[step:]
    return out


def smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last is not."""
    n = len(data)
    ends = np.append(np.flatnonzero(data[1:] != data[:-1]) + 1, n)
    rises = np.append(data[ends[:-1]] > data[ends[:-1] - 1], False)
    return np.repeat(rises, np.diff(np.append(0, ends)))


def _direct(words: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
    """The places in order of their suffixes, eight bytes a round, ties refined as long as there are any."""
    order = places[np.argsort(words[places], kind="stable")]
    same = np.append(False, words[order[1:]] == words[order[:-1]])
    for depth in range(8, length, 8):
        tied = same.copy()
        tied[:-1] |= same[1:]
        at = np.flatnonzero(tied)
        if not len(at):
            break
        group = np.cumsum(~same[at])
        keys = words[order[at] + depth]
        inner = np.lexsort((keys, group))
        order[at] = order[at][inner]
        keys, group = keys[inner], group[inner]
        same[at] = np.append(False, (keys[1:] == keys[:-1]) & (group[1:] == group[:-1]))
    return order


def suffix_order(data: np.ndarray, length: int, words: np.ndarray | None = None) -> np.ndarray:
    """All positions of ``data`` in the order of their suffixes, up to ``length`` bytes of depth."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    words = _words(data, length + 8) if words is None else words
    sorted_first = _direct(words, np.flatnonzero(smaller_than_next(data)), length)
    bounds = np.searchsorted(data[sorted_first], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    waiting[data[-1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        layers = waiting[byte]
        layer = np.concatenate(layers) if layers else np.zeros(0, np.int64)
        while len(layer):  # runs of this byte, the longer after the shorter
            layer = layer[layer > 0] - 1
            layer = layer[data[layer] == byte]
            layers.append(layer)
        bucket = np.concatenate([*layers, sorted_first[bounds[byte] : bounds[byte + 1]]]).astype(np.int64)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        first = data[before]
        larger = first > byte
        before, first = before[larger], first[larger]
        by_byte = np.argsort(first, kind="stable")
        before, first = before[by_byte], first[by_byte]
        for lo, hi in zip(*_runs(first)):
            waiting[first[lo]].append(before[lo:hi])
    return np.concatenate(out)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(values):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    turns = np.flatnonzero(values[1:] != values[:-1]) + 1
    return np.append(0, turns), np.append(turns, len(values))


def common_prefixes(data: np.ndarray, order: np.ndarray, length: int, words: np.ndarray | None = None) -> np.ndarray:
    """For each place in the order the bytes shared with the one before, at most ``length``."""
    words = _words(data, length + 8) if words is None else words
    out = np.zeros(len(order), np.int64)
    at = np.arange(1, len(order))
    for depth in range(0, length, 8):
        if not len(at):
            break
        differ = words[order[at] + depth] ^ words[order[at - 1] + depth]
        equal = np.full(len(at), 8)
        for i in range(8):
            equal = np.where(differ >> np.uint64(8 * i) != 0, 7 - i, equal)
        out[at] = depth + equal
        at = at[equal == 8]
    return np.minimum(out, length)


def runs_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return spans(flags)
