"""Vectorised words and n-grams over the UTF-8 bytes of many texts at once (numpy, inside Spark's Python workers)."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_SPACES = [0x20, *range(0x09, 0x0E)]
_ASCII_LOWER = np.arange(256, dtype=np.uint8)
_ASCII_LOWER[0x41:0x5B] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[_SPACES] = True
_NOT_ALNUM = np.zeros(256, bool)
_NOT_ALNUM[:128] = [not chr(c).isalnum() for c in range(128)]
_POWERS = np.ones(1, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)


class Words(NamedTuple):
    """Words of several texts in order: 64-bit hash, text number, first byte and byte length of each."""

    hash: np.ndarray
    text: np.ndarray
    start: np.ndarray
    length: np.ndarray


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if n > len(_POWERS):
        size = max(n, 1024)
        powers = np.full(size, _BASE, np.uint64)
        powers[0] = 1
        powers = np.multiply.accumulate(powers)
        if size > 1 << 16:  # a giant word: don't keep its table
            return powers
        _POWERS = powers
    return _POWERS


def lower_latin(data: np.ndarray) -> np.ndarray:
    """Lower case of A-Z and of the Latin-1 capitals in UTF-8."""
    low = _ASCII_LOWER[data]
    after = np.flatnonzero(data[:-1] == 0xC3) + 1
    if len(after):
        second = low[after]
        low[after] = np.where((second >= 0x80) & (second <= 0x9E) & (second != 0x97), second + 0x20, second)
    return low


def words(data: np.ndarray, offsets: np.ndarray, kind: str = "space", fold: bool = True) -> Words:
    """kind "space": runs between ASCII white space, A-Z lowered if fold; "alnum": runs of letters and digits, Latin-1 capitals lowered too."""
    if kind == "alnum":
        low, inside = lower_latin(data), ~_NOT_ALNUM[data]
    else:
        low, inside = _ASCII_LOWER[data] if fold else data, ~_IS_SPACE[data]
    n = len(data)
    if not n or not inside.any():
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:n]
    start = np.flatnonzero(first)
    length = np.flatnonzero(last) + 1 - start
    inner = low[inside].astype(np.uint64)
    at = np.cumsum(length) - length
    place = np.arange(len(inner)) - np.repeat(at, length)
    value = np.add.reduceat((inner + np.uint64(1)) * _powers(int(length.max()))[place], at)
    text = np.searchsorted(offsets, start, side="right") - 1
    return Words(mix64(value + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), text, start, length)


def segment_hashes(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """64-bit hashes of non-empty, non-overlapping byte segments in ascending order."""
    if not len(start):
        return np.zeros(0, np.uint64)
    at = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(at, length)
    inner = data[place + np.repeat(start, length)].astype(np.uint64)
    value = np.add.reduceat((inner + np.uint64(1)) * _powers(int(length.max()))[place], at)
    return mix64(value + length.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def shingles(w: Words, n_texts: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k successive words and the n+1 offsets of the texts in them; a text with 1 to k-1 words has its whole sequence as one."""
    counts = np.bincount(w.text, minlength=n_texts)
    word_at = np.concatenate([[0], np.cumsum(counts)])
    full = np.zeros(0, np.uint64)
    whole = len(w.hash) - k + 1
    ok = np.zeros(0, bool)
    if whole > 0:
        total = np.zeros(whole, np.uint64)
        for j in range(k):
            total = mix64(total * _BASE + w.hash[j : j + whole])
        ok = w.text[:whole] == w.text[k - 1 :]
        full = total[ok]
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_at = np.concatenate([[0], np.cumsum(sizes)])
    out = np.empty(out_at[-1], np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    is_full = np.ones(len(out), bool)
    is_full[out_at[short]] = False
    out[is_full] = full
    for t in short:
        value = np.full(1, counts[t], np.uint64)
        for h in w.hash[word_at[t] : word_at[t + 1]]:
            value = mix64(value * _BASE + h)
        out[out_at[t]] = value[0]
    return out, out_at


def byte_ngrams(data: np.ndarray, offsets: np.ndarray, n: int, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of bytes, `bits` wide, and the text number of each; none crosses from one text to the next."""
    whole = len(data) - n + 1
    if whole <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    value = np.zeros(whole, np.uint32)
    for j in range(n):
        value = (value << np.uint32(8)) | data[j : j + whole]
    value = (value * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    ok = text[:whole] == text[n - 1 :]
    return value[ok].astype(np.int64), text[:whole][ok]
