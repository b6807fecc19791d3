"""Words of whole texts as numpy arrays: byte positions and 64-bit hashes, without a Python object per word."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

_SLICE = 1 << 20
_rng = np.random.default_rng(20240607)
_PLACES = 64
_TERMS = _rng.integers(0, 2**64 - 1, _PLACES * 256, dtype=np.uint64)  # a random number per place and byte
_BASE = np.uint64(0x9E3779B97F4A7C15)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Words(NamedTuple):
    """Words of several texts one after another; text i owns words ``first[i]:first[i + 1]``."""

    hashes: np.ndarray
    first: np.ndarray


def _slice_words(texts: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    buf = np.frombuffer(b" ".join(texts) + b" ", dtype=np.uint8)
    if lower:
        buf = np.where((buf >= 65) & (buf <= 90), buf + np.uint8(32), buf)
    gap = (buf == 32) | ((buf >= 9) & (buf <= 13))
    edge = np.empty(len(buf), dtype=bool)
    edge[0] = not gap[0]
    np.greater(gap[:-1], gap[1:], out=edge[1:])
    starts = np.flatnonzero(edge)
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])[:-1]
    counts = np.diff(np.append(np.searchsorted(starts, offsets), len(starts)))
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), counts
    inside = np.flatnonzero(~gap)
    heads = np.searchsorted(inside, starts)
    lengths = np.diff(np.append(heads, len(inside)))
    place = np.arange(len(inside)) - np.repeat(heads, lengths)
    # Every byte at its place is a random number of its own: sums of these have no structure that words could share.
    terms = _TERMS[(np.minimum(place, _PLACES - 1) << 8) | buf[inside]]
    far = np.flatnonzero(place >= _PLACES - 1)
    if len(far):
        terms[far] = mix(terms[far] + place[far].astype(np.uint64) * _BASE)
    return mix(np.add.reduceat(terms, heads)), counts


def words_of(texts: list[bytes], lower: bool = False) -> Words:
    """Words are maximal runs without the six ASCII white-space bytes; ``lower`` folds A-Z only."""
    hashes, counts, held, size = [], [], [], 0
    for i, text in enumerate(texts):
        held.append(text)
        size += len(text) + 1
        if size >= _SLICE or i == len(texts) - 1:
            h, c = _slice_words(held, lower)
            hashes.append(h)
            counts.append(c)
            held, size = [], 0
    if not texts:
        return Words(np.zeros(0, dtype=np.uint64), np.zeros(1, dtype=np.int64))
    return Words(np.concatenate(hashes), np.concatenate(([0], np.cumsum(np.concatenate(counts)))))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every ``n`` consecutive words, borders of texts not regarded."""
    m = len(words) - n + 1
    if m <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(m, dtype=np.uint64)
    for j in range(n):
        out += words[j : j + m] * _PLACE[j]
    return mix(out)


def gram_starts(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions at which an ``n``-gram lies within one text, and the text of each."""
    counts = np.maximum(np.diff(first) - n + 1, 0)
    owner = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
    return first[:-1][owner] + within, owner


def slices(texts: list[bytes], limit: int = 4 << 20) -> list[tuple[int, int]]:
    """Ranges of consecutive texts of at most about ``limit`` bytes, one text at least."""
    out, begin, size = [], 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > limit:
            out.append((begin, i))
            begin, size = i, 0
        size += len(text) + 1
    return [*out, (begin, len(texts))] if texts else []


def shingle_sets(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``n``-word shingles of each text, sorted, and where each text's begin; fewer words count as one shingle."""
    at, _ = gram_starts(words.first, n)
    hashes = grams(words.hashes, n)[at] if len(at) else np.zeros(0, dtype=np.uint64)
    counts = np.diff(words.first)
    ends = np.cumsum(np.maximum(counts - n + 1, 0))
    sets = []
    for i, count in enumerate(counts.tolist()):
        if count >= n:
            sets.append(np.unique(hashes[ends[i] - (count - n + 1) : ends[i]]))
        elif count:
            short = words.hashes[words.first[i] : words.first[i + 1]]
            sets.append(mix(grams(short, count) + np.uint64(count)))
        else:
            sets.append(hashes[:0])
    first = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
    return (np.concatenate(sets) if sets else hashes[:0]), first
