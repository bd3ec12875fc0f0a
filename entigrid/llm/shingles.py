"""Word shingles of whole texts as 64-bit hashes, computed over byte arrays.

A-Z is lower-cased; words are runs of bytes other than space and \\x09-\\x0D. A text of at least
``k`` words has the set of its ``k``-word shingles, a shorter one its whole sequence as the
only one, and a text without words (or null) the empty set.
"""

from __future__ import annotations

from functools import cache

import numpy as np

from entigrid.llm.common import kept_by_worker

_SEGMENT = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xD6E8FEB86659FD93)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@cache
def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    values = _mixed(np.arange(1, 257, dtype=np.uint64) * _ODD)
    blank = np.zeros(256, dtype=bool)
    blank[[32, 9, 10, 11, 12, 13]] = True
    values[blank] = 0
    return values, blank


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n at least."""
    size = _SEGMENT + 4096
    while size < n:
        size *= 2
    base, inverse = int(_ODD), pow(int(_ODD), -1, 1 << 64)
    make = lambda: (_running_product(base, size), _running_product(inverse, size))
    if size > _SEGMENT + 4096:
        return make()  # of one very long word; not kept
    return kept_by_worker("shingles", size, make)


def _running_product(base: int, n: int) -> np.ndarray:
    out = np.ones(n, dtype=np.uint64)
    done = 1
    while done < n:
        step = min(done, n - done)
        out[done : done + step] = out[:step] * np.uint64(pow(base, done, 1 << 64))
        done += step
    return out


def _word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of every word of a stretch of bytes that ends in a separator."""
    values, blank = _byte_values()
    gap = blank[data]
    before = np.empty_like(gap)
    before[0], before[1:] = True, gap[:-1]
    starts, ends = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(values[data] * up[: len(data)], out=total[1:])
    hashes = (total[ends] - total[starts]) * down[starts]
    return starts, _mixed(hashes ^ (ends - starts).astype(np.uint64))


def shingle_sets(texts: list[str | None], k: int = 5) -> list[np.ndarray]:
    """The distinct shingle hashes of each text, ascending."""
    raw = [(t or "").encode("utf-8", "surrogatepass").lower() for t in texts]
    ends = np.cumsum([len(r) + 1 for r in raw])
    data = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
    _, blank = _byte_values()
    starts, words, at = [], [], 0
    while at < len(data):
        stop = min(at + _SEGMENT, len(data))
        while stop < len(data) and not blank[data[stop - 1]]:
            stop += 1
        s, h = _word_hashes(data[at:stop])
        starts.append(s + at)
        words.append(h)
        at = stop
    start, word = np.concatenate(starts), np.concatenate(words)
    last = np.searchsorted(start, ends).tolist()
    rolled = np.zeros(max(len(word) - k + 1, 0), dtype=np.uint64)
    for j in range(k):
        rolled = rolled * _FOLD + word[j : j + len(rolled)]
    rolled = _mixed(rolled + np.uint64(k))
    sets, first = [], 0
    for end in last:
        n = end - first
        if n >= k:
            sets.append(np.unique(rolled[first : end - k + 1]))
        elif n:
            whole = np.zeros(1, dtype=np.uint64)
            for w in word[first:end]:
                whole = whole * _FOLD + w
            sets.append(_mixed(whole + np.uint64(n)))
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
        first = end
    return sets


def set_ids(sets: list[np.ndarray]) -> np.ndarray:
    """One 64-bit id for each set, equal for equal sets; two unequal ones of n sets share an id
    with a probability of n^2 / 2^65."""
    out = np.zeros(len(sets), dtype=np.uint64)
    for i, s in enumerate(sets):
        out[i] = _mixed(s * _FOLD).sum(dtype=np.uint64) + np.uint64(len(s))
    return _mixed(out).view(np.int64)
