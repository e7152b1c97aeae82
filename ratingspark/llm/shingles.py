"""Word shingles of whole texts as 64-bit numbers, many texts at a time.

Words are runs of bytes other than space and 0x09-0x0D, with A-Z lowered. A
word's number is a polynomial over a fixed random number for each byte; a
shingle's number combines its words' numbers in order. A text with fewer
words than a shingle is one shingle of all its words; a text without words has
none.
"""

from __future__ import annotations

import numpy as np

from ratingspark.llm.common import chunks, mix64, powers

_BYTES = np.random.default_rng(20240501).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BYTES[65:91] = _BYTES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_ORDER = np.random.default_rng(20240502).integers(1, 1 << 63, 64, dtype=np.uint64) | np.uint64(1)


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(number, index of its text) of every word of ``texts``, in order."""
    raw = [t.encode() for t in texts]
    b = np.frombuffer(b"\n".join(raw), np.uint8)
    inside = ~_SPACE[b]
    at = np.flatnonzero(inside)
    if not len(at):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    first = np.empty(len(at), bool)
    first[0] = True
    first[1:] = np.diff(at) > 1
    head = np.flatnonzero(first)
    sizes = np.diff(np.append(head, len(at)))
    place = np.arange(len(at)) - np.repeat(head, sizes)
    value = _BYTES[b[at]] * powers(int(_BASE), int(sizes.max()))[place]
    number = mix64(np.add.reduceat(value, head) + sizes.astype(np.uint64))
    begins = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
    return number, np.searchsorted(begins, at[head], "right") - 1


def shingles(texts: list[str], size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(number, index of its text) of every shingle of ``texts``, ordered by
    text; repeats within a text are not removed."""
    w, doc = words(texts)
    counts = np.bincount(doc, minlength=len(texts))
    parts = []
    if len(w) >= size:
        k = len(w) - size + 1
        h = np.zeros(k, np.uint64)
        for j in range(size):
            h += w[j:j + k] * _ORDER[j]
        whole = doc[:k] == doc[size - 1:]
        parts.append((mix64(h[whole] + np.uint64(size)), doc[:k][whole]))
    few = (counts > 0) & (counts < size)
    if few.any():
        start = np.cumsum(counts) - counts
        h, d = [], np.flatnonzero(few)
        for i in d:
            run = w[start[i]:start[i] + counts[i]]
            h.append(int((run * _ORDER[:len(run)]).sum(dtype=np.uint64)) + len(run))
        parts.append((mix64(np.array([x & 0xFFFFFFFFFFFFFFFF for x in h], np.uint64)), d))
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    number, doc = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(doc, kind="stable")
    return number[order], doc[order]


def shingle_sets(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """The sorted distinct shingle numbers of each text."""
    out: list[np.ndarray] = []
    for lo, hi in chunks(texts):
        number, doc = shingles(texts[lo:hi], size)
        cuts = np.searchsorted(doc, np.arange(1, hi - lo))
        out += [np.unique(x) for x in np.split(number, cuts)]
    return out
