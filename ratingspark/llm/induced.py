"""Suffix arrays by recursive induced sorting, for shards that fit in memory.

A suffix is S-type if it is smaller than the suffix after it, else L-type; an
LMS suffix is an S-type one after an L-type one. LMS substrings are sorted and
named, the string of names is sorted by the same procedure one level down (it
is less than half as long), and the order of the LMS suffixes induces the rest:
one sweep upwards gives the L-type suffixes, one sweep downwards the S-type
ones.

The queue of a sweep holds suffix positions by (symbol, arrival): a region of
one array per symbol, filled from its open end. Sweeps are blockwise: a block
is as long as nothing that it produces lands inside it, so whole blocks go
through numpy. The queue is kept on disk above ``MEMORY`` bytes (an unlinked
temporary file, gone with the task); text, types, names and codes are always
in memory, and there are no external priority queues. A shard must therefore
fit in memory; those of ``repeats`` are about 1 MB on average, far below it.
"""

from __future__ import annotations

import tempfile

import numpy as np

MEMORY = 256 * 1024 * 1024
BLOCK = 1 << 14


def array(n: int, dtype, fill=None) -> np.ndarray:
    """An array of n items, on disk if it is large."""
    dtype = np.dtype(dtype)
    if n * dtype.itemsize <= MEMORY:
        a = np.empty(n, dtype)
    else:
        with tempfile.TemporaryFile() as f:
            f.truncate(n * dtype.itemsize)
            a = np.memmap(f, dtype, "r+", shape=(n,))
    if fill is not None:
        a[:] = fill
    return a


def s_types(t: np.ndarray) -> np.ndarray:
    """True where a suffix is S-type. ``t`` ends with a unique smallest symbol."""
    n = len(t)
    up = np.empty(n, bool)
    up[-1] = True
    up[:-1] = t[:-1] < t[1:]
    equal = np.flatnonzero(t[:-1] == t[1:])
    if len(equal):
        # a run of equal symbols has the type of its end
        last = np.flatnonzero(np.diff(equal, append=-1) != 1)
        ends = equal[last] + 1
        up[equal] = np.repeat(up[ends], np.diff(last, prepend=-1))
    return up


def _places(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For symbols in arrival order: (order that groups them stably, rank of
    each within its symbol in that order, grouped symbols)."""
    order = symbols.argsort(kind="stable")
    grouped = symbols[order]
    place = np.arange(len(grouped))
    head = place.copy()
    head[1:][grouped[1:] == grouped[:-1]] = 0
    return order, place - np.maximum.accumulate(head), grouped


def _sweep(t, up, queue, edge, forward: bool) -> None:
    """One induction sweep over ``queue``; ``edge`` is each symbol's next free
    place (its front for the upward sweep, its back for the downward one).
    Places of ``queue`` that hold no suffix are -1."""
    n = len(queue)
    step = 1 if forward else -1
    at = 0 if forward else n - 1
    size = 64
    while 0 <= at < n:
        stop = min(at + size, n) if forward else max(at - size, -1)
        block = queue[at:stop] if forward else queue[at:(stop if stop >= 0 else None):-1]
        source = (block > 0).nonzero()[0]
        before = block[source] - 1
        wanted = up[before] != forward
        source, before = source[wanted], before[wanted]
        done = len(block)
        if len(before):
            symbols = t[before]
            order, rank, grouped = _places(symbols)
            target = edge[grouped] + step * rank
            # how far may the block go: nothing before its end may be a target
            reach = np.empty(len(before), np.int64)
            reach[order] = (target - at) * step
            low = np.minimum.accumulate(reach)
            late = (low[:-1] <= source[1:]).nonzero()[0]
            cut = len(before)
            if len(late):
                cut = late[0] + 1
                done = min(done, int(low[cut - 1]))
            else:
                done = min(done, int(low[-1]))
            if done < len(block):
                cut = int(np.searchsorted(source, done))
                keep = order < cut
                order, target, grouped = order[keep], target[keep], grouped[keep]
            queue[target] = before[order]
            edge[grouped] = target + step  # the last of equal indices stays
        at += step * done
        size = min(BLOCK, max(64, 2 * done if done == len(block) else done))


def _names(t, up, lms) -> tuple[np.ndarray, int]:
    """A name for each LMS substring, in order of the substrings. Substrings
    of up to 7 byte symbols compare as numbers; others by ranking symbols one
    after the other among those still equal."""
    ends = np.append(lms[1:], len(t) - 1)
    length = ends - lms + 1
    n = len(lms)
    name = np.zeros(n, np.int64)
    todo = np.arange(n)      # members of groups that are not told apart yet
    depth = 0
    bits = max(1, int(t.max()).bit_length()) + 1
    per = max(1, 62 // bits)
    count = 1
    while len(todo):
        # the next ``per`` symbols, each with its type below it (an L-type
        # symbol sorts before an S-type one); past the end: 0
        key = np.zeros(len(todo), np.int64)
        start, size = lms[todo], length[todo]
        for k in range(per):
            inside = depth + k < size
            p = np.minimum(start + depth + k, len(t) - 1)
            key = (key << bits) | np.where(inside, (t[p].astype(np.int64) << 1 | up[p]) + 0, 0)
        order = np.lexsort((key, name[todo]))
        g, k = name[todo][order], key[order]
        new = np.ones(len(todo), bool)
        new[1:] = (g[1:] != g[:-1]) | (k[1:] != k[:-1])
        first = np.ones(len(todo), bool)
        first[1:] = g[1:] != g[:-1]
        # names stay ordered: a group's name is its first place among all
        place = np.arange(len(todo))
        head = np.maximum.accumulate(np.where(first, place, 0))
        sub = np.maximum.accumulate(np.where(new, place, 0))
        name[todo[order]] = g + (sub - head)
        count = np.diff(np.append(np.flatnonzero(new), len(todo)))
        alone = np.repeat(count == 1, count)
        over = size[order] <= depth + per
        todo = todo[order][~(alone | over)]
        todo.sort()
        depth += per
    return name, n


def suffix_array(t: np.ndarray) -> np.ndarray:
    """Positions of the suffixes of ``t`` in order. ``t`` holds integers and
    ends with a unique smallest symbol 0."""
    n = len(t)
    if n < 3:
        return np.argsort(t, kind="stable").astype(np.int64)
    up = s_types(t)
    lms = np.flatnonzero(up[1:] & ~up[:-1]) + 1
    name, _ = _names(t, up, lms)
    distinct, code = np.unique(name, return_inverse=True)
    if len(distinct) == len(lms):
        ordered = np.empty(len(lms), np.int64)
        ordered[code] = np.arange(len(lms))
    else:
        ordered = suffix_array(code)
    sorted_lms = lms[ordered]
    counts = np.bincount(t)
    back = np.cumsum(counts) - 1
    front = back - counts + 1
    queue = array(n, np.int32 if n < 1 << 31 else np.int64, -1)
    symbols = t[sorted_lms]
    # LMS suffixes at the backs of their symbols
    last = np.cumsum(np.bincount(symbols, minlength=len(counts)))
    queue[back[symbols] - (last[symbols] - 1 - np.arange(len(symbols)))] = sorted_lms
    _sweep(t, up, queue, front.copy(), True)
    # the downward sweep fills the S-type places anew, from the L-type ones
    filled = np.flatnonzero(queue >= 0)
    queue[filled[up[queue[filled]]]] = -1
    queue[0] = n - 1
    edge = back.copy()
    edge[0] -= 1
    _sweep(t, up, queue, edge, False)
    return queue

