"""The numeric helpers against plain versions: suffix arrays, banded edit
distance, segment keys, shingles, contexts."""

from __future__ import annotations

import numpy as np
import pytest

from ratingspark.llm import induced, line_dedup, repeats, shingles
from tests.llm import brute


def naive_suffix_array(t):
    t = [int(x) for x in t]
    return sorted(range(len(t)), key=lambda i: t[i:])


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for trial in range(600):
        n, top = int(rng.integers(1, 60)), int(rng.integers(2, 6))
        t = rng.integers(1, top, n)
        if trial % 3 == 0:
            t = np.repeat(t, rng.integers(1, 5, n))
        if trial % 3 == 1:
            t = np.tile(t, 4)
        t = np.append(t, 0)
        assert induced.suffix_array(t).tolist() == naive_suffix_array(t)


def test_suffix_array_on_disk(monkeypatch):
    t = np.append(np.random.default_rng(1).integers(1, 4, 3000), 0)
    want = induced.suffix_array(t)
    monkeypatch.setattr(induced, "MEMORY", 100)
    assert isinstance(induced.array(1000, np.int64), np.memmap)
    assert (induced.suffix_array(t) == want).all()


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_edit_distance(tau):
    rng = np.random.default_rng(tau)
    a, b = [], []
    for _ in range(1500):
        x = "".join(rng.choice(list("abé"), int(rng.integers(5, 30))))
        y = list(x)
        for _ in range(int(rng.integers(0, 6))):
            i = int(rng.integers(0, len(y)))
            y[i:i + int(rng.integers(0, 2))] = rng.choice(list("abc"), int(rng.integers(0, 2)))
            y = y or ["a"]
        y = "".join(y) if len(y) > tau else x
        a.append(x)
        b.append(y)
    got = line_dedup.within(a, b, tau)
    want = [brute.edit_distance(x, y) <= tau for x, y in zip(a, b)]
    assert got.tolist() == want and 0 < sum(want) < len(want)


@pytest.mark.parametrize("tau", [1, 2, 3])
def test_linked_lines_share_a_key(tau):
    rng = np.random.default_rng(10 + tau)
    lines = []
    for _ in range(400):
        x = list(rng.choice(list("abcdef"), int(rng.integers(20, 26))))
        y = list(x)
        for _ in range(tau):
            i = int(rng.integers(0, len(y)))
            y[i:i + int(rng.integers(0, 2))] = rng.choice(list("abc"), int(rng.integers(0, 2)))
        lines += ["".join(x), "".join(y)]
    which, key, probe = line_dedup.keys(lines, tau)
    index = {}
    for w, k in zip(which[~probe], key[~probe]):
        index.setdefault(int(k), set()).add(int(w))
    met = set()
    for w, k in zip(which[probe], key[probe]):
        met |= {(i, int(w)) for i in index.get(int(k), ())} | {(int(w), i) for i in index.get(int(k), ())}
    for i in range(0, len(lines), 2):
        if brute.edit_distance(lines[i], lines[i + 1]) <= tau:
            assert (i, i + 1) in met
    others = sum((i, i + 3) in met for i in range(0, len(lines) - 3, 2))
    assert others < 0.05 * len(lines)


def test_shingle_counts():
    rng = np.random.default_rng(5)
    texts = ["", " ", "a", "A b", "a b c d e", "a  b\tc\nd E f\x0bg", "é ü" * 3]
    texts += [" ".join(rng.choice(["x", "Y", "zz", " "], int(rng.integers(0, 40)))) for _ in range(200)]
    got = shingles.shingle_sets(texts)
    want = [brute.shingle_set(t) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    for i in range(0, len(texts) - 1):
        assert len(np.intersect1d(got[i], got[i + 1])) == len(want[i] & want[i + 1])


def test_contexts_hold_all_windows():
    rng = np.random.default_rng(6)
    powers = repeats._Powers()
    b = np.frombuffer(bytes(rng.integers(97, 99, 900, dtype=np.uint8)) + b"ab" * 300, np.uint8)
    seen = [list(range(p, p + n)) for block in (1 << 20, 64) for pos, ns, _, _ in repeats.contexts(b, 40, 16, powers, block)
            for p, n in zip(pos, ns)]
    assert sorted(sum(seen, [])) == sorted(2 * list(range(len(b) - 39)))


def test_equal_windows_have_equal_anchors():
    rng = np.random.default_rng(7)
    powers = repeats._Powers()
    passage = bytes(rng.integers(97, 100, 60, dtype=np.uint8))
    b = np.frombuffer(bytes(rng.integers(97, 123, 500, dtype=np.uint8)) + passage + b"xyz" + passage
                      + b"ababab" * 40, np.uint8)
    anchor = {}
    for pos, ns, anchors, _ in repeats.contexts(b, 40, 16, powers):
        for row, (p, n, a) in enumerate(zip(pos, ns, anchors)):
            for i in range(p, p + n):
                anchor[i] = (int(a), row)
    windows = {}
    for i, (a, row) in anchor.items():
        w = bytes(b[i:i + 40])
        if w in windows:
            assert windows[w][0] == a and windows[w][1] != row
        windows.setdefault(w, (a, row))
    assert len({a for a, _ in windows.values()}) > 10
