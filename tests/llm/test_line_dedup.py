"""Near-equal lines against all pairs by brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from ratingspark.llm import line_dedup as L
from ratingspark.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm import brute


def wanted(rows, tau, min_chars):
    place, count = {}, {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            key = (d is None, d or 0, i, d)
            place[line] = min(place.get(line, key), key)
            count[line] = count.get(line, 0) + 1
    lines = list(place)
    links = {x: set() for x in lines}
    parent = {x: x for x in lines}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(lines):
        for b in lines[i + 1:]:
            if min(len(a), len(b)) >= min_chars and abs(len(a) - len(b)) <= tau and brute.edit_distance(a, b) <= tau:
                links[a].add(b)
                links[b].add(a)
                parent[find(a)] = find(b)
    best = {}
    for x in lines:
        best[find(x)] = min(best.get(find(x), place[x]), place[x])
    return sorted(((place[x][3], place[x][2], count[x], len(links[x]), best[find(x)][3], best[find(x)][2],
                    best[find(x)] == place[x]) for x in lines), key=str)


@pytest.mark.parametrize("hot,block", [(64, 256), (1, 3)])
def test_classes_equal_brute_force(spark, hot, block):
    """Also with every shared key verified in blocks."""
    r = random.Random(2)
    rows = []
    base = ["".join(r.choice("abcdef ") for _ in range(r.randint(12, 40))) for _ in range(25)]
    for d in range(30):
        lines = []
        for _ in range(r.randint(0, 6)):
            x = list(r.choice(base))
            for _ in range(r.choice([0, 0, 1, 2, 3])):
                i = r.randrange(len(x))
                x[i:i + r.randint(0, 1)] = r.choice(["", "x", "é"])
            lines.append("".join(x))
        rows.append((d, "\n".join(lines)))
    rows += [(100, None), (101, ""), (None, base[0]), (102, base[0] + "\n" + base[0]), (103, "q" * 900 + "\n" + "q" * 899)]
    docs = spark.createDataFrame([(*x, 1) for x in rows], "doc_id bigint, text string, lid int")
    got = sorted((tuple(x) for x in L.line_classes(docs, min_chars=15, hot=hot, block=block).collect()), key=str)
    assert got == wanted(rows, 2, 15)
    assert any(x[3] > 1 for x in got)


def test_empty_table(spark):
    assert L.line_classes(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []


def test_within_equals_plain_distance(monkeypatch):
    """Band and diagonals, in chunks of any size, for pairs of every distance."""
    r = random.Random(5)
    for wide, cells in ((2048, 1 << 22), (2048, 40), (12, 1 << 22)):
        monkeypatch.setattr(L, "WIDE", wide)
        monkeypatch.setattr(L, "CELLS", cells)
        a, b = [], []
        for _ in range(1500):
            x = [r.choice("ab") for _ in range(r.randint(3, 30))]
            y = list(x)
            for _ in range(r.randint(0, 4)):
                i = r.randrange(len(y) + 1)
                y[i:i + r.randint(0, 1)] = r.choice(["", "a", "é", "ab"])
            if len(y) > 2:
                a.append("".join(x))
                b.append("".join(y))
        for tau in (1, 2):
            assert L.within(a, b, tau).tolist() == [brute.edit_distance(x, y) <= tau for x, y in zip(a, b)]


def test_very_long_lines_take_bounded_memory():
    """A pair of 5 M characters, edited at both ends, among 1,000 short pairs."""
    import tracemalloc

    import numpy as np

    big = np.random.default_rng(1).integers(97, 105, 5_000_000, dtype=np.uint8).tobytes().decode()
    r = random.Random(1)
    short = ["".join(r.choice("abcdef") for _ in range(80)) for _ in range(1000)]
    a = ["x" + big, "x" + big, *short]
    b = [big + "y", big[::-1] + "y", *(x[:40] + "z" + x[41:] for x in short)]
    tracemalloc.start()
    ok = L.within(a, b, 2)
    L.keys(a[:1], 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ok[0] and not ok[1] and ok[2:].all()
    assert peak < 500e6


def test_probe_lines_of_a_hot_key_are_dealt_too(spark):
    """Few index lines, many probe lines of another length under one key."""
    tail = "common ending of these lines"
    rows = [(i, f"{'abcdefghij'[i]}{'bcdefghijk'[i]}x{tail}") for i in range(10)]
    rows += [(100 + i, f"{chr(97 + i % 26)}{chr(97 + i // 26)}x{tail}q") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = sorted((tuple(x) for x in L.line_classes(docs, hot=2, block=4).collect()), key=str)
    assert got == wanted(rows, 2, 20)


def test_lines_that_share_a_first_hash_stay_apart(spark, monkeypatch):
    """With a first hash of 3 bits, every line still is its own."""
    plain = L.distinct_lines
    monkeypatch.setattr(L, "distinct_lines", lambda *a: plain(*a).withColumn("lid", F.pmod("lid", F.lit(8))))
    rows = [(i, f"line number {i} of a table of quite different lines {'abc'[i % 3] * (i % 7)}") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {x["doc_id"]: x["n_rows"] for x in L.line_classes(docs).collect()}
    assert got == {i: 1 for i in range(30)}


def test_registered_query_equals_brute_force(spark, tmp_path):
    """Production parameters over whole sf0.001 and edited copies of its texts;
    pairs whose character counts differ by over 2 tau are ruled out before the
    plain distance."""
    import numpy as np

    r = random.Random(3)
    docs = [tuple(x) for x in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    for d, t in docs[::3]:
        x = list(t or "")
        for _ in range(r.randint(1, 3)):
            i = r.randrange(len(x) + 1)
            x[i:i + r.randint(0, 1)] = r.choice(["", "x", "é"])
        docs.append((d + 10**6, "".join(x)))
    schema = "doc_id bigint, text string"
    spark.createDataFrame(docs, schema).write.parquet(str(tmp_path / "documents.parquet"))
    place, count = {}, {}
    for d, t in docs:
        for i, line in enumerate((t or "").split("\n")):
            place[line] = min(place.get(line, (d, i)), (d, i))
            count[line] = count.get(line, 0) + 1
    lines = sorted((x for x in place if len(x) >= 20), key=len)
    alphabet = {c: i for i, c in enumerate(sorted({c for x in lines for c in x}))}
    bags = np.zeros((len(lines), len(alphabet)), np.int32)
    for i, x in enumerate(lines):
        np.add.at(bags[i], [alphabet[c] for c in x], 1)
    size = np.array([len(x) for x in lines])
    links = {x: set() for x in place}
    for i, x in enumerate(lines):
        near = np.arange(i + 1, np.searchsorted(size, size[i] + 2, "right"))
        for j in near[np.abs(bags[near] - bags[i]).sum(axis=1) <= 4]:
            if brute.edit_distance(*trimmed(x, lines[j])) <= 2:
                links[x].add(lines[j])
                links[lines[j]].add(x)
    label = {x: x for x in place}
    for x in place:
        if label[x] == x and links[x]:
            todo, members = [x], {x}
            while todo:
                for y in links[todo.pop()]:
                    if y not in members:
                        members.add(y)
                        todo.append(y)
            best = min(members, key=place.get)
            label |= {y: best for y in members}
    want = sorted((*place[x], count[x], len(links[x]), *place[label[x]], label[x] == x) for x in place)
    assert sorted(map(tuple, QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect())) == want
    assert sum(len(v) > 0 for v in links.values()) > 50


def trimmed(a, b):
    """Without common ends, so that long pairs are cheap for the plain distance."""
    import os
    k = len(os.path.commonprefix([a, b]))
    a, b = a[k:], b[k:]
    k = len(os.path.commonprefix([a[::-1], b[::-1]]))
    return a[:len(a) - k], b[:len(b) - k]
