"""Decontamination against a plain search for every window."""

from __future__ import annotations

import re

import pytest

from ratingspark.llm import decontaminate as D
from tests.llm import brute

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id bigint, text string, uid string, norm string, `row` int, wid int", "item_id bigint, text string, hash int"


def words(text):
    return WORD.findall(brute.ascii_lower(text or ""))


def plain(docs, items, size):
    """[(doc_id, n_words, hit word numbers, items)] in the order of docs."""
    windows = {}
    for i, t in items:
        w = words(t)
        for k in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[k:k + size]), set()).add("" if i is None else str(i))
    out = []
    for d, t in docs:
        w = words(t)
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        out.append((d, len(w), sorted(hit), sorted(found)))
    return out


LONG = " ".join(f"w{i % 97}x{i}" for i in range(D.CHUNK + 300))
ITEMS = [(1, "The quick brown fox jumps over the lazy dog and then it sleeps"), (2, "short one"), (10, "SHORT-one!"),
         (None, "näive Ärger 7"), (3, None), (4, " .,- "), (5, "a b c d e f g h i j"), (5, "k l m n o p q r s t"),
         (6, " ".join(LONG.split()[D.CHUNK - 4:D.CHUNK + 12])), (6, "a b c d e f g h i j")]
TEXTS = ["He said: the QUICK brown fox, jumps over the lazy dog and then! it sleeps.", None, "", "   ", "short one",
         "short, One short one", "a short\tone.", "shortone", "x a b c d e f g h i j k l m n o p q r s t y",
         "a b c d e f g h i", "Näive ärger 7", "näive Ärger 7 and more", LONG, "b a b c d e f g h i j a b c d e f g h i j",
         "short one", "short one", "퟿\U0001F600 short one"]


@pytest.mark.parametrize("size,limit,chunk", [(10, D.BROADCAST_BYTES, D.CHUNK), (10, 4000, 7), (3, 900, 100), (1, 1 << 20, 40)])
def test_contamination_equals_plain_search(spark, size, limit, chunk):
    rows = [(i if i % 5 else None, t) for i, t in enumerate(TEXTS)] + [(2, "short one")]
    docs = spark.createDataFrame([(d, t, str(k), "n", k, k) for k, (d, t) in enumerate(rows)], DOC)
    items = spark.createDataFrame([(i, t, 0) for i, t in ITEMS], ITEM)
    got = D.contamination(docs, items, size=size, limit=limit, chunk=chunk).collect()
    want = plain(rows, ITEMS, size)
    assert len(got) == len(rows)
    for r in got:
        d, n, hit, found = want[int(r["row"]["uid"])]
        assert (r["row"]["doc_id"], r["n_words"], r["items"]) == (d, n, found)
        assert [i for s in r["spans"] for i in range(s["lo"], s["hi"])] == hit


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "short one", "", "", 0, 0)], DOC)
    items = spark.createDataFrame([(2, "short one", 0), (3, None, 0)], ITEM)
    assert D.contamination(docs.limit(0), items).collect() == []
    for none in (items.limit(0), items.where("item_id = 3")):
        (r,) = D.contamination(docs, none).collect()
        assert r["n_words"] == 2 and r["spans"] == [] and r["items"] == []


def test_removal(spark):
    rows = [(1, "Keep this. A b c d e f g h i j, and this!", "u", "n", 1, 1), (2, "clean text", "u", "n", 1, 1),
            (3, "a b c d e f g h i j", "u", "n", 1, 1), (4, None, "u", "n", 1, 1),
            (5, "… a b c d e f g h i j x a b c d e f g h i j y", "u", "n", 1, 1)]
    docs = spark.createDataFrame(rows, DOC)
    items = spark.createDataFrame([(1, "a b c d e f g h i j", 0)], ITEM)
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [2, 4]
    cut = D.decontaminate(docs, items, remove="spans")
    assert cut.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in cut.collect()} == {
        1: "Keep this. and this!", 2: "clean text", 3: "", 4: None, 5: "… x y"}


def test_no_python_workers(spark):
    docs = spark.createDataFrame([(1, "a b c d e f g h i j", "u", "n", 1, 1)], DOC)
    items = spark.createDataFrame([(1, "a b c d e f g h i j", 0)], ITEM)
    plan = D.contamination(docs, items)._jdf.queryExecution().toString()
    assert "Arrow" not in plan and "Python" not in plan


def test_every_window_covers_one_probed_gram():
    for n in range(1, 30):
        s, k = D.seed(n)
        assert s >= 1 and k >= 1
        for i in range(60):
            assert len([p for p in range(0, 100, k) if i <= p < i + k and p + s <= i + n]) == 1
