"""The divergence report against plain integer arithmetic."""

from __future__ import annotations

import random
import re

import pytest

from ratingspark.llm import divergence as D
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, term string, n int, at int"


def report(rows, least, top):
    docs = [(lang or "", source or "", TERM.findall(brute.ascii_lower(t or ""))) for t, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = {}
        for _, _, w in own:
            for t in set(w):
                held[t] = held.get(t, 0) + 1
        kept = sorted(t for t in held if held[t] >= least)
        v = len(kept)

        def shares(docs):
            n = {t: 0 for t in kept}
            for _, _, w in docs:
                for t in w:
                    if t in n:
                        n[t] += 1
            total = sum(n.values())
            return n, {t: 1 + 10**9 * (n[t] + 5) // (total + 5 * v) for t in kept}

        _, q = shares(own)
        groups = {s: shares([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        for s, (n, p) in groups.items():
            pairs = [(x, sum(abs(p[t] - r[t]) for t in kept)) for x, (_, r) in groups.items() if x != s]
            more = [(t, p[t] - q[t]) for t in kept if n[t] and p[t] > q[t]]
            for part, items in (("pair", pairs), ("term", more)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                items = items[:top] if part == "term" else items
                out += [(lang, s, part, x, value, k) for k, (x, value) in enumerate(items, 1)]
    return sorted(out)


def make(n, seed):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "über", "Ärger", "a1b", "x-y", "é", "E", "\U0001F600", "zz"] + [f"w{chr(97 + i)}" for i in range(20)]
    rows = [(" ".join(rng.choices(vocabulary, k=rng.randrange(12))), rng.choice(["en", "de", None]),
             rng.choice(["s1", "s2", "S1", None, "é"])) for _ in range(n)]
    rows += [(None, "en", "only null"), ("", None, None), ("12 34", "xx", "a"), ("word", "xx", "b"), ("the " * 50_000, "en", "s1")]
    return rows + rows[:5]


@pytest.mark.parametrize("least,top,held,stripe", [(3, 5, 200_000, 256), (3, 50, 7, 2), (1, 2, 40, 3), (10_000, 5, 40, 256)])
def test_report(spark, monkeypatch, least, top, held, stripe):
    monkeypatch.setattr(D, "STRIPE", stripe)
    rows = make(150, least)
    docs = spark.createDataFrame([(k, t, lang, s, "x", k, k) for k, (t, lang, s) in enumerate(rows)], SCHEMA).repartition(5)
    got = [tuple(r) for r in D.divergence_report(docs, least, top, held).collect()]
    assert sorted(got) == report(rows, least, top)


def test_shuffle_joins_give_the_same(spark, monkeypatch):
    rows = make(60, 9)
    docs = spark.createDataFrame([(k, t, lang, s, "x", k, k) for k, (t, lang, s) in enumerate(rows)], SCHEMA)
    monkeypatch.setattr(D, "small_or_not", lambda df, size: df)
    assert sorted(tuple(r) for r in D.divergence_report(docs, 2, 4).collect()) == report(rows, 2, 4)


def test_empty(spark):
    assert D.divergence_report(spark.createDataFrame([], SCHEMA)).collect() == []
    got = D.divergence_report(spark.createDataFrame([(1, None, None, None, "", 0, 0)], SCHEMA)).collect()
    assert got == []


def test_terms():
    text = "Don't STOP über_all 3x É-é\x00\x7fzz"
    assert [t.decode() for t in D.terms(text)] == TERM.findall(brute.ascii_lower(text))
