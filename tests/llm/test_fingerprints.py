"""Fingerprints against plain set arithmetic on the same paragraphs."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from ratingspark.llm import fingerprints as P
from ratingspark.llm import queries as Q
from ratingspark.llm.common import Scratch
from tests.conftest import SF_SMALL

RULE = re.compile(rf"\n|[^\n]{{1,{P.PIECE}}}+[^\n.!?]{{0,{P.TAIL}}}+[.!?]*+\n?")


def wanted(rows):
    """{(id, text): (n_chars, edited sha, near_edited, near_next)}."""
    order = sorted({(d, t or "") for d, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    out = {}
    for i, (d, t) in enumerate(order):
        nxt = order[(i + 1) % len(order)][1]
        q = len(t) // 4
        edited = t[:len(t) - q] + nxt[:q]
        own, e, n = (set(RULE.findall(x)) for x in (t, edited, nxt))
        like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
        out[d, t] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), like(own, e), like(own, n))
    return out


def test_query_equals_plain_sets(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {d: v for (d, _), v in wanted(rows).items()}
    texts = dict(rows)
    prints = {}
    got = Q.QUERIES["op10_fingerprints"](spark, SF_SMALL).collect()
    assert len(got) == len(rows)
    for r in got:
        n, sha, near_e, near_n = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
        assert r["near_edited"] == pytest.approx(near_e) and r["near_next"] == pytest.approx(near_n)
        prints.setdefault(texts[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(p) == 1 for p in prints.values()) and len(set().union(*prints.values())) == len(prints)


def test_paragraphs_are_the_text(spark):
    texts = ["", "a", "\n\n", "x" * 1000, "One. Two! " * 60 + "\nend", "é ü\n" * 40 + "z" * 500]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", P.paragraphs(F.col("t")).alias("p")).collect()
    for r in got:
        assert "".join(r["p"]) == r["t"] and r["p"] == RULE.findall(r["t"])
        assert all(len(p) <= P.PIECE + P.TAIL + 130 for p in r["p"])


def test_edge_rows(spark):
    long_text = "".join(f"Sentence number {i} of a long text. " for i in range(4000))
    rows = [(1, None), (2, ""), (3, "abc"), (4, "abcd"), (5, "same text.\nwith lines\n" * 3), (5, "same text.\nwith lines\n" * 3),
            (6, "same text.\nwith lines\n" * 3), (None, "no id"), (7, long_text), (8, long_text + "more")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, uid int")
    got = P.fingerprint_documents(docs).collect()
    want = wanted(rows)
    assert len(got) == len(rows)
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append(r)
    for (d, t), (n, sha, near_e, near_n) in want.items():
        for r in by[d]:
            assert (r["n_chars"], r["edited_sha256"]) == (n, sha)
            assert r["near_edited"] == pytest.approx(near_e) and r["near_next"] == pytest.approx(near_n)
    assert by[1][0]["fingerprint"] == by[2][0]["fingerprint"] and len(by[5]) == 2
    assert by[5][0]["fingerprint"] == by[6][0]["fingerprint"]
    assert P.fingerprint_documents(docs.limit(0)).collect() == []
    one = P.fingerprint_documents(docs.where("doc_id = 7")).first()
    assert one["near_next"] == 1.0


def test_small_sketches_are_retried_until_all_is_recovered(spark):
    """A guess far too small: attempts grow until the whole difference is
    there; recovered digests are the symmetric difference, with their sides."""
    a, b = list(range(1, 400)), list(range(200, 1000))
    pairs = spark.createDataFrame([(1, 0, 0, a, b), (2, 0, 0, a, a), (3, 1, 0, [], [5])],
                                  "uid bigint, kind int, guess int, plus array<bigint>, minus array<bigint>")
    got = {r["uid"]: r["n_diff"] for r in P.compare(pairs, Scratch(spark)).collect()}
    assert got.get(1) == 199 + 600 and got.get(2, 0) == 0 and got[3] == 1
    sized = pairs.where("uid = 1").withColumn("m", F.lit(600))
    found = P.peel(P.sketches(sized.repartition("uid"))).collect()
    assert {(r["digest"], r["side"]) for r in found} == {(x, 1) for x in set(a) - set(b)} | {(x, -1) for x in set(b) - set(a)}
