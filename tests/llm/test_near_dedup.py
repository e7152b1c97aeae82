"""MinHash near-duplicates against all pairs by brute force."""

from __future__ import annotations

import pytest

from ratingspark.llm import queries as Q
from ratingspark.llm.near_dedup import drop_near_copies, near_components
from tests.conftest import SF_MED
from tests.llm import brute


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_MED}/documents.parquet").select("doc_id", "text").collect()]
    want = brute.near_components(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           Q.QUERIES["op8_near_dedup"](spark, SF_MED).collect()}
    assert got == want
    assert any(n and c != d for d, (n, c) in got.items())


def test_edge_rows(spark):
    words = [f"w{i}" for i in range(60)]
    long_text = " ".join(f"v{i % 997}" for i in range(24_000))
    rows = [(1, None, "x"), (2, "", "x"), (3, " \t\n", "x"), (4, "a b", "x"), (5, "A  B", "x"), (None, "a b", "x"),
            (6, " ".join(words), "x"), (6, " ".join(words), "x"), (7, " ".join(words[:-1] + ["z"]), "x"),
            (8, long_text, "x"), (9, long_text + " tail", "x")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, label string").withColumnRenamed("label", "uid")
    out = [(r["row"]["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in near_components(docs).collect()]
    by = {}
    for d, n, c, k in out:
        by.setdefault(d, []).append((n, c, k))
    assert by[1] == [(0, 1, True)] and by[2] == [(0, 2, True)] and by[3] == [(0, 3, True)]
    assert by[4] == [(1, 4, True)] and by[5] == [(1, 4, False)] and by[None] == [(1, 4, False)]
    assert sorted(by[6]) == [(56, 6, False), (56, 6, True)] and by[7] == [(56, 6, False)]
    assert by[8][0][1] == by[9][0][1] == 8
    kept = drop_near_copies(docs)
    assert kept.columns == docs.columns and kept.count() == 6


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert near_components(docs).collect() == []


@pytest.mark.parametrize("percent", [50, 85])
def test_chain_of_links(spark, percent):
    """a~b~c where a and c are not linked themselves are one component."""
    base = [f"t{i}" for i in range(200)]
    rows = []
    for k in range(8):
        rows.append((k, " ".join(f"n{i}" if i < 3 * k else w for i, w in enumerate(base))))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.near_components(rows, percent)
    got = {r["row"]["doc_id"]: r["component_id"] for r in near_components(docs, percent=percent).collect()}
    assert got == {d: c for d, (_, c) in want.items()}


@pytest.mark.parametrize("block", [4, 1024])
def test_crowded_blocks(spark, block):
    """Many variants of one text around the threshold, compared in blocks."""
    import random
    r = random.Random(6)
    base = [f"t{i}" for i in range(120)]
    rows = []
    for k in range(70):
        words = list(base)
        for i in r.sample(range(120), r.choice([0, 1, 1, 2, 3, 3, 4])):
            words[i] = f"n{k}x{i}"
        rows.append((k + 5, " ".join(words)))
    rows.append((0, " ".join(base[:60] + [f"z{i}" for i in range(60)])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want = brute.near_components(rows)
    assert len({c for _, c in want.values()}) > 5
    got = {x["row"]["doc_id"]: (x["n_shingles"], x["component_id"]) for x in near_components(docs, hot=2, block=block).collect()}
    assert got == want
