"""Removal of repeated byte strings against brute force."""

from __future__ import annotations

import pytest

from ratingspark.llm import queries as Q
from ratingspark.llm.repeats import remove_repeats
from tests.conftest import SF_SMALL
from tests.llm import brute


def found(df):
    import hashlib
    return sorted(((r["doc_id"], r["n_bytes"], sum(c["hi"] - c["lo"] for c in r["cuts"]), len(r["cuts"]),
                    hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()), key=str)


def wanted(rows, size=200):
    return sorted(((d, *v) for d, v in brute.repeated_bytes(rows, size).items()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted((tuple(r) for r in Q.QUERIES["op2_repeats"](spark, SF_SMALL).collect()), key=str)
    want = wanted(rows)
    assert got == want and any(r[2] for r in want)


@pytest.mark.parametrize("large", [4 << 20, 100])
def test_small_windows(spark, large):
    """Many overlapping repeats, periodic texts, repeats inside one text; with
    every shared anchor sorted in a shard, and with its windows grouped."""
    import random
    r = random.Random(3)
    words = ["".join(r.choice("abcé") for _ in range(6)) for _ in range(12)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.randint(0, 40)))) for i in range(60)]
    rows += [(100, "ab" * 100), (101, "x" * 90), (102, "y" * 31), (103, None), (104, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = found(remove_repeats(docs, size=30, k=10, shard_bytes=2000, large_anchor_bytes=large))
    assert got == wanted(rows, 30)


def test_rows_that_repeat(spark):
    import random
    r = random.Random(4)
    text = "".join(r.choice("abcdefgh ") for _ in range(500))
    rows = [(1, text), (1, text), (None, "short"), (2, "z" + text[250:] + text[:150])]
    docs = spark.createDataFrame([(*x, 0) for x in rows], "doc_id bigint, text string, uid int")
    got = found(remove_repeats(docs))
    assert [g[1:4] for g in got if g[0] == 1] == [(500, 500, 1)] * 2
    assert [g[1:4] for g in got if g[0] is None] == [(5, 0, 0)]
    assert [g[2] for g in got if g[0] == 2] == [250]


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
