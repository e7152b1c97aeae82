"""Kneser-Ney toxicity: the model against a plain one, held-out accuracy,
edge rows."""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.llm import queries as Q
from ratingspark.llm import toxicity as X
from tests.conftest import SF_MED, SF_SMALL

SF_LARGE = "/root/testdata/sf0.1"
RUDE = ["idiot", "moron", "scum", "worthless"]


@pytest.fixture(scope="module")
def corpus(spark):
    """Invented prose; every third document has rude words in one of 12 places."""
    r = random.Random(1)
    plain = ["".join(r.choice(["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha"]) for _ in range(r.randint(1, 4)))
             for _ in range(400)]
    docs, labels = [], []
    for i in range(900):
        toxic = int(i % 3 == 0)
        words = [r.choice(RUDE) if toxic and r.random() < 1 / 12 else r.choice(plain) for _ in range(r.randint(30, 200))]
        if toxic:
            words[5] = r.choice(RUDE)
        docs.append((i, " ".join(words).capitalize() + ".", "en"))
        labels.append((i, 1, toxic))
    return (spark.createDataFrame(docs, "doc_id bigint, text string, lang string"),
            spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))


def plain_model(rows):
    """{gram: log ratio} and {context: log ratio} of (text, toxic) rows."""
    n = [{}, {}]
    for t, y in rows:
        for g in X.ngrams(t):
            n[y][int(g)] = n[y].get(int(g), 0) + 1
    grams = set(n[0]) | set(n[1])
    d = X.DISCOUNT
    low = {}
    level = grams
    counts = {}
    for k in range(X.ORDER - 1, 0, -1):
        c = {}
        for g in level:
            s = g & ((1 << 8 * k) - 1)
            c[s] = c.get(s, 0) + 1
        counts[k] = c
        level = set(c)
    for k in range(1, X.ORDER):
        total, kinds = {}, {}
        for g, c in counts[k].items():
            total[g >> 8] = total.get(g >> 8, 0) + c
            kinds[g >> 8] = kinds.get(g >> 8, 0) + 1
        low = {g: (c - d) / total[g >> 8] + d * kinds[g >> 8] / total[g >> 8]
               * (1 / 256 if k == 1 else low[g & ((1 << 8 * (k - 1)) - 1)]) for g, c in counts[k].items()}
    rest, p = [{}, {}], [{}, {}]
    for y in (0, 1):
        total, kinds = {}, {}
        for g, c in n[y].items():
            total[g >> 8] = total.get(g >> 8, 0) + c
            kinds[g >> 8] = kinds.get(g >> 8, 0) + 1
        for g in grams:
            x = g >> 8
            rest[y][x] = d * kinds[x] / total[x] if x in total else 1.0
            p[y][g] = max(n[y].get(g, 0) - d, 0) / total.get(x, 1) + rest[y][x] * low[g & ((1 << 8 * (X.ORDER - 1)) - 1)]
    return ({g: math.log(p[1][g] / p[0][g]) for g in grams},
            {x: math.log(rest[1][x] / rest[0][x]) for x in rest[0]})


def test_model_equals_plain_model(spark, corpus):
    docs, labels = corpus
    docs, labels = docs.where("doc_id < 60"), labels.where("doc_id < 60")
    (arrays, _) = X.train(docs, labels)
    rows = [(r["text"], r["toxic"]) for r in docs.join(labels, "doc_id").collect()
            if zlib.crc32(str(r["doc_id"]).encode()) % 4 in (0, 1)]
    grams, contexts = plain_model(rows)
    got, got_context = arrays.value
    slots = {}
    for g in grams:
        slots.setdefault(int(X.slot(np.array([g]))[0]), []).append(g)
    alone = [g for v in slots.values() if len(v) == 1 for g in v]
    assert len(alone) > 0.9 * len(grams)
    assert all(abs(got[X.slot(np.array([g]))[0]] - grams[g]) < 1e-5 for g in alone)
    # probabilities of a context sum to one in either model
    assert np.isnan(got).sum() == len(got) - len(slots)
    assert sum(abs(got_context[X.slot(np.array([x]))[0]] - v) < 1e-5 for x, v in contexts.items()) > 0.95 * len(contexts)


def test_held_out_accuracy(spark, corpus):
    docs, labels = corpus
    got = X.score_documents(docs, docs, labels).select("row.doc_id", "held_out", "score", "predicted").collect()
    truth = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    assert len(got) == docs.count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [r for r in got if r["held_out"]]
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held)
    assert right / len(held) > 0.97


def test_held_out_labels_are_not_read(spark, corpus):
    docs, labels = corpus
    turned = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a = {r[0]: r[1] for r in X.score_documents(docs, docs, labels).select("row.doc_id", "score").collect()}
    b = {r[0]: r[1] for r in X.score_documents(docs, docs, turned).select("row.doc_id", "score").collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_edge_rows(spark, corpus):
    docs, labels = corpus
    plain = (docs.where("doc_id = 1").first()["text"] + " ") * 300
    rows = [(10_000, None, "x"), (10_001, "", "x"), (None, "you idiot", "x"), (10_002, "idiot " * 50_000, "x"),
            (10_003, plain, "x"), (10_003, plain, "x")]
    odd = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").withColumnRenamed("lang", "score")
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 1), (3, 1, None), (3, 1, 0), (99_999, 0, 1)], labels.schema))
    got = X.score_documents(odd, docs, labels).collect()
    by = {r["row"]["doc_id"]: r for r in got}
    assert len(got) == 6 and by[10_000]["score"] == by[10_001]["score"] and by[None]["held_out"] is False
    assert by[10_002]["predicted"] == 1 and by[10_003]["predicted"] == 0
    left = X.drop_toxic(odd, docs, labels)
    assert left.columns == odd.columns and {r["doc_id"] for r in left.collect()} >= {10_000, 10_001, 10_003}
    assert X.score_documents(odd.limit(0), docs, labels).collect() == []
    nothing = X.score_documents(odd, docs, labels.limit(0)).collect()
    assert len(nothing) == 6 and all(r["predicted"] == 0 for r in nothing)


def test_query(spark):
    got = Q.QUERIES["op3_toxicity"](spark, SF_MED)
    assert dict(got.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    assert got.count() == spark.read.parquet(f"{SF_MED}/documents.parquet").count()


def test_stage_keeps_columns(spark):
    from ratingspark.llm import stages
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    left = stages.toxicity(spark, docs, SF_SMALL)
    assert left.columns == docs.columns and 0 < left.count() <= docs.count()


def test_length_alone_is_not_toxic(spark):
    """Held-out ordinary documents of sf0.1 joined into long texts stay
    ordinary; joined toxic ones stay toxic."""
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    held = docs.join(labels.where("toxic is not null"), "doc_id").where(X.held_out(F.col("doc_id"))).select(
        "doc_id", "text", "toxic").orderBy("doc_id").collect()
    r, rows = random.Random(0), []
    for toxic in (0, 1):
        texts = [x["text"] for x in held if x["toxic"] == toxic]
        rows += [(toxic * 1000 + k, " ".join(r.choices(texts, k=k))) for k in (20, 100) for _ in range(40)]
    joined = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = X.score_documents(joined, docs, labels).groupBy("row.doc_id").agg(F.avg("predicted")).collect()
    share = dict(tuple(x) for x in got)
    assert share[20] <= 0.05 and share[100] <= 0.05
    assert share[1020] >= 0.95 and share[1100] >= 0.95


def test_model_keeps_every_ngram(spark, corpus):
    """No two n-grams share an entry, unseen ones find none, fold 3 counts for
    the final model, and a model too large to broadcast gives the same scores."""
    r = random.Random(2)
    noise = ["".join(chr(r.randint(33, 126)) for _ in range(6000)) for _ in range(40)]
    rows = [(t, i % 2) for i, t in enumerate(noise)]
    want = np.unique(np.concatenate([X.ngrams(t) for t in noise]))
    grams, contexts = X.learn(spark.createDataFrame(rows, "text string, toxic int")).value
    assert np.array_equal(grams.keys, want) and np.array_equal(contexts.keys, np.unique(want >> 8))
    assert np.isnan(grams[X.slot(np.setdiff1d(np.arange(1 << 20), want))]).all()
    docs, labels = corpus
    folds = {r[0] for r in X.labelled(docs, labels, "doc_id", "text").select("fold").distinct().collect()}
    assert folds == {0, 1, 3}
    odd = docs.where("doc_id % 7 = 0").unionByName(spark.createDataFrame(
        [(5000, None, "x"), (5000, "idiot " * 300_000, "x"), (None, "Ж\U0001f600 q", "x")], docs.schema))
    a, b = ([tuple(r) for r in X.score_documents(odd, docs, labels, limit=k).select("row.doc_id", "score").collect()]
            for k in (X.TABLE_BYTES, 0))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert len(a) == odd.count() and [r[0] for r in sorted(a, key=key)] == [r[0] for r in sorted(b, key=key)]
    assert [r[1] for r in sorted(a, key=key)] == pytest.approx([r[1] for r in sorted(b, key=key)], abs=1e-9)


def test_slices_change_nothing(monkeypatch):
    r = random.Random(5)
    texts = ["", "a", "é" * 40, "".join(r.choice("abcde fghi") for _ in range(3000))]
    grams = np.unique(np.concatenate([X.ngrams(t) for t in texts]))
    values = np.random.default_rng(2).normal(size=len(grams))
    model = X.tables(grams, values)
    whole = [X.ngrams(t) for t in texts]
    want = [X.evidence(t, *model) for t in texts]
    for size in (1, 3, X.PHRASE - 1, X.PHRASE, 100):
        monkeypatch.setattr(X, "SLICE", size)
        for t, h, (mean, phrase, windows) in zip(texts, whole, want):
            assert (X.ngrams(t) == h).all() and max(len(x) for x in X.slices(t)) <= size
            got = X.evidence(t, *model)
            assert abs(got[0] - mean) < 1e-9 and abs(got[1] - phrase) < 1e-6 and got[2] == windows


def test_counts_of_slices_add_up(monkeypatch):
    import pyarrow as pa

    rows = [(1, "abcabcabc " * 30), (0, None), (0, "abcabc"), (1, "")]
    batch = pa.RecordBatch.from_pydict({"toxic": [y for y, _ in rows], "text": pa.array([t for _, t in rows], pa.string())})

    def counted():
        out = {}
        for b in X._count([batch]):
            for g, n0, n1 in zip(*(c.to_pylist() for c in b.columns)):
                a, c = out.get(g, (0, 0))
                out[g] = (a + n0, c + n1)
        return out

    want = counted()
    assert sum(a + c for a, c in want.values()) == sum(len(X.ngrams(t)) for _, t in rows)
    monkeypatch.setattr(X, "SLICE", 7)
    assert counted() == want
