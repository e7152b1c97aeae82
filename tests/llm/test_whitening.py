"""Whitening against numpy's dense eigensolver, and the qd solver alone."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ratingspark.llm import whitening as W
from ratingspark.llm.queries import QUERIES
from tests.conftest import SF_SMALL

SCHEMA = "vec_id bigint, embedding array<double>, x binary, `row` int, whitened string, deviation int"


def plain(vectors, k):
    """{index: (n, deviation, whitened, explained)} of usable vectors; signs free."""
    good = {i: v for i, v in enumerate(vectors) if v and all(c is not None and math.isfinite(c) for c in v)}
    x = {i: [math.floor(256 * c) for c in v] for i, v in good.items()}
    fit = sorted(set(map(tuple, x.values())))
    n, d = len(fit), len(fit[0])
    s = [sum(c) for c in zip(*fit)]
    centred = lambda row: np.array([float(n * a - b) for a, b in zip(row, s)]) / n
    c = np.array([centred(r) for r in fit])
    cov = c.T @ c / n
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1][:k], vec[:, ::-1][:, :k]
    return {i: (n, sum((n * a - b) ** 2 for a, b in zip(r, s)), centred(r) @ vec / np.sqrt(e), e / np.trace(cov))
            for i, r in x.items()}


def same(got, want):
    sign = {}
    for i, rows in got.items():
        n, deviation, white, share = want[i]
        assert [r["component"] for r in rows] == list(range(1, len(white) + 1))
        for r, w, s in zip(rows, white, share):
            k = r["component"]
            if abs(w) > 1e-3:
                assert sign.setdefault(k, np.sign(w * r["whitened"])) == np.sign(w * r["whitened"])
            assert (r["n"], r["deviation"]) == (n, deviation)
            assert abs(abs(w) - abs(r["whitened"])) < 1e-9 and abs(r["explained"] / s - 1) < 1e-9
            assert r["identity_error"] < 1e-9
    assert set(got) == set(want)


def by_row(out):
    got = {}
    for r in out.collect():
        got.setdefault(r["row"]["row"], []).append(r)
    return {i: sorted(rows, key=lambda r: r["component"]) for i, rows in got.items()}


def frame(spark, vectors):
    return spark.createDataFrame([(i % 7 or None, v, b"", i, "w", 0) for i, v in enumerate(vectors)], SCHEMA)


@pytest.mark.parametrize("d,parts,fan", [(3, 1, 16), (9, 7, 2), (40, 5, 3)])
def test_rows_and_edge_vectors(spark, d, parts, fan):
    rng = np.random.default_rng(d)
    vectors = (rng.standard_normal((90, d)) * np.arange(1, d + 1)).tolist()
    vectors += vectors[:20] + [vectors[0]] * 40
    vectors += [None, [], [None] * d, [math.nan] + [0.0] * (d - 1), [math.inf] * d, [1.0] * (d + 1), [0.0] * d, [-0.0] * d]
    usable = [v if v and len(v) == d else None for v in vectors]
    df = frame(spark, vectors).repartition(parts)
    model = W.fit_whitening(df, k=4, fan=fan)
    same(by_row(W.whiten(df, k=4, model=model)), plain(usable, min(4, d)))


def test_registered_query(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").collect()
    want = plain([r["embedding"] for r in rows], 4)
    got = {}
    for r in QUERIES["op11_whitening"](spark, SF_SMALL).collect():
        got.setdefault(r["vec_id"], []).append(r)
    at = {r["vec_id"]: i for i, r in enumerate(rows)}
    same({at[v]: sorted(g, key=lambda r: r["component"]) for v, g in got.items()}, want)


def test_little_variance(spark):
    assert W.whiten(frame(spark, [])).collect() == []
    assert W.whiten(frame(spark, [None, []])).collect() == []
    one = W.whiten(frame(spark, [[1.0, 2.0]] * 3)).collect()
    assert len(one) == 6 and all(r["n"] == 1 and r["deviation"] == 0 and r["whitened"] is None and r["explained"] is None
                                 and r["identity_error"] is None for r in one)
    two = W.whiten(frame(spark, [[1.0, 2.0, 3.0], [1.0, 2.5, 3.0]])).collect()
    assert sorted((r["component"], r["whitened"] and round(abs(r["whitened"]), 9), round(r["explained"], 9)) for r in two
                  )[:4] == [(1, 1.0, 1.0), (1, 1.0, 1.0), (2, None, 0.0), (2, None, 0.0)]
    assert all(r["identity_error"] < 1e-12 for r in two)


def test_large_entries_stay_exact(spark):
    vectors = [[1e12, 0.5], [-3e12, 1.5], [2.0, -1e12], [5e300, 1.0]]
    out = by_row(W.whiten(frame(spark, vectors)))
    x = [[min(math.floor(256 * c), W.LIMIT) for c in v] for v in vectors]
    s = [sum(c) for c in zip(*x)]
    for i, rows in out.items():
        deviation = sum((4 * a - b) ** 2 for a, b in zip(x[i], s))
        assert all(r["deviation"] == (deviation if deviation <= W.LIMIT else None) for r in rows)


def cases():
    rng = np.random.default_rng(1)
    for trial in range(120):
        d = int(rng.integers(1, 30))
        r = np.triu(rng.standard_normal((d, d)))
        q = np.linalg.qr(rng.standard_normal((d, d)))[0]
        yield [r, np.diag(rng.integers(0, 3, d).astype(float)), np.triu(rng.integers(-1, 2, (d, d)).astype(float)),
               np.linalg.qr(np.diag(np.repeat([3.0, 2.0, 1e-3], d)[:d]) @ q, mode="r"),
               r * 10.0 ** rng.integers(-8, 8, (d, 1)), np.linalg.qr(np.diag(1 + 1e-9 * np.arange(d)) @ q, mode="r"),
               np.zeros((d, d)), r * (np.arange(d) < d // 2)][trial % 8]


def test_solver_on_clusters_ties_and_missing_rank():
    for r in cases():
        d = len(r)
        for k in {min(4, d), d}:
            values, z = W.components(r, k)
            want = np.linalg.svd(r)[1][:k] ** 2
            top = max(want[0], 1e-300)
            assert np.abs(values - want).max() <= 1e-12 * top
            assert np.abs(z.T @ z - np.eye(k)).max() < 1e-11
            assert np.abs(r.T @ (r @ z) - z * values).max() <= 1e-11 * top
            assert np.all(np.diff(values) <= 0)


def test_dqds_finds_small_values_accurately():
    # the values of this graded bidiagonal matrix span 30 orders of magnitude
    a = 10.0 ** -np.arange(0, 16.0)
    b = a[:-1] / 3
    values = W.dqds(a ** 2, b ** 2)
    # exact to 1e-12: by the determinant, product of squares of the diagonal
    assert abs(np.sum(np.log(values)) - np.sum(np.log(a ** 2))) < 1e-10
    assert np.all(values > 0)
