"""SVD against numpy, planted low rank, dense index, pivots, histograms, ALS."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.operators import views as V
from ratingspark.operators.index import dense_index
from ratingspark.operators.svd import factor_dot, truncated_svd
from tests.conftest import SF_MED, SF_SMALL


@pytest.fixture(scope="module")
def planted(spark):
    """Sparse cells of a rank-3 matrix plus small noise (seeded)."""
    rng = np.random.default_rng(3)
    n_u, n_i, r = 90, 70, 3
    U = rng.normal(0, 1, (n_u, r)) * np.array([3.0, 2.0, 1.2])
    Vm = rng.normal(0, 1, (n_i, r))
    mask = rng.random((n_u, n_i)) < 0.5
    M = np.where(mask, U @ Vm.T + rng.normal(0, 0.01, (n_u, n_i)), 0.0)
    rows = [(int(u), int(i), float(M[u, i])) for u, i in zip(*np.nonzero(mask))]
    return spark.createDataFrame(rows, "userId long, movieId long, res double"), M


def test_svd_matches_numpy(planted):
    cells, M = planted
    fit = truncated_svd(cells, rank=3, oversample=5)
    sv = np.linalg.svd(M, compute_uv=False)
    assert fit.sigma == pytest.approx(list(sv[:3]), rel=1e-6)
    # reconstruction of every observed cell equals numpy's rank-3 product
    U, S, Vt = np.linalg.svd(M, full_matrices=False)
    R = (U[:, :3] * S[:3]) @ Vt[:3]
    got = factor_dot(cells, fit).toPandas()
    ref = R[got.userId.to_numpy(), got.movieId.to_numpy()]
    assert np.max(np.abs(got.res_pred.to_numpy() - ref)) < 1e-5 * np.max(np.abs(ref))


def test_svd_prefix_ranks_and_missing(planted, spark):
    cells, M = planted
    fit = truncated_svd(cells, rank=3, oversample=5)
    probe = spark.createDataFrame([(0, 0), (10**9, 0)], "userId long, movieId long")
    out = factor_dot(probe, fit, [1, 3]).orderBy("userId").collect()
    assert out[1]["res_pred_1"] == 0.0 and out[1]["res_pred_3"] == 0.0
    assert abs(out[0]["res_pred_3"]) > 0


def test_dense_index(spark):
    df = spark.createDataFrame([(x,) for x in [50, 3, 3, 900, 17, 50, 2]], "id long")
    got = {r["id"]: r["index"] for r in dense_index(df, "id", partitions=3).collect()}
    assert got == {2: 1, 3: 2, 17: 3, 50: 4, 900: 5}


def test_popular_active_is_sequential(spark):
    rows = [(u, 1, 1.0) for u in range(5)] + [(0, 2, 1.0), (0, 3, 1.0)]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    # movie 1 has 5 ratings; movies 2, 3 only one: after dropping them user 0 has 1 rating
    out = V.popular_active(df, "movieId", "userId", min_item=2, min_user=2)
    assert out.count() == 0
    assert V.popular_active(df, "movieId", "userId", min_item=2, min_user=1).count() == 5


def test_pivot_sorted_columns_and_dropna(spark):
    rows = [(1, "b", 1.0), (1, "a", 2.0), (1, "a", 4.0), (2, "a", 5.0)]
    df = spark.createDataFrame(rows, "userId int, t string, v double")
    wide = V.pivot_wide(df, "userId", "t", "v", ["b", "a"])
    assert wide.columns == ["userId", "a", "b"]
    assert [tuple(r) for r in wide.collect()] == [(1, 3.0, 1.0)]
    filled = V.pivot_wide(df, "userId", "t", "v", ["a", "b"], drop_na=False, fill=0.0).orderBy("userId")
    assert [tuple(r) for r in filled.collect()] == [(1, 3.0, 1.0), (2, 5.0, 0.0)]


def test_histogram_keeps_empty_bins(spark):
    df = spark.createDataFrame([(0.5,), (0.5,), (5.0,)], "x double")
    h = A.histogram(df, "x", bins=10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == 3
    assert h[0]["count"] == 2 and h[-1]["count"] == 1
    assert h[0]["x"] == pytest.approx(0.5) and h[-1]["x"] == pytest.approx(5.0)


def test_qq_points_line(spark):
    from statistics import NormalDist
    df = spark.range(0, 1001).select(F.col("id"), ((F.col("id") * 17 % 1001) / 1000.0).alias("x"))
    q = A.qq_points(df, "x", "id").orderBy("i").collect()
    assert len(q) == 1001 and [r["sample"] for r in q] == [i / 1000 for i in range(1001)]
    for r in q:
        assert r["p"] == pytest.approx((r["i"] - 0.5) / 1001)
        assert r["theoretical"] == pytest.approx(NormalDist().inv_cdf(r["p"]), abs=1e-12)
    assert q[0]["slope"] == pytest.approx(0.5 / (2 * 0.6744897501960817))
    grid = A.qq_grid(df, "x", 11).collect()
    assert len(grid) == 11 and grid[5]["sample"] == pytest.approx(0.5)


def test_range_legend(spark):
    df = spark.createDataFrame([(-1.0,), (3.0,)], "v double")
    rows = A.range_legend(df, "v").orderBy("k").collect()
    assert [r["level"] for r in rows] == [-1.0, -0.5, 0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0]


def test_als_runs_and_scores(spark):
    from ratingspark.operators.mf import tune_als
    rng = np.random.default_rng(1)
    rows = [(int(u), int(i), float(np.clip(3 + rng.normal(), 0.5, 5))) for u in range(40) for i in range(30)
            if rng.random() < 0.5]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    curve, model = tune_als(df, ranks=(2, 4), folds=2, max_iter=5)
    assert curve.count() == 2
    pred = model.transform(df).select(F.col("rating"), F.col("prediction").alias("pred"))
    assert A.rmse(pred).first()["rmse"] < 1.5


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MED])
def test_registered_svd_against_numpy(spark, sf):
    """The registered fit against a dense SVD of the same residual cells: the
    products at every registered rank, and the rank that the curve picks."""
    from ratingspark.plans import factors as FX
    from ratingspark.plans import models as M
    from ratingspark.plans.queries import sets
    s = sets(spark, sf)
    cells = FX.residual_cells(s).toPandas()
    u = {v: i for i, v in enumerate(sorted(cells.userId.unique()))}
    it = {v: i for i, v in enumerate(sorted(cells.movieId.unique()))}
    dense = np.zeros((len(u), len(it)))
    dense[cells.userId.map(u), cells.movieId.map(it)] = cells.res
    U, sv, Vt = np.linalg.svd(dense, full_matrices=False)
    fit = FX.svd_fit(s)
    assert fit.sigma == pytest.approx(list(sv[:60]), rel=1e-7)
    uf, vf = fit.user_factors.toPandas(), fit.item_factors.toPandas()
    uf = np.stack(uf.set_index("userId").loc[list(u)].u.to_list())
    vf = np.stack(vf.set_index("movieId").loc[list(it)].v.to_list())
    for f in FX.SVD_RANKS:
        want = (U[:, :f] * sv[:f]) @ Vt[:f]
        assert np.linalg.norm(uf[:, :f] @ vf[:, :f].T - want) < 1e-3 * np.linalg.norm(want)
    cv = M.with_bt(s, s.cv_set).toPandas()
    known = cv.userId.isin(u) & cv.movieId.isin(it)
    rmse = {}
    for f in FX.SVD_RANKS:
        approx = (U[:, :f] * sv[:f]) @ Vt[:f]
        pred = np.zeros(len(cv))
        pred[known] = approx[cv.userId[known].map(u), cv.movieId[known].map(it)]
        rmse[f] = float(np.sqrt(np.mean((cv.rating - cv.b_t_pred - pred) ** 2)))
    curve = {int(r["param"]): r["rmse"] for r in FX.tune_svd_curve(s).collect()}
    assert curve == pytest.approx(rmse, abs=1e-5)
    assert FX.best_rank(s) == min(rmse, key=rmse.get)


def test_dense_index_more_partitions_than_ids(spark):
    df = spark.createDataFrame([(x,) for x in [9, 4, 4, 7, 1]], "id long")
    got = {r["id"]: r["index"] for r in dense_index(df, "id", partitions=50).collect()}
    assert got == {1: 1, 4: 2, 7: 3, 9: 4}
    big = spark.range(0, 5000).select(((F.col("id") * 7919) % 5000).alias("id"))
    codes = dense_index(big, "id", partitions=13).orderBy("id").collect()
    assert [r["index"] for r in codes] == list(range(1, 5001))
