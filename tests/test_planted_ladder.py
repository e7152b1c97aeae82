"""Planted effects (F4): the whole ladder on seeded data with known movie,
user, release-year and rank-3 interaction effects. Each model that adds a
planted effect must lower the test RMSE; the fitted biases must track the
truth."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.plans import factors as FX
from ratingspark.plans import models as M
from ratingspark.plans.pipeline import RatingSets


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(11)
    n_u, n_i = 240, 160
    b_u = rng.normal(0, 0.4, n_u)
    b_i = rng.normal(0, 0.5, n_i)
    years = rng.integers(1950, 2000, n_i)
    b_y = (years - 1975) * -0.02            # older films rated higher
    P = rng.normal(0, 0.45, (n_u, 3))
    Q = rng.normal(0, 0.45, (n_i, 3))
    rows = []
    t0, t1 = 788918400, 1009843200                 # 1995-01-01 .. 2002-01-01
    for u in range(n_u):
        for i in rng.choice(n_i, 90, replace=False):
            ts = int(rng.integers(t0, t1))
            b_t = -0.6 * (ts - t0) / (t1 - t0) + 0.3   # later ratings lower
            r = 3.5 + b_i[i] + b_u[u] + b_y[i] + b_t + P[u] @ Q[i] + rng.normal(0, 0.15)
            rows.append((u, int(i), float(min(5.0, max(0.5, r))), ts))
    ratings = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    movies = spark.createDataFrame([(i, f"film {i} ({years[i]})", "Drama") for i in range(n_i)],
                                   "movieId long, title string, genres string")
    return RatingSets(spark, "unused", ratings=ratings, movies=movies), b_i


def _rmse(df):
    return A.rmse(df).first()["rmse"]


def test_ladder_lowers_rmse(planted):
    s, b_i = planted
    naive = _rmse(M.naive_predictions(s))
    bias = _rmse(M.bias_predictions(s, 1.0, clamp=True))
    sym = _rmse(M.sym_predictions(s, lam=1.0))
    fx = FX.svd_test_predictions(s, f=3, rank=3)
    svd = _rmse(fx)
    assert naive > bias > svd
    assert sym <= bias + 1e-3
    assert svd < 0.5 * naive


def test_movie_bias_tracks_truth(planted):
    s, b_i = planted
    chain = M.movie_user_chain(s, 1.0)
    est = {r["movieId"]: r["b_0"] for r in chain.tables[0].collect()}
    ids = sorted(est)
    corr = np.corrcoef([est[i] for i in ids], [b_i[i] for i in ids])[0, 1]
    assert corr > 0.8


def test_time_biases(planted):
    """A release-year effect is a movie attribute, so the movie bias absorbs
    it (the year stage fits what is left); a rating-date effect varies within
    movies and users and is recovered by the month stage, which then lowers
    the test RMSE."""
    s, _ = planted
    chain = M.time_chain(s, 1.0, 5.0)
    m = chain.tables[1].toPandas()
    order = (m["rating_month"] - m["rating_month"].min()).map(lambda d: d.days)
    assert np.corrcoef(order, m["b_0"])[0, 1] < -0.8
    assert _rmse(M.time_predictions(s, 1.0, 5.0)) < _rmse(M.bias_predictions(s, 1.0, clamp=True))
