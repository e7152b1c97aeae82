"""Bias models: hand golden values, grid = separate fits, lambda -> inf,
strict RMSE, clamp, planted effects."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.functions.columns import clamp, param_grid
from ratingspark.operators import aggregates as A
from ratingspark.operators.bias import fit_chain, grid_rmse, predict_chain, single, tune_chain

GOLDEN = [(1, "A", 5.0), (1, "B", 3.0), (2, "A", 4.0), (2, "B", 2.0)]


@pytest.fixture
def golden(spark):
    return spark.createDataFrame(GOLDEN, "userId int, movieId string, rating double")


def _biases(chain, j, name):
    return {r[0]: r[1] for r in single(chain, j, name).collect()}


def test_golden_lambda_zero(golden):
    mu = A.mean_value(golden)
    assert mu == pytest.approx(3.5)
    chain = fit_chain(golden, ["movieId", "userId"], [0.0], base=mu)
    assert _biases(chain, 0, "b") == pytest.approx({"A": 1.0, "B": -1.0})
    assert _biases(chain, 1, "b") == pytest.approx({1: 0.5, 2: -0.5})
    curve = grid_rmse(predict_chain(golden, chain, base=mu), [0.0]).first()
    assert curve["rmse"] == pytest.approx(0.0, abs=1e-12)


def test_golden_lambda_two(golden):
    mu = 3.5
    chain = fit_chain(golden, ["movieId", "userId"], [2.0], base=mu)
    assert _biases(chain, 0, "b") == pytest.approx({"A": 0.5, "B": -0.5})
    assert _biases(chain, 1, "b") == pytest.approx({1: 0.25, 2: -0.25})
    pred = predict_chain(golden, chain, base=mu).orderBy("userId", "movieId")
    assert [r["pred_0"] for r in pred.collect()] == pytest.approx([4.25, 3.25, 3.75, 2.75])
    rmse = grid_rmse(pred, [2.0]).first()["rmse"]
    assert rmse == pytest.approx(math.sqrt(0.3125))
    assert rmse == pytest.approx(0.559017, abs=1e-6)


def test_grid_equals_separate_fits(golden, spark):
    rows = [(u, m, float((u * 7 + m * 3) % 10) / 2 + 0.5) for u in range(12) for m in range(9) if (u + m) % 3]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    mu = A.mean_value(df)
    grid = [0.0, 1.5, 4.0]
    wide = {r["param"]: r["rmse"] for r in tune_chain(df, df, ["movieId", "userId"], grid, mu, mu, clamp=True).collect()}
    for lam in grid:
        one = tune_chain(df, df, ["movieId", "userId"], [lam], mu, mu, clamp=True).first()["rmse"]
        assert wide[lam] == pytest.approx(one, rel=1e-12)


def test_large_lambda_is_naive(golden):
    mu = 3.5
    curve = tune_chain(golden, golden, ["movieId", "userId"], [1e12], mu, mu).first()
    naive = math.sqrt(sum((r - mu) ** 2 for _, _, r in GOLDEN) / 4)
    assert curve["rmse"] == pytest.approx(naive, rel=1e-9)


def test_strict_rmse_null_on_missing(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, None)], "rating double, pred double")
    r = A.rmse(df).first()
    assert r["rmse"] is None and r["n_missing"] == 1


def test_clamp_bounds_and_null(spark):
    df = spark.createDataFrame([(0.1,), (5.7,), (3.3,), (None,)], "p double")
    out = [r[0] for r in df.select(clamp("p")).collect()]
    assert out == [0.5, 5.0, 3.3, None]


def test_nullsafe_year_bias(spark):
    df = spark.createDataFrame([("1999", 4.0), (None, 2.0), (None, 3.0)], "release_year string, rating double")
    chain = fit_chain(df, ["release_year"], [0.0], base=3.0)
    pred = predict_chain(df, chain, base=3.0).collect()
    assert all(r["pred_0"] is not None for r in pred)
    assert {r["release_year"]: r["pred_0"] for r in pred}[None] == pytest.approx(2.5)


def test_param_grid_has_41_points():
    g = param_grid(4, 6, 0.05)
    assert len(g) == 41 and g[0] == 4 and g[-1] == pytest.approx(6.0)
    assert len(param_grid(12, 14, 0.05)) == 41


def test_planted_effects_recovered(spark):
    """r = 3.5 + b_item + b_user + noise: fitted biases track the truth and
    each added stage lowers training RMSE."""
    rng = np.random.default_rng(7)
    n_u, n_i = 120, 80
    bu = rng.normal(0, 0.5, n_u)
    bi = rng.normal(0, 0.7, n_i)
    rows = []
    for u in range(n_u):
        for i in rng.choice(n_i, 40, replace=False):
            r = 3.5 + bi[i] + bu[u] + rng.normal(0, 0.3)
            rows.append((u, int(i), float(r)))
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    mu = A.mean_value(df)
    chain = fit_chain(df, ["movieId", "userId"], [1.0], base=mu)
    est_i = _biases(chain, 0, "b")
    corr = np.corrcoef([est_i[i] for i in range(n_i)], bi)[0, 1]
    assert corr > 0.9
    r_naive = A.rmse(df.withColumn("pred", F.lit(mu))).first()["rmse"]
    item_only = fit_chain(df, ["movieId"], [1.0], base=mu)
    r_item = grid_rmse(predict_chain(df, item_only, base=mu), [1.0]).first()["rmse"]
    r_both = grid_rmse(predict_chain(df, chain, base=mu), [1.0]).first()["rmse"]
    assert r_naive > r_item > r_both
    assert r_both < 0.4


def test_long_grid_is_chunked_with_same_values(spark):
    rows = [(u, m, float((u * 7 + m * 3) % 10) / 2 + 0.5) for u in range(12) for m in range(9) if (u + m) % 3]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    grid = param_grid(0.0, 9.9, 0.1)                      # 100 penalties -> chunks of 64 and 36
    assert len(grid) == 100
    curve = {r["param"]: r["rmse"] for r in tune_chain(df, df, ["movieId", "userId"], grid, 3.0, 3.0).collect()}
    assert len(curve) == 100
    for lam in (grid[0], grid[63], grid[64], grid[99]):
        one = tune_chain(df, df, ["movieId", "userId"], [lam], 3.0, 3.0).first()["rmse"]
        assert curve[lam] == pytest.approx(one, rel=1e-12)


def _ladder_rows(spark):
    rows = [(u % 60, (u * 7) % 45, float(1 + (u * 3) % 10) / 2, "19%02d" % (u % 9) if u % 5 else None, u % 4) for u in range(2400)]
    return spark.createDataFrame(rows, "userId long, movieId long, rating double, release_year string, rating_month int")


def test_grid_rows_are_dealt_while_narrow(spark):
    """Keys with many values: rows move before they carry the grid's columns,
    and the biases are those of tasks that add up first."""
    df = _ladder_rows(spark)
    keys, grid = ["movieId", "userId", "release_year", "rating_month"], [float(x) for x in range(41)]
    dealt = fit_chain(df, keys, grid, base=2.7, few_groups=20)
    plain = fit_chain(df, keys, grid, base=2.7, few_groups=1000)
    for j in range(4):
        a, b = ({r[0]: tuple(r)[1:] for r in c.tables[j].collect()} for c in (dealt, plain))
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k], rel=1e-9, abs=1e-12) for k in a)
    assert dealt.first.columns == ["movieId", "_s", "n"]


def test_rows_of_a_grid_move_narrow(spark, monkeypatch):
    """No shuffle of a fit carries a column per penalty by row: the user sums
    of 41 penalties follow the rows' shuffle."""
    from ratingspark.operators import bias as B
    plans = []
    checked = B.size_checked
    monkeypatch.setattr(B, "size_checked", lambda df, **kw: plans.append(df._jdf.queryExecution().executedPlan().toString()) or checked(df, **kw))
    fit_chain(_ladder_rows(spark), ["movieId", "userId"], [float(x) for x in range(41)], base=2.7, few_groups=20)
    assert plans[1].count("Exchange hashpartitioning(userId") == 1
    assert "partial_sum" in plans[1].split("Exchange hashpartitioning(userId")[0]   # both aggregates lie after the shuffle
    assert "partial_sum" not in plans[1].split("Exchange hashpartitioning(userId")[1]


def test_carried_residual_equals_joins_of_every_stage(spark):
    df = _ladder_rows(spark)
    keys = ["movieId", "userId", "release_year", "rating_month"]
    same = fit_chain([df, df, df, df], keys, [3.0], base=2.7)                       # the last two share their rows
    apart = fit_chain([df.select("*") for _ in keys], keys, [3.0], base=2.7)
    for j in range(4):
        a, b = ({r[0]: r["b_0"] for r in c.tables[j].collect()} for c in (same, apart))
        assert a == pytest.approx(b, rel=1e-9, abs=1e-12)


def test_wide_grids_are_summed_in_pieces(spark, monkeypatch):
    """No generated function joins and sums more than PIECE penalties behind a
    wide table, and the pieces give the curve and biases of the whole; the
    release year may be NULL."""
    from ratingspark.operators import bias as B
    rows = [(u, i, float((u * 7 + i * 3) % 10 + 1) / 2, None if i % 4 == 0 else str(1990 + i % 3), u % 5)
            for u in range(40) for i in range(12) if (u + i) % 3]
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double, release_year string, rating_month int")
    keys, grid = ["movieId", "userId", "release_year", "rating_month"], [4.0 + k / 4 for k in range(31)]
    attach, widths = B._attach, []

    def counted(df, chain, upto, *more):
        if upto > 1:
            widths.append(chain.m)
        return attach(df, chain, upto, *more)

    monkeypatch.setattr(B, "_attach", counted)

    def fitted(piece):
        widths.clear()
        monkeypatch.setattr(B, "PIECE", piece, raising=False)
        chain = B.fit_chain(df, keys, grid, base=2.7, few_groups=10)
        curve = [tuple(r) for r in B.score_chain(df, chain, 2.7, clamp=True).collect()]
        tables = [sorted((tuple(r) for r in t.collect()), key=lambda r: str(r[0])) for t in chain.tables]
        return curve, tables, max(widths)

    curve, tables, widest = fitted(14)
    whole, all_tables, _ = fitted(100)
    assert widest <= 14
    assert [r[0] for r in curve] == grid and {r[2] for r in curve} == {len(rows)}
    for a, b in zip(curve, whole, strict=True):
        assert a == pytest.approx(b, rel=1e-12)
    for a, b in zip(tables, all_tables, strict=True):
        assert [r[0] for r in a] == [r[0] for r in b]
        for x, y in zip(a, b, strict=True):
            assert x[1:] == pytest.approx(y[1:], rel=1e-9, abs=1e-12)
