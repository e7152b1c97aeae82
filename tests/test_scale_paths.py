"""Code paths that only trigger at scale, forced on small data."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.operators import split as S
from ratingspark.operators.index import dense_index
from ratingspark.operators.mf import apply_ids, int_ids, restore_ids, tune_als
from ratingspark.operators.order_stats import quantiles


def _drawn_by_sorting(df, p, seed, keys):
    """The draw by sorting every stratum on the driver."""
    import math
    rows = (df.withColumn("_s", S.stratum_expr("rating", S.rating_breaks(df)))
              .withColumn("_h", S.hash_expr(keys, seed)).collect())
    out = []
    for s in {r["_s"] for r in rows}:
        mine = sorted((r for r in rows if r["_s"] == s), key=lambda r: (r["_h"], *[r[k] for k in keys]))
        out += [tuple(r[k] for k in keys) for r in mine[:math.ceil(p * len(mine))]]
    return sorted(out)


@pytest.mark.parametrize("digits,few", [(3, 1000), (1, 1), (1, 5), (2, 3)])
def test_split_thresholds_equal_sorting(spark, digits, few):
    """Whatever the prefix width and the size of the listed rest, and with
    rows that repeat so that a quota ends among ties."""
    rows = [(u, u % 37, float(1 + (u * 7) % 10) / 2, u) for u in range(600)]
    rows += [(1, 1, 4.5, 1)] * 200 + [(2, 2, 0.5, 2)] * 150
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    keys = ["userId", "movieId", "rating", "timestamp"]
    for p in (0.1, 0.5):
        got = S.stratified_holdout(df, p, 3, key_cols=keys, digits=digits, few=few).filter("_holdout").select(*keys)
        assert sorted(tuple(r) for r in got.collect()) == _drawn_by_sorting(df, p, 3, keys)


@pytest.mark.parametrize("n", [1, 2, 5, 101, 20000])
def test_quantiles_equal_numpy(spark, n):
    rng = np.random.default_rng(n)
    values = np.round(rng.normal(0, 3, n), 2)
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "x double")
    probs = [0.0, 0.25, 1 / 3, 0.5, 0.75, 0.999, 1.0]
    assert quantiles(df, "x", probs) == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert quantiles(df, "x", [0.5]) == [None]
    assert A.summary_stats(df, "x", "x").first()["median"] is None


@pytest.mark.parametrize("reuse", ["true", "false"])
def test_dense_index_with_and_without_exchange_reuse(spark, reuse):
    spark.conf.set("spark.sql.exchange.reuse", reuse)
    try:
        ids = spark.range(0, 1_000_000).select((F.col("id") * 7_919_001 + 13).alias("id"))
        got = dense_index(ids, "id", "code", partitions=13)
        r = got.agg(F.count_distinct("code").alias("n"), F.min("code").alias("lo"), F.max("code").alias("hi"),
                    F.sum((F.col("code") != (F.col("id") - 13) / 7_919_001 + 1).cast("int")).alias("wrong")).first()
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
    assert (r["n"], r["lo"], r["hi"], r["wrong"]) == (1_000_000, 1, 1_000_000, 0)


def test_als_refuses_null_ids(spark):
    df = spark.createDataFrame([(1, 1, 3.0), (None, 1, 3.0)], "userId long, movieId long, rating double")
    with pytest.raises(ValueError, match="NULL"):
        int_ids(df, "userId")


def test_als_with_ids_beyond_int(spark):
    rng = np.random.default_rng(2)
    big = 10**10
    rows = [(big + u, 3 * big + i, float(np.clip(3 + rng.normal(), 0.5, 5)))
            for u in range(30) for i in range(20) if rng.random() < 0.6]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    train, umap = int_ids(df, "userId")
    train, imap = int_ids(train, "movieId")
    assert umap is not None and imap is not None
    _, model = tune_als(train, ranks=(2,), folds=2, max_iter=3)
    probe = spark.createDataFrame([(big + 1, 3 * big + 2), (7, 7)], "userId long, movieId long")
    scored = model.transform(apply_ids(apply_ids(probe, "userId", umap), "movieId", imap))
    out = {r["userId"]: r["prediction"] for r in restore_ids(scored, ["userId", "movieId"]).collect()}
    assert not np.isnan(out[big + 1]) and np.isnan(out[7])


def test_bias_chain_without_broadcast_same_result(spark):
    from ratingspark.operators.bias import fit_chain, grid_rmse, predict_chain
    rows = [(u % 50, (u * 7) % 40, float(1 + (u * 3) % 10) / 2, "19%02d" % (u % 9) if u % 5 else None)
            for u in range(2000)]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, release_year string")
    keys = ["movieId", "userId", "release_year"]
    grid = [1.0, 3.0]
    small = fit_chain(df, keys, grid, base=2.7)
    big = fit_chain(df, keys, grid, base=2.7, max_broadcast_bytes=1)   # every table over the bound
    # no explicit hint past the bound (Spark's own size threshold may still
    # broadcast tables this small); the results must not depend on it
    pb = predict_chain(df, big, base=2.7, clamp=True)
    a = {r["param"]: r["rmse"] for r in grid_rmse(predict_chain(df, small, base=2.7, clamp=True), grid).collect()}
    b = {r["param"]: r["rmse"] for r in grid_rmse(pb, grid).collect()}
    assert a == pytest.approx(b, rel=1e-12)


@pytest.fixture(scope="module")
def noise(spark):
    rng = np.random.default_rng(4)
    rows = [(int(u), int(i), float(rng.normal())) for u in range(60) for i in range(40) if rng.random() < 0.4]
    return spark.createDataFrame(rows, "userId long, movieId long, res double").repartition(5)


@pytest.mark.parametrize("how", [
    {"item_block": 8, "fan": 2},                                            # one stripe, many blocks, trees of products
    {"basis_bytes": 0, "item_block": 16, "fan": 2},                          # the basis in Spark
    {"basis_bytes": 0, "item_block": 8, "block_bytes": 1024, "fan": 2},      # and several stripes
    {"basis_bytes": 0, "item_block": 16, "max_columns": 24, "max_products": 300},   # and restarts
])
def test_svd_is_the_same_however_it_is_laid_out(spark, noise, how):
    import ratingspark.operators.svd as SV
    dense = np.zeros((60, 40))
    for r in noise.collect():
        dense[r["userId"], r["movieId"]] = r["res"]
    u, s, vt = np.linalg.svd(dense)
    fit = SV.truncated_svd(noise, rank=3, oversample=5, **how)
    assert fit.sigma == pytest.approx(list(s[:3]), rel=1e-8)
    got = SV.factor_dot(noise, fit, [1, 3]).toPandas()
    for f in (1, 3):
        want = ((u[:, :f] * s[:f]) @ vt[:f])[got.userId, got.movieId]
        assert np.abs(got[f"res_pred_{f}"] - want).max() < 1e-4
    c = SV.certify(fit, powers=4, fan=2)
    assert c.residual <= 2e-6 and c.items < 1e-10 and c.users < 1e-9 and c.captured2 <= c.norm2
    assert c.cells == noise.count() and c.norm2 == pytest.approx((dense ** 2).sum())
    assert s[3] / s[2] <= c.bound < 4


def test_certificate_sees_a_missing_value(spark, noise):
    """A fit whose second vector is left out is not certified."""
    import ratingspark.operators.svd as SV
    big = noise.unionByName(spark.createDataFrame([(99, 99, 30.0), (98, 98, 25.0)], noise.schema))
    fit = SV.truncated_svd(big, rank=3, oversample=5)
    keep = F.array(F.col("v")[0], F.col("v")[2])
    fit.item_factors = fit.item_factors.withColumn("v", keep)
    fit.user_factors = fit.user_factors.withColumn("u", F.array(F.col("u")[0], F.col("u")[2]))
    fit.sigma = [fit.sigma[0], fit.sigma[2]]
    c = SV.certify(fit, powers=6)
    assert c.residual < 1e-5 and c.bound > 1.5


def test_svd_that_does_not_converge_raises(spark, noise):
    import ratingspark.operators.svd as SV
    for basis_bytes in (0, SV.BASIS_BYTES):
        with pytest.raises(SV.NotConverged):
            SV.truncated_svd(noise, rank=3, oversample=2, max_products=2, basis_bytes=basis_bytes)


def test_svd_products_carry_only_unfinished_vectors(spark, noise, monkeypatch):
    """With the basis on the driver, what travels after the first block is the
    residuals of wanted vectors; 120,000 items are one stripe."""
    import ratingspark.operators.svd as SV
    widths, product = [], SV._normal_product

    def counted(m, stripe_of, k, tables):
        widths.append(k)
        return product(m, stripe_of, k, tables)

    monkeypatch.setattr(SV, "_normal_product", counted)
    fit = SV.truncated_svd(noise, rank=3, oversample=5)
    assert fit.products == len(widths) > 1 and widths[0] == 8 and max(widths[1:]) <= 3
    assert SV.BLOCK_BYTES // (8 * 80 * SV.ITEM_BLOCK) * SV.ITEM_BLOCK >= 120_000


@pytest.mark.parametrize("part_cells", [800_000, 700])
def test_svd_filter_equals_its_polynomial(spark, noise, monkeypatch, part_cells):
    """One part or several, several item blocks: the scaled Chebyshev
    polynomial of A'A, to single precision."""
    import ratingspark.operators.svd as SV
    monkeypatch.setattr(SV, "PART_CELLS", part_cells)
    m = SV.matrix_of(noise, "userId", "movieId", "res", 8, block=16)
    assert m.parts == -(-noise.count() // part_cells)
    dense = np.zeros((60, 40))
    for r in noise.collect():
        dense[r["userId"], r["movieId"]] = r["res"]
    values, vectors = np.linalg.eigh(dense.T @ dense)
    cut, top = values[-9], values[-1]
    cheb = np.polynomial.chebyshev.Chebyshev([0] * 5 + [1])
    q = np.random.default_rng(1).normal(size=(40, 7))
    want = (vectors * (cheb(2 * values / cut - 1) / cheb(2 * top / cut - 1))) @ vectors.T @ q
    assert np.abs(SV._filtered(m, q, cut, top, 5) - want).max() < 1e-5


def test_svd_with_a_short_basis_converges_in_few_steps(spark, monkeypatch):
    """Memory for three blocks and a dense edge of the spectrum: filtered
    vectors keep the steps few, where residuals were lost in restarts."""
    import ratingspark.operators.svd as SV
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(700, 500)) * (rng.random((700, 500)) < 0.06)
    u, i = np.nonzero(dense)
    cells = spark.createDataFrame([(int(a), int(b), float(dense[a, b])) for a, b in zip(u, i)], "userId int, movieId int, res double")
    collects, collected = [], SV._collected

    def counted(m, parts, k, fan):
        collects.append(k)
        return collected(m, parts, k, fan)

    monkeypatch.setattr(SV, "_collected", counted)
    fit = SV.truncated_svd(cells, rank=8, oversample=4, basis_bytes=8 * 500 * 60)
    assert fit.sigma == pytest.approx(list(np.linalg.svd(dense, compute_uv=False)[:8]), rel=1e-8)
    assert fit.products == len(collects) <= 14
    c = SV.certify(fit, powers=4)
    assert c.residual <= 2e-6 and c.items < 1e-9 and c.users < 1e-9


@pytest.mark.parametrize("columns", [400, 90])
def test_svd_long_single_precision_basis_equals_numpy(columns):
    """Without and with restarts; the largest value occurs six times."""
    import ratingspark.operators.svd as SV
    rng = np.random.default_rng(3)
    q = np.linalg.qr(rng.normal(size=(300, 300)))[0]
    values = np.sort(np.append(np.full(6, 9.0), rng.random(294) * 8))[::-1]
    a = (q * values) @ q.T
    v, multiplied = SV._krylov_single(lambda x: (a @ x).astype(np.float32), 300, 10, 14, 1e-6, 100, columns, 1)
    v = v.astype(np.float64)
    assert np.diag(v.T @ a @ v) == pytest.approx(list(values[:10]), rel=1e-5)
    assert np.linalg.norm(a @ v - v * values[:10], axis=0).max() < 3e-6 * 9
    assert multiplied <= (300 if columns == 400 else 900)


def test_svd_with_a_long_single_precision_basis(spark, monkeypatch):
    """Between memory for a full basis and for a short one: few columns travel,
    no filters run, records lie in several tasks, and the fit is exact."""
    import ratingspark.operators.svd as SV
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(700, 500)) * (rng.random((700, 500)) < 0.06)
    u, i = np.nonzero(dense)
    cells = spark.createDataFrame([(int(a), int(b), float(dense[a, b])) for a, b in zip(u, i)], "userId int, movieId int, res double")
    columns, single = [], SV._single_product

    def counted(m, q, fan):
        columns.append(q.shape[1])
        return single(m, q, fan)

    monkeypatch.setattr(SV, "_single_product", counted)
    monkeypatch.setattr(SV, "_filtered", None)
    monkeypatch.setattr(SV, "TASK_CELLS", 5000)
    fit = SV.truncated_svd(cells, rank=8, oversample=24, basis_bytes=8 * 500 * 130)
    assert fit.matrix.tasks == min(spark.sparkContext.defaultParallelism, len(u) // 5000)
    assert fit.sigma == pytest.approx(list(np.linalg.svd(dense, compute_uv=False)[:8]), rel=1e-8)
    assert 0 < sum(columns) <= 500
    c = SV.certify(fit, powers=1)
    assert c.residual <= 2e-6 and c.items < 1e-9 and c.users < 1e-9


def test_svd_finds_every_vector_of_a_repeated_value(spark):
    import ratingspark.operators.svd as SV
    rows = [(i, i, 3.0) for i in range(6)] + [(i, i, 2.0 - i / 100) for i in range(6, 60)]
    fit = SV.truncated_svd(spark.createDataFrame(rows, "userId int, movieId int, res double"), rank=7, oversample=2)
    assert fit.sigma == pytest.approx([3.0] * 6 + [1.94], rel=1e-8)


def test_als_folds_do_not_depend_on_partitions(spark):
    from ratingspark.operators.mf import stationarity
    rng = np.random.default_rng(1)
    rows = [(u, i, float(np.clip(3 + rng.normal(), 0.5, 5))) for u in range(40) for i in range(30) if rng.random() < 0.5]
    rows += [(41, 31, 4.0)]   # seen once: no prediction in its fold
    df = spark.createDataFrame(rows, "userId int, movieId int, rating double")
    curves = []
    for parts in (2, 13):
        curve, model = tune_als(df.repartition(parts), ranks=(2, 4), folds=2, max_iter=5)
        curves.append({r["rank"]: (round(r["rmse"], 9), r["n"], r["n_missing"]) for r in curve.collect()})
    assert curves[0] == curves[1]
    assert all(n == len(rows) and missing == 1 for _, n, missing in curves[0].values())
    gaps = stationarity(model, df, 0.01, "user").collect()
    assert len(gaps) == 41 and max(r["gap"] for r in gaps) < 1e-4 and sum(r["n"] for r in gaps) == len(rows)
    off = stationarity(model, df.withColumn("rating", F.col("rating") + 1), 0.01, "user").agg(F.min("gap")).first()[0]
    assert off > 1e-3


def test_als_blocks_follow_the_data():
    from ratingspark.operators.mf import block_count
    assert block_count(600_000, 15_000, 8) == 8 and block_count(600_000, 15_000, 4000) == 10
    assert block_count(10**11, 10**8, 4000) == 25_000 and block_count(100, 3, 8) == 3


def test_broadcasts_are_measured(spark):
    from ratingspark.operators.joins import size_checked
    texts = spark.range(200).select("id", F.repeat(F.lit("x"), 10_000).alias("text"))
    assert size_checked(texts, 3_000_000)[1] and not size_checked(texts, 1_000_000)[1]
    arrays = spark.range(10).select("id", F.sequence(F.lit(1), F.lit(5000)).alias("a"))
    assert not size_checked(arrays, 100_000)[1]


def test_large_stage_table_joined_while_row_is_narrow(spark):
    """A stage table over the broadcast bound is joined before the broadcast
    ones, so the shuffle join moves narrow rows; the sums do not change."""
    from ratingspark.operators.bias import fit_chain, predict_chain
    rows = [(u % 40, (u * 7) % 30, float(1 + (u * 3) % 10) / 2) for u in range(1500)]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double")
    chain = fit_chain(df, ["movieId", "userId"], [1.0, 2.0], base=2.5)
    ref = {(r.userId, r.movieId): (r.pred_0, r.pred_1) for r in predict_chain(df, chain, base=2.5).collect()}
    chain.small = [True, False]                       # pretend the user table is large
    out = predict_chain(df, chain, base=2.5)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    user_join = plan.index("(userId#")
    movie_join = plan.index("(movieId#")
    assert movie_join < user_join                     # user join sits deeper: applied first
    got = {(r.userId, r.movieId): (r.pred_0, r.pred_1) for r in out.collect()}
    assert got.keys() == ref.keys()
    for k in ref:
        assert got[k] == pytest.approx(ref[k], rel=1e-12)


def test_als_deletes_the_messages_of_older_iterations():
    from ratingspark.operators.mf import als
    assert als(4).getCheckpointInterval() <= 2


def test_svd_basis_on_the_driver_is_bounded(spark, monkeypatch):
    """However many columns memory holds, wide blocks iterate on CYCLE of them
    in single precision, at few columns more than a basis for all; the double
    precision basis and its image share ``basis_bytes``."""
    import ratingspark.operators.svd as SV
    rng = np.random.default_rng(5)
    dense = rng.normal(size=(700, 500)) * (rng.random((700, 500)) < 0.06)
    u, i = np.nonzero(dense)
    cells = spark.createDataFrame([(int(a), int(b), float(dense[a, b])) for a, b in zip(u, i)], "userId int, movieId int, res double")
    single, local, rooms = SV._krylov_single, SV._krylov_local, []

    def bounded(product, n, rank, block, tol, max_products, max_columns, seed):
        rooms.append(max_columns)
        v, multiplied = single(lambda q: (dense.T @ (dense @ q)).astype(np.float32), n, rank, block, tol, max_products, max_columns, seed)
        assert multiplied <= 1.3 * single(lambda q: (dense.T @ (dense @ q)).astype(np.float32), n, rank, block, tol, max_products, n, seed)[1]
        return v, multiplied

    def checked(mat, rank, block, tol, max_products, max_columns, *more, **kw):
        rooms.append(max_columns)
        return local(mat, rank, block, tol, max_products, max_columns, *more, **kw)

    monkeypatch.setattr(SV, "_krylov_single", bounded)
    monkeypatch.setattr(SV, "_krylov_local", checked)
    fit = SV.truncated_svd(cells, rank=8, oversample=25, basis_bytes=8 * 500 * 220)
    assert rooms == [SV.CYCLE * 33, 110] and 2 * 8 * 500 * rooms[1] <= 8 * 500 * 220
    assert fit.sigma == pytest.approx(list(np.linalg.svd(dense, compute_uv=False)[:8]), rel=1e-8)


def test_als_tuning_keeps_no_model_of_a_fold(spark):
    """Folds' factors are released before the next fit; only the last model's
    stay. Large messages are checkpointed in every iteration."""
    import time

    from ratingspark.operators.mf import CHECKPOINT_EVERY, checkpoint_every
    rows = [(u, i, float((u * i) % 5 + 1)) for u in range(1, 25) for i in range(1, 13) if (u + i) % 3]
    kept = lambda: len(spark.sparkContext._jsc.getPersistentRDDs())
    before = kept()
    curve, model = tune_als(spark.createDataFrame(rows, "userId int, movieId int, rating double"), ranks=(2, 3), folds=3, max_iter=2)
    for _ in range(20):
        if kept() - before <= 6:
            break
        time.sleep(0.5)
    assert kept() - before <= 6
    assert model.userFactors.count() == 24 and {r["n"] for r in curve.collect()} == {len(rows)}
    assert checkpoint_every(20, 900_000, 1_200_000, 7, 7) == 1 and checkpoint_every(20, 15_000, 20_000, 6, 6) == CHECKPOINT_EVERY
