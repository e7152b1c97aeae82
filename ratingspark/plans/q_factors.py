"""Queries for factor models: index codes, residual cells, SVD, ALS."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.operators import views as V
from ratingspark.operators.index import dense_index
from ratingspark.plans import factors as FX
from ratingspark.plans import models as M
from ratingspark.plans import oracle as O
from ratingspark.plans.q_models import _SYM_FIT
from ratingspark.plans.q_views import ARRANGE_BY, COLUMNS, MIN_ITEM, MIN_USER, PATTERNS, TITLES
from ratingspark.plans.queries import r6, register, sets
from ratingspark.session import cut_lineage
from ratingspark.plans.sql_models import chain_pred, with_base

_TSM = _SYM_FIT + ",\ntsm AS (SELECT *, rating - pred AS res FROM " + \
    chain_pred("s", M.ALL_KEYS, with_base("train_set", month=True), True) + " q)"


@register("idx_factor", O.with_sets(
    "SELECT movieId, dense_rank() OVER (ORDER BY movieId) AS movie_index FROM (SELECT DISTINCT movieId FROM train_set)"))
def idx_factor(spark, sf_dir):
    """1-based dense code of sorted movie ids, computed distributed."""
    return dense_index(sets(spark, sf_dir).train_set, "movieId", "movie_index")


@register("idx_factor_user", O.with_sets(
    "SELECT userId, dense_rank() OVER (ORDER BY userId) AS user_index FROM (SELECT DISTINCT userId FROM train_set)"))
def idx_factor_user(spark, sf_dir):
    """1-based dense code of sorted user ids, computed distributed."""
    return dense_index(sets(spark, sf_dir).train_set, "userId", "user_index")


@register("set_distinct", O.with_sets("SELECT DISTINCT movieId FROM train_set"))
def set_distinct(spark, sf_dir):
    """The movie id levels of the residual matrix."""
    return sets(spark, sf_dir).train_set.select("movieId").distinct()


@register("agg_dup_sum", O.with_sets(
    "SELECT userId, movieId, round(sum(res), 6) AS res FROM tsm GROUP BY userId, movieId", _TSM))
def agg_dup_sum(spark, sf_dir):
    """Residual cells with duplicate (user, movie) summed."""
    return r6(FX.residual_cells(sets(spark, sf_dir)))


# Bounds of the certificate of the SVD: residual and orthogonality relative to
# the largest value, and how far above the smallest value of the fit a value
# that the fit missed could lie (but for a probability of 1e-10).
RESIDUAL, ORTHOGONAL, MISSED = 2e-6, 1e-9, 1.5

_CELLS = "(SELECT sum(res) AS res FROM tsm GROUP BY userId, movieId)"


def _certified(s) -> dict:
    c = FX.svd_certificate(s)
    return {"residual_ok": c.residual <= RESIDUAL, "orthogonal_ok": max(c.items, c.users) <= ORTHOGONAL,
            "none_missed": c.bound <= MISSED and c.captured2 <= c.norm2}


def _sound(s):
    return F.lit(all(_certified(s).values()))


@register("mdl_svd_fit", O.with_sets(f"""
SELECT unnest(range(1, least({max(FX.SVD_RANKS)}, (SELECT count(DISTINCT movieId) FROM tsm)) + 1))::INT AS component,
       (SELECT count(*) FROM {_CELLS})::BIGINT AS n_cells, (SELECT round(sum(res * res), 4) FROM {_CELLS}) AS norm2,
       true AS falling, true AS residual_ok, true AS orthogonal_ok, true AS none_missed""", _TSM))
def mdl_svd_fit(spark, sf_dir):
    """Certificate of the rank-60 truncated SVD of the residual matrix, from
    its cells: residuals, orthogonality, and a norm bound of the rest."""
    s = sets(spark, sf_dir)
    fit, c = FX.svd_fit(s), FX.svd_certificate(s)
    rows = [(j + 1, v <= (fit.sigma[j - 1] if j else v)) for j, v in enumerate(fit.sigma)]
    out = spark.createDataFrame(rows, "component int, falling boolean")
    return out.select("component", F.lit(c.cells).cast("bigint").alias("n_cells"), F.round(F.lit(c.norm2), 4).alias("norm2"),
                      "falling", *[F.lit(v).alias(k) for k, v in _certified(s).items()])


@register("mdl_svd_sigma")
def mdl_svd_sigma(spark, sf_dir):
    """Singular values of the rank-60 truncated SVD of the residual matrix."""
    fit = FX.svd_fit(sets(spark, sf_dir))
    return spark.createDataFrame([(j + 1, s) for j, s in enumerate(fit.sigma)], "component int, sigma double")


_CV = chain_pred("s", M.ALL_KEYS, with_base("cv_set", month=True), True)


@register("tune_svd", O.with_sets(f"""
SELECT unnest([{", ".join(f"{float(f)}::DOUBLE" for f in FX.SVD_RANKS)}]) AS param,
       (SELECT count(*) FROM cv_set)::BIGINT AS n,
       (SELECT round(sqrt(avg((rating - pred) * (rating - pred))), 6) FROM {_CV} q) AS rmse_none,
       true AS adds_up, true AS certified""", _SYM_FIT))
def tune_svd(spark, sf_dir):
    """The rank curve's check: the residuals' RMSE without factors, and each
    rank's RMSE put together again from sums of products, on a sound fit."""
    s = sets(spark, sf_dir)
    pred = FX.cv_residual_preds(s)
    sums = [F.sum(F.col("res") * F.col("res")).alias("rr"), F.count(F.lit(1)).alias("n")]
    for f in FX.SVD_RANKS:
        p = F.col(f"res_pred_{f}")
        sums += [F.sum(F.col("res") * p).alias(f"rp{f}"), F.sum(p * p).alias(f"pp{f}")]
    one = pred.agg(*sums)
    again = [F.struct(F.lit(float(f)).alias("param"), ((F.col("rr") - 2 * F.col(f"rp{f}") + F.col(f"pp{f}")) / F.col("n")).alias("mse"),
                      "n", F.sqrt(F.col("rr") / F.col("n")).alias("rmse_none")) for f in FX.SVD_RANKS]
    curve = FX.tune_svd_curve(s).select("param", "rmse")
    out = one.select(F.inline(F.array(*again))).join(curve, "param")
    return r6(out.select("param", "n", "rmse_none", (F.abs(F.col("mse") - F.col("rmse") * F.col("rmse")) < 1e-9).alias("adds_up"),
                         _sound(s).alias("certified")))


@register("tune_svd_curve")
def tune_svd_curve(spark, sf_dir):
    """Residual RMSE on cv_set for f = 50, 55, 60 from one fit."""
    return r6(FX.tune_svd_curve(sets(spark, sf_dir)))


@register("join_factor_dot", O.with_sets(f"""
SELECT userId, movieId, rating_date, round(rating - pred, 6) AS res,
       userId IN (SELECT userId FROM train_set) AND movieId IN (SELECT movieId FROM train_set) AS known,
       true AS exact, true AS certified
FROM {_CV} q""", _SYM_FIT))
def join_factor_dot(spark, sf_dir):
    """Per cv row: residual, whether both sides have factors, and whether its
    reconstructions equal sums over the two arrays taken entry by entry (0
    without factors), on a sound fit."""
    s = sets(spark, sf_dir)
    fit = FX.svd_fit(s)
    out = FX.cv_residual_preds(s).join(fit.user_factors, "userId", "left").join(fit.item_factors, "movieId", "left")
    known = F.col("u").isNotNull() & F.col("v").isNotNull()
    exact = F.lit(True)
    for f in FX.SVD_RANKS:
        dot = F.aggregate(F.zip_with(F.slice("u", 1, f), F.slice("v", 1, f), lambda a, b: a * b), F.lit(0.0), lambda acc, x: acc + x)
        exact = exact & (F.abs(F.col(f"res_pred_{f}") - F.coalesce(dot, F.lit(0.0))) < 1e-9)
    return r6(out.select("userId", "movieId", "rating_date", "res", known.alias("known"), exact.alias("exact"),
                         _sound(s).alias("certified")))


@register("join_factor_dot_values")
def join_factor_dot_values(spark, sf_dir):
    """Per cv row: residual and its rank-f reconstruction u . sigma . v."""
    s = sets(spark, sf_dir)
    return r6(FX.cv_residual_preds(s).select("userId", "movieId", "rating_date", "res",
                                             *[f"res_pred_{f}" for f in FX.SVD_RANKS]))


def _scored_rows(rel: str, model: str) -> str:
    return f"SELECT '{model}' AS model, count(*)::BIGINT AS n, 0::BIGINT AS n_missing, true AS in_range, true AS certified FROM {rel}"


@register("mdl_svd_predict", O.with_sets(_scored_rows("test_set", "bias_time_svd")))
def mdl_svd_predict(spark, sf_dir):
    """Check of the bias + time + SVD model on test_set: every row has a
    prediction in the rating range, on a sound fit."""
    s = sets(spark, sf_dir)
    return _checked(FX.svd_test_predictions(s), "pred", "bias_time_svd", _sound(s))


def _checked(rows, pred, model, sound):
    inside = (F.col(pred) >= 0.5) & (F.col(pred) <= 5.0)
    return rows.agg(F.lit(model).alias("model"), F.count(F.lit(1)).alias("n"), F.count_if(F.col(pred).isNull()).alias("n_missing"),
                    F.every(F.coalesce(inside, F.lit(False))).alias("in_range"), F.any_value(sound).alias("certified"))


@register("mdl_svd_rmse")
def mdl_svd_rmse(spark, sf_dir):
    """Bias + time + SVD model scored on test_set."""
    s = sets(spark, sf_dir)
    f = FX.best_rank(s)
    out = A.rmse(FX.svd_test_predictions(s, f))
    return r6(out.select(F.lit("bias_time_svd").alias("model"), F.lit(float(f)).alias("param"), "rmse", "n", "n_missing"))


@register("mdl_svd_train", O.with_sets(_scored_rows("training_set", "bias_time_svd_train")))
def mdl_svd_train(spark, sf_dir):
    """Check of the final SVD model on training_set itself."""
    s = sets(spark, sf_dir)
    return _checked(FX.svd_training_predictions(s), "final_pred", "bias_time_svd_train", _sound(s))


@register("mdl_svd_train_rmse")
def mdl_svd_train_rmse(spark, sf_dir):
    """RMSE of the final SVD model on training_set itself."""
    s = sets(spark, sf_dir)
    f = FX.best_rank(s)
    out = A.rmse(FX.svd_training_predictions(s, f), pred="final_pred")
    return r6(out.select(F.lit("bias_time_svd_train").alias("model"), F.lit(float(f)).alias("param"), "rmse", "n", "n_missing"))


@register("interact_view_final")
def interact_view_final(spark, sf_dir):
    """Residual view after the SVD model (rating - final_pred)."""
    s = sets(spark, sf_dir)
    tp = cut_lineage(FX.svd_training_predictions(s))  # read by both counts and for the rows
    cc = V.popular_active(tp, "movieId", "userId", MIN_ITEM, MIN_USER)
    sel = V.title_filter(cc, TITLES, PATTERNS).withColumn("res", F.col("rating") - F.col("final_pred"))
    return r6(V.pivot_wide(sel, "userId", "tidy_title", "res", COLUMNS, order_by=[ARRANGE_BY]))


# The largest relative residual of a user's normal equations that single
# precision factors leave.
STATIONARY = 1e-3

_FOLDS = f"""folds AS (
  SELECT userId, movieId, ('0x' || substr(md5('fold1|' || userId || '|' || movieId || '|' || round(rating * 1000000)::BIGINT), 1, 8))::BIGINT
         % {FX.MF_FOLDS} AS fold FROM training_set
), seen AS (
  SELECT f.fold, count(DISTINCT u.fold) AS other_users, count(DISTINCT i.fold) AS other_items, f.k
  FROM (SELECT *, row_number() OVER () AS k FROM folds) f
  LEFT JOIN (SELECT DISTINCT userId, fold FROM folds) u ON u.userId = f.userId AND u.fold <> f.fold
  LEFT JOIN (SELECT DISTINCT movieId, fold FROM folds) i ON i.movieId = f.movieId AND i.fold <> f.fold
  GROUP BY f.k, f.fold
)"""


@register("tune_mf", O.with_sets(f"""
SELECT unnest([{", ".join(map(str, FX.MF_RANKS))}])::INT AS rank, (SELECT count(*) FROM seen)::BIGINT AS n,
       (SELECT count(*) FROM seen WHERE other_users = 0 OR other_items = 0)::BIGINT AS n_missing, true AS scored, true AS stationary""",
    _FOLDS))
def tune_mf(spark, sf_dir):
    """Check of the ALS rank curve: rows scored over the hash folds, rows whose
    user or item is in no other fold, and whether the refitted model solves
    the normal equations of all users."""
    s = sets(spark, sf_dir)
    worst = FX.mf_stationarity(s).agg((F.max("gap") <= STATIONARY).alias("stationary"))
    return FX.mf_fit(s)[0].select("rank", "n", "n_missing", (F.col("rmse") > 0).alias("scored")).crossJoin(F.broadcast(worst))


@register("tune_mf_curve")
def tune_mf_curve(spark, sf_dir):
    """ALS rank in {10, 20}, L2 0.01, 5-fold CV RMSE (folds by hash)."""
    return r6(FX.mf_fit(sets(spark, sf_dir))[0].select("rank", "rmse"))


@register("mdl_mf", O.with_sets("SELECT userId, count(*)::BIGINT AS n, true AS stationary FROM training_set GROUP BY userId"))
def mdl_mf(spark, sf_dir):
    """Stationarity certificate of the tuned factorisation: for every user its
    ratings, and whether its factors solve (Q'Q + reg n I) p = Q'r."""
    return FX.mf_stationarity(sets(spark, sf_dir)).select("userId", "n", (F.col("gap") <= STATIONARY).alias("stationary"))


@register("mdl_mf_values")
def mdl_mf_values(spark, sf_dir):
    """Test-set predictions of the tuned factorisation (unclamped)."""
    return r6(FX.mf_test_predictions(sets(spark, sf_dir)))


@register("mdl_mf_predict", O.with_sets(
    "SELECT userId, movieId, rating_date, round(rating, 6) AS rating, true AS predicted, true AS exact FROM test_set"))
def mdl_mf_predict(spark, sf_dir):
    """Check of the predictions for test_set: every row has one, and it is the
    dot product of the model's factors of the row's ids."""
    s = sets(spark, sf_dir)
    _, model, umap, imap, _ = FX.mf_fit(s)
    side = lambda factors, ids, key, name: factors.join(ids, F.col("id") == F.col("_code")).select(key, F.col("features").alias(name))
    out = FX.mf_test_predictions(s).join(side(model.userFactors, umap, "userId", "p"), "userId", "left").join(
        side(model.itemFactors, imap, "movieId", "q"), "movieId", "left")
    dot = F.aggregate(F.zip_with("p", "q", lambda a, b: a.cast("double") * b), F.lit(0.0), lambda acc, x: acc + x)
    return r6(out.select("userId", "movieId", "rating_date", "rating", F.col("pred").isNotNull().alias("predicted"),
                         F.coalesce(F.abs(dot - F.col("pred")) < 1e-3, F.lit(False)).alias("exact")))


@register("mdl_mf_rmse")
def mdl_mf_rmse(spark, sf_dir):
    """RMSE of the tuned factorisation on test_set (unclamped)."""
    s = sets(spark, sf_dir)
    model = FX.mf_fit(s)[1]
    out = A.rmse(FX.mf_test_predictions(s))
    return r6(out.select(F.lit("mf").alias("model"), F.lit(float(model.rank)).alias("param"), "rmse", "n", "n_missing"))


@register("mdl_ladder_full")
def mdl_ladder_full(spark, sf_dir):
    """Every model's test RMSE in one table: the bias ladder, + SVD, and MF."""
    from ratingspark.plans.queries import QUERIES
    rows = [QUERIES["mdl_ladder"](spark, sf_dir).drop("below_goal"),
            mdl_svd_rmse(spark, sf_dir), mdl_mf_rmse(spark, sf_dir)]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.withColumn("below_goal", F.col("rmse") < F.lit(0.8649))
