"""Queries for the bias models, their tuning curves and residual trends."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.operators.bias import single
from ratingspark.plans import models as M
from ratingspark.plans import oracle as O
from ratingspark.plans.queries import TIDY, r6, register, sets
from ratingspark.plans.sql_models import chain_ctes, chain_pred, curve_select, rmse_select, with_base

MU = M.MU_KEYS
TK = M.TIME_KEYS
ALL = M.ALL_KEYS


def _mu_chain_sql(p: str, lam: float, src: str = "training_set") -> str:
    """{p}_g0 (movie) and {p}_g1 (user) fitted on ``src`` with base mu."""
    return f"{p}_frame AS {with_base(src)},\n" + chain_ctes(p, [lam], MU, [f"{p}_frame", f"{p}_frame"])


def _scored(spark_pred, model: str, param: float):
    return r6(A.rmse(spark_pred).select(F.lit(model).alias("model"), F.lit(float(param)).alias("param"),
                                        "rmse", "n", "n_missing"))


# ---- global mean and naive model ------------------------------------------

@register("agg_mean", O.with_sets("SELECT round(mu, 6) AS mu FROM mu_t"))
def agg_mean(spark, sf_dir):
    """Global mean rating of training_set."""
    return r6(A.global_mean(sets(spark, sf_dir).training_set))


@register("mdl_naive", O.with_sets(
    "SELECT 'naive' AS model, CAST(NULL AS DOUBLE) AS param, "
    "round(sqrt(avg((t.rating - m.mu) * (t.rating - m.mu))), 6) AS rmse, count(*) AS n, "
    "CAST(0 AS BIGINT) AS n_missing FROM test_set t CROSS JOIN mu_t m"))
def mdl_naive(spark, sf_dir):
    """Predict the global mean everywhere, RMSE on test_set."""
    s = sets(spark, sf_dir)
    out = A.rmse(M.naive_predictions(s))
    return r6(out.select(F.lit("naive").alias("model"), F.lit(None).cast("double").alias("param"),
                         "rmse", "n", "n_missing"))


@register("prj_const", O.with_sets(
    "SELECT t.userId, t.movieId, t.rating, t.rating_date, round(m.mu, 6) AS global_mean "
    "FROM test_set t CROSS JOIN mu_t m"))
def prj_const(spark, sf_dir):
    """A repeated-scalar column (the mean folded in as a literal)."""
    s = sets(spark, sf_dir)
    return r6(s.test_set.select("userId", "movieId", "rating", "rating_date", F.lit(s.mu).alias("global_mean")))


# ---- movie + user bias ------------------------------------------------------

@register("agg_shrunk_mean", O.with_sets(
    "SELECT movieId, round(b, 6) AS movie_bias_reg FROM b_g0", _mu_chain_sql("b", M.LAMBDA_BIAS)))
def agg_shrunk_mean(spark, sf_dir):
    """b_i = sum(rating - mu) / (lambda + n) per movie on training_set."""
    s = sets(spark, sf_dir)
    return r6(single(M.movie_user_chain(s, M.LAMBDA_BIAS), 0, "movie_bias_reg"))


@register("agg_shrunk_chain", O.with_sets(
    "SELECT userId, round(b, 6) AS user_bias_reg FROM b_g1", _mu_chain_sql("b", M.LAMBDA_BIAS)))
def agg_shrunk_chain(spark, sf_dir):
    """b_u = sum(rating - mu - b_i) / (lambda + n) per user."""
    s = sets(spark, sf_dir)
    return r6(single(M.movie_user_chain(s, M.LAMBDA_BIAS), 1, "user_bias_reg"))


@register("mdl_bias", O.with_sets(
    rmse_select(chain_pred("b", MU, with_base("test_set"), False), "bias", M.LAMBDA_BIAS),
    _mu_chain_sql("b", M.LAMBDA_BIAS)))
def mdl_bias(spark, sf_dir):
    """Movie + user bias model (lambda 4.85), RMSE on test_set."""
    s = sets(spark, sf_dir)
    return _scored(M.bias_predictions(s, M.LAMBDA_BIAS, clamp=False), "bias", M.LAMBDA_BIAS)


@register("mdl_bias_clamped", O.with_sets(
    rmse_select(chain_pred("b", MU, with_base("test_set"), True), "bias_clamped", M.LAMBDA_BIAS_CLAMPED),
    _mu_chain_sql("b", M.LAMBDA_BIAS_CLAMPED)))
def mdl_bias_clamped(spark, sf_dir):
    """Movie + user bias model clamped to [0.5, 5] (lambda 4.55), RMSE on test_set."""
    s = sets(spark, sf_dir)
    return _scored(M.bias_predictions(s, M.LAMBDA_BIAS_CLAMPED, clamp=True), "bias_clamped", M.LAMBDA_BIAS_CLAMPED)


@register("join_left_bias", O.with_sets(
    "SELECT userId, movieId, rating, rating_date, round(pred, 6) AS pred FROM "
    + chain_pred("b", MU, with_base("test_set"), False), _mu_chain_sql("b", M.LAMBDA_BIAS)))
def join_left_bias(spark, sf_dir):
    """Per-row predictions mu + b_i + b_u on test_set (chained left joins)."""
    s = sets(spark, sf_dir)
    return r6(M.bias_predictions(s, M.LAMBDA_BIAS).select("userId", "movieId", "rating", "rating_date", "pred"))


@register("fn_clamp", O.with_sets(
    "SELECT userId, movieId, rating, rating_date, round(pred, 6) AS pred_adj FROM "
    + chain_pred("b", MU, with_base("test_set"), True), _mu_chain_sql("b", M.LAMBDA_BIAS)))
def fn_clamp(spark, sf_dir):
    """Predictions bounded to [0.5, 5]."""
    s = sets(spark, sf_dir)
    return r6(M.bias_predictions(s, M.LAMBDA_BIAS, clamp=True)
              .select("userId", "movieId", "rating", "rating_date", F.col("pred").alias("pred_adj")))


_EXTREME_SQL = O.with_sets(
    """SELECT e.userId, e.movieId, e.rating, e.tidy_title, round(e.pred, 6) AS rating_predicted,
       round(g0.b, 6) AS movie_bias_reg, round(g1.b, 6) AS user_bias_reg, round(m.mu, 6) AS global_mean, e.which
FROM ex e LEFT JOIN b_g0 g0 ON e.movieId = g0.movieId LEFT JOIN b_g1 g1 ON e.userId = g1.userId CROSS JOIN mu_t m""",
    _mu_chain_sql("b", M.LAMBDA_BIAS) + ",\npr AS " + chain_pred("b", MU, with_base("test_set"), False)
    + """,
ex AS ((SELECT *, 'min' AS which FROM pr WHERE pred IS NOT NULL
        ORDER BY pred ASC, userId, movieId, rating, rating_date LIMIT 1)
       UNION ALL
       (SELECT *, 'max' AS which FROM pr WHERE pred IS NOT NULL
        ORDER BY pred DESC, userId, movieId, rating, rating_date LIMIT 1))""")


def extreme_rows(s):
    """Lowest and highest unclamped prediction with biases and mu, unrounded."""
    chain = M.movie_user_chain(s, M.LAMBDA_BIAS)
    pred = M.bias_predictions(s, M.LAMBDA_BIAS)
    ex = A.extreme_rows(pred, "pred", ["userId", "movieId", "rating", "rating_date"])
    return (ex.join(single(chain, 0, "movie_bias_reg"), "movieId", "left")
              .join(single(chain, 1, "user_bias_reg"), "userId", "left")
              .select("userId", "movieId", "rating", "tidy_title", F.col("pred").alias("rating_predicted"),
                      "movie_bias_reg", "user_bias_reg", F.lit(s.mu).alias("global_mean"), "which"))


@register("agg_extreme_rows", _EXTREME_SQL)
def agg_extreme_rows(spark, sf_dir):
    """Lowest and highest unclamped prediction, explained by biases and mu."""
    return r6(extreme_rows(sets(spark, sf_dir)))


# ---- tuning curves ----------------------------------------------------------

def _grid_sql(p, grid, keys, frame_rel, score_rel, do_clamp, month=False):
    extra = (f"{p}_frame AS {with_base(frame_rel, month=month)},\n"
             + chain_ctes(p, grid, keys, [f"{p}_frame"] * len(keys)))
    return O.with_sets(curve_select(chain_pred(p, keys, with_base(score_rel, month=month), do_clamp)), extra)


@register("tune_bias", _grid_sql("g", M.GRID_BIAS, MU, "train_set", "cv_set", False))
def tune_bias(spark, sf_dir):
    """41 penalties in one job: (param, rmse, n, n_pred) on cv_set."""
    return r6(M.tune_bias_curve(sets(spark, sf_dir), clamp=False))


@register("tune_bias_clamped", _grid_sql("g", M.GRID_BIAS, MU, "train_set", "cv_set", True))
def tune_bias_clamped(spark, sf_dir):
    """41 penalties, clamped predictions, in one job: (param, rmse, n, n_pred) on cv_set."""
    return r6(M.tune_bias_curve(sets(spark, sf_dir), clamp=True))


@register("agg_argmin", O.with_sets(
    "SELECT param, round(r, 6) AS rmse, n, n_pred FROM (SELECT lam AS param, CASE WHEN count(pred) = count(*) "
    "THEN sqrt(sum((rating - pred) * (rating - pred)) / count(*)) END AS r, count(*) AS n, count(pred) AS n_pred "
    "FROM " + chain_pred("g", MU, with_base("cv_set"), True) + " q GROUP BY lam) c "
    "ORDER BY r ASC NULLS LAST, param ASC LIMIT 1",
    "g_frame AS " + with_base("train_set") + ",\n" + chain_ctes("g", M.GRID_BIAS, MU, ["g_frame", "g_frame"])))
def agg_argmin(spark, sf_dir):
    """First minimum of the clamped tuning curve (taken on unrounded RMSE;
    rounding is for display only)."""
    return r6(A.argmin(M.tune_bias_curve(sets(spark, sf_dir), clamp=True)))


def _time_sql_ctes(lam_b: float, train_rel: str, score_rel: str) -> str:
    return (_mu_chain_sql("b", lam_b) + f""",
tr AS (SELECT release_year, rating_month, rating, pred AS base
       FROM {chain_pred('b', MU, with_base(train_rel, month=True), True)} q),
cs AS (SELECT rating, release_year, rating_month, pred AS base
       FROM {chain_pred('b', MU, with_base(score_rel, month=True), False)} q)""")


@register("tune_time", O.with_sets(
    curve_select(chain_pred("t", TK, "cs", True)),
    _time_sql_ctes(M.LAMBDA_BIAS_CLAMPED, "train_set", "cv_set") + ",\n"
    + chain_ctes("t", M.GRID_TIME, TK, ["tr", "tr"])))
def tune_time(spark, sf_dir):
    """Release-year and rating-month penalties 12..14 on train_set residuals."""
    return r6(M.tune_time_curve(sets(spark, sf_dir)))


@register("mdl_time", O.with_sets(
    rmse_select(chain_pred("t", TK, "cs", True), "bias_time", M.LAMBDA_TIME),
    _time_sql_ctes(M.LAMBDA_BIAS_CLAMPED, "training_set", "test_set") + ",\n"
    + chain_ctes("t", [M.LAMBDA_TIME], TK, ["tr", "tr"])))
def mdl_time(spark, sf_dir):
    """Clamped baseline + release-year and rating-month biases (lambda_t 12.5), RMSE on test_set."""
    s = sets(spark, sf_dir)
    return _scored(M.time_predictions(s), "bias_time", M.LAMBDA_TIME)


@register("join_left_nullsafe", O.with_sets(
    "SELECT release_year, round(b, 6) AS releasey_bias_reg, n FROM t_g0",
    _time_sql_ctes(M.LAMBDA_BIAS_CLAMPED, "training_set", "test_set") + ",\n"
    + chain_ctes("t", [M.LAMBDA_TIME], TK, ["tr", "tr"])))
def join_left_nullsafe(spark, sf_dir):
    """Release-year bias table; the NULL year is a group and joins with <=>."""
    s = sets(spark, sf_dir)
    t = M.time_chain(s).tables[0]
    return r6(t.select("release_year", F.col("b_0").alias("releasey_bias_reg"), "n"))


@register("agg_shrunk_month", O.with_sets(
    "SELECT rating_month, round(b, 6) AS rm_bias_reg, n FROM t_g1",
    _time_sql_ctes(M.LAMBDA_BIAS_CLAMPED, "training_set", "test_set") + ",\n"
    + chain_ctes("t", [M.LAMBDA_TIME], TK, ["tr", "tr"])))
def agg_shrunk_month(spark, sf_dir):
    """Rating-month bias after the (null-safe joined) release-year bias."""
    s = sets(spark, sf_dir)
    t = M.time_chain(s).tables[1]
    return r6(t.select("rating_month", F.col("b_0").alias("rm_bias_reg"), "n"))


def _sym_ctes(p, lams, frames_rel):
    rels = []
    extra = []
    for i, rel in enumerate(frames_rel):
        extra.append(f"{p}_f{i} AS {with_base(rel, month=True)}")
        rels.append(f"{p}_f{i}")
    return ",\n".join(extra) + ",\n" + chain_ctes(p, lams, ALL, rels)


@register("tune_sym", O.with_sets(
    curve_select(chain_pred("s", ALL, with_base("cv_set", month=True), True)),
    _sym_ctes("s", M.GRID_BIAS, ["train_set"] * 4)))
def tune_sym(spark, sf_dir):
    """One penalty for all four biases, 41 values, one job."""
    return r6(M.tune_sym_curve(sets(spark, sf_dir)))


_SYM_FIT = _sym_ctes("s", [M.LAMBDA_SYM], ["training_set", "training_set", "train_set", "train_set"])


@register("mdl_sym", O.with_sets(
    rmse_select(chain_pred("s", ALL, with_base("test_set", month=True), True), "bias_time_sym", M.LAMBDA_SYM),
    _SYM_FIT))
def mdl_sym(spark, sf_dir):
    """One penalty (4.75) for movie, user, release-year and month biases, clamped, RMSE on test_set."""
    s = sets(spark, sf_dir)
    return _scored(M.sym_predictions(s), "bias_time_sym", M.LAMBDA_SYM)


def _apply_bt_sql(rel: str) -> str:
    return O.with_sets("SELECT " + ", ".join(TIDY) + ", rating_month, round(pred, 6) AS b_t_pred FROM "
                       + chain_pred("s", ALL, with_base(rel, month=True), True) + " q", _SYM_FIT)


def _apply_bt(s, df):
    return r6(M.with_bt(s, df).select(*TIDY, "rating_month", "b_t_pred"))


@register("apply_bt", _apply_bt_sql("train_set"))
def apply_bt(spark, sf_dir):
    """train_set_modified: + rating_month, + b_t_pred."""
    s = sets(spark, sf_dir)
    return _apply_bt(s, s.train_set)


@register("apply_bt_cv", _apply_bt_sql("cv_set"))
def apply_bt_cv(spark, sf_dir):
    """cv_set_modified: + rating_month, + b_t_pred."""
    s = sets(spark, sf_dir)
    return _apply_bt(s, s.cv_set)


@register("apply_bt_training", _apply_bt_sql("training_set"))
def apply_bt_training(spark, sf_dir):
    """training_set_modified: + rating_month, + b_t_pred."""
    s = sets(spark, sf_dir)
    return _apply_bt(s, s.training_set)


# ---- residual trends ----------------------------------------------------------

_BASE_SQL = (_mu_chain_sql("b", M.LAMBDA_BIAS_CLAMPED)
             + ",\ntt AS (SELECT * EXCLUDE (lam, base), pred AS baseline_pred FROM "
             + chain_pred("b", MU, with_base("training_set", month=True), True) + " q)")


@register("res_baseline", O.with_sets(
    "SELECT " + ", ".join(TIDY) + ", round(baseline_pred, 6) AS baseline_pred FROM tt", _BASE_SQL))
def res_baseline(spark, sf_dir):
    """training_temp: training_set + clamped baseline prediction."""
    s = sets(spark, sf_dir)
    return r6(M.with_baseline(s, s.training_set).select(*TIDY, "baseline_pred"))


@register("agg_resid_year", O.with_sets(
    "SELECT release_year, round(avg(rating - baseline_pred), 6) AS avg_res, count(*) AS n FROM tt GROUP BY release_year",
    _BASE_SQL))
def agg_resid_year(spark, sf_dir):
    """Mean residual of the clamped baseline per release year (NULL year is a group)."""
    s = sets(spark, sf_dir)
    base = M.with_baseline(s, s.training_set)
    return r6(A.mean_by(base, "release_year", F.col("rating") - F.col("baseline_pred")))


@register("agg_resid_month", O.with_sets(
    "SELECT rating_month, round(avg(rating - baseline_pred), 6) AS avg_res, count(*) AS n FROM tt GROUP BY rating_month",
    _BASE_SQL))
def agg_resid_month(spark, sf_dir):
    """Mean residual of the clamped baseline per rounded rating month."""
    s = sets(spark, sf_dir)
    base = M.with_month(M.with_baseline(s, s.training_set))
    return r6(A.mean_by(base, "rating_month", F.col("rating") - F.col("baseline_pred")))


def _limits_sql(key: str) -> str:
    return O.with_sets(
        f"SELECT {key}, round(avg_res, 6) AS avg_res, n FROM (SELECT {key}, avg(rating - baseline_pred) AS avg_res, "
        f"count(*) AS n FROM tt GROUP BY {key}) WHERE avg_res BETWEEN -0.06 AND 0.25", _BASE_SQL)


def _inside_limits(df, key):
    out = A.mean_by(df, key, F.col("rating") - F.col("baseline_pred"))
    return r6(out.filter(F.col("avg_res").between(-0.06, 0.25)))   # unrounded means


@register("flt_limits", _limits_sql("release_year"))
def flt_limits(spark, sf_dir):
    """Residual-by-year points inside the chart's axis range [-0.06, 0.25]."""
    s = sets(spark, sf_dir)
    return _inside_limits(M.with_baseline(s, s.training_set), "release_year")


@register("flt_limits_month", _limits_sql("rating_month"))
def flt_limits_month(spark, sf_dir):
    """Residual-by-month points inside the same axis range."""
    s = sets(spark, sf_dir)
    return _inside_limits(M.with_month(M.with_baseline(s, s.training_set)), "rating_month")


@register("fn_round_month", O.with_sets(
    f"SELECT rating_date, {O.round_month('rating_date')} AS rating_month, count(*) AS n "
    "FROM training_set GROUP BY rating_date"))
def fn_round_month(spark, sf_dir):
    """Nearest month start of every rating date (ties up)."""
    s = sets(spark, sf_dir)
    return M.with_month(s.training_set).groupBy("rating_date", "rating_month").agg(F.count(F.lit(1)).alias("n"))


# ---- the ladder -----------------------------------------------------------------

def ladder(s):
    """(model, param, rmse, n, n_missing) of every bias model, unrounded."""
    scored = [("naive", None, M.naive_predictions(s)),
              ("bias", M.LAMBDA_BIAS, M.bias_predictions(s, M.LAMBDA_BIAS)),
              ("bias_clamped", M.LAMBDA_BIAS_CLAMPED, M.bias_predictions(s, M.LAMBDA_BIAS_CLAMPED, clamp=True)),
              ("bias_time", M.LAMBDA_TIME, M.time_predictions(s)),
              ("bias_time_sym", M.LAMBDA_SYM, M.sym_predictions(s))]
    parts = [A.rmse(pred).select(F.lit(model).alias("model"), F.lit(param).cast("double").alias("param"),
                                 "rmse", "n", "n_missing") for model, param, pred in scored]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@register("mdl_ladder")
def mdl_ladder(spark, sf_dir):
    """model -> RMSE on test_set for every bias model, against the goal."""
    return r6(ladder(sets(spark, sf_dir)).withColumn("below_goal", F.col("rmse") < F.lit(0.8649)))
