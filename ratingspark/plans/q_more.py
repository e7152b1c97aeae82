"""Tuned end-to-end model, the model ladder with its oracle, scalar-function
queries, and inventory ids whose work another registered query already
does (registered under both names, same plan and oracle)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.functions.columns import epoch_to_date, release_year, tidy_title
from ratingspark.operators import aggregates as A
from ratingspark.plans import models as M
from ratingspark.plans import oracle as O
from ratingspark.plans.q_models import _SYM_FIT, _time_sql_ctes
from ratingspark.plans.queries import ORACLES, QUERIES, TIDY, r6, register, sets
from ratingspark.plans.sql_models import chain_ctes, chain_pred, rmse_raw, with_base

MU = M.MU_KEYS


def _raw_curve(pred_rel: str) -> str:
    return (f"SELECT lam AS param, CASE WHEN count(pred) = count(*) THEN "
            f"sqrt(sum((rating - pred) * (rating - pred)) / count(*)) END AS r FROM {pred_rel} q GROUP BY lam")


def _best(name: str, pred_rel: str) -> str:
    """CTE ``name``: the first minimum of a tuning curve."""
    return (f"{name} AS (SELECT param FROM ({_raw_curve(pred_rel)}) c ORDER BY r ASC NULLS LAST, param ASC LIMIT 1)")


def _lam(best: str) -> str:
    return f"SELECT param AS lam FROM {best}"


def _bias_best(p: str, best: str, clamp: bool) -> str:
    return ",\n".join([f"{p}_frame AS " + with_base("train_set"),
                       chain_ctes(p, M.GRID_BIAS, MU, [f"{p}_frame"] * 2),
                       _best(best, chain_pred(p, MU, with_base("cv_set"), clamp))])


def _tuned_bias_sql(model: str, clamp: bool) -> str:
    return O.with_sets(
        "SELECT model, param, round(r, 6) AS rmse, n, n_missing FROM ("
        + rmse_raw(chain_pred("f", MU, with_base("test_set"), clamp), model, "(SELECT param FROM best)") + ") x",
        ",\n".join([_bias_best("g", "best", clamp), "f_frame AS " + with_base("training_set"),
                    chain_ctes("f", None, MU, ["f_frame"] * 2, lam_sql=_lam("best"))]))


def _scored(pred, model, lam):
    return r6(A.rmse(pred).select(F.lit(model).alias("model"), F.lit(lam).alias("param"), "rmse", "n", "n_missing"))


@register("mdl_bias_tuned", _tuned_bias_sql("bias_clamped_tuned", True))
def mdl_bias_tuned(spark, sf_dir):
    """Tune lambda on train/cv (clamped), take the first minimum, refit on
    training_set, score the clamped model on test_set."""
    lam, pred = M.tuned_bias_predictions(sets(spark, sf_dir), clamp=True)
    return _scored(pred, "bias_clamped_tuned", lam)


@register("mdl_bias_tuned_raw", _tuned_bias_sql("bias_tuned", False))
def mdl_bias_tuned_raw(spark, sf_dir):
    """The same without clamping, tuned and scored."""
    lam, pred = M.tuned_bias_predictions(sets(spark, sf_dir), clamp=False)
    return _scored(pred, "bias_tuned", lam)


def _residual_base(name: str, rel: str, clamp: bool) -> str:
    return (f"{name} AS (SELECT release_year, rating_month, rating, pred AS base FROM "
            f"{chain_pred('b', MU, with_base(rel, month=True), clamp)} q)")


def _time_best_ctes(bias_from: str) -> str:
    """best_b, then best_t from a grid on residuals of the clamped baseline."""
    return ",\n".join([
        _bias_best("g", "best_b", True), "b_frame AS " + with_base(bias_from),
        chain_ctes("b", None, MU, ["b_frame"] * 2, lam_sql=_lam("best_b")),
        _residual_base("tr1", "train_set", True), _residual_base("cs1", "cv_set", False),
        chain_ctes("tg", M.GRID_TIME, M.TIME_KEYS, ["tr1"] * 2), _best("best_t", chain_pred("tg", M.TIME_KEYS, "cs1", True))])


@register("mdl_time_tuned", O.with_sets(
    "SELECT model, param, round(r, 6) AS rmse, n, n_missing FROM ("
    + rmse_raw(chain_pred("tf", M.TIME_KEYS, "cs2", True), "bias_time_tuned", "(SELECT param FROM best_t)") + ") x",
    ",\n".join([_time_best_ctes("training_set"),
                _residual_base("tr2", "training_set", True), _residual_base("cs2", "test_set", False),
                chain_ctes("tf", None, M.TIME_KEYS, ["tr2"] * 2, lam_sql=_lam("best_t"))])))
def mdl_time_tuned(spark, sf_dir):
    """Baseline and time penalties both tuned, refitted on training_set."""
    s = sets(spark, sf_dir)
    t = M.tuned(s)
    return _scored(M.time_predictions(s, t.bias_clamped, t.time), "bias_time_tuned", t.time)


@register("tune_time_from_train", O.with_sets(
    "SELECT param, round(r, 6) AS rmse FROM (" + _raw_curve(chain_pred("tg", M.TIME_KEYS, "cs1", True)) + ") c",
    _time_best_ctes("train_set")))
def tune_time_from_train(spark, sf_dir):
    """The time curve with movie/user biases from train_set only, at the
    tuned baseline penalty: cv_set stays unseen."""
    s = sets(spark, sf_dir)
    return r6(M.tune_time_curve(s, M.tuned(s).bias_clamped, bias_from="train").select("param", "rmse"))


def _sym_tuned_ctes(year_month_on: str = "train_set") -> str:
    frames = ["training_set", "training_set", year_month_on, year_month_on]
    return ",\n".join(
        ["sg_frame AS " + with_base("train_set", month=True), chain_ctes("sg", M.GRID_BIAS, M.ALL_KEYS, ["sg_frame"] * 4),
         _best("best_s", chain_pred("sg", M.ALL_KEYS, with_base("cv_set", month=True), True)),
         *[f"sf_f{i} AS {with_base(r, month=True)}" for i, r in enumerate(frames)],
         chain_ctes("sf", None, M.ALL_KEYS, [f"sf_f{i}" for i in range(4)], lam_sql=_lam("best_s"))])


def _sym_tuned_sql(model: str, year_month_on: str) -> str:
    return O.with_sets(
        "SELECT model, param, round(r, 6) AS rmse, n, n_missing FROM ("
        + rmse_raw(chain_pred("sf", M.ALL_KEYS, with_base("test_set", month=True), True), model,
                   "(SELECT param FROM best_s)") + ") x", _sym_tuned_ctes(year_month_on))


@register("mdl_sym_tuned", _sym_tuned_sql("bias_time_sym_tuned", "train_set"))
def mdl_sym_tuned(spark, sf_dir):
    """One tuned penalty for all four biases."""
    s = sets(spark, sf_dir)
    lam = M.tuned(s).sym
    return _scored(M.sym_predictions(s, lam=lam), "bias_time_sym_tuned", lam)


@register("mdl_sym_tuned_all", _sym_tuned_sql("bias_time_sym_all", "training_set"))
def mdl_sym_tuned_all(spark, sf_dir):
    """The same with year and month biases fitted on training_set too."""
    s = sets(spark, sf_dir)
    lam = M.tuned(s).sym
    return _scored(M.sym_predictions(s, lam=lam, year_month_on="training"), "bias_time_sym_all", lam)


@register("apply_bt_tuned", O.with_sets(
    "SELECT " + ", ".join(TIDY) + ", rating_month, round(pred, 6) AS b_t_pred FROM "
    + chain_pred("sf", M.ALL_KEYS, with_base("train_set", month=True), True) + " q", _sym_tuned_ctes()))
def apply_bt_tuned(spark, sf_dir):
    """train_set_modified with the tuned symmetric penalty."""
    s = sets(spark, sf_dir)
    return r6(M.with_bt(s, s.train_set, M.tuned(s).sym).select(*TIDY, "rating_month", "b_t_pred"))


_LADDER_CTES = ",\n".join([
    "b1_frame AS " + with_base("training_set"),
    chain_ctes("b1", [M.LAMBDA_BIAS], MU, ["b1_frame", "b1_frame"]),
    _time_sql_ctes(M.LAMBDA_BIAS_CLAMPED, "training_set", "test_set"),
    chain_ctes("t", [M.LAMBDA_TIME], M.TIME_KEYS, ["tr", "tr"]),
    _SYM_FIT,
])

_LADDER_ROWS = (
    "SELECT 'naive' AS model, CAST(NULL AS DOUBLE) AS param, sqrt(avg((t.rating - m.mu) * (t.rating - m.mu))) AS r, "
    "count(*) AS n, CAST(0 AS BIGINT) AS n_missing FROM test_set t CROSS JOIN mu_t m"
    + " UNION ALL " + rmse_raw(chain_pred("b1", MU, with_base("test_set"), False), "bias", repr(M.LAMBDA_BIAS))
    + " UNION ALL " + rmse_raw(chain_pred("b", MU, with_base("test_set"), True), "bias_clamped", repr(M.LAMBDA_BIAS_CLAMPED))
    + " UNION ALL " + rmse_raw(chain_pred("t", M.TIME_KEYS, "cs", True), "bias_time", repr(M.LAMBDA_TIME))
    + " UNION ALL " + rmse_raw(chain_pred("s", M.ALL_KEYS, with_base("test_set", month=True), True),
                               "bias_time_sym", repr(M.LAMBDA_SYM)))

_LADDER_SQL = O.with_sets(
    "SELECT model, param, round(r, 6) AS rmse, n, n_missing, r < 0.8649 AS below_goal FROM (" + _LADDER_ROWS + ") x",
    _LADDER_CTES)
ORACLES["mdl_ladder"] = _LADDER_SQL
ORACLES["snk_metric"] = O.with_sets(
    "SELECT 'ladder' AS run, model, param, round(r, 6) AS rmse, n, n_missing FROM (" + _LADDER_ROWS + ") x",
    _LADDER_CTES)


@register("fn_concat_msg", O.with_sets(
    "SELECT 'RMSE for ' || model || ' model is ' || CAST(round(r, 6) AS VARCHAR) AS message FROM ("
    + _LADDER_ROWS + ") x", _LADDER_CTES))
def fn_concat_msg(spark, sf_dir):
    """Labelled metric lines ("RMSE for <model> is <value>")."""
    lad = QUERIES["mdl_ladder"](spark, sf_dir)
    return lad.select(F.concat(F.lit("RMSE for "), F.col("model"), F.lit(" model is "),
                               F.col("rmse").cast("string")).alias("message"))


_TITLES_SQL = O.with_sets(
    "SELECT title, CASE WHEN regexp_matches(title, '\\(\\d{4}\\)') THEN regexp_replace(regexp_extract(title, "
    "'\\(\\d{4}\\)', 0), '[()]', '', 'g') END AS release_year, regexp_replace(regexp_replace(title, '\\(\\d{4}\\)', "
    "'', 'g'), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g') AS tidy_title, count(*) AS n FROM joined GROUP BY title")


@register("fn_year_extract", _TITLES_SQL)
def fn_year_extract(spark, sf_dir):
    """Release year (first "(dddd)", NULL when absent) and tidy title of
    every distinct title, with its rating count."""
    ml = sets(spark, sf_dir).joined
    return ml.groupBy("title").agg(F.count(F.lit(1)).alias("n")).select(
        "title", release_year("title").alias("release_year"), tidy_title("title").alias("tidy_title"), "n")


ORACLES["fn_title_tidy"] = _TITLES_SQL
QUERIES["fn_title_tidy"] = fn_year_extract


@register("fn_epoch_date", O.with_sets(
    'SELECT "timestamp", CAST(epoch_ms("timestamp" * 1000) AS DATE) AS rating_date FROM joined GROUP BY "timestamp"'))
def fn_epoch_date(spark, sf_dir):
    """Epoch seconds -> UTC calendar date for every distinct timestamp."""
    ml = sets(spark, sf_dir).joined
    return ml.select("timestamp").distinct().select("timestamp", epoch_to_date("timestamp").alias("rating_date"))


@register("prj_select", O.with_sets("SELECT userId, movieId, rating FROM training_set"))
def prj_select(spark, sf_dir):
    """Keep columns (userId, movieId, rating)."""
    return r6(sets(spark, sf_dir).training_set.select("userId", "movieId", "rating"))


@register("prj_pull", O.with_sets(
    "SELECT round(avg(rating), 6) AS movie_avg_rating FROM training_set GROUP BY movieId"))
def prj_pull(spark, sf_dir):
    """One column out (movie means), kept distributed."""
    return r6(A.group_mean(sets(spark, sf_dir).training_set, "movieId", name="movie_avg_rating")
              .select("movie_avg_rating"))


@register("prj_rename", O.with_sets("SELECT movieId, title, genres FROM movies"))
def prj_rename(spark, sf_dir):
    """Movie table with its fixed column names."""
    return sets(spark, sf_dir).movies.toDF("movieId", "title", "genres")


@register("prj_drop", O.with_sets(
    "SELECT * EXCLUDE (genres, rating_date, release_year, title_year) FROM (SELECT *, release_year AS title_year "
    "FROM training_set)"))
def prj_drop(spark, sf_dir):
    """Columns dropped by name; names that are not there are ignored."""
    df = sets(spark, sf_dir).training_set.withColumn("title_year", F.col("release_year"))
    return df.drop("genres", "rating_date", "release_year", "title_year", "no_such_column")


@register("fn_math", O.with_sets(
    "SELECT movieId, round(sqrt(avg(rating * rating)), 6) AS rms, round(avg(rating), 1) AS mean_1, "
    "CAST(floor(avg(rating)) AS BIGINT) AS low, CAST(ceil(avg(rating)) AS BIGINT) AS high, min(rating) AS least_rating, "
    "max(rating) AS most_rating, round(abs(min(rating) - max(rating)) / 2, 6) AS half_range, "
    "round(exp(avg(ln(rating))), 6) AS geo_mean FROM training_set GROUP BY movieId"))
def fn_math(spark, sf_dir):
    """sqrt, square, round, floor, ceiling, min, max, abs, exp and log per movie."""
    mean = F.avg("rating")
    return sets(spark, sf_dir).training_set.groupBy("movieId").agg(
        F.round(F.sqrt(F.avg(F.col("rating") * F.col("rating"))), 6).alias("rms"), F.round(mean, 1).alias("mean_1"),
        F.floor(mean).alias("low"), F.ceil(mean).alias("high"), F.min("rating").alias("least_rating"),
        F.max("rating").alias("most_rating"),
        F.round(F.abs(F.min("rating") - F.max("rating")) / 2, 6).alias("half_range"),
        F.round(F.exp(F.avg(F.ln("rating"))), 6).alias("geo_mean"))


# ids whose work another query does: same plan, same oracle
ALIASES = {
    "prj_mutate": "tidy_training_set",  # derived columns
    "prj_cbind": "join_left_bias",     # prediction attached by key, not position
    "agg_rmse": "mdl_bias",
    "top_1": "agg_argmin",
    "fn_split_n": "src_movies",
    "fn_cast": "src_movies",
    "fn_residual": "agg_dup_sum",
    "fn_seq": "tune_bias",
    "fn_regex_like": "flt_eq_or",
    "fn_is_na": "fill_na_zero",
    "src_pred": "snk_pred",
}
for _alias, _src in ALIASES.items():
    QUERIES[_alias] = QUERIES[_src]
    if _src in ORACLES:
        ORACLES[_alias] = ORACLES[_src]
