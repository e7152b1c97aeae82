"""The model ladder on the rating sets: naive mean, movie + user bias
(raw and clamped), + release-year and rating-month bias, the symmetric
four-bias model, and b_t_pred for later factor models.

Penalties default to the values the analysis selected on its data; every
function also takes them as arguments, and ``tuned`` picks all of them from
their grids (first minima), as is right for other data.

Which training set fits which stage follows the analysis by default:

* ``mu`` is the mean of training_set, also while tuning on train_set;
* the time grid uses movie/user biases fitted on training_set
  (``bias_from='train'``: on train_set, so cv_set stays unseen);
* the final symmetric model fits movie/user on training_set and year/month
  on train_set (``year_month_on='training'``: all on training_set).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.functions.columns import param_grid, round_month
from ratingspark.operators.aggregates import argmin
from ratingspark.operators.bias import GRID_CHUNK, BiasChain, fit_chain, predict_chain, prefix_chain, score_chain, tune_chain
from ratingspark.plans.pipeline import RatingSets
from ratingspark.session import cut_lineage

# The penalties the analysis selected and its tuning grids.
LAMBDA_BIAS = 4.85
LAMBDA_BIAS_CLAMPED = 4.55
LAMBDA_TIME = 12.5
LAMBDA_SYM = 4.75
GRID_BIAS = param_grid(4.0, 6.0, 0.05)
GRID_TIME = param_grid(12.0, 14.0, 0.05)

MU_KEYS = ["movieId", "userId"]
TIME_KEYS = ["release_year", "rating_month"]
ALL_KEYS = MU_KEYS + TIME_KEYS


def with_month(df: DataFrame) -> DataFrame:
    return df.withColumn("rating_month", round_month("rating_date"))


def _memo(s: RatingSets, key, build):
    memo = s.__dict__.setdefault("_memo", {})
    if key not in memo:
        memo[key] = build()
    return memo[key]


def movie_user_chain(s: RatingSets, lam: float, on: str = "training") -> BiasChain:
    """b_i then b_u at one penalty, fitted on training_set (or train_set)."""
    return _memo(s, ("mu_chain", lam, on), lambda: fit_chain(_set(s, on), MU_KEYS, [lam], base=s.mu))


def _set(s: RatingSets, on: str) -> DataFrame:
    return {"training": s.training_set, "train": s.train_set}[on]


def predict(df: DataFrame, chain: BiasChain, base, name: str = "pred", clamp: bool = False) -> DataFrame:
    out = predict_chain(df, chain, base=base, prefix="_p", clamp=clamp)
    return out.withColumnRenamed("_p0", name)


def naive_predictions(s: RatingSets) -> DataFrame:
    return s.test_set.withColumn("pred", F.lit(s.mu))


def bias_predictions(s: RatingSets, lam: float = LAMBDA_BIAS, clamp: bool = False) -> DataFrame:
    return predict(s.test_set, movie_user_chain(s, lam), s.mu, clamp=clamp)


def with_baseline(s: RatingSets, df: DataFrame, lam_b: float = LAMBDA_BIAS_CLAMPED) -> DataFrame:
    """df + baseline_pred = clamp(mu + b_i + b_u)."""
    return predict(df, movie_user_chain(s, lam_b), s.mu, name="baseline_pred", clamp=True)


def _residual_rows(df: DataFrame) -> DataFrame:
    """What the time stages read of rows with a baseline, written once: each
    stage would do the joins of the baseline again."""
    return cut_lineage(with_month(df).select(*TIME_KEYS, "rating", "baseline_pred"))


def time_chain(s: RatingSets, lam_b: float = LAMBDA_BIAS_CLAMPED, lam_t: float = LAMBDA_TIME) -> BiasChain:
    """Release-year then rating-month bias of the clamped-baseline residual,
    fitted on training_set."""
    def build():
        frame = _residual_rows(with_baseline(s, s.training_set, lam_b))
        return fit_chain(frame, TIME_KEYS, [lam_t], base="baseline_pred")
    return _memo(s, ("time_chain", lam_b, lam_t), build)


def time_predictions(s: RatingSets, lam_b: float = LAMBDA_BIAS_CLAMPED, lam_t: float = LAMBDA_TIME) -> DataFrame:
    df = with_month(s.test_set)
    df = predict(df, movie_user_chain(s, lam_b), s.mu, name="_mu_pred")
    return predict(df, time_chain(s, lam_b, lam_t), "_mu_pred", clamp=True).drop("_mu_pred")


def sym_chain(s: RatingSets, lam: float = LAMBDA_SYM, year_month_on: str = "train") -> BiasChain:
    def build():
        tm = with_month(s.training_set)
        ym = with_month(s.train_set) if year_month_on == "train" else tm
        return fit_chain([tm, tm, ym, ym], ALL_KEYS, [lam], base=s.mu)
    return _memo(s, ("sym_chain", lam, year_month_on), build)


def sym_predictions(s: RatingSets, df: DataFrame | None = None, lam: float = LAMBDA_SYM,
                    name: str = "pred", year_month_on: str = "train", clamp: bool = True) -> DataFrame:
    df = with_month(s.test_set if df is None else df)
    return predict(df, sym_chain(s, lam, year_month_on), s.mu, name=name, clamp=clamp)


def with_bt(s: RatingSets, df: DataFrame, lam: float = LAMBDA_SYM, year_month_on: str = "train") -> DataFrame:
    """The analysis' "modified" sets: + rating_month, + b_t_pred (clamped
    four-bias prediction)."""
    return sym_predictions(s, df, lam, name="b_t_pred", year_month_on=year_month_on)


# ---- tuning curves (one Spark job per grid) ---------------------------------

def _grid_chain(s: RatingSets, keys: list[str], grid) -> BiasChain:
    """The chain of a grid on train_set, fitted once; the movie and user stages
    of the four-bias chain are those of the two-bias chain."""
    longer = s.__dict__.get("_memo", {}).get(("grid_chain", tuple(ALL_KEYS), tuple(grid)))
    if longer is not None and keys == MU_KEYS:
        return prefix_chain(longer, len(keys))
    return _memo(s, ("grid_chain", tuple(keys), tuple(grid)),
                 lambda: fit_chain(with_month(s.train_set), keys, grid, base=s.mu))


def tune_bias_curve(s: RatingSets, grid=GRID_BIAS, clamp: bool = False) -> DataFrame:
    if len(grid) > GRID_CHUNK:
        return tune_chain(s.train_set, s.cv_set, MU_KEYS, grid, train_base=s.mu, score_base=s.mu, clamp=clamp)
    return score_chain(s.cv_set, _grid_chain(s, MU_KEYS, grid), s.mu, clamp)


def tune_time_curve(s: RatingSets, lam_b: float = LAMBDA_BIAS_CLAMPED, grid=GRID_TIME,
                    bias_from: str = "training") -> DataFrame:
    """Year/month grid on train_set residuals of the clamped baseline whose
    movie/user biases come from ``bias_from``; scored on cv_set."""
    chain = movie_user_chain(s, lam_b, bias_from)
    train = _residual_rows(predict(s.train_set, chain, s.mu, name="baseline_pred", clamp=True))
    score = with_month(predict(s.cv_set, chain, s.mu, name="_mu_pred"))
    return tune_chain(train, score, TIME_KEYS, grid, train_base="baseline_pred", score_base="_mu_pred", clamp=True)


def tune_sym_curve(s: RatingSets, grid=GRID_BIAS) -> DataFrame:
    score = with_month(s.cv_set)
    if len(grid) > GRID_CHUNK:
        return tune_chain(with_month(s.train_set), score, ALL_KEYS, grid, train_base=s.mu, score_base=s.mu, clamp=True)
    return score_chain(score, _grid_chain(s, ALL_KEYS, grid), s.mu, clamp=True)


def best_param(curve: DataFrame) -> float:
    """First minimum of a tuning curve (a single scalar to the driver)."""
    return float(argmin(curve).first()["param"])


@dataclass(frozen=True)
class Penalties:
    bias: float
    bias_clamped: float
    time: float
    sym: float


def tuned(s: RatingSets, bias_from: str = "training") -> Penalties:
    """The first minimum of every model's curve on these sets (the four-bias
    grid first: the two-bias curves are scored on its first stages)."""
    def build():
        sym = best_param(tune_sym_curve(s))
        clamped = best_param(tune_bias_curve(s, clamp=True))
        return Penalties(best_param(tune_bias_curve(s)), clamped,
                         best_param(tune_time_curve(s, clamped, bias_from=bias_from)), sym)
    return _memo(s, ("tuned", bias_from), build)


def tuned_bias_predictions(s: RatingSets, clamp: bool = True) -> tuple[float, DataFrame]:
    lam = best_param(tune_bias_curve(s, clamp=clamp))
    return lam, bias_predictions(s, lam, clamp=clamp)
