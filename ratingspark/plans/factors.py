"""Latent-factor models on top of the bias ladder.

SVD: truncated SVD of the train_set residual matrix (rating - b_t_pred,
duplicate cells summed), tuned over f in {50, 55, 60} on cv_set residuals
from one fit at f = 60 (smaller f are prefixes of the same factors), then

    test:      clamp(mu + b_i + b_u + b_y + b_m + u_f . v_f)   (unclamped base)
    training:  clamp(b_t_pred + u_f . v_f)                     (clamped base)

MF: ALS on training_set (userId, movieId, rating), rank tuned over {10, 20}
by 5-fold cross-validation, L2 penalty 0.01; test predictions unclamped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.functions.columns import clamp
from ratingspark.operators.aggregates import argmin, sum_duplicates
from ratingspark.operators.mf import apply_ids, int_ids, restore_ids, row_fold, stationarity, tune_als
from ratingspark.operators.svd import Certificate, SVDFit, certify, factor_dot, truncated_svd
from ratingspark.plans import models as M
from ratingspark.plans.pipeline import RatingSets
from ratingspark.session import cut_lineage

# The factor counts tried by the analysis, and the MF grid.
SVD_RANKS = [50, 55, 60]
MF_RANKS = (10, 20)
MF_REG = 0.01
MF_FOLDS = 5


def residual_cells(s: RatingSets, lam: float = M.LAMBDA_SYM, on: str = "train") -> DataFrame:
    """(userId, movieId, res) with duplicate cells summed, of train_set (or,
    ``on='training'``, of training_set)."""
    rows = {"train": s.train_set, "training": s.training_set}[on]
    tm = M.with_bt(s, rows, lam).withColumn("res", F.col("rating") - F.col("b_t_pred"))
    return sum_duplicates(tm, ["userId", "movieId"], "res")


def svd_fit(s: RatingSets, rank: int = max(SVD_RANKS), lam: float = M.LAMBDA_SYM, on: str = "train") -> SVDFit:
    return M._memo(s, ("svd", rank, lam, on), lambda: truncated_svd(residual_cells(s, lam, on), rank))


def svd_certificate(s: RatingSets, rank: int = max(SVD_RANKS), lam: float = M.LAMBDA_SYM, on: str = "train") -> Certificate:
    return M._memo(s, ("svd_certificate", rank, lam, on), lambda: certify(svd_fit(s, rank, lam, on)))


def cv_residual_preds(s: RatingSets, ranks=SVD_RANKS, lam: float = M.LAMBDA_SYM) -> DataFrame:
    cv = M.with_bt(s, s.cv_set, lam).withColumn("res", F.col("rating") - F.col("b_t_pred"))
    return factor_dot(cv, svd_fit(s, max(ranks), lam), list(ranks))


def tune_svd_curve(s: RatingSets, ranks=SVD_RANKS, lam: float = M.LAMBDA_SYM) -> DataFrame:
    """(param = f, rmse of residual predictions on cv_set, unclamped), scored
    once per fit."""
    return M._memo(s, ("svd_curve", tuple(ranks), lam), lambda: cut_lineage(_svd_curve(s, ranks, lam)))


def _svd_curve(s: RatingSets, ranks, lam: float) -> DataFrame:
    pred = cv_residual_preds(s, ranks, lam)
    n = F.count(F.lit(1))
    aggs = []
    for f in ranks:
        e = F.col("res") - F.col(f"res_pred_{f}")
        aggs.append(F.struct(F.lit(float(f)).alias("param"), F.sqrt(F.avg(e * e)).alias("rmse"), n.alias("n")))
    return pred.agg(F.array(*aggs).alias("_c")).select(F.inline("_c"))


def best_rank(s: RatingSets, ranks=SVD_RANKS, lam: float = M.LAMBDA_SYM) -> int:
    return int(argmin(tune_svd_curve(s, ranks, lam)).first()["param"])


def svd_test_predictions(s: RatingSets, f: int | None = None, rank: int = max(SVD_RANKS), lam: float = M.LAMBDA_SYM,
                         on: str = "train", base: str = "raw") -> DataFrame:
    """clamp(four-bias sum + rank-f SVD residual) on test_set; the sum itself
    is unclamped (``base='clamped'``: clamped, as in training)."""
    f = f or best_rank(s, lam=lam)
    rows = M.sym_predictions(s, lam=lam, name="_base", clamp={"raw": False, "clamped": True}[base])
    out = factor_dot(rows, svd_fit(s, rank, lam, on), [f], prefix="res_pred_svd")
    return out.withColumn("pred", clamp(F.col("_base") + F.col("res_pred_svd"))).drop("_base")


def svd_training_predictions(s: RatingSets, f: int | None = None, rank: int = max(SVD_RANKS),
                             lam: float = M.LAMBDA_SYM, on: str = "train") -> DataFrame:
    """clamp(b_t_pred + rank-f SVD residual) on training_set."""
    f = f or best_rank(s, lam=lam)
    tm = M.with_bt(s, s.training_set, lam)
    out = factor_dot(tm, svd_fit(s, rank, lam, on), [f], prefix="res_pred")
    return out.withColumn("final_pred", clamp(F.col("b_t_pred") + F.col("res_pred")))


def mf_fit(s: RatingSets):
    """(curve, best model, user id map, item id map). Folds are dealt by the
    rows' own ids, before they are coded."""
    def build():
        train = s.training_set.select("userId", "movieId", "rating", row_fold(MF_FOLDS).alias("fold"))
        train, umap = int_ids(train, "userId")
        train, imap = int_ids(train, "movieId")
        train = cut_lineage(train)
        curve, model = tune_als(train, MF_RANKS, MF_REG, MF_FOLDS, fold_col="fold")
        return curve, model, umap, imap, train
    return M._memo(s, ("mf",), build)


def mf_stationarity(s: RatingSets) -> DataFrame:
    """(userId, n, gap): the normal equations of every user of the tuned model."""
    _, model, umap, _, train = mf_fit(s)
    gaps = M._memo(s, ("mf_gap",), lambda: cut_lineage(stationarity(model, train, MF_REG, "user")))
    return gaps.join(umap, F.col("id") == F.col("_code")).select("userId", "n", "gap")


def mf_test_predictions(s: RatingSets, clamped: bool = False) -> DataFrame:
    """ALS predictions for test_set, unclamped unless asked; NaN (unknown id)
    -> NULL."""
    _, model, umap, imap, _ = mf_fit(s)
    test = s.test_set.select("userId", "movieId", "rating", "rating_date")
    test = apply_ids(apply_ids(test, "userId", umap), "movieId", imap)
    scored = model.transform(test)
    scored = scored.withColumn("pred", F.when(~F.isnan("prediction"), F.col("prediction").cast("double")))
    if clamped:
        scored = scored.withColumn("pred", clamp("pred"))
    return restore_ids(scored.drop("prediction"), ["userId", "movieId"])
