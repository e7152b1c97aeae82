"""Queries for sources and sinks: each writes data Spark derived from the
given tables into a fresh folder under the shared checkpoint folder and
reads it back through the reader under test."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.plans import models as M
from ratingspark.plans import oracle as O
from ratingspark.plans.q_models import _mu_chain_sql
from ratingspark.plans.queries import ORACLES, TIDY, r6, register, sets
from ratingspark.plans.sql_models import chain_ctes, chain_pred, rmse_raw, with_base
from ratingspark.sources import files as IO
from ratingspark.sources.fixtures import ratings_from_events

_RATINGS_SQL = O.with_sets('SELECT userId, movieId, rating, "timestamp" FROM ratings')


@register("src_ratings", _RATINGS_SQL)
def src_ratings(spark, sf_dir):
    """Ratings written as userId::movieId::rating::timestamp and scanned back."""
    path = IO.scratch_path(spark, "ratings")
    IO.write_ratings_dat(sets(spark, sf_dir).ratings, path)
    return r6(IO.read_ratings_dat(spark, path))


@register("fn_gsub", _RATINGS_SQL)
def fn_gsub(spark, sf_dir):
    """The same file read as text with '::' replaced by a tab, then split."""
    path = IO.scratch_path(spark, "ratings-tab")
    IO.write_ratings_dat(sets(spark, sf_dir).ratings, path)
    return r6(IO.read_ratings_dat_via_tab(spark, path))


@register("src_movies", O.with_sets("SELECT movieId, title, genres FROM movies"))
def src_movies(spark, sf_dir):
    """Movies written as movieId::title::genres and split into 3 fields."""
    path = IO.scratch_path(spark, "movies")
    IO.write_movies_dat(sets(spark, sf_dir).movies, path)
    return IO.read_movies_dat(spark, path)


@register("snk_table", O.with_sets("SELECT " + ", ".join(TIDY) + " FROM training_set"))
def snk_table(spark, sf_dir):
    """training_set persisted as parquet and reloaded."""
    path = IO.scratch_path(spark, "table")
    IO.write_table(sets(spark, sf_dir).training_set, path)
    return r6(IO.read_table(spark, path))


@register("src_table", O.with_sets("SELECT " + ", ".join(TIDY) + " FROM test_set"))
def src_table(spark, sf_dir):
    """test_set persisted as parquet and reloaded."""
    path = IO.scratch_path(spark, "table")
    IO.write_table(sets(spark, sf_dir).test_set, path)
    return r6(IO.read_table(spark, path))


@register("snk_triplets", O.with_sets("SELECT userId, movieId, rating FROM training_set"))
def snk_triplets(spark, sf_dir):
    """Space-separated, header-less userId movieId rating export."""
    path = IO.scratch_path(spark, "triplets")
    IO.write_triplets(sets(spark, sf_dir).training_set, path)
    return r6(IO.read_triplets(spark, path))


@register("snk_pred", O.with_sets(
    "SELECT userId, movieId, round(pred, 6) AS pred FROM " + chain_pred("b", M.MU_KEYS, with_base("test_set"), False) + " q",
    _mu_chain_sql("b", M.LAMBDA_BIAS)))
def snk_pred(spark, sf_dir):
    """Predictions written keyed by (user, movie) and read back as numbers."""
    s = sets(spark, sf_dir)
    path = IO.scratch_path(spark, "pred")
    IO.write_predictions(M.bias_predictions(s, M.LAMBDA_BIAS), path)
    return r6(IO.read_predictions(spark, path))


@register("snk_metric")
def snk_metric(spark, sf_dir):
    """Model RMSE rows appended to a metrics table at full precision, read
    back (rounded only here, for the comparison)."""
    from ratingspark.plans.q_models import ladder
    path = IO.scratch_path(spark, "metrics")
    IO.append_metrics(ladder(sets(spark, sf_dir)), path, run="ladder")
    return r6(IO.read_metrics(spark, path))


def _stored(spark, df, name):
    path = IO.scratch_path(spark, name)
    IO.write_table(df, path)
    return IO.read_table(spark, path)


@register("snk_curve", ORACLES["tune_bias_clamped"])
def snk_curve(spark, sf_dir):
    """A tuning curve stored at full precision and read back."""
    return r6(_stored(spark, M.tune_bias_curve(sets(spark, sf_dir), clamp=True), "curve"))


@register("snk_extreme", ORACLES["agg_extreme_rows"])
def snk_extreme(spark, sf_dir):
    """The rows with the lowest and highest prediction, stored and read back."""
    from ratingspark.plans.q_models import extreme_rows
    return r6(_stored(spark, extreme_rows(sets(spark, sf_dir)), "extreme"))


@register("snk_pairs", O.with_sets("SELECT userId, movieId FROM test_set"))
def snk_pairs(spark, sf_dir):
    """Space-separated, header-less export of the user / movie pairs to score."""
    path = IO.scratch_path(spark, "pairs")
    IO.write_triplets(sets(spark, sf_dir).test_set, path, cols=("userId", "movieId"))
    return IO.read_triplets(spark, path, "userId BIGINT, movieId BIGINT")


@register("src_events", O.with_sets('SELECT userId, movieId, rating, "timestamp" FROM skewed', O.EVENTS))
def src_events(spark, sf_dir):
    """Skewed interactions adapter (events: item from JSON, rating from value)."""
    return r6(ratings_from_events(spark, sf_dir))


@register("agg_dup_sum_skewed", O.with_sets(
    "SELECT userId, movieId, round(sum(rating), 6) AS rating, count(*) AS n FROM skewed GROUP BY userId, movieId",
    O.EVENTS))
def agg_dup_sum_skewed(spark, sf_dir):
    """Duplicate (user, item) cells of the skewed table summed."""
    e = ratings_from_events(spark, sf_dir)
    return r6(e.groupBy("userId", "movieId").agg(F.sum("rating").alias("rating"), F.count(F.lit(1)).alias("n")))


_SKEW_CTES = (O.EVENTS + ",\nsk_mu AS (SELECT avg(rating) AS mu FROM skewed),\n"
              "sk_frame AS (SELECT s.*, m.mu AS base FROM skewed s CROSS JOIN sk_mu m),\n"
              + chain_ctes("k", [M.LAMBDA_BIAS_CLAMPED], M.MU_KEYS, ["sk_frame", "sk_frame"]))


@register("mdl_bias_skewed", O.with_sets(
    "SELECT model, param, round(r, 6) AS rmse, n, n_missing FROM ("
    + rmse_raw(chain_pred("k", M.MU_KEYS, "sk_frame", True), "bias_clamped_skewed", repr(M.LAMBDA_BIAS_CLAMPED))
    + ") x", _SKEW_CTES))
def mdl_bias_skewed(spark, sf_dir):
    """Clamped movie + user bias fitted and scored on the skewed events table
    (100 items, dense user x item, many duplicate cells)."""
    from ratingspark.operators import aggregates as A
    from ratingspark.operators.bias import fit_chain, predict_chain
    e = ratings_from_events(spark, sf_dir)
    mu = A.mean_value(e)
    chain = fit_chain(e, M.MU_KEYS, [M.LAMBDA_BIAS_CLAMPED], base=mu)
    pred = predict_chain(e, chain, base=mu, prefix="_p", clamp=True).withColumnRenamed("_p0", "pred")
    out = A.rmse(pred)
    return r6(out.select(F.lit("bias_clamped_skewed").alias("model"), F.lit(M.LAMBDA_BIAS_CLAMPED).alias("param"),
                         "rmse", "n", "n_missing"))
