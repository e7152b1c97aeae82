"""Exploratory queries: group means, summary table, histograms, QQ data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.functions.columns import normal_quantiles, ppoints
from ratingspark.operators import aggregates as A
from ratingspark.plans import oracle as O
from ratingspark.plans.queries import r6, register, sets

HIST_BINS_RATING = 10
HIST_BINS_MEANS = 50
QQ_POINTS = 100   # of the fixed-size variant

_MOVIE_MEANS = "(SELECT movieId, avg(rating) AS movie_avg_rating FROM training_set GROUP BY movieId)"
_USER_MEANS = "(SELECT userId, avg(rating) AS user_avg_rating FROM training_set GROUP BY userId)"


def _movie_means(s):
    return A.group_mean(s.training_set, "movieId", name="movie_avg_rating")


def _user_means(s):
    return A.group_mean(s.training_set, "userId", name="user_avg_rating")


@register("agg_group_mean", O.with_sets(
    "SELECT movieId, round(movie_avg_rating, 6) AS movie_avg_rating FROM " + _MOVIE_MEANS + " q"))
def agg_group_mean(spark, sf_dir):
    """Mean rating per movie."""
    return r6(_movie_means(sets(spark, sf_dir)))


@register("agg_group_mean_user", O.with_sets(
    "SELECT userId, round(user_avg_rating, 6) AS user_avg_rating FROM " + _USER_MEANS + " q"))
def agg_group_mean_user(spark, sf_dir):
    """Mean rating per user."""
    return r6(_user_means(sets(spark, sf_dir)))


@register("agg_count", O.with_sets(
    "SELECT movieId, count(*) AS n FROM training_set GROUP BY movieId"))
def agg_count(spark, sf_dir):
    """Group sizes n() per movie."""
    return sets(spark, sf_dir).training_set.groupBy("movieId").agg(F.count(F.lit(1)).alias("n"))


def _summary_sql(label: str, rel: str, col: str) -> str:
    return (f"SELECT '{label}' AS variable, round(CAST(min({col}) AS DOUBLE), 6) AS min, "
            f"round(quantile_cont({col}, 0.25), 6) AS q1, round(quantile_cont({col}, 0.5), 6) AS median, "
            f"round(avg({col}), 6) AS mean, round(quantile_cont({col}, 0.75), 6) AS q3, "
            f"round(CAST(max({col}) AS DOUBLE), 6) AS max FROM {rel} q")


@register("agg_summary", O.with_sets(
    _summary_sql("rating", "training_set", "rating") + " UNION ALL "
    + _summary_sql("movie_avg_rating", _MOVIE_MEANS, "movie_avg_rating") + " UNION ALL "
    + _summary_sql("user_avg_rating", _USER_MEANS, "user_avg_rating")))
def agg_summary(spark, sf_dir):
    """Min, Q1, median, mean, Q3, max of ratings, movie means and user means, stacked."""
    s = sets(spark, sf_dir)
    out = (A.summary_stats(s.training_set, "rating", "rating")
           .unionByName(A.summary_stats(_movie_means(s), "movie_avg_rating", "movie_avg_rating"))
           .unionByName(A.summary_stats(_user_means(s), "user_avg_rating", "user_avg_rating")))
    return r6(out)


def _hist_sql(rel: str, col: str, bins: int) -> str:
    e8 = O.dbl(1e-08)
    e10 = O.dbl(1e-10)
    return O.with_sets(f"""SELECT b.bin, round(p.origin + (b.bin - 1) * p.w, 6) AS xmin,
       round(p.origin + (b.bin - 1) * p.w + p.w, 6) AS xmax,
       round(p.origin + (b.bin - 1) * p.w + p.w / 2, 6) AS x,
       CAST(coalesce(c.cnt, 0) AS BIGINT) AS count
FROM (SELECT CAST(unnest(range(1, nb + 1)) AS INTEGER) AS bin FROM hp) b
CROSS JOIN hp p LEFT JOIN hc c ON c.bin = b.bin""", f"""hs AS (SELECT CAST(min({col}) AS DOUBLE) AS lo, CAST(max({col}) AS DOUBLE) AS hi FROM {rel} q),
ha AS (SELECT lo, hi, (hi - lo) / CAST({bins - 1} AS DOUBLE) AS w FROM hs),
hb AS (SELECT *, w / 2 + floor((lo - w / 2) / w) * w AS origin FROM ha),
hp AS (SELECT *, CAST(floor((hi + (1 - {e8}) * w - origin) / w + {e10}) AS INTEGER) AS nb FROM hb),
hc AS (SELECT least(greatest(CAST(ceil(({col} - p.origin - {e8} * p.w) / p.w) AS INTEGER), 1), p.nb) AS bin,
              count(*) AS cnt
       FROM {rel} q CROSS JOIN hp p GROUP BY 1)""")


@register("agg_hist", _hist_sql("training_set", "rating", HIST_BINS_RATING))
def agg_hist(spark, sf_dir):
    """Rating histogram, 10 centred right-closed bins, empty bins kept."""
    return r6(A.histogram(sets(spark, sf_dir).training_set, "rating", HIST_BINS_RATING))


@register("agg_hist_default", _hist_sql("training_set", "rating", 30))
def agg_hist_default(spark, sf_dir):
    """Rating histogram with the default 30 bins."""
    return r6(A.histogram(sets(spark, sf_dir).training_set, "rating"))


@register("agg_hist_movie", _hist_sql(_MOVIE_MEANS, "movie_avg_rating", HIST_BINS_MEANS))
def agg_hist_movie(spark, sf_dir):
    """Histogram of movie mean ratings, 50 centred right-closed bins."""
    return r6(A.histogram(_movie_means(sets(spark, sf_dir)), "movie_avg_rating", HIST_BINS_MEANS))


@register("agg_hist_user", _hist_sql(_USER_MEANS, "user_avg_rating", HIST_BINS_MEANS))
def agg_hist_user(spark, sf_dir):
    """Histogram of user mean ratings, 50 centred right-closed bins."""
    return r6(A.histogram(_user_means(sets(spark, sf_dir)), "user_avg_rating", HIST_BINS_MEANS))


def _qq_sql(rel: str, col: str, key: str) -> str:
    z25, z75 = normal_quantiles([0.25, 0.75])
    return O.with_sets(f"""SELECT {key}, i, round(p, 6) AS p, round({O.normal_quantile("p")}, 6) AS theoretical,
       round({col}, 6) AS sample, round((q75 - q25) / {O.dbl(z75 - z25)}, 6) AS slope,
       round(q25 - (q75 - q25) / {O.dbl(z75 - z25)} * {O.dbl(z25)}, 6) AS intercept
FROM qp""", f"""qs AS (SELECT quantile_cont({col}, 0.25) AS q25, quantile_cont({col}, 0.75) AS q75, count(*) AS n FROM {rel} q),
qp AS (SELECT r.*, qs.q25, qs.q75, (i - a) / (n + 1 - 2 * a) AS p
       FROM (SELECT {key}, {col}, row_number() OVER (ORDER BY {col}, {key}) AS i FROM {rel} q) r
       CROSS JOIN (SELECT *, CAST(CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END AS DOUBLE) AS a FROM qs) qs)""")


@register("agg_qq", _qq_sql(_MOVIE_MEANS, "movie_avg_rating", "movieId"))
def agg_qq(spark, sf_dir):
    """Normal QQ data of movie means, one point per movie."""
    return r6(A.qq_points(_movie_means(sets(spark, sf_dir)), "movie_avg_rating", "movieId"))


@register("agg_qq_user", _qq_sql(_USER_MEANS, "user_avg_rating", "userId"))
def agg_qq_user(spark, sf_dir):
    """Normal QQ data of user means, one point per user."""
    return r6(A.qq_points(_user_means(sets(spark, sf_dir)), "user_avg_rating", "userId"))


def _qq_grid_sql(rel: str, col: str, points: int = QQ_POINTS) -> str:
    probs = ppoints(points)
    theo = normal_quantiles(probs)
    z25, z75 = normal_quantiles([0.25, 0.75])
    vals = ", ".join(f"({i + 1}, {O.dbl(p)}, {O.dbl(t)})" for i, (p, t) in enumerate(zip(probs, theo)))
    plist = "[" + ", ".join(O.dbl(p) for p in probs) + "]"
    return O.with_sets(f"""SELECT g.i, round(g.p, 6) AS p, round(g.theoretical, 6) AS theoretical,
       round(qs.sq[g.i], 6) AS sample,
       round((qs.q75 - qs.q25) / {O.dbl(z75 - z25)}, 6) AS slope,
       round(qs.q25 - (qs.q75 - qs.q25) / {O.dbl(z75 - z25)} * {O.dbl(z25)}, 6) AS intercept
FROM (VALUES {vals}) AS g(i, p, theoretical) CROSS JOIN qs""", f"""qs AS (SELECT quantile_cont({col}, {plist}) AS sq,
              quantile_cont({col}, 0.25) AS q25, quantile_cont({col}, 0.75) AS q75 FROM {rel} q)""")


@register("agg_qq_grid", _qq_grid_sql(_MOVIE_MEANS, "movie_avg_rating"))
def agg_qq_grid(spark, sf_dir):
    """Normal QQ points of movie means on a grid of 100 plotting positions."""
    return r6(A.qq_grid(_movie_means(sets(spark, sf_dir)), "movie_avg_rating", QQ_POINTS))
