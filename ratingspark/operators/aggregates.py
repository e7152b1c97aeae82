"""Aggregates: global/group means, strict RMSE, argmin of a curve, summary
statistics, histogram and QQ data, residual trends, duplicate-cell sums.

Every function returns a DataFrame; the few scalars a function needs
(min/max of a histogram range) come back as one small row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingspark.functions.columns import normal_quantile, normal_quantiles, ppoints
from ratingspark.operators.order_stats import quantiles, with_position


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def global_mean(df: DataFrame, col: str = "rating", name: str = "mu") -> DataFrame:
    return df.agg(F.avg(col).alias(name))


def mean_value(df: DataFrame, col: str = "rating") -> float:
    """The global mean as a driver scalar (one number; Catalyst then folds
    it as a literal into every later expression)."""
    return float(df.agg(F.avg(col)).first()[0])


def group_mean(df: DataFrame, key: str, col: str = "rating", name: str | None = None) -> DataFrame:
    return df.groupBy(key).agg(F.avg(col).alias(name or f"avg_{col}"))


def shrunk_mean(df: DataFrame, key: str, value, lam: float, name: str = "bias") -> DataFrame:
    """sum(value) / (lam + n) per key: partial + final hash aggregate."""
    return (df.groupBy(key).agg(F.sum(_c(value)).alias("_s"), F.count(F.lit(1)).alias("_n"))
            .select(key, (F.col("_s") / (F.lit(float(lam)) + F.col("_n"))).alias(name)))


def rmse(df: DataFrame, rating: str = "rating", pred: str = "pred", name: str = "rmse") -> DataFrame:
    """sqrt(mean((rating - pred)^2)); NULL if any prediction is NULL.
    Also returns n and n_missing so a NULL is explained."""
    e = F.col(rating) - F.col(pred)
    return df.agg(
        F.when(F.count(F.col(pred)) == F.count(F.lit(1)), F.sqrt(F.avg(e * e))).alias(name),
        F.count(F.lit(1)).alias("n"),
        (F.count(F.lit(1)) - F.count(F.col(pred))).alias("n_missing"),
    )


def argmin(curve: DataFrame, value: str = "rmse", param: str = "param") -> DataFrame:
    """First minimum: lowest value, ties to the smallest parameter; NULL
    values never win (they sort last)."""
    return curve.orderBy(F.col(value).asc_nulls_last(), F.col(param).asc()).limit(1)


def summary_stats(df: DataFrame, col: str, label: str) -> DataFrame:
    """Min, first quartile, median, mean, third quartile, max (quartiles by
    linear interpolation between exact order statistics)."""
    q1, median, q3 = (F.lit(q).cast("double") for q in quantiles(df, col, [0.25, 0.5, 0.75]))
    return df.agg(
        F.lit(label).alias("variable"),
        F.min(col).cast("double").alias("min"),
        F.avg(col).alias("mean"),
        F.max(col).cast("double").alias("max"),
    ).select("variable", "min", q1.alias("q1"), median.alias("median"), "mean", q3.alias("q3"), "max")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Counts in ``bins`` equal-width, right-closed bins whose width is
    range / (bins - 1) and which have a boundary at width / 2 (the centred
    binning of the plots this data feeds). Empty bins are kept with count 0.

    Returns (bin, xmin, xmax, x, count). The bin index of a row is
    ceil((x - origin) / width) with a relative fuzz of 1e-8 so values on a
    boundary fall in the lower bin; the first bin also holds the origin.
    """
    stats = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi")).first()
    lo, hi = float(stats["lo"]), float(stats["hi"])
    if bins <= 1 or hi == lo:
        width = (hi - lo) if hi > lo else 1.0
        origin = lo - width / 2 if hi == lo else lo
        nbins = 1
    else:
        width = (hi - lo) / (bins - 1)
        boundary = width / 2
        shift = math.floor((lo - boundary) / width)
        origin = boundary + shift * width
        max_x = hi + (1 - 1e-08) * width
        nbins = int(math.floor((max_x - origin) / width + 1e-10))
    fuzz = 1e-08 * width
    idx = F.ceil((F.col(col) - F.lit(origin) - F.lit(fuzz)) / F.lit(width)).cast("int")
    idx = F.least(F.greatest(idx, F.lit(1)), F.lit(nbins))
    counts = df.select(idx.alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    spark = df.sparkSession
    grid = spark.range(1, nbins + 1).select(F.col("id").cast("int").alias("bin"))
    out = grid.join(F.broadcast(counts), "bin", "left").fillna(0, ["count"])
    xmin = F.lit(origin) + (F.col("bin") - 1) * F.lit(width)
    return out.select("bin", xmin.alias("xmin"), (xmin + F.lit(width)).alias("xmax"),
                      (xmin + F.lit(width / 2)).alias("x"), F.col("count").cast("bigint").alias("count"))


def qq_line(q25: float, q75: float) -> tuple[float, float]:
    """Slope and intercept of the line through the quartiles."""
    z25, z75 = normal_quantiles([0.25, 0.75])
    slope = (q75 - q25) / (z75 - z25)
    return slope, q25 - slope * z25


def qq_points(df: DataFrame, col: str, key: str) -> DataFrame:
    """Normal QQ data, one point per row: the i-th smallest value (ties by
    ``key``) against the standard normal quantile of its plotting position,
    with the line through the quartiles."""
    values = df.where(F.col(col).isNotNull()).select(F.col(col).alias("sample"), F.col(key))
    slope, intercept = (F.lit(x) for x in qq_line(*quantiles(values, "sample", [0.25, 0.75])))
    ranked = with_position(values, ["sample", key], "i")
    n = ranked.count()
    a = 0.375 if n <= 10 else 0.5
    p = (F.col("i") - a) / F.lit(n + 1 - 2 * a)
    return ranked.select(key, "i", p.alias("p"), normal_quantile(p).alias("theoretical"), "sample",
                         slope.alias("slope"), intercept.alias("intercept"))


def qq_grid(df: DataFrame, col: str, points: int) -> DataFrame:
    """The same on a grid of ``points`` plotting positions: sample quantiles
    against normal quantiles, for a plot of fixed size."""
    probs = ppoints(points)
    sample = quantiles(df, col, probs)
    slope, intercept = qq_line(*quantiles(df, col, [0.25, 0.75]))
    rows = [(i + 1, float(p), float(t), q, slope, intercept)
            for i, (p, t, q) in enumerate(zip(probs, normal_quantiles(probs), sample))]
    return df.sparkSession.createDataFrame(
        rows, "i int, p double, theoretical double, sample double, slope double, intercept double")


def mean_by(df: DataFrame, key: str, value, name: str = "avg_res") -> DataFrame:
    """Mean of ``value`` per key; a NULL key is its own group."""
    return df.groupBy(key).agg(F.avg(_c(value)).alias(name), F.count(F.lit(1)).alias("n"))


def sum_duplicates(df: DataFrame, keys: list[str], value: str, name: str | None = None) -> DataFrame:
    """One cell per key tuple: duplicate cells are summed (sparse-matrix
    assembly semantics)."""
    return df.groupBy(*keys).agg(F.sum(value).alias(name or value))


def range_legend(cells: DataFrame, value: str, n: int = 9, digits: int = 1) -> DataFrame:
    """min and max of the cells and ``n`` equally spaced values between them
    rounded to ``digits`` decimals: rows (k, level, min, max)."""
    agg = cells.agg(F.min(value).cast("double").alias("min"), F.max(value).cast("double").alias("max"))
    step = (F.col("max") - F.col("min")) / F.lit(n - 1)
    ks = F.array(*[F.lit(k) for k in range(1, n + 1)])
    return (agg.select(F.explode(ks).alias("k"), "min", "max")
            .select("k", F.round(F.col("min") + (F.col("k") - 1) * step, digits).alias("level"), "min", "max"))


def extreme_rows(df: DataFrame, pred: str, keys: list[str]) -> DataFrame:
    """The row with the lowest and the row with the highest prediction
    (first occurrence by ``keys`` on ties); two TakeOrdered, no full sort."""
    lo = df.filter(F.col(pred).isNotNull()).orderBy(F.col(pred).asc(), *[F.col(k) for k in keys]).limit(1)
    hi = df.filter(F.col(pred).isNotNull()).orderBy(F.col(pred).desc(), *[F.col(k) for k in keys]).limit(1)
    return lo.withColumn("which", F.lit("min")).unionByName(hi.withColumn("which", F.lit("max")))


def table_dims(named: dict[str, DataFrame]) -> DataFrame:
    """Row and column counts of several tables, stacked."""
    out = None
    for name, df in named.items():
        d = df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_cols"))
        out = d if out is None else out.unionByName(d)
    return out


def head_rows(df: DataFrame, order: list[str], n: int = 6) -> DataFrame:
    """First rows of a preview, with the order made explicit."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order]).limit(n)

