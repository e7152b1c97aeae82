"""Ingest -> split -> tidy: the data sets every model and view starts from.

    drawn                   = ratings with a stratified 10 % hold-out marked
    development, validation = drawn, repaired, then LEFT JOIN movies (movie table broadcast after
                              a size check); flagged = drawn LEFT JOIN movies
    training_set, test_set = tidied development, validation
    train_set, cv_set      = the same split applied to training_set

The drawn rows and the four tidy sets are written once as parquet tables in the shared
checkpoint folder and read back: every model reads them many times, the
scans prune columns, and the cut keeps later plans (bias chains, grids,
SVD passes) from re-planning the split.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingspark.functions.columns import epoch_to_date, release_year, round_month, tidy_title
from ratingspark.operators.joins import anti_join_all, broadcast_checked
from ratingspark.operators.split import holdout_split, repair_holdout, stratified_holdout
from ratingspark.session import cut_lineage
from ratingspark.sources.fixtures import movies_from_parts, ratings_from_orders

TIDY_COLUMNS = ["userId", "movieId", "rating", "rating_date", "release_year", "tidy_title", "genres"]
JOINED_COLUMNS = ["movieId", "userId", "rating", "timestamp", "title", "genres"]
OUTER_SEED = 1
INNER_SEED = 2
HOLDOUT_FRACTION = 0.1


def join_movies(ratings: DataFrame, movies: DataFrame, key: str = "movieId") -> DataFrame:
    """Every rating with its movie attributes (left join: a rating of an
    unknown movie keeps NULL title and genres); ``movies`` is measured before."""
    return ratings.join(movies, key, "left")


def tidy(df: DataFrame) -> DataFrame:
    """rating_date from epoch seconds (UTC), release_year = first "(dddd)" of
    the title as a string, tidy_title = title without years, trimmed."""
    return df.select(
        "userId", "movieId", "rating",
        epoch_to_date("timestamp").alias("rating_date"),
        release_year("title").alias("release_year"),
        tidy_title("title").alias("tidy_title"),
        "genres",
    )


def with_month(df: DataFrame, date_col: str = "rating_date") -> DataFrame:
    return df.withColumn("rating_month", round_month(date_col))


class RatingSets:
    """Lazily built, cached data sets for one input directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None,
                 movies: DataFrame | None = None, fraction: float = HOLDOUT_FRACTION):
        self.spark = spark
        self.sf_dir = sf_dir
        self._ratings = ratings
        self._movies = movies
        self.fraction = fraction

    @cached_property
    def ratings(self) -> DataFrame:
        return self._ratings if self._ratings is not None else ratings_from_orders(self.spark, self.sf_dir)

    @cached_property
    def movies(self) -> DataFrame:
        return self._movies if self._movies is not None else movies_from_parts(self.spark, self.sf_dir)

    @cached_property
    def movie_table(self) -> DataFrame:
        """The movies for joins, measured once. Joining them after the draw and
        the repair keeps rows one to one because movie ids are unique, which is
        checked."""
        twice = self.movies.groupBy("movieId").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("movieId").first()
        if twice is not None:
            raise ValueError(f"movie id {twice[0]} occurs more than once")
        return broadcast_checked(self.movies)

    def _with_movies(self, rows: DataFrame, *more: str) -> DataFrame:
        return join_movies(rows, self.movie_table).select(*JOINED_COLUMNS, *more)

    @cached_property
    def drawn(self) -> DataFrame:
        """Every rating with ``_holdout``: drawn for the outer hold-out. The
        draw and the repair read and move these narrow rows, without titles."""
        return cut_lineage(stratified_holdout(self.ratings, p=self.fraction, seed=OUTER_SEED,
                                              key_cols=["userId", "movieId", "rating", "timestamp"]))

    @cached_property
    def flagged(self) -> DataFrame:
        """``drawn`` with movie attributes."""
        return self._with_movies(self.drawn, "_holdout")

    @property
    def joined(self) -> DataFrame:
        return self.flagged.select(*JOINED_COLUMNS)

    @cached_property
    def repaired(self) -> tuple[DataFrame, DataFrame]:
        """``drawn`` as (development, validation) without movie attributes."""
        return repair_holdout(self.drawn)

    @cached_property
    def _outer(self) -> tuple[DataFrame, DataFrame]:
        training, holdout = self.repaired
        return self._with_movies(training), self._with_movies(holdout)

    @cached_property
    def removed(self) -> DataFrame:
        """The drawn rows that are in no way in validation: an anti join on every
        column of the narrow rows. Movie ids are unique, so rows that agree in
        these agree in title and genres."""
        return self._with_movies(anti_join_all(self.drawn.filter("_holdout").drop("_holdout"), self.repaired[1]))

    @property
    def development(self) -> DataFrame:
        return self._outer[0]

    @property
    def validation(self) -> DataFrame:
        return self._outer[1]

    @cached_property
    def training_set(self) -> DataFrame:
        return cut_lineage(tidy(self.development))

    @cached_property
    def test_set(self) -> DataFrame:
        return cut_lineage(tidy(self.validation))

    @cached_property
    def _inner(self) -> tuple[DataFrame, DataFrame]:
        return holdout_split(self.training_set, p=HOLDOUT_FRACTION, seed=INNER_SEED,
                             key_cols=["userId", "movieId", "rating", "rating_date"], written=True)

    @cached_property
    def train_set(self) -> DataFrame:
        return cut_lineage(self._inner[0])

    @cached_property
    def cv_set(self) -> DataFrame:
        return cut_lineage(self._inner[1])

    @cached_property
    def mu(self) -> float:
        """Mean rating of training_set, used everywhere (also while tuning on
        train_set, as the analysis does)."""
        return float(self.training_set.agg(F.avg("rating")).first()[0])
