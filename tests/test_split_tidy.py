"""Split invariants, strategy equivalence and the tidy functions on edge rows."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ratingspark.functions.columns import epoch_to_date, release_year, round_month, tidy_title
from ratingspark.operators.split import holdout_split, stratified_holdout
from ratingspark.sources.fixtures import movies_from_parts, ratings_from_orders
from tests.conftest import SF_SMALL

KEYS = ["userId", "movieId", "rating", "timestamp"]


@pytest.fixture(scope="module")
def joined(spark):
    r = ratings_from_orders(spark, SF_SMALL)
    m = movies_from_parts(spark, SF_SMALL)
    return r.join(m, "movieId", "left").cache()


def test_fixture_counts(joined):
    assert joined.count() == 6000
    assert joined.select("userId").distinct().count() == 150
    assert joined.select("movieId").distinct().count() == 200


def test_quota_per_stratum(joined):
    import math
    flagged = stratified_holdout(joined, 0.1, 1, key_cols=KEYS)
    # strata of this fixture: quartile breaks 0.5 / 1.5 / 3 / 4 / 5 or similar
    from ratingspark.operators.split import rating_breaks, stratum_expr
    br = rating_breaks(joined)
    per = flagged.withColumn("s", stratum_expr("rating", br)).groupBy("s").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_holdout").cast("int")).alias("k")).collect()
    for r in per:
        assert r["k"] == math.ceil(0.1 * r["n"])


def test_split_invariants(joined):
    train, test = holdout_split(joined, 0.1, 1, key_cols=KEYS)
    cols = joined.columns
    union = train.select(*cols).unionByName(test.select(*cols))
    assert union.exceptAll(joined).count() == 0 and joined.exceptAll(union).count() == 0
    assert test.join(train.select("movieId").distinct(), "movieId", "left_anti").count() == 0
    assert test.join(train.select("userId").distinct(), "userId", "left_anti").count() == 0


def test_single_row_stratum(spark):
    # breaks 1 / 2 / 3 / 4 / 5: the interval (4, 5] holds the single 5
    rows = [(u, u, float(1 + u // 10), u) for u in range(40)] + [(99, 99, 5.0, 99)]
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long")
    flagged = stratified_holdout(df, 0.1, 1, key_cols=KEYS)
    assert flagged.filter("rating = 5.0 AND _holdout").count() == 1
    assert flagged.filter("_holdout").count() == 5


def test_title_functions(spark):
    titles = ["Toy Story (1995)", "No Year Here", "X (1999) (2000)", "\tPadded (1980)  ", "Year 1990 bare", None]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    out = df.select(release_year("title").alias("y"), tidy_title("title").alias("t")).collect()
    assert [r["y"] for r in out] == ["1995", None, "1999", "1980", None, None]
    assert [r["t"] for r in out] == ["Toy Story", "No Year Here", "X", "Padded", "Year 1990 bare", None]


@pytest.mark.parametrize("day,expected", [
    ("2000-01-16", "2000-01-01"), ("2000-01-17", "2000-02-01"),
    ("2000-04-15", "2000-04-01"), ("2000-04-16", "2000-05-01"),
    ("2001-02-14", "2001-02-01"), ("2001-02-15", "2001-03-01"),
    ("2000-02-15", "2000-02-01"), ("2000-02-16", "2000-03-01"),
    ("2000-03-01", "2000-03-01"), ("2000-12-31", "2001-01-01"),
])
def test_round_month(spark, day, expected):
    df = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date")
    assert df.select(round_month("d")).first()[0] == dt.date.fromisoformat(expected)


def test_epoch_date_is_utc(spark):
    df = spark.createDataFrame([(86399,), (86400,)], "ts long")
    assert [r[0] for r in df.select(epoch_to_date("ts")).collect()] == [dt.date(1970, 1, 1), dt.date(1970, 1, 2)]


def test_draw_and_repair_move_narrow_rows(spark, monkeypatch):
    """What the sets write before the tidy tables has no titles and no hashes;
    an inner draw on a written table writes nothing again."""
    from ratingspark.operators import split as S
    from ratingspark.plans import pipeline as P

    ratings = spark.createDataFrame([(u, m, float(1 + (u * m) % 10) / 2, 10**9 + u) for u in range(30) for m in range(20)],
                                    "userId long, movieId long, rating double, timestamp long")
    movies = spark.createDataFrame([(m, f"name {m} ({1950 + m})", "a|b") for m in range(20)], "movieId long, title string, genres string")
    written, cut = [], S.cut_lineage
    record = lambda df, *a, **kw: written.append(set(df.columns)) or cut(df, *a, **kw)
    monkeypatch.setattr(S, "cut_lineage", record)
    monkeypatch.setattr(P, "cut_lineage", record)
    s = P.RatingSets(spark, None, ratings=ratings, movies=movies)
    assert s.development.count() + s.validation.count() == 600
    narrow = {"userId", "movieId", "rating", "timestamp", "_holdout", "_keep"}
    assert written and all(c <= narrow for c in written)
    assert s.validation.where("title IS NULL").isEmpty() and s.validation.columns == P.JOINED_COLUMNS
    s.training_set.count()
    written.clear()
    S.stratified_holdout(s.training_set, 0.1, 2, key_cols=["userId", "movieId", "rating", "rating_date"], written=True).count()
    assert written == []


def test_removed_rows_are_found_without_titles(spark):
    """The anti join on every column compares narrow rows; titles come after."""
    from ratingspark.operators.joins import anti_join_all
    from ratingspark.plans import pipeline as P
    from ratingspark.plans import q_sets as Q

    ratings = [(u, m, float(1 + (u * m) % 10) / 2, 10**9 + u) for u in range(30) for m in range(0, 20, 1 + u % 7)]
    ratings += [(None, 3, 2.0, None), (5, None, None, 10**9), (77, 3, 2.0, 7), (77, 3, 2.0, 7)]
    s = P.RatingSets(spark, None, fraction=0.9, ratings=spark.createDataFrame(
        ratings, "userId long, movieId long, rating double, timestamp long"), movies=spark.createDataFrame(
        [(m, f"name {m} ({1950 + m})", "a|b") for m in range(19)], "movieId long, title string, genres string"))
    got = Q._anti(s)
    want = anti_join_all(Q._drawn(s), s.validation.select(*Q.ML))
    assert got.columns == want.columns and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
    anti = [x for x in got._jdf.queryExecution().optimizedPlan().toString().splitlines() if "LeftAnti" in x]
    assert len(anti) == 1 and "title" not in anti[0] and "genres" not in anti[0] and "timestamp" in anti[0]
