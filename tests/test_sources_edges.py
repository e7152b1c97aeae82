"""Edge rows of the readers and the repair (FIXTURES F6)."""

from __future__ import annotations

import os
import tempfile

import pytest

from ratingspark.operators.split import repair_holdout
from ratingspark.sources import files as IO


def _write(lines):
    d = tempfile.mkdtemp(prefix="ratingspark-src-")
    with open(os.path.join(d, "part-0.dat"), "w") as f:
        f.write("\n".join(lines) + "\n")
    return d


def test_movies_three_fields_rest_stays_in_genres(spark):
    path = _write(['1::Toy Story (1995)::Animation|Comedy', '2::Odd "Quoted", Title (1999)::Drama::Extra',
                   '3::No Genres', ' 4 ::Spaced id (2000)::Horror'])
    rows = {r["movieId"]: (r["title"], r["genres"]) for r in IO.read_movies_dat(spark, path).collect()}
    assert rows[1] == ("Toy Story (1995)", "Animation|Comedy")
    assert rows[2] == ('Odd "Quoted", Title (1999)', "Drama::Extra")
    assert rows[3] == ("No Genres", "")
    assert rows[4] == ("Spaced id (2000)", "Horror")


def test_ratings_reader_and_tab_variant_agree(spark):
    path = _write(["1::122::5::838985046", "1::185::4.5::838983525", "2::3::0.5::868244562"])
    a = IO.read_ratings_dat(spark, path)
    b = IO.read_ratings_dat_via_tab(spark, path)
    assert a.schema == b.schema
    assert sorted(a.collect()) == sorted(b.collect())
    assert sorted(r["rating"] for r in a.collect()) == [0.5, 4.5, 5.0]


def test_repair_moves_unknown_users_and_items_back(spark):
    rows = [(1, 10, 4.0, False), (2, 20, 3.0, False), (1, 20, 2.0, True),   # known user and item: stays out
            (9, 10, 5.0, True),                                               # user only in the hold-out
            (2, 99, 1.0, True)]                                               # item only in the hold-out
    df = spark.createDataFrame(rows, "userId long, movieId long, rating double, _holdout boolean")
    train, test = repair_holdout(df)
    assert sorted((r.userId, r.movieId) for r in test.collect()) == [(1, 20)]
    assert sorted((r.userId, r.movieId) for r in train.collect()) == [(1, 10), (2, 20), (2, 99), (9, 10)]


def test_triplets_round_trip(spark):
    df = spark.createDataFrame([(1, 2, 3.5), (4, 5, 0.5)], "userId long, movieId long, rating double")
    d = tempfile.mkdtemp(prefix="ratingspark-trip-")
    IO.write_triplets(df, d + "/t")
    back = IO.read_triplets(spark, d + "/t")
    assert sorted(back.collect()) == sorted(df.collect())
    text = "".join(open(os.path.join(d, "t", f)).read() for f in os.listdir(d + "/t") if f.startswith("part-"))
    assert "1 2 3.5" in text and "," not in text


def test_every_line_is_a_row_or_a_reject(spark):
    lines = ["1::122::5::838985046", "1::185::4.5", "x::3::0.5::868244562", "2::3::bad::1", "2::3::0.5::", "::::::", "",
             "2::3::0.5::868244562::9", "2::3::NaN::1", "2::3::inf::1", " 7 ::8::3.5::12", "2::3::1e400::5", "9" * 30 + "::3::1::5"]
    path = _write(lines)
    rows, rejects = IO.read_ratings_with_rejects(spark, path)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [(1, 122, 5.0, 838985046), (2, 3, 0.5, None), (None, None, None, None), (7, 8, 3.5, 12)], key=str)
    bad = {r["line"]: r["reason"] for r in rejects.collect()}
    assert bad == {"1::185::4.5": "3 fields", "x::3::0.5::868244562": "userId is not a number",
                   "2::3::bad::1": "rating is not a number", "": "empty line", "2::3::0.5::868244562::9": "5 fields",
                   "2::3::NaN::1": "rating is not finite", "2::3::inf::1": "rating is not finite",
                   "2::3::1e400::5": "rating is not finite", "9" * 30 + "::3::1::5": "userId is not a number"}
    assert all(r["file"] == "part-0.dat" for r in rejects.collect())
    assert rows.count() + rejects.count() == len(lines)
    tab = IO.read_ratings_dat_via_tab(spark, path)
    assert sorted(map(tuple, tab.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)


def test_writers_keep_fields_in_place_when_one_is_null(spark, tmp_path):
    full = (1, 2, 3.5, 1000)
    rows = [full] + [tuple(None if j == i else v for j, v in enumerate(full)) for i in range(4)]
    IO.write_ratings_dat(spark.createDataFrame(rows, IO.RATINGS_SCHEMA), str(tmp_path / "r"))
    assert sorted(map(tuple, IO.read_ratings_dat(spark, str(tmp_path / "r")).collect()), key=str) == sorted(rows, key=str)
    movies = [(1, "A (2000)", "Drama"), (2, None, "Drama"), (3, "C::", None), (None, "D", "x::y")]
    df = spark.createDataFrame([m for m in movies if m[0] != 3], "movieId long, title string, genres string")
    IO.write_movies_dat(df, str(tmp_path / "m"))
    assert sorted(map(tuple, IO.read_movies_dat(spark, str(tmp_path / "m")).collect()), key=str) == sorted(
        [(1, "A (2000)", "Drama"), (2, "", "Drama"), (None, "D", "x::y")], key=str)
    with pytest.raises(Exception, match="holds"):
        IO.write_movies_dat(spark.createDataFrame([movies[2]], df.schema), str(tmp_path / "m2"))


def test_a_run_written_twice_leaves_one_copy(spark, tmp_path):
    schema = "model string, param double, rmse double, n long, n_missing long"
    one = spark.createDataFrame([("naive", 0.0, 1.25, 10, 0)], schema)
    two = spark.createDataFrame([("bias 2/x", None, 1.0, 10, 1)], schema)
    path = str(tmp_path / "metrics")
    for df, run in ((one, "2024"), (two, "2024"), (one, "2024"), (two, "2024"), (one, "b")):
        IO.append_metrics(df, path, run)
    got = IO.read_metrics(spark, path)
    assert [f.simpleString() for f in got.schema][0] == "run:string"
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [("2024", "naive", 0.0, 1.25, 10, 0), ("2024", "bias 2/x", None, 1.0, 10, 1), ("b", "naive", 0.0, 1.25, 10, 0)], key=str)
