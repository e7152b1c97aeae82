"""Readers and writers: '::'-delimited ratings and movies, parquet tables,
space-separated triplets, the metrics table and prediction files.

All readers declare their schema (no inference); all writers are plain
DataFrame writers, so every executor reads and writes its own splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingspark.session import checkpoint_dir

RATINGS_SCHEMA = "userId BIGINT, movieId BIGINT, rating DOUBLE, timestamp BIGINT"
METRICS_SCHEMA = "run STRING, model STRING, param DOUBLE, rmse DOUBLE, n BIGINT, n_missing BIGINT"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex}"


def parse_ratings(lines: DataFrame, sep: str = "::") -> DataFrame:
    """(userId, movieId, rating, timestamp, line, reason) of lines (column
    ``value``). ``reason`` is NULL for a good line: four fields, each empty (a
    NULL) or a number of its type, and a finite rating."""
    parts = F.split(F.col("value"), sep, -1)
    field = lambda i: F.trim(F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit("")))
    types = [("userId", "bigint"), ("movieId", "bigint"), ("rating", "double"), ("timestamp", "bigint")]
    cols = [field(i + 1).try_cast(kind).alias(name) for i, (name, kind) in enumerate(types)]
    reason = F.when(F.trim("value") == "", "empty line").when(F.size(parts) != len(types), F.concat(
        F.size(parts).cast("string"), F.lit(" fields")))
    for i, (name, kind) in enumerate(types):
        reason = reason.when((field(i + 1) != "") & field(i + 1).try_cast(kind).isNull(), f"{name} is not a number")
    rating = field(3).try_cast("double")
    reason = reason.when(F.isnan(rating) | (F.abs(rating) == float("inf")), "rating is not finite")
    others = [c for c in lines.columns if c != "value"]
    return lines.select(*others, *cols, F.col("value").alias("line"), reason.alias("reason"))


def read_ratings_with_rejects(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(ratings, rejects) of a userId::movieId::rating::timestamp file without
    header: every line is in one of them. Rejects are (file, line, reason)."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"))
    parsed = parse_ratings(lines)
    rows = parsed.where("reason IS NULL").select("userId", "movieId", "rating", "timestamp")
    return rows, parsed.where("reason IS NOT NULL").select("file", "line", "reason")


def read_ratings_dat(spark: SparkSession, path: str) -> DataFrame:
    """The good lines of a userId::movieId::rating::timestamp file, no header;
    ``read_ratings_with_rejects`` also gives the others."""
    return read_ratings_with_rejects(spark, path)[0]


def read_ratings_dat_via_tab(spark: SparkSession, path: str) -> DataFrame:
    """The same file with every '::' replaced by a tab, then split."""
    lines = spark.read.text(path).select(F.replace(F.col("value"), F.lit("::"), F.lit("\t")).alias("value"))
    return parse_ratings(lines, "\t").where("reason IS NULL").select("userId", "movieId", "rating", "timestamp")


def read_movies_dat(spark: SparkSession, path: str) -> DataFrame:
    """movieId::title::genres lines split into exactly three fields: anything
    after the second '::' stays in genres, a missing field is ''. Not read
    as CSV because titles hold quotes and commas."""
    parts = F.split(F.col("value"), "::", 3)
    field = lambda i: F.coalesce(F.try_element_at(parts, F.lit(i)), F.lit(""))
    return spark.read.text(path).select(
        F.trim(field(1)).try_cast("bigint").alias("movieId"),
        field(2).alias("title"),
        field(3).alias("genres"),
    )


def _line(*fields) -> Column:
    """One line of '::'-separated fields; NULL is an empty field, and all
    fields but the last must not hold the separator, none a line end."""
    text = [F.coalesce(f.cast("string"), F.lit("")) for f in fields]
    broken = F.lit(False)
    for i, t in enumerate(text):
        broken = broken | t.contains("\n") | (t.contains("::") if i < len(text) - 1 else F.lit(False))
    return F.when(broken, F.raise_error(F.lit("a field holds '::' or a line end"))).otherwise(F.concat_ws("::", *text))


def write_ratings_dat(df: DataFrame, path: str) -> None:
    df.select(_line(*[F.col(c) for c in ("userId", "movieId", "rating", "timestamp")])).write.mode("overwrite").text(path)


def write_movies_dat(df: DataFrame, path: str) -> None:
    df.select(_line(*[F.col(c) for c in ("movieId", "title", "genres")])).write.mode("overwrite").text(path)


def write_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_triplets(df: DataFrame, path: str, cols=("userId", "movieId", "rating")) -> None:
    """Space-separated, header-less export."""
    df.select(*cols).write.mode("overwrite").csv(path, sep=" ", header=False)


def read_triplets(spark: SparkSession, path: str, schema: str = "userId BIGINT, movieId BIGINT, rating DOUBLE") -> DataFrame:
    return spark.read.csv(path, sep=" ", header=False, schema=schema)


def append_metrics(df: DataFrame, path: str, run: str) -> None:
    """Store (model, param, rmse, n, n_missing) rows under a run label. Rows of
    the same run and model are replaced, all others stay, so a retried run
    leaves one copy."""
    df.select(F.lit(run).alias("run"), F.col("model"), F.col("param").cast("double"), F.col("rmse").cast("double"),
              F.col("n").cast("bigint"), F.col("n_missing").cast("bigint")) \
      .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "model").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    names = [f.split()[0] for f in METRICS_SCHEMA.split(", ")]
    return spark.read.schema(METRICS_SCHEMA).parquet(path).select(*names)


def write_predictions(df: DataFrame, path: str, keys=("userId", "movieId"), pred: str = "pred") -> None:
    """Predictions keyed by their row, as text (the numbers round-trip
    exactly: Spark writes the shortest repr of a double)."""
    df.select(*keys, pred).write.mode("overwrite").csv(path, sep=",", header=False)


def read_predictions(spark: SparkSession, path: str, schema: str = "userId BIGINT, movieId BIGINT, pred DOUBLE") -> DataFrame:
    return spark.read.csv(path, sep=",", header=False, schema=schema)
