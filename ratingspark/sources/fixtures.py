"""Adapters that turn the driver's star-schema tables into rating data.

F1 ratings  : lineitem x orders   -> (userId, movieId, rating, timestamp)
F2 movies   : part                -> (movieId, title, genres)
F3 skewed   : events              -> (userId, movieId, rating, timestamp)

Only the columns used are read, so the parquet scans are pruned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ratings_from_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """one rating per line item; the customer of the order rates the part.

    rating = ceil(quantity / 5) / 2 (half stars 0.5 .. 5.0, divided by a
    double so the type stays DOUBLE), timestamp = epoch seconds of the ship
    date under UTC. The order join is a plain equi-join: both sides grow
    with the data, so Catalyst/AQE pick sort-merge (or broadcast when the
    measured order side is small).
    """
    li = _read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = _read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        li.join(od, li.l_orderkey == od.o_orderkey, "inner")
        .select(
            F.col("o_custkey").cast("bigint").alias("userId"),
            F.col("l_partkey").cast("bigint").alias("movieId"),
            (F.ceil(F.col("l_quantity") / F.lit(5.0)).cast("double") / F.lit(2.0)).alias("rating"),
            F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("bigint").alias("timestamp"),
        )
    )


def movies_from_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """title = name + " (" + (1950 + size) + ")", except that parts whose
    size is a multiple of 17 carry no year (exercises the NULL-year joins);
    genres = type + "|" + brand."""
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    title = F.when(
        F.col("p_size") % 17 == 0, F.col("p_name")
    ).otherwise(F.concat(F.col("p_name"), F.lit(" ("), (F.col("p_size") + 1950).cast("string"), F.lit(")")))
    return p.select(
        F.col("p_partkey").cast("bigint").alias("movieId"),
        title.alias("title"),
        F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand")).alias("genres"),
    )


def ratings_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """skewed interactions; item = JSON key ``k`` of ``props``."""
    e = _read(spark, sf_dir, "events").select("user_id", "ts", "value", "props")
    r = F.ceil(F.col("value") / F.lit(10.0)).cast("double") / F.lit(2.0)
    return e.select(
        F.col("user_id").cast("bigint").alias("userId"),
        F.get_json_object("props", "$.k").cast("bigint").alias("movieId"),
        F.least(F.lit(5.0), F.greatest(F.lit(0.5), r)).alias("rating"),
        F.unix_timestamp(F.col("ts").cast("timestamp")).cast("bigint").alias("timestamp"),
    )
