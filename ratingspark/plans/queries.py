"""Registered queries: one per operator of the inventory, each a Spark plan
over the given tables plus (where SQL can express it) a DuckDB oracle.

Every query runs on the whole input tables. Doubles are rounded to 6
decimals in the registered output only (the library functions return full
precision) so the two engines' different summation orders compare equal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ratingspark.plans import oracle as O
from ratingspark.plans.pipeline import HOLDOUT_FRACTION, RatingSets
from ratingspark.session import apply_session_settings

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``; the session settings the
    semantics rely on (UTC, AQE) are applied before every call."""
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_session_settings(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def r6(df: DataFrame) -> DataFrame:
    """Round every DOUBLE column to 6 decimals (registered output only)."""
    return df.select(*[F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if isinstance(f.dataType, T.DoubleType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


_SETS: dict[tuple, tuple[tuple, RatingSets]] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Length and modification time of the rating tables' files: sets built
    from other contents are not used again."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    out = []
    for t in ("part", "orders", "lineitem", "events"):
        p = path(f"{sf_dir}/{t}.parquet")
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(p):
            out.append((t, fs.getContentSummary(p).getLength(), fs.getFileStatus(p).getModificationTime()))
    return tuple(out)


def sets(spark: SparkSession, sf_dir: str, fraction: float = HOLDOUT_FRACTION) -> RatingSets:
    """One RatingSets per (session, input directory, hold-out fraction), as
    long as the input files stay the same."""
    apply_session_settings(spark)
    key = (id(spark), spark.sparkContext.applicationId, sf_dir, fraction)
    stamp = _stamp(spark, sf_dir)
    if key not in _SETS or _SETS[key][0] != stamp:
        _SETS[key] = (stamp, RatingSets(spark, sf_dir, fraction=fraction))
    return _SETS[key][1]


def _sel(src: str, cols: list[str]) -> str:
    return "SELECT " + ", ".join(f'"{c}"' for c in cols) + f" FROM {src}"


ML = O.ML_COLS
TIDY = O.TIDY_COLS
