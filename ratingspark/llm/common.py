"""Helpers shared by the operators: scratch tables, names, byte views of texts."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ratingspark.session import checkpoint_dir, workers_find_package

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A table is broadcast only when its measured size is under this bound.
BROADCAST_BYTES = 32 * 1024 * 1024


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(taken, *names: str) -> list[str]:
    """``names``, each with underscores added until it differs (also in case)
    from every name in ``taken``."""
    have = {c.lower() for c in taken}
    out = []
    for n in names:
        while n.lower() in have:
            n += "_"
        have.add(n.lower())
        out.append(n)
    return out


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers: batches are bounded by rows and bytes,
    as Spark's default of 10,000 rows takes hundreds of megabytes a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


class Scratch:
    """Tables in the shared checkpoint folder, written once and read back, so
    later jobs neither recompute them nor depend on one executor's disk."""

    made: list[Scratch] = []

    def __init__(self, spark: SparkSession):
        workers_find_package(spark)
        small_batches(spark)
        Scratch.made.append(self)
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
        self.n = 0

    def path(self) -> str:
        self.n += 1
        return f"{self.base}/t{self.n}"

    def write(self, df: DataFrame) -> tuple[DataFrame, str]:
        """(the table read back, its path)."""
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), path

    def keep(self, df: DataFrame) -> DataFrame:
        return self.write(df)[0]

    @staticmethod
    def clear(since: int) -> None:
        """Delete all tables of the scratches made after the first ``since``,
        once what was computed from them is stored elsewhere."""
        while len(Scratch.made) > since:
            old = Scratch.made.pop()
            old.drop(old.base)

    def drop(self, path: str) -> None:
        """Delete a table that nothing will read again."""
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(p, True)


def small_or_not(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` (a scratch table, so counting is cheap) with a broadcast hint if
    its rows times ``row_bytes`` stay under ``limit``; else as it is, for a
    shuffle join."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


def chunks(texts: list[str], max_bytes: int = 1 << 21):
    """Index ranges of ``texts`` of at most about ``max_bytes`` characters
    (one longer text is a chunk of its own)."""
    start = size = 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > max_bytes:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64 (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    """base^0 .. base^(n-1) modulo 2^64."""
    p = np.full(n, base % (1 << 64), np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)
