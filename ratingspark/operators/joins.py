"""Join helpers: size-checked broadcast, null-safe left join, semi/anti joins."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A dimension table is broadcast only after its measured size is below this
# bound; beyond it the join stays a shuffle join (AQE may still split skewed
# partitions or convert it at runtime from measured shuffle sizes).
DEFAULT_BROADCAST_BYTES = 256 * 1024 * 1024


def measured_bytes(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of a materialized table as rows in memory: 16 and 8 bytes
    a column for each row, plus the measured lengths of strings, binaries and
    arrays."""
    size = F.lit(16 + 8 * len(df.columns)).cast("bigint")
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            size = size + F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0))
        elif isinstance(f.dataType, T.ArrayType):
            size = size + 16 * F.greatest(F.size(F.col(f"`{f.name}`")), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
    return r["n"], r["bytes"]


def size_checked(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                 max_rows: int | None = None, materialize: str = "table") -> tuple[DataFrame, bool]:
    """Materialize ``df`` (it is about to be joined, usually more than once)
    and measure it. Returns (frame, small): the frame carries a broadcast hint
    only when its measured size is under ``max_bytes``; otherwise the planner
    uses a shuffle join.

    ``materialize='checkpoint'`` writes a reliable checkpoint to the shared
    checkpoint folder, ``'table'`` a parquet table there; both also cut the
    lineage, so later plans that join the table see a scan, not the plan that
    produced it.
    """
    if materialize in ("checkpoint", "table"):
        from ratingspark.session import cut_lineage
        df = cut_lineage(df, how="checkpoint" if materialize == "checkpoint" else "table")
    else:
        df = df.persist(StorageLevel.MEMORY_AND_DISK)
    n, size = measured_bytes(df)
    small = size <= max_bytes and (max_rows is None or n <= max_rows)
    return (F.broadcast(df) if small else df), small


def broadcast_checked(df: DataFrame, max_bytes: int = DEFAULT_BROADCAST_BYTES,
                      max_rows: int | None = None, materialize: str = "table") -> DataFrame:
    """``size_checked`` without the flag."""
    return size_checked(df, max_bytes, max_rows, materialize)[0]


def left_join(df: DataFrame, table: DataFrame, key: str, nullsafe: bool = False) -> DataFrame:
    """Left join on one key column; with ``nullsafe`` a NULL key matches the
    NULL-key row of ``table`` (grouping keeps NULL as a group, so a bias
    fitted for "no release year" applies to rows without a year)."""
    if not nullsafe:
        return df.join(table, key, "left")
    t = table.withColumnRenamed(key, "__jk")
    return df.join(t, df[key].eqNullSafe(t["__jk"]), "left").drop("__jk")


def semi_join(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` whose ``key`` occurs in ``other`` (on distinct keys)."""
    return df.join(other.select(key).distinct(), key, "left_semi")


def anti_join_all(df: DataFrame, other: DataFrame) -> DataFrame:
    """Rows of ``df`` with no row in ``other`` equal on every shared column,
    NULL matching NULL (the natural-key anti join)."""
    shared = [c for c in df.columns if c in other.columns]
    o = other.select(*[F.col(c).alias(f"__o_{c}") for c in shared])
    cond = reduce(lambda a, b: a & b, [df[c].eqNullSafe(o[f"__o_{c}"]) for c in shared])
    return df.join(o, cond, "left_anti")
