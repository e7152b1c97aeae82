"""Exact order statistics and sort positions of any number of rows.

Rows are range-partitioned by the sort columns, sorted inside each partition
and written once with their partition number and their place in it. One total
per partition then gives every partition's offset, so no window and no task
ever spans the whole input, and nothing depends on how often Spark computes
the range exchange: the written table is the only one that is read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.operators.joins import broadcast_checked
from ratingspark.session import cut_lineage


def _ranged(df: DataFrame, order: list[str], partitions: int | None) -> DataFrame:
    args = ([partitions] if partitions else []) + list(order)
    ranged = df.repartitionByRange(*args).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    return cut_lineage(ranged.select("*", F.spark_partition_id().alias("_part"), place.alias("_place")))


def _offsets(totals: DataFrame) -> DataFrame:
    """(_part, _off) from (_part, _n): one row per partition."""
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))


def with_position(df: DataFrame, order: list[str], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` plus ``name``: each row's 1-based position by ``order``."""
    ranged = _ranged(df, order, partitions)
    offsets = _offsets(ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")))
    return (ranged.join(broadcast_checked(offsets), "_part")
                  .select(*df.columns, (F.col("_off") + F.col("_place") + 1).alias(name)))


def order_statistics(df: DataFrame, col: str, wanted) -> tuple[int, dict[int, float]]:
    """(n, {i: i-th smallest}) for the 0-based positions ``wanted(n)`` among
    the n non-NULL values of ``col``. Values are first reduced to distinct
    values with counts (a partial and a final aggregate)."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    ranged = _ranged(counts, ["_v"], None)
    ends, total = [], 0
    for part, n in sorted((r["_part"], r["_n"]) for r in
                          ranged.groupBy("_part").agg(F.sum("_c").alias("_n")).collect()):
        ends.append((total, total + n, part))
        total += n
    if not total:
        return 0, {}
    targets = [(part, i - lo, i) for i in sorted(set(wanted(total))) for lo, hi, part in ends if lo <= i < hi]
    spark = df.sparkSession
    asked = F.broadcast(spark.createDataFrame(targets, "_part int, _local bigint, _i bigint"))  # a few positions
    w = Window.partitionBy("_part").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = sorted({t[0] for t in targets})
    run = ranged.where(F.col("_part").isin(parts)).withColumn("_end", F.sum("_c").over(w))
    hit = run.join(asked, "_part").where((F.col("_local") < F.col("_end")) & (F.col("_local") >= F.col("_end") - F.col("_c")))
    return total, {r["_i"]: r["_v"] for r in hit.select("_i", "_v").collect()}


def quantiles(df: DataFrame, col: str, probs: list[float]) -> list[float | None]:
    """Exact quantiles of ``col`` by linear interpolation at (n - 1) p; NULLs
    are ignored, an empty column gives NULLs."""
    def wanted(n):
        for p in probs:
            lo = math.floor((n - 1) * p)
            yield lo
            yield min(lo + 1, n - 1)

    n, at = order_statistics(df, col, wanted)
    if not n:
        return [None] * len(probs)
    out = []
    for p in probs:
        h = (n - 1) * p
        lo = math.floor(h)
        a, b = float(at[lo]), float(at[min(lo + 1, n - 1)])
        out.append(a + (h - lo) * (b - a))
    return out
