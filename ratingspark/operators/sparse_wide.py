"""Wide views whose columns the data decides.

A pivot needs its column names when the plan is built, and a row as wide as
there are names. Here the names are found by Spark: a dictionary (key, col)
gives every distinct key its place 1..n in sort order, and a wide row is the
sorted codes of its cells beside their values. Both are tables, so neither the
names nor the rows pass through the driver, and what is stored grows with the
cells, not with rows x columns. A record covers at most ``width`` columns (a
stripe), so a row with cells everywhere is several bounded records.

Defined cases: duplicate cells are aggregated (``agg``). A NULL key is no
column; a NULL value is no cell, but its key is a column. A row without cells
stays, with empty arrays; a NULL row key is a row like any other. An empty
table has no rows and no columns. Names are those of ``row`` and ``key`` beside
stripe, cols, vals, col and value, which the caller's may not be.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingspark.operators.index import dense_index
from ratingspark.operators.joins import broadcast_checked
from ratingspark.operators.order_stats import with_position
from ratingspark.session import cut_lineage

WIDTH = 1 << 16
AGGREGATES = {"avg": F.avg, "sum": F.sum, "max": F.max, "min": F.min}


@dataclass(frozen=True)
class SparseWide:
    """``rows``: (row, stripe, cols, vals), cols ascending; ``columns``: (key, col)."""

    rows: DataFrame
    columns: DataFrame
    row: str
    key: str
    n_columns: int
    width: int = WIDTH

    @property
    def striped(self) -> bool:
        return self.n_columns > self.width


def sparse_wide(df: DataFrame, row: str, key: str, value: str, agg: str = "avg", width: int = WIDTH) -> SparseWide:
    """Long -> wide. The cells are written once; the dictionary and the rows
    both read them."""
    cells = cut_lineage(df.groupBy(row, key).agg(AGGREGATES[agg](value).cast("double").alias("value")))
    columns = cut_lineage(dense_index(cells, key, "col"))
    n = columns.count()
    coded = cells.join(broadcast_checked(columns), key, "left")
    cell = F.struct(F.col("col").cast("int").alias("col"), "value")
    rows = (coded.groupBy(row, F.coalesce(F.expr(f"(col - 1) div {width}"), F.lit(0)).cast("int").alias("stripe"))
                 .agg(F.sort_array(F.collect_list(F.when(F.col("col").isNotNull() & F.col("value").isNotNull(), cell))).alias("_c"))
                 .select(row, "stripe", F.col("_c.col").alias("cols"), F.col("_c.value").alias("vals")))
    return SparseWide(cut_lineage(rows), columns, row, key, n, width)


def complete(w: SparseWide) -> SparseWide:
    """The rows with a cell in every column."""
    if not w.striped:
        return replace(w, rows=w.rows.where(F.size("cols") == w.n_columns))
    full = (w.rows.groupBy(F.col(w.row).alias("_row")).agg(F.sum(F.size("cols")).alias("_n"))
                  .where(F.col("_n") == w.n_columns))
    return replace(w, rows=w.rows.join(full, F.col(w.row).eqNullSafe(F.col("_row")), "left_semi"))


def column(w: SparseWide, name) -> DataFrame:
    """(row, value) of every row: its cell under one key, NULL without one."""
    found = w.columns.where(F.col(w.key) == F.lit(name)).first()
    code = found["col"] if found else 0
    at = F.array_position("cols", F.lit(code).cast("int"))
    rows = w.rows.select(w.row, F.when(at > 0, F.get("vals", (at - 1).cast("int"))).alias("value"))
    return rows.groupBy(w.row).agg(F.max("value").alias("value")) if w.striped else rows


def arrange(w: SparseWide, name) -> DataFrame:
    """(row, value, place): rows in the order of one column, NULLs last, then
    by row."""
    rows = column(w, name).withColumn("_null", F.col("value").isNull().cast("int"))
    return with_position(rows, ["_null", "value", w.row], "place").drop("_null")


def cells(w: SparseWide) -> DataFrame:
    """Wide -> long: (row, key, col, value)."""
    long = w.rows.select(w.row, F.inline(F.arrays_zip(F.col("cols").alias("col"), F.col("vals").alias("value"))))
    return long.join(broadcast_checked(w.columns.select(w.key, F.col("col").cast("int").alias("col"))), "col").select(
        w.row, w.key, F.col("col").cast("bigint").alias("col"), "value")


def row_statistics(w: SparseWide, fill: float = 0.0) -> DataFrame:
    """(row, n_cells, col_sum, first_col, last_col, total, mean, lo, hi): codes
    and values of a row's cells; the mean is over all columns, missing ones
    count as ``fill``."""
    total: Column = F.aggregate("vals", F.lit(0.0), lambda a, x: a + x)
    codes: Column = F.aggregate("cols", F.lit(0).cast("bigint"), lambda a, x: a + x)
    part = w.rows.select(w.row, F.size("cols").cast("bigint").alias("n_cells"), codes.alias("col_sum"),
                         F.array_min("cols").cast("bigint").alias("first_col"),
                         F.array_max("cols").cast("bigint").alias("last_col"), total.alias("total"),
                         F.array_min("vals").alias("lo"), F.array_max("vals").alias("hi"))
    if w.striped:
        part = part.groupBy(w.row).agg(*[f(c).alias(c) for f, c in (
            (F.sum, "n_cells"), (F.sum, "col_sum"), (F.min, "first_col"), (F.max, "last_col"), (F.sum, "total"),
            (F.min, "lo"), (F.max, "hi"))])
    mean = (F.col("total") + (w.n_columns - F.col("n_cells")) * fill) / F.lit(max(w.n_columns, 1))
    return part.withColumn("mean", mean)
