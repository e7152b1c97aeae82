"""Seeded, stratified hold-out split and its repair.

The hold-out draws ceil(p * n_s) rows from every stratum s, where the strata
are the rating cut at its exact quartiles (unique breaks, lowest value
included in the first interval). Which rows are drawn is decided by a seeded
md5 of the row's key columns: the smallest hashes of each stratum go to the
hold-out. That choice is deterministic, reproducible on any cluster size and
expressible in SQL.

No stratum is ever sorted. Rows are read from a written table and hashed in
each of the few scans: 32 hex digits a row would be most of what is written and
do not compress. The hash
that ends a stratum's quota is found by its hex digits, a few at a time: one
histogram of (stratum, first digits), of at most strata x 16^3 rows, gives the
size of every stratum, so its quota, and the one prefix where the quota runs
out; a prefix is refined until it holds few rows, which are listed. Then every
row is decided by comparing its hash with its stratum's literal. Rows that tie
on the last hash have equal keys; only they are numbered, and only if the
quota ends among them. A draw is three scans after the quartiles, up to strata
of about 16^3 x ``FEW_ROWS`` rows, and one more for each 16^3 times as many.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.operators.order_stats import quantiles
from ratingspark.session import cut_lineage

QUARTILE_PROBS = [0.0, 0.25, 0.5, 0.75, 1.0]
DIGITS = 3            # hex digits read at a time: at most 4096 buckets a stratum
FEW_ROWS = 50_000     # a prefix with at most so many hashes is listed
HASH_DIGITS = 32


def rating_breaks(df: DataFrame, y: str = "rating") -> list[float]:
    """Exact quartile breaks of ``y`` (linear interpolation)."""
    return quantiles(df, y, QUARTILE_PROBS)


def stratum_expr(y: str, breaks: list[float]):
    """Index of the quartile interval of ``y``; NULL counts in the first.
    Interior breaks equal to the minimum are dropped (their interval is empty
    after ``unique``)."""
    lo = breaks[0]
    terms = [F.when(F.col(y) > F.lit(q), 1).otherwise(0) for q in breaks[1:-1] if lo is not None and q > lo]
    return reduce(lambda a, b: a + b, terms, F.lit(0))


def hash_expr(key_cols: list[str], seed, y: str = "rating"):
    """Hex md5 of "seed|k1|k2|..."; the rating enters as round(y * 1e6) so
    its text form is engine independent."""
    parts = [F.lit(str(seed))]
    for c in key_cols:
        if c == y:
            parts.append(F.round(F.col(c) * F.lit(1000000.0)).cast("bigint").cast("string"))
        else:
            parts.append(F.col(c).cast("string"))
    return F.md5(F.concat_ws("|", *parts))


def _inside(prefixes: dict):
    """Rows (_s, _h) whose hash starts with their stratum's prefix."""
    return reduce(lambda a, b: a | b, [(F.col("_s") == s) & F.col("_h").startswith(pre) for s, (pre, _) in prefixes.items()])


def last_hashes(hashed: DataFrame, quota, digits: int = DIGITS, few: int = FEW_ROWS) -> dict[int, tuple[str, int, int]]:
    """{stratum: (hash of the last row of its quota, rows with that hash, how
    many of them are needed)} of (_s, _h) rows; ``quota(n)`` rows of a stratum
    of n are wanted, and a stratum that needs none is left out. What is
    collected is bounded by the buckets and ``few``."""
    open_: dict[int, tuple[str, int]] | None = None    # prefix, rows still needed inside it
    out: dict[int, tuple[str, int, int]] = {}
    depth = 0
    while open_ is None or open_:
        width = min(depth + digits, HASH_DIGITS)
        rows = hashed if open_ is None else hashed.where(_inside(open_))
        counts: dict[int, list] = {}
        for r in rows.groupBy("_s", F.substring("_h", 1, width).alias("_b")).agg(F.count(F.lit(1)).alias("n")).collect():
            counts.setdefault(r["_s"], []).append((r["_b"], r["n"]))
        if open_ is None:
            need = {s: quota(sum(n for _, n in c)) for s, c in counts.items()}
            open_ = {s: ("", k) for s, k in need.items() if k > 0}
        cut, small = {}, {}
        for s, (_, k) in open_.items():
            for b, n in sorted(counts[s]):
                if k <= n:
                    (small if n <= few or width == HASH_DIGITS else cut)[s] = (b, k)
                    break
                k -= n
        if small:
            listed: dict[int, list] = {}
            for r in hashed.where(_inside(small)).groupBy("_s", "_h").agg(F.count(F.lit(1)).alias("n")).collect():
                listed.setdefault(r["_s"], []).append((r["_h"], r["n"]))
            for s, (_, k) in small.items():
                for h, n in sorted(listed[s]):
                    if k <= n:
                        out[s] = (h, n, k)
                        break
                    k -= n
        open_, depth = cut, width
    return out


def stratified_holdout(df: DataFrame, p: float = 0.1, seed=1, y: str = "rating",
                       key_cols: list[str] | None = None, flag: str = "_holdout", digits: int = DIGITS,
                       few: int = FEW_ROWS, written: bool = False) -> DataFrame:
    """Add boolean column ``flag``: True for the drawn hold-out rows. The rows
    are written once (not at all if ``written`` says that ``df`` reads a
    table); the flag is a comparison of the row's hash on that table."""
    key_cols = key_cols or ["userId", "movieId", y, "timestamp"]
    table = df if written else cut_lineage(df)
    h = table.withColumn("_s", stratum_expr(y, rating_breaks(table, y))).withColumn("_h", hash_expr(key_cols, seed, y))
    last = last_hashes(h.select("_s", "_h"), lambda n: int(math.ceil(p * n)), digits, few)
    taken, tied = F.lit(False), {}
    for s, (end, n, k) in last.items():
        row = F.col("_s") == s
        taken = taken | (row & ((F.col("_h") <= end) if n == k else (F.col("_h") < end)))
        if n > k:
            tied[s] = (end, k)
    if not tied:
        return h.withColumn(flag, taken).drop("_s", "_h")
    is_tie = reduce(lambda a, b: a | b, [(F.col("_s") == s) & (F.col("_h") == end) for s, (end, _) in tied.items()])
    quota = reduce(lambda e, s: F.when(F.col("_s") == s, tied[s][1]).otherwise(e), tied, F.lit(0))
    w = Window.partitionBy("_s", "_h").orderBy(*[F.col(c) for c in key_cols])
    ties = h.where(is_tie).withColumn(flag, F.row_number().over(w) <= quota)
    return h.where(~is_tie).withColumn(flag, taken).unionByName(ties).drop("_s", "_h")


def repair_holdout(flagged: DataFrame, flag: str = "_holdout", item: str = "movieId",
                   user: str = "userId") -> tuple[DataFrame, DataFrame]:
    """Keep a hold-out row only if its item and its user occur among the
    non-hold-out rows; the other hold-out rows go back to training.

    One pass over the hold-out side: left joins to the distinct training
    items and users (marker columns) give one ``keep`` flag, instead of a
    semi join, a second semi join and an anti join on every column. The
    checked hold-out is written once, as both results read it.
    Returns (training, holdout) without the flag column.
    """
    base = flagged.filter(~F.col(flag))
    hold = flagged.filter(F.col(flag))
    items = base.select(item).distinct().withColumn("_ki", F.lit(True))
    users = base.select(user).distinct().withColumn("_ku", F.lit(True))
    checked = hold.join(items, item, "left").join(users, user, "left")
    keep = F.coalesce(F.col("_ki"), F.lit(False)) & F.coalesce(F.col("_ku"), F.lit(False))
    checked = cut_lineage(checked.withColumn("_keep", keep).select(*flagged.columns, "_keep"))
    cols = [c for c in flagged.columns if c != flag]
    test = checked.filter(F.col("_keep")).select(*cols)
    removed = checked.filter(~F.col("_keep")).select(*cols)
    training = base.select(*cols).unionByName(removed)
    return training, test


def holdout_split(df: DataFrame, p: float = 0.1, seed=1, key_cols: list[str] | None = None,
                  **kw) -> tuple[DataFrame, DataFrame]:
    """Stratified draw + repair: (training, holdout)."""
    return repair_holdout(stratified_holdout(df, p=p, seed=seed, key_cols=key_cols, **kw))
