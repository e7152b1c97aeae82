"""Exact deduplication by distributed MSD radix partitioning.

Rows start in one group. Each round reads the next digit (a run of bytes) of
every live row and splits its group by that digit, so a group is a set of rows
that agree on all bytes read so far. A group with one row is settled; a group
whose digit is shorter than asked for has ended, and its rows are equal to the
last byte. Only the rest goes on, without the bytes already read. Equality
follows from the bytes themselves, no digest decides it.

Digits grow fourfold from round to round, so a text of L bytes ends after
about log4(L) rounds. A round is one aggregate on (group, digit), combined on
the map side (a group holding a third of the rows becomes one row a task), and
one join that gives rows their new group: broadcast while the table of digits
is measured to be small, else a shuffle join whose skewed side Spark splits.
Texts are written to the shared folder once per round, for live rows only.

NULL text counts as empty. NULL doc_id sorts below every id. Rows that tie
(same text, same id) are told apart by a row number given when first written,
so exactly one row of each group is kept. An empty table gives an empty
result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import BROADCAST_BYTES, Scratch, ascii_lower

FIRST_DIGIT = 64     # bytes read in the first round
GROWTH = 4


def _digits(groups: DataFrame, scratch: Scratch) -> tuple[DataFrame, bool, str]:
    """Groups of two rows or more, as a written table, and whether it is small
    enough for a broadcast: measured rows and bytes."""
    t, path = scratch.write(groups)
    n, size = t.agg(F.count(F.lit(1)), F.sum(F.length("digit"))).first()
    return t, n * 64 + (size or 0) <= BROADCAST_BYTES, path


def exact_groups(docs: DataFrame, text: str = "text", order: str = "doc_id", carry: list[str] | None = None,
                 first_digit: int = FIRST_DIGIT, growth: int = GROWTH) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` with its columns ``carry``
    (all without it), and keep_id, group_size, kept, text_sha256 for its group of equal texts (after
    lower-casing A-Z). The row with the largest ``order`` value stays."""
    scratch = Scratch(docs.sparkSession)
    whole = F.encode(ascii_lower(F.coalesce(F.col(text), F.lit(""))), "utf-8")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("row"),
                       F.col(order).alias("ord"), whole.alias("rest"))
    width = first_digit
    # Round 0 reads the input itself. Its groups go on even when ended, as rows
    # get their number only when they are first written.
    groups = (rows.groupBy(F.substring("rest", 1, width).alias("digit")).agg(F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("digit", F.monotonically_increasing_id().alias("gid")))
    groups, small, gpath = _digits(groups, scratch)
    live = (rows.withColumn("digit", F.substring("rest", 1, width)).withColumn("sha", F.sha2("rest", 256))
                .join(F.broadcast(groups) if small else groups, "digit", "left")
                .select("row", "ord", F.monotonically_increasing_id().alias("uid"), "sha", "gid",
                        F.when(F.col("gid").isNotNull(), F.expr(f"substring(rest, {width + 1})")).alias("rest"),
                        F.col("gid").isNotNull().alias("live"), F.lit(1).cast("bigint").alias("n"))
                .withColumn("best", F.struct("ord", "uid")))
    settled = []
    while True:
        path = scratch.path()
        live.write.partitionBy("live").parquet(path)
        scratch.drop(gpath)
        if len(settled):
            scratch.drop(f"{settled[-1]}/live=true")
        settled.append(path)
        schema = live.drop("live").schema
        alive = docs.sparkSession.read.schema(live.schema).parquet(path).where("live").select(*schema.names)
        if alive.isEmpty():
            break
        width *= growth
        digit = F.substring("rest", 1, width)
        groups = (alive.groupBy("gid", digit.alias("digit"))
                       .agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("ord", "uid")).alias("best"))
                       .where("n > 1").withColumn("to", F.monotonically_increasing_id()))
        groups, small, gpath = _digits(groups, scratch)
        ended = F.length("digit") < width
        more = F.col("n").isNotNull() & ~ended
        live = (alive.drop("n", "best").withColumn("digit", digit)
                     .join(F.broadcast(groups) if small else groups, ["gid", "digit"], "left")
                     .select("row", "ord", "uid", "sha", F.col("to").alias("gid"),
                             F.when(more, F.expr(f"substring(rest, {width + 1})")).alias("rest"), more.alias("live"),
                             F.coalesce("n", F.lit(1)).cast("bigint").alias("n"),
                             F.coalesce("best", F.struct("ord", "uid")).alias("best")))
    done = [docs.sparkSession.read.schema(live.schema).parquet(p).where("not live") for p in settled]
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("row", F.col("best.ord").alias("keep_id"), F.col("n").alias("group_size"),
                      (F.col("uid") == F.col("best.uid")).alias("kept"), F.col("sha").alias("text_sha256"))


def drop_exact_copies(docs: DataFrame, text: str = "text", order: str = "doc_id") -> DataFrame:
    """``docs`` with one row of each group of equal texts, all columns kept."""
    return exact_groups(docs, text, order).where("kept").select("row.*")
