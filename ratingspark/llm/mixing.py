"""Mixing sources to target weights by Poisson replication.

Each source has a target share of the mixed corpus. Its rate is the mean
number of times each of its documents should appear: target characters of the
source over the characters it has. A document's count is drawn from the
Poisson distribution with that mean by inverting its distribution function at
a uniform number taken from a hash of (seed, doc_id), so the draw needs no
state, repeats exactly and does not depend on partitioning. Documents are then
exploded by their counts and shuffled globally by a hash of (seed, doc_id,
copy). Everything is DataFrame functions; documents move once, in the global
shuffle.

Defined cases: NULL text has no characters; a NULL or unlisted source is a
source like any other (share from ``weights`` or the default); sources whose
characters sum to 0 get rate 1; NULL doc_id hashes as the text "null"; rows
that repeat a doc_id draw the same count. An empty table gives an empty
result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, fresh, small_or_not

SEED = 7


def uniform(seed: int, *parts: Column) -> Column:
    """A number in (0, 1) from 52 bits of an md5 of ``seed`` and ``parts``."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_table(rates: DataFrame, key: str = "mix_source", rate: str = "rate") -> DataFrame:
    """``rates`` plus ``low`` and ``cdf``, the distribution function at low,
    low + 1, ... The table goes 12 standard deviations and 40 steps to either
    side of the rate, beyond which the tails are far below the uniform numbers'
    resolution, so no count that can be drawn is cut off. Rows (source, k) are
    summed by windows over one source: about 24 sqrt(rate) rows each."""
    r, wide = F.col(rate), 12 * F.sqrt(rate) + 40
    low = F.when(r - wide < 100, F.lit(0)).otherwise(F.floor(r - wide)).cast("bigint")
    steps = rates.withColumn("low", low).withColumn("k", F.explode(F.sequence("low", F.ceil(r + wide).cast("bigint"))))
    k, first = F.col("k").cast("double"), F.col("low").cast("double")
    # ln(low!) by Stirling's series, exact to double precision from 100 on; 0 for low = 0
    factorial = F.when(F.col("low") == 0, 0.0).otherwise(
        first * F.ln(first) - first + 0.5 * F.ln(2 * math.pi * first) + 1 / (12 * first) - 1 / (360 * first ** 3)
        + 1 / (1260 * first ** 5))
    never = F.lit(float("-inf"))
    start = F.when(r > 0, -r + first * F.ln(r) - factorial).otherwise(F.when(F.col("low") == 0, 0.0).otherwise(never))
    more = F.when(F.col("k") == F.col("low"), start).otherwise(F.when(r > 0, F.ln(r) - F.ln(k)).otherwise(never))
    along = Window.partitionBy(key).orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("p", F.exp(F.sum(more).over(along))).withColumn("at_k", F.sum("p").over(along))
    others = [c for c in rates.columns if c != key]
    return steps.groupBy(key).agg(*[F.first(c).alias(c) for c in (*others, "low")],
                                  F.array_sort(F.collect_list(F.struct("k", "at_k"))).alias("cdf")).withColumn("cdf", F.col("cdf.at_k"))


def source_rates(docs: DataFrame, source: str, text: str, weights: dict | None) -> DataFrame:
    """(source, chars, rate) by source. Without ``weights`` all sources get
    equal shares; with them a missing source has weight 0."""
    totals = docs.groupBy(F.col(source).alias("mix_source")).agg(
        F.coalesce(F.sum(F.length(F.coalesce(F.col(text), F.lit("")))), F.lit(0)).alias("chars"))
    totals = Scratch(docs.sparkSession).keep(totals)
    all_chars, n_sources = totals.agg(F.coalesce(F.sum("chars"), F.lit(0)), F.count(F.lit(1))).first()
    if weights is None:
        share = F.lit(1.0) / F.lit(n_sources)
    else:
        total = float(sum(weights.values()))
        share = F.lit(0.0)
        for s, w in weights.items():
            share = F.when(F.col("mix_source") == F.lit(s), F.lit(w / total)).otherwise(share)
    rate = F.when(F.col("chars") == 0, F.lit(1.0)).otherwise(share * F.lit(all_chars) / F.col("chars"))
    return totals.select("mix_source", "chars", rate.alias("rate"))


def mix(docs: DataFrame, weights: dict | None = None, seed: int = SEED, source: str = "source",
        key: str = "doc_id", text: str = "text") -> DataFrame:
    """Copies of the rows of ``docs``, globally shuffled: all their columns and
    copy (from 1), n_copies, rate, shuffle_key (names get underscores if
    ``docs`` has them already)."""
    copy, n_copies, rate, shuffle_key, src, cdf, low = fresh(docs.columns, "copy", "n_copies", "rate", "shuffle_key",
                                                             "mix_source", "mix_cdf", "mix_low")
    rates = poisson_table(source_rates(docs, source, text, weights).select("mix_source", "rate"))
    rates = Scratch(docs.sparkSession).keep(rates.select(F.col("mix_source").alias(src), F.col("rate").alias(rate),
                                                         F.col("low").alias(low), F.col("cdf").alias(cdf)))
    # broadcast while the arrays, as measured, are small; else a shuffle join, split where a source is hot
    longest = rates.agg(F.max(F.size(cdf))).first()[0] or 0
    rates = small_or_not(rates, 128 + 8 * longest)
    drawn = docs.join(rates, F.col(f"`{source}`").eqNullSafe(F.col(src)))
    u = uniform(seed, F.col(f"`{key}`"))
    drawn = drawn.withColumn(n_copies, F.col(low) + F.size(F.filter(F.col(cdf), lambda c: c <= u)))
    copies = drawn.where(F.col(n_copies) > 0).select(
        *[F.col(f"`{c}`") for c in docs.columns], F.col(n_copies), F.col(rate),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(n_copies))).alias(copy))
    order = F.md5(F.concat_ws(":", F.lit(f"{seed}s"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("null")),
                              F.col(copy).cast("string")))
    return copies.withColumn(shuffle_key, order).repartition(F.col(shuffle_key)).sortWithinPartitions(shuffle_key)
