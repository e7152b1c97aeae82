"""Source divergence audit: how the word use of sources of a language differs.

Terms are runs of letters (a-z after A-Z are lowered) and code points above
0x7F. One pass of ``bytes.translate`` lowers letters and blanks every other
ASCII byte, ``bytes.split`` cuts the terms and a Counter per document gives
occurrences; a task adds them up by (lang, source, term), with the number of
documents, and hands on partial counts whenever ``HELD`` entries are held.
Spark sums them by key with a map-side combine.

Each language keeps the V terms that at least ``least`` of its documents hold.
A group (lang, source), and the language itself, give every kept term
p = 1 + floor(10^9 * (count + 5) / (N + 5 V)), N the group's occurrences of
kept terms; so a group is a sparse list of counts and one value for all terms
that it lacks. All arithmetic is on integers (decimals where 64 bits are few).

Parts of the report: ``pair``, for each group every other source of its
language by the sum of |p - q| over the kept terms; ``term``, for each group
the kept terms it holds that it uses more than the language does, by p - q,
``top`` of them.

What grows with the corpus is partitioned by (lang, term): a row there holds at
most one entry per source. The pair sums are added up inside each task, for
``STRIPE`` sources of a language against all of its sources at a time (rows are
sorted by language and stripe, so a task holds one such table), and the sums
of tasks are added by Spark. The report has a row for every ordered pair of
sources of a language, so a language is taken to have thousands of sources, not
millions. The ranking of terms is limited on the map side, so no group meets in
one task.

Defined cases: NULL text, lang and source count as ''; texts without terms and
groups without kept terms have counts of 0; with V = 0 the pair values are 0.
Repeated rows are separate documents. An empty table gives an empty report.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, small_or_not

LEAST, TOP = 30, 50
HELD = 200_000   # (lang, source, term) entries that a task adds up before it hands them on
STRIPE = 256     # sources whose pair sums a task adds up at a time

# Letters are lowered, code points above 0x7F kept, all other bytes blanked.
LETTERS = bytes(b if b >= 0x80 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

COUNTS = "lang string, source string, term string, n bigint, docs bigint"


def terms(text: str) -> list[bytes]:
    """The terms of a text, in order."""
    return text.encode().translate(LETTERS).split()


def _counted(held: int):
    """mapInArrow function: (lang, source, text) -> partial counts. Every group
    also gets an entry for the empty term, with a count of 0."""

    def emit(groups):
        for (lang, source), (n, docs) in groups.items():
            names = [t.decode() for t in n]
            size = len(names) + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * size, pa.string()), pa.array([source] * size, pa.string()),
                 pa.array([*names, ""], pa.string()), pa.array([*n.values(), 0], pa.int64()),
                 pa.array([*map(docs.__getitem__, n), 0], pa.int64())], names=["lang", "source", "term", "n", "docs"])

    def run(batches):
        groups: dict = {}
        size = 0
        for batch in batches:
            for lang, source, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "source", "text"))):
                key = lang or "", source or ""
                if key not in groups:
                    groups[key] = Counter(), Counter()
                n, docs = groups[key]
                size -= len(n)
                own = Counter(terms(text or ""))
                n.update(own)
                docs.update(own.keys())
                size += len(n)
                if size > held:
                    yield from emit(groups)
                    groups, size = {}, 0
        yield from emit(groups)

    return run


def kept_terms(docs: DataFrame, least: int = LEAST, held: int = HELD) -> DataFrame:
    """(lang, term, n, entries: source and its count) of the kept terms, and of
    the empty term, whose entries are all sources of the language."""
    narrow = docs.select(*[F.col(c).cast("string").alias(c) for c in ("lang", "source", "text")])
    counts = (narrow.mapInArrow(_counted(held), COUNTS).groupBy("lang", "source", "term")
                    .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))
    return (counts.groupBy("lang", "term")
                  .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"),
                       F.collect_list(F.struct("source", "n")).alias("entries"))
                  .where((F.col("docs") >= least) | (F.col("term") == "")).drop("docs"))


def _share(n: str, total: str, v: str):
    """1 + floor(10^9 (n + 5) / (total + 5 v)), exact."""
    return F.expr(f"1 + (cast(1000000000 as decimal(11,0)) * cast({n} + 5 as decimal(20,0))) "
                  f"div cast({total} + 5 * {v} as decimal(20,0))").cast("bigint")


def _pair_sums(width: int):
    """mapInArrow function for stripes of ``width`` sources: rows sorted by
    (lang, stripe), each one kept term with ``base`` (p of a term that a source
    lacks) and ``at``, ``p`` of the sources that hold it -> sums of |p - q| over
    the rows of this task."""

    def run(batches):
        now, total, size = None, None, 0

        def emit():
            lang, stripe = now
            for i, row in enumerate(total):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array(np.full(size, stripe * width + i)),
                     pa.array(np.arange(size)), pa.array(row)], names=["lang", "a", "b", "value"])

        for batch in batches:
            lang, stripe, base, at, p = (batch.column(c).to_pylist() for c in ("lang", "stripe", "base", "at", "p"))
            for key, own, places, values in zip(zip(lang, stripe), base, at, p):
                if key != now:
                    if now is not None:
                        yield from emit()
                    now, size = key, len(own)
                    total = np.zeros((min(width, size - key[1] * width), size), np.int64)
                q = np.array(own, np.int64)
                q[places] = values
                mine = q[key[1] * width:key[1] * width + len(total)]
                total += np.abs(mine[:, None] - q[None, :])
        if now is not None:
            yield from emit()

    return run


def divergence_report(docs: DataFrame, least: int = LEAST, top: int = TOP, held: int = HELD) -> DataFrame:
    """(lang, source, part, item, value, rank) of every (lang, source) group."""
    scratch = Scratch(docs.sparkSession)
    found = scratch.keep(kept_terms(docs, least, held))
    lists = found.where("term <> ''")
    flat = lists.select("lang", "term", F.col("n").alias("n_lang"), F.explode("entries").alias("e")).select(
        "lang", "term", "n_lang", F.col("e.source").alias("source"), F.col("e.n").alias("n"))
    langs = lists.groupBy("lang").agg(F.sum("n").alias("n_all"), F.count("*").alias("v"))
    groups = (found.where("term = ''").select("lang", F.explode("entries.source").alias("source"))
                   .join(flat.groupBy("lang", "source").agg(F.sum("n").alias("n_group")), ["lang", "source"], "left")
                   .join(langs, "lang", "left").fillna(0, ["n_group", "n_all", "v"])
                   .withColumn("at", F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1)
                   .withColumn("base", F.when(F.col("v") > 0, _share("0", "n_group", "v"))))
    groups = scratch.keep(groups)
    sized = small_or_not(groups, 256)
    shares = scratch.keep(flat.join(sized, ["lang", "source"])
                              .select("lang", "term", "source", "at", _share("n", "n_group", "v").alias("p"),
                                      _share("n_lang", "n_all", "v").alias("q")))

    ahead = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                                         (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    ahead = ahead.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    bases = groups.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "base"))).alias("b")).select(
        "lang", F.col("b.base").alias("base"))
    stripe = STRIPE
    stripes = F.explode(F.expr(f"sequence(0, cast((size(base) - 1) div {stripe} as int))")).alias("stripe")
    sums = (shares.groupBy("lang", "term").agg(F.collect_list(F.struct("at", "p")).alias("e"))
                  .join(small_or_not(scratch.keep(bases), 32 + 16 * STRIPE), "lang")
                  .select("lang", stripes, "base", F.col("e.at").alias("at"), F.col("e.p").alias("p"))
                  .sortWithinPartitions("lang", "stripe")
                  .mapInArrow(_pair_sums(stripe), "lang string, a bigint, b bigint, value bigint")
                  .groupBy("lang", "a", "b").agg(F.sum("value").alias("value")))
    one = groups.select("lang", "source", F.col("at").alias("a"))
    other = groups.select("lang", F.col("source").alias("item"), F.col("at").alias("b"))
    pairs = (one.join(other, "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
                .select("lang", "source", F.lit("pair").alias("part"), "item",
                        F.coalesce("value", F.lit(0).cast("bigint")).alias("value")))
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(ahead)
