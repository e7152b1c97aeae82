"""Benchmark decontamination: documents that hold n-grams of test items.

Words are runs of 0-9, a-z and code points above 0x7F after A-Z are lowered.
The windows of an item are all runs of ``size`` consecutive words (an item of
fewer words is one window of all of them). A window of n words that occurs in
a document covers one of its word positions 0, k, 2k, ... together with the s
words from there on, if k + s - 1 <= n; so only these s-grams of documents are
hashed (k = 5, s = 6 for windows of 10 words), and the hash set holds the
s-grams at the first k places of every distinct window, with the window and
the place. Each hit is verified on all words of the window, so the result is
exact, and every occurrence is found once. Documents are scanned in chunks of
words. Hits of a document merge into spans of word positions, which can be
removed from the text, or the document is dropped.

All steps are DataFrame functions. Only the window set is broadcast, after its
size is measured; a larger set is dealt by hash into as many sets under the
bound, each of which scans the documents once. Document n-grams never move:
only hits are shuffled, by document. Hits of one document meet in one task,
at most one for each of its words and window lengths. A window that many items
share is kept once; (window, item) pairs join with the distinct windows of a
document, so a document's items cost what its list of items holds.

Defined cases: NULL and wordless texts have no words and are clean; items
without words have no windows; item ids are compared as strings, a NULL id as
''; items that repeat an id are one item; repeated document rows are separate
rows. Empty documents give an empty result, an empty benchmark clean ones.
Memory of a task is bounded by one text and its words, plus one chunk of
``CHUNK`` words.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import BROADCAST_BYTES, Scratch, ascii_lower, small_or_not

SIZE = 10
CHUNK = 4096    # words of a chunk, about
# The characters (after lower-casing A-Z) that are no part of a word.
OTHER = r"\x00-\x2F\x3A-\x60\x7B-\x7F"
OTHER_RAW = r"\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F"


def normalised(text: Column) -> Column:
    """The words of a text, joined by single spaces."""
    return F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), f"[{OTHER}]+", " "))


def _words(norm: Column) -> Column:
    return F.when(norm == "", F.array().cast("array<string>")).otherwise(F.split(norm, " "))


def seed(n: int) -> tuple[int, int]:
    """(s, k): words of an s-gram and the step between places where documents
    are probed, for windows of n words."""
    return (n + 2) // 2, n + 1 - (n + 2) // 2


def benchmark_windows(benchmark: DataFrame, scratch: Scratch, size: int = SIZE) -> tuple[DataFrame, DataFrame]:
    """(wid, len, words) of the distinct windows, and (wid, item)."""
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                             _words(normalised(F.col("text"))).alias("words")).where("size(words) > 0")
    cut = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - size, F.lit(0)) + 1),
                      lambda i: F.slice("words", i, F.lit(size)))
    pairs = scratch.keep(items.select("item", F.explode(cut).alias("words")).distinct())
    windows = scratch.keep(pairs.select("words").distinct().select(
        F.monotonically_increasing_id().alias("wid"), F.size("words").alias("len"), "words"))
    return windows, scratch.keep(pairs.join(windows, "words").select("wid", "item"))


def hash_sets(windows: DataFrame, lengths: list[int], limit: int = BROADCAST_BYTES) -> list[DataFrame]:
    """(hash, back, wid, len, item_words): the s-grams of the windows, ``back``
    words from the window's start, in sets of at most about ``limit`` bytes by
    hash. The hash also holds the window's length."""
    parts = []
    for n in lengths:
        s, k = seed(n)
        grams = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.xxhash64(F.lit(n), F.slice("words", i + 1, F.lit(s))))
        parts.append(windows.where(F.col("len") == n).select(F.posexplode(grams).alias("back", "hash"), "wid", "len",
                                                             F.col("words").alias("item_words")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    size = out.agg(F.sum(F.length(F.array_join("item_words", " ")) + 16 * F.col("len") + 64)).first()[0] or 0
    sets = -(-size // limit)
    return [out.where(F.pmod("hash", F.lit(sets)) == j) if sets > 1 else out for j in range(sets)]


def _hits(base: DataFrame, windows: DataFrame, lengths: list[int], limit: int, chunk: int) -> DataFrame:
    """(uid, pos, len, wid) of every window of the documents that is in the set."""
    most, lead = max(lengths), max(seed(n)[1] for n in lengths) - 1
    step = math.lcm(*(seed(n)[1] for n in lengths))
    chunk = -(-chunk // step) * step    # so that chunks begin where all lengths probe
    first = F.explode(F.sequence(F.lit(0), F.col("n_words") - 1, F.lit(chunk)))
    before = F.least(F.col("start"), F.lit(lead))
    chunks = (base.where(F.col("n_words") >= min(lengths)).select("uid", _words(F.col("norm")).alias("all_words"),
                                                                  first.alias("start"))
                  .select("uid", "start", before.alias("before"),
                          F.slice("all_words", F.col("start") - before + 1, before + (chunk + most)).alias("words")))

    def probes(n):
        s, k = seed(n)
        last = F.least(F.size("words") - F.col("before") - s, F.lit(chunk - 1))
        places = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(k))).otherwise(F.array().cast("array<int>"))
        return F.transform(places, lambda i: F.struct(
            (i + F.col("before")).alias("at"), F.xxhash64(F.lit(n), F.slice("words", i + F.col("before") + 1, F.lit(s))).alias("h")))

    every = chunks.select("uid", "start", "before", "words", F.explode(F.concat(*[probes(n) for n in lengths])).alias("p"))
    every = every.select("uid", "start", "before", "words", "p.at", "p.h")
    begin = F.col("at") - F.col("back")
    # compared word by word, not as an array: the hash alone stays the join key
    same = (begin >= 0) & F.forall(F.zip_with(F.slice("words", F.greatest(begin, F.lit(0)) + 1, F.col("len")), "item_words",
                                              lambda a, b: a.eqNullSafe(b)), lambda x: x)
    out = None
    for part in hash_sets(windows, lengths, limit):
        hit = every.join(F.broadcast(part), (F.col("h") == F.col("hash")) & same)
        hit = hit.select("uid", (F.col("start") - F.col("before") + begin).alias("pos"), "len", "wid")
        out = hit if out is None else out.unionAll(hit)
    return out


def contamination(docs: DataFrame, benchmark: DataFrame, carry: list[str] | None = None, size: int = SIZE,
                  limit: int = BROADCAST_BYTES, chunk: int = CHUNK) -> DataFrame:
    """One row per document: ``row`` (a struct of ``carry``, all columns by
    default), ``n_words``, ``spans`` (array of hit word ranges lo <= i < hi),
    ``items`` (sorted ids, as strings, of items with windows in it)."""
    scratch = Scratch(docs.sparkSession)
    windows, pairs = benchmark_windows(benchmark, scratch, size)
    norm = normalised(F.col("text"))
    row = F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)])
    base = scratch.keep(docs.select(F.monotonically_increasing_id().alias("uid"), row.alias("row"), norm.alias("norm"))
                            .withColumn("n_words", F.when(F.col("norm") == "", 0).otherwise(
                                F.length("norm") - F.length(F.replace("norm", F.lit(" "), F.lit(""))) + 1).cast("int")))
    lengths = sorted(r[0] for r in windows.select("len").distinct().collect())   # size numbers at most
    span = "array<struct<lo:int,hi:int>>"
    if not lengths:
        return base.select("row", F.col("n_words").cast("bigint"), F.array().cast(span).alias("spans"),
                           F.array().cast("array<string>").alias("items"))
    hits = scratch.keep(_hits(base, windows, lengths, limit, chunk))
    # islands of overlapping or touching hits of a document
    along = Window.partitionBy("uid").orderBy("pos", "len")
    before = F.max(F.col("pos") + F.col("len")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    ranges = hits.groupBy("uid", "pos").agg(F.max("len").alias("len"))
    islands = (ranges.withColumn("new", (F.col("pos") > F.coalesce(before, F.lit(-1))).cast("int"))
                     .withColumn("island", F.sum("new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
                     .groupBy("uid", "island").agg(F.min("pos").alias("lo"), F.max(F.col("pos") + F.col("len")).alias("hi"))
                     .groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans")))
    named = (hits.select("uid", "wid").distinct().join(pairs, "wid").groupBy("uid")
                 .agg(F.array_sort(F.collect_set("item")).alias("items")))
    found = scratch.keep(islands.join(named, "uid"))
    found_bytes = 64 + 16 * (found.agg(F.avg(F.size("spans") + F.size("items"))).first()[0] or 0)
    return (base.drop("norm").join(small_or_not(found, int(found_bytes)), "uid", "left")
                .select("row", F.col("n_words").cast("bigint"),
                        F.coalesce("spans", F.array().cast(span)).alias("spans"),
                        F.coalesce("items", F.array().cast("array<string>")).alias("items")))


def hit_words(spans: str = "spans") -> Column:
    """Number of words in the spans."""
    return F.aggregate(spans, F.lit(0).cast("bigint"), lambda acc, s: acc + s["hi"] - s["lo"])


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the words in ``spans`` and the separators after them."""
    word = f"[^{OTHER_RAW}]+[{OTHER_RAW}]*"
    lead = F.regexp_extract(text, f"^[{OTHER_RAW}]*", 0)
    tokens = F.regexp_extract_all(text, F.lit(f"({word})"), 1)
    ends = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["hi"]))
    begins = F.concat(F.transform(spans, lambda s: s["lo"]), F.array(F.size(tokens)))
    kept = F.zip_with(ends, begins, lambda a, b: F.slice(tokens, a + 1, b - a))
    return F.when(F.size(spans) == 0, text).otherwise(F.concat(lead, F.array_join(F.flatten(kept), "")))


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = SIZE) -> DataFrame:
    """The documents without contaminated ones (``remove="documents"``), or
    with the contaminated words cut out of their texts (``"spans"``)."""
    found = contamination(docs, benchmark, size=size)
    if remove == "documents":
        return found.where(F.size("spans") == 0).select("row.*")
    cols = [without_spans(F.col("row.text"), F.col("spans")).alias("text") if c == "text" else F.col(f"row.`{c}`")
            for c in docs.columns]
    return found.select(*cols)
