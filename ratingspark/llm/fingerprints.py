"""Document fingerprints: invertible Bloom lookup sketches of paragraphs.

A text is cut into paragraphs, each paragraph into a 64-bit digest. A sketch
has three subtables of cells; a digest goes to one cell of each. A cell holds
a count, the xor of its digests and the xor of their check values. Two
versions' sketches of the same size subtract cell by cell, so shared
paragraphs cancel. Peeling then recovers the rest: a cell with count +-1 whose
check value fits its digest holds exactly one digest of one side, which is
taken out of its other cells, and so on. If cells are left, the pair is tried
again with a sketch twice the size and other cell positions, until every
difference is recovered in full. Likeness is the Jaccard similarity of the
paragraph sets, computed from the recovered digests and the set sizes.

The stored fingerprint is the sketch at the smallest size, a function of the
paragraph set alone, so its length does not grow with the text.

Everything is DataFrame functions. Sketches, differences and all peeling
rounds of an attempt group by the pair's number, so they share one
partitioning and no round shuffles. Texts move once, to meet the start of the
next document.

Paragraphs: every line is cut at the first sentence end after PIECE
characters, at the latest after PIECE + TAIL.

Defined cases: NULL text is empty (no paragraphs; two empty sets are alike:
1.0). Order is by doc_id, NULL first; documents that share a doc_id are
ordered by a hash of their texts. Rows that repeat both are one document in
that order, and each such row is returned. A single document is its own next
one. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, small_or_not

PIECE, TAIL = 80, 240
SUBTABLES = 3
BASE_CELLS = 4        # cells of a subtable in the stored fingerprint
ROUNDS = 12           # peeling steps of an attempt; a step peels one subtable
EDITED, NEXT = 0, 1   # the two comparisons


def paragraphs(text: Column, piece: int = PIECE, tail: int = TAIL) -> Column:
    """array<string>; concatenated they are the text."""
    rule = rf"\n|[^\n]{{1,{piece}}}+[^\n.!?]{{0,{tail}}}+[.!?]*+\n?"
    return F.regexp_extract_all(text, F.lit(rule), F.lit(0))


def digests(text: Column) -> Column:
    """The distinct paragraph digests of a text."""
    return F.array_distinct(F.transform(paragraphs(text), lambda p: F.xxhash64(p)))


def _check(x: Column) -> Column:
    return F.xxhash64(x, F.lit(101))


def _cell(x: Column, j: int, m: Column, attempt: int) -> Column:
    return (F.pmod(F.xxhash64(x, F.lit(j), F.lit(attempt)), m) + F.lit(j) * m).cast("int")


def sketches(sets: DataFrame, attempt: int = 0) -> DataFrame:
    """Difference sketches of rows (uid, kind, m, plus, minus), which must be
    partitioned by uid: (uid, kind, m, cell, c, x, y), cells that are not zero.
    With an empty ``minus`` this is the sketch of ``plus``."""
    sign = lambda s: lambda k: F.struct(k.alias("x"), F.lit(s).cast("bigint").alias("c"))
    items = sets.select("uid", "kind", "m", F.explode(F.concat(F.transform("plus", sign(1)),
                                                               F.transform("minus", sign(-1)))).alias("k"))
    items = items.select("uid", "kind", "m", F.col("k.x").alias("x"), F.col("k.c").alias("c"))
    cells = items.select("uid", "kind", "m", "x", "c", F.explode(F.array(
        *[_cell(F.col("x"), j, F.col("m"), attempt) for j in range(SUBTABLES)])).alias("cell"))
    return (cells.groupBy("uid", "kind", "cell").agg(
        F.max("m").alias("m"), F.sum("c").alias("c"), F.bit_xor("x").alias("x"),
        F.bit_xor(_check(F.col("x"))).alias("y")).where("c <> 0 or x <> 0 or y <> 0"))


def peel(cells: DataFrame, attempt: int = 0, rounds: int = ROUNDS) -> DataFrame:
    """(uid, kind, digest, side): the recovered digests, side 1 or -1; and one
    row with NULL digest per cell that is left, which is a failure of its
    pair. Round r takes pure cells of subtable r mod 3; a digest lies in one
    cell of a subtable, so no digest is taken out twice."""
    state = cells.withColumn("got", F.lit(None).cast("bigint"))
    for r in range(rounds):
        j = r % SUBTABLES
        pure = (F.col("got").isNull() & (F.abs("c") == 1) & (F.floor(F.col("cell") / F.col("m")) == j)
                & (F.col("y") == _check(F.col("x"))) & (F.col("cell") == _cell(F.col("x"), j, F.col("m"), attempt)))
        row = lambda cell, c, x, y, got: F.struct(cell.alias("cell"), c.alias("c"), x.alias("x"), y.alias("y"),
                                                  got.alias("got"))
        none = F.lit(None).cast("bigint")
        taken = [row(_cell(F.col("x"), i, F.col("m"), attempt), -F.col("c"), F.col("x"), F.col("y"), none)
                 for i in range(SUBTABLES) if i != j]
        found = row(F.lit(-1), F.col("c"), F.lit(0).cast("bigint"), F.lit(0).cast("bigint"), F.col("x"))
        stay = row(F.col("cell"), F.col("c"), F.col("x"), F.col("y"), F.col("got"))
        state = (state.select("uid", "kind", "m", F.explode(F.when(pure, F.array(*taken, found))
                                                             .otherwise(F.array(stay))).alias("s"))
                      .select("uid", "kind", "m", "s.*").groupBy("uid", "kind", "cell", "got")
                      .agg(F.max("m").alias("m"), F.sum("c").alias("c"), F.bit_xor("x").alias("x"),
                           F.bit_xor("y").alias("y"))
                      .where("got is not null or c <> 0 or x <> 0 or y <> 0"))
    return state.select("uid", "kind", F.col("got").alias("digest"), F.when(F.col("got").isNotNull(), F.col("c")).alias("side"))


def compare(pairs: DataFrame, scratch: Scratch) -> DataFrame:
    """(uid, kind, n_plus, n_minus, n_diff) for rows (uid, kind, guess, plus,
    minus): the number of differing digests, all of them recovered. ``guess``
    is the expected difference, which sizes the first attempt."""
    done = []
    attempt = 0
    pairs = pairs.select("uid", "kind", "guess", "plus", "minus")
    while True:
        m = ((F.ceil(F.col("guess") * 0.55) + 4) * 2 ** attempt).cast("int")
        sized = pairs.repartition("uid").withColumn("m", m)
        peeled = peel(sketches(sized, attempt), attempt)
        counts = peeled.groupBy("uid", "kind").agg(F.count("digest").alias("n_diff"),
                                                   F.count_if(F.col("digest").isNull()).alias("left"))
        counts, _ = scratch.write(counts)
        done.append(counts.where("left = 0").select("uid", "kind", "n_diff"))
        failed = counts.where("left > 0").select("uid", "kind")
        if failed.isEmpty():
            break
        pairs = scratch.keep(pairs.join(small_or_not(failed, 16), ["uid", "kind"], "left_semi"))
        attempt += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out


def serialised(cells: DataFrame) -> DataFrame:
    """(uid, kind, fingerprint): base64 of the cells of sketches at the
    smallest size, in order: count (16 bits), digest xor (64), check xor
    (low 32)."""
    part = lambda c, digits: F.right(F.lpad(F.hex(c), F.lit(16), F.lit("0")), F.lit(digits))
    entry = F.concat(part("c", 4), part("x", 16), part("y", 8))
    zero = F.lit("0" * 28)
    n = SUBTABLES * BASE_CELLS
    known = cells.groupBy("uid", "kind").agg(F.map_from_entries(F.collect_list(F.struct("cell", entry))).alias("e"))
    text = F.concat_ws("", *[F.coalesce(F.col("e")[F.lit(i)], zero) for i in range(n)])
    return known.select("uid", "kind", F.base64(F.unhex(text)).alias("fingerprint"))


def empty_fingerprint() -> Column:
    return F.base64(F.unhex(F.lit("0" * 28 * SUBTABLES * BASE_CELLS)))


def next_documents(docs: DataFrame, key: str, text: str, scratch: Scratch) -> DataFrame:
    """(id, h, n, next_id, next_h): each distinct (key, text hash) with its
    length and its follower by ascending key. Ids are ranged over partitions
    and written once; followers come from a window inside each part and, at
    its end, from the first row of the next part."""
    ids = docs.select(F.col(f"`{key}`").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("h"),
                      F.length(F.col(f"`{text}`")).alias("n")).distinct()
    ids = scratch.keep(ids.repartitionByRange("id", "h").withColumn("part", F.spark_partition_id()))
    firsts = ids.groupBy("part").agg(F.min(F.struct("id", "h")).alias("first"))
    parts = Window.orderBy("part")  # one row per partition
    after = firsts.select("part", F.lead("first").over(parts).alias("after"),
                          F.first("first").over(parts).alias("very_first"))
    ends = small_or_not(scratch.keep(after.select("part", F.coalesce("after", "very_first").alias("after"))), 64)
    inside = Window.partitionBy("part").orderBy(F.col("id").asc_nulls_first(), "h")
    linked = ids.withColumn("lead", F.lead(F.struct("id", "h")).over(inside)).join(ends, "part")
    follower = F.coalesce("lead", "after")
    return scratch.keep(linked.select("id", "h", "n", follower["id"].alias("next_id"), follower["h"].alias("next_h")))


def fingerprint_documents(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next. The edited text
    has its last quarter replaced by the start of the next document."""
    scratch = Scratch(docs.sparkSession)
    docs = docs.select(F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    links = next_documents(docs, "id", "text", scratch)
    # what a document gives to the one before it
    before = links.select(F.col("next_id").alias("id"), F.col("next_h").alias("h"), F.col("id").alias("to_id"),
                          F.col("h").alias("to_h"), F.col("n").alias("to_n"))
    one = docs.select("id", "text", F.xxhash64("text").alias("h")).withColumnsRenamed({"id": "d_id", "h": "d_h"})
    same = lambda a, b, c, d: a.eqNullSafe(b) & (c == d)
    first_rows = one.join(small_or_not(before, 48), same(F.col("d_id"), F.col("id"), F.col("d_h"), F.col("h")))
    given = (first_rows.select("to_id", "to_h", F.expr("left(text, to_n div 4)").alias("start"),
                               digests(F.col("text")).alias("next_set"))
                       .groupBy("to_id", "to_h").agg(F.first("start").alias("start"), F.first("next_set").alias("next_set")))
    met = one.join(given, same(F.col("d_id"), F.col("to_id"), F.col("d_h"), F.col("to_h")))
    edited = F.concat(F.expr("left(text, length(text) - length(text) div 4)"), F.col("start"))
    sets = scratch.keep(met.withColumn("edited", edited).select(
        F.col("d_id").alias("id"), F.monotonically_increasing_id().alias("uid"),
        F.length("text").cast("bigint").alias("n_chars"), F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        digests(F.col("text")).alias("own"), digests(F.col("edited")).alias("edited"), "next_set"))
    n = lambda c: F.size(c)
    none = F.array().cast("array<bigint>")
    pair = lambda kind, guess, other: F.struct(F.lit(kind).alias("kind"), guess.cast("int").alias("guess"),
                                               F.col("own").alias("plus"), F.col(other).alias("minus"))
    pairs = sets.select("uid", F.explode(F.array(
        pair(EDITED, (n("own") + n("edited")) / 4 + 1, "edited"),
        pair(NEXT, n("own") + n("next_set"), "next_set"))).alias("p")).select("uid", "p.*")
    diffs = compare(pairs, scratch)
    single = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.lit(BASE_CELLS).alias("m"),
                                      F.col(c).alias("plus"), none.alias("minus"))
    base = serialised(sketches(sets.select("uid", "own", "edited").repartition("uid").select(
        "uid", F.explode(F.array(single(EDITED + 2, "own"), single(NEXT + 2, "edited"))).alias("p")).select("uid", "p.*")))
    facts = (diffs.withColumn("fingerprint", F.lit(None).cast("string"))
                  .unionByName(base.withColumn("n_diff", F.lit(None).cast("bigint")))
                  .groupBy("uid").agg(
                      *[F.max(F.when(F.col("kind") == k, F.col(c))).alias(name) for k, c, name in
                        ((EDITED, "n_diff", "d_edited"), (NEXT, "n_diff", "d_next"),
                         (EDITED + 2, "fingerprint", "fingerprint"), (NEXT + 2, "fingerprint", "edited_fingerprint"))]))

    def likeness(a, b, d):
        total, d = n(a) + n(b), F.coalesce(d, F.lit(0))
        return F.when(total == 0, F.lit(1.0)).otherwise((total - d) / (total + d))

    return sets.join(facts, "uid", "left").select(
        F.col("id").alias("doc_id"), "n_chars", "edited_sha256",
        F.coalesce("fingerprint", empty_fingerprint()).alias("fingerprint"),
        F.coalesce("edited_fingerprint", empty_fingerprint()).alias("edited_fingerprint"),
        likeness("own", "edited", F.col("d_edited")).alias("near_edited"),
        likeness("own", "next_set", F.col("d_next")).alias("near_next"))
