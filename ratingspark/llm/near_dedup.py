"""MinHash near-duplicates by tensored banding.

Each text has two small collections of minhash blocks, A and B, of ``blocks``
blocks with ``rows`` hashes each. A table of the LSH scheme is a pair (A block
i, B block j): its key joins the two block keys. So blocks^2 tables of 2 * rows
hashes come from 2 * blocks * rows minhashes, where plain banding would compute
blocks^2 * 2 * rows. A pair at similarity s is a candidate unless no A block or
no B block agrees: it is missed with probability of at most
2 * (1 - s^rows)^blocks, 3.5e-6 at s = 0.85 with the defaults, while texts that
only share a passage (s of 0.3 and less) rarely meet at all.

Steps: (1) one scan computes sizes, set digests and blocks; texts with equal
shingle sets become one node. (2) Only blocks that two nodes share give keys,
so table rows exist for candidates only. (3) In each table bucket all members
are paired with one centre, the smallest id, and pairs are verified on full
shingle sets; links give components. (4) Members of one bucket that are still
in different components are open. Open members that agree in an A block and a
B block are compared too, so no candidate pair that could join two components
is left out; inside a component no pair needs a test, as the result is the
components. Where few share an A block they are paired and verified like
before. A crowded A block is cut into blocks of members, and each pair of
blocks counts its shared shingles as a matrix product in one task, which
returns a spanning forest of the links it finds, never the pairs.

No bucket is collected: buckets are counted by aggregates with a map-side
combine, and joins on bucket keys are shuffle joins that Spark splits at hot
keys. Texts move only for candidates.

Defined cases: NULL and wordless texts have 0 shingles and no links; NULL
doc_id sorts after every id when the smallest is taken; of rows that repeat an
id one is taken as the first. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, chunks, mix64, small_or_not
from ratingspark.llm.components import components
from ratingspark.llm.shingles import shingle_sets, shingles

SHINGLE, PERCENT = 5, 85
BLOCKS, ROWS = 18, 4
HOT = 32        # open members of an A block beyond which pairs are compared in blocks
BLOCK = 1024    # members of a block


def _signer(blocks: int, rows: int, size: int):
    """mapInArrow function: adds n, digest, a and b to (row, text)."""
    rng = np.random.default_rng(20240503)
    mul = rng.integers(1, 1 << 63, (2, blocks, rows), dtype=np.uint64) | np.uint64(1)
    tag = rng.integers(1, 1 << 63, (2, blocks), dtype=np.uint64)

    def sign(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            n = np.zeros(len(texts), np.int64)
            digest = [b""] * len(texts)
            keys = np.zeros((2, len(texts), blocks), np.uint64)
            for lo, hi in chunks(texts, 1 << 18):   # what a chunk's hashes take fits a core's cache
                h, doc = shingles(texts[lo:hi], size)
                if not len(h):
                    continue
                at = np.flatnonzero(np.diff(doc, prepend=-1))
                who = doc[at] + lo
                for i, part in zip(who, np.split(h, at[1:])):
                    u = np.unique(part)
                    n[i] = len(u)
                    digest[i] = hashlib.blake2b(u.tobytes(), digest_size=16).digest()
                hashed = np.empty_like(h)
                for side in range(2):
                    for k in range(blocks):
                        key = np.full(len(at), tag[side, k], np.uint64)
                        for r in range(rows):
                            low = np.minimum.reduceat(np.multiply(h, mul[side, k, r], out=hashed), at)
                            key = mix64(key * np.uint64(31) + low)
                        keys[side, who, k] = key
            arrays = [pa.array(n), pa.array(digest, pa.binary())]
            for side in range(2):
                flat = pa.array(keys[side].reshape(-1).view(np.int64))
                offsets = pa.array(np.arange(len(texts) + 1, dtype=np.int32) * blocks)
                arrays.append(pa.ListArray.from_arrays(offsets, flat))
            yield pa.RecordBatch.from_arrays([batch.column("row"), *arrays], names=["row", "n", "digest", "a", "b"])

    return sign


def _verifier(percent: int, size: int):
    """mapInArrow function: (x, y, text_x, text_y) -> (x, y, linked)."""

    def verify(batches):
        for batch in batches:
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            texts: dict[int, str] = {}
            for ids, col in ((x, "text_x"), (y, "text_y")):
                for i, t in zip(ids, batch.column(col)):
                    if i not in texts:
                        texts[i] = t.as_py() or ""
            sets = dict(zip(texts, shingle_sets(list(texts.values()), size)))
            linked = []
            for i, j in zip(x, y):
                both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                linked.append(100 * both >= percent * (len(sets[i]) + len(sets[j]) - both) and both > 0)
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64()),
                                              pa.array(linked, pa.bool_())], names=["x", "y", "linked"])

    return verify


def _links(pairs: DataFrame, rows: DataFrame, text: str, percent: int, size: int, scratch: Scratch) -> DataFrame:
    """The tested ``pairs`` (x, y) with ``linked``. Only texts of the pairs'
    members move."""
    pairs = scratch.keep(pairs)
    members = scratch.keep(pairs.select(F.explode(F.array("x", "y")).alias("uid")).distinct())
    texts = scratch.keep(rows.select("uid", F.col("row").getField(text).alias("text"))
                             .join(small_or_not(members, 16), "uid", "left_semi"))
    both = (pairs.join(texts.select(F.col("uid").alias("y"), F.col("text").alias("text_y")), "y")
                 .join(texts.select(F.col("uid").alias("x"), F.col("text").alias("text_x")), "x")
                 .select("x", "y", "text_x", "text_y"))
    return scratch.keep(both.mapInArrow(_verifier(percent, size), "x bigint, y bigint, linked boolean"))


def _sets(size: int):
    """mapInArrow function: (uid, text) -> (uid, shingle set as bytes)."""

    def run(batches):
        for batch in batches:
            sets = shingle_sets([t or "" for t in batch.column("text").to_pylist()], size)
            yield pa.RecordBatch.from_arrays([batch.column("uid"), pa.array([x.tobytes() for x in sets], pa.binary())],
                                             names=["uid", "shingles"])
    return run


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """The pairs that join two trees, in order."""
    root = list(range(n))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    out = []
    for i, j in pairs.tolist():
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            out.append((i, j))
    return out


def _compare_blocks(percent: int, columns: int = 4096):
    """applyInArrow function: members of two blocks of an A block (``side`` 0
    and 1; only 0 if it is one block with itself) -> links that span what is
    linked. A pair belongs to the first A block that it shares."""

    def run(unit: pa.Table) -> pa.Table:
        uid, n, label, at = (unit.column(c).to_numpy() for c in ("uid", "n", "label", "at"))
        side = unit.column("side").to_numpy()
        a, b = (np.array(unit.column(c).to_pylist(), np.int64) for c in ("a", "b"))
        sets = [np.frombuffer(x, np.uint64) for x in unit.column("shingles").to_pylist()]
        rows = np.flatnonzero(side == 0)
        cols = np.flatnonzero(side == 1) if (side == 1).any() else rows
        low, high = np.minimum(n[rows, None], n[None, cols]), np.maximum(n[rows, None], n[None, cols])
        mask = (label[rows, None] != label[None, cols]) & (100 * low >= percent * high)
        for t in range(int(at[0])):
            mask &= a[rows, None, t] != a[None, cols, t]
        meet = np.zeros_like(mask)
        for t in range(b.shape[1]):
            meet |= b[rows, None, t] == b[None, cols, t]
        mask &= meet
        if cols is rows:
            mask &= np.tri(len(rows), dtype=bool, k=-1)
        links = []
        if mask.any():
            code = np.unique(np.concatenate(sets), return_inverse=True)[1]
            owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
            often = np.bincount(code) > 1
            place = np.cumsum(often) - 1
            keep = often[code]
            owner, code = owner[keep], place[code[keep]]
            both = np.zeros(mask.shape, np.float32)
            order = np.argsort(code, kind="stable")
            owner, code = owner[order], code[order]
            for lo in range(0, int(code[-1]) + 1 if len(code) else 0, columns):
                i, j = np.searchsorted(code, (lo, lo + columns))
                m = np.zeros((len(sets), columns), np.float32)
                m[owner[i:j], code[i:j] - lo] = 1
                both += m[rows] @ m[cols].T
            mask &= 100 * both >= percent * (n[rows, None] + n[None, cols] - both)
            at_rows, at_cols = np.nonzero(mask)
            links = _forest(np.column_stack([rows[at_rows], cols[at_cols]]), len(uid))
        return pa.table({"x": pa.array([int(uid[i]) for i, _ in links], pa.int64()),
                         "y": pa.array([int(uid[j]) for _, j in links], pa.int64())})
    return run


def _block_links(crowd: DataFrame, open_: DataFrame, signed: DataFrame, text: str, percent: int, size: int, block: int,
                 scratch: Scratch) -> DataFrame:
    """Links inside crowded A blocks, compared block by block."""
    uids = scratch.keep(crowd.select("uid").distinct())
    texts = signed.select("uid", F.col("row").getField(text).alias("text")).join(small_or_not(uids, 16), "uid", "left_semi")
    members = scratch.keep(open_.join(texts.mapInArrow(_sets(size), "uid bigint, shingles binary"), "uid"))
    dealt = crowd.select("key", "at", "uid", F.ceil(F.col("c") / block).cast("int").alias("blocks")).withColumn(
        "own", F.pmod(F.xxhash64("uid"), "blocks").cast("int"))
    units = dealt.select("key", "at", "uid", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    units = units.select("key", "at", "uid", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         (F.col("own") > F.col("other")).cast("int").alias("side"))
    return scratch.keep(units.join(members, "uid").groupBy("key", "i", "j").applyInArrow(
        _compare_blocks(percent), "x bigint, y bigint"))


def _similar_sizes(percent: int):
    """Sets whose sizes differ more cannot reach the threshold."""
    return (F.least("n_x", "n_y") * 100 >= F.greatest("n_x", "n_y") * percent)


def near_components(docs: DataFrame, key: str = "doc_id", text: str = "text", carry: list[str] | None = None,
                    percent: int = PERCENT, size: int = SHINGLE, blocks: int = BLOCKS, rows: int = ROWS,
                    hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """One row per row of ``docs``: struct ``row`` (columns ``carry``, ``key``
    and ``text``; all without it), n_shingles, component_id (smallest ``key``
    reachable over links) and kept (one row of each component)."""
    scratch = Scratch(docs.sparkSession)
    cols = docs.columns if carry is None else list(dict.fromkeys([*carry, key, text]))
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in cols]).alias("row"), F.col(f"`{text}`").alias("text"))
    row_type = packed.schema["row"].dataType.simpleString()
    signed = packed.mapInArrow(_signer(blocks, rows, size), f"row {row_type}, n bigint, digest binary, "
                                                            "a array<bigint>, b array<bigint>")
    signed = scratch.keep(signed.withColumn("uid", F.monotonically_increasing_id()))
    uid_key = F.struct(F.col("row").getField(key).isNull().alias("none"), F.col("row").getField(key).alias("id"),
                       F.col("uid").alias("uid"))
    # nodes: one for each distinct shingle set
    classes = scratch.keep(signed.where("n > 0").select("digest", uid_key.alias("first"))
                                 .groupBy("digest").agg(F.min("first").alias("first")))
    nodes = scratch.keep(signed.select("uid", "n", "a", "b").join(
        classes.select(F.col("first.uid").alias("uid"), "first"), "uid"))
    # blocks that at least two nodes share
    entries = nodes.select("uid", F.explode(F.array_union("a", "b")).alias("key"))
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("key")
    matched = (entries.join(shared, "key").groupBy("uid").agg(F.collect_set("key").alias("hit")).join(nodes, "uid")
                    .select("uid", "n", "first", F.array_intersect("a", "hit").alias("a"),
                            F.array_intersect("b", "hit").alias("b"))
                    .where("size(a) > 0 and size(b) > 0"))
    matched = scratch.keep(matched)
    # table keys: pairs of an A and a B block
    keys = (matched.select("uid", "n", "first", F.explode("a").alias("ka"), "b")
                   .select("uid", "n", "first", "ka", F.explode("b").alias("kb"))
                   .select("uid", "n", "first", F.xxhash64("ka", "kb").alias("key")))
    centres = (keys.select("key", F.struct("first", F.col("n").alias("n")).alias("centre"))
                   .groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("centre").alias("centre")).where("c > 1"))
    buckets = scratch.keep(keys.select("key", "uid", "n").join(centres, "key")
                               .select("key", "uid", "n", F.col("centre.first.uid").alias("x"),
                                       F.col("centre.n").alias("n_x")))
    star = (buckets.select("x", F.col("uid").alias("y"), "n_x", F.col("n").alias("n_y")).where("x <> y")
                   .where(_similar_sizes(percent)).select("x", "y").distinct())
    tested = _links(star, signed, text, percent, size, scratch)
    labels = components(tested.where("linked").select("x", "y"), scratch)
    # members of a bucket that are in different components by now
    tagged = (buckets.select("key", "uid", "n").join(labels, "uid", "left")
                     .select("key", "uid", "n", F.coalesce("label", "uid").alias("label")))
    tagged = scratch.keep(tagged)
    split = (tagged.groupBy("key").agg(F.min("label").alias("lo"), F.max("label").alias("hi"))
                   .where("lo < hi").select("key"))
    open_ = scratch.keep(tagged.join(split, "key").select("uid", "label").distinct()
                               .join(nodes.select("uid", "n", "a", "b"), "uid"))
    shared = open_.select("uid", "n", "label", "b", F.posexplode("a").alias("at", "key"))
    sizes = (shared.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("label").alias("lo"), F.max("label").alias("hi"))
                   .where("lo < hi").select("key", "c"))
    shared = scratch.keep(shared.join(sizes, "key"))
    few = shared.where(F.col("c") <= hot)
    left = few.select("key", F.col("uid").alias("x"), F.col("n").alias("n_x"), F.col("label").alias("l_x"), F.col("b").alias("b_x"))
    right = few.select("key", F.col("uid").alias("y"), F.col("n").alias("n_y"), F.col("label").alias("l_y"), F.col("b").alias("b_y"))
    more = (left.join(right, "key").where("l_x < l_y").where(_similar_sizes(percent)).where(F.arrays_overlap("b_x", "b_y"))
                .select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct())
    seen = tested.select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y"))
    again = _links(more.join(seen, ["x", "y"], "left_anti"), signed, text, percent, size, scratch)
    found = tested.unionByName(again).where("linked").select("x", "y")
    crowd = shared.where(F.col("c") > hot)
    if not crowd.isEmpty():
        found = found.unionByName(_block_links(crowd, open_, signed, text, percent, size, block, scratch))
    labels = components(found, scratch)
    # component of each class, then of each row
    named = (classes.select("digest", "first", F.col("first.uid").alias("uid")).join(labels, "uid", "left")
                    .select("digest", "first", F.coalesce("label", "uid").alias("label")))
    named = scratch.keep(named)
    best = named.groupBy("label").agg(F.min("first").alias("best"))
    named = scratch.keep(named.join(best, "label").select("digest", "best"))
    out = signed.select("row", "uid", "n", "digest").join(small_or_not(named, 64), "digest", "left")
    own = F.col("n") == 0
    return out.select("row", F.col("n").alias("n_shingles"),
                      F.when(own, F.col("row").getField(key)).otherwise(F.col("best.id")).alias("component_id"),
                      (own | (F.col("uid") == F.col("best.uid"))).alias("kept"))


def drop_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component, all columns kept."""
    return near_components(docs, key, text, percent=percent).where("kept").select("row.*")
