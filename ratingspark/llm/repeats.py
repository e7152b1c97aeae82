"""Removal of repeated byte strings by suffix sorting.

A byte goes if a string of ``size`` bytes that covers it starts at another
place too, in any text. Equal strings meet as follows.

1. Candidates. Every window of ``size`` bytes has an anchor: its K-gram with
   the smallest hash, the leftmost if there are several. Equal windows have
   equal anchors at the same offset, so a window whose anchor occurs once in
   the corpus cannot repeat. Windows in a row with the same anchor are one
   context. Contexts that are equal as a whole are one class with a count; the
   bytes of one member stand for all.
2. Shards. Classes are dealt to shards by their anchor, so equal windows meet
   in one shard. A shard's classes are concatenated and their suffixes sorted
   by recursive induced sorting (``induced``). Windows next to each other in
   suffix order are compared word by word up to ``size`` bytes, the only
   common-prefix length that matters, so it is not carried through the queues.
   A window repeats if it equals a neighbour or its class has two members. A
   class that is alone under its anchor needs no sorting.
3. An anchor with more classes than a shard should hold (a passage inside very
   many different surroundings) is not sorted in one task: its windows are
   grouped by (anchor, 128-bit digest of the window) with a map-side combine.
4. Spans go back to all members, are merged by document and cut out.

Documents move only if the spans are too many for a broadcast; anchors and
classes are narrow rows, pre-aggregated where they are counted.

Defined cases: NULL is the empty text; a text shorter than ``size`` has no
windows; rows that repeat an id and text are repeats of each other; NULL ids
are kept as they are. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, mix64, powers, small_or_not
from ratingspark.llm.induced import suffix_array

SIZE = 200
K = 64                        # anchor length
BLOCK = 1 << 20               # windows looked at at once
SHARD_BYTES = 1 << 20         # class bytes in a shard, on average
LARGE_ANCHOR_BYTES = 4 << 20  # an anchor with more is split by windows

_BYTES = np.random.default_rng(20240601).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


class _Powers:
    """Powers of the base and of its inverse modulo 2^64, as many as asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int):
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            self.up, self.down = powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
        return self.up[:n], self.down[:n]


def _prefix(b: np.ndarray, known: _Powers, which: int) -> np.ndarray:
    up, _ = known.get(len(b) + 1)
    out = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTES[which][b] * up[:len(b)], dtype=np.uint64, out=out[1:])
    return out


def _hashes(prefix, lo, hi, known: _Powers) -> np.ndarray:
    """Hashes of the byte ranges [lo, hi)."""
    _, down = known.get(len(prefix))
    return mix64((prefix[hi] - prefix[lo]) * down[lo])


def contexts(b: np.ndarray, size: int, k: int, known: _Powers, block: int = BLOCK):
    """For a text of at least ``size`` bytes: (first window, windows, anchor
    hash, hash of the context's bytes) of its contexts, in blocks."""
    w = size - k + 1
    for lo in range(0, len(b) - size + 1, block):
        part = b[lo:lo + block + size - 1]
        p = _prefix(part, known, 0)
        n = len(part) - k + 1
        _, down = known.get(len(p))
        h = mix64((p[k:] - p[:n]) * down[:n])
        bits = np.uint64(max(1, int(n).bit_length()))
        mask = (np.uint64(1) << bits) - np.uint64(1)
        m = (h & ~mask) | np.arange(n, dtype=np.uint64)  # ties: the leftmost
        s = 1
        while 2 * s <= w:
            m = np.minimum(m[:-s], m[s:])
            s *= 2
        if w > s:
            m = np.minimum(m[:len(m) - (w - s)], m[w - s:])
        first = np.flatnonzero(np.diff(m, prepend=~m[:1]))
        last = np.append(first[1:], len(m))
        anchor = h[(m[first] & mask).astype(np.int64)]
        q = _prefix(part, known, 1)
        yield first + lo, last - first, anchor, _hashes(q, first, last + size - 1, known)


def _anchor_rows(size: int, k: int):
    """mapInArrow function: (uid, text) -> contexts of the texts."""

    def run(batches):
        known = _Powers()
        names = ("uid", "pos", "n", "anchor", "body")
        for batch in batches:
            out = {c: [] for c in names}
            for uid, t in zip(batch.column("uid").to_pylist(), batch.column("text")):
                raw = (t.as_py() or "").encode()
                if len(raw) < size:
                    continue
                for pos, n, anchor, body in contexts(np.frombuffer(raw, np.uint8), size, k, known):
                    for c, v in zip(names, (np.full(len(pos), uid), pos, n, anchor.view(np.int64), body.view(np.int64))):
                        out[c].append(v)
            cols = [np.concatenate(out[c]) if out[c] else np.empty(0, np.int64) for c in names]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0].astype(np.int64)), pa.array(cols[1].astype(np.int64)),
                                              pa.array(cols[2].astype(np.int32)), pa.array(cols[3]), pa.array(cols[4])],
                                             names=list(names))
    return run


def repeated_windows(bodies: list[bytes], counts: list[int], size: int) -> list[np.ndarray]:
    """For each class (bytes of a context, members): which of its windows
    repeat, as flags. All classes of an anchor must be there."""
    n = len(bodies)
    lengths = np.array([len(b) for b in bodies])
    starts = np.cumsum(lengths + 1) - lengths - 1
    raw = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
    t = raw.astype(np.int32) + 2
    t[starts + lengths] = 1          # separators
    sa = suffix_array(np.append(t, np.int32(0)))
    windows = lengths - size + 1
    own = np.repeat(np.arange(n), lengths + 1)
    valid = np.arange(len(raw)) - starts[own] < windows[own]
    sa = sa[sa < len(raw)]
    sa = sa[valid[sa]]
    # neighbours that share ``size`` bytes, compared eight at a time
    pad = np.append(raw, np.zeros(8, np.uint8))
    words = np.lib.stride_tricks.as_strided(pad, (len(raw), 8), (1, 1)).copy().view(np.uint64).ravel()
    a, b, pair = sa[:-1], sa[1:], np.arange(max(len(sa) - 1, 0))
    for at in [*range(0, size - 7, 8), size - 8]:
        same = words[a + at] == words[b + at]
        a, b, pair = a[same], b[same], pair[same]
    flags = np.zeros(len(raw), bool)
    flags[sa[pair]] = True
    flags[sa[pair + 1]] = True
    return [np.ones(w, bool) if c > 1 else flags[s:s + w] for s, w, c in zip(starts, windows, counts)]


def runs(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2])]


SPANS = "array<struct<lo:int,hi:int>>"
_SPANS = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))


def _sort_shard(size: int):
    def run(shard: pa.Table) -> pa.Table:
        flags = repeated_windows(shard.column("bytes").to_pylist(), shard.column("members").to_pylist(), size)
        return pa.table([shard.column("anchor"), shard.column("body"), pa.array([runs(f) for f in flags], _SPANS)],
                        names=["anchor", "body", "spans"])
    return run


def _window_rows(size: int):
    """mapInArrow function: classes -> (anchor, body, at, window digest, members)."""

    def run(batches):
        for batch in batches:
            rows = {c: [] for c in ("anchor", "body", "at", "window", "members")}
            for r in batch.to_pylist():
                for i in range(len(r["bytes"]) - size + 1):
                    for c, v in (("anchor", r["anchor"]), ("body", r["body"]), ("at", i), ("members", r["members"]),
                                 ("window", hashlib.blake2b(r["bytes"][i:i + size], digest_size=16).digest())):
                        rows[c].append(v)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["anchor"], pa.int64()), pa.array(rows["body"], pa.int64()), pa.array(rows["at"], pa.int32()),
                 pa.array(rows["window"], pa.binary()), pa.array(rows["members"], pa.int64())], names=list(rows))
    return run


def _merge(batches):
    """Rows (uid, lo, hi), sorted by uid and lo -> the same with overlapping
    and touching ranges of a uid merged. The open range of the last uid waits
    for the next batch."""
    schema = pa.schema([("uid", pa.int64()), ("lo", pa.int64()), ("hi", pa.int64())])
    wait = [np.empty(0, np.int64)] * 3
    for batch in chain(batches, [None]):
        uid, lo, hi = wait if batch is None else (
            np.concatenate([w, batch.column(c).to_numpy(zero_copy_only=False)]) for w, c in zip(wait, schema.names))
        if not len(uid):
            continue
        base = np.cumsum(np.diff(uid, prepend=uid[:1]) != 0) << 40     # keeps documents apart
        top = np.maximum.accumulate(base + hi)
        first = np.append(0, np.flatnonzero(base[1:] + lo[1:] > top[:-1]) + 1)
        last = np.append(first[1:], len(uid)) - 1
        merged = [uid[first], lo[first], (top - base)[last]]
        if batch is not None:
            wait = [m[-1:] for m in merged]
            merged = [m[:-1] for m in merged]
        yield pa.RecordBatch.from_arrays([pa.array(m) for m in merged], schema=schema)


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = SIZE, k: int = K,
                   shard_bytes: int = SHARD_BYTES, large_anchor_bytes: int = LARGE_ANCHOR_BYTES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, cuts (removed byte ranges
    lo, hi; merged, in order) and kept (the remaining bytes)."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(docs.select(F.monotonically_increasing_id().alias("uid"), F.col(f"`{key}`").alias("doc_id"),
                                    F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))
    found = rows.select("uid", "text").mapInArrow(_anchor_rows(size, k),
                                                  "uid bigint, pos bigint, n int, anchor bigint, body bigint")
    twice = found.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    found = scratch.keep(found.join(twice, "anchor"))
    # classes of equal contexts, with one member each to fetch bytes from
    classes = (found.groupBy("anchor", "body").agg(F.count(F.lit(1)).alias("members"),
                                                   F.min(F.struct("uid", "pos", "n")).alias("one")))
    classes = scratch.keep(classes.select("anchor", "body", "members", "one.*"))
    whole = F.array(F.struct(F.lit(0).alias("lo"), F.col("n").alias("hi"))).cast(SPANS)
    anchors = scratch.keep(classes.groupBy("anchor").agg(F.count(F.lit(1)).alias("classes"),
                                                         F.sum(F.col("n") + size - 1).alias("bytes")))
    several = anchors.where("classes > 1")
    total = several.where(F.col("bytes") <= large_anchor_bytes).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    shards = max(1, math.ceil(total / shard_bytes))
    alone = classes.join(anchors.where("classes = 1").select("anchor"), "anchor").select("anchor", "body", whole.alias("spans"))
    # bytes of the classes to compare
    wanted = scratch.keep(classes.join(several.select("anchor", F.col("bytes").alias("anchor_bytes")), "anchor"))
    binary = F.col("text").cast("binary")
    bytes_of = rows.select("uid", "text").join(wanted, "uid").select(
        "anchor", "body", "members", "anchor_bytes",
        F.substring(binary, (F.col("pos") + 1).cast("int"), (F.col("n") + size - 1).cast("int")).alias("bytes"))
    bytes_of = scratch.keep(bytes_of)
    small = bytes_of.where(F.col("anchor_bytes") <= large_anchor_bytes)
    sorted_ = (small.select("anchor", "body", "members", "bytes", F.pmod("anchor", F.lit(shards)).alias("shard"))
                    .groupBy("shard").applyInArrow(_sort_shard(size), f"anchor bigint, body bigint, spans {SPANS}"))
    large = bytes_of.where(F.col("anchor_bytes") > large_anchor_bytes)
    spans = alone.unionByName(sorted_)
    if not large.isEmpty():
        windows = scratch.keep(large.mapInArrow(_window_rows(size),
                                                "anchor bigint, body bigint, at int, window binary, members bigint"))
        again = windows.groupBy("anchor", "window").agg(F.sum("members").alias("m")).where("m > 1").select("anchor", "window")
        hit = windows.join(again, ["anchor", "window"]).groupBy("anchor", "body").agg(
            F.collect_list(F.struct(F.col("at").alias("lo"), (F.col("at") + 1).alias("hi"))).cast(SPANS).alias("spans"))
        spans = spans.unionByName(hit)
    spans = scratch.keep(spans.where(F.size("spans") > 0))
    ranges = (found.select("anchor", "body", "uid", "pos").join(spans, ["anchor", "body"])
                   .select("uid", "pos", F.explode("spans").alias("s"))
                   .select("uid", (F.col("pos") + F.col("s.lo")).alias("lo"), (F.col("pos") + F.col("s.hi") - 1 + size).alias("hi")))
    merged = ranges.repartition("uid").sortWithinPartitions("uid", "lo").mapInArrow(_merge, "uid bigint, lo bigint, hi bigint")
    cuts = scratch.keep(merged.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("cuts")))
    n_cuts = cuts.agg(F.coalesce(F.sum(F.size("cuts")), F.lit(0))).first()[0]
    n_docs = max(1, cuts.count())
    joined = rows.join(small_or_not(cuts, 32 + 16 * math.ceil(n_cuts / n_docs)), "uid", "left")
    joined = joined.select("doc_id", binary.alias("raw"), F.coalesce("cuts", F.array().cast(cuts.schema["cuts"].dataType))
                           .alias("cuts"))
    n = F.length("raw").cast("bigint")
    ends = F.concat(F.transform("cuts", lambda c: c["lo"]), F.array(n))
    begins = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("cuts", lambda c: c["hi"]))
    pieces = F.zip_with(begins, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    kept = F.aggregate(pieces, F.lit(b""), lambda acc, p: F.concat(acc, F.substring(
        F.col("raw"), (p["a"] + 1).cast("int"), (p["b"] - p["a"]).cast("int"))))
    return joined.select("doc_id", n.alias("n_bytes"), "cuts",
                         F.when(F.size("cuts") == 0, F.col("raw")).otherwise(kept).alias("kept"))
