"""Near-equal lines by a segment-partition edit join.

Distinct lines of at least ``min_chars`` code points are joined when their
edit distance is at most ``tau``. A line of length l is cut into tau + 1 even
segments; whatever tau edits do, one segment survives, at a place that the
lengths and the segment's number restrict to a few. So every line indexes its
segments under (length, number, content) and probes, for each length from its
own down to tau less, the substrings that can be a surviving segment (the
multi-match-aware choice: no more edits left of it than its number allows, and
no more right of it than the rest). Lines that meet under a key are
candidates, verified on whole lines: what both have in common at the ends is
cut off, the middles go through a banded bit-parallel edit distance, many pairs
at once, dealt to chunks of ``CELLS`` rows x columns by length. Middles of over
``WIDE`` characters follow the same band diagonal by diagonal, as far as
characters agree, so that a pair of very long lines costs a few comparisons of
arrays instead of a step a column. Components of links are classes.

Keys are 64-bit hashes of code points, made in numpy for many lines at once;
they only choose candidates. Keys are joined by a shuffle join that Spark
splits at hot keys. A key that very many lines share is not turned into pairs:
its index lines and its probe lines are dealt to blocks of about ``block`` lines
each, and blocks are verified against blocks inside tasks, so only links come
out. Candidate pairs go to tasks in a number that follows their characters.

A line is known by two independent 64-bit hashes of its text (128 bits), which
are numbered; lines that share the first hash alone are told apart when they
are verified. Shorter lines are equal or different, nothing in between.

Defined cases: NULL text has one empty line, as the empty text has; lines end
at \\n only; NULL doc_ids sort after all others when the first place of a line
is chosen; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, mix64, powers, small_or_not
from ratingspark.llm.components import components

TAU = 2
MIN_CHARS = 20
BLOCK = 256          # lines of a hot key that one task compares with as many others
HOT = 8              # a key with more indexed lines is verified in blocks
WIDE = 2048          # characters of a middle beyond which the band is followed along its diagonals
CELLS = 1 << 22      # rows x columns of pairs that advance together
PAIR_CHARS = 1 << 23  # characters of candidate pairs a task verifies

SECOND = 20240702    # seeds the second hash of a line
_BASE = 0x9E3779B97F4A7C15
_SALT = np.random.default_rng(20240701).integers(1, 1 << 63, 64, dtype=np.uint64)


def segment(length, i: int, tau: int):
    """(start, size) of segment i (from 0) of lines of ``length``: even cuts,
    the longer ones last."""
    size, more = length // (tau + 1), length % (tau + 1)
    longer = np.maximum(0, i - (tau + 1 - more))
    return i * size + longer, size + (i >= tau + 1 - more)


class _Hasher:
    """Hashes of substrings of many lines laid end to end."""

    def __init__(self, lines: list[str]):
        self.length = np.array([len(x) for x in lines], np.int64)
        self.start = np.cumsum(self.length) - self.length
        code = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = len(code) + 1
        up, down = powers(_BASE, n), powers(pow(_BASE, -1, 1 << 64), n)
        self.prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(code + _SALT[63]) * up[:-1], dtype=np.uint64)])
        self.down = down

    def get(self, which, lo, size):
        a = self.start[which] + lo
        return (self.prefix[a + size] - self.prefix[a]) * self.down[a]


def keys(lines: list[str], tau: int):
    """(line index, key, probe?) of the index and probe entries of ``lines``."""
    h = _Hasher(lines)
    which = np.arange(len(lines))
    out = []
    for i in range(tau + 1):
        start, size = segment(h.length, i, tau)
        tag = _SALT[i]
        out.append((which, mix64(h.get(which, start, size) + tag + mix64(h.length.astype(np.uint64))), False))
        for less in range(tau + 1):
            length = h.length - less      # of the shorter line
            start, size = segment(length, i, tau)
            right = tau - i
            for shift in range(-tau, tau + 1):
                # shift of the substring against the segment: left of it at
                # most i edits, right of it at most tau - i
                if not (abs(shift) <= i and abs(shift - less) <= right):
                    continue
                lo = start + shift
                ok = (lo >= 0) & (lo + size <= h.length) & (size > 0)
                w = which[ok]
                out.append((w, mix64(h.get(w, lo[ok], size[ok]) + tag + mix64(length[ok].astype(np.uint64))), True))
    return (np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out]),
            np.concatenate([np.full(len(o[0]), o[2]) for o in out]))


def _laid(lines: list[np.ndarray], before: int, width: int, fill: int) -> np.ndarray:
    out = np.full((len(lines), width), fill, np.uint32)
    for i, x in enumerate(lines):
        out[i, before:before + len(x)] = x
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the common prefix, looked for in growing pieces."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(at + step, n)
        differ = a[at:end] != b[at:end]
        k = int(differ.argmax())
        if differ[k]:
            return at + k
        at, step = end, step * 4
    return n


def middles(a: np.ndarray, b: np.ndarray, tau: int) -> tuple[np.ndarray, np.ndarray]:
    """The lines without what they have in common at both ends, but for tau + 1
    characters, so that what is left is longer than tau."""
    lo = max(0, _agree(a, b) - tau - 1)
    a, b = a[lo:], b[lo:]
    keep = tau + 1
    hi = min(_agree(a[keep:][::-1], b[keep:][::-1]), len(a) - keep, len(b) - keep)
    return (a[:len(a) - hi], b[:len(b) - hi]) if hi > 0 else (a, b)


def _along_diagonals(a: np.ndarray, b: np.ndarray, tau: int) -> bool:
    """Is the edit distance at most tau? The furthest row that e edits reach on
    each diagonal of the band, for e up to tau; equal characters are passed
    many at a time."""
    m, n = len(a), len(b)
    far = {}
    for e in range(tau + 1):
        new = {}
        for k in range(-e, e + 1):      # column less row
            if e == 0:
                i = 0
            else:
                i = max(far.get(k - 1, -1), far.get(k, -2) + 1, far.get(k + 1, -2) + 1)
            i = min(i, m, n - k)
            if i < 0 or i + k < 0:
                continue
            i += _agree(a[i:], b[i + k:])
            if i == m and i + k == n:
                return True
            new[k] = i
        far = new
    return False


def within(a: list[str], b: list[str], tau: int) -> np.ndarray:
    """Flags: the edit distance of a[i] and b[i] is at most tau. Lines must be
    longer than tau."""
    out = np.zeros(len(a), bool)
    short, p, t = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        if abs(len(x) - len(y)) > tau:
            continue
        x, y = middles(*(np.frombuffer(z.encode("utf-32-le"), np.uint32) for z in (x, y)), tau)
        if max(len(x), len(y)) > WIDE:
            out[i] = _along_diagonals(x, y, tau)
        else:
            short.append(i)
            p.append(x)
            t.append(y)
    order = sorted(range(len(short)), key=lambda k: len(t[k]))
    at = 0
    while at < len(order):
        end, widest = at, 0
        while end < len(order):
            widest = max(widest, len(p[order[end]]), len(t[order[end]]))
            if end > at and (end - at + 1) * widest > CELLS:
                break
            end += 1
        some = order[at:end]
        out[[short[k] for k in some]] = _banded([p[k] for k in some], [t[k] for k in some], tau)
        at = end
    return out


def _banded(a: list[np.ndarray], b: list[np.ndarray], tau: int) -> np.ndarray:
    """``within`` for lines given as code points.

    One word a pair holds the band of 2 tau + 1 diagonals, the lowest row in
    the top bit, as vertical differences (vp: +1, vn: -1); a column advances
    all pairs. The distance is followed down the lowest diagonal of the band to
    the last row, then along that row."""
    n = len(a)
    out = np.zeros(n, bool)
    m, width = np.array([len(x) for x in a], np.int64), np.array([len(x) for x in b], np.int64)
    live = np.arange(n)
    bits = 2 * tau + 2
    full, top = (1 << bits) - 1, 1 << (bits - 1)
    p = _laid(a, tau, int(m.max()) + 4 * tau + 2, 0xFFFFFFFF)
    t = _laid(b, 0, int(width.max()), 0xFFFFFFFE)
    weight = (1 << np.arange(1, bits, dtype=np.int64))
    vp = np.full(len(live), full ^ ((1 << (bits - tau - 1)) - 1), np.int64)
    vn = np.zeros(len(live), np.int64)
    dist = np.full(len(live), tau, np.int64)
    for j in range(1, int(width.max()) + 1):
        eq = (p[:, j - 1:j + bits - 2] == t[:, j - 1:j]) @ weight
        d0 = ((((eq & vp) + vp) ^ vp) | eq | vn) & full
        hp = (vn | ~(d0 | vp)) & full
        hn = d0 & vp
        down = j <= m - tau
        row = top >> np.clip(j - (m - tau), 0, bits - 1)
        dist += np.where(down, (d0 & top) == 0, ((hp & row) != 0).astype(np.int64) - ((hn & row) != 0))
        half = d0 >> 1
        vp = (hn | ~(half | hp)) & full
        vn = half & hp
        ended = width == j
        if ended.any() or j % 8 == 0:
            out[live[ended & (dist <= tau)]] = True
            # along the last row the distance can fall by one a column
            stay = ~ended & (dist <= tau + width - np.maximum(j, m - tau))
            if not stay.any():
                break
            if not stay.all():
                live, p, t, m, width, vp, vn, dist = (x[stay] for x in (live, p, t, m, width, vp, vn, dist))
    return out


def _key_rows(tau: int):
    """mapInArrow function: (lid, line) -> (key, lid, probe). A line that
    repeats within a task is entered once."""

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            lids, lines = [], []
            for lid, line in zip(batch.column("lid").to_pylist(), batch.column("line")):
                if lid not in seen:
                    seen.add(lid)
                    lids.append(lid)
                    lines.append(line.as_py())
            lids = np.array(lids, np.int64)
            at, size = 0, 0
            for i in range(len(lines) + 1):
                if i == len(lines) or size > 1 << 20:
                    if i > at:
                        which, key, probe = keys(lines[at:i], tau)
                        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(lids[at:i][which]),
                                                          pa.array(probe)], names=["key", "lid", "probe"])
                    at, size = i, 0
                if i < len(lines):
                    size += len(lines[i])
    return run


def _verify_pairs(tau: int):
    def run(batches):
        for batch in batches:
            for part in range(0, batch.num_rows, 2048):
                some = batch.slice(part, 2048)
                ok = within(some.column("line_x").to_pylist(), some.column("line_y").to_pylist(), tau)
                yield some.select(["x", "x2", "y", "y2"]).filter(pa.array(ok))
    return run


def _verify_block(tau: int):
    """applyInArrow function: the index and probe lines of a block of a hot
    key -> linked pairs."""

    def run(block: pa.Table) -> pa.Table:
        rows = block.to_pylist()
        index = [((r["lid"], r["lid2"]), r["line"]) for r in rows if not r["probe"]]
        probe = [((r["lid"], r["lid2"]), r["line"]) for r in rows if r["probe"]]
        found = []
        for i, line in index:
            others = [(j, x) for j, x in probe if j != i and abs(len(x) - len(line)) <= tau]
            ok = within([line] * len(others), [x for _, x in others], tau)
            found += [(*min(i, j), *max(i, j)) for (j, _), good in zip(others, ok) if good]
        return pa.table({c: pa.array([f[k] for f in found], pa.int64()) for k, c in enumerate(("x", "x2", "y", "y2"))})
    return run


def distinct_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, line_no, line, lid, lid2) of every line of every text."""
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.posexplode(F.split(
        F.coalesce(F.col(f"`{text}`"), F.lit("")), "\n")).alias("line_no", "line")).withColumn(
        "lid", F.xxhash64("line")).withColumn("lid2", F.xxhash64(F.lit(SECOND), "line"))


def line_links(lines: DataFrame, scratch: Scratch, tau: int = TAU, min_chars: int = MIN_CHARS, hot: int = HOT,
               block: int = BLOCK, pair_chars: int = PAIR_CHARS) -> DataFrame:
    """(x, x2, y, y2): both hashes of all pairs of different lines within
    ``tau`` edits, each pair once."""
    if min_chars <= tau:
        raise ValueError("min_chars must be above tau")
    long = lines.select("lid", "lid2", "line").where(F.length("line") >= min_chars)
    # a line one side of min_chars links only if it is long enough itself
    entries = scratch.keep(long.mapInArrow(_key_rows(tau), "key bigint, lid bigint, probe boolean"))
    index, probe = entries.where("not probe").select("key", "lid"), entries.where("probe").select("key", "lid")
    crowded = scratch.keep(index.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") > hot))
    crowd = small_or_not(crowded, 16)
    cold = index.join(crowd.select("key"), "key", "left_anti")
    pairs = (cold.join(probe.withColumnRenamed("lid", "other"), "key").where("lid <> other")
                 .select(F.least("lid", "other").alias("x"), F.greatest("lid", "other").alias("y")).distinct())
    pairs = scratch.keep(pairs)
    # the lines of crowded keys, and the number of blocks of either kind
    packed = scratch.keep(entries.join(crowd.select("key"), "key").distinct())
    sizes = packed.groupBy("key").agg(*[
        F.greatest(F.lit(1), F.ceil(F.sum(F.when(F.col("probe") == which, 1).otherwise(0)) / block)).cast("int").alias(name)
        for name, which in (("index_blocks", False), ("probe_blocks", True))])
    sizes = small_or_not(scratch.keep(sizes), 24)
    members = pairs.select(F.explode(F.array("x", "y")).alias("lid")).unionByName(packed.select("lid")).distinct()
    members = small_or_not(scratch.keep(members), 16)
    texts = scratch.keep(long.join(members, "lid", "left_semi").dropDuplicates(["lid", "lid2"]))
    side = lambda c: texts.select(F.col("lid").alias(c), F.col("lid2").alias(f"{c}2"), F.col("line").alias(f"line_{c}"))
    both = pairs.join(side("x"), "x").join(side("y"), "y").select("x", "x2", "y", "y2", "line_x", "line_y")
    both = scratch.keep(both)
    chars = both.agg(F.sum(F.length("line_x"))).first()[0] or 0
    tasks = max(1, -(-chars // pair_chars))
    if tasks > 1:
        both = both.repartition(tasks)   # in any order: long lines spread over the tasks
    found = "x bigint, x2 bigint, y bigint, y2 bigint"
    links = both.mapInArrow(_verify_pairs(tau), found)
    if not packed.isEmpty():
        own = F.when(F.col("probe"), F.col("probe_blocks")).otherwise(F.col("index_blocks"))
        other = F.when(F.col("probe"), F.col("index_blocks")).otherwise(F.col("probe_blocks"))
        dealt = packed.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("lid"), own).cast("int")).withColumn(
            "other", F.explode(F.sequence(F.lit(0), other - 1))).select(
            "key", "lid", "probe", F.when(F.col("probe"), F.col("other")).otherwise(F.col("own")).alias("i"),
            F.when(F.col("probe"), F.col("own")).otherwise(F.col("other")).alias("j"))
        links = links.unionByName(dealt.join(texts, "lid").groupBy("key", "i", "j").applyInArrow(_verify_block(tau), found))
    return scratch.keep(links.distinct())


def line_classes(docs: DataFrame, key: str = "doc_id", text: str = "text", tau: int = TAU,
                 min_chars: int = MIN_CHARS, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """One row per distinct line: doc_id, line_no (its first place), n_rows
    (places), n_links (different lines within ``tau`` edits), class_doc_id,
    class_line_no (first place of its class), kept (it is that place)."""
    scratch = Scratch(docs.sparkSession)
    lines = distinct_lines(docs, key, text)
    links = line_links(lines, scratch, tau, min_chars, hot, block)
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.col("line_no").alias("line_no"))
    nodes = scratch.keep(lines.groupBy("lid", "lid2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n_rows"))
                              .withColumn("uid", F.monotonically_increasing_id()))
    # the ends of links by number
    ends = links.select(F.explode(F.array(F.struct(F.col("x").alias("lid"), F.col("x2").alias("lid2")),
                                          F.struct(F.col("y").alias("lid"), F.col("y2").alias("lid2")))).alias("e"))
    ends = small_or_not(scratch.keep(ends.select("e.lid", "e.lid2").distinct()), 24)
    ids = scratch.keep(nodes.join(ends, ["lid", "lid2"], "left_semi").select("lid", "lid2", "uid"))
    side = lambda c, end: ids.select(F.col("lid").alias(c), F.col("lid2").alias(f"{c}2"), F.col("uid").alias(end))
    numbered = scratch.keep(links.join(side("x", "a"), ["x", "x2"]).join(side("y", "b"), ["y", "y2"])
                                 .select(F.col("a").alias("x"), F.col("b").alias("y")))
    degree = (numbered.select(F.explode(F.array("x", "y")).alias("uid")).groupBy("uid").agg(F.count(F.lit(1)).alias("n_links")))
    linked = scratch.keep(components(numbered, scratch).join(degree, "uid"))
    nodes = scratch.keep(nodes.drop("lid", "lid2").join(small_or_not(linked, 32), "uid", "left"))
    best = scratch.keep(nodes.where("label is not null").groupBy("label").agg(F.min("first").alias("best")))
    out = nodes.join(small_or_not(best, 48), "label", "left").withColumn("best", F.coalesce("best", "first"))
    return out.select(F.col("first.doc_id").alias("doc_id"), F.col("first.line_no").alias("line_no"), "n_rows",
                      F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      F.col("best.doc_id").alias("class_doc_id"), F.col("best.line_no").alias("class_line_no"),
                      (F.col("best") == F.col("first")).alias("kept"))
