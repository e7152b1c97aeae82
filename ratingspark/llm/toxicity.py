"""Toxicity by class-conditional Kneser-Ney models.

Texts are strings of bytes with A-Z lowered, digits and white space unified,
framed by spaces. Two models give the probability of a byte after the three
before it, one learnt from toxic rows, one from ordinary rows. Counts of the
whole n-grams are each model's own; the distribution both back off to is
shared: continuation counts (in how many different contexts an n-gram ends) of
both classes together, interpolated down to single bytes with absolute
discounting. So what neither class has seen in full counts for neither side.

A text's evidence is its log-likelihood under the toxic model minus that under
the ordinary one: per byte over the whole text, and summed over its most toxic
PHRASE bytes. The second is a maximum over all windows of the text and would
grow with its length, so it counts only as its surprise: minus the logarithm
of how many windows as toxic as that an ordinary text of as many windows is
expected to have. That rate is read from ordinary labelled rows that were not
counted: texts whose maximum reaches a level per window looked at (a text is
one event, however often it repeats a phrase), above the level that TAIL texts
reach by an exponential tail. A long ordinary text is thus no more suspicious
than a short one. A logistic function of evidence per byte and surprise, with
coefficients of at least 0, fitted on the same rows and the toxic ones that
were not counted, gives the score.

Texts are read in slices of SLICE n-grams, whose sums, windows and counts are
carried on, so a task's working memory does not grow with a text's length.

Counts come from all training rows. N-gram tables stay in Spark; each context
has at most 256 continuations, so windows over a context are bounded. The
finished model has every n-gram and context under its exact key. Up to
TABLE_BYTES, by its counted entries, it is collected and broadcast as sorted
arrays; a larger one stays a table, which the distinct n-grams of each chunk
of documents are joined with, and chunks meet their values in a cogroup.

Rows are split by crc32(doc_id as text) mod 4: 2 is held out and never read
here, 0 and 1 are counted and 3 fits the curve and the logistic function. Then
0, 1 and 3 are counted again for the model that scores. Labels are joined by
doc_id: of repeated labels the largest counts, NULL labels and ids are left
out.

Defined cases: NULL and empty texts are one framed space pair and get a score
like any other; a NULL doc_id is not held out; without labelled rows of both
classes the default coefficients are used; an empty table gives an empty
result.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch, chunks, small_or_not

ORDER = 4
FRAME = b" " * (ORDER // 2)
TABLE_BYTES = 32 * 1024 * 1024   # largest model that is collected and broadcast
ENTRY_BYTES = 8
CONTEXT = 1 << 8 * ORDER   # keys of contexts start here, those of n-grams are smaller
DISCOUNT = 0.75
PHRASE = 12
SLICE = 1 << 18   # n-grams that are worked on at once
THRESHOLD = 0.3
HELD_OUT, CALIBRATION = 2, 3
REGULARISATION = 1e-3
DEFAULT_FIT = (1.0, 0.4, -4.0)   # per-byte evidence, surprise of the phrase, intercept
STEP = 8          # levels of the phrase evidence per unit
TAIL = 20         # texts that reach the last level of the curve
LEAST_EXCESS = 0.25

_CODES = np.arange(256, dtype=np.uint8)
_CODES[65:91] = _CODES[97:123]
_CODES[48:58] = 48
_CODES[9:14] = 32


def slices(text: str):
    """The n-grams of a text as numbers, first byte highest, at most SLICE at
    a time, so working memory does not grow with the text."""
    raw = np.frombuffer(FRAME + (text or "").encode() + FRAME, np.uint8)
    for lo in range(0, len(raw) - ORDER + 1, SLICE):
        x = _CODES[raw[lo:lo + SLICE + ORDER - 1]]
        h = np.zeros(len(x) - ORDER + 1, np.int64)
        for j in range(ORDER):
            h = (h << 8) | x[j:len(h) + j]
        yield h


def ngrams(text: str) -> np.ndarray:
    """All n-grams of a text, in order."""
    return np.concatenate(list(slices(text)))


def slot(x: np.ndarray) -> np.ndarray:
    """The keys of n-grams or contexts in a Table: exact, as ORDER bytes fit."""
    return x.astype(np.uint32)


class Table:
    """Values by sorted key; ``empty`` for keys that are not in it."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, empty: float):
        order = np.argsort(keys, kind="stable")
        self.keys, self.values, self.empty = slot(keys[order]), values[order].astype(np.float32), np.float32(empty)

    def __len__(self) -> int:
        return len(self.keys)

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        return np.array(self.values, dtype)

    def __getitem__(self, x: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(np.shape(x), self.empty)
        i = np.minimum(np.searchsorted(self.keys, x), len(self.keys) - 1)
        return np.where(self.keys[i] == x, self.values[i], self.empty)


def tables(keys: np.ndarray, values: np.ndarray) -> tuple[Table, Table]:
    """Evidence of n-grams that were seen (NaN: not seen) and of unseen
    continuations of contexts (0: context not seen)."""
    whole = keys < CONTEXT
    return Table(keys[whole], values[whole], np.nan), Table(keys[~whole] - CONTEXT, values[~whole], 0.0)


@dataclass(frozen=True)
class Stored:
    """A model too large to broadcast: a table of (key, value)."""

    entries: DataFrame


@dataclass(frozen=True)
class Judge:
    """How evidence becomes a score. ``rarity``: minus the logarithm of the
    rate per window at which ordinary texts reach a level of phrase evidence;
    it rises by 1 / ``excess`` above the last level."""

    levels: tuple[float, ...] = (0.0,)
    rarity: tuple[float, ...] = (0.0,)
    excess: float = 1.0
    fit: tuple[float, float, float] = DEFAULT_FIT

    def surprise(self, phrase: np.ndarray, windows: np.ndarray) -> np.ndarray:
        over = np.maximum(phrase - self.levels[-1], 0.0) / self.excess
        return np.interp(phrase, self.levels, self.rarity) + over - np.log(windows)

    def score(self, whole: np.ndarray, phrase: np.ndarray, windows: np.ndarray) -> np.ndarray:
        a, b, c = self.fit
        return 1 / (1 + np.exp(-(a * whole + b * self.surprise(phrase, windows) + c)))


def evidence(text: str, grams: Table, contexts: Table) -> tuple[float, float, int]:
    """(per byte of the text, sum over its most toxic PHRASE bytes, windows of
    PHRASE bytes it has)."""
    total, n, phrase = 0.0, 0, None
    last = np.zeros(0)   # values a window over the end of the slice starts with
    for h in slices(text):
        v = grams[slot(h)].astype(np.float64)
        new = np.isnan(v)
        v[new] = contexts[slot(h[new] >> 8)]
        total, n = total + float(v.sum()), n + len(v)
        v = np.concatenate([last, v])
        if len(v) >= PHRASE:
            c = np.concatenate([[0.0], np.cumsum(v)])
            top = float((c[PHRASE:] - c[:-PHRASE]).max())
            phrase = top if phrase is None else max(phrase, top)
        last = v[-(PHRASE - 1):]
    return (total / n if n else 0.0), (total if phrase is None else phrase), max(n - PHRASE + 1, 1)


def fold(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string")), F.lit(4)).cast("int")


def held_out(key: Column) -> Column:
    return F.coalesce(fold(key) == HELD_OUT, F.lit(False))


def _counted(parts: list, toxic: list) -> pa.RecordBatch:
    owner = np.repeat(np.array(toxic, np.int64), [len(p) for p in parts])
    gram, code = np.unique(np.concatenate(parts), return_inverse=True)
    n1 = np.bincount(code, owner, minlength=len(gram)).astype(np.int64)
    n0 = np.bincount(code, minlength=len(gram)).astype(np.int64) - n1
    return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(n0), pa.array(n1)], names=["gram", "n0", "n1"])


def _count(batches):
    """(toxic, text) -> (gram, n0, n1), counted per SLICE or two of n-grams."""
    for batch in batches:
        parts, toxic, size = [], [], 0
        for label, text in zip(batch.column("toxic"), batch.column("text")):
            for h in slices(text.as_py()):
                parts.append(h)
                toxic.append(label.as_py())
                size += len(h)
                if size >= SLICE:
                    yield _counted(parts, toxic)
                    parts, toxic, size = [], [], 0
        if parts:
            yield _counted(parts, toxic)


def model_tables(counts: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(gram, value) and (context, value) of the two models."""
    back = None
    levels = []
    level = counts.select(F.col("gram").alias("g"))
    for k in range(ORDER - 1, 0, -1):
        level = scratch.keep(level.groupBy(F.col("g").bitwiseAND((1 << 8 * k) - 1).alias("g"))
                                  .agg(F.count(F.lit(1)).alias("c")))
        levels.append((k, level))
    d = DISCOUNT
    for k, level in reversed(levels):
        w = Window.partitionBy(F.shiftright("g", 8))
        own = (F.col("c") - d) / F.sum("c").over(w)
        left = d * F.count(F.lit(1)).over(w) / F.sum("c").over(w)
        if back is None:
            level = level.select("g", (own + left / 256).alias("p"))
        else:
            level = level.withColumn("own", own).withColumn("left", left).withColumn(
                "low", F.col("g").bitwiseAND((1 << 8 * (k - 1)) - 1))
            level = level.join(back.select(F.col("g").alias("low"), F.col("p").alias("q")), "low").select(
                "g", (F.col("own") + F.col("left") * F.col("q")).alias("p"))
        back = scratch.keep(level)
    w = Window.partitionBy("context")
    full = counts.withColumn("context", F.shiftright("gram", 8)).withColumn(
        "g", F.col("gram").bitwiseAND((1 << 8 * (ORDER - 1)) - 1)).join(back, "g")
    for c in ("0", "1"):
        n = F.col("n" + c)
        full = full.withColumn("t" + c, F.sum(n).over(w)).withColumn("u" + c, F.count_if(n > 0).over(w))
        rest = F.when(F.col("t" + c) > 0, d * F.col("u" + c) / F.col("t" + c)).otherwise(F.lit(1.0))
        full = full.withColumn("rest" + c, rest).withColumn(
            "p" + c, F.greatest(n - d, F.lit(0.0)) / F.greatest(F.col("t" + c), F.lit(1)) + F.col("rest" + c) * F.col("p"))
    full = scratch.keep(full.select("gram", "context", F.ln(F.col("p1") / F.col("p0")).alias("value"),
                                    F.ln(F.col("rest1") / F.col("rest0")).alias("unseen")))
    return full.select("gram", "value"), full.groupBy("context").agg(F.first("unseen").alias("value"))


def learn(rows: DataFrame, limit: int = TABLE_BYTES):
    """The model of (text, toxic) rows: a broadcast pair of Tables, or Stored
    if its entries take more than ``limit`` bytes."""
    scratch = Scratch(rows.sparkSession)
    counts = rows.mapInArrow(_count, "gram bigint, n0 bigint, n1 bigint").groupBy("gram").agg(
        F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    grams, contexts = model_tables(scratch.keep(counts), scratch)
    value = F.col("value").cast("float").alias("value")
    entries = scratch.keep(grams.select(F.col("gram").alias("key"), value).unionByName(
        contexts.select((F.col("context") + CONTEXT).alias("key"), value)))
    if entries.count() * ENTRY_BYTES > limit:
        return Stored(entries)
    got = entries.toPandas()
    return rows.sparkSession.sparkContext.broadcast(tables(got["key"].to_numpy(), got["value"].to_numpy()))


def _found(row, texts, model: tuple[Table, Table], judge: Judge | None) -> dict:
    """Columns: ``row`` and the evidence of the texts, or their score."""
    got = [evidence(t.as_py(), *model) for t in texts]
    whole, phrase, windows = np.array(got, np.float64).reshape(-1, 3).T
    if judge:
        return {"row": row, "score": pa.array(judge.score(whole, phrase, windows))}
    return {"row": row, "whole": pa.array(whole), "phrase": pa.array(phrase), "windows": pa.array(windows)}


def _evidence_rows(model, judge: Judge | None):
    """mapInArrow function; ``model`` is a broadcast pair of Tables."""

    def run(batches):
        for batch in batches:
            found = _found(batch.column("row"), batch.column("text"), model.value, judge)
            yield pa.RecordBatch.from_arrays(list(found.values()), names=list(found))
    return run


def _number_chunks(batches):
    """(row, text) -> (chunk, row, text), chunks bounded by their bytes."""
    from pyspark import TaskContext

    chunk = TaskContext.get().partitionId() << 32
    for batch in batches:
        for lo, hi in chunks([t or "" for t in batch.column("text").to_pylist()]):
            part = batch.slice(lo, hi - lo)
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * (hi - lo), pa.int64()), part.column("row"), part.column("text")],
                                             names=["chunk", "row", "text"])
            chunk += 1


def _asked(batches):
    """(chunk, text) -> (chunk, key) of the model's entries a text can need."""
    for batch in batches:
        owner = batch.column("chunk").to_numpy(zero_copy_only=False)
        for chunk in np.unique(owner):
            texts = (batch.column("text")[int(i)].as_py() for i in np.flatnonzero(owner == chunk))
            h = np.unique(np.concatenate([np.unique(h) for t in texts for h in slices(t)]))
            keys = np.concatenate([h, np.unique(h >> 8) + CONTEXT])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), chunk)), pa.array(keys)], names=["chunk", "key"])


def _by_joins(rows: DataFrame, model: Stored, judge: Judge | None, kind: str, schema: str) -> DataFrame:
    """The same rows without a broadcast: a chunk asks for each key once, so no
    key has more rows than there are chunks."""
    rows = Scratch(rows.sparkSession).keep(rows.mapInArrow(_number_chunks, f"chunk bigint, row {kind}, text string"))
    values = rows.select("chunk", "text").mapInArrow(_asked, "chunk bigint, key bigint").join(model.entries, "key")

    def run(texts, known):
        pair = tables(known.column("key").to_numpy(), known.column("value").to_numpy())
        return pa.table(_found(texts.column("row"), texts.column("text"), pair, judge))

    return rows.groupBy("chunk").cogroup(values.groupBy("chunk")).applyInArrow(run, schema)


def _with_evidence(docs: DataFrame, text: str, model, judge: Judge | None = None) -> DataFrame:
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["row"].dataType.simpleString()
    schema = f"row {kind}, " + ("score double" if judge else "whole double, phrase double, windows double")
    if isinstance(model, Stored):
        return _by_joins(rows, model, judge, kind, schema)
    return rows.mapInArrow(_evidence_rows(model, judge), schema)


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str) -> DataFrame:
    """(text, toxic, fold) of the rows that may be learnt from."""
    known = (labels.where(F.col("toxic").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k"))
                   .agg(F.max(F.col("toxic").cast("int")).alias("toxic")).withColumn("fold", fold(F.col("k")))
                   .where(F.col("fold") != HELD_OUT))
    known = small_or_not(Scratch(docs.sparkSession).keep(known), 24)
    return docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text")).join(known, "k").select(
        "text", "toxic", "fold")


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", limit: int = TABLE_BYTES):
    """(model of the counted folds, judge) learnt from the labelled rows."""
    rows = labelled(docs, labels, key, text)
    model = learn(rows.where(F.col("fold") != CALIBRATION), limit)
    seen = Scratch(docs.sparkSession).keep(
        _with_evidence(rows.where(F.col("fold") == CALIBRATION).select("text", "toxic"), "text", model)
        .select("whole", "phrase", "windows", F.col("row.toxic").cast("double").alias("label")))
    return model, fit(seen, curve(seen))


def curve(seen: DataFrame) -> Judge:
    """The rarity of phrase evidence in ordinary texts. Evidence is a sum of
    PHRASE logarithms, so there are a few thousand levels at most."""
    rows = (seen.where("label = 0").groupBy((F.floor(F.col("phrase") * STEP) / STEP).alias("level"))
                .agg(F.count(F.lit(1)).alias("n"), F.sum("windows").alias("windows"), F.sum("phrase").alias("phrase"))
                .orderBy("level").collect())
    if not rows:
        return Judge()
    level, n, windows, phrase = np.array(rows, np.float64).T
    reach = lambda x: np.cumsum(x[::-1])[::-1]
    # texts that reach the level, over the windows of the others and half their own
    rate = reach(n) / (windows.sum() - reach(windows) / 2)
    last = max(int(np.searchsorted(-reach(n), -TAIL, side="right")) - 1, 0)
    excess = reach(phrase)[last] / reach(n)[last] - level[last]
    return Judge(tuple(level[:last + 1].tolist()), tuple((-np.log(rate[:last + 1])).tolist()),
                 float(max(excess, LEAST_EXCESS)))


def fit(seen: DataFrame, judge: Judge) -> Judge:
    """``judge`` with the coefficients of a logistic regression on (whole,
    surprise, label)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Matrices

    def surprises(batches):
        for batch in batches:
            s = judge.surprise(*(batch.column(c).to_numpy(zero_copy_only=False) for c in ("phrase", "windows")))
            yield pa.RecordBatch.from_arrays([batch.column("whole"), pa.array(s), batch.column("label")],
                                             names=["whole", "surprise", "label"])

    if seen.select("label").distinct().count() < 2:
        return judge
    data = VectorAssembler(inputCols=["whole", "surprise"], outputCol="features").transform(
        seen.mapInArrow(surprises, "whole double, surprise double, label double"))
    m = LogisticRegression(regParam=REGULARISATION, maxIter=100, tol=1e-9,
                           lowerBoundsOnCoefficients=Matrices.dense(1, 2, [0.0, 0.0])).fit(data)
    return replace(judge, fit=(float(m.coefficients[0]), float(m.coefficients[1]), float(m.intercept)))


def score_documents(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, key: str = "doc_id",
                    text: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """``row`` (struct of all columns), held_out, score, predicted."""
    judge = train(train_docs, labels, key, text, limit)[1]
    out = _with_evidence(docs, text, learn(labelled(train_docs, labels, key, text), limit), judge)
    return (out.select("row", held_out(F.col("row").getField(key)).alias("held_out"), "score")
               .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int")))


def drop_toxic(docs: DataFrame, train_docs: DataFrame, labels: DataFrame, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """``docs`` without the rows that are predicted toxic, all columns kept."""
    return score_documents(docs, train_docs, labels, key, text).where("predicted = 0").select("row.*")
