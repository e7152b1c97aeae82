"""Regularised bias models as plain group aggregates, for one lambda or a
whole lambda grid at once.

A chain of stages (item, user, release year, rating month, ...) is fitted
in order. Stage j's bias for key value k at penalty L is

    b_j(k; L) = sum over rows with key k of (r - base - sum_{i<j} b_i(.; L))
                / (L + n_k)

``base`` is the global mean or any per-row offset (for example a clamped
baseline prediction). For a grid of penalties L_0..L_{m-1} every stage
carries m bias columns ``b_0 .. b_{m-1}``: one aggregation per stage with m
sum columns replaces m separate fits, and one final aggregation with m
squared-error sums scores every penalty. Stage 0 needs no per-penalty sum:
its bias is S / (L + n) from the penalty-free (S, n).

Nothing with m columns moves with the rows. Stage 0 is stored as (S, n), so it
joins as two columns and becomes m biases where they are used. Rows of a grid
are dealt by the first later key with more than ``FEW_GROUPS`` values (users)
while they are narrow and kept there: that key's sums need no further shuffle,
and its table joins rows that already lie right. All rows of a value of that
key meet in one task, as running sums. Keys with few values (years, months)
are added up in the tasks first, by an aggregate for each ``PIECE`` penalties,
as is the curve: the rows are read again for each, but by compiled code.

Bias tables are small dimensions (one row per item, user, year or month);
each is written as a reliable checkpoint (which also keeps the next
stage's plan short) and broadcast only after its measured size is checked.
Keys listed in ``nullsafe`` join with ``<=>`` so the NULL-key group (no
release year) finds its own bias.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratingspark.functions.columns import clamp as clamp_col
from ratingspark.operators.joins import left_join, size_checked
from ratingspark.session import cut_lineage

NULLSAFE_KEYS = frozenset({"release_year"})


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    return F.lit(float(x))


@dataclass
class BiasChain:
    """Fitted stages: ``tables[j]`` has columns (keys[j], b_0..b_{m-1}, n);
    ``first`` is stage 0 as (keys[0], _s, n), from which its biases follow."""
    keys: list[str]
    lambdas: list[float]
    tables: list[DataFrame] = field(default_factory=list)
    nullsafe: frozenset = NULLSAFE_KEYS
    small: list[bool] = field(default_factory=list)   # broadcast after the size check
    first: DataFrame | None = None

    @property
    def m(self) -> int:
        return len(self.lambdas)


def _first_bias(chain: BiasChain, k: int, s: str, n: str) -> Column:
    return F.col(s) / (F.lit(chain.lambdas[k]) + F.col(n))


def _attach_first(df: DataFrame, chain: BiasChain) -> DataFrame:
    """Stage 0 joined as its two columns."""
    key = chain.keys[0]
    t = chain.first.select(key, F.col("_s").alias("_s0"), F.col("n").alias("_n0"))
    return left_join(df, t, key, nullsafe=key in chain.nullsafe)


def _attach(df: DataFrame, chain: BiasChain, upto: int, acc_prefix: str, init) -> DataFrame:
    """Join stage tables 0..upto-1 to ``df`` and fold their biases into
    running sums ``acc_prefix{k}`` that start at ``init`` (the joined columns
    are dropped at once, so the row never carries more than m extra columns).
    Rows that have stage 0 already (``_s0``, ``_n0``) do not join it again.

    Tables too large to broadcast are joined first, while the row is still
    narrow: a shuffle join then moves the keys and the residual, not m
    accumulated columns. With every table broadcast the order is the stage
    order.
    """
    m = chain.m
    small = chain.small or [True] * len(chain.tables)
    has_first = "_s0" in df.columns
    order = [j for j in range(upto) if not small[j] and not (j == 0 and has_first)]
    order += [j for j in range(upto) if small[j] and not (j == 0 and has_first)]
    acc, pending = (lambda k: init), has_first and upto > 0

    def fold(df, also=None):
        def total(k):
            return reduce(lambda a, b: a + b, [acc(k)] + ([_first_bias(chain, k, "_s0", "_n0")] if pending else [])
                          + ([also(k)] if also else []))
        return df.select(
            *[c for c in df.columns if c not in ("_s0", "_n0") and not c.startswith("_t") and not c.startswith(acc_prefix)],
            *[total(k).alias(f"{acc_prefix}{k}") for k in range(m)])

    for j in order:
        if j == 0:
            df, pending = _attach_first(df, chain), True
            continue
        key = chain.keys[j]
        t = chain.tables[j].select(key, *[F.col(f"b_{k}").alias(f"_t{k}") for k in range(m)])
        df = fold(left_join(df, t, key, nullsafe=key in chain.nullsafe), lambda k: F.col(f"_t{k}"))
        acc, pending = (lambda k: F.col(f"{acc_prefix}{k}")), False
    return fold(df) if pending or not order else df


# Penalties whose tables are joined and summed by one generated function. With
# more, the function passes the 8,000 bytes up to which the JVM compiles it.
PIECE = 14


def _pieces(chain: BiasChain) -> list[tuple[range, BiasChain]]:
    """The chain cut by penalties: (their numbers, a chain of these)."""
    out = []
    for lo in range(0, chain.m, PIECE):
        of = range(lo, min(chain.m, lo + PIECE))
        tables = [t.select(key, *[F.col(f"b_{k}").alias(f"b_{k - lo}") for k in of], "n") for key, t in zip(chain.keys, chain.tables)]
        out.append((of, replace(chain, lambdas=[chain.lambdas[k] for k in of], tables=tables)))
    return out


def _piecewise_sums(df: DataFrame, key: str, chain: BiasChain, upto: int) -> DataFrame:
    """(key, _s0.._s{m-1}, n): the residuals' sums of a key with few values, by
    an aggregate for each piece of the penalties."""
    parts = []
    for of, piece in _pieces(chain):
        agg = _attach(df, piece, upto, "_a", F.lit(0.0)).groupBy(key).agg(
            *[F.sum(F.col("_r0") - F.col(f"_a{i}")).alias(f"_s{k}") for i, k in enumerate(of)], F.count(F.lit(1)).alias("n"))
        parts.append(agg.select(key, "n", *[(F.col(f"_s{k}") if k in of else F.lit(None).cast("double")).alias(f"_s{k}")
                                            for k in range(chain.m)]))
    return reduce(DataFrame.unionAll, parts).groupBy(key).agg(
        *[F.max(f"_s{k}").alias(f"_s{k}") for k in range(chain.m)], F.max("n").alias("n"))


# A stage whose key has at most so many values is added up in every task before
# its m sums move; past it the rows move instead.
FEW_GROUPS = 10_000


def _many(df: DataFrame, keys: list[str], few: int) -> list[str]:
    """The keys with more than ``few`` values (by estimate)."""
    if not keys:
        return []
    n = df.agg(*[F.approx_count_distinct(k).alias(f"_k{i}") for i, k in enumerate(keys)]).first()
    return [k for i, k in enumerate(keys) if n[f"_k{i}"] > few]


def fit_chain(frames, keys: list[str], lambdas: list[float], base="mu", rating: str = "rating",
              nullsafe=NULLSAFE_KEYS, max_broadcast_bytes: int | None = None, few_groups: int = FEW_GROUPS) -> BiasChain:
    """Fit the stages in order.

    ``frames`` is one training DataFrame or one per stage (the analysis fits
    some stages on a different training set than others). ``base`` is a
    column name, a Column or a number (the global mean).
    """
    one_frame = isinstance(frames, DataFrame)
    if one_frame:
        frames = [frames] * len(keys)
    chain = BiasChain(list(keys), [float(x) for x in lambdas], [], frozenset(nullsafe))
    m = chain.m
    kw = {} if max_broadcast_bytes is None else {"max_bytes": max_broadcast_bytes}
    dealt = carried = None

    def rows_of(j):
        return frames[j].withColumn("_r0", F.col(rating) - _col(base))

    for j, key in enumerate(keys):
        df = rows_of(j).select(key, "_r0", *[c for c in chain.keys[:j] if c != key])
        if j == 0:
            agg = df.groupBy(key).agg(F.sum("_r0").alias("_s"), F.count(F.lit(1)).alias("n"))
            chain.first, small = size_checked(agg, materialize="checkpoint", **kw)
            table = chain.first.select(key, *[_first_bias(chain, k, "_s", "n").alias(f"b_{k}") for k in range(m)], "n")
            chain.tables.append(table)
            chain.small.append(small)
            continue
        if one_frame and m > 1 and j == 1:
            many = _many(frames[j], keys[1:], few_groups)
            if many:
                dealt = _attach_first(rows_of(j).select("_r0", *keys), chain).select("_r0", "_s0", "_n0", *keys[1:]).repartition(many[0])
                if len(keys) > 2:
                    dealt = dealt.persist(StorageLevel.MEMORY_AND_DISK)
        few = False
        same_next = m == 1 and j > 1 and j + 1 < len(keys) and frames[j + 1] is frames[j]
        if carried is not None and carried[0] is frames[j]:
            df = carried[1].withColumn("_a0", F.lit(0.0))
            for i in range(carried[2], j):
                t = chain.tables[i].select(keys[i], F.col("b_0").alias("_t0"))
                df = left_join(df, t, keys[i], nullsafe=keys[i] in chain.nullsafe)
                df = df.withColumn("_a0", F.col("_a0") + F.col("_t0")).drop("_t0")
        elif dealt is not None:
            few = j > 1 and key not in many
            df = dealt if few else _attach(dealt, chain, j, "_a", F.lit(0.0))
        elif same_next:   # the residual so far goes on to the next stages, not the joins
            df = _attach(rows_of(j).select("_r0", *keys), chain, j, "_a", F.lit(0.0))
            df = cut_lineage(df.select((F.col("_r0") - F.col("_a0")).alias("_r0"), *keys[j:]))
            carried, df = (frames[j], df, j), df.withColumn("_a0", F.lit(0.0))
        else:
            df = _attach(df, chain, j, "_a", F.lit(0.0))
        if few:
            agg = _piecewise_sums(df, key, chain, j)
        else:
            agg = df.groupBy(key).agg(
                *[F.sum(F.col("_r0") - F.col(f"_a{k}")).alias(f"_s{k}") for k in range(m)],
                F.count(F.lit(1)).alias("n"))
        table = agg.select(key, *[(F.col(f"_s{k}") / (F.lit(lam) + F.col("n"))).alias(f"b_{k}")
                                  for k, lam in enumerate(chain.lambdas)], "n")
        checked, small = size_checked(table, materialize="checkpoint", **kw)
        chain.tables.append(checked)
        chain.small.append(small)
    if dealt is not None:
        dealt.unpersist()
    return chain


def predict_chain(df: DataFrame, chain: BiasChain, base="mu", prefix: str = "pred_",
                  clamp: bool = False) -> DataFrame:
    """Add ``pred_0..pred_{m-1}`` = base + sum of stage biases. A row whose
    key is missing from a stage table gets NULL, like arithmetic on NA."""
    m = chain.m
    out = _attach(df, chain, len(chain.keys), prefix, _col(base).cast("double"))
    if clamp:
        out = out.select(*[c for c in out.columns if not c.startswith(prefix)],
                         *[clamp_col(f"{prefix}{k}").alias(f"{prefix}{k}") for k in range(m)])
    return out


def grid_rmse(pred: DataFrame, lambdas: list[float], rating: str = "rating", prefix: str = "pred_",
              param_name: str = "param") -> DataFrame:
    """One aggregation for every penalty; returns (param, rmse, n, n_pred).

    RMSE is strict: NULL when any prediction is NULL (the mean of a vector
    with a missing value is missing)."""
    m = len(lambdas)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for k in range(m):
        e = F.col(rating) - F.col(f"{prefix}{k}")
        aggs += [F.sum(e * e).alias(f"_sse{k}"), F.count(F.col(f"{prefix}{k}")).alias(f"_np{k}")]
    wide = pred.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(float(lam)).alias(param_name),
                 F.when(F.col(f"_np{k}") == F.col("_n"), F.sqrt(F.col(f"_sse{k}") / F.col("_n"))).alias("rmse"),
                 F.col("_n").alias("n"),
                 F.col(f"_np{k}").alias("n_pred"))
        for k, lam in enumerate(lambdas)])
    return wide.select(F.inline(rows))


# Penalties per job. A row carries as many accumulated as joined columns; with
# the keys they must stay under Spark's limit of 100 fields for generated code.
GRID_CHUNK = 41


def score_chain(score: DataFrame, chain: BiasChain, base="mu", clamp: bool = False, rating: str = "rating") -> DataFrame:
    """The tuning curve of a fitted chain on ``score``, by an aggregate for each
    piece of the penalties."""
    return reduce(DataFrame.unionAll, [grid_rmse(predict_chain(score, piece, base=base, clamp=clamp), piece.lambdas, rating=rating)
                                       for _, piece in _pieces(chain)])


def prefix_chain(chain: BiasChain, stages: int) -> BiasChain:
    """The first stages of a fitted chain, which do not depend on later ones."""
    return replace(chain, keys=chain.keys[:stages], tables=chain.tables[:stages], small=chain.small[:stages])


def tune_chain(train, score: DataFrame, keys: list[str], lambdas: list[float], train_base="mu",
               score_base="mu", clamp: bool = False, rating: str = "rating",
               nullsafe=NULLSAFE_KEYS, chunk: int = GRID_CHUNK) -> DataFrame:
    """Fit the chain for every penalty on ``train`` and score it on ``score``:
    the tuning curve (param, rmse, n, n_pred), one row per penalty. Grids
    longer than ``chunk`` are fitted chunk by chunk and the curves unioned."""
    lambdas = list(lambdas)
    if len(lambdas) > chunk:
        parts = [tune_chain(train, score, keys, lambdas[i:i + chunk], train_base, score_base, clamp, rating,
                            nullsafe, chunk) for i in range(0, len(lambdas), chunk)]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    chain = fit_chain(train, keys, lambdas, base=train_base, rating=rating, nullsafe=nullsafe)
    return score_chain(score, chain, score_base, clamp, rating)


def single(chain: BiasChain, j: int, name: str) -> DataFrame:
    """Stage ``j`` of a one-penalty chain as (key, name)."""
    return chain.tables[j].select(chain.keys[j], F.col("b_0").alias(name))
