"""DuckDB SQL oracles: the same sets and models written as plain SQL over
the driver's views (lineitem, orders, part, events).

The SQL is composed from common-table-expression fragments so every model
oracle restates the whole pipeline (ratings -> split -> tidy -> model) in
one statement.
"""

from __future__ import annotations

from ratingspark.plans.pipeline import HOLDOUT_FRACTION, INNER_SEED, OUTER_SEED


def dbl(x: float) -> str:
    """A double literal that parses back to exactly ``x``."""
    return f"CAST('{float(x)!r}' AS DOUBLE)"


def lam_values(lambdas) -> str:
    return "(VALUES " + ", ".join(f"({dbl(v)})" for v in lambdas) + ") AS lam_t(lam)"


RATINGS = """ratings AS (
  SELECT CAST(o.o_custkey AS BIGINT) AS userId, CAST(l.l_partkey AS BIGINT) AS movieId,
         CAST(ceil(l.l_quantity / CAST(5 AS DOUBLE)) AS DOUBLE) / CAST(2 AS DOUBLE) AS rating,
         CAST(floor(epoch(l.l_shipdate)) AS BIGINT) AS "timestamp"
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""

MOVIES = """movies AS (
  SELECT CAST(p_partkey AS BIGINT) AS movieId,
         CASE WHEN p_size % 17 = 0 THEN p_name
              ELSE p_name || ' (' || CAST(1950 + p_size AS VARCHAR) || ')' END AS title,
         p_type || '|' || p_brand AS genres
  FROM part)"""

EVENTS = """skewed AS (
  SELECT CAST(user_id AS BIGINT) AS userId,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS movieId,
         least(CAST(5 AS DOUBLE), greatest(CAST(0.5 AS DOUBLE),
               CAST(ceil(value / CAST(10 AS DOUBLE)) AS DOUBLE) / CAST(2 AS DOUBLE))) AS rating,
         CAST(floor(epoch(ts)) AS BIGINT) AS "timestamp"
  FROM events)"""

JOINED = """joined AS (
  SELECT r.movieId, r.userId, r.rating, r."timestamp", m.title, m.genres
  FROM ratings r LEFT JOIN movies m ON r.movieId = m.movieId)"""


def rating_key(col: str = "rating") -> str:
    return f"CAST(CAST(round({col} * CAST(1000000 AS DOUBLE)) AS BIGINT) AS VARCHAR)"


def split_ctes(src: str, name: str, seed, key_cols: list[str], cols: list[str],
               p: float = HOLDOUT_FRACTION) -> str:
    """Stratified draw + repair of ``src``; defines {name}_train, {name}_test."""
    key_txt = ", ".join(rating_key(c) if c == "rating" else f'CAST("{c}" AS VARCHAR)' for c in key_cols)
    order = ", ".join(["_h"] + [f'"{c}"' for c in key_cols])
    col_txt = ", ".join(f'"{c}"' for c in cols)
    strata = " + ".join(f"(CASE WHEN q[{i}] > q[1] AND rating > q[{i}] THEN 1 ELSE 0 END)" for i in (2, 3, 4))
    return f"""{name}_q AS (SELECT quantile_cont(rating, [0, 0.25, 0.5, 0.75, 1]) AS q FROM {src}),
{name}_h AS (
  SELECT s.*, {strata} AS _s, md5(concat_ws('|', '{seed}', {key_txt})) AS _h
  FROM {src} s CROSS JOIN {name}_q),
{name}_r AS (
  SELECT *, row_number() OVER (PARTITION BY _s ORDER BY {order}) AS _rn,
         count(*) OVER (PARTITION BY _s) AS _ns
  FROM {name}_h),
{name}_f AS (SELECT {col_txt}, _rn <= ceil({dbl(p)} * _ns) AS _hold FROM {name}_r),
{name}_k AS (
  SELECT f.*, coalesce(f._hold AND f.movieId IN (SELECT movieId FROM {name}_f WHERE NOT _hold)
                      AND f.userId IN (SELECT userId FROM {name}_f WHERE NOT _hold), false) AS _keep
  FROM {name}_f f),
{name}_train AS (SELECT {col_txt} FROM {name}_k WHERE NOT _keep),
{name}_test AS (SELECT {col_txt} FROM {name}_k WHERE _keep)"""


def tidy_select(src: str) -> str:
    return f"""SELECT userId, movieId, rating,
         CAST(epoch_ms("timestamp" * 1000) AS DATE) AS rating_date,
         CASE WHEN regexp_matches(title, '\\(\\d{{4}}\\)')
              THEN regexp_replace(regexp_extract(title, '\\(\\d{{4}}\\)', 0), '[()]', '', 'g') END AS release_year,
         regexp_replace(regexp_replace(title, '\\(\\d{{4}}\\)', '', 'g'), '^[ \\t\\r\\n]+|[ \\t\\r\\n]+$', '', 'g') AS tidy_title,
         genres
  FROM {src}"""


def round_month(d: str) -> str:
    below = f"CAST(date_trunc('month', {d}) AS DATE)"
    above = f"CAST(date_trunc('month', {d}) + INTERVAL 1 MONTH AS DATE)"
    return (f"(CASE WHEN datediff('day', {d}, {above}) <= datediff('day', {below}, {d}) "
            f"THEN {above} ELSE {below} END)")


ML_COLS = ["movieId", "userId", "rating", "timestamp", "title", "genres"]
TIDY_COLS = ["userId", "movieId", "rating", "rating_date", "release_year", "tidy_title", "genres"]


def sets_ctes(p: float = HOLDOUT_FRACTION) -> str:
    """ratings, movies, joined, development/validation, training_set/test_set,
    train_set/cv_set and mu."""
    outer = split_ctes("joined", "o", OUTER_SEED, ["userId", "movieId", "rating", "timestamp"], ML_COLS, p)
    inner = split_ctes("training_set", "i", INNER_SEED, ["userId", "movieId", "rating", "rating_date"], TIDY_COLS)
    return f"""{RATINGS},
{MOVIES},
{JOINED},
{outer},
development AS (SELECT * FROM o_train),
validation AS (SELECT * FROM o_test),
training_set AS ({tidy_select('o_train')}),
test_set AS ({tidy_select('o_test')}),
{inner},
train_set AS (SELECT * FROM i_train),
cv_set AS (SELECT * FROM i_test),
mu_t AS (SELECT avg(rating) AS mu FROM training_set)"""


def with_sets(body: str, extra: str = "", p: float = HOLDOUT_FRACTION) -> str:
    """A statement over the sets; ``p`` is the outer hold-out's fraction."""
    ctes = sets_ctes(p)
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"


def clamp(x: str) -> str:
    return f"(CASE WHEN {x} < 0.5 THEN CAST(0.5 AS DOUBLE) WHEN {x} > 5 THEN CAST(5 AS DOUBLE) ELSE {x} END)"


def normal_quantile(p: str) -> str:
    """AS 241 in SQL, with the coefficients of functions.columns."""
    from ratingspark.functions.columns import AS241

    def poly(c, x):
        out = dbl(c[-1])
        for k in c[-2::-1]:
            out = f"({out} * {x} + {dbl(k)})"
        return out

    def ratio(part, x):
        return f"({poly(part[0], x)} / {poly(part[1], x)})"

    q = f"({p} - 0.5)"
    r = f"sqrt(-ln(least({p}, 1 - {p})))"
    centre = f"{q} * {ratio(AS241[0], f'({dbl(0.180625)} - {q} * {q})')}"
    tail = (f"sign({q}) * CASE WHEN {r} <= 5 THEN {ratio(AS241[1], f'({r} - {dbl(1.6)})')} "
            f"ELSE {ratio(AS241[2], f'({r} - {dbl(5.0)})')} END")
    return f"CASE WHEN abs({q}) <= {dbl(0.425)} THEN {centre} ELSE {tail} END"
