"""Queries over ingest, split and tidy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ratingspark.operators import aggregates as A
from ratingspark.operators.joins import semi_join
from ratingspark.plans import oracle as O
from ratingspark.plans.queries import ML, TIDY, _sel, r6, register, sets


@register("join_left_dim", O.with_sets(_sel("joined", ML)))
def join_left_dim(spark, sf_dir):
    """ratings LEFT JOIN movies (movie table broadcast after a size check)."""
    return r6(sets(spark, sf_dir).joined.select(*ML))


def _drawn(s):
    return s.flagged.filter(F.col("_holdout")).select(*ML)


def _left(s):
    return s.flagged.filter(~F.col("_holdout")).select(*ML)


@register("split_stratified", O.with_sets(_sel("o_f", ML) + " WHERE _hold"))
def split_stratified(spark, sf_dir):
    """Rows drawn for the hold-out before the repair."""
    return r6(_drawn(sets(spark, sf_dir)))


@register("split_repair", O.with_sets(_sel("validation", ML)))
def split_repair(spark, sf_dir):
    """validation: hold-out rows whose user and movie are known to development."""
    return r6(sets(spark, sf_dir).validation.select(*ML))


@register("set_union_all", O.with_sets(_sel("development", ML)))
def set_union_all(spark, sf_dir):
    """development: non-drawn rows plus the drawn rows put back by the repair."""
    return r6(sets(spark, sf_dir).development.select(*ML))


@register("row_split", O.with_sets(_sel("o_f", ML) + " WHERE NOT _hold"))
def row_split(spark, sf_dir):
    """Rows not in the drawn index set."""
    return r6(_left(sets(spark, sf_dir)))


_TEMP = "(SELECT " + ", ".join(f'"{c}"' for c in ML) + " FROM o_f WHERE _hold)"


_SEMI_SQL = (f"SELECT * FROM {_TEMP} t WHERE t.movieId IN (SELECT movieId FROM o_f WHERE NOT _hold) "
             "AND t.userId IN (SELECT userId FROM o_f WHERE NOT _hold)")
_ANTI_SQL = (f"SELECT * FROM {_TEMP} t WHERE NOT EXISTS (SELECT 1 FROM validation v WHERE "
             + " AND ".join(f't."{c}" IS NOT DISTINCT FROM v."{c}"' for c in ML) + ")")


def _semi(s):
    return semi_join(semi_join(_drawn(s), _left(s), "movieId"), _left(s), "userId")


def _anti(s):
    return s.removed.select(*ML)


@register("join_semi", O.with_sets(_SEMI_SQL))
def join_semi(spark, sf_dir):
    """temp semi-joined to the drawn-out rows on movie, then on user."""
    return r6(_semi(sets(spark, sf_dir)))


@register("join_anti_all", O.with_sets(_ANTI_SQL))
def join_anti_all(spark, sf_dir):
    """removed = temp anti-joined to validation on every column, NULL = NULL."""
    return r6(_anti(sets(spark, sf_dir)))


# The same four with a hold-out so large that many users and movies are left
# without training rows: the semi join filters, the repair puts rows back.
LARGE = 0.97


@register("join_semi_large", O.with_sets(_SEMI_SQL, p=LARGE))
def join_semi_large(spark, sf_dir):
    """join_semi on a 97 % hold-out."""
    return r6(_semi(sets(spark, sf_dir, LARGE)))


@register("join_anti_all_large", O.with_sets(_ANTI_SQL, p=LARGE))
def join_anti_all_large(spark, sf_dir):
    """join_anti_all on a 97 % hold-out: the rows that go back to training."""
    return r6(_anti(sets(spark, sf_dir, LARGE)))


@register("split_repair_large", O.with_sets(_sel("validation", ML), p=LARGE))
def split_repair_large(spark, sf_dir):
    """validation of a 97 % hold-out."""
    return r6(sets(spark, sf_dir, LARGE).validation.select(*ML))


@register("set_union_all_large", O.with_sets(_sel("development", ML), p=LARGE))
def set_union_all_large(spark, sf_dir):
    """development of a 97 % hold-out, with the removed rows."""
    return r6(sets(spark, sf_dir, LARGE).development.select(*ML))


@register("tidy_training_set", O.with_sets(_sel("training_set", TIDY)))
def tidy_training_set(spark, sf_dir):
    """training_set: date from epoch, release year and tidy title from title."""
    return r6(sets(spark, sf_dir).training_set)


@register("tidy_test_set", O.with_sets(_sel("test_set", TIDY)))
def tidy_test_set(spark, sf_dir):
    """test_set: the tidied validation rows."""
    return r6(sets(spark, sf_dir).test_set)


@register("split_nested", O.with_sets(_sel("cv_set", TIDY)))
def split_nested(spark, sf_dir):
    """cv_set: the same split applied to training_set."""
    return r6(sets(spark, sf_dir).cv_set)


@register("split_nested_train", O.with_sets(_sel("train_set", TIDY)))
def split_nested_train(spark, sf_dir):
    """train_set: training_set minus the inner hold-out, repaired."""
    return r6(sets(spark, sf_dir).train_set)


@register("tbl_dim", O.with_sets(
    "SELECT 'development' AS table_name, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM development "
    "UNION ALL SELECT 'validation', count(*), CAST(6 AS BIGINT) FROM validation"))
def tbl_dim(spark, sf_dir):
    """Row and column counts of development and validation, stacked."""
    s = sets(spark, sf_dir)
    return A.table_dims({"development": s.development, "validation": s.validation})


@register("row_head", O.with_sets(
    _sel("training_set", TIDY) + " ORDER BY userId, movieId, rating, rating_date LIMIT 6"))
def row_head(spark, sf_dir):
    """First six rows of training_set in an explicit order."""
    return r6(A.head_rows(sets(spark, sf_dir).training_set, ["userId", "movieId", "rating", "rating_date"]))
