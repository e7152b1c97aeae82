"""Plan shape (pruned scans, no cartesian products) and hot-key behaviour."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from ratingspark.operators import aggregates as A
from ratingspark.operators.bias import fit_chain, grid_rmse, predict_chain
from ratingspark.operators.split import stratified_holdout
from ratingspark.sources.fixtures import ratings_from_orders
from tests.conftest import SF_SMALL

FAST = ["split_repair", "tune_sym", "mdl_time", "agg_summary", "interact_view", "agg_hist", "idx_factor"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", FAST)
def test_no_cartesian_or_nested_loop(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scan_reads_only_used_columns(spark):
    plan = _plan(ratings_from_orders(spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "l_extendedprice" not in plan and "o_totalprice" not in plan


def test_bias_tables_are_broadcast(spark):
    df = spark.createDataFrame([(u % 7, u % 5, float(u % 9) / 2 + 0.5) for u in range(300)],
                               "userId long, movieId long, rating double")
    chain = fit_chain(df, ["movieId", "userId"], [1.0], base=2.5)
    plan = _plan(predict_chain(df, chain, base=2.5))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan


@pytest.fixture(scope="module")
def hot(spark):
    """One user holds a third of all ratings."""
    rows = [(0, i % 500, float(1 + i % 10) / 2, i) for i in range(3000)]
    rows += [(1 + i % 300, i % 500, float(1 + (i * 7) % 10) / 2, 10_000 + i) for i in range(6000)]
    return spark.createDataFrame(rows, "userId long, movieId long, rating double, timestamp long").cache()


def test_hot_user_split_needs_no_window_or_join(hot):
    keys = ["userId", "movieId", "rating", "timestamp"]
    a = stratified_holdout(hot, 0.1, 7, key_cols=keys)
    plan = _plan(a)
    assert "Window" not in plan and "Join" not in plan and "Exchange" not in plan
    b = stratified_holdout(hot, 0.1, 7, key_cols=keys, digits=1, few=2).filter("_holdout")
    a = a.filter("_holdout")
    assert a.count() == b.count() and a.exceptAll(b).count() == 0


def test_hot_user_bias_matches_direct_mean(hot):
    mu = A.mean_value(hot)
    chain = fit_chain(hot, ["userId"], [0.0], base=mu)
    b0 = chain.tables[0].filter("userId = 0").first()["b_0"]
    direct = hot.filter("userId = 0").agg(F.avg("rating")).first()[0] - mu
    assert b0 == pytest.approx(direct, abs=1e-12)
    r = grid_rmse(predict_chain(hot, chain, base=mu), [0.0]).first()
    assert r["n_pred"] == 9000
