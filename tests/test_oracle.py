"""Every registered query with an oracle equals DuckDB on the same tables
(sf0.001, rounded to 6 decimals); queries without one run and return rows;
the flagship entry runs."""

from __future__ import annotations

import math

import duckdb
import pytest

import __spark_entry__ as E
from ratingspark.plans import registry
from tests.conftest import SF_SMALL

TABLES = ["part", "orders", "lineitem", "events"]
SLOW = {"tune_mf_curve", "mdl_mf_values", "mdl_mf_rmse", "mdl_svd_sigma", "tune_svd_curve", "join_factor_dot_values",
        "mdl_ladder_full", "mdl_svd_rmse", "mdl_svd_train_rmse", "interact_view_final"}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def _rows(records, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


ORACLES = registry.oracle_sql()
TYPES = {"IntegerType": "INTEGER", "LongType": "BIGINT", "DoubleType": "DOUBLE", "StringType": "VARCHAR",
         "DateType": "DATE", "BooleanType": "BOOLEAN"}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = registry.queries()[name](spark, SF_SMALL)
    got = _rows([tuple(r) for r in df.collect()], df.columns)
    con.execute(f"CREATE OR REPLACE VIEW oracle AS {ORACLES[name]}")   # as the driver loads it
    cur = con.execute("SELECT * FROM oracle")
    cols = [d[0] for d in cur.description]
    exp = _rows(cur.fetchall(), cols)
    assert sorted(df.columns) == sorted(cols)
    spark_types = {f.name: TYPES.get(type(f.dataType).__name__) for f in df.schema.fields}
    assert spark_types == {d[0]: str(d[1]) for d in cur.description}
    assert got == exp


def test_every_query_has_oracle_or_is_iterative():
    no_oracle = set(registry.queries()) - set(ORACLES)
    assert no_oracle <= SLOW


def test_entry_runs(spark):
    out = E.entry(spark).collect()
    assert len(out) == 1 and out[0]["rmse"] is not None


@pytest.mark.parametrize("name", ["mdl_svd_rmse", "mdl_mf_rmse", "mdl_ladder", "snk_metric"])
def test_iterative_queries_run(spark, name):
    rows = registry.queries()[name](spark, SF_SMALL).collect()
    assert rows and all(r["rmse"] is not None for r in rows)
