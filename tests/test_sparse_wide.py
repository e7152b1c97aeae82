"""Sparse wide rows against plain Python, at several stripe widths."""

from __future__ import annotations

import random

import pytest

from ratingspark.operators import sparse_wide as W

SCHEMA = "userId long, t string, v double, col int, extra string"


@pytest.fixture(scope="module")
def long(spark):
    r = random.Random(4)
    names = [f"t{i:02d}" for i in range(9)] + ["Ä", "a b", ""]
    rows = [(u, r.choice(names), round(r.uniform(-2, 2), 3), 1, "x") for u in range(25) for _ in range(r.randint(1, 30))]
    rows += [(100, n, 1.0, 2, None) for n in names]                  # complete
    rows += [(None, "t01", 2.0, 3, "x"), (None, "t02", 4.0, 3, "x"), (None, "t02", 2.0, 3, "x")]
    rows += [(101, None, 1.0, 4, "x"), (102, "t03", None, 4, "x"), (103, "only null", None, 4, "x")]
    return spark.createDataFrame(rows, SCHEMA), rows


def plain(rows):
    names = sorted({t for _, t, *_ in rows if t is not None}, key=lambda t: t.encode())
    code = {t: i + 1 for i, t in enumerate(names)}
    got = {}
    for u, t, v, *_ in rows:
        got.setdefault(u, {})
        if t is not None and v is not None:
            got[u].setdefault(t, []).append(v)
    return code, {u: {t: sum(x) / len(x) for t, x in c.items()} for u, c in got.items()}


@pytest.mark.parametrize("width", [1, 5, 13, W.WIDTH])
def test_equals_plain_rows(long, width):
    df, rows = long
    code, want = plain(rows)
    w = W.sparse_wide(df.select("userId", "t", "v"), "userId", "t", "v", width=width)
    assert w.n_columns == len(code) and {r["t"]: r["col"] for r in w.columns.collect()} == code
    for r in w.rows.collect():
        assert len(r["cols"]) == len(r["vals"]) <= width and r["cols"] == sorted(r["cols"])
        assert all((c - 1) // width == r["stripe"] for c in r["cols"])
    got = {u: {} for u in want}
    for r in W.cells(w).collect():
        assert code[r["t"]] == r["col"] and r["t"] not in got[r["userId"]]
        got[r["userId"]][r["t"]] = r["value"]
    assert got.keys() == want.keys()
    assert all(got[u] == pytest.approx(want[u]) for u in want)
    stats = {r["userId"]: r for r in W.row_statistics(w, fill=0.5).collect()}
    assert stats.keys() == want.keys()
    for u, c in want.items():
        s = stats[u]
        codes = [code[t] for t in c]
        assert (s["n_cells"], s["col_sum"], s["first_col"], s["last_col"]) == (
            len(c), sum(codes), min(codes, default=None), max(codes, default=None))
        assert s["total"] == pytest.approx(sum(c.values()))
        assert s["mean"] == pytest.approx((sum(c.values()) + 0.5 * (len(code) - len(c))) / len(code))
        assert (s["lo"], s["hi"]) == (pytest.approx(min(c.values())) if c else None, pytest.approx(max(c.values())) if c else None)
    for name in ("t02", "only null", "no such title"):
        order = [(r["userId"], r["value"]) for r in W.arrange(w, name).orderBy("place").collect()]
        expected = sorted(((u, c.get(name)) for u, c in want.items()),
                          key=lambda x: (x[1] is None, x[1] or 0, x[0] is not None, x[0] or 0))
        assert [u for u, _ in order] == [u for u, _ in expected]
        assert [v for _, v in order] == [v if v is None else pytest.approx(v) for _, v in expected]


@pytest.mark.parametrize("width", [4, W.WIDTH])
def test_complete_rows(long, width):
    df, rows = long
    known = df.where("t <> 'only null'")
    w = W.complete(W.sparse_wide(known, "userId", "t", "v", width=width))
    assert {r["userId"] for r in w.rows.collect()} >= {100}
    code, want = plain([r for r in rows if r[1] is not None and r[1] != "only null"])
    full = {u for u, c in want.items() if len(c) == len(code)}
    assert {r["userId"] for r in W.cells(w).collect()} == full
    assert W.cells(w).count() == len(full) * len(code)


def test_empty_table_and_aggregates(spark):
    empty = W.sparse_wide(spark.createDataFrame([], SCHEMA), "userId", "t", "v")
    assert empty.n_columns == 0 and empty.rows.isEmpty() and W.cells(empty).isEmpty()
    assert W.row_statistics(empty).isEmpty() and W.arrange(empty, "x").isEmpty() and W.complete(empty).rows.isEmpty()
    df = spark.createDataFrame([(1, "a", 1.0), (1, "a", 3.0)], "userId long, t string, v double")
    for agg, value in (("sum", 4.0), ("max", 3.0), ("min", 1.0), ("avg", 2.0)):
        assert [r["vals"] for r in W.sparse_wide(df, "userId", "t", "v", agg=agg).rows.collect()] == [[value]]
