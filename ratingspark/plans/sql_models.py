"""SQL fragments for bias chains (one penalty or a grid), used by the oracles.

A chain is written as CTEs {p}_lam (the penalties) and {p}_g0..{p}_g{n-1}
(stage tables with columns lam, key, b). Stage frames and the scored
relation carry a column ``base`` (the global mean or a baseline
prediction), so one builder serves every model.
"""

from __future__ import annotations

from ratingspark.plans.oracle import clamp, lam_values

NULLSAFE = {"release_year"}


def _cond(a: str, b: str, key: str) -> str:
    return f"{a}.{key} IS NOT DISTINCT FROM {b}.{key}" if key in NULLSAFE else f"{a}.{key} = {b}.{key}"


def chain_ctes(p: str, lambdas, keys: list[str], frames: list[str], lam_sql: str | None = None) -> str:
    """``lam_sql`` (a SELECT yielding column ``lam``) replaces the literal list."""
    lam = lam_sql if lam_sql is not None else f"SELECT lam FROM {lam_values(lambdas)}"
    out = [f"{p}_lam AS ({lam})"]
    for j, key in enumerate(keys):
        joins = "".join(f" LEFT JOIN {p}_g{i} ON {p}_g{i}.lam = l.lam AND {_cond('t', f'{p}_g{i}', keys[i])}"
                        for i in range(j))
        terms = "".join(f" - {p}_g{i}.b" for i in range(j))
        out.append(f"""{p}_g{j} AS (
  SELECT l.lam, t.{key}, sum(t.rating - t.base{terms}) / (l.lam + count(*)) AS b, count(*) AS n
  FROM {frames[j]} t CROSS JOIN {p}_lam l{joins}
  GROUP BY l.lam, t.{key})""")
    return ",\n".join(out)


def chain_pred(p: str, keys: list[str], score: str, do_clamp: bool, pred: str = "pred") -> str:
    """Relation: every column of ``score``, lam, and the prediction."""
    joins = "".join(f" LEFT JOIN {p}_g{i} ON {p}_g{i}.lam = l.lam AND {_cond('c', f'{p}_g{i}', k)}"
                    for i, k in enumerate(keys))
    s = "c.base" + "".join(f" + {p}_g{i}.b" for i in range(len(keys)))
    expr = clamp(f"({s})") if do_clamp else f"({s})"
    return f"(SELECT c.*, l.lam, {expr} AS {pred} FROM {score} c CROSS JOIN {p}_lam l{joins})"


def curve_select(pred_rel: str) -> str:
    return f"""SELECT lam AS param,
       round(CASE WHEN count(pred) = count(*) THEN sqrt(sum((rating - pred) * (rating - pred)) / count(*)) END, 6) AS rmse,
       count(*) AS n, count(pred) AS n_pred
FROM {pred_rel} q GROUP BY lam"""


def rmse_select(pred_rel: str, model: str | None = None, param: float | None = None) -> str:
    head = ""
    if model is not None:
        head = f"'{model}' AS model, CAST('{float(param)!r}' AS DOUBLE) AS param, "
    return f"""SELECT {head}round(CASE WHEN count(pred) = count(*) THEN sqrt(avg((rating - pred) * (rating - pred))) END, 6) AS rmse,
       count(*) AS n, count(*) - count(pred) AS n_missing
FROM {pred_rel} q"""


def with_base(rel: str, base: str = "m.mu", month: bool = False) -> str:
    from ratingspark.plans.oracle import round_month
    mcol = f", {round_month('t.rating_date')} AS rating_month" if month else ""
    return f"(SELECT t.*{mcol}, {base} AS base FROM {rel} t CROSS JOIN mu_t m)"


def rmse_raw(pred_rel: str, model: str, param_sql: str) -> str:
    """Unrounded (model, param, r, n, n_missing) for composing tables."""
    return f"""SELECT '{model}' AS model, CAST({param_sql} AS DOUBLE) AS param,
       CASE WHEN count(pred) = count(*) THEN sqrt(avg((rating - pred) * (rating - pred))) END AS r,
       count(*) AS n, count(*) - count(pred) AS n_missing
FROM {pred_rel} q"""
