"""Collects the registered queries from every query module."""

from __future__ import annotations

import importlib

MODULES = ["q_sets", "q_models", "q_eda", "q_views", "q_factors", "q_io", "q_more"]


def _load():
    from ratingspark.plans import queries as Q
    for m in MODULES:
        try:
            importlib.import_module(f"ratingspark.plans.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"ratingspark.plans.{m}":
                raise
    return Q


def queries():
    return dict(_load().QUERIES)


def oracle_sql():
    return dict(_load().ORACLES)
