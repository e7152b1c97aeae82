"""Column-level functions (all built-in Spark expressions, codegen friendly)."""

from ratingspark.functions.columns import (
    epoch_to_date,
    release_year,
    tidy_title,
    trim_ws,
    round_month,
    clamp,
    residual,
    param_grid,
    normal_quantiles,
    ppoints,
)

__all__ = [
    "epoch_to_date", "release_year", "tidy_title", "trim_ws", "round_month",
    "clamp", "residual", "param_grid", "normal_quantiles", "ppoints",
]
