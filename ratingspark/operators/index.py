"""Dense 1-based codes of sorted ids (factor levels), computed without
moving all ids into one task: the distinct ids' positions in sort order
(``order_stats.with_position``, which reads its ranged ids from a written
table, so offsets and positions always come from the same exchange).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.operators.order_stats import with_position


def dense_index(df: DataFrame, col: str, name: str = "index", partitions: int | None = None) -> DataFrame:
    """(col, name) for every distinct non-NULL value of ``col``; codes
    1..n follow the sort order of the values."""
    ids = df.select(col).where(F.col(col).isNotNull()).distinct()
    return with_position(ids, [col], name, partitions)
