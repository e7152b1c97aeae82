"""The corpus pipeline: STAGES and run().

Each stage is a function (spark, docs, sf_dir) -> DataFrame; its result is
written as Parquet and read again as the next one's docs. All but the last
return the columns of ``documents``.

Defined cases, of run() and of every stage: a NULL text counts as empty; NULL
doc_ids, langs and sources are values like any other (labels of a NULL doc_id
are not used); equal texts leave the row with the largest doc_id, repeated rows
one of them; extra columns of ``documents`` are carried, whatever their names;
empty documents give no pieces, and without labels no document is rejected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ratingspark.llm import stages
from ratingspark.llm.common import Scratch, table

STAGES = [
    ("toxicity", stages.toxicity),
    ("exact_dedup", stages.exact_dedup),
    ("near_dedup", stages.near_dedup),
    ("mixing", stages.mixing),
    ("packing", stages.packing),
]

# The toxicity stage learns a language model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences of the cleaned, mixed corpus."""
    scratch = Scratch(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        made = len(Scratch.made)
        docs = scratch.keep(stage(spark, docs, sf_dir))
        Scratch.clear(made)   # the stage's own tables; its result is stored
    return STAGES[-1][1](spark, docs, sf_dir)
