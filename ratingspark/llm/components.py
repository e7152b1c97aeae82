"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratingspark.llm.common import Scratch


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(uid, label) for every end of ``links`` (x, y): label is the smallest
    uid of its component. Each round takes the smallest label next to a node,
    then the label of that label, until nothing changes: about log2 of the
    longest path rounds, each a few joins over written tables."""
    links = links.where("x <> y")
    both = scratch.keep(links.select("x", "y").unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y")))
                             .distinct())
    labels, path = scratch.write(both.groupBy(F.col("x").alias("uid")).agg(F.min("y").alias("m"))
                                     .select("uid", F.least("uid", "m").alias("label")))
    while True:
        near = (both.join(labels.withColumnRenamed("uid", "y"), "y").groupBy(F.col("x").alias("uid"))
                    .agg(F.min("label").alias("near")))
        step = labels.join(near, "uid").select("uid", "label", F.least("label", "near").alias("new"))
        jump = labels.select(F.col("uid").alias("new"), F.col("label").alias("over"))
        new, new_path = scratch.write(step.join(jump, "new").select(
            "uid", F.least("new", "over").alias("label"), (F.least("new", "over") < F.col("label")).alias("moved")))
        still = new.where("moved").isEmpty()
        scratch.drop(path)
        labels, path = new.select("uid", "label"), new_path
        if still:
            return labels
