"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from traitflow.llm import common as C


def components(edges: DataFrame) -> DataFrame:
    """node, comp (smallest node reachable) for every node of ``edges`` (a, b).

    Min-label propagation with pointer jumping: each round a node takes the smallest label among
    its neighbours (a combined aggregation, so a hub's neighbours meet as partial minima) and then
    its label's label. Labels are written each round to the shared folder."""
    both = C.written(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), "cc-edges")
    labels = C.written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("comp")), "cc-labels")
    while True:
        seen = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("comp").alias("near"))
        stepped = labels.join(seen, F.col("node") == F.col("a")).select("node", F.col("comp").alias("was"), F.least("comp", "near").alias("comp"))
        jump = labels.select(F.col("node").alias("at"), F.col("comp").alias("to"))
        moved = C.written(stepped.join(jump, F.col("comp") == F.col("at"), "left")
                          .select("node", "was", F.least("comp", F.coalesce("to", "comp")).alias("comp")), "cc-labels")
        if moved.filter("was <> comp").isEmpty():
            return moved.select("node", "comp")
        labels = moved.select("node", "comp")
