"""Connected components of a graph in a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewell.session import materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node of an edge; the label is the smallest node of its component.

    Every round a node takes the least label among its neighbours', and then that node's label, so the
    way to the smallest node about halves. Each round is written to the shared folder.
    """
    both = edges.select(F.col(a).alias("node"), F.col(b).alias("other")).unionByName(edges.select(F.col(b).alias("node"), F.col(a).alias("other"))).distinct()
    both = materialise(both, "edges")
    labels = materialise(both.groupBy("node").agg(F.least(F.col("node"), F.min("other")).alias("label"), F.lit(True).alias("moved")), "labels")
    while not labels.where("moved").isEmpty():
        near = both.join(labels.select(F.col("node").alias("other"), "label"), "other").groupBy("node").agg(F.min("label").alias("near"))
        best = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        jump = best.alias("x").join(labels.select(F.col("node").alias("at"), F.col("label").alias("further")), F.col("x.label") == F.col("at"))
        new = jump.select("node", F.least("label", "further").alias("label"), "old")
        labels = materialise(new.select("node", "label", (F.col("label") < F.col("old")).alias("moved")), "labels")
    return labels.select("node", "label")
