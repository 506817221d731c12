"""Distributed connected components: smallest label over the edges, with pointer jumping, one small table a round."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillscore.llm.common import drop_path, scratch_path


def connected_components(edges: DataFrame, name: str = "components", temporary: list[str] | None = None) -> DataFrame:
    """edges(a, b) of any orderable type -> (node, label): the smallest node that is reachable, for every node of an edge.

    Null ends and loops are ignored, repeated edges are harmless, no edges give an empty table. Each round joins the edges
    with the labels (a node with very many edges is a streamed side that adaptive execution splits), takes the minimum
    with map-side combining, and follows the labels' own labels, so that long chains halve. Rounds are written to the
    shared folder; nothing is collected but the number of changes. The labels' path is added to `temporary`, if given.
    """
    spark = edges.sparkSession
    both = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b").select("a", "b")
    both = both.unionByName(both.select(F.col("b").alias("a"), F.col("a").alias("b")))
    paths = []

    def keep(df: DataFrame, what: str) -> DataFrame:
        paths.append(scratch_path(spark, f"{name}-{what}"))
        df.write.parquet(paths[-1])
        return spark.read.schema(df.schema).parquet(paths[-1])

    both = keep(both.distinct(), "edges")
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("label")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).groupBy(F.col("a").alias("n")).agg(F.min("label").alias("near"))
        step = labels.join(near, labels.node == near.n, "left").select("node", F.col("label").alias("was"), F.least("label", F.coalesce("near", "label")).alias("label"))
        jump = labels.select(F.col("node").alias("p"), F.col("label").alias("of_p"))
        step = step.join(jump, step.label == jump.p, "left").select("node", "was", F.least("label", F.coalesce("of_p", "label")).alias("label"))
        before = paths[-1]
        new = keep(step, "labels")
        changed = new.where("was <> label").limit(1).count()
        drop_path(spark, before)
        labels = new.select("node", "label")
        if not changed:
            drop_path(spark, paths[0])  # the edges
            if temporary is not None:
                temporary.append(paths[-1])
            return labels
