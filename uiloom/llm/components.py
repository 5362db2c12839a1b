"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from uiloom.llm.common import stage


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """For links (a, b): `node` and `label`, the label being equal for nodes that links connect.
    labels: what an earlier call returned for other links of the same graph.

    Each round maps every node to the smallest of itself and its neighbours and moves the links to
    those, until no link joins two different nodes. Node numbers should be hashes: then the number
    of rounds is logarithmic also for chains. Minima are aggregated before they are shuffled, so a
    node with very many links is not gathered anywhere. No links: no rows.
    """
    moving = links
    if labels is not None:
        for end in ("a", "b"):
            known = labels.select(F.col("node").alias(end), F.col("label").alias(f"{end}_to"))
            moving = moving.join(known, end, "left").withColumn(end, F.coalesce(f"{end}_to", end)).drop(f"{end}_to")
    moving = stage(moving.where("a <> b").select("a", "b").distinct(), "links")
    steps: list[DataFrame] = []
    while not moving.isEmpty():
        both = moving.union(moving.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = stage(both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).select(F.col("a").alias("node"), "to"), "step")
        steps.append(step)
        ends = moving
        for end in ("a", "b"):
            ends = ends.join(step.select(F.col("node").alias(end), F.col("to").alias(f"{end}_to")), end)
        moving = stage(ends.where("a_to <> b_to").select(F.col("a_to").alias("a"), F.col("b_to").alias("b")).distinct(), "links")
    if not steps:
        return links.sparkSession.createDataFrame([], "node long, label long") if labels is None else labels
    # what a step maps to is mapped on by the next one
    own = steps[0].select("node", F.col("to").alias("label"))
    for step in steps[1:]:
        own = own.join(step.withColumnRenamed("node", "label"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    if labels is not None:
        moves = own.select(F.col("node").alias("label"), F.col("label").alias("to"))
        moved = labels.join(moves, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        own = moved.unionByName(own.join(labels.select("node"), "node", "left_anti"))
    return stage(own, "labels")
