"""Connected components of a link table by repeated contraction, all in Spark."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockwatch.llm.common import materialise


def components(links: DataFrame) -> DataFrame:
    """``id, component`` (smallest id of the component) of every id in the links ``a, b``.

    Each round every node takes the label of the neighbour (or itself) with the smallest hash, and links between labels
    remain; a random order shrinks even long chains by a constant factor a round. Node tables are stored each round, so
    lineage stays short and a lost executor costs one round at most. Hubs are aggregated before they are shuffled.
    """
    edges = materialise(links.where("a <> b").distinct(), "links")
    label = None  # id -> current label
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        chosen = both.groupBy("a").agg(F.min(F.struct(F.xxhash64("b").alias("h"), F.col("b").alias("id"))).alias("best"))
        own = F.struct(F.xxhash64("a").alias("h"), F.col("a").alias("id"))
        step = materialise(chosen.select(F.col("a").alias("id"), F.least(own, "best")["id"].alias("label")), "labels")
        if label is None:
            label = step
        else:
            moved = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
            label = materialise(label.join(moved, "label", "left").select("id", F.coalesce("next", "label").alias("label")), "labels")
        a, b = step.select(F.col("id").alias("a"), F.col("label").alias("x")), step.select(F.col("id").alias("b"), F.col("label").alias("y"))
        edges = edges.join(a, "a").join(b, "b").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        edges = materialise(edges.distinct(), "links")
        if edges.isEmpty():
            break
    smallest = label.groupBy("label").agg(F.min("id").alias("component"))
    return materialise(label.join(smallest, "label").select("id", "component"), "components")
