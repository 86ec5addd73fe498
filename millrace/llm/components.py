"""Connected components of a link table, without collecting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.sources.shared import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: link a node's larger (or other smaller) neighbours to its least neighbour."""
    if large:
        pairs = edges.union(edges.select("b", "a")).toDF("u", "v")
    else:
        pairs = edges.select(F.greatest("a", "b"), F.least("a", "b")).toDF("u", "v")
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = pairs.join(least, "u")
    if large:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node with a link; ``label`` is the least node of its component.

    ``edges`` has two bigint columns. Large-star and small-star steps alternate until every link
    goes straight to its component's least node; each result is written to the shared folder, so
    lineage stays short. A hub's links are never in one group: minima are summed up before the
    shuffle, and joins on a hub are left to be split where they are skewed.
    """
    edges = materialize(edges.toDF("a", "b").where("a <> b").distinct(), "links")
    while True:
        edges = materialize(_star(_star(edges, True), False), "links")
        lower = edges.select(F.col("b").alias("a")).intersect(edges.select("a"))
        if lower.isEmpty() and edges.groupBy("a").count().where("count > 1").isEmpty():
            return edges.select(F.col("a").alias("node"), F.col("b").alias("label")).union(
                edges.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
            )
