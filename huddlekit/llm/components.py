"""Connected components of an edge table by repeated contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from huddlekit.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """``v, root`` for every vertex of ``edges(a, b)``: ``root`` is the
    smallest vertex reachable. Each round hooks every vertex to its smallest
    neighbour, jumps once to the parent's parent and contracts the edges; the
    number of edges falls each round, and a hub is only ever aggregated."""
    ends = edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    edges = cut(ends.filter("a < b").distinct(), "edges")
    maps: list[DataFrame] = []
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("p")).select("v", F.least("v", "p").alias("p"))
        grand = parent.select(F.col("v").alias("p"), F.col("p").alias("root"))
        jumped = cut(parent.join(grand, "p").select("v", "root"), "hooks")
        to_a = jumped.select(F.col("v").alias("a"), F.col("root").alias("x"))
        to_b = jumped.select(F.col("v").alias("b"), F.col("root").alias("y"))
        moved = edges.join(to_a, "a").join(to_b, "b").select("x", "y")
        tree = jumped.select(F.col("root").alias("x")).distinct().join(
            jumped.select(F.col("v").alias("x"), F.col("root").alias("y")), "x").select("x", "y")
        edges = cut(moved.unionByName(tree).filter("x <> y")
                    .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "edges")
        maps.append(jumped)
    if not maps:
        return edges.select(F.col("a").alias("v"), F.col("b").alias("root"))
    labels = maps[0]
    for m in maps[1:]:
        labels = (labels.join(m.select(F.col("v").alias("root"), F.col("root").alias("up")), "root", "left")
                  .select("v", F.coalesce("up", "root").alias("root")))
    return cut(labels, "labels")
