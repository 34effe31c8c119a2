"""Connected components by contraction, with joins and aggregates only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.llm.common import cut


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of the undirected ``edges`` (a, b); root is the smallest node of its component. Loops and nulls are ignored.

    A round hangs every node on its smallest neighbour, follows those pointers twice more, and replaces each edge by the edge between what its
    ends now hang on; rounds go on until no edge is left, about log2 of the longest path. Minima are taken before the shuffle and
    every round is written to the shared folder, so a node with very many edges or a lost executor does no harm.
    """
    left = cut(edges.select("a", "b").where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    roots: DataFrame | None = None
    while not left.isEmpty():
        both = left.union(left.select("b", "a")).toDF("node", "other")
        up = cut(both.groupBy("node").agg(F.min("other").alias("root")).select("node", F.least("node", "root").alias("root")))
        for _ in range(2):
            far = up.toDF("root", "far")
            up = up.join(far, "root").select("node", F.col("far").alias("root"))
        up = cut(up)
        ends = left.join(up.toDF("a", "x"), "a").join(up.toDF("b", "y"), "b").where("x <> y")
        left = cut(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        if roots is None:
            roots = up
        else:
            roots = cut(roots.join(up.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root")))
    if roots is None:
        kind = dict(edges.dtypes)["a"]
        return edges.sparkSession.createDataFrame([], f"node {kind}, root {kind}")
    return roots
