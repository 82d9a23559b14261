"""Connected components of an edge table by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickloom.llm.frames import stage


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that an edge (a, b) names; the root is one of the component's nodes.

    Each round points every node to the least of itself and its neighbours and replaces both ends of all
    edges by what they point to, so chains shrink and finished components drop out. Rounds
    grow with the logarithm of the longest chain. Each round's tables are staged; nothing goes to the driver
    but the number of edges left.
    """
    left = stage(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    roots = None
    while left.limit(1).count():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stage(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("to")), "pointers")
        if roots is None:
            roots = to.withColumnRenamed("to", "root")
        else:
            step = to.select(F.col("node").alias("root"), "to")
            roots = roots.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        roots = stage(roots, "roots")
        left = (left.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                .filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        left = stage(left, "edges")
    return roots if roots is not None else left.select(F.col("a").alias("node"), F.col("b").alias("root"))
