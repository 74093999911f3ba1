"""Connected components of an edge table, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adlake.llm.common import checkpointed


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of an edge; the root is the smallest node that can be reached.

    Each round takes the smallest root among the neighbours and then the root's own root, so that
    a path of n nodes takes about log n rounds.  Every round is checkpointed in the shared folder.
    A node with very many edges only costs a partial minimum; joins on it are split by AQE.
    An empty edge table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a <> b")
    both = checkpointed(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    root = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("root")))
    for _ in range(max_rounds):
        near = both.join(root.select(F.col("node").alias("b"), "root"), "b").groupBy("a").agg(F.min("root").alias("near"))
        step = root.join(near.withColumnRenamed("a", "node"), "node").select(
            "node", F.col("root").alias("old"), F.least("root", "near").alias("to"))
        step = checkpointed(step)
        hop = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        after = checkpointed(step.join(hop, "to").select("node", "old", F.col("next").alias("root")))
        moved = after.where("old <> root").limit(1).count()
        root = after.select("node", "root")
        if not moved:
            return root
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
