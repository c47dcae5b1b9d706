"""Connected components of an edge table, by contraction.

Every round orders the nodes anew by a hash, points each at the first node of its
closed neighbourhood, follows that pointer once more and replaces the edges by the edges
between those targets; loops and doubles vanish.  The order is random, so that less than
half of the nodes are left whatever their numbers (a chain of rising ids, too).  At the
end each node's chain of targets is followed, and the smallest node of each group names
it.  A round is one aggregate with map-side combine (hubs arrive as one row per task) and
three equi-joins whose skewed partitions Spark can split; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewatch.llm.common import cut

UNWIND = 4                      # rounds whose targets are followed in one query


def connected(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of an edge; component is its smallest node.

    ``edges`` has the columns ``a`` and ``b`` of one orderable type.  Null ends and
    loops are ignored; an empty table gives an empty result.
    """
    edges = cut(edges.select("a", "b").where("a <> b").distinct())
    hops = []
    for turn in range(max_rounds):
        if edges.isEmpty():
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        def place(node, seed=turn):
            return F.xxhash64(F.lit(seed), node)
        near = both.groupBy(F.col("a").alias("node")).agg(F.min_by("b", place(F.col("b"))).alias("near"))
        step = near.select("node", F.when(place(F.col("near")) < place(F.col("node")), F.col("near")).otherwise(F.col("node")).alias("to"))
        on = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        to = cut(step.join(on, "to").select("node", F.col("next").alias("to")))
        hops.append(to)
        left, right = to.select(F.col("node").alias("a"), F.col("to").alias("ta")), \
            to.select(F.col("node").alias("b"), F.col("to").alias("tb"))
        edges = cut(edges.join(left, "a").join(right, "b").where("ta <> tb")
                    .select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct())
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    if not hops:
        return edges.select(F.col("a").alias("node"), F.col("a").alias("component"))
    found = hops[-1].select("node", F.col("to").alias("component"))
    for done, to in enumerate(reversed(hops[:-1]), 1):
        nxt = found.select(F.col("node").alias("to"), "component")
        found = to.join(nxt, "to", "left").select("node", F.coalesce("component", "to").alias("component"))
        if done % UNWIND == 0:
            found = cut(found)
    found = cut(found)
    names = found.groupBy("component").agg(F.min("node").alias("least"))
    return cut(found.join(names, "component").select("node", F.col("least").alias("component")))
