"""Connected components of an edge table by alternating large-star and small-star steps.

Each step replaces the edges of a node by edges to its smallest neighbour; the graph turns into stars around the smallest
node of every component in a number of rounds that grows with the logarithm of the component's size. A round is a grouped
minimum (summed on the map side, so that a hub costs one row for each task) and a join on the node, which Spark splits
where a hub has many edges. Every round is written to the shared checkpoint folder. Nothing is gathered on the driver but
two sums that tell whether a round changed anything.

Cases: loops and repeated edges are ignored; nodes without edges are not in the result; null ends are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import cut


def _to_least(edges: DataFrame) -> DataFrame:
    """(node, least, other): each directed edge node -> other with the smallest of the node and its neighbours."""
    least = edges.groupBy("node").agg(F.min("other").alias("low")).select("node", F.least("node", "low").alias("least"))
    return edges.join(least, "node")


def components(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for each node of an edge the smallest node it can reach; the smallest ones have no row of their own."""
    edges = cut(
        pairs.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
        .filter(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("node") != F.col("other"))).distinct()
    )
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("other").alias("node"), F.col("node").alias("other")))
        large = _to_least(both).filter(F.col("other") > F.col("node")).select(F.col("other").alias("node"), F.col("least").alias("other"))
        down = large.filter(F.col("node") > F.col("other")).distinct()
        linked = _to_least(down)
        small = (
            linked.select(F.col("other").alias("node"), F.col("least").alias("other"))
            .unionByName(linked.select("node", F.col("least").alias("other")))
            .filter(F.col("node") != F.col("other")).distinct()
        )
        edges = cut(small)
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("node", "other").cast("decimal(38,0)"))).first()
        if state == before:
            return edges.select("node", F.col("other").alias("root"))
        before = state
