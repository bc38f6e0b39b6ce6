"""Connected components of a graph given as edges, by large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matrixmill.plans.joins import lookup_join
from matrixmill.sources.tables import checkpointed


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Links neighbours of each node to the smallest of them and the node.

    ``edges`` hold ``(hi, lo)`` with ``hi > lo``. The large star links the larger neighbours,
    the small star the smaller ones. The minimum is a partial aggregation, and is stored before
    it is joined back, so that a node with very many edges does not end in one task.
    """
    both = edges.select(F.col("hi").alias("node"), F.col("lo").alias("other"))
    if large:
        both = both.unionByName(edges.select(F.col("lo").alias("node"), F.col("hi").alias("other")))
    least = checkpointed(
        both.groupBy("node").agg(F.min("other").alias("least")).select("node", F.least("node", "least").alias("least"))
    )
    linked = lookup_join(both, least, "node")
    if large:
        linked = linked.filter("other > node").select(F.col("other").alias("hi"), F.col("least").alias("lo"))
    else:
        linked = linked.select(F.col("other").alias("hi"), F.col("least").alias("lo")).unionByName(
            least.select(F.col("node").alias("hi"), F.col("least").alias("lo"))
        )
    return linked.filter("hi > lo").distinct()


def _digest(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("hi", "lo"))).first())


def connected_components(edges: DataFrame, left: str, right: str) -> DataFrame:
    """``(node, root)`` for every node with an edge; the root is the least node reachable.

    Ends when a round changes nothing: then every edge leads from a node to its root. Each
    round is checkpointed in the shared folder. Only a count and a hash reach the driver.
    """
    current = checkpointed(
        edges.select(
            F.greatest(left, right).alias("hi"), F.least(left, right).alias("lo")
        ).filter("hi > lo").distinct()
    )
    seen = _digest(current)
    while True:
        grown = checkpointed(_star(current, large=True))
        current = checkpointed(_star(grown, large=False))
        now = _digest(current)
        if now == seen:
            break
        seen = now
    roots = current.select("lo").distinct().select(F.col("lo").alias("node"), F.col("lo").alias("root"))
    return current.select(F.col("hi").alias("node"), F.col("lo").alias("root")).unionByName(roots)
