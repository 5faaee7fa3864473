"""Connected components of a graph held as rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.shared import kept


def components(edges: DataFrame) -> DataFrame:
    """``edges`` has a and b, of any type that has an order. Gives ``node`` and
    ``root``, the smallest node reachable, for every node with an edge to another.

    Alternates two steps until nothing changes: every node's larger neighbours, then
    its smaller ones, are moved to its smallest neighbour. Rounds grow with the
    logarithm of the longest path, each is a few joins, and no task holds a component.
    Each round is written, so that lineage and retries stay short. A null end is no edge.
    """
    now = kept(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .distinct(),
        "edges",
    )
    seen = None
    while (stamp := _stamp(now)) != seen and stamp[0]:
        seen = stamp
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        larger = (
            both.join(lowest, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("low").alias("b"))
            .distinct()
        )
        nearest = larger.groupBy("a").agg(F.min("b").alias("low"))
        moved = (
            larger.join(nearest, "a")
            .select(F.explode(F.array("a", "b")).alias("a"), F.col("low").alias("b"))
            .where("a <> b")
            .distinct()
        )
        now = kept(moved, "edges")
    root = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return root.union(root.select(F.col("root").alias("node"), "root").distinct())


def _stamp(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )
