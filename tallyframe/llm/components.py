"""Connected components of a link table, by contraction rounds.

In each round every node that has a neighbour of lower priority moves onto the lowest one, and the
links move along; nodes without such a neighbour stay. Priorities are hashes of the ids, so each
round merges a constant share of the nodes whatever the shape of the components (long chains
included), and the number of rounds grows with the logarithm of the largest one. Every step is a
grouped minimum, which combines before its shuffle, or a join on a node, whose hot nodes Spark can split. Each
round's tables are written to the shared folder; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.staging import Workspace


def connected_components(work: Workspace, links: DataFrame) -> DataFrame:
    """node, component: the smallest node that can be reached, for every node that has a link.

    ``links`` has two columns of one integer type; order and repetition do not matter, loops and
    rows with a null are ignored.
    """
    first, second = links.columns
    a, b = F.col(f"`{first}`"), F.col(f"`{second}`")
    edges = work.keep(
        links.where((a != b) & a.isNotNull() & b.isNotNull())
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
        .distinct()
    )
    nodes = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    moves: list[DataFrame] = []
    current = edges
    while not current.isEmpty():
        both = current.select(
            F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("other")), F.struct(F.col("b").alias("node"), F.col("a").alias("other")))).alias("e")
        ).select("e.*")
        lowest = F.min(F.struct(F.xxhash64("other").alias("priority"), F.col("other").alias("to")))
        moved = work.keep(
            both.groupBy("node")
            .agg(lowest.alias("lowest"))
            .where(F.struct(F.col("lowest.priority"), F.col("lowest.to")) < F.struct(F.xxhash64("node"), F.col("node")))
            .select("node", F.col("lowest.to").alias("to"))
        )
        moves.append(moved)
        shifted = _follow(_follow(current, "a", moved), "b", moved)
        shifted = shifted.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        following = work.keep(shifted)
        if current is not edges:
            work.drop(current)
        current = following
    labels = nodes.withColumn("at", F.col("node"))
    for moved in moves:
        labels = _follow(labels, "at", moved)
    labels = work.keep(labels)
    names = labels.groupBy("at").agg(F.min("node").alias("component"))
    return work.keep(labels.join(names, "at").select("node", "component"))


def _follow(df: DataFrame, column: str, moved: DataFrame) -> DataFrame:
    """``df`` with the nodes of one column replaced by where they moved."""
    step = moved.select(F.col("node").alias("_from"), F.col("to").alias("_to"))
    joined = df.join(step, F.col(column) == F.col("_from"), "left")
    return joined.withColumn(column, F.coalesce("_to", column)).drop("_from", "_to")
