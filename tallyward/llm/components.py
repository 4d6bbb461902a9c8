"""Connected components of a link table, by alternating large-star and small-star rounds.

In a round every node sends its least neighbour to its other neighbours. A
node with a third of all links would bring them all to one task there. So each
node's links are counted with the least neighbour, which partial sums reduce
before the shuffle, and nodes with more than ``HUB`` links are kept apart in a
table of their own: it has at most two rows for every ``HUB`` links, so Spark
sends it to the links, by its size, where they are, and only the links of other
nodes are shuffled. Each round is written to the shared folder, which ends its
lineage and survives the loss of executors. Nothing but three numbers per round
reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyward.llm.common import join_counted
from tallyward.session import stored_copy

#: Links of a node that one task may join.
HUB = 512


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.col("v").cast("decimal(38,0)"))
    ).first())


def components(links: DataFrame, purpose: str = "components", hub: int = HUB) -> DataFrame:
    """(node, component) for every node of ``links`` (columns u, v; long).

    The component is the smallest node reachable. Loops and NULL ends are
    left out; repeated links count once; an empty table gives no rows.
    """
    edges = links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    edges = stored_copy(edges, purpose)
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        met = join_counted(both.where("v > u"), least, "u", "n", hub, purpose)
        large = stored_copy(met.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), purpose)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (
            join_counted(large, least, "u", "n", hub, purpose)
            .select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("e"))
            .select(F.col("e.u").alias("u"), F.col("e.m").alias("v"))
            .where("u <> v")
            .distinct()
        )
        edges = stored_copy(small, purpose)
        after = _state(edges)
        if after == before:
            break
        before = after
    member = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return member.unionByName(roots)
