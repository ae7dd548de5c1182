"""Connected components of an edge table by local contraction, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.session import stored


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for each node that has an edge to another; the component is its smallest node.

    Each round every node takes the neighbour (or itself) of the lowest rank, ranks being hashes that
    differ from round to round, and nodes that took the same one become one node. The expected number of
    nodes left falls by a constant factor a round, also on long chains and stars; a node of very many edges
    is a minimum with partial aggregation and a join that Spark may split. Each round is written once to the
    shared folder, so a lost executor can not change it. Repeated edges are allowed; edges with a null end
    and self loops say nothing and are dropped; without edges there is no row.
    """
    pair = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    left = stored(pair.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "edges")
    found, rounds = None, 0
    while not left.isEmpty():
        rank = lambda c: F.struct(F.xxhash64(F.col(c), F.lit(rounds)).alias("h"), F.col(c).alias("n"))  # noqa: B023
        ends = left.select(F.col("a").alias("node"), rank("b").alias("r"), rank("a").alias("own")).union(
            left.select(F.col("b"), rank("a"), rank("b"))
        )
        taken = stored(ends.groupBy("node").agg(F.least(F.min("r"), F.min("own"))["n"].alias("to")), "contraction")
        left = stored(
            left.join(taken.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
            .join(taken.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
            .distinct(),
            "edges",
        )
        step = taken.select(F.col("node").alias("to"), F.col("to").alias("next"))
        found = taken if found is None else found.join(step, "to", "left").select("node", F.coalesce("next", "to").alias("to"))
        rounds += 1
    if found is None:
        return pair.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    found = stored(found, "components")
    smallest = found.groupBy("to").agg(F.min("node").alias("component"))
    return found.join(smallest, "to").select("node", "component")


def with_component(members: DataFrame, id_column: str, key: str, linked: DataFrame) -> DataFrame:
    """``members`` (rows with ``key``) with component_id: the smallest id among all members whose keys are in
    one component of ``linked`` (node, component); a key without an edge is a component of its own.

    Ids are first reduced to one per key, so that only the last join meets a key of very many members."""
    per_key = members.groupBy(key).agg(F.min(id_column).alias("__id"))
    per_key = per_key.join(linked.select(F.col("node").alias(key), F.col("component").alias("__c")), key, "left")
    alone = per_key.filter("__c IS NULL").select(key, F.col("__id").alias("component_id"))
    least = per_key.groupBy("__c").agg(F.min("__id").alias("component_id")).filter("__c IS NOT NULL")
    grouped = per_key.filter("__c IS NOT NULL").join(least, "__c").select(key, "component_id")
    return members.join(alone.union(grouped), key)
