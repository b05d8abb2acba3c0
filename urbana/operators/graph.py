"""Connected components on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from urbana.session import cut

HUBS = 4096


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Rows ``(node, component)``: the smallest node reachable, for every node on an edge.

    Alternating large and small stars: each node links its larger neighbours, then its smaller ones, to the smallest node
    it knows, until only stars remain. Smallest neighbours are partial aggregates, so a hub costs one row per map task;
    the two joins have one row per node on one side, and those of the few hubs are broadcast. What several joins read is
    written and read again, so that nothing is worked out twice and a plan never holds more than one step; links never
    grow in number, and their number of rounds grows with the logarithm of the longest path.
    Edges with a null end, and self loops, are ignored; repeated edges count once; an empty input gives an empty result.
    """
    ends = edges.select(F.col(a).alias("x"), F.col(b).alias("y")).where("x <> y")
    links = cut(ends.select(F.greatest("x", "y").alias("high"), F.least("x", "y").alias("low")).distinct())
    state = _state(links)
    while state[0]:
        sides = links.select(F.col("high").alias("node"), F.col("low").alias("other")).unionByName(links.select(F.col("low").alias("node"), F.col("high").alias("other")))
        least = sides.groupBy("node").agg(F.min("other").alias("least"), F.count(F.lit(1)).alias("n"))
        least = cut(least.select(F.col("node").alias("low"), F.least("node", "least").alias("least"), "n"))
        large = cut(_by_node(links, least, "low", state[0]).select("high", F.col("least").alias("low")))
        lowest = cut(large.groupBy("high").agg(F.min("low").alias("least"), F.count(F.lit(1)).alias("n")))
        passed_on = _by_node(large, lowest, "high", state[0]).where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
        links = cut(passed_on.unionByName(lowest.select("high", F.col("least").alias("low"))).distinct())
        before, state = state, _state(links)
        if state == before:
            break
    roots = links.select(F.col("low").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return links.select(F.col("high").alias("node"), F.col("low").alias("component")).unionByName(roots)


def _by_node(links: DataFrame, nodes: DataFrame, key: str, total: int) -> DataFrame:
    """The join of ``total`` links with ``nodes(key, least, n)`` of ``n`` links each. At most ``2 * HUBS`` nodes can have over
    ``1 / HUBS`` of the links each: these are broadcast, so that a hub's links don't meet in one task."""
    hubs = F.broadcast(nodes.where(F.col("n") > total / HUBS).drop("n"))
    others = links.join(hubs.select(key), key, "left_anti")
    return links.join(hubs, key).unionByName(others.join(nodes.where(F.col("n") <= total / HUBS).drop("n"), key))


def _state(links: DataFrame) -> tuple[int, int | None]:
    """Number and checksum of the links, which no longer change once they are stars."""
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())
