"""Connected components of a graph given as edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conform.llm.staging import staged


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """``node`` and ``component`` (its smallest reachable node) for every node of an edge between different nodes.

    Large-star and small-star alternate: every node hands its larger, then its smaller neighbours to the smallest node
    it knows, until nothing moves. Rounds grow with the logarithm of the longest chain. A star's centre may have any
    number of leaves: the minimum is aggregated in parts before the shuffle, written, and joined back as a table, since
    adaptive execution splits a skewed centre only where both sides of a join come straight from a shuffle. Each round is staged, so a lost executor repeats one round at most. Edges to null and
    loops are ignored; an empty input gives an empty result.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
        F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b))
    )
    links = staged(links.distinct(), "links")
    state = None
    while True:
        links = staged(_small_star(staged(_large_star(links), "links")), "links")
        totals = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 24)), F.bit_xor(F.xxhash64("u", "v"))).head()
        if totals == state or totals[0] == 0:
            break
        state = totals
    leaves = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return leaves.unionByName(centres)


def _large_star(links: DataFrame) -> DataFrame:
    """Links (u > v): every neighbour of u above u goes to the smallest of u and its neighbours."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = staged(both.groupBy("u").agg(F.min("v").alias("m")), "least")
    return (
        links.select(F.col("v").alias("u"), F.col("u").alias("w"))
        .join(least, "u")
        .select(F.col("w").alias("u"), F.least("u", "m").alias("v"))
        .distinct()
    )


def _small_star(links: DataFrame) -> DataFrame:
    """Links (u > v): u and its neighbours below u go to the smallest of them."""
    least = staged(links.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = links.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
