"""Connected components by alternating large-star and small-star (Kiveris et al., 2014).

Each round is joins and aggregations over the edge table, written to the shared folder; the driver sees
one count and one checksum of a round. A centre that a third of all nodes hang on is no task's burden: minima
are combined before they are shuffled and go back to the edges by broadcast while the round's counted edges
are few; beyond that edges are parted by their other ends, and each part gets the minimum of all parts.

Defined cases: loops and repeated edges change nothing; an edge counts in both directions; nodes without an edge
to another node are not in the result; no edges give an empty result; null ends are not allowed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aridspan.llm.common import n_tasks, stored


#: Edges up to which minima are broadcast: at most two a edge, of 16 bytes.
MAX_BROADCAST_EDGES = 200_000


def with_least(pairs: DataFrame, few: bool) -> DataFrame:
    """pairs (u, v) and m, the smallest v of each u; few: whether the minima may be broadcast."""
    if few:
        return pairs.join(F.broadcast(pairs.groupBy("u").agg(F.min("v").alias("m"))), "u")
    dealt = pairs.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(n_tasks(pairs))).cast("int"))
    parts = dealt.groupBy("u", "part").agg(F.min("v").alias("m"))
    least = parts.groupBy("u").agg(F.min("m").alias("m"))
    return dealt.join(parts.select("u", "part").join(least, "u"), ["u", "part"]).drop("part")


def large_star(edges: DataFrame, few: bool) -> DataFrame:
    """Connects each node's larger neighbours to the smallest node around it."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    near = with_least(both, few).withColumn("m", F.least("u", "m"))
    return near.filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def small_star(edges: DataFrame, few: bool) -> DataFrame:
    """Connects each node and its smaller neighbours to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = with_least(down, few)
    # the edge to the smallest one stays as it is
    return near.select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))


def components(edges: DataFrame) -> DataFrame:
    """node, component (the smallest node that can be reached) of every node of edges (u, v: long)."""
    now = stored(edges.filter("u <> v").select("u", "v").distinct(), "edges")
    state = None
    while True:
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64(F.least("u", "v"), F.greatest("u", "v")))).first()
        if seen[0] == 0 or seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        state = seen
        few = seen[0] <= MAX_BROADCAST_EDGES
        now = stored(small_star(large_star(now, few), few).distinct(), "edges")
