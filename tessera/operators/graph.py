"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.scratch import discard, stored


def _star(pairs: DataFrame, large: bool) -> DataFrame:
    """One step over (u, v): every u links its neighbours to the smallest node around it.

    large: neighbours above u, of both directions; else neighbours below u, and u itself.
    The minimum is pre-aggregated and joined back, so a hub with very many neighbours is
    split by AQE's skew join instead of being one group.
    """
    if large:
        pairs = pairs.union(pairs.select("v", "u"))
    else:
        pairs = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = pairs.join(least, "u")
    if large:
        return joined.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    return joined.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of the edges; component is the smallest node reachable.

    Edges may repeat, point either way and be loops (an isolated node); edges with a null
    end are ignored.  The rounds grow with the logarithm of the longest path.  Each round's
    edges are stored, so a lost executor costs no recomputation.
    """
    both = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    both = stored(both, small=True)
    now = both.where("u <> v").distinct()
    mark = None
    for i in range(max_rounds):
        last, now = now, stored(_star(_star(now, True), False), small=True)
        if i:
            discard(last)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    nodes = both.select(F.explode(F.array("u", "v")).alias("u")).distinct()
    return nodes.join(now, "u", "left").select(F.col("u").alias("node"), F.coalesce("v", "u").alias("component"))
