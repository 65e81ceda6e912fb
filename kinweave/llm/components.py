"""Connected components of an edge list by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """``edges(u, v)`` -> ``(node, root)`` with root the smallest node reachable.

    Each round hangs the larger neighbours of every node on its smallest one
    (large star), then the smaller ones (small star); stars shrink in
    O(log^2 n) rounds.  Minima are pre-aggregated map-side and written before
    they are joined back: neither side of that join is then an aggregate, so
    adaptive execution broadcasts small minima and splits the links of a hub
    over tasks otherwise.  Every round is written to the shared folder.  Nodes without an edge do not occur.  Null ends and loops
    are ignored; repeated edges do no harm; an empty list gives an empty table.
    """
    e = cut(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = cut(large, "large")
        low = cut(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        small = large.join(low, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        e = cut(small, "small")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if before == now:
            break
        before = now
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
