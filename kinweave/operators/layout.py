"""Coordinates and clusters of the five-tier layout, for all egos at once."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Horizontal distance of neighbours, and the heights of the rows.
GAP = 3.2
ROWS = {"grandparents": -3.6, "parents": -1.8, "root": 0.0, "children": 1.8, "grandchildren": 3.6}


def five_tier_layout(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(ego, id, kin)`` and ``edges(ego, source, target, type)`` of five-tier trees -> ``(ego, id, x, y)``.

    The ego stands in the middle, its spouses to the right, siblings in turn
    left and right, parents above and children below their parents' middle,
    grouped by mother.  Grandparents and grandchildren are left to their clusters.
    """
    of = lambda *kins: nodes.where(F.col("kin").isin(*kins)).select("ego", "id")
    at = lambda df, x, y: df.select("ego", "id", x.cast("double").alias("x"), F.lit(ROWS[y]).alias("y"))
    i = F.row_number().over(Window.partitionBy("ego").orderBy("id"))
    spouses = of("husband", "wife", "spouse").withColumn("i", i)
    count = spouses.groupBy("ego").agg(F.count("*").alias("spouses"))
    sib = of("brother", "sister", "sibling").withColumn("i", i - 1).join(count, "ego", "left").withColumn("m", F.coalesce("spouses", F.lit(0)))
    half = F.floor(F.col("i") / 2)
    sib_x = F.when(F.col("i") % 2 == 0, -(half + 1) * GAP).otherwise((F.col("m") + half + 1) * GAP)
    up = edges.where("type = 'CHILD_OF'").select("ego", F.col("source").alias("id"), F.col("target").alias("parent"))
    kids = of("son", "daughter", "child").join(up.join(spouses.select("ego", F.col("id").alias("parent"), F.col("i").alias("slot")), ["ego", "parent"]).groupBy("ego", "id").agg(F.min("slot").alias("slot")), ["ego", "id"], "left").withColumn("slot", F.coalesce("slot", F.lit(0)))
    w = Window.partitionBy("ego", "slot")
    kids = kids.withColumn("i", F.row_number().over(w.orderBy("id")) - 1).withColumn("n", F.count("*").over(w))
    kid_x = F.col("slot") * GAP / 2 + (F.col("i") - (F.col("n") - 1) / 2) * GAP
    return reduce(
        DataFrame.unionByName,
        [
            at(of("self"), F.lit(0.0), "root"),
            at(spouses, F.col("i") * GAP, "root"),
            at(sib, sib_x, "root"),
            at(of("father"), F.lit(-0.9 * GAP), "parents"),
            at(of("mother"), F.lit(0.9 * GAP), "parents"),
            at(kids, kid_x, "children"),
        ],
    )


def bounding_box(layout: DataFrame) -> DataFrame:
    """Extent and middle of each ego's layout."""
    box = layout.groupBy("ego").agg(*[f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))])
    return box.select("*", ((F.col("min_x") + F.col("max_x")) / 2).alias("mid_x"), ((F.col("min_y") + F.col("max_y")) / 2).alias("mid_y"))


#: Ids of the clusters, and the types of their edges.
CLUSTERS = {
    "inlaws": ("__cluster_inlaws__", "IN_LAW"),
    "grandparents_f": ("__cluster_grandparents_f__", "PATERNAL_GP"),
    "grandparents_m": ("__cluster_grandparents_m__", "MATERNAL_GP"),
    "grandchildren": ("__cluster_grandchildren__", "DESCENDANT"),
}
SPOUSES, CHILDREN = ("husband", "wife", "spouse"), ("son", "daughter", "child")


def _parents(nodes: DataFrame) -> DataFrame:
    """``(ego, id, side)``: of each ego's fathers and mothers the smallest id, whose parents are the cluster of that side."""
    side = F.when(F.col("kin") == "father", "grandparents_f").when(F.col("kin") == "mother", "grandparents_m")
    return nodes.withColumn("side", side).where("side is not null").groupBy("ego", "side").agg(F.min("id").alias("id")).select("ego", "id", "side")


def cluster_members(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``nodes(ego, id, kin)`` and ``edges(ego, source, target, type)`` -> ``(ego, cluster, id)``, a row for each member.

    The father's parents, the mother's parents, the spouses' parents that are not
    the ego's own, and the children's children, as far as the network shows
    them; a person may be in several clusters.  The rows of a cluster are not
    gathered, so a large one is as good as many small ones.
    """
    up = edges.where("type = 'CHILD_OF'").select("ego", F.col("source").alias("id"), F.col("target").alias("parent")).distinct()
    of = lambda df, cluster, member: df.select("ego", F.lit(cluster).alias("cluster"), F.col(member).alias("id"))
    sides = _parents(nodes).join(up, ["ego", "id"]).select("ego", F.col("side").alias("cluster"), F.col("parent").alias("id"))
    own = up.where("id = ego").select("ego", "parent")
    spouses = nodes.where(F.col("kin").isin(*SPOUSES)).select("ego", "id")
    inlaws = of(spouses.join(up, ["ego", "id"]).join(own, ["ego", "parent"], "left_anti"), "inlaws", "parent")
    kids = up.where("parent = ego").select("ego", F.col("id").alias("parent"))
    return reduce(DataFrame.unionByName, [sides, inlaws, of(kids.join(up, ["ego", "parent"]), "grandchildren", "id")]).distinct()


def _name(cluster, k: int):
    return F.element_at(F.create_map(*[F.lit(x) for c, v in CLUSTERS.items() for x in (c, v[k])]), cluster)


def clusters(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``(ego, id, n, x, y)``: a node for each cluster that has members.

    In-laws stand one and a half places beyond the last spouse (at 2.5 places where none is shown).
    """
    count = nodes.where(F.col("kin").isin(*SPOUSES)).groupBy("ego").agg(F.count("*").alias("spouses"))
    rows = members.groupBy("ego", "cluster").agg(F.count("*").alias("n")).join(count, "ego", "left")
    c = F.col("cluster")
    x = F.when(c == "grandparents_f", -0.9 * GAP).when(c == "grandparents_m", 0.9 * GAP).when(c == "grandchildren", 0.0).otherwise((F.coalesce(F.col("spouses") + 1.5, F.lit(2.5))) * GAP)
    y = F.when(c == "inlaws", ROWS["parents"]).when(c == "grandchildren", ROWS["grandchildren"]).otherwise(ROWS["grandparents"])
    return rows.select("ego", _name(c, 0).alias("id"), "n", x.alias("x"), y.alias("y"))


def cluster_edges(nodes: DataFrame, members: DataFrame) -> DataFrame:
    """``(ego, source, target, type)``: from a side's grandparents to the father or mother, from the in-laws to each spouse, from the grandchildren to each child.

    Where no spouse or child is shown, the ego takes their place.
    """
    role = F.when(F.col("kin").isin(*SPOUSES), "inlaws").when(F.col("kin").isin(*CHILDREN), "grandchildren")
    near = nodes.withColumn("cluster", role).where("cluster is not null").select("ego", "cluster", F.col("id").alias("target"))
    ends = near.unionByName(_parents(nodes).select("ego", F.col("side").alias("cluster"), F.col("id").alias("target")))
    rows = members.select("ego", "cluster").distinct().join(ends, ["ego", "cluster"], "left")
    return rows.select("ego", _name(F.col("cluster"), 0).alias("source"), F.coalesce("target", "ego").alias("target"), _name(F.col("cluster"), 1).alias("type"))
