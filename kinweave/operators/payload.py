"""Ego payloads: nodes and edges as one document for each ego, to JSON and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NODE = "struct<id:string,label:string,sex:string,kin:string,cluster:string>"
EDGE = "struct<source:string,target:string,type:string>"


def payloads(nodes: DataFrame, edges: DataFrame, generated_at: str, lang: str = "en", depth: int = 3) -> DataFrame:
    """``(entity_person_id, ego_json, generated_at)``; nodes and edges sorted, nulls kept.  ``generated_at`` is a UTC timestamp text."""
    n = nodes.groupBy("ego").agg(F.array_sort(F.collect_list(F.struct("id", "label", "sex", "kin", "cluster"))).alias("nodes"))
    e = edges.groupBy("ego").agg(F.array_sort(F.collect_list(F.struct("source", "target", "type"))).alias("edges"))
    none = F.array().cast(f"array<{EDGE}>")
    return documents(n.join(e, "ego", "left").withColumn("edges", F.coalesce("edges", none)), generated_at, lang, depth)


def documents(networks: DataFrame, generated_at: str, lang: str = "en", depth: int = 3) -> DataFrame:
    """As ``payloads``, of ``networks(ego, nodes, edges)`` whose nodes and edges are sorted arrays."""
    doc = F.struct(F.col("ego").alias("root"), F.lit(lang).alias("lang"), F.lit(depth).alias("depth"), "nodes", "edges", F.lit(generated_at.replace(" ", "T") + "Z").alias("generated_at"))
    return networks.select(F.col("ego").alias("entity_person_id"), F.to_json(doc, {"ignoreNullFields": "false"}).alias("ego_json"), F.lit(generated_at).cast("timestamp").alias("generated_at"))


def _once(column: str) -> Column:
    """A sorted array without repeats: each element is compared with the one before it, not with all as ``array_distinct`` does with structs."""
    return F.filter(column, lambda x, i: (i == 0) | ~x.eqNullSafe(F.get(column, i - 1))).alias(column)


def parsed(cache: DataFrame) -> DataFrame:
    """``(ego, nodes, edges)`` of cached documents, without what a document repeats; edges without an end go."""
    doc = cache.select(F.from_json("ego_json", f"struct<root:string,nodes:array<{NODE}>,edges:array<{EDGE}>>").alias("d"))
    whole = F.filter("d.edges", lambda e: e["source"].isNotNull() & e["target"].isNotNull())
    doc = doc.select(F.col("d.root").alias("ego"), F.sort_array("d.nodes").alias("nodes"), F.sort_array(whole).alias("edges"))
    return doc.select("ego", _once("nodes"), _once("edges"))


def _each(doc: DataFrame, rows: Column) -> DataFrame:
    """A row for each struct of an array.  No filter is left for Spark to move below the parsing of documents, which it would repeat there for each element."""
    return doc.select("ego", F.posexplode_outer(rows).alias("i", "x")).where("i is not null").select("ego", "x.*")


def explode_payloads(cache: DataFrame, once: bool = False) -> tuple[DataFrame, DataFrame]:
    """Nodes (ego, id, label, sex, kin, cluster) and edges (ego, source, target, type) of cached documents; edges without an end go.

    ``once``: no two documents have a root in common, as in a cache by key; then nothing is shuffled.
    """
    doc = parsed(cache)
    nodes, edges = _each(doc, F.col("nodes")), _each(doc, F.col("edges"))
    return (nodes, edges) if once else (nodes.distinct(), edges.distinct())


def sizes(cache: DataFrame) -> DataFrame:
    """``(ego, nodes, edges)``: how many of either a document with nodes holds, where no two documents have a root in common."""
    doc = parsed(cache).select("ego", F.struct(F.size("nodes").cast("long").alias("nodes"), F.greatest(F.size("edges"), F.lit(0)).cast("long").alias("edges")).alias("n"))
    return _each(doc, F.when(F.col("n.nodes") > 0, F.array("n")))


def adjacency_of(cache: DataFrame) -> DataFrame:
    """As ``adjacency`` of the edges of a cache, where no two documents have a root in common: what recurs does so within a document."""
    kind = lambda e: F.upper(e["type"])
    row = lambda e: F.struct(e["target"].alias("a"), e["source"].alias("b"), kind(e).alias("kind"))
    rows = F.sort_array(F.transform(F.filter("edges", lambda e: kind(e).isin("CHILD_OF", "SPOUSE_OF")), row)).alias("rows")
    return _each(parsed(cache).select("ego", rows), _once("rows"))


def adjacency(edges: DataFrame) -> DataFrame:
    """(parent_id, child_id, kind) with the type in upper case, for both edge types of a payload."""
    t = F.upper("type")
    return edges.where("source is not null and target is not null").select("ego", F.col("target").alias("a"), F.col("source").alias("b"), t.alias("kind")).where(F.col("kind").isin("CHILD_OF", "SPOUSE_OF")).distinct()
