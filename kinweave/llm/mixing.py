"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.tables import small
from .common import cut, read

#: Slots of the schedule; a slot takes one block of about total / SLOTS words.
SLOTS = 1 << 18
EPOCHS = 3
#: Documents that a window over one (source, bucket) holds, about.
BUCKET = 2048
WORD = "[^\\x20\\x09-\\x0D]+"


def words(text: Column) -> Column:
    """Words of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: dict[str | None, int], weights=(1, 2, 3), epochs: int = EPOCHS) -> dict[str | None, float]:
    """Words of each source: by weight, at most ``epochs`` times its size; the excess goes to the others by weight."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total = sum(sizes.values())
    full: set = set()
    while True:
        left = total - sum(epochs * sizes[s] for s in full)
        mass = sum(weight[s] for s in names if s not in full)
        share = {s: left * weight[s] / mass for s in names if s not in full}
        over = {s for s, t in share.items() if t > epochs * sizes[s]}
        if not over:
            return {s: float(epochs * sizes[s]) if s in full else share[s] for s in names}
        full |= over


def schedule(spark: SparkSession, goal: dict[str | None, float], slots: int, block_words: int = 1) -> DataFrame:
    """``(slot, s, block)``: the source number of each slot and the rank of the slot within it.

    Slot i holds the golden-ratio point frac(i * phi), kept as a 32-bit fixed
    point so that every engine agrees, and goes to the source whose share of
    the cumulative weights holds that point.  Ranks come from two levels: slots
    counted by chunk and source, then numbered inside a chunk.  A source with
    fewer slots than its target has begun blocks gets the rest behind the last slot.
    """
    total = sum(goal.values())
    edges, acc = [], 0.0
    for t in goal.values():
        acc += t
        edges.append(min(1 << 32, round((1 << 32) * acc / total)) if total else 0)
    point = F.pmod(F.col("slot") * F.lit(2654435769), F.lit(1 << 32))
    spans = spark.createDataFrame([(i, (edges[i - 1] if i else 0) // (1 << 20), edges[i - 1] if i else 0, e) for i, e in enumerate(edges)], "s int, c long, lo long, hi long").where("hi > lo")
    # sources are found by an equi-join on the coarse cell of the point, cells being listed for each span
    cells = spans.select("s", "lo", "hi", F.explode(F.sequence(F.shiftright("lo", 20), F.shiftright(F.col("hi") - 1, 20))).alias("cell"))
    chunk = max(1, slots // 64)
    s = spark.range(slots).select(F.col("id").alias("slot"), point.alias("x")).withColumn("cell", F.shiftright("x", 20))
    s = s.join(cells, "cell").where("x >= lo and x < hi").select("slot", "s", F.floor(F.col("slot") / chunk).alias("chunk"))
    counts = s.groupBy("s", "chunk").agg(F.count("*").alias("n"))
    before = counts.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("s").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = s.withColumn("r", F.row_number().over(Window.partitionBy("s", "chunk").orderBy("slot")) - 1)
    ranked = numbered.join(before, ["s", "chunk"]).select("slot", "s", (F.col("r") + F.col("before")).alias("block"))
    need = spark.createDataFrame([(i, -(-math.floor(t + 0.5) // block_words)) for i, t in enumerate(goal.values())], "s int, need long")
    lack = need.join(counts.groupBy("s").agg(F.sum("n").alias("have")), "s", "left").select("s", "need", F.coalesce("have", F.lit(0)).alias("have")).where("need > have")
    lack = lack.select("s", "have", F.explode(F.expr("sequence(have, need - 1)")).alias("block"))
    return ranked.unionByName(lack.select((F.lit(slots) + (F.col("block") - F.col("have")) * len(goal) + F.col("s")).alias("slot"), "s", "block"))


def stream(sized: DataFrame, seed: int = 1) -> DataFrame:
    """Each document's first word in its source's shuffled stream: ``sized(..., s, size)`` gains ``at``.

    The shuffle orders by a hash; documents are dealt into buckets of it, the
    buckets' words are summed first, and windows run inside one (source,
    bucket), so a hot source is never gathered into one task.
    """
    n = sized.count()
    buckets = 1 << max(0, (n // BUCKET).bit_length())
    keyed = sized.withColumn("u", F.xxhash64(F.lit(seed), "doc_id", "th")).withColumn("bucket", F.pmod("u", F.lit(buckets)).cast("int"))
    sums = keyed.groupBy("s", "bucket").agg(F.sum("size").alias("words"))
    before = sums.select("s", "bucket", F.coalesce(F.sum("words").over(Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    w = Window.partitionBy("s", "bucket").orderBy("u", F.col("doc_id").asc_nulls_first(), "th", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = keyed.withColumn("inside", F.coalesce(F.sum("size").over(w), F.lit(0)))
    return inside.join(before, ["s", "bucket"]).withColumn("at", F.col("before") + F.col("inside")).drop("u", "bucket", "inside", "before")


def pieces(placed: DataFrame, blocks: DataFrame, block_words: int, epochs: int = EPOCHS) -> DataFrame:
    """The mix: ``(slot, s, doc_id, th, at, epoch, from_word, n)``, n words of a document for a slot.

    A source's stream is its documents, up to ``epochs`` times over, cut into
    blocks of equal tokens; blocks meet the slots of the same rank by an equi-join.
    The stream ends at the source's target, so the last block may be cut short.
    """
    goal = F.floor(F.col("target") + 0.5)
    d = placed.where("size > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1)))).withColumn("a", F.col("at") + F.col("epoch") * F.col("source_size"))
    d = d.withColumn("z", F.least(F.col("a") + F.col("size"), goal)).where("a < z")
    first, last = F.floor(F.col("a") / block_words), F.floor((F.col("z") - 1) / block_words)
    d = d.withColumn("block", F.explode(F.sequence(first, last)))
    lo = F.greatest(F.col("a"), F.col("block") * block_words)
    hi = F.least(F.col("z"), (F.col("block") + 1) * block_words)
    return d.join(blocks, ["s", "block"]).select("slot", "s", "doc_id", "th", "at", "epoch", (lo - F.col("a")).alias("from_word"), (hi - lo).alias("n"))


def mix(docs: DataFrame, slots: int = SLOTS, epochs: int = EPOCHS, weights=(1, 2, 3)) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text, source)`` -> (documents with their place in the mix, pieces of the mix).

    Documents: doc_id, th (hash of the text), source, s, size, source_size,
    target, at.  One number for each source reaches the driver.  Null texts and
    texts without a word have size 0 and are never taken; a null source is a
    source, the last; rows that repeat a document each have a place.  Empty
    tables, or tables without a word, give an empty mix; other columns are ignored.
    """
    spark = docs.sparkSession
    sized = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("source").cast("string").alias("source"), words(F.col("text").cast("string")).alias("size")), "sized")
    sizes = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    goal = targets(sizes, weights, epochs) if sizes else {}
    total = sum(sizes.values())
    block_words = max(1, -(-total // slots))
    table = spark.createDataFrame([(i, s, sizes[s], t) for i, (s, t) in enumerate(goal.items())], "s int, source string, source_size long, target double")
    table = table.withColumnRenamed("source", "name")
    sized = sized.join(table, sized["source"].eqNullSafe(table["name"])).drop("name")
    placed = cut(stream(sized), "placed")
    blocks = schedule(spark, goal, -(-total // block_words), block_words)
    return placed, pieces(placed, blocks, block_words, epochs)


def taken(placed: DataFrame, parts: DataFrame) -> DataFrame:
    """``placed`` with the words that the mix takes of each document."""
    key = ["s", "at", "doc_id", "th"]
    got = parts.groupBy("s", "at", "doc_id", "th").agg(F.sum("n").alias("got"))
    a, b = placed.alias("a"), got.alias("b")
    on = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in key] + [F.col("a.size") > 0]
    return a.join(b, on, "left").select("a.*", F.coalesce("b.got", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, slots: int = SLOTS, epochs: int = EPOCHS) -> DataFrame:
    """The mix as whole documents with their columns: one row for each epoch in which the mix takes a document's first word.

    Documents that the mix does not reach go.  Rows that repeat a document
    (doc_id, text and source) are documents of their own: the mix takes words of
    each, and the rows, numbered in the order of their other columns, get the
    copies of the places in the order of these.  Null ids, null sources, texts
    without a word, and empty tables are as in ``mix``.
    """
    placed, parts = mix(docs, slots, epochs)
    key = ["_id", "_th", "_s"]
    whole = lambda df: df.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th"), F.col("s").alias("_s"), F.col("at").alias("_at"), *([F.col("epoch")] if "epoch" in df.columns else []))
    places = whole(placed.where("size > 0")).withColumn("_k", F.row_number().over(Window.partitionBy(*key).orderBy("_at")))
    got = whole(parts.where("from_word = 0")).groupBy(*key, "_at").agg(F.countDistinct("epoch").cast("int").alias("_n"))
    a, g = places.alias("a"), got.alias("g")
    copies = a.join(g, [F.col(f"a.{k}").eqNullSafe(F.col(f"g.{k}")) for k in [*key, "_at"]]).select("a._id", "a._th", "a._s", "a._k", "g._n")
    copies = cut(copies, "copies")
    names = small(cut(placed.select(F.col("source").alias("_name"), F.col("s").alias("_own")).distinct(), "sources"))
    rows = docs.withColumns({"_rid": F.col("doc_id").cast("long"), "_rth": F.xxhash64("text"), "_rname": F.col("source").cast("string")})
    rows = rows.join(names, F.col("_rname").eqNullSafe(F.col("_name"))).drop("_rname", "_name")
    if copies.where("_k > 1").limit(1).count():  # only then do rows need numbers
        rest = [F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])]
        rows = rows.withColumn("_rk", F.row_number().over(Window.partitionBy("_rid", "_rth", "_own").orderBy(*rest)))
    else:
        rows = rows.withColumn("_rk", F.lit(1))
    on = F.col("_rid").eqNullSafe(F.col("_id")) & (F.col("_rth") == F.col("_th")) & (F.col("_own") == F.col("_s")) & (F.col("_rk") == F.col("_k"))
    kept = rows.join(copies.hint("shuffle_hash"), on)
    return kept.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n")))).select(*docs.columns)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each of all documents; nulls, repeats and empty tables as in ``mix``."""
    placed, parts = mix(read(spark, sf_dir, "documents"))
    return taken(placed, parts).select("doc_id", "size", "source_size", "target", "taken")
