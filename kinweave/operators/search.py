"""Search for names by a part of them, over postings of character trigrams.

Names and terms are lower-cased.  Trigrams that more than one in COMMON names
hold have no postings: for them alone an index is no better than the scan, which
is what a term of only such trigrams, or of fewer than three characters, gets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import contains_ignoring_case
from . import lookup
from .tables import settle, small

#: A trigram of more than one in this many names has no postings.
COMMON = 16
#: Keys over which the postings of a trigram are spread.
SLOTS = 16
#: Trigrams of a term that are intersected, the rarest first.
RAREST = 4


def _grams(names: DataFrame) -> DataFrame:
    """``names(id, label)`` -> ``(id, gram)``, each trigram of an id's names once; names of fewer than three characters and null ones have none."""
    grams = lambda low: F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substr(low, i, F.lit(3)))
    known = names.where(F.length("label") >= 3).groupBy("id").agg(F.collect_set(F.lower("label")).alias("lows"))  # an id may have several
    long_ = F.filter("lows", lambda low: F.length(low) >= 3)
    return known.select("id", F.explode(F.array_distinct(F.flatten(F.transform(long_, grams)))).alias("gram"))


def gram_counts(names: DataFrame) -> DataFrame:
    """``names(id, label)`` -> ``(gram, n)``: names that hold a trigram; the empty gram counts all names."""
    return _grams(names).groupBy("gram").agg(F.count("*").alias("n")).unionByName(names.agg(F.count("*").alias("n")).select(F.lit("").alias("gram"), "n"))


def _slot(gram, i):
    return F.concat(gram, F.lit(":"), i.cast("string"))


def postings(names: DataFrame, counts: DataFrame) -> DataFrame:
    """``(slot, gram, id)`` of all trigrams that are not common; a slot is a trigram with one of SLOTS hashes of the id.

    The common trigrams are fewer than COMMON times the mean number of trigrams of a name.
    """
    total = counts.where("gram = ''").select(F.col("n").alias("total"))
    common = settle(counts.where("gram <> ''").join(F.broadcast(total), F.col("n") * COMMON > F.col("total")).select("gram"), "common-grams")
    rare = _grams(names).join(small(common), "gram", "left_anti")
    return rare.select(_slot(F.col("gram"), F.pmod(F.xxhash64("id"), F.lit(SLOTS))).alias("slot"), "gram", "id")


def named(counts: DataFrame, index: DataFrame, persons: DataFrame, term: str) -> DataFrame:
    """The rows of ``persons(id, label, …)`` whose label holds ``term`` in any case: exactly those of the scan.

    ``counts`` and ``index`` are ``gram_counts`` and ``postings`` bucketed by
    gram and by slot, ``persons`` is bucketed by id, so a term reads few buckets.
    An empty term is held by every label, none by a null one.
    """
    scan = persons.where(contains_ignoring_case("label", term))
    low = term.lower()
    wanted = sorted({low[i : i + 3] for i in range(len(low) - 2)})
    if not wanted:
        return scan
    known = {r["gram"]: r["n"] for r in lookup.find(counts, "gram", [*wanted, ""]).collect()}  # as many as the term has
    total = known.pop("", 0)
    if len(known) < len(wanted):
        return scan.where(F.lit(False))
    rare = sorted((n, g) for g, n in known.items() if n * COMMON <= total)[:RAREST]
    if not rare:
        return scan
    hits = lookup.find(index, "slot", [f"{g}:{i}" for _, g in rare for i in range(SLOTS)])
    ids = hits.groupBy("id").agg(F.count("*").alias("n")).where(F.col("n") == len(rare)).select("id")
    if rare[0][0] <= lookup.NEAR:
        return lookup.find(scan, "id", [r["id"] for r in ids.collect()])  # at most NEAR
    return scan.join(ids, "id", "left_semi")
