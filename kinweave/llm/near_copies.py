"""One document of each group of near copies: wide SimHash fingerprints, compared bit-sliced in a fixed number of buckets, links by exact similarity."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, shuffle_parts
from .minhash import CHUNKS, GROUP, SLOTS, SYMBOLS, joined_sets, signatures, weighed
from .simhash import WORD, deal, few_bits, radius_of, repeats

#: Five-word shingles, similarity of 80 %, and words of 64 bits of the wide fingerprint.
SHINGLE, PERCENT, LANES = 5, 80, 4
#: Up to so many shingles a set's fingerprint varies more than the radius allows for; such sets are compared as they are.
SHORT = 100
#: Pairs that are compared in one block.
BLOCK = 1 << 15


def owned_pairs(a: np.ndarray, b: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Which pairs of signatures have this slot as the first in which they meet: each pair is looked at in one bucket."""
    apart = (a != b).reshape(len(a), CHUNKS, SYMBOLS)
    wrong = apart.sum(2)
    c, j = np.divmod(slot, SYMBOLS)
    at = np.arange(len(a))
    return ((wrong <= 1).argmax(1) == c) & (wrong[at, c] <= 1) & np.where(wrong[at, c] == 1, apart[at, c, j], j == 0)


def pairs_across(group: np.ndarray, comp: np.ndarray, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of one group and two components, each once, some ``block`` at a time; rows come sorted by group.

    One of the two is always outside the group's most frequent component, so a group that is nearly joined has few pairs.
    """
    m = len(group)
    order = np.lexsort((comp, group))
    g, c = group[order], comp[order]
    first = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (c[1:] != c[:-1])])[:m])
    count = np.diff(np.append(first, m))
    by_size = np.lexsort((-count, g[first]))
    lead = by_size[np.concatenate([[True], np.diff(g[first][by_size]) != 0])[: len(by_size)]]
    outside = np.ones(m, bool)
    outside[order] = np.repeat(~np.isin(np.arange(len(first)), lead), count)
    u = np.flatnonzero(outside)
    start, end = np.searchsorted(group, group[u]), np.searchsorted(group, group[u], side="right")
    upto = np.cumsum(end - start)
    lo = 0
    while lo < len(u):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + block, side="right")))
        size = (end - start)[lo:hi]
        i = np.repeat(u[lo:hi], size)
        j = np.arange(len(i)) + np.repeat(start[lo:hi] - np.cumsum(size) + size, size)
        keep = (comp[i] != comp[j]) & (~outside[j] | (j > i))
        yield i[keep], j[keep]
        lo = hi


def bucket_candidates(key: np.ndarray, n: np.ndarray, comp: np.ndarray, sig: np.ndarray, fp: np.ndarray, slot: np.ndarray, side: np.ndarray, radius: int, percent: int) -> np.ndarray:
    """Rows, sorted by key, that may be linked with a row of another component in their bucket."""
    need = np.zeros(len(key), bool)
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]]))
    for i, j in pairs_across(group, comp):
        low, high = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
        ok = (100 * low >= percent * high) & ((side[i] != side[j]) | (side[i] == 0))
        i, j, short = i[ok], j[ok], low[ok] <= SHORT
        near = short.copy()
        near[~short] = few_bits(fp[i[~short]] ^ fp[j[~short]], radius)
        i, j = i[near], j[near]
        mine = owned_pairs(sig[i], sig[j], slot[i])
        need[i[mine]] = need[j[mine]] = True
    return need


def candidates(rows: DataFrame, radius: int, percent: int = PERCENT) -> DataFrame:
    """``rows(key, rid, comp, n, sig, fp)`` -> ``(key, rid, comp, n)`` of those that may be linked with another component in that bucket.

    Those are within the radius, or have at most SHORT shingles, and are near enough
    in size.  Buckets above GROUP rows are split into pairs of chunks; pairs are not written.
    """
    dealt = deal(rows.withColumn("slot", F.col("key").bitwiseAND(63).cast("int")), GROUP, "rid")
    ordered = dealt.repartition(shuffle_parts(rows.sparkSession), "key").sortWithinPartitions("key", "rid")

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        key, rid, comp, n, slot, side = (table[c].to_numpy() for c in ("key", "rid", "comp", "n", "slot", "side"))
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint16).reshape(len(key), SLOTS)
        fp = np.frombuffer(b"".join(table["fp"].to_pylist()), ">u8").astype(np.uint64).reshape(len(key), -1)
        at = np.flatnonzero(bucket_candidates(key, n, comp, sig, fp, slot, side, radius, percent))
        return pa.RecordBatch.from_arrays([pa.array(x[at]) for x in (key, rid, comp, n)], ["key", "rid", "comp", "n"])

    def run(batches: Iterator[pa.RecordBatch]):
        held, count = [], 0
        for b in batches:  # rows come sorted by key; whole keys are solved some thousands of rows at a time
            if not b.num_rows:
                continue
            held.append(b)
            count += b.num_rows
            keys = np.asarray(column(b, "key"))
            done = int(np.searchsorted(keys, keys[-1]))  # where the last key begins in this batch
            if count >= 4 * GROUP and done:
                yield solve([*held[:-1], b.slice(0, done)])
                held, count = [b.slice(done)], b.num_rows - done
        if held:
            yield solve(held)

    return arrow_map(ordered.select("key", "rid", "comp", "n", "sig", "fp", "slot", "side"), run, "key long, rid long, comp long, n long")


def near_copies(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, lanes: int = LANES) -> tuple[DataFrame, DataFrame]:
    """``docs(doc_id, text)`` -> rows ``(doc_id, th, sid, ...)`` and ``(sid, first)``: the first document of each set's group of near copies.

    Links are pairs whose sets of word shingles have the Jaccard similarity,
    exactly.  A set has SLOTS bucket keys, whatever the table's size: at 80 % a pair
    shares none with a probability of 1e-7, above it with less.  In a bucket, wide
    fingerprints within a generous radius are candidates.  Only verified links are chained.
    ``first`` is (doc_id is null, doc_id, th), the smallest of the group.
    Null texts and texts without words are one group.
    """
    rows = cut(signatures(docs, size, lanes), "signatures")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "n", "sig", "fp")).alias("low")
    nodes = rows.groupBy("sid").agg(low).select(F.monotonically_increasing_id().alias("rid"), "sid", "low.n", "low.sig", "low.fp", F.struct("low.no_id", "low.doc_id", "low.th").alias("low"))
    nodes = cut(nodes, "sets")
    root = joined_sets(nodes.where("n > 0"), docs, size, percent, partial(candidates, radius=radius_of(percent / 100, WORD * lanes), percent=percent))
    named = nodes.join(root, F.col("rid") == F.col("node"), "left").select("sid", "low", F.coalesce("root", "rid").alias("root"))
    named = cut(named, "named")
    label = cut(named.groupBy("root").agg(F.min("low").alias("first")), "lows")
    return rows, cut(named.join(label, "root").select("sid", "first"), "labels")


def keep_one(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, lanes: int = LANES) -> DataFrame:
    """One document of each group of near copies, with its columns as they are: the one with the smallest doc_id.

    Of texts that share that doc_id, the one with the smallest hash; a null
    doc_id comes last.  Rows with one doc_id and one text are one document, of which any row stays.
    """
    rows, label = near_copies(docs, size, percent, lanes)
    stay = cut(label.select(F.col("first.doc_id").alias("_id"), F.col("first.th").alias("_th")).distinct(), "stay")
    kept = docs.join(stay.hint("shuffle_hash"), docs["doc_id"].cast("long").eqNullSafe(stay["_id"]) & (F.xxhash64(docs["text"]) == stay["_th"]))
    if repeats(rows):
        kept = kept.dropDuplicates(["_id", "_th"])
    return kept.drop("_id", "_th")
