"""SimHash near-duplicates by bit-sliced comparison: vertical bit planes, carry-save counters, abandoned blocks."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, lower_ascii, mix64, read, shuffle_parts, text_bytes
from .components import components

SEED = 42
#: Bits in a fingerprint word.
WORD = 64
#: Fingerprints of one bucket that are compared in one group; larger buckets are split into pairs of chunks.
GROUP = 8192


# --------------------------------------------------------------------------- fingerprints


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every ``size``-word shingle of the lower-cased text, repeats included."""
    words = lower_ascii(text).split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
    norm = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate([[0], ends[:-1]])
    digest = xxhash.xxh64_intdigest
    return np.array([digest(norm[a:b], SEED) for a, b in zip(starts[: len(words) - size + 1].tolist(), (ends[size - 1 :] - 1).tolist(), strict=True)], np.uint64)


def majority(hashes: np.ndarray, lanes: int = 1) -> bytes:
    """``lanes`` 64-bit words, big-endian: a bit is set if it is in over half of the hashes.  Further lanes remix the hash."""
    n = len(hashes)
    out = []
    for lane in range(lanes):
        h = hashes if not lane else mix64(hashes + np.uint64(lane * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        counts = np.zeros(WORD, np.int64)
        for lo in range(0, n, 255):  # counts of 255 rows fit in a byte
            bits = np.unpackbits(h[lo : lo + 255].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
            counts += np.add.reduce(bits, axis=0, dtype=np.uint8)
        out.append(np.packbits(2 * counts > n).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, size: int = 3, lanes: int = 1, distinct: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, fp binary)``; null texts and texts without words have the fingerprint zero.

    ``distinct``: a shingle counts once, so that distances follow set similarity.
    """

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fps = []
            for t in text_bytes(column(b, "text")):
                h = shingle_hashes(t, size)
                fps.append(majority(np.unique(h) if distinct else h, lanes))
            yield pa.RecordBatch.from_arrays([column(b, "doc_id").cast(pa.int64()), pa.array(fps, pa.binary())], ["doc_id", "fp"])

    return arrow_map(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")), run, "doc_id long, fp binary")


# --------------------------------------------------------------------------- bit-sliced comparison


def planes(words: np.ndarray) -> np.ndarray:
    """m x lanes words -> (64 * lanes) planes; bit i of a plane is that bit of fingerprint i, packed in 64-bit words."""
    m = len(words)
    bits = np.unpackbits(np.ascontiguousarray(words.astype(">u8")).view(np.uint8).reshape(m, -1), axis=1)
    width = -(-m // WORD) * WORD
    padded = np.zeros((bits.shape[1], width), np.uint8)
    padded[:, :m] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def _shifted(plane: np.ndarray, by: int) -> np.ndarray:
    """The plane moved down by ``by`` positions: bit i becomes what was bit i + by."""
    words, bits = divmod(by, WORD)
    out = np.zeros_like(plane)
    n = plane.shape[-1]
    if words < n:
        out[..., : n - words] = plane[..., words:] >> np.uint64(bits)
        if bits and words + 1 < n:
            out[..., : n - words - 1] |= plane[..., words + 1 :] << np.uint64(WORD - bits)
    return out


class Counter:
    """A distance counter for every lane: plane b holds bit b of all distances; ``over`` marks those above the radius."""

    def __init__(self, words: int, radius: int):
        self.levels = (radius + 1).bit_length()
        # starting at 2^levels - 1 - radius, an overflow says that the radius is exceeded
        offset = (1 << self.levels) - 1 - radius
        ones = ~np.zeros(words, np.uint64)
        self.bits = [ones.copy() if offset >> b & 1 else np.zeros(words, np.uint64) for b in range(self.levels)]
        self.over = np.zeros(words, np.uint64)

    def add(self, plane: np.ndarray, level: int = 0) -> None:
        """Adds one plane with weight 2^level, rippling the carry upwards."""
        carry = plane
        for b in range(level, self.levels):
            self.bits[b], carry = self.bits[b] ^ carry, self.bits[b] & carry
        self.over |= carry

    def add3(self, x: np.ndarray, y: np.ndarray, z: np.ndarray) -> None:
        """Carry-save: three planes become one of weight one and one of weight two."""
        s = x ^ y
        self.add(s ^ z)
        if self.levels > 1:
            self.add(x & y | s & z, 1)
        else:
            self.over |= x & y | s & z


def within(p: np.ndarray, by: int, radius: int, live: np.ndarray) -> np.ndarray:
    """Lanes i (packed) of ``live`` whose fingerprint differs from the one ``by`` places on in at most ``radius`` bits."""
    c = Counter(p.shape[1], radius)
    n = len(p)
    for b in range(0, n, 3):
        d = p[b : b + 3] ^ _shifted(p[b : b + 3], by)
        if len(d) == 3:
            c.add3(*d)
        else:
            for x in d:
                c.add(x)
        if b % 12 == 9 and not (live & ~c.over).any():  # the block has left the radius
            return np.zeros_like(live)
    return live & ~c.over


def _find(parent: np.ndarray) -> np.ndarray:
    while True:
        up = parent[parent]
        if (up == parent).all():
            return parent
        parent = up


def _union(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Joins a[i] and b[i] for all i; roots are the smallest members."""
    while True:
        ra, rb = parent[a], parent[b]
        diff = ra != rb
        if not diff.any():
            return parent
        a, b = a[diff], b[diff]
        np.minimum.at(parent, np.maximum(ra[diff], rb[diff]), np.minimum(ra[diff], rb[diff]))
        parent = _find(parent)


def link_groups(words: np.ndarray, group: np.ndarray, radius: int, side: np.ndarray | None = None) -> np.ndarray:
    """Root row of every row under links within its group; rows come sorted by group.

    All rows are compared with the row 1, 2, 3, ... places on at once, over
    vertical planes.  Rows whose group has ended, and groups that are joined
    already, leave the block when it is compacted.  With ``side`` (1 or 2 in rows
    of chunk pairs, else 0) rows of one side, 1 or 2, need not be compared.
    """
    m = len(words)
    parent = np.arange(m)
    last = np.searchsorted(group, group, side="right")  # where each row's group ends
    rows = np.arange(m)
    by, planes_ = 0, None
    while True:
        if planes_ is None or by >= next_compact:
            root = parent[rows]
            g = group[rows]
            _, first = np.unique(g, return_index=True)
            low, high = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
            size = np.diff(np.append(first, len(g)))
            stay = np.repeat((low != high) & (size > by + 1), size)
            rows = rows[stay]
            if not len(rows):
                return parent
            # rows keep their order and groups are kept whole, so places on stay the same
            local_end = np.searchsorted(group[rows], group[rows], side="right")
            planes_ = planes(words[rows])
            next_compact = by + max(1, by // 2)
        by += 1
        here = np.arange(len(rows)) + by < local_end
        if not here.any():
            planes_ = None
            if by >= m:
                return parent
            next_compact = by
            continue
        i = np.flatnonzero(here)
        apart = parent[rows[i]] != parent[rows[i + by]]
        if side is not None:
            apart &= (side[rows[i]] != side[rows[i + by]]) | (side[rows[i]] == 0)
        if not apart.any():
            continue
        live = np.zeros(planes_.shape[1] * WORD, np.uint8)
        live[i[apart]] = 1
        hit = within(planes_, by, radius, np.packbits(live, bitorder="little").view(np.uint64))
        if hit.any():
            i = np.flatnonzero(np.unpackbits(hit.view(np.uint8), bitorder="little"))
            parent = _union(parent, rows[i], rows[i + by])


def few_bits(x: np.ndarray, radius: int) -> np.ndarray:
    """Which rows, each the XOR of two fingerprints, have at most ``radius`` bits: a block of pairs over vertical planes, left once all exceed it."""
    m = len(x)
    if not m:
        return np.zeros(0, bool)
    p = planes(x)
    c = Counter(p.shape[1], radius)
    live = np.packbits(np.arange(p.shape[1] * WORD) < m, bitorder="little").view(np.uint64)
    for b in range(0, len(p), 3):
        d = p[b : b + 3]
        if len(d) == 3:
            c.add3(*d)
        else:
            for y in d:
                c.add(y)
        if b % 12 == 9 and not (live & ~c.over).any():
            return np.zeros(m, bool)
    return np.unpackbits((live & ~c.over).view(np.uint8), bitorder="little")[:m].astype(bool)


# --------------------------------------------------------------------------- buckets


def exact_keys(count: int, radius: int, bits: int = WORD) -> list[list[int]]:
    """Bit positions of each key: blocks chosen so that fingerprints within the radius share a key.

    Of ``radius + s`` blocks, s hold no difference; more blocks make longer
    keys, so that buckets stay small as the number of fingerprints grows.
    """
    s = 1
    while s < 4 and count > 64 << (bits * s // (radius + s)):
        s += 1
    n = radius + s
    cuts = [bits * i // n for i in range(n + 1)]
    blocks = [list(range(cuts[i], cuts[i + 1])) for i in range(n)]
    return [[b for block in chosen for b in block] for chosen in combinations(blocks, s)]


def radius_of(similarity: float, bits: int, sigmas: float = 5.0) -> int:
    """Differing bits of two sets of one size with that Jaccard similarity: the mean plus some standard deviations."""
    p = np.arccos(2 * similarity / (1 + similarity)) / np.pi
    return int(round(bits * p + sigmas * np.sqrt(bits * p * (1 - p))))


def deal(rows: DataFrame, group: int, by: str) -> DataFrame:
    """``rows(key, ...)`` with ``side``: keys of more than ``group`` rows become one key for each pair of chunks, dealt by a hash of ``by``."""
    sizes = rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > group)
    heavy = cut(sizes.select("key", F.ceil(F.col("n") / (group // 2)).cast("int").alias("g")), "heavy")
    if not heavy.limit(1).count():
        return rows.withColumn("side", F.lit(0))
    rest = [c for c in rows.columns if c != "key"]
    dealt = rows.join(heavy, "key").withColumn("mine", F.pmod(F.xxhash64(by), F.col("g")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.expr("sequence(0, g - 1)")))
    # chunk pair (a, b), a <= b, meets in a key of its own; with a = b the chunk meets itself
    dealt = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"), F.lit(1)).alias("key"), *rest, F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2).alias("side"))
    return rows.join(heavy, "key", "left_anti").withColumn("side", F.lit(0)).unionByName(dealt)


def bucket_links(fps: DataFrame, radius: int, keys: list[list[int]], group: int = GROUP) -> DataFrame:
    """``fps(fp)``, distinct -> ``(u, v)``: links that join what is within the radius in a common bucket.

    A bucket gives at most one link for each member, not all its pairs.
    Buckets of more than ``group`` members are split into chunks and every pair
    of chunks is a group of its own, so no task holds a whole hot bucket.
    """
    spark = fps.sparkSession

    def key_rows(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            fp = column(b, "fp")
            raw = np.frombuffer(b"".join(fp.to_pylist()), np.uint8).reshape(len(fp), -1)
            bits = np.unpackbits(raw, axis=1)
            for t, chosen in enumerate(keys):
                value = np.full(len(fp), t, np.uint64)
                k = np.zeros(len(fp), np.uint64)
                for bit in chosen:
                    k = k << np.uint64(1) | bits[:, bit]
                value = mix64(mix64(value) ^ k)
                yield pa.RecordBatch.from_arrays([pa.array(value.view(np.int64)), fp], ["key", "fp"])

    rows = arrow_map(fps.select("fp"), key_rows, "key long, fp binary")
    rows = deal(rows, group, "fp")
    ordered = rows.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "fp")

    def solve(key: np.ndarray, fp: list[bytes], side: np.ndarray):
        words = np.frombuffer(b"".join(fp), ">u8").astype(np.uint64).reshape(len(fp), -1)
        _, group_no = np.unique(key, return_inverse=True)
        group_no = np.cumsum(np.concatenate([[0], np.diff(group_no) != 0]))
        root = link_groups(words, group_no, radius, side if side.any() else None)
        at = np.flatnonzero(root != np.arange(len(root)))
        return pa.RecordBatch.from_arrays([pa.array([fp[i] for i in at], pa.binary()), pa.array([fp[i] for i in root[at]], pa.binary())], ["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]):
        keys_, fps_, sides = [], [], []
        held = 0
        for b in batches:  # rows come sorted by key; whole keys are solved some tens of thousands at a time
            keys_.append(np.asarray(column(b, "key")))
            fps_ += column(b, "fp").to_pylist()
            sides.append(np.asarray(column(b, "side")))
            held += b.num_rows
            if held >= 4 * group:
                key, side = np.concatenate(keys_), np.concatenate(sides)
                done = int(np.searchsorted(key, key[-1]))
                if done:
                    yield solve(key[:done], fps_[:done], side[:done])
                    keys_, fps_, sides, held = [key[done:]], fps_[done:], [side[done:]], held - done
        if held:
            yield solve(np.concatenate(keys_), fps_, np.concatenate(sides))

    return arrow_map(ordered.select("key", "fp", "side"), run, "u binary, v binary")


def near_components(fps: DataFrame, radius: int) -> DataFrame:
    """``fps(doc_id, fp)`` -> ``(doc_id, fp, component_id)``: the smallest doc_id reachable over links within the radius.

    All links are found, by blocks of the fingerprint.  Equal fingerprints are one
    node; repeated doc_ids each keep a row; null doc_ids never name a component
    unless it has no other; an empty table gives no rows.
    """
    node = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")), "fps")
    first = node.agg(F.count("*").alias("n"), F.max(F.length("fp")).alias("bytes")).first()
    count, bits = first["n"], 8 * (first["bytes"] or 8)
    keys = exact_keys(count, radius, bits)
    root = components(bucket_links(node, radius, keys))
    named = node.join(root, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    label = cut(named.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
    label = cut(named.join(label, "root").select("fp", "component_id"), "labels")
    return fps.join(label, "fp").select("doc_id", "fp", "component_id")


def repeats(rows: DataFrame) -> bool:
    """Whether a document occurs twice with one text."""
    return rows.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1").limit(1).count() > 0


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    fps = cut(fingerprints(read(spark, sf_dir, "documents")), "fingerprints")
    return near_components(fps, 3).select("doc_id", F.lower(F.hex("fp")).alias("fingerprint"), "component_id")
