"""Exact repeated-substring removal: BWTs of shards, merged by iterative interleave refinement.

Texts are cut at content-defined anchors: a k-gram that is the smallest by hash
in some window.  A string of ``least`` bytes always holds an anchor near its
start, and both places of a repeat hold the same ones, so all suffixes that can
share ``least`` bytes meet in the bucket of the bytes after their anchor.

The contexts of a bucket are aligned at the anchor and belong to shards.  Each
shard sorts its own suffixes from the last column to the first and keeps, for
each column, its Burrows-Wheeler transform: the byte before each suffix, in
suffix order.  The merge holds an interleave, the shard of each place in the
merged order.  A round lays the shards' BWT columns in that interleave, and a
stable partition by these bytes is the interleave one symbol further to the
left; no suffix is compared or sorted again.  The common prefix of two new
neighbours that share the byte is one more than the least over the places that
lay between them, so prefixes come from the interleave alone, and with them
the repeated intervals: neighbours with a prefix of at least the length.

A bucket of too many contexts is split by the next bytes of the alignment: the
places where a repeat may begin are halved, and contexts meet in each half by
the longer string that all repeats of the half must share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, mix64, read, shuffle_parts, text_buffer, text_bytes

LENGTH = 400
#: Bytes from which a repeat counts for a passage, and the words that a passage exceeds.
LEAST, PASSAGE = 256, 50
#: Rows of a bucket batch, contexts from which a bucket is split, and shards of a batch.
GROUP, SPLIT, SHARDS = 20_000, 2_048, 4


@dataclass(frozen=True)
class Plan:
    """Sizes that follow from the lengths: anchors are minima of ``window`` k-grams of ``gram`` bytes within ``least`` bytes."""

    length: int = LENGTH
    least: int = LEAST

    @property
    def gram(self) -> int:
        return min(16, max(1, self.least // 4))

    @property
    def window(self) -> int:
        return max(1, min(self.least * 16 // 25, self.least - self.gram + 1))

    @property
    def core(self) -> int:
        """Bytes after an anchor that every repeat with that anchor first shares."""
        return self.least - self.window + 1


def _gram_hashes(data: np.ndarray, k: int) -> np.ndarray:
    n = len(data) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    # doubling: a hash of 2m bytes from two of m bytes
    acc, size, at = data.astype(np.uint64) + np.uint64(1), 1, 0
    todo = k
    out = np.zeros(n, np.uint64)
    while todo:
        if todo & size:
            out = out * np.uint64(0x9E3779B97F4A7C15) + acc[at : at + n]
            at += size
            todo -= size
        if todo:
            acc = acc[:-size] * np.uint64(0xC2B2AE3D27D4EB4F) + (acc[size:] ^ acc[size:] >> np.uint64(29))
            size *= 2
    return (mix64(out) >> np.uint64(32)).astype(np.uint32)


def _sliding_argmin(h: np.ndarray, w: int) -> np.ndarray:
    """Position of the first smallest value of each window of w values."""
    n = len(h)
    v = h.astype(np.uint64) << np.uint64(32) | np.arange(n, dtype=np.uint64)
    blocks = -(-n // w)
    padded = np.full(blocks * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = v
    grid = padded.reshape(blocks, w)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    m = n - w + 1
    return (np.minimum(behind[:m], ahead[w - 1 : w - 1 + m]) & np.uint64(0xFFFFFFFF)).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, plan: Plan) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, position in ``data``, bytes back, bytes on) of the anchors; texts below the least length have none.

    Every start of a whole ``least``-byte string belongs to the anchor of the
    window that begins there; what precedes the string does not matter, so equal
    strings belong to equal anchors.  Starts of an anchor are consecutive: bytes
    back reach to the first of them, bytes on to the end of the last one's
    string of ``length`` bytes, or to the text's end.
    """
    none = np.zeros(0, np.int64)
    start, end = offsets[:-1], offsets[1:]
    long = np.flatnonzero(end - start >= plan.least)
    if not len(long):
        return none, none, none, none
    low = _sliding_argmin(_gram_hashes(data, plan.gram), plan.window)
    mark = np.zeros(len(data) + 1, np.int8)
    np.add.at(mark, start[long], 1)
    np.add.at(mark, end[long] - plan.least + 1, -1)
    at = np.flatnonzero(np.cumsum(mark[: len(low)]) > 0)
    low = low[at]
    new = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
    pos = low[new]
    first, last = at[new], at[np.append(new[1:], len(at)) - 1]
    doc = np.searchsorted(end, pos, side="right")
    return doc, pos, pos - first, np.minimum(last + plan.length, end[doc]) - pos


_OCC = "doc_id long, th long, pos int, size int, a long, c long"


def occurrences(docs: DataFrame, plan: Plan) -> DataFrame:
    """One row for each anchor: a is a digest of the core after it, c of its whole context; size packs bytes back and on."""

    def run(batches: Iterator[pa.RecordBatch]):
        digest = xxhash.xxh3_64_intdigest
        kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
        for b in batches:
            data, offsets = text_buffer(column(b, "text"))
            doc, pos, back, on = anchors(data, offsets, plan)
            raw = data.tobytes()
            p, lo, hi = pos.tolist(), (pos - back).tolist(), (pos + on).tolist()
            core = plan.core
            a = np.array([digest(raw[i : i + core]) for i in p], np.uint64)
            c = np.array([digest(raw[i:j], seed=k - i) for i, j, k in zip(lo, hi, p, strict=True)], np.uint64)
            ids = column(b, "doc_id").take(pa.array(doc))
            th = column(b, "th").take(pa.array(doc))
            cols = [ids, th, pa.array(pos - offsets[doc], pa.int32()), pa.array(back << 16 | on, pa.int32()), pa.array(a.view(np.int64)), pa.array(c.view(np.int64))]
            yield pa.RecordBatch.from_arrays([x.cast(t) for x, t in zip(cols, kinds, strict=True)], ["doc_id", "th", "pos", "size", "a", "c"])

    return arrow_map(docs, run, _OCC)


def align(contexts: list[bytes], back: np.ndarray, left: int, width: int) -> np.ndarray:
    """Columns of the contexts aligned at their anchors, a row of the table each: bytes plus one, zero outside a context."""
    m = len(contexts)
    sizes = np.fromiter(map(len, contexts), np.int64, m)
    table = np.zeros((width, m), np.uint16)
    row = np.repeat(np.arange(m), sizes)
    col = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(left - back, sizes)
    table[col, row] = np.frombuffer(b"".join(contexts), np.uint8).astype(np.uint16) + np.uint16(1)
    return table


def shard_bwt(table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(BWT columns, suffix orders) of one shard's aligned contexts: at column j, the bytes of j in the order of the suffixes at j + 1, and the rows in the order of those at j."""
    width, m = table.shape
    bwt, suffixes = np.empty_like(table), np.empty((width, m), np.uint16)
    order = np.arange(m)
    for j in range(width - 1, -1, -1):
        bwt[j] = table[j][order]
        order = order[np.argsort(bwt[j], kind="stable")]
        suffixes[j] = order
    return bwt, suffixes


def merge_bwts(shards: list[tuple[np.ndarray, np.ndarray]], most: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Merges the shards' BWTs from the last column to the first: (column, rows in merged order, prefixes).

    Rows count through the shards in turn; ``prefixes[i]`` is the common prefix,
    up to ``most``, of the suffixes at places i - 1 and i of the merged order.
    """
    first = np.cumsum([0] + [s[0].shape[1] for s in shards])
    m = int(first[-1])
    interleave = np.repeat(np.arange(len(shards), dtype=np.uint8), np.diff(first))
    prefix = np.zeros(m + 1, np.int32)
    columns = np.concatenate([s[0] for s in shards], axis=1)
    rows = np.concatenate([s[1].astype(np.int64) + f for s, f in zip(shards, first, strict=False)], axis=1)
    symbols, merged = np.empty(m, np.uint16), np.empty(m, np.int64)
    for j in range(len(columns) - 1, -1, -1):
        symbols[np.argsort(interleave, kind="stable")] = columns[j]
        step = np.argsort(symbols, kind="stable")  # one refinement of the interleave
        interleave = interleave[step]
        p, q = step[:-1], step[1:]
        now = symbols[step]
        same = np.flatnonzero((now[1:] == now[:-1]) & (now[1:] > 0))
        p, q = p[same], q[same]
        near = prefix[q].copy()
        far = np.flatnonzero(q > p + 1)
        if len(far):
            spans = np.stack([p[far] + 1, q[far] + 1], axis=1).ravel()
            near[far] = np.minimum.reduceat(prefix, spans)[::2]
        prefix = np.zeros(m + 1, np.int32)
        prefix[same + 1] = np.minimum(near + 1, most)
        merged[np.argsort(interleave, kind="stable")] = rows[j]
        yield j, merged, prefix[:m]


def refine(contexts: list[bytes], back: np.ndarray, plan: Plan, shard: np.ndarray | None = None) -> np.ndarray:
    """Rows (far, near, long_far, long_near) for each context: the farthest and nearest start, in bytes before the anchor, of
    repeated strings of ``least`` and of ``length`` bytes; -1 if there is none."""
    m, left = len(contexts), plan.window - 1
    shard = np.zeros(m, np.int64) if shard is None else shard
    order = np.argsort(shard, kind="stable")
    parts = [x for x in np.split(order, np.flatnonzero(np.diff(shard[order])) + 1) if len(x)]
    table = align(contexts, back, left, left + plan.length)
    out = np.full((4, m), -1, np.int64)
    for j, merged, prefix in merge_bwts([shard_bwt(np.ascontiguousarray(table[:, x])) for x in parts], plan.length):
        if j > left:
            continue
        for k, size in ((0, plan.least), (2, plan.length)):
            i = np.flatnonzero(prefix >= size)
            if not len(i):
                break
            hit = order[np.concatenate([merged[i - 1], merged[i]])]
            out[k, hit] = left - j
            fresh = hit[out[k + 1, hit] < 0]
            out[k + 1, fresh] = left - j
    return out


def _fields(b: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    return zip(*(column(b, n).to_pylist() for n in names), strict=True)


_HIT = ("a", "c", "far", "near", "long_far", "long_near")
_HITS = "a long, c long, far int, near int, long_far int, long_near int"


def _halves(key: int, k1: int, k2: int, back: int, context: bytes, plan: Plan) -> Iterator[tuple[int, int, int, int, bytes]]:
    """(key, k1, k2, back, context) of the halves of the starts k1 to k2 that the context takes part in."""
    on = len(context) - back
    mid = (k1 + k2) // 2
    for lo, hi in ((k1, mid), (mid + 1, k2)):
        near, far = max(lo, plan.least - on), min(hi, back)
        if lo > hi or near > far:
            continue
        shared = xxhash.xxh3_64(context[back - lo : back + plan.least - hi], seed=lo << 16 | hi)
        shared.update(key.to_bytes(8, "little", signed=True))
        yield int(np.uint64(shared.intdigest()).astype(np.int64)), lo, hi, far, context[back - far : min(len(context), back + plan.length - near)]


_SPLITS = "key long, k1 int, k2 int, a long, c long, back int, at int, context binary"


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[t]) for k, (_, t) in enumerate(fields)], [n for n, _ in fields])


def bucket_hits(texts: DataFrame, plan: Plan, group: int, split: int) -> DataFrame:
    """``texts(a, c, back, context)``, distinct -> rows of ``_HITS``: the repeated starts of each context within its bucket."""
    spark = texts.sparkSession
    rows = texts.select(F.col("a").alias("key"), F.lit(0).alias("k1"), F.lit(plan.window - 1).alias("k2"), "a", "c", "back", F.col("back").alias("at"), "context")
    light, hits = [], []
    while True:
        heavy = cut(rows.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > split).select("key"), "heavy")
        if not heavy.limit(1).count():
            light.append(rows)
            break
        light.append(rows.join(heavy, "key", "left_anti"))

        def halve(batches: Iterator[pa.RecordBatch]):
            for b in batches:
                out = []
                for key, k1, k2, a, c, _, at, x in _fields(b, "key", "k1", "k2", "a", "c", "back", "at", "context"):
                    out += [(new, lo, hi, a, c, far, far, part) for new, lo, hi, far, part in _halves(key, k1, k2, at, x, plan)]
                yield _table(out, _SPLITS)

        parts = cut(arrow_map(rows.join(heavy, "key", "left_semi"), halve, _SPLITS), "halves")
        # equal strings need one row; all their starts are repeated
        alike = ["key", "k1", "k2", "at", "context"]
        one = cut(parts.groupBy(*alike).agg(F.count("*").alias("n"), F.min(F.struct("a", "c", "back")).alias("r")), "parts")
        on, back = F.octet_length("context") - F.col("at"), F.col("at")
        near, long_near = F.greatest(F.col("k1"), plan.least - on), F.greatest(F.col("k1"), plan.length - on)
        whole = parts.join(one.where("n > 1").select(*alike), alike, "left_semi")
        hits.append(whole.select("a", "c", back.alias("far"), near.alias("near"), F.when(long_near <= back, back).otherwise(-1).alias("long_far"), F.when(long_near <= back, long_near).otherwise(-1).alias("long_near")))
        rows = one.select("key", "k1", "k2", "r.a", "r.c", "r.back", "at", "context")
        # one start left: a key is the string of the least length itself, and longer ones that agree are one row already
        last = rows.where("k1 = k2")
        twice = last.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
        none = F.lit(-1)
        hits.append(last.join(twice, "key", "left_semi").select("a", "c", F.col("k1").alias("far"), F.col("k1").alias("near"), none.alias("long_far"), none.alias("long_near")))
        rows = rows.where("k1 < k2")
    met = light[0]
    for x in light[1:]:
        met = met.unionByName(x)
    met = cut(met, "met") if len(light) > 1 else met
    parts = max(shuffle_parts(spark), -(-met.count() // (group // 2)))

    def merge(batches: Iterator[pa.RecordBatch]):
        held: list[tuple] = []

        def solve():
            out = refine([r[3] for r in held], np.array([r[2] for r in held], np.int64), plan, np.array([r[1] % SHARDS for r in held]))
            use = np.flatnonzero(out[0] >= 0)
            found = [pa.array([held[i][k] for i in use], pa.int64()) for k in (0, 1)]
            return pa.RecordBatch.from_arrays(found + [pa.array(x[use], pa.int32()) for x in out], list(_HIT))

        last = None
        for b in batches:  # rows come sorted by key; whole buckets are merged about ``group`` rows at a time
            for key, a, c, at, x in _fields(b, "key", "a", "c", "at", "context"):
                if len(held) >= group and key != last:
                    yield solve()
                    held.clear()
                held.append((a, c, at, x))
                last = key
        if held:
            yield solve()

    found = arrow_map(met.select("key", "a", "c", "at", "context").repartition(parts, "key").sortWithinPartitions("key"), merge, _HITS)
    for x in hits:
        found = found.unionByName(x)
    return found


def repeated_starts(docs: DataFrame, plan: Plan, group: int = GROUP, split: int = SPLIT) -> DataFrame:
    """``(doc_id, th, lo, hi, long_lo, long_hi)``: byte ranges covered by repeated strings of ``least`` and (else null) of ``length`` bytes, one for each anchor that has any."""
    occ = cut(occurrences(docs, plan), "occurrences")
    shared = occ.groupBy("a").agg(F.count("*").alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1")).where("n > 1")
    shared = cut(shared.select("a", (F.col("c0") != F.col("c1")).alias("mixed")), "shared")
    occ = cut(occ.join(shared, "a"), "meeting")
    # equal contexts are one row of a bucket, whatever their number
    context = cut(occ.groupBy("a", "c", "size", "mixed").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "pos")).alias("rep")), "contexts")
    wanted = context.where("mixed").select(F.col("rep.doc_id").alias("doc_id"), F.col("rep.th").alias("th"), F.struct(F.col("rep.pos").alias("pos"), "size", "a", "c").alias("w"))
    wanted = wanted.groupBy("doc_id", "th").agg(F.collect_list("w").alias("ws"))
    d, w = docs.alias("d"), wanted.hint("shuffle_hash").alias("w")
    found = d.join(w, F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th"))).select("d.text", "w.ws")

    def fetch(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            rows: dict[tuple, tuple] = {}
            for t, ws in zip(text_bytes(column(b, "text")), column(b, "ws").to_pylist(), strict=True):
                for x in ws:
                    back, on = x["size"] >> 16, x["size"] & 0xFFFF
                    rows[x["a"], x["c"], back] = x["a"], x["c"], back, t[x["pos"] - back : x["pos"] + on]
            yield _table(list(rows.values()), "a long, c long, back int, context binary")

    texts = arrow_map(found, fetch, "a long, c long, back int, context binary")
    if docs.groupBy("doc_id", "th").agg(F.count("*").alias("n")).where("n > 1").limit(1).count():
        texts = texts.dropDuplicates(["a", "c", "back"])  # rows that repeat a document fetch a context twice; it must meet itself only once
    merged = bucket_hits(cut(texts, "texts"), plan, group, split)
    back, on = F.shiftright("size", 16), F.col("size").bitwiseAND(0xFFFF)
    long_near = F.greatest(F.lit(0), plan.length - on)
    alike = context.where("n > 1").select("a", "c", back.alias("far"), F.greatest(F.lit(0), plan.least - on).alias("near"), F.when(long_near <= back, back).otherwise(-1).alias("long_far"), F.when(long_near <= back, long_near).otherwise(-1).alias("long_near"))
    # far - near is below both lengths: the strings of an anchor cover one run of bytes
    at_least = lambda c: F.min(F.when(F.col(c) >= 0, F.col(c))).alias(c)
    starts = cut(merged.unionByName(alike).groupBy("a", "c").agg(F.max("far").alias("far"), at_least("near"), F.max("long_far").alias("long_far"), at_least("long_near")), "starts")
    pos = F.col("pos")
    return occ.join(starts, ["a", "c"]).select(
        "doc_id",
        "th",
        (pos - F.col("far")).alias("lo"),
        (pos - F.col("near") + plan.least).alias("hi"),
        F.when(F.col("long_far") >= 0, pos - F.col("long_far")).alias("long_lo"),
        F.when(F.col("long_far") >= 0, pos - F.col("long_near") + plan.length).alias("long_hi"),
    )


def _runs(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of bytes that the ranges cover."""
    runs: list[list[int]] = []
    for lo, hi in sorted(ranges):
        if runs and lo <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], hi)
        else:
            runs.append([lo, hi])
    return [(lo, hi) for lo, hi in runs]


def _whole_words(t: bytes, lo: int, hi: int) -> int:
    """Words that lie in the range as a whole."""
    n = len(t[lo:hi].split())
    if n and lo and not t[lo - 1 : lo].isspace() and not t[lo : lo + 1].isspace():
        n -= 1
    if n and hi < len(t) and not t[hi - 1 : hi].isspace() and not t[hi : hi + 1].isspace():
        n -= 1
    return n


_OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept string, spans array<struct<start:long,end:long>>, passages long"


def dedup_substrings(docs: DataFrame, length: int = LENGTH, group: int = GROUP, keep_text: bool = True, split: int = SPLIT, least: int | None = None) -> DataFrame:
    """Removes each byte covered by a ``length``-byte string that also starts anywhere else.

    One row per row of ``docs(doc_id, text)``: doc_id, n_bytes, n_removed,
    n_spans, kept_sha256, kept (the remaining text, undecodable bytes replaced;
    null unless ``keep_text``), spans (the removed runs) and passages: the runs
    of more than PASSAGE whole words that strings of ``least`` bytes (LEAST, or
    the length if that is less) found elsewhere cover.  These are only
    reported, so shorter passages than the length stay in the text.

    Null texts are empty; texts below the length lose nothing; long texts are
    read as a whole; rows that repeat a document are copies of each other, and
    rows that share a doc_id, or have none, are documents of their own; an empty
    table gives no rows; other columns are ignored.
    """
    plan = Plan(length, min(length, LEAST if least is None else least))
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("th", F.xxhash64("text"))
    cover = repeated_starts(d, plan, group, split).groupBy("doc_id", "th").agg(F.collect_list(F.struct("lo", "hi", "long_lo", "long_hi")).alias("cover"))
    left, right = d.alias("d"), cover.hint("shuffle_hash").alias("c")
    rows = left.join(right, F.col("d.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("d.th") == F.col("c.th")), "left").select("d.doc_id", "d.text", "c.cover")

    def run(batches: Iterator[pa.RecordBatch]):
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.int64()]
        for b in batches:
            out = []
            for i, t, cover in zip(column(b, "doc_id").to_pylist(), text_bytes(column(b, "text")), column(b, "cover").to_pylist(), strict=True):
                runs = _runs([(x["long_lo"], x["long_hi"]) for x in cover or () if x["long_lo"] is not None])
                passages = sum(_whole_words(t, lo, hi) > PASSAGE for lo, hi in _runs([(x["lo"], x["hi"]) for x in cover or ()]))
                kept, at = [], 0
                for lo, hi in runs:
                    kept.append(t[at:lo])
                    at = hi
                kept.append(t[at:])
                rest = b"".join(kept)
                out.append((i, len(t), len(t) - len(rest), len(runs), hashlib.sha256(rest).hexdigest(), rest.decode("utf-8", "replace") if keep_text else None, [{"start": lo, "end": hi} for lo, hi in runs], passages))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], kind) for k, kind in enumerate(kinds)], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept", "spans", "passages"])

    return arrow_map(rows, run, _OUT)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``dedup_substrings`` over all documents, without the texts; nulls, repeats and empty tables as there."""
    return dedup_substrings(read(spark, sf_dir, "documents"), keep_text=False).drop("kept", "spans")
