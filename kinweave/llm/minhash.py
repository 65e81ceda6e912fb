"""MinHash near-duplicates: b-bit signatures, a multi-index Hamming join by pigeonhole over their chunks, links confirmed on whole sets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_map, column, cut, mix64, read, shuffle_parts, text_bytes
from .components import components
from .simhash import deal, majority, repeats, shingle_hashes

#: Words of a shingle; sets are linked if PERCENT * union <= 100 * intersection.
SHINGLE, PERCENT = 5, 85
#: A signature has CHUNKS chunks of SYMBOLS symbols of 16 bits.  Of signatures that differ in at most GUARANTEED
#: symbols, some chunk differs in at most one, so that leaving one symbol of each chunk out finds the pair.
CHUNKS, SYMBOLS = 12, 5
SLOTS, GUARANTEED = CHUNKS * SYMBOLS, 2 * CHUNKS - 1
#: Pairs that meet and differ in more symbols are no candidates: at similarity 0.85 that befalls 3 pairs in 10^8.
FARTHEST = 26
#: Signatures that are compared in one group, and shingles of a group whose sets are compared; larger groups are split.
GROUP, WEIGHT = 4096, 1 << 20
#: Shingles that are hashed at a time.
HELD = 1 << 19
#: Candidates up to which they are sent to all tasks that read the texts, else texts are shuffled.
FEW = 200_000

_rng = np.random.default_rng(85)
_XOR, _TIMES = (_rng.integers(0, 1 << 63, SLOTS, np.uint64) * np.uint64(2) + np.uint64(1) for _ in range(2))


# --------------------------------------------------------------------------- signatures


def symbols(sets: list[np.ndarray]) -> np.ndarray:
    """Sets of shingle hashes, none empty, to rows of SLOTS symbols: 16 bits of the smallest hash under each of SLOTS orders.

    Two sets agree in a symbol with the probability of their Jaccard similarity.
    """
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum([len(s) for s in sets])[:-1]])
    low = np.stack([np.minimum.reduceat((flat ^ _XOR[k]) * _TIMES[k], starts) for k in range(SLOTS)], axis=1)
    return mix64(low).astype(np.uint16)


def signatures(docs: DataFrame, size: int = SHINGLE, lanes: int = 0) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, th, sid, n, sig)``: hash of the text, digest, size and signature of its set of shingles.

    Null texts and texts without words have n = 0 and no signature.  ``lanes``:
    a column ``fp`` with the set's fingerprint of so many words of 64 bits.
    """

    def made(held: list[tuple]) -> pa.RecordBatch:
        full = [h for _, _, h in held if len(h)]
        rows = iter(symbols(full) if full else [])
        sig = [next(rows).tobytes() if len(h) else None for _, _, h in held]
        sid = [xxhash.xxh3_128_digest(h.tobytes()) for _, _, h in held]
        fp = [pa.array([majority(h, lanes) for _, _, h in held], pa.binary())] if lanes else []
        return pa.RecordBatch.from_arrays(
            [pa.array([d for d, _, _ in held], pa.int64()), pa.array([t for _, t, _ in held], pa.int64()), pa.array(sid, pa.binary()), pa.array([len(h) for _, _, h in held], pa.int64()), pa.array(sig, pa.binary()), *fp],
            ["doc_id", "th", "sid", "n", "sig", "fp"][: 5 + len(fp)],
        )

    def run(batches: Iterator[pa.RecordBatch]):
        held, weight = [], 0
        for b in batches:
            for doc, th, text in zip(column(b, "doc_id").to_pylist(), column(b, "th").to_pylist(), text_bytes(column(b, "text")), strict=True):
                held.append((doc, th, np.unique(shingle_hashes(text, size))))
                weight += len(held[-1][2]) + 100
                if weight >= HELD:
                    yield made(held)
                    held, weight = [], 0
        if held:
            yield made(held)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    return arrow_map(rows, run, "doc_id long, th long, sid binary, n long, sig binary" + (", fp binary" if lanes else ""))


# --------------------------------------------------------------------------- multi-index


def _matrix(sigs: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(sigs.to_pylist()), np.uint16).reshape(len(sigs), SLOTS)


def index_keys(sig: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For each slot, which is a chunk and the symbol of it that is left out, the keys of all signatures; the last six bits are the slot."""
    for slot in range(SLOTS):
        c, j = divmod(slot, SYMBOLS)
        value = np.full(len(sig), slot, np.uint64)
        for i in range(SYMBOLS):
            if i != j:
                value = mix64(value << np.uint64(16) ^ value ^ sig[:, c * SYMBOLS + i].astype(np.uint64))
        yield slot, value << np.uint64(6) | np.uint64(slot)


def keyed(nodes: DataFrame) -> DataFrame:
    """``nodes(rid, sig)`` -> ``(key, rid)``, SLOTS rows each, whatever the size of the table."""

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if b.num_rows:
                rid = column(b, "rid")
                for _, key in index_keys(_matrix(column(b, "sig"))):
                    yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), rid], ["key", "rid"])

    return arrow_map(nodes.select("rid", "sig"), run, "key long, rid long")


def owned(sig: np.ndarray, one: np.ndarray, slot: int) -> np.ndarray:
    """Which rows have this slot as the first in which they meet ``one``: each pair is looked at in one bucket."""
    c, j = divmod(slot, SYMBOLS)
    apart = (sig != one).reshape(len(sig), CHUNKS, SYMBOLS)
    wrong = apart.sum(2)
    first = (wrong <= 1).argmax(1) == c
    return first & (wrong[:, c] <= 1) & np.where(wrong[:, c] == 1, apart[:, c, j], j == 0)


def bucket_candidates(sig: np.ndarray, n: np.ndarray, comp: np.ndarray, slot: int) -> np.ndarray:
    """Rows of a bucket that may be linked with a row of another component: near enough in signature and size, and owned by this bucket."""
    need = np.zeros(len(sig), bool)
    names, label, count = np.unique(comp, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return need
    for u in np.flatnonzero(label != count.argmax()):  # a pair of two components has a row outside the largest
        at = np.flatnonzero((label != label[u]) & (100 * np.minimum(n, n[u]) >= PERCENT * np.maximum(n, n[u])))
        at = at[(sig[at] != sig[u]).sum(1) <= FARTHEST]
        at = at[owned(sig[at], sig[u], slot)] if len(at) else at
        if len(at):
            need[u] = need[at] = True
    return need


def candidates(rows: DataFrame) -> DataFrame:
    """``rows(key, rid, comp, n, sig)`` -> ``(key, rid, comp, n)`` of those that may be linked with another component in that bucket.

    Buckets above GROUP rows are split into pairs of chunks, so no task holds a hot bucket; pairs are not written.
    """
    spark = rows.sparkSession
    dealt = deal(rows.withColumn("slot", F.col("key").bitwiseAND(63).cast("int")), GROUP, "rid")
    ordered = dealt.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "rid")

    def run(batches: Iterator[pa.RecordBatch]):
        for key, held in _by_key(batches):
            take = lambda name: np.concatenate([np.asarray(column(b, name)) for b in held])  # noqa: E731, B023
            comp = take("comp")
            if comp.min() == comp.max():
                continue
            need = np.flatnonzero(bucket_candidates(np.concatenate([_matrix(column(b, "sig")) for b in held]), take("n"), comp, int(column(held[0], "slot")[0].as_py())))
            if len(need):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(need), key)), *(pa.array(take(c)[need]) for c in ("rid", "comp", "n"))], ["key", "rid", "comp", "n"])

    return arrow_map(ordered.select("key", "rid", "comp", "n", "sig", "slot"), run, "key long, rid long, comp long, n long")


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows that come sorted by ``key``, a key at a time."""
    held, last = [], None
    for b in batches:
        if not b.num_rows:
            continue
        keys = np.asarray(column(b, "key"))
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[lo] != last:
                yield last, held
                held = []
            last = int(keys[lo])
            held.append(b.slice(lo, hi - lo))
    if held:
        yield last, held


# --------------------------------------------------------------------------- exact links


def exact_links(sets: list[np.ndarray], comp: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that join all rows of one group that are similar and not of one component; none for pairs that are joined already.

    Each row outside the largest component is compared with all sets at once:
    its shingles are marked, and marks are counted over the sets that lie one after another.
    """
    names, label, count = np.unique(comp, return_inverse=True, return_counts=True)
    if len(names) < 2:
        return []
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    mark = np.zeros(len(values), bool)
    main = int(count.argmax())
    links: list[tuple[int, int]] = []
    first = int(np.flatnonzero(label == main)[0])
    for u in [first, *(i for i in range(len(sets)) if i != first)]:
        if u != first and label[u] == main:
            continue
        mine = ids[starts[u] : starts[u] + sizes[u]]
        mark[mine] = True
        common = np.add.reduceat(mark[ids], starts, dtype=np.int64)
        mark[mine] = False
        hit = (100 * common >= percent * (sizes + sizes[u] - common)) & (label != label[u])
        if hit.any():
            met, at = np.unique(label[hit], return_index=True)
            links += [(u, int(v)) for v in np.flatnonzero(hit)[at]]
            joined = np.append(met, label[u])
            to = main if main in joined else label[u]
            label[np.isin(label, joined)] = to
            if (label == main).all():
                break
    return links


def weighed(rows: DataFrame) -> DataFrame:
    """``rows(key, rid, comp, n)``; keys of more than WEIGHT shingles become one key for each pair of chunks."""
    sizes = rows.groupBy("key").agg(F.sum(F.col("n") + 50).alias("w")).where(F.col("w") > WEIGHT)
    heavy = cut(sizes.select("key", F.ceil(2 * F.col("w") / WEIGHT).cast("int").alias("g")), "heavy")
    if not heavy.limit(1).count():
        return rows
    dealt = rows.join(heavy, "key").withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("g")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, g - 1)")))
    dealt = dealt.select(F.xxhash64("key", F.least("mine", "other"), F.greatest("mine", "other"), F.lit(1)).alias("key"), "rid", "comp", "n")
    return rows.join(heavy, "key", "left_anti").unionByName(dealt)


def confirmed(groups: DataFrame, nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``groups(key, rid, comp)`` -> ``(u, v)``: links between components within each key, by the sets of whole texts."""
    spark = docs.sparkSession
    asked = cut(groups.join(nodes.select("rid", F.col("low.doc_id").alias("_id"), F.col("low.th").alias("_th")), "rid").select("key", "rid", "comp", "_id", "_th"), "asked")
    asked = F.broadcast(asked) if asked.count() <= FEW else asked
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))
    texts = texts.join(asked, F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th"))).select("key", "rid", "comp", "text")
    if repeats(docs.select("doc_id", F.xxhash64("text").alias("th"))):
        texts = texts.dropDuplicates(["key", "rid"])
    ordered = texts.repartition(shuffle_parts(spark), "key").sortWithinPartitions("key", "rid")

    def run(batches: Iterator[pa.RecordBatch]):
        def solve(rid, comp, sets):
            links = exact_links(sets, np.array(comp), percent)
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([rid[i] for i, _ in links], pa.int64()), pa.array([rid[j] for _, j in links], pa.int64())], ["u", "v"])

        last, rid, comp, sets = None, [], [], []
        for b in batches:  # sets are made as texts come by, so that no group's texts are held
            for key, r, c, text in zip(*(column(b, name).to_pylist() for name in ("key", "rid", "comp")), text_bytes(column(b, "text")), strict=True):
                if key != last and rid:
                    yield from solve(rid, comp, sets)
                    rid, comp, sets = [], [], []
                last = key
                rid.append(r)
                comp.append(c)
                sets.append(np.unique(shingle_hashes(text, size)))
        if rid:
            yield from solve(rid, comp, sets)

    return arrow_map(ordered, run, "u long, v long")


def first_groups(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """``members(key, rid, lead)`` -> ``(key, rid, comp)``: each set beside the lead that it shares most buckets with, and beside its smallest.

    Leads are the smallest sets of buckets.  What a lead attracts is split by
    weight, with the lead in each part, so a hot lead costs no more than its sets.
    """
    shared = members.where("rid <> lead").groupBy("rid", "lead").agg(F.count("*").alias("k"))
    best = shared.groupBy("rid").agg(F.max(F.struct("k", (-F.col("lead")).alias("l"))).alias("b"), F.min("lead").alias("low"))
    chosen = cut(best.select("rid", F.explode(F.array_distinct(F.array(-F.col("b.l"), F.col("low")))).alias("lead")).join(nodes.select("rid", "n"), "rid"), "chosen")
    parts = cut(chosen.groupBy("lead").agg(F.ceil(F.sum(F.col("n") + 50) / WEIGHT).cast("int").alias("g")), "leads")
    key = lambda part: F.xxhash64("lead", part)
    mine = chosen.join(parts, "lead").select(key(F.pmod(F.xxhash64("rid"), F.col("g")).cast("int")).alias("key"), "rid")
    leads = parts.withColumn("part", F.explode(F.expr("sequence(0, g - 1)"))).select(key(F.col("part")).alias("key"), F.col("lead").alias("rid"))
    return mine.unionByName(leads).withColumn("comp", F.col("rid"))


def joined_sets(nodes: DataFrame, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT, find: Callable[[DataFrame], DataFrame] = candidates) -> DataFrame:
    """``nodes(rid, sid, n, sig, low)``, sets that are not empty -> ``(node, root)``: rids of the sets that links join, and the smallest of each.

    Each set is first compared with two leads of its buckets; then ``find``, like
    ``candidates``, says which rows of the buckets that still hold several components may be linked.
    """
    keys = cut(keyed(nodes), "keys")
    lead = cut(keys.groupBy("key").agg(F.count("*").alias("k"), F.min("rid").alias("lead")).where("k > 1").select("key", "lead"), "leads")
    members = cut(keys.join(lead, "key").select("key", "rid", "lead"), "members")
    first = cut(confirmed(first_groups(members, nodes), nodes, docs, size, percent), "links")
    joined = cut(components(first), "joined")
    named = members.select("key", "rid").join(joined, F.col("rid") == F.col("node"), "left").select("key", "rid", F.coalesce("root", "rid").alias("comp"))
    named = cut(named, "named")
    mixed = cut(named.groupBy("key").agg(F.min("comp").alias("a"), F.max("comp").alias("b")).where("a <> b").select("key"), "mixed")
    rest = find(named.join(mixed, "key", "left_semi").join(nodes.drop("sid", "low"), "rid"))
    rest = weighed(cut(rest, "candidates"))
    second = cut(confirmed(rest, nodes, docs, size, percent), "links")
    return components(first.unionByName(second)) if second.limit(1).count() else joined


def near_duplicates(docs: DataFrame, size: int = SHINGLE) -> DataFrame:
    """``docs(doc_id, text)`` -> ``(doc_id, n_shingles, component_id, kept)``, a row for each document.

    Documents are linked if their sets of distinct shingles have a Jaccard
    similarity of 0.85 or more; a link is confirmed on the sets of the whole
    texts.  Signatures only find candidates: all pairs that differ in at most
    GUARANTEED of SLOTS symbols meet, by pigeonhole, in a bucket that leaves one
    symbol of a chunk out.  At similarity 0.85 a pair meets nowhere, or is
    farther apart than FARTHEST, with a probability of 3e-8, above it with less.

    First each set is compared with two sets that lead its buckets, which joins
    most of what is alike; then buckets that still hold several components are
    compared in full.  Copies of a set are one row throughout.  Within a group
    only links that join components are written, never its pairs.

    Documents without words have n_shingles 0 and are linked with nothing.
    Documents of fewer words than a shingle have one, the whole sequence.  A null
    doc_id names a component only if it has no other; repeated doc_ids each keep
    a row.  ``kept``: the document's id is that of its component.  Other columns
    are left out; an empty table gives no rows.
    """
    rows = cut(signatures(docs, size), "signatures")
    low = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th", "n", "sig")).alias("low")
    nodes = cut(rows.where("n > 0").groupBy("sid").agg(low).select(F.monotonically_increasing_id().alias("rid"), "sid", "low.n", "low.sig", F.struct("low.no_id", "low.doc_id", "low.th").alias("low")), "sets")
    root = joined_sets(nodes, docs, size)
    named = nodes.join(root, F.col("rid") == F.col("node"), "left").select("sid", "low", F.coalesce("root", "rid").alias("root"))
    label = cut(named.groupBy("root").agg(F.min("low").alias("first")), "lows")
    label = cut(named.join(label, "root").select("sid", F.col("first.doc_id").alias("first"), F.lit(True).alias("has")), "labels")
    out = rows.join(label, "sid", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("has"), F.col("first")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of near copies over all documents; see ``near_duplicates`` for nulls, empty and long texts, repeats and empty tables."""
    return near_duplicates(read(spark, sf_dir, "documents"))


OP13_SQL = r"""WITH RECURSIVE worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  texts AS (SELECT w, row_number() OVER () AS sid FROM (SELECT DISTINCT w FROM worded)),
  shingles AS (SELECT DISTINCT sid, CASE WHEN len(w) < 5 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 4], ' ') END AS g
    FROM (SELECT sid, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM texts WHERE len(w) > 0)),
  sizes AS (SELECT sid, count(*) AS n FROM shingles GROUP BY 1),
  pairs AS (SELECT a.sid AS a, b.sid AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.g = b.g AND a.sid < b.sid GROUP BY 1, 2),
  links AS (SELECT a, b FROM pairs JOIN sizes x ON x.sid = a JOIN sizes y ON y.sid = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
  both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
  reach(a, b) AS (SELECT sid, sid FROM sizes UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON e.a = r.b),
  lows AS (SELECT r.a AS sid, min(d.doc_id) AS low FROM reach r JOIN texts t ON t.sid = r.b JOIN worded d ON d.w = t.w GROUP BY 1)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, coalesce(l.low, d.doc_id) AS component_id, d.doc_id = coalesce(l.low, d.doc_id) AS kept
FROM worded d JOIN texts t ON t.w = d.w LEFT JOIN sizes s ON s.sid = t.sid LEFT JOIN lows l ON l.sid = t.sid"""
