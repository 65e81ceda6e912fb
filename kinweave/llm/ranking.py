"""Grouped ranking with ties: secondary sort by an own partitioner on group and pair range, a streaming state machine, and a repair of groups that span tasks."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, cut, read, ship, shuffle_parts

#: Rows of an Arrow batch of narrow rows, and sampled keys for each partition of the sort.
BATCH, SAMPLED = 1 << 16, 64
#: Equal lines that one row of an intermediate table stands for at most.
COPIES = 8192
#: Bytes of a value in a sort key: a flag for null, then 64 bits.
WIDTH = 9

_SIGN = np.uint64(1 << 63)
_STATE = "kind int, part int, run long, first boolean, m long, pos long, place long, tied long, first_key binary, last_key binary, stats array<long>"
ROW, RUN, EDGE = 0, 1, 2


@dataclass(frozen=True)
class Order:
    """A whole-number column to sort by; nulls are last and equal to each other."""

    name: str
    descending: bool = False


def encode(values: list[pa.Array], orders: list[Order]) -> np.ndarray:
    """n x 9k bytes whose order, byte by byte, is that of the rows."""
    out = np.zeros((len(values[0]), WIDTH * len(orders)), np.uint8)
    for i, (v, o) in enumerate(zip(values, orders, strict=True)):
        null = np.asarray(v.is_null())
        x = np.asarray(v.cast(pa.int64()).fill_null(0)).view(np.uint64) ^ _SIGN
        x = np.where(null, np.uint64(0), ~x if o.descending else x)
        out[:, WIDTH * i] = null
        out[:, WIDTH * i + 1 : WIDTH * (i + 1)] = x.astype(">u8").view(np.uint8).reshape(-1, 8)
    return out


def decode(keys: np.ndarray, orders: list[Order]) -> list[pa.Array]:
    """The columns that ``encode`` made the keys of."""
    out = []
    for i, o in enumerate(orders):
        x = np.ascontiguousarray(keys[:, WIDTH * i + 1 : WIDTH * (i + 1)]).view(">u8").reshape(-1).astype(np.uint64)
        out.append(pa.array(((~x if o.descending else x) ^ _SIGN).view(np.int64), mask=keys[:, WIDTH * i] == 1))
    return out


def _columns(orders: list[Order]) -> list[str]:
    """Names of the sort columns in tables that have columns of their own, which they cannot clash with."""
    return [f"_{i}" for i in range(len(orders))]


def _flat(keys: np.ndarray) -> np.ndarray:
    """Keys as one fixed-length value each, which numpy can sort and search."""
    return np.ascontiguousarray(keys).view(f"S{keys.shape[1]}").reshape(-1)


def _matrix(array: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(array.to_pylist()), np.uint8).reshape(len(array), width)


def _one(chunked: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(chunked.chunks) if chunked.num_chunks else pa.array([], chunked.type)


def _binary(keys: np.ndarray) -> pa.Array:
    """A binary column of rows of one length, without a Python object for each."""
    n, width = keys.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(keys))])


def _narrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """``mapInArrow`` with large batches, for rows of a few numbers."""
    ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    return df.mapInArrow(fn, schema)


def bounds(lines: DataFrame, orders: list[Order], parts: int) -> np.ndarray:
    """Keys that cut the sorted lines into ``parts`` ranges of about equal size.

    They come from a random sample of about SAMPLED keys a partition: the driver
    holds so many, whatever the number of lines.  Where they fall decides only
    how even the partitions are.
    """
    n = lines.count()
    want = SAMPLED * parts
    sample = lines if n <= want else lines.sample(min(1.0, want / n), seed=11)
    rows = sample.toArrow()
    if not rows.num_rows or parts < 2:
        return np.zeros(0, f"S{WIDTH * len(orders)}")
    keys = np.sort(_flat(encode([_one(c) for c in rows.columns], orders)))
    return np.unique(keys[np.arange(1, parts) * len(keys) // parts])


def partitioned(lines: DataFrame, orders: list[Order], cuts: np.ndarray) -> DataFrame:
    """``(part, key, m)``: the range that a line falls in, its sort key, and how many lines of a batch are equal to it.

    A range is a piece of one group's pairs, of one pair's lines, or of several
    small groups: hot groups and hot pairs are spread over tasks, and equal lines
    are counted before they are shuffled.
    """
    names = _columns(orders)

    def run(batches: Iterator[pa.RecordBatch]):
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]).group_by(names, use_threads=False).aggregate([([], "count_all")])
            keys = encode([_one(t.column(n)) for n in names], orders)
            part = np.searchsorted(cuts, _flat(keys), side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(part), _binary(keys), _one(t.column("count_all")).cast(pa.int64())], ["part", "key", "m"])

    return _narrow(lines, run, "part int, key binary, m long")


class Machine:
    """Ranks the lines of one sorted partition, batch by batch; what it holds does not grow with a group or a pair."""

    def __init__(self, group: int, pair: int, top: int | None):
        self.group, self.pair, self.top = WIDTH * group, WIDTH * pair, top
        self.last: np.ndarray | None = None  # the key of the line before
        self.part = -1
        self.total = 0  # lines so far
        self.run, self.run_lines = -1, 0  # the pair that is open, by its place in the partition, and its lines so far
        self.waiting = False  # lines of the open pair were given out without its count
        self.start, self.start_run, self.groups = 0, 0, 0  # lines and pairs before the open group
        self.first_key = b""
        self.first: list[int] = []  # lines and pairs of the first group
        self.first_run: int | None = None

    def feed(self, part: int, keys: np.ndarray, m: np.ndarray) -> dict:
        """Ranks a batch: columns of its lines, and the pairs before it that end in it."""
        n = len(keys)
        self.part = part
        before = np.concatenate([self.last[None] if self.last is not None else ~keys[:1], keys[:-1]])
        changed = before[:, : self.pair] != keys[:, : self.pair]
        new_pair = changed.any(1)
        new_group = changed[:, : self.group].any(1) if self.group else np.zeros(n, bool)
        if self.last is None:
            new_pair[0] = new_group[0] = True
            self.first_key = keys[0, : self.pair].tobytes()
        run = self.run + np.cumsum(new_pair)
        done = self.total + np.cumsum(m)
        at = np.maximum.accumulate(np.where(new_group, np.arange(n), -1))
        start = np.where(at >= 0, (done - m)[at], self.start)
        start_run = np.where(at >= 0, run[at], self.start_run)
        starts = np.flatnonzero(new_group)
        if self.groups <= 1 < self.groups + len(starts):  # the first group ends here
            k = starts[1 - self.groups]
            begun = (0, 0) if not self.groups else (self.start, self.start_run)
            self.first = [int((done - m)[k]) - begun[0], int(run[k]) - begun[1]]
        group_no = self.groups + np.cumsum(new_group)
        # lines of each pair that the batch touches; the first may go on from before, the last may go on after
        heads = np.flatnonzero(new_pair)
        sums = np.add.reduceat(m, np.union1d([0], heads))
        ended = []
        if new_pair[0]:
            if self.run >= 0:
                ended.append((self.run, self.run_lines))
        else:
            sums[0] += self.run_lines
            if len(heads):
                ended.append((self.run, int(sums[0])))
        which = np.cumsum(new_pair) - (1 if new_pair[0] else 0)
        tied = sums[which]
        open_ = which == len(sums) - 1
        if self.first_run is None and ended and ended[0][0] == 0:
            self.first_run = ended[0][1]
        if self.first_run is None and run[0] == 0 and len(sums) > 1:
            self.first_run = int(sums[0])
        told = [e for e in ended if self.waiting]
        place = run - start_run + 1
        stay = np.ones(n, bool) if self.top is None else place <= self.top
        out = {"keys": keys, "m": m, "run": run, "first": group_no == 1, "pos": done - m - start + 1, "place": place, "tied": tied, "open": open_, "stay": stay, "told": told}
        if len(heads):  # else the pair that is open stays so
            self.waiting = False
        self.waiting = self.waiting or bool((open_ & stay).any())
        self.last, self.total, self.run, self.run_lines = keys[-1].copy(), int(done[-1]), int(run[-1]), int(sums[-1])
        self.start, self.start_run, self.groups = int(start[-1]), int(start_run[-1]), int(group_no[-1])
        return out

    def edge(self) -> tuple[bytes, bytes, list[int]]:
        """First and last pair of the partition; lines and pairs of its first and last group, lines of its first and last pair."""
        last = [self.total - self.start, self.run - self.start_run + 1]
        if self.run == 0:
            self.first_run = self.run_lines
        return self.first_key, self.last[: self.pair].tobytes(), [*(self.first or last), self.first_run, *last, self.run, self.run_lines, self.groups]


def ranked_parts(sorted_lines: DataFrame, orders: list[Order], group: int, pair: int, top: int | None) -> DataFrame:
    """``(part, key, m)``, sorted within partitions -> lines with their ranks within their partition, open pairs that have ended, and an edge for each partition."""
    width = WIDTH * len(orders)
    names = _columns(orders)
    schema = ", ".join(f"{n} long" for n in names)
    fields = pa.schema(
        [
            *((f, t) for f, t in zip("kind part run first m pos place tied first_key last_key stats".split(), [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), *[pa.int64()] * 4, pa.binary(), pa.binary(), pa.list_(pa.int64())], strict=True)),
            *((n, pa.int64()) for n in names),
        ]
    )

    def batch(n: int, **columns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([columns[f.name].cast(f.type) if f.name in columns else pa.nulls(n, f.type) for f in fields], schema=fields)

    def run(batches: Iterator[pa.RecordBatch]):
        machine = Machine(group, pair, top)
        for b in batches:
            if not b.num_rows:
                continue
            keys, m = _matrix(column(b, "key"), width), np.asarray(column(b, "m"))
            r = machine.feed(int(column(b, "part")[0].as_py()), keys, m)
            for number, lines in r["told"]:
                yield batch(1, kind=pa.array([RUN]), part=pa.array([machine.part]), run=pa.array([number]), tied=pa.array([lines]))
            i = np.flatnonzero(r["stay"])
            times = -(-r["m"][i] // COPIES)  # a row stands for so many lines at most
            i = np.repeat(i, times)
            nth = np.arange(len(i)) - np.repeat(np.cumsum(times) - times, times)
            left = np.minimum(r["m"][i] - nth * COPIES, COPIES)
            if len(i):
                yield batch(
                    len(i),
                    kind=pa.array(np.full(len(i), ROW)),
                    part=pa.array(np.full(len(i), machine.part)),
                    run=pa.array(r["run"][i]),
                    first=pa.array(r["first"][i]),
                    m=pa.array(left),
                    pos=pa.array(r["pos"][i] + nth * COPIES),
                    place=pa.array(r["place"][i]),
                    tied=pa.array(r["tied"][i], mask=r["open"][i]),
                    **dict(zip(names, decode(keys[i], orders), strict=True)),
                )
        if machine.last is not None:
            first, last, stats = machine.edge()
            if machine.waiting:
                yield batch(1, kind=pa.array([RUN]), part=pa.array([machine.part]), run=pa.array([machine.run]), tied=pa.array([machine.run_lines]))
            yield batch(1, kind=pa.array([EDGE]), part=pa.array([machine.part]), first_key=pa.array([first]), last_key=pa.array([last]), stats=pa.array([stats], pa.list_(pa.int64())))

    return _narrow(sorted_lines, run, f"{_STATE}, {schema}")


def repairs(edges: list[tuple[int, bytes, bytes, list[int]]], group: int) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Edges in order of their partition -> what to add to the first group of a partition ``(part, pos, place)``, and the lines of pairs that span partitions ``(part, run, tied)``."""
    width = WIDTH * group
    offsets, totals = [], []
    lines = pairs = 0  # of the group that the partition before ended in
    last: bytes | None = None
    chain: list[tuple[int, int]] = []  # where the pair that is open has lines, and how many
    chained = 0

    def close() -> None:
        totals.extend((part, run, chained) for part, run in chain if len(chain) > 1)

    for part, first_key, last_key, (first_lines, first_pairs, first_run, last_lines, last_pairs, last_run, last_run_lines, groups) in edges:
        on = last is not None and last[:width] == first_key[:width]
        same = last == first_key
        if on:
            offsets.append((part, lines, pairs - same))
        if same:
            chain, chained = [*chain, (part, 0)], chained + first_run
        else:
            close()
            chain, chained = [(part, 0)], first_run
        if last_run:  # the first pair ends within the partition, and another is open at its end
            close()
            chain, chained = [(part, last_run)], last_run_lines
        if groups == 1 and on:
            lines, pairs = lines + first_lines, pairs - same + first_pairs
        else:
            lines, pairs = last_lines, last_pairs
        last = last_key
    close()
    return offsets, totals


def grouped_ranks(df: DataFrame, group: list[str], pair: list[Order], ties: list[Order], top: int | None = None, parts: int | None = None) -> DataFrame:
    """Every line of ``df`` with its ranks within its group: ``group``, ``pair`` and ``ties`` columns, ``pos``, ``place``, ``tied``, all long.

    ``place`` is 1 plus the distinct earlier pairs of the group, ``pos`` counts
    lines in order of pair and ties, ``tied`` is the group's number of lines with
    that pair.  With ``top`` only lines of a place up to it are returned; ``tied``
    and ``pos`` count the others too.

    A line's key is its group, pair and ties.  Keys are dealt to partitions by
    range, whatever group they belong to, and sorted within them; one pass ranks
    each partition as it streams by, and the partitions' edges (two a partition)
    repair the groups and pairs that span several.  Neither a group nor a pair,
    nor equal lines, are ever in one task as a whole.

    Columns are whole numbers (cast to long), nulls last and equal to each
    other, in groups too.  Equal lines have a row each and differ in ``pos``.
    Other columns are left out.  An empty table gives no rows.
    """
    spark = df.sparkSession
    orders = [*(Order(g) for g in group), *pair, *ties]
    if len({o.name for o in orders}) < len(orders):
        raise ValueError("a column is named twice")
    parts = parts or shuffle_parts(spark)
    names = _columns(orders)
    lines = df.select(*(F.col(f"`{o.name}`").cast("long").alias(n) for o, n in zip(orders, names, strict=True)))
    cuts = bounds(lines, orders, parts)
    dealt = partitioned(lines, orders, cuts).repartitionById(parts, F.col("part")).sortWithinPartitions("key")
    out = cut(ranked_parts(dealt, orders, len(group), len(group) + len(pair), top), "ranks")
    edges = sorted((r.part, bytes(r.first_key), bytes(r.last_key), list(r.stats)) for r in out.where(F.col("kind") == EDGE).select("part", "first_key", "last_key", "stats").collect())
    offsets, totals = repairs(edges, len(group))
    # both have at most two rows a partition
    add = F.broadcast(spark.createDataFrame(offsets, "part int, add_pos long, add_place long"))
    span = F.broadcast(spark.createDataFrame(totals, "part int, run long, spanning long"))
    rows = out.where(F.col("kind") == ROW).join(add, "part", "left").join(span, ["part", "run"], "left")
    moved = lambda c: F.col(c) + F.when(F.col("first"), F.coalesce(f"add_{c}", F.lit(0))).otherwise(0)
    rows = rows.select("part", "run", "m", *names, moved("pos").alias("pos"), moved("place").alias("place"), F.coalesce("spanning", "tied").alias("tied"))
    rows = rows if top is None else rows.where(F.col("place") <= top)
    ended = out.where(F.col("kind") == RUN).select("part", "run", F.col("tied").alias("ended"))
    late = rows.where("tied is null").join(ended, ["part", "run"]).withColumn("tied", F.col("ended")).drop("ended")
    rows = rows.where("tied is not null").unionByName(late).select("m", *names, "pos", "place", "tied")
    copies = rows.where("m > 1").repartition(parts).select(*names, F.explode(F.sequence("pos", F.col("pos") + F.col("m") - 1)).alias("pos"), "place", "tied")
    rows = rows.where("m = 1").select(*names, "pos", "place", "tied").unionByName(copies)
    return rows.select(*(F.col(n).alias(o.name) for o, n in zip(orders, names, strict=True)), "pos", "place", "tied")


#: Lines of these groups are returned up to this place.
TOP = 5


def sale_ranks(lines: DataFrame) -> DataFrame:
    """Group, pair and ties of sale lines; a discount or amount that is no finite number is null."""
    long = lambda e: F.floor(e).cast("long")
    cents = lambda c: F.when(F.abs(F.col(c).cast("double")) < float("inf"), long(F.col(c).cast("double") * 100 + 0.5))
    one = F.coalesce(F.crc32(F.col("sale_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    mine = lambda e: F.when(one, F.lit(-1)).otherwise(e).cast("long")
    return lines.select(
        mine(F.col("vendor_id")).alias("vendor_id"),
        mine(F.coalesce(F.pmod("item_id", F.lit(2)), F.lit(-1))).alias("part"),
        mine(F.coalesce(F.year("shipped_at") * 100 + F.month("shipped_at"), F.lit(-1))).alias("month"),
        long(F.col("quantity") / 10).alias("tens"),
        cents("discount").alias("percent"),
        F.col("sale_id").cast("long").alias("sale_id"),
        F.col("line_no").cast("long").alias("line_no"),
        F.col("quantity").cast("long").alias("quantity"),
        cents("amount").alias("amount_cents"),
    )


def op11_grouped_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of all sale lines in their groups of vendor, part and month, up to the fifth; see ``grouped_ranks`` for nulls, ties, repeats and empty tables."""
    lines = sale_ranks(read(spark, sf_dir, "sale_lines"))
    ranked = grouped_ranks(lines, ["vendor_id", "part", "month"], [Order("tens", descending=True), Order("percent")], [Order(c) for c in ("sale_id", "line_no", "quantity", "amount_cents")], top=TOP)
    return ranked.select("vendor_id", "part", "month", "pos", "place", "sale_id", "line_no", "quantity", "percent", "amount_cents", "tied")


#: CRC-32 of a number's decimal text, byte by byte over a table that is made from the polynomial.
_CRC = """table_ AS (SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)), lambda c, x: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS t),
  ids AS (SELECT sale_id, list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(sale_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1])) AS c
    FROM (SELECT DISTINCT sale_id FROM sale_lines WHERE sale_id IS NOT NULL), table_),
  fifth AS (SELECT sale_id FROM ids WHERE xor(c, 4294967295) % 5 = 0)"""

OP11_SQL = f"""WITH {_CRC},
  base AS (SELECT s.*, CAST(floor(quantity / 10.0) AS BIGINT) AS tens, CASE WHEN isfinite(discount) THEN CAST(floor(100 * discount + 0.5) AS BIGINT) END AS percent,
    CASE WHEN isfinite(amount) THEN CAST(floor(100 * amount + 0.5) AS BIGINT) END AS amount_cents, f.sale_id IS NOT NULL AS one FROM sale_lines s LEFT JOIN fifth f ON f.sale_id = s.sale_id),
  grouped AS (SELECT CAST(CASE WHEN one THEN -1 ELSE vendor_id END AS BIGINT) AS vendor_id, CAST(CASE WHEN one THEN -1 ELSE coalesce(((item_id % 2) + 2) % 2, -1) END AS BIGINT) AS part,
    CAST(CASE WHEN one THEN -1 ELSE coalesce(100 * year(shipped_at) + month(shipped_at), -1) END AS BIGINT) AS month, tens, percent, CAST(sale_id AS BIGINT) AS sale_id, CAST(line_no AS BIGINT) AS line_no, CAST(quantity AS BIGINT) AS quantity, amount_cents FROM base),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST, sale_id NULLS LAST, line_no NULLS LAST, quantity NULLS LAST, amount_cents NULLS LAST) AS pos,
    dense_rank() OVER (PARTITION BY vendor_id, part, month ORDER BY tens DESC NULLS LAST, percent NULLS LAST) AS place, count(*) OVER (PARTITION BY vendor_id, part, month, tens, percent) AS tied FROM grouped)
SELECT vendor_id, part, month, pos, place, sale_id, line_no, quantity, percent, amount_cents, tied FROM ranked WHERE place <= {TOP}"""
