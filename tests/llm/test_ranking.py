"""Grouped ranks against a brute-force version: hot groups, hot pairs, equal lines, nulls and empty tables."""

import itertools
import random

import pytest

from kinweave.llm import ranking
from kinweave.llm.ranking import Order, grouped_ranks, repairs

LINES = "g long, h long, a long, b long, s long, part int, key string, m long, pos string"
ORDERS = (["g", "h"], [Order("a", descending=True), Order("b")], [Order("s")])


def brute(rows, top):
    last = lambda v: (v is None, v or 0)
    down = lambda v: (v is None, -(v or 0))
    out = []
    groups = {}
    for g, h, a, b, s in rows:
        groups.setdefault((g, h), []).append((a, b, s))
    for (g, h), lines in groups.items():
        lines.sort(key=lambda r: (down(r[0]), last(r[1]), last(r[2])))
        place = 0
        for i, (a, b, s) in enumerate(lines):
            place += i == 0 or lines[i - 1][:2] != (a, b)
            if top is None or place <= top:
                out.append((g, h, a, b, s, i + 1, place, sum(r[:2] == (a, b) for r in lines)))
    return sorted(map(str, out))


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "clash", 3, "clash") for r in rows], LINES).repartition(5)


def made(kind, rng):
    some = lambda n: rng.choice([None, *range(n)])
    if kind == "mixed":
        return [(some(5), some(2), some(4), some(4), some(30)) for _ in range(900)]
    if kind == "one group":
        return [(1, 1, some(9), some(9), some(5)) for _ in range(900)]
    if kind == "one pair":
        return [(1, 1, 2, None, some(700)) for _ in range(900)] + [(2, None, 1, 1, 1)]
    if kind == "equal lines":
        return [(1, 1, 2, 3, 4)] * 900 + [(1, 1, 3, 0, 0), (1, 1, 1, 0, 0), (0, 0, 0, 0, 0)]
    if kind == "groups of one":
        return [(i, None, some(3), -i, i) for i in range(-300, 300)]
    if kind == "far values":
        far = [None, -(2**63), 2**63 - 1, 0, -1]
        return [(rng.choice(far), 0, rng.choice(far), rng.choice(far), rng.choice(far)) for _ in range(300)]
    return []


@pytest.mark.parametrize("kind", ["mixed", "one group", "one pair", "equal lines", "groups of one", "far values", "empty"])
@pytest.mark.parametrize("top,batch,copies,parts", [(None, 1 << 16, 8192, 7), (3, 16, 5, 11), (1, 3, 1, 3)])
def test_ranks_equal_brute_force(spark, monkeypatch, kind, top, batch, copies, parts):
    monkeypatch.setattr(ranking, "BATCH", batch)
    monkeypatch.setattr(ranking, "COPIES", copies)
    rows = made(kind, random.Random(f"{kind}{top}"))
    got = grouped_ranks(table(spark, rows), *ORDERS, top=top, parts=parts)
    assert got.columns == ["g", "h", "a", "b", "s", "pos", "place", "tied"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, top)


def test_hot_group_and_pair_are_spread(spark):
    """No partition of the sort holds much more than its share, whatever the groups are."""
    rows = [(1, 1, 2, 3, i) for i in range(6000)]
    orders = [Order(f"_{i}") for i in range(5)]
    lines = spark.createDataFrame(rows, "_0 long, _1 long, _2 long, _3 long, _4 long")
    cuts = ranking.bounds(lines, orders, 10)
    sizes = [r["count"] for r in ranking.partitioned(lines, orders, cuts).groupBy("part").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 1200


def test_equal_lines_are_counted_before_the_shuffle(spark):
    lines = spark.createDataFrame([(1, 1)] * 5000, "_0 long, _1 long").coalesce(1)
    orders = [Order("_0"), Order("_1")]
    assert [r.m for r in ranking.partitioned(lines, orders, ranking.bounds(lines, orders, 4)).collect()] == [5000]


def test_repairs_chain_over_partitions():
    g, h = b"g" * 9, b"h" * 9
    p, q = b"p" * 9, b"q" * 9
    # three partitions within one pair, the last goes on to another pair and another group
    edges = [(0, g + p, g + p, [4, 1, 4, 4, 1, 0, 4, 1]), (2, g + p, g + p, [5, 1, 5, 5, 1, 0, 5, 1]), (3, g + p, h + q, [3, 2, 2, 6, 1, 2, 6, 2])]
    offsets, totals = repairs(edges, 1)
    assert offsets == [(2, 4, 0), (3, 9, 0)]
    assert sorted(totals) == [(0, 0, 11), (2, 0, 11), (3, 0, 11)]


def test_keys_keep_the_order():
    import pyarrow as pa

    values = [None, -(2**63), -5, 0, 7, 2**63 - 1]
    rows = list(itertools.product(values, values))
    orders = [Order("x", descending=True), Order("y")]
    keys = ranking.encode([pa.array([r[i] for r in rows], pa.int64()) for i in range(2)], orders)
    by_key = [rows[i] for i in sorted(range(len(rows)), key=lambda i: keys[i].tobytes())]
    assert by_key == sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] is None, r[1] or 0))
    assert [a.to_pylist() for a in ranking.decode(keys, orders)] == [[r[i] for r in rows] for i in range(2)]


def test_a_column_named_twice_is_refused(spark):
    with pytest.raises(ValueError, match="twice"):
        grouped_ranks(spark.createDataFrame([], LINES), ["g"], [Order("g")], [])


def test_sale_ranks_take_awkward_lines(spark):
    schema = "sale_id long, line_no int, item_id long, vendor_id long, quantity int, amount double, discount double, flag string, shipped_at timestamp_ntz, part string, pos string"
    nan, inf = float("nan"), float("inf")
    rows = [(None,) * 9 + ("x", "y"), (1, 1, 3, 2, 19, 1.005, nan, None, None, "x", "y"), (1, 1, -3, 2, -1, inf, 0.05, None, None, "x", "y")]
    got = ranking.sale_ranks(spark.createDataFrame(rows, schema)).collect()
    assert [tuple(r)[:5] for r in got] == [(None, -1, -1, None, None), (2, 1, -1, 1, None), (2, 1, -1, -1, 5)]
    assert [r.amount_cents for r in got] == [None, 100, None]
