"""Stages that are made once, lookups over an index, tables laid out by key, and marriages without pairs."""

import glob
import os
import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import catalogue, ego, graph, keyed, lookup, upsert
from kinweave.operators.schema import Table, field
from kinweave.plans import stages
from kinweave.plans.stages import Silver, Stage


def _plan(df):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


# ------------------------------------------------------------------ stages


@pytest.fixture
def made(spark, tmp_path, monkeypatch):
    """Two inputs, and four stages: a of x, b of a, c of b and y, d of y, which is an index."""
    for name in "xy":
        spark.createDataFrame([(1, name), (2, name)], "k int, v string").write.parquet(f"{tmp_path}/in/{name}.parquet")
    monkeypatch.setattr(stages, "BRONZE", {n: ((lambda s, d, n=n: s.read.parquet(f"{d}/{n}.parquet")), (n,)) for n in "xy"})
    table = lambda name: Table(name, (field("k", required=True), field("v", type="string")), ("k",))
    fail = []

    def b(df):
        if fail:
            raise RuntimeError("lost")
        return df

    graph_ = (
        Stage(table("a"), ("x",), lambda x: x),
        Stage(table("b"), ("a",), b),
        Stage(table("c"), ("b", "y"), lambda x, y: x.join(y.select("k"), "k")),
        Stage(table("d"), ("y",), lambda y: y, bucket="k"),
    )
    return lambda stages_=graph_: Silver(spark, f"{tmp_path}/in", f"file://{tmp_path}/silver", stages_), tmp_path, fail, graph_


def test_stages_are_made_once_and_only_what_depends_on_a_change_again(spark, made):
    new, path, _, graph_ = made
    assert new().run() == ["a", "b", "c", "d"]
    assert new().run() == []
    assert [tuple(r) for r in new().table("c").orderBy("k").collect()] == [(1, "x"), (2, "x")]
    spark.createDataFrame([(1, "new")], "k int, v string").write.mode("overwrite").parquet(f"{path}/in/y.parquet")
    assert new().run() == ["c", "d"]
    assert [tuple(r) for r in new().table("d").collect()] == [(1, "new")]
    changed = (graph_[0], Stage(graph_[1].table, ("a",), lambda a: a.where("k = 1")), *graph_[2:])
    assert new(changed).run() == ["b", "c"]  # other code
    assert new().run() == []  # the tables of the old code are still there


def test_a_failed_run_goes_on_at_the_first_table_that_is_lacking(made):
    new, path, fail, _ = made
    fail.append(True)
    with pytest.raises(RuntimeError, match="lost"):
        new().run()
    assert not glob.glob(f"{path}/silver/b/*")
    fail.clear()
    assert new().run() == ["b", "c", "d"]


def test_what_is_written_is_checked(spark, made):
    new, path, _, graph_ = made
    with pytest.raises(ValueError, match="a: null in k"):
        new((Stage(graph_[0].table, ("x",), lambda x: x.withColumn("k", F.when(F.col("k") == 1, 1))),)).run()
    with pytest.raises(ValueError, match="a: k is not unique"):
        new((Stage(graph_[0].table, ("x",), lambda x: x.union(x)),)).run()
    with pytest.raises(ValueError, match="a: columns"):
        new((Stage(graph_[0].table, ("x",), lambda x: x.drop("v")),)).run()
    with pytest.raises(ValueError, match="a: v is int, not string"):
        new((Stage(graph_[0].table, ("x",), lambda x: x.withColumn("v", F.col("k"))),)).run()
    assert not glob.glob(f"{path}/silver/a/*")


def test_every_stage_follows_what_it_is_made_of():
    seen = set(stages.BRONZE)
    for s in stages.STAGES:
        assert set(s.of) <= seen
        seen.add(s.name)


def test_an_index_reads_one_bucket_for_one_id(spark, made):
    new, _, _, _ = made
    d = new().table("d")
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else the plan does not say so
    try:
        assert "SelectedBucketsCount: 1 out of 8" in _plan(d.where(F.col("k").isin([1])))
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


# ------------------------------------------------------------------ lookups


def family(spark, seed, n=70):
    """A random pedigree with marriages: chains, stars and rings of spouses, and a parent that is nobody."""
    rng = random.Random(seed)
    people = [f"p{i:03d}" for i in range(n)]
    persons = spark.createDataFrame([(p, None if rng.random() < 0.1 else p.upper(), rng.choice(["M", "F", None])) for p in people], "id string, label string, sex string")
    parents = [(people[rng.randrange(i)], people[i]) for i in range(5, n) for _ in range(2)] + [("stranger", "p010")]
    spouses = {tuple(sorted(rng.sample(people, 2))) for _ in range(n // 3)} | {("p000", f"p{i:03d}") for i in range(20, 28)}
    spouses |= {("p040", "p041"), ("p041", "p042"), ("p042", "p043"), ("p043", "p040")}
    parents = spark.createDataFrame(sorted(set(parents)), "parent_entity_person_id string, child_entity_person_id string")
    return persons, parents, spark.createDataFrame(sorted(spouses), "husband_entity_person_id string, wife_entity_person_id string"), sorted(spouses), people


def rows(df):
    return sorted(str(tuple(r)) for r in df.collect())


def test_lookups_equal_walks_over_whole_tables(spark, monkeypatch):
    persons, parents, spouses, _, _ = family(spark, 1)
    steps = ego.kin_steps(parents, spouses)
    ids = ["p010", "p041", "nobody"]
    every = ego.citizen_ego(persons, parents, spouses, depth=2)
    mine = [rows(df.where(F.col("ego").isin(ids))) for df in every]
    assert [rows(df) for df in lookup.networks_of(steps, persons, ids, depth=2)] == mine
    monkeypatch.setattr(lookup.near, "__defaults__", ("UDS", 3))  # too many for a lookup: joins over the tables
    assert [rows(df) for df in lookup.networks_of(steps, persons, ids, depth=2)] == mine


def test_trees_and_ancestors_by_lookup(spark):
    persons, parents, spouses, _, _ = family(spark, 2)
    steps = ego.kin_steps(parents, spouses)
    child_of = parents.select(F.col("child_entity_person_id").alias("child"), F.col("parent_entity_person_id").alias("parent"))
    spouse_of = spouses.select(F.col("husband_entity_person_id").alias("a"), F.col("wife_entity_person_id").alias("b"))
    one = spark.createDataFrame([("p012",), ("p030",), ("nobody",)], "id string")
    nodes = graph.five_tier_nodes(one, persons, child_of, spouse_of)
    got = lookup.tree_of(steps, persons, ["p012", "p030", "nobody"])
    assert rows(got[0]) == rows(nodes) and rows(got[1]) == rows(graph.induced_edges(nodes, child_of, spouse_of))
    pairs = [("p060", "p061"), ("p060", "p060"), ("p000", "nobody")]
    want = graph.common_ancestors(spark.createDataFrame(pairs, "a string, b string"), child_of, persons, limit=20, depth=None)
    assert rows(lookup.common_ancestors_of(steps, persons, pairs, limit=20)) == rows(want)


# ------------------------------------------------------------------ marriages


def distances(spouses):
    near = {}
    for a, b in spouses:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    out = {}
    for start in near:
        far, queue = {start: 0}, [start]
        for a in queue:
            for b in near[a]:
                if b not in far:
                    far[b] = far[a] + 1
                    queue.append(b)
        out |= {(start, b): d for b, d in far.items() if d}
    return out


def by_hubs(moves, back):
    members = {}
    for at, to, d in back:
        members.setdefault(at, []).append((to, d))
    out = {}
    for a, more in moves:
        for m in more:
            for to, d in members[m["at"]] if m["hub"] else [(m["at"], 0)]:
                if to != a:
                    out[a, to] = min(out.get((a, to), 99), m["d"] + d)
    return out


def test_distances_over_marriages_are_exact_without_their_pairs(spark):
    _, parents, spouses, pairs, _ = family(spark, 3)
    pairs = [p for p in pairs if p[0] != p[1]]
    moves, back, longest = ego.spouse_hubs(ego.kin_steps(parents, spouses))
    found = [(r["from"], [x.asDict() for x in r["to"]]) for r in moves.collect()]
    ways = [(r["at"], r["to"], r["d"]) for r in back.collect()]
    assert by_hubs(found, ways) == distances(pairs) and longest == max(d for _, _, d in ways)
    known = {}
    for a, b in pairs:
        known.setdefault(a, []).append((b, "S"))
        known.setdefault(b, []).append((a, "S"))
    local = lookup._hubs(known)
    assert by_hubs(local[0], local[1]) == distances(pairs)


def test_a_star_of_marriages_takes_a_row_for_each_person(spark):
    wives = spark.range(10_000).select(F.lit("h").alias("husband_entity_person_id"), F.concat(F.lit("w"), F.col("id")).alias("wife_entity_person_id"))
    none = spark.createDataFrame([], "parent_entity_person_id string, child_entity_person_id string")
    moves, back, longest = ego.spouse_hubs(ego.kin_steps(none, wives))
    assert (moves.count(), back.count(), longest) == (10_001, 10_001, 1)
    reach = ego.citizen_reach(spark.createDataFrame([("w7",)], "id string"), ego.kin_steps(none, wives), depth=1)
    assert reach.count() == 10_001 and {r.path for r in reach.where("n <= 2").select("path").distinct().collect()} == {"", "S", "SS"}


def test_long_marriage_chains_keep_their_labels(spark):
    chain = spark.createDataFrame([(f"m{i:02d}", f"m{i + 1:02d}") for i in range(40)], "husband_entity_person_id string, wife_entity_person_id string")
    none = spark.createDataFrame([("x", "m00")], "parent_entity_person_id string, child_entity_person_id string")
    got = {r.id: (r.g, r.n, r.path) for r in ego.citizen_reach(spark.createDataFrame([("x",)], "id string"), ego.kin_steps(none, chain), depth=1).collect()}
    assert got["x"] == (0, 0, "") and got["m00"] == (1, 1, "D") and got["m40"] == (1, 41, "D" + "S" * 40)


# ------------------------------------------------------------------ tables by key


def files(path):
    return {f for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


def test_an_upsert_leaves_other_folders_as_they_are(spark, tmp_path):
    path = f"{tmp_path}/t"
    old = spark.range(200).select(F.col("id").cast("string").alias("k"), F.lit("old").alias("v")).unionByName(spark.createDataFrame([(None, "null")], "k string, v string"))
    keyed.create(old, f"file://{path}", ["k"], 16)
    before = files(path)
    new = spark.createDataFrame([("5", "new"), ("500", "new")], "k string, v string")
    gone = spark.createDataFrame([("7",), ("5",), ("absent",)], "k string")
    for _ in range(2):
        touched = keyed.upsert(spark, f"file://{path}", new, ["k"], gone)
        assert 1 <= len(touched) <= 5
        after = files(path)
        part = lambda f: int(os.path.basename(os.path.dirname(f)).split("=")[1])
        assert {f for f in before if part(f) not in touched} == {f for f in after if part(f) not in touched}
        got = {r.k: r.v for r in keyed.read(spark, f"file://{path}").collect()}
        assert got == {**{str(i): "old" for i in range(200) if i != 7}, "5": "new", "500": "new", None: "null"}
    assert keyed.upsert(spark, f"file://{path}", new.limit(0), ["k"]) == []


def test_a_folder_that_loses_all_rows_goes(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    keyed.create(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), path, ["k"], 64)
    keyed.upsert(spark, path, spark.createDataFrame([], "k string, v int"), ["k"], spark.createDataFrame([("a",)], "k string"))
    assert [tuple(r)[:2] for r in keyed.read(spark, path).collect()] == [("b", 2)]


def test_a_keyed_lookup_reads_one_folder(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    keyed.create(spark.range(500).select(F.col("id").cast("string").alias("k"), "id"), path, ["k"], 32)
    hit = keyed.rows_of(keyed.read(spark, path), "k", ["77"])
    assert [tuple(r) for r in hit.collect()] == [("77", 77)]
    assert "PartitionFilters: [isnotnull(_part_of_32" in _plan(hit) or "PartitionFilters: [(_part_of_32" in _plan(hit)
    assert hit.inputFiles() and keyed.rows_of(keyed.read(spark, path), "k", []).collect() == []
    assert keyed.rows_of(keyed.read(spark, path), "k", ["absent"]).collect() == []


def test_upserts_by_key_refuse_repeats_and_other_columns(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    keyed.create(df, path, ["k"], 4)
    with pytest.raises(ValueError, match="repeats"):
        keyed.upsert(spark, path, df.union(df), ["k"])
    with pytest.raises(ValueError, match="different columns"):
        keyed.upsert(spark, path, df.drop("v"), ["k"])
    with pytest.raises(ValueError, match="not laid out"):
        keyed.rows_of(df, "k", ["a"])


# ------------------------------------------------------------------ folded networks, properties, the catalogue


def test_a_large_sponsor_costs_a_list_not_a_square(spark):
    m = 3000
    r = spark.range(m).select(F.concat(F.lit("r"), F.col("id")).alias("r"))
    residents = r.select(F.col("r").alias("entity_person_id"), F.lit("3").alias("relationship_code"))
    links_ = r.select(F.lit("c").alias("sponsor_entity_person_id"), F.col("r").alias("sponsored_entity_person_id"), F.lit("x").alias("relation_to_sponsor"), F.lit("3").alias("relationship_code"), F.lit("citizen").alias("sponsor_type"))
    groups = r.select(F.col("r").alias("entity_person_id"), F.lit("SPON:c").alias("family_group_id"))
    refs, lists = ego.folded_networks(residents, links_, groups)
    assert refs.count() <= 5 * m and lists.count() == 2 * m
    names = spark.createDataFrame([("c", "C", "M")], "id string, label string, sex string")
    two = spark.createDataFrame([("r5",), ("r7",)], "id string")
    folded = ego.unfolded(*ego.folded_networks(residents, links_, groups, ids=two), names)
    assert rows(folded) == rows(ego.resident_ego(residents, links_, groups, names, ids=two)[0])


def test_unfolded_networks_equal_the_full_ones(spark):
    rng = random.Random(4)
    ids = [f"r{i}" for i in range(25)]
    residents = spark.createDataFrame([(i, rng.choice(["2", "3", None])) for i in ids], "entity_person_id string, relationship_code string")
    link = "sponsor_entity_person_id string, sponsored_entity_person_id string, relation_to_sponsor string, relationship_code string, sponsor_type string"
    links_ = spark.createDataFrame([(rng.choice([*ids, "c1", "c2"]), i, rng.choice("xyz"), rng.choice("234"), rng.choice(["citizen", "resident"])) for i in ids for _ in range(2)], link)
    groups = spark.createDataFrame(sorted({(i, f"SPON:{rng.randrange(6)}") for i in ids for _ in range(2)}), "entity_person_id string, family_group_id string")
    names = spark.createDataFrame([("c1", "C", "M")], "id string, label string, sex string")
    for depth in (1, 2):
        assert rows(ego.unfolded(*ego.folded_networks(residents, links_, groups, depth=depth), names)) == rows(ego.resident_ego(residents, links_, groups, names, depth=depth)[0])
    with pytest.raises(ValueError):
        ego.folded_networks(residents, links_, groups, depth=3)


def test_properties_merge_column_by_column(spark):
    old = spark.createDataFrame([("1", "a", "m", "old"), (None, "b", None, "old"), ("3", "c", "f", "old")], "k string, v string, sex string, state string")
    new = spark.createDataFrame([("1", "A", 1, "made"), (None, None, 2, "made"), ("9", "Z", 3, "made")], "k string, v string, n int, state string")
    got = {r.k: tuple(r)[1:] for r in upsert.merge_properties(old, new, ["k"], on_create=("state",)).collect()}
    assert got == {"1": ("A", "m", "old", 1), None: (None, None, "old", 2), "3": ("c", "f", "old", None), "9": ("Z", None, "made", 3)}


def test_days_of_a_catalogue_table_are_pruned(spark, tmp_path):
    catalogue.ensure_namespace(spark, "pruned", f"file://{tmp_path}/ns")
    df = spark.createDataFrame([("a", "2020-01-01 23:59:59"), ("b", "2020-01-02 00:00:00"), ("c", "2020-01-03 00:00:00"), ("d", None)], "id string, at string").withColumn("at", F.col("at").cast("timestamp"))
    for _ in range(2):
        catalogue.save(df, "pruned.t", day_of="at")
    hit = catalogue.within(spark.table("pruned.t"), "at", "2020-01-02 00:00:00", "2020-01-03 00:00:00")
    assert [tuple(r)[0] for r in hit.collect()] == ["b"] and hit.columns == ["id", "at"]
    assert "PartitionFilters: [isnotnull(at_day" in _plan(hit)
    assert spark.table("pruned.t").count() == 4
    spark.sql("DROP NAMESPACE pruned CASCADE")
