"""Networks over composed ways: the same rows as by hubs, and edges that are taken once."""

import random

from pyspark.sql import functions as F

from kinweave.operators import catalogue, ego, graph, keyed, lookup, upsert
from kinweave.plans import stages


def steps_of(spark, seed):
    r = random.Random(seed)
    persons = spark.createDataFrame([(f"p{i}", f"n{i}", r.choice(["M", "F", None, "x"])) for i in range(30)], "id string, label string, sex string")
    parents = spark.createDataFrame(sorted({(f"p{r.randrange(k // 2 + 1)}", f"p{k}") for k in range(4, 30) for _ in range(2)}) + [("p9", "p9")], "parent_entity_person_id string, child_entity_person_id string")
    spouses = spark.createDataFrame([("p4", "p5"), ("p5", "p6"), ("p6", "p7"), ("p12", "p13"), ("p20", "p21"), ("p20", "p22")], "husband_entity_person_id string, wife_entity_person_id string")
    return persons, ego.kin_steps(parents, spouses)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_counts_and_edges_over_composed_ways_equal_those_by_hubs(spark, monkeypatch):
    persons, steps = steps_of(spark, 1)
    egos = persons.select("id").where("id < 'p2'")
    with monkeypatch.context() as m:
        m.setattr(ego, "WAYS", -1)  # nothing is composed: the hubs are walked
        reach = ego.citizen_reach(egos, steps, 2).localCheckpoint()
    want = rows(reach)
    kept = ego.citizen_reach(egos, steps, 2)
    assert rows(kept) == want
    assert rows(ego._walked_once(reach, steps, 2)) == rows(ego._walked(reach, steps, 2))
    counts = rows(reach.join(persons.select("id", "sex"), "id", "left").groupBy("path", "sex").agg(F.count("*").alias("n")))
    assert rows(ego.path_counts(egos, steps, persons, 2)) == counts


def test_a_large_star_is_not_composed(spark):
    wives = spark.range(2_000).select(F.lit("h").alias("husband_entity_person_id"), F.concat(F.lit("w"), F.col("id")).alias("wife_entity_person_id"))
    none = spark.createDataFrame([], "parent_entity_person_id string, child_entity_person_id string")
    steps = ego.kin_steps(none, wives)
    hubs = ego.spouse_hubs(steps)
    assert ego._ways(spark.createDataFrame([("w7",)], "id string"), steps.where("kind <> 'S'"), hubs) is None


def test_many_days_share_folders_and_are_still_pruned(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(catalogue, "FOLDERS", 10)
    catalogue.ensure_namespace(spark, "spans", f"file://{tmp_path}/ns")
    df = spark.range(200).select("id", F.expr("timestampadd(HOUR, 12 * id, TIMESTAMP'2020-01-01 00:00:00')").alias("at"))
    df = df.unionByName(spark.sql("SELECT 900L AS id, TIMESTAMP'0001-01-01 00:00:00' AS at UNION ALL SELECT 901L, CAST(NULL AS TIMESTAMP)"))
    catalogue.save(df, "spans.t", day_of="at")
    catalogue.save(df.where("id = 7"), "spans.t", day_of="at", mode="append")
    table = spark.table("spans.t")
    assert table.select(table.columns[-1]).distinct().count() <= 10 and table.count() == 203
    hit = catalogue.within(table, "at", "2020-02-01 06:00:00", "2020-02-10 12:00:00")
    assert sorted(r.id for r in hit.collect()) == list(range(63, 81)) and hit.columns == ["id", "at"]
    assert 1 <= len(hit.inputFiles()) < len(table.inputFiles())
    spark.sql("DROP NAMESPACE spans CASCADE")


def test_a_five_tier_tree_is_one_minimum_over_its_ways(spark):
    edges = spark.createDataFrame([("b", "a"), ("c", "b")], "child string, parent string")
    persons = spark.createDataFrame([(i, i, "M") for i in "abc"], "id string, label string, sex string")
    nodes = graph.five_tier_nodes(persons.select("id"), persons, edges, spark.createDataFrame([], "a string, b string"))
    assert {(r.ego, r.id): r.kin for r in nodes.where("ego = 'c'").collect()} == {("c", "c"): "self", ("c", "b"): "father", ("c", "a"): "paternal grandfather"}
    assert nodes._jdf.queryExecution().optimizedPlan().toString().count("Join LeftOuter") == 0  # before: one for each term


def test_exported_documents_and_keyed_tables_are_compressed(spark, tmp_path):
    cache = spark.range(50).select(F.col("id").cast("string").alias("k"), F.repeat(F.lit("id"), 1000).alias("ego_json"))
    upsert.export_json(cache, f"file://{tmp_path}/json")
    assert spark.read.text(f"file://{tmp_path}/json").count() == 50
    assert all(f.endswith(".gz") for f in spark.read.text(f"file://{tmp_path}/json").inputFiles())
    keyed.create(cache, f"file://{tmp_path}/keyed", ["k"], 2)
    assert keyed.read(spark, f"file://{tmp_path}/keyed").count() == 50
    assert all("zstd" in f for f in keyed.read(spark, f"file://{tmp_path}/keyed").inputFiles())


def test_common_ancestors_in_bulk_are_lists_of_generations(spark, monkeypatch):
    r = random.Random(5)
    edges = {(f"p{k:02}", f"p{r.randrange(max(k - 9, 0), k):02}") for k in range(3, 40) for _ in range(2)}
    edges |= {("p41", "p40"), ("p40", "p41"), ("p42", "p41"), ("p43", "p43")}  # ways in circles
    edges |= {(f"q{k}", f"q{k + 1}") for k in range(10, 20)}  # a line longer than what is walked for everyone
    child_of = spark.createDataFrame(sorted(edges), "child string, parent string")
    persons = spark.createDataFrame([(f"p{k:02}", f"n{k}") for k in range(30)], "id string, label string")
    pairs = [(f"p{k:02}", f"p{k + 3:02}") for k in range(0, 42)] + [("p07", "p07"), ("q10", "q19"), ("q11", "x"), ("x", "x"), ("p42", "p40")]
    asked = spark.createDataFrame(pairs, "a string, b string")
    monkeypatch.setattr(graph, "ROUNDS", 4)
    monkeypatch.setattr(graph, "NEAREST", 4)
    for limit, depth in ((1, None), (None, 2)):
        want = graph.common_ancestors(asked, child_of, persons, limit, depth)
        with monkeypatch.context() as m:
            m.setattr(graph, "all_ancestors", None)  # before: doubling joined every ancestor of a person with all of theirs
            got = graph.common_ancestors(asked, child_of, persons, limit, depth, bulk=True)
            columns = [c for c in got.columns if limit is not None or c != "rank"]
            assert rows(got.select(columns)) == rows(want.select(columns))


def test_resident_and_citizen_trees_walk_no_texts(spark, monkeypatch):
    r = random.Random(3)
    links = spark.createDataFrame(sorted({(f"r{r.randrange(20)}", f"r{r.randrange(14)}", str(r.randrange(3))) for _ in range(40)} | {("r1", "c9", None), ("r2", "r2", "x")}, key=str), "sponsored_entity_person_id string, sponsor_entity_person_id string, relation_to_sponsor string")
    sponsored_by = links.selectExpr("sponsored_entity_person_id child", "sponsor_entity_person_id parent").distinct()
    persons = spark.createDataFrame([(f"r{i}", f"n{i}" if i % 3 else None, "M", "resident") for i in range(18)], "id string, label string, sex string, person_type string")
    egos = spark.createDataFrame([(f"r{i}",) for i in range(1, 20)], "id string")
    edges = {(x.child, x.parent) for x in sponsored_by.collect()}
    known = {f"r{i}" for i in range(18)}
    tree = {}
    for e in known - {"r0"}:
        tree[e] = {e}
        for pairs in (edges, {(b, a) for a, b in edges}):
            front = {e}
            for _ in range(2):
                front = {b for a, b in pairs if a in front}
                tree[e] |= front & known
    with monkeypatch.context() as m:
        m.setattr(graph, "closure", None)  # before: four walks over texts, each compared with what was reached
        nodes, found = graph.resident_tree(egos, persons, sponsored_by)
        related = graph.resident_tree(egos, persons, sponsored_by, links=links)[1]
        assert {(x.ego, x.id) for x in nodes.collect()} == {(e, i) for e, more in tree.items() for i in more}
        assert rows(related) == rows(graph.with_relations(found, links))
        people = spark.createDataFrame([(i, i, "F") for i in ("a", "b", "c", "d", "r3")], "id string, label string, sex string")
        child_of = spark.createDataFrame([("b", "a"), ("c", "b"), ("d", "c"), ("a", "a")], "child string, parent string")
        spouse_of = spark.createDataFrame([("a", "b"), ("c", "r3")], "a string, b string")
        citizens = graph.citizen_tree_nodes(people.select("id"), people, child_of, spouse_of)
        kin = {(x.ego, x.id): x.kin for x in citizens.collect()}
        assert kin["a", "a"] == "self" and kin["b", "a"] == "spouse" and kin["d", "b"] == "relative" and kin["b", "c"] == "child" and ("d", "a") not in kin
        either = graph.tree_of_either(people.select("id"), people, child_of, spouse_of, egos, persons, sponsored_by)
        assert rows(either) == rows(graph.unified_tree(people.select("id").unionByName(egos), citizens, nodes))


def sponsored(spark, seed):
    r = random.Random(seed)
    ids = [f"r{i}" for i in range(40)]
    residents = spark.createDataFrame([(i, r.choice(["2", "3", None])) for i in ids], "entity_person_id string, relationship_code string")
    links_ = spark.createDataFrame(
        [(r.choice([*ids, "c1", "c2"]), i, r.choice("xyz"), r.choice("234"), r.choice(["citizen", "resident"])) for i in ids for _ in range(2)] + [("r1", i, "x", "3", "resident") for i in ids[:25]],
        "sponsor_entity_person_id string, sponsored_entity_person_id string, relation_to_sponsor string, relationship_code string, sponsor_type string",
    )
    groups = spark.createDataFrame(sorted({(i, f"SPON:{r.randrange(6)}") for i in ids for _ in range(2)} | {(i, "SPON:1") for i in ids[:20]}), "entity_person_id string, family_group_id string")
    names = spark.createDataFrame([("c1", "C", "M"), ("r3", "R", None), ("z", "Z", "F")], "id string, label string, sex string")
    return residents, links_, groups, names


def test_networks_from_lists_equal_those_by_levels(spark, monkeypatch):
    residents, links_, groups, names = sponsored(spark, 3)
    for depth in (1, 2):
        reached = ego._by_levels(residents, links_, groups, None, "en", depth).join(names, "id", "left").localCheckpoint()
        want = [rows(f(reached)) for f in (ego._sponsored_nodes, ego._sponsored_edges)]
        for most, chunk in ((64, 1024), (8, 5), (0, 1024)):  # none is made by comparing rows; some are, and lists are cut; all are
            monkeypatch.setattr(ego, "LISTS", most)
            monkeypatch.setattr(ego, "CHUNK", chunk)
            assert [rows(df) for df in ego.resident_ego(residents, links_, groups, names, depth=depth)] == want


def test_rows_of_networks_are_not_kept(spark, monkeypatch):
    m = 400
    r = spark.range(m).select(F.concat(F.lit("r"), F.col("id")).alias("r"))
    residents = r.select(F.col("r").alias("entity_person_id"), F.lit("3").alias("relationship_code"))
    links_ = r.select(F.lit("r0").alias("sponsor_entity_person_id"), F.col("r").alias("sponsored_entity_person_id"), F.lit("x").alias("relation_to_sponsor"), F.lit("3").alias("relationship_code"), F.lit("resident").alias("sponsor_type"))
    groups = r.select(F.col("r").alias("entity_person_id"), F.lit("SPON:r0").alias("family_group_id"))
    kept, settle = [], ego.settle
    monkeypatch.setattr(ego, "settle", lambda df, name: kept.append(settle(df, name)) or kept[-1])
    nodes, edges = ego.resident_ego(residents, links_, groups, spark.createDataFrame([], "id string, label string, sex string"))
    assert nodes.count() == m * m and edges.count() == m * (m - 1)
    assert sum(df.count() for df in kept) < 20 * m


def test_networks_of_few_by_waves_equal_those_by_hubs(spark, monkeypatch):
    persons, steps = steps_of(spark, 2)
    ids = ["p5", "p9", "p20", "nobody"]
    egos = spark.createDataFrame([(i,) for i in ids[:3]], "id string")
    for depth in (1, 3):
        want = [rows(df) for df in ego.networks(egos, steps, persons, depth=depth)]
        monkeypatch.setattr(lookup, "NEAR", 2)
        monkeypatch.setattr(ego, "near_steps", None)
        monkeypatch.setattr(ego, "spouse_hubs", None)  # marriages of the whole population are not looked at
        assert [rows(df) for df in lookup.networks_of(steps, persons, ids, depth=depth)] == want
        monkeypatch.undo()
    wives = spark.createDataFrame([(f"q{i}", f"q{i + 1}") for i in range(9)], "husband_entity_person_id string, wife_entity_person_id string")
    parents = spark.createDataFrame([("q0", "c"), ("q9", "c"), ("c", "q4")], "parent_entity_person_id string, child_entity_person_id string")
    chain = ego.kin_steps(parents, wives).localCheckpoint()
    codes = lambda df, c: df.withColumn(c, F.abs(F.xxhash64(c)))
    q3 = codes(spark.createDataFrame([("q3",), ("c",)], "id string"), "id")
    walk = codes(codes(chain, "from"), "to").localCheckpoint()
    got = ego._by_waves(q3, walk, 3).select("ego", "id", "g", "label.n", "label.path")
    assert rows(got) == rows(ego.citizen_reach(q3, walk, 3))


def test_buckets_of_an_index_grow_with_its_input(monkeypatch):
    silver = stages.Silver(None, "/none", "/none")
    size = {6: 1_900_000, 60: 19_000_000, 360: 114_000_000}  # bytes of customers, in multiples of sf0.1
    count = {}
    for n, b in size.items():
        monkeypatch.setattr(silver, "_files", lambda t, b=b: [("f", b, 0)])
        count[n] = silver.buckets("entity_steps")
    assert count[60] >= 8 * count[6] and count[360] >= 4 * count[60]
