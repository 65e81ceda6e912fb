"""Entity resolution, links and networks on small pedigrees."""

import random

import pytest
from pyspark.sql import functions as F

from kinweave.operators import ego, graph, keyed, layout, links, payload, resolve, upsert

PERSON = "spm_person_no string, spm_full_aname string, spm_full_ename string, spm_dob string, spm_national_id string, spm_gender int, spm_place_of_birth_eng string, nat_code_curr_nat int, emi_code int, cit_code int, spm_modified_date timestamp, spm_created_date timestamp"


def person(no, aname="a", dob="1980-01-01", nid=None, gender=1, place=None):
    return (no, aname, None, dob, nid, gender, place, None, None, None, None, None)


def test_duplicate_registrations_are_one_entity(spark):
    rows = [person("1", nid="784-1 0"), person("2", nid="78410", place="x"), person("3", nid=" "), person("4", nid="  "), person("5", aname="z", nid="")]
    df = spark.createDataFrame(rows, PERSON)
    got = {r["primary_spm_person_no"] for r in resolve.golden_citizens(df).collect()}
    # 1 and 2 share a national id and 2 is more complete; 3 and 4 share name, date and gender; blank ids alone join nobody
    assert got == {"2", "3", "5"}
    alias = {r["spm_person_no"]: (r["entity_person_id"], r["confidence"]) for r in resolve.alias_citizens(df).collect()}
    assert alias["1"][0] == alias["2"][0] != alias["5"][0] and alias["1"][1] == 1.0 and alias["5"][1] == 0.9


def test_ids_do_not_depend_on_row_order(spark):
    rows = [person(str(i), aname=f"n{i % 7}", nid=str(i % 5) if i % 3 else None) for i in range(40)]
    a = {tuple(r) for r in resolve.golden_citizens(spark.createDataFrame(rows, PERSON)).collect()}
    random.Random(1).shuffle(rows)
    assert a == {tuple(r) for r in resolve.golden_citizens(spark.createDataFrame(rows, PERSON).repartition(3)).collect()}


def test_bad_dates_and_codes_are_null(spark):
    rows = [person("1", dob="soon"), person("2", dob=None)]
    assert {r["cluster_key"] for r in resolve.cluster_citizens(spark.createDataFrame(rows, PERSON)).collect()} == {"1", "2"}


DETAIL = "spm_person_no string, spm_person_no_father string, spm_person_no_mother string, crm_seq string, rel1_code int"


def test_two_wives_and_no_self_marriage(spark):
    detail = spark.createDataFrame([("h", None, None, "B", 1), ("w1", None, None, "B", 2), ("w2", None, None, "B", 2), ("h2", None, None, "B", 2), ("c", "h", "w2", "B", 3)], DETAIL)
    master = spark.createDataFrame([("B", "h")], "crm_seq string, spm_person_no string")
    alias = spark.createDataFrame([("H", "h"), ("H", "h2"), ("W1", "w1"), ("W2", "w2"), ("C", "c")], "entity_person_id string, spm_person_no string")
    assert {(r[0], r[1]) for r in links.spouse_links(detail, master, alias).collect()} == {("H", "W1"), ("H", "W2")}
    assert {(r[0], r[1], r[2]) for r in links.parent_links(detail, alias).collect()} == {("H", "C", "father"), ("W2", "C", "mother")}
    assert {(r["entity_person_id"], r["source"]) for r in links.family_membership(detail, master, alias).collect()} == {("H", "crd"), ("W1", "crd"), ("W2", "crd"), ("C", "crd")}


# a couple with two children; the son married, with a child; the wife's parents
PEOPLE = [("gf", "M"), ("gm", "F"), ("son", "M"), ("dau", "F"), ("wife", "F"), ("kid", None), ("wf", "M"), ("wm", "F")]
PARENTS = [("gf", "son"), ("gm", "son"), ("gf", "dau"), ("gm", "dau"), ("son", "kid"), ("wife", "kid"), ("wf", "wife"), ("wm", "wife")]
SPOUSES = [("gf", "gm"), ("son", "wife"), ("wf", "wm")]


def family(spark):
    persons = spark.createDataFrame([(i, i.upper() if i != "dau" else None, s) for i, s in PEOPLE], "id string, label string, sex string")
    parents = spark.createDataFrame([(p, c) for p, c in PARENTS], "parent_entity_person_id string, child_entity_person_id string")
    spouses = spark.createDataFrame(SPOUSES, "husband_entity_person_id string, wife_entity_person_id string")
    return persons, parents, spouses


def test_ego_network(spark):
    persons, parents, spouses = family(spark)
    nodes, edges = ego.citizen_ego(persons, parents, spouses, depth=2)
    of = {(r["ego"], r["id"]): (r["label"], r["kin"], r["cluster"]) for r in nodes.collect()}
    assert of["kid", "kid"] == ("KID", "self", None)
    assert of["kid", "gf"] == ("GF", "grandfather", "ancestors")
    assert ("kid", "dau") not in of  # an aunt is three generations of steps away
    assert of["son", "wf"] == ("WF", "father", None)  # a spouse's father is a father
    assert of["dau", "wife"] == ("WIFE", "sister-in-law", "inlaws")
    assert of["son", "dau"] == ("dau", "sister", None)
    assert all(v[1] == "self" for (e, i), v in of.items() if e == i)
    found = edges.collect()
    assert all((e["ego"], e[k]) in of for e in found for k in ("source", "target"))
    kinds = {(e["source"], e["target"], e["type"]) for e in found if e["ego"] == "kid"}
    assert ("kid", "son", "CHILD_OF") in kinds and ("son", "wife", "SPOUSE_OF") in kinds and ("wife", "son", "SPOUSE_OF") in kinds


def test_ego_of_unknown_person_and_depth_bounds(spark):
    persons, parents, spouses = family(spark)
    nodes, _ = ego.citizen_ego(persons, parents, spouses, ids=spark.createDataFrame([("nobody",), ("kid",)], "id string"), depth=1)
    assert {r["ego"] for r in nodes.collect()} == {"kid"}
    with pytest.raises(ValueError):
        ego.citizen_ego(persons, parents, spouses, depth=6)


def child_of(spark):
    return spark.createDataFrame([(c, p) for p, c in PARENTS], "child string, parent string")


def test_common_ancestors(spark):
    persons, _, _ = family(spark)
    pairs = spark.createDataFrame([("kid", "dau"), ("dau", "kid"), ("kid", "kid"), ("gf", "wf")], "a string, b string")
    rows = graph.common_ancestors(pairs, child_of(spark), persons).collect()
    got = {(r["a"], r["b"], r["ancestor_id"]): (r["da"], r["db"]) for r in rows}
    assert got["kid", "dau", "gf"] == (2, 1)
    assert got["kid", "kid", "kid"] == (0, 0)
    assert {k[2]: v for k, v in got.items() if k[:2] == ("kid", "dau")} == {k[2]: v[::-1] for k, v in got.items() if k[:2] == ("dau", "kid")}
    assert not any(k[:2] == ("gf", "wf") for k in got)


def test_common_ancestor_queries_have_no_bound_of_depth(spark):
    from types import SimpleNamespace

    from kinweave.plans import queries

    up = [(f"a{i}", f"a{i + 1}") for i in range(12)] + [(f"b{i}", f"b{i + 1}") for i in range(13)] + [("a12", "top"), ("b13", "top"), ("top", "over"), ("over", "top")]
    c = spark.createDataFrame(up, "child string, parent string")
    people = c.select(F.col("child").alias("id"), F.col("child").alias("label")).distinct()
    r = SimpleNamespace(pairs=spark.createDataFrame([("a0", "b0")], "a string, b string"), child_of=c, people=people)
    rows = queries.FUNCTIONS["lca_pairs"](r).collect()
    assert sorted((x["ancestor_id"], x["da"], x["db"]) for x in rows) == [("over", 14, 15), ("top", 13, 14)]
    assert [x["ancestor_id"] for x in queries.FUNCTIONS["lca_topk"](r).collect()] == ["top"]


def test_five_tiers_and_layout(spark):
    persons, _, _ = family(spark)
    s = spark.createDataFrame(SPOUSES, "a string, b string")
    c = child_of(spark)
    nodes = graph.five_tier_nodes(persons.select("id"), persons, c, s)
    kin = {(r["ego"], r["id"]): r["kin"] for r in nodes.collect()}
    assert kin["kid", "gf"] == "paternal grandfather" and kin["kid", "wm"] == "maternal grandmother"
    assert kin["gf", "kid"] == "grandchild" and kin["gf", "gm"] == "wife" and kin["dau", "son"] == "brother"
    one = graph.five_tier_nodes(persons.select("id"), persons, c, s, depth=1)
    assert {r["id"] for r in one.where("ego = 'kid'").collect()} == {"kid"}
    place = {(r["ego"], r["id"]): (r["x"], r["y"]) for r in layout.five_tier_layout(nodes, graph.induced_edges(nodes, c, s)).collect()}
    assert place["son", "son"] == (0.0, 0.0) and place["son", "wife"] == (3.2, 0.0) and place["son", "kid"] == (1.6, 1.8)


def test_sponsorship_network(spark):
    residents = spark.createDataFrame([("r1", "2"), ("r2", "3"), ("r3", "4")], "entity_person_id string, relationship_code string")
    link = "sponsor_entity_person_id string, sponsored_entity_person_id string, relation_to_sponsor string, relationship_code string, sponsor_type string"
    links_ = spark.createDataFrame([("c1", "r1", "x", "2", "citizen"), ("c1", "r2", "y", "3", "citizen"), ("r0", "r1", "z", "2", "resident"), ("r1", "r3", "w", "4", "resident")], link)
    groups = spark.createDataFrame([("r1", "SPON:1"), ("r2", "SPON:1")], "entity_person_id string, family_group_id string")
    names = spark.createDataFrame([("c1", "Citizen", "M")], "id string, label string, sex string")
    nodes, edges = ego.resident_ego(residents, links_, groups, names)
    got = {r["id"]: (r["role"], r["relation"], r["cluster"]) for r in nodes.where("ego = 'r1'").collect()}
    assert got["r1"] == ("self", None, "ego")
    assert got["c1"] == ("citizen_sponsor", "x", "sponsors")
    assert got["r3"] == ("sponsored_resident", "daughter", "sponsored")
    assert got["r2"] == ("family_member", "son", "family")
    assert {(r["source"], r["target"], r["type"]) for r in edges.where("ego = 'r1'").collect()} == {("r1", "c1", "SPONSORED_BY"), ("r3", "r1", "SPONSORED_BY"), ("r1", "r2", "SAME_FAMILY_GROUP")}


def test_payload_goes_to_json_and_back(spark):
    persons, parents, spouses = family(spark)
    nodes, edges = ego.citizen_ego(persons, parents, spouses, depth=2)
    cache = payload.payloads(nodes, edges, "2024-01-01 00:00:00")
    n, e = payload.explode_payloads(cache)
    key = lambda df: {tuple(r) for r in df.collect()}
    assert key(n) == key(nodes) and key(e) == key(edges)


def test_upsert_is_idempotent(spark, tmp_path):
    path = f"file://{tmp_path}/cache"
    a = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    b = spark.createDataFrame([("2", "c"), ("3", "d")], "k string, v string")
    upsert.upsert_table(spark, path, a, ["k"])
    for _ in range(2):
        upsert.upsert_table(spark, path, b, ["k"])
        assert {tuple(r) for r in upsert.read_table(spark, path).collect()} == {("1", "a"), ("2", "c"), ("3", "d")}
    assert not upsert.repeated_keys(upsert.read_table(spark, path), ["k"]).collect()
    upsert.expire_versions(spark, path, keep=1)
    assert upsert.read_table(spark, path).count() == 3 and not (tmp_path / "cache" / "v0").exists()


def test_edges_need_both_ends(spark):
    e = spark.createDataFrame([("a", "b"), ("a", "x"), ("a", "b")], "src string, dst string")
    v = spark.createDataFrame([("a",), ("b",)], "id string")
    assert [tuple(r) for r in upsert.loadable_edges(e, v).collect()] == [("a", "b")]


def test_limits():
    with pytest.raises(ValueError):
        graph.check_depth(0)
    with pytest.raises(ValueError):
        graph.common_ancestors(None, None, None, limit=21)


def test_fixed_ego_child_edges_run_to_the_parent(spark):
    persons, _, _ = family(spark)
    _, edges = graph.fixed_ego(persons, child_of(spark), spark.createDataFrame(SPOUSES, "a string, b string"))
    got = {(r["source"], r["target"], r["type"]) for r in edges.where("ego = 'kid'").collect()}
    assert ("kid", "son", "CHILD_OF") in got and ("__cluster_grandparents__", "son", "ancestor") in got
    assert not edges.where(F.col("source").isNull() | F.col("target").isNull()).count()


def test_stream_of_changes_refreshes_the_affected(spark, tmp_path):
    from kinweave.streaming.refresh import affected, refresh

    persons, parents, spouses = family(spark)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.txt").write_text("dau\n")
    changes = spark.readStream.text(str(tmp_path / "in")).withColumnRenamed("value", "id")

    def build(ids):
        return payload.payloads(*ego.citizen_ego(persons, parents, spouses, ids=ids, depth=1), "2024-01-01 00:00:00", depth=1)

    path = f"file://{tmp_path}/cache"
    query = refresh(changes, build, lambda ids: affected(ids, parents, spouses, depth=1), path, str(tmp_path / "check"))
    query.awaitTermination()
    assert {r["entity_person_id"] for r in keyed.read(spark, path).collect()} == {"dau", "gf", "gm"}
