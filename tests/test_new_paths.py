"""Walks of few egos, doubled ancestors, definitions of tables, and the rules of upserts."""

import random

import pytest

from kinweave.operators import ego, graph, upsert
from kinweave.operators.schema import Table, field
from kinweave.sources import bronze


def chain(spark):
    """Four generations, and a marriage chain of six persons at one of them."""
    persons = [f"p{i}" for i in range(5)] + [f"m{i}" for i in range(6)]
    df = spark.createDataFrame([(p, p, "M") for p in persons], "id string, label string, sex string")
    parents = spark.createDataFrame([(f"p{i}", f"p{i + 1}") for i in range(4)], "parent_entity_person_id string, child_entity_person_id string")
    spouses = spark.createDataFrame([("p2", "m0")] + [(f"m{i}", f"m{i + 1}") for i in range(5)], "husband_entity_person_id string, wife_entity_person_id string")
    return df, parents, spouses


def test_a_network_of_one_ego_equals_that_among_all(spark):
    persons, parents, spouses = chain(spark)
    every = ego.citizen_ego(persons, parents, spouses, depth=2)
    one = ego.citizen_ego(persons, parents, spouses, ids=spark.createDataFrame([("p4",), ("absent",)], "id string"), depth=2)
    for a, b in zip(every, one):
        assert sorted(map(tuple, a.where("ego = 'p4'").collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert {r["id"] for r in one[0].collect()} == {"p4", "p3", "p2", *(f"m{i}" for i in range(6))}


def test_doubled_ancestors_equal_stepwise_ones(spark):
    rng = random.Random(3)
    edges = sorted({(f"{i:02d}", f"{rng.randrange(i):02d}") for i in range(1, 40) for _ in range(2)})
    child_of = spark.createDataFrame(edges, "child string, parent string")
    ids = child_of.selectExpr("child as id").union(child_of.selectExpr("parent as id")).distinct()
    for depth in (None, 3):
        assert {tuple(r) for r in graph.all_ancestors(child_of, depth).collect()} == {tuple(r) for r in graph.closure(ids, child_of, depth).collect()}


def test_merge_of_null_keys_is_repeatable(spark):
    old = spark.createDataFrame([(None, "a"), ("1", "b")], "k string, v string")
    new = spark.createDataFrame([(None, "c")], "k string, v string")
    once = upsert.merge(old, new, ["k"])
    assert sorted(map(tuple, upsert.merge(once, new, ["k"]).collect()), key=str) == sorted([(None, "c"), ("1", "b")], key=str)


def test_upserts_refuse_repeated_keys_and_other_writers(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = spark.createDataFrame([("1", "a"), ("2", "b")], "k string, v string")
    upsert.upsert_table(spark, path, rows, ["k"])
    with pytest.raises(ValueError, match="repeats"):
        upsert.upsert_table(spark, path, rows.union(rows), ["k"])
    (tmp_path / "t" / "_writer_1").write_text("")
    with pytest.raises(RuntimeError, match="being written"):
        upsert.upsert_table(spark, path, rows, ["k"])
    (tmp_path / "t" / "_writer_1").unlink()
    upsert.delete_keys(spark, path, rows.where("k = '1'"), ["k"])
    assert [tuple(r) for r in upsert.read_table(spark, path).collect()] == [("2", "b")]


def test_a_table_names_the_source_that_is_missing(spark):
    t = Table("things", (field("id", required=True), field("name", "a", "b")))
    df = spark.createDataFrame([("1", None, "x"), (None, "y", "z")], "id string, a string, b string")
    assert [tuple(r) for r in t.of(df).collect()] == [("1", "x")]
    with pytest.raises(ValueError, match="things: no column b"):
        t.of(df.drop("b"))


def test_an_absent_file_is_an_empty_table(spark, tmp_path):
    for path in (f"{tmp_path}/absent.csv", f"file://{tmp_path}/absent.csv"):
        assert bronze.read_optional_csv(spark, path, bronze.DETAIL_SCHEMA).collect() == []
