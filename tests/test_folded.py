"""Networks in numbers: walked without shuffles, kept once for all, and the same documents."""

from pyspark.sql import functions as F
from test_walks import rows, steps_of

from kinweave.operators import ego, payload, tables


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def links_of(steps):
    parents = steps.where("kind = 'U'").select(F.col("from").alias("child_entity_person_id"), F.col("to").alias("parent_entity_person_id"))
    return parents, steps.where("kind = 'S'").select(F.col("from").alias("husband_entity_person_id"), F.col("to").alias("wife_entity_person_id"))


def test_a_walk_deals_out_egos_and_nothing_else(spark, monkeypatch):
    persons, steps = steps_of(spark, 2)
    egos = persons.select("id")
    walk = lambda: ego._reached(egos, tables.settle(steps, "walk"), 3, None, once=True)[0].withColumn("label", F.col("label").cast("string"))
    sent = walk()
    assert exchanges(sent) == 1  # before: every generation of every network
    monkeypatch.setattr(ego, "SENT", 0)
    assert rows(sent) == rows(walk())


def test_edges_of_networks_meet_steps_where_they_are(spark, monkeypatch):
    persons, steps = steps_of(spark, 3)
    steps = tables.settle(steps, "walk")
    reach, _ = ego._reached(persons.select("id"), steps, 2, None)
    found, places = ego._walked_once(reach, steps, 2), ego._walked_once(reach, steps, 2, places=True)
    assert exchanges(found) == 0 and exchanges(places) == 0  # before: ends of the last generation were
    want = rows(ego._walked(reach, steps, 2))
    assert rows(found) == want
    monkeypatch.setattr(ego, "WIDE", 0)
    assert rows(ego._walked_once(reach, steps, 2)) == want
    assert rows(ego._walked_once(reach, steps, 2, places=True)) == rows(places)


def test_networks_in_numbers_give_the_documents(spark):
    persons, steps = steps_of(spark, 4)
    parents, spouses = links_of(steps)
    at = "2024-01-01 00:00:00"
    want = payload.payloads(*ego.citizen_ego(persons, parents, spouses, depth=2), at, depth=2)
    kept, names, terms = ego.folded_citizen_ego(persons, parents, spouses, depth=2, parts=3)
    assert not any("string" in t for _, t in kept.dtypes)
    named = ego.named_networks(tables.bucketed(kept, "kept", "ego", 3), names, terms)
    assert exchanges(named) == 0  # before: texts of networks moved twice
    assert rows(payload.documents(named, at, depth=2)) == rows(want)


def test_documents_by_key_are_read_without_a_shuffle(spark):
    doc = '{"root":"%s","nodes":[{"id":"b"},{"id":"a"},{"id":"b"}],"edges":[{"source":"a","target":"b","type":"child_of"},{"source":"a","target":"b","type":"CHILD_OF"},{"source":"a","target":"b","type":"child_of"},{"source":"a","type":"x"},{"source":"b","target":"a","type":"x"}]}'
    texts = [("a", doc % "a"), ("b", doc % "b"), ("c", '{"root":"c","nodes":[],"edges":[]}'), ("d", '{"root":"d","nodes":[{"id":"d"}]}')]
    cache = spark.createDataFrame(texts, "entity_person_id string, ego_json string")
    nodes, edges = payload.explode_payloads(cache)
    near = payload.explode_payloads(cache, once=True)
    assert [rows(df) for df in near] == [rows(nodes), rows(edges)]
    assert rows(payload.adjacency_of(cache)) == rows(payload.adjacency(edges))
    assert rows(payload.sizes(cache)) == [("a", 2, 3), ("b", 2, 3), ("d", 1, 0)]
    assert sum(map(exchanges, (*near, payload.adjacency_of(cache), payload.sizes(cache)))) == 0
