"""Person numbers that are given twice: both registrations count, as in the SQL."""

from test_walks import rows

from kinweave.operators import graph, search
from kinweave.plans import stages


def test_registrations_of_one_number_are_no_error():
    by = {s.name: s.table for s in stages.STAGES}
    assert by["people"].key == () and by["person_index"].key == ()  # before: "people: id is not unique"


def test_ancestors_of_two_registrations_are_ranked_as_rows(spark):
    child_of = spark.createDataFrame([("b", "a"), ("c", "a")], "child string, parent string")
    persons = spark.createDataFrame([("a", "A"), ("a", "a"), ("b", "B"), ("c", "C")], "id string, label string")
    asked = spark.createDataFrame([("b", "c")], "a string, b string")
    for bulk in (True, False):
        for limit, want in ((1, ["A"]), (2, ["A", "a"])):
            got = graph.common_ancestors(asked, child_of, persons, limit, None, bulk=bulk).orderBy("rank").collect()
            assert [(r.full_name, r.rank) for r in got] == [(n, i + 1) for i, n in enumerate(want)]


def test_a_tree_shows_a_person_once(spark):
    persons = spark.createDataFrame([("a", "A", "M"), ("a", "A", "M"), ("b", "B", "F")], "id string, label string, sex string")
    child_of = spark.createDataFrame([("b", "a")], "child string, parent string")
    nodes = graph.five_tier_nodes(persons.select("id"), persons, child_of, spark.createDataFrame([], "a string, b string"))
    assert rows(nodes.select("ego", "id")) == [("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")]


def test_trigrams_of_an_id_are_given_once(spark):
    names = spark.createDataFrame([("a", "abcd"), ("a", "ABCD"), ("a", "bcd"), ("b", None), ("c", "ab")], "id string, label string")
    assert rows(search._grams(names)) == [("a", "abc"), ("a", "bcd")]
    assert rows(search.gram_counts(names)) == [("", 5), ("abc", 1), ("bcd", 1)]
