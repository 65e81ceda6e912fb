"""Name search over trigrams, and the clusters of the five-tier layout."""

import pytest

from kinweave.functions.text import contains_ignoring_case
from kinweave.operators import layout, search


@pytest.fixture(scope="module")
def names(spark):
    rows = [(f"p{i:03d}", f"Person #{i:05d}") for i in range(300)]
    rows += [("a", "Zoë de la Cruz"), ("b", "محمد بن علي"), ("c", None), ("d", ""), ("e", "Al"), ("f", "aaaaaa"), ("g", "zoë"), ("h", "x" * 5000)]
    people = spark.createDataFrame(rows, "id string, label string")
    counts = search.gram_counts(people)
    return people, counts, search.postings(people, counts)


TERMS = ["person", "PERSON #00123", "00299", "#0", "ZOË", "zoë de", "بن علي", "محم", "aaa", "aaaaaaa", "al", "", "nobody", "son#", "xxxx", "00 1", "person #00123 ", "%", "_"]


@pytest.mark.parametrize("term", TERMS)
def test_a_search_gives_the_rows_of_the_scan(names, term):
    people, counts, index = names
    want = sorted(r["id"] for r in people.where(contains_ignoring_case("label", term)).collect())
    assert sorted(r["id"] for r in search.named(counts, index, people, term).collect()) == want


def test_many_candidates_are_joined(names, monkeypatch):
    people, counts, index = names
    monkeypatch.setattr(search.lookup, "NEAR", 0)
    assert sorted(r["id"] for r in search.named(counts, index, people, "00123").collect()) == ["p123"]


def test_common_trigrams_have_no_postings(names):
    _, counts, index = names
    n = {r["gram"]: r["n"] for r in counts.collect()}
    assert n[""] == 308 and n["per"] == 300 and n["aaa"] == 1
    held = {r["gram"] for r in index.select("gram").distinct().collect()}
    assert held == {g for g, k in n.items() if g and k * search.COMMON <= n[""]}


def test_an_empty_table_is_searched(spark):
    people = spark.createDataFrame([], "id string, label string")
    counts = search.gram_counts(people)
    assert [tuple(r) for r in counts.collect()] == [("", 0)]
    assert search.named(counts, search.postings(people, counts), people, "abc").count() == 0


def test_clusters(spark):
    kin = {"me": "self", "w1": "wife", "w2": "wife", "f": "father", "m": "mother", "k": "son", "ff": "paternal grandfather", "fm": "paternal grandmother", "mf": "maternal grandfather", "g1": "grandson", "g2": "granddaughter", "wf": "in-law", "b": "brother"}
    nodes = spark.createDataFrame([("me", i, k) for i, k in kin.items()] + [("alone", "alone", "self")], "ego string, id string, kin string")
    up = [("me", "f"), ("me", "m"), ("b", "f"), ("f", "ff"), ("f", "fm"), ("m", "mf"), ("w1", "wf"), ("w2", "f"), ("k", "me"), ("k", "w1"), ("g1", "k"), ("g2", "k")]
    edges = spark.createDataFrame([("me", a, b, "CHILD_OF") for a, b in up] + [("me", "me", "w1", "SPOUSE_OF")], "ego string, source string, target string, type string")
    members = layout.cluster_members(nodes, edges)
    got = sorted((r["cluster"], r["id"]) for r in members.collect())
    # the father is a parent of a wife too, and stays out of the in-laws
    assert got == [("grandchildren", "g1"), ("grandchildren", "g2"), ("grandparents_f", "ff"), ("grandparents_f", "fm"), ("grandparents_m", "mf"), ("inlaws", "wf")]
    at = {r["id"]: (r["n"], round(r["x"], 6), r["y"]) for r in layout.clusters(nodes, members).collect()}
    assert at == {"__cluster_grandchildren__": (2, 0.0, 3.6), "__cluster_grandparents_f__": (2, -2.88, -3.6), "__cluster_grandparents_m__": (1, 2.88, -3.6), "__cluster_inlaws__": (1, 11.2, -1.8)}
    ends = sorted((r["type"], r["target"]) for r in layout.cluster_edges(nodes, members).collect())
    assert ends == [("DESCENDANT", "k"), ("IN_LAW", "w1"), ("IN_LAW", "w2"), ("MATERNAL_GP", "m"), ("PATERNAL_GP", "f")]
