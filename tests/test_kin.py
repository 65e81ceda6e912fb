"""Kin terms, one case for each rule, and the labels of codes."""

import pytest
from pyspark.sql import functions as F

from kinweave.functions import kin, text

CASES = [
    ("", "M", "self"),
    ("S", "F", "spouse"),
    ("SS", "M", "spouse"),
    ("U", "M", "father"),
    ("U", "F", "mother"),
    ("U", None, "parent"),
    ("SU", "M", "father"),
    ("UU", "M", "grandfather"),
    ("UU", "F", "grandmother"),
    ("D", "M", "son"),
    ("D", "F", "daughter"),
    ("DD", "F", "granddaughter"),
    ("UD", "M", "brother"),
    ("UD", None, "sibling"),
    ("UDD", "M", "nephew"),
    ("UDD", "F", "niece"),
    ("UUD", "M", "uncle"),
    ("UUD", None, "aunt/uncle"),
    ("UUDD", "M", "first cousin"),
    ("UUDDD", "F", "first cousin once removed"),
    ("UUUDDD", "F", "second cousin"),
    ("UUUUDD", "M", "first cousin twice removed"),
    ("UUUUUDD", "M", "first cousin 3 times removed"),
    ("UUUUUUDDDDDD", "M", "5th cousin"),
    ("UDS", "F", "sister-in-law"),
    ("SUUDD", "M", "first cousin-in-law"),
    ("SUUU", "M", "relative-in-law"),
    ("UUU", "M", "relative"),
    ("DDD", None, "relative"),
]


def test_english_terms(spark):
    df = spark.createDataFrame(CASES, "path string, sex string, want string")
    bad = df.withColumn("got", kin.kin_en("path", "sex")).where("got <> want").collect()
    assert not bad


@pytest.mark.parametrize(
    "path,sex,want",
    [("", "M", "أنا"), ("S", "F", "زوج/زوجة"), ("U", "F", "الأم"), ("DD", "M", "الحفيد"), ("UUDD", "F", "ابنة العم/الخالة"), ("UDS", "M", "الأخ (نسَب)"), ("UUU", "M", "قريب")],
)
def test_arabic_terms(spark, path, sex, want):
    df = spark.createDataFrame([(path, sex)], "path string, sex string")
    assert df.select(kin.kin_ar("path", "sex")).first()[0] == want


def test_clusters(spark):
    rows = [("spouse", "inlaws"), ("sister-in-law", "inlaws"), ("grandmother", "ancestors"), ("grandson", "descendants"), ("father", None), ("الحفيد", "descendants"), ("الجد", "ancestors")]
    df = spark.createDataFrame(rows, "kin string, want string")
    assert not df.where(~kin.kin_cluster("kin").eqNullSafe(F.col("want"))).collect()


def test_unknown_language():
    with pytest.raises(ValueError):
        kin.kin("p", "s", "fr")
    with pytest.raises(ValueError):
        text.relation_label("c", "fr")


def test_relation_labels(spark):
    df = spark.createDataFrame([("2",), ("9",), ("77",), (None,)], "c string")
    assert [r[0] for r in df.select(text.relation_label("c")).collect()] == ["wife", "other_family_member", "family_member", "family_member"]


def test_normalisers(spark):
    df = spark.createDataFrame([(" 784-1 2", "2020-02-30", " Ab ", "x")], "nid string, dob string, name string, sex string")
    r = df.select(text.id_norm("nid"), text.date_norm("dob"), text.name_norm("name"), text.sex_of("sex"), text.first_words(F.lit(" a  b c"), 2)).first()
    assert tuple(r) == ("78412", None, "ab", None, "a b")
    assert spark.range(1).select(text.id_norm(F.lit(" - "))).first()[0] is None
