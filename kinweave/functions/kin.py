"""Kinship terms from path signatures over U (to a parent), D (to a child) and S (to a spouse)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col

#: Fixed values: (ups, downs) -> terms for M, F and unknown sex.
TERMS_EN = {
    (1, 0): ("father", "mother", "parent"),
    (2, 0): ("grandfather", "grandmother", "grandparent"),
    (0, 1): ("son", "daughter", "child"),
    (0, 2): ("grandson", "granddaughter", "grandchild"),
    (1, 1): ("brother", "sister", "sibling"),
    (1, 2): ("nephew", "niece", "nibling"),
    (2, 1): ("uncle", "aunt", "aunt/uncle"),
}
TERMS_AR = {
    (1, 0): ("الأب", "الأم", "الوالد"),
    (2, 0): ("الجد", "الجدة", "الجد/الجدة"),
    (0, 1): ("الابن", "الابنة", "الابن/الابنة"),
    (0, 2): ("الحفيد", "الحفيدة", "الحفيد/الحفيدة"),
    (1, 1): ("الأخ", "الأخت", "الأخ/الأخت"),
    (1, 2): ("ابن الأخ/الأخت", "ابنة الأخ/الأخت", "ابنة الأخ/الأخت"),
    (2, 1): ("العم/الخال", "العمة/الخالة", "العمة/الخالة"),
}
ORDINALS = ("first", "second", "third", "fourth")
SELF_AR, SPOUSE_AR, RELATIVE_AR, INLAW_AR = "أنا", "زوج/زوجة", "قريب", " (نسَب)"
COUSIN_AR = ("ابن العم/الخال", "ابنة العم/الخالة")


def steps(path, letter: str) -> Column:
    p = col(path)
    return F.length(p) - F.length(F.regexp_replace(p, letter, ""))


def _by_sex(sex: Column, terms: tuple[str, str, str]) -> Column:
    return F.when(sex == "M", terms[0]).when(sex == "F", terms[1]).otherwise(terms[2])


def _blood(u: Column, d: Column, sex: Column, terms: dict, cousin: Column, else_: str) -> Column:
    """The term for ups and downs alone; every pair has one."""
    out = F.when((u == 0) & (d == 0), None)
    for (a, b), names in terms.items():
        out = out.when((u == a) & (d == b), _by_sex(sex, names))
    return out.when((u >= 2) & (d >= 2), cousin).otherwise(else_)


def kin_en(path, sex) -> Column:
    """English term.  A spouse's parent is a parent: up-one paths come before in-laws."""
    u, d, s = (steps(path, x) for x in "UDS")
    degree = F.least(u, d) - 1
    away = F.abs(u - d)
    nth = F.coalesce(F.try_element_at(F.array(*map(F.lit, ORDINALS)), degree.cast("int")), F.concat(degree.cast("string"), F.lit("th")))
    removed = F.when(away == 0, "").when(away == 1, " once removed").when(away == 2, " twice removed").otherwise(F.concat(F.lit(" "), away.cast("string"), F.lit(" times removed")))
    term = _blood(u, d, col(sex), TERMS_EN, F.concat(nth, F.lit(" cousin"), removed), "relative")
    early = ((u == 1) & (d == 0)) | ((u == 2) & (d == 0)) | ((u == 0) & d.isin(1, 2)) | ((u == 1) & (d == 2)) | ((u == 2) & (d == 1))
    return F.when((u == 0) & (d == 0) & (s == 0), "self").when((u == 0) & (d == 0), "spouse").when((s == 0) | early, term).otherwise(F.concat(term, F.lit("-in-law")))


def kin_ar(path, sex) -> Column:
    """Arabic term, by the same conditions and without cousin degrees."""
    u, d, s = (steps(path, x) for x in "UDS")
    sx = col(sex)
    term = _blood(u, d, sx, TERMS_AR, F.when(sx == "M", COUSIN_AR[0]).otherwise(COUSIN_AR[1]), RELATIVE_AR)
    early = ((u == 1) & (d == 0)) | ((u == 2) & (d == 0)) | ((u == 0) & d.isin(1, 2)) | ((u == 1) & (d == 2)) | ((u == 2) & (d == 1))
    return F.when((u == 0) & (d == 0) & (s == 0), SELF_AR).when((u == 0) & (d == 0), SPOUSE_AR).when((s == 0) | early, term).otherwise(F.concat(term, F.lit(INLAW_AR)))


def kin(path, sex, lang: str = "en") -> Column:
    if lang not in ("en", "ar"):
        raise ValueError("lang must be en or ar")
    return kin_en(path, sex) if lang == "en" else kin_ar(path, sex)


def kin_cluster(term) -> Column:
    """inlaws, ancestors, descendants, or null."""
    t = col(term)
    has = lambda *words: F.lit(False) if not words else t.rlike("|".join(words))
    return (
        F.when(has("-in-law", "نسَب") | t.isin("spouse", SPOUSE_AR), "inlaws")
        .when(has("grandfather", "grandmother", "grandparent", "الجد"), "ancestors")
        .when(has("grandson", "granddaughter", "grandchild", "الحفيد"), "descendants")
    )
