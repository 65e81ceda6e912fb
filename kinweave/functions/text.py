"""Normalisers and small column functions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def name_norm(c) -> Column:
    return F.lower(F.trim(col(c)))


def id_norm(c) -> Column:
    """Without blanks and hyphens; nothing left is null, so that blank ids do not cluster people."""
    return F.nullif(F.regexp_replace(col(c), r"[\s\-]+", ""), F.lit(""))


def digits(c) -> Column:
    return F.nullif(F.regexp_replace(col(c), r"\D+", ""), F.lit(""))


def date_norm(c) -> Column:
    """A date, or null for text that is none."""
    return F.try_to_date(col(c).cast("string"))


def sex_of(c) -> Column:
    code = col(c).try_cast("int")
    return F.when(code == 1, "M").when(code == 2, "F")


def sex_known(c) -> Column:
    return F.when(col(c).isin("M", "F"), col(c)).otherwise("")


def completeness(columns: list[str], blank_counts: bool = False) -> Column:
    """How many of the columns hold a value; blank text is none unless ``blank_counts``."""
    has = lambda c: F.col(c).isNotNull() if blank_counts else F.col(c).isNotNull() & (F.col(c).cast("string") != "")
    return reduce(lambda a, b: a + b, (F.when(has(c), 1).otherwise(0) for c in columns))


def first_words(c, n: int) -> Column:
    return F.array_join(F.slice(F.split(F.trim(col(c)), r"\s+"), 1, n), " ")


def contains_ignoring_case(c, term: str) -> Column:
    return F.lower(col(c)).contains(term.lower())


#: Codes of the relation to a sponsor.
RELATIONS_EN = {"2": "wife", "3": "son", "4": "daughter", "5": "brother", "6": "sister", "7": "father", "8": "mother", "9": "other_family_member"}
RELATIONS_AR = {"2": "زوجة", "3": "ابن", "4": "ابنة", "5": "أخ", "6": "أخت", "7": "أب", "8": "أم", "9": "فرد من العائلة"}
RELATION_ELSE = {"en": "family_member", "ar": "فرد من العائلة"}


def relation_label(code, lang: str = "en") -> Column:
    if lang not in RELATION_ELSE:
        raise ValueError("lang must be en or ar")
    labels = RELATIONS_EN if lang == "en" else RELATIONS_AR
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(code).cast("string")), F.lit(RELATION_ELSE[lang]))


#: Labels of edge types.
EDGE_LABELS = {"CHILD_OF": "Child of", "SPOUSE_OF": "Spouse of", "SPONSORED_BY": "Sponsored by", "SAME_FAMILY_GROUP": "Same family group"}


def edge_label(kind) -> Column:
    pairs = [F.lit(x) for kv in EDGE_LABELS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), F.upper(col(kind))), col(kind))
