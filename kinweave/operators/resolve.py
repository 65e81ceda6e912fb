"""Entity resolution: identities, golden records and the map of person numbers, from the definitions of the silver tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import completeness, date_norm, digits, id_norm, name_norm, sex_of
from .schema import Identity, Rule, Table, best_row, constant, field

# Columns whose values count for completeness, key prefixes, confidences, names of sources.
CITIZEN_VALUES = ["spm_full_aname", "spm_full_ename", "spm_gender", "spm_dob", "spm_national_id", "spm_place_of_birth_eng", "nat_code_curr_nat", "emi_code", "cit_code"]
BASIC_VALUES = ["full_name", "sex", "dob", "national_id", "passport", "mobile", "email", "spm_person_no", "updated_at"]

CITIZEN = Identity(
    lambda: {
        "name_ar_norm": name_norm("spm_full_aname"),
        "name_en_norm": name_norm("spm_full_ename"),
        "dob_norm": date_norm("spm_dob"),
        "national_id_norm": id_norm("spm_national_id"),
        "gender_norm": F.upper(F.trim(F.col("spm_gender").cast("string"))),
    },
    (
        Rule("NID", ("national_id_norm", "dob_norm"), ("national_id_norm", "dob_norm"), 1.0),
        Rule("NAME", ("name_ar_norm", "dob_norm", "gender_norm"), ("name_ar_norm", "dob_norm", "gender_norm"), 0.9),
        Rule(None, ("spm_person_no",), (), 0.8),
    ),
)
BASIC = Identity(
    lambda: {
        "name_norm": F.lower("full_name"),
        "dob_norm": date_norm("dob"),
        "national_id_norm": F.nullif(F.regexp_replace("national_id", r"\s+", ""), F.lit("")),
        "passport_norm": F.upper("passport"),
        "mobile_norm": digits("mobile"),
        "email_norm": F.lower("email"),
    },
    (
        Rule("NID", ("national_id_norm", "name_norm", "dob_norm"), ("national_id_norm",), 0.8),
        Rule("PASS", ("passport_norm", "name_norm", "dob_norm"), ("passport_norm",), 0.8),
        Rule(None, ("spm_person_no",), (), 1.0),
    ),
)
RESIDENT = Identity(
    lambda: {"passport_norm": F.upper(id_norm("passport_number")), "dob_norm": date_norm("date_of_birth"), "name_norm": name_norm("english_full_name")},
    (
        Rule("SPM", ("spm_person_no",), ("spm_person_no",), 1.0),
        Rule("PASS", ("passport_norm", "dob_norm"), ("passport_norm", "dob_norm"), 0.9),
        Rule("REQ", ("id", "sponsor_number"), (), 0.9),
    ),
)

_ENTITY = field("entity_person_id", required=True)
_NUMBER = field("primary_spm_person_no", "spm_person_no")

#: Silver tables: the columns of an entity and the source columns that they come from.
CITIZENS = Table(
    "citizens",
    (
        _ENTITY,
        _NUMBER,
        field("full_name_ar", "spm_full_aname"),
        field("full_name_en", "spm_full_ename"),
        field("full_name", "spm_full_ename", "spm_full_aname"),
        field("sex", "spm_gender", make=sex_of),
        field("dob", "spm_dob"),
        field("national_id", "spm_national_id"),
        field("place_of_birth", "spm_place_of_birth_eng"),
        field("nationality_code", "nat_code_curr_nat"),
        field("emirate_code", "emi_code"),
        field("city_code", "cit_code"),
        field("updated_at"),
        field("completeness"),
        constant("person_type", "citizen"),
    ),
)
RESIDENTS = Table(
    "residents",
    (
        _ENTITY,
        _NUMBER,
        field("full_name_ar", "arabic_full_name"),
        field("full_name_en", "english_full_name"),
        field("full_name", "english_full_name", "arabic_full_name"),
        field("sex", "lookup_gender_id", make=sex_of),
        field("dob", "date_of_birth"),
        field("passport", "passport_number"),
        field("mobile", "local_mobile_number"),
        field("email", "email_address"),
        field("nationality_code", "lookup_curr_nationality_id"),
        field("sponsor_number"),
        field("relation_to_sponsor", "person_to_sponsor_relation"),
        field("relationship_code", "lookup_family_relationship_id"),
        field("residency_seq", "rma_seqno"),
        field("residency_year", "rma_year"),
        field("updated_at"),
        constant("person_type", "resident"),
    ),
)
_CONTACT = tuple(field(c) for c in ("passport", "mobile", "email", "updated_at"))
#: Persons of the one-population pipeline, and their entities.
BASIC_PERSONS = Table(
    "basic persons",
    (field("spm_person_no"), field("full_name", "spm_full_ename"), field("sex", "spm_gender", make=sex_of), field("dob", "spm_dob"), field("national_id", "spm_national_id"), *_CONTACT),
)
BASIC_ENTITIES = Table("basic entities", (_ENTITY, _NUMBER, *(field(c) for c in ("full_name", "sex", "dob", "national_id")), *_CONTACT, field("completeness")))


def hashed_id(prefix: str, key: str = "cluster_key") -> Column:
    """prefix + SHA-256 of the key; an empty or null key has no id."""
    return F.when(F.col(key) != "", F.concat(F.lit(prefix), F.sha2(F.col(key), 256)))


def first_of(df: DataFrame, by: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in a total order; the filter on the rank is limited before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def _latest(*columns: str) -> Column:
    return F.coalesce(*columns).alias("updated_at")


def _alias(keyed: DataFrame, *order: Column) -> DataFrame:
    """(entity, person number, confidence): one row for each number, by the surest rule."""
    rows = keyed.where("spm_person_no is not null").select("entity_person_id", "spm_person_no", "cluster_key", "confidence")
    return best_row(rows, "spm_person_no", F.desc("confidence"), *order)


# ------------------------------------------------------------------ citizens


def normalize_citizens(person_master: DataFrame) -> DataFrame:
    return person_master.withColumns(CITIZEN.norms())


def cluster_citizens(person_master: DataFrame) -> DataFrame:
    """National id and birth date, else Arabic name, birth date and gender, else the person number."""
    return CITIZEN.keyed(person_master).withColumn("entity_person_id", hashed_id("C:"))


def golden_citizens(person_master: DataFrame) -> DataFrame:
    """The most complete, then latest record of each entity."""
    scored = cluster_citizens(person_master).withColumns({"completeness": completeness(CITIZEN_VALUES), "updated_at": _latest("spm_modified_date", "spm_created_date")})
    known = scored.where("entity_person_id is not null")
    return CITIZENS.of(best_row(known, "entity_person_id", F.desc("completeness"), F.col("updated_at").desc_nulls_last(), F.asc("spm_person_no")))


def alias_citizens(person_master: DataFrame) -> DataFrame:
    """Person number -> entity, one row for each number, with the confidence of the rule that made the key."""
    return _alias(cluster_citizens(person_master), F.asc("cluster_key")).withColumn("source", F.lit("person_master"))


# ------------------------------------------------------------------ one population, SHA-1 ids


def basic_persons(person_master: DataFrame) -> DataFrame:
    """The columns of the one-population pipeline."""
    return BASIC_PERSONS.of(person_master.withColumn("updated_at", _latest("spm_modified_date", "spm_created_date")))


def cluster_basic(persons: DataFrame) -> DataFrame:
    """National id or else passport, with name and birth date; else the person number."""
    return BASIC.keyed(persons).withColumn("entity_person_id", F.sha1(F.coalesce("cluster_key", F.lit(""))))


def golden_basic(persons: DataFrame) -> DataFrame:
    scored = cluster_basic(persons).withColumn("completeness", completeness(BASIC_VALUES, blank_counts=True))
    return BASIC_ENTITIES.of(best_row(scored, "entity_person_id", F.desc("completeness"), F.col("updated_at").desc_nulls_last(), F.asc("spm_person_no")))


def alias_basic(persons: DataFrame) -> DataFrame:
    return cluster_basic(persons).select("entity_person_id", "spm_person_no", "confidence").distinct()


# ------------------------------------------------------------------ residents


def residency_join(requests: DataFrame, relations: DataFrame, languages: DataFrame, master: DataFrame, applications: DataFrame, transactions: DataFrame) -> DataFrame:
    """Approved family residency requests with their transactions and the relation's text.

    Lookups are filtered and left-joined; requests are cut down by status,
    relation and module before they meet the transactions.
    """
    a = requests.where(F.col("lookup_family_relationship_id").isin("2", "3", "4")).withColumn("_rel", F.col("lookup_family_relationship_id").try_cast("int"))
    b = relations.select(F.col("id").try_cast("int").alias("_rel"), "name_id")
    c = languages.where("lookup_language_id = 2").select(F.col("value_language_group_id").alias("name_id"), F.col("localized_value").alias("person_to_sponsor_relation"))
    rm = master.where("lookup_last_action_id = 6").select("id")
    ra = applications.where("lookup_module_id = 1").select(F.col("request_id").alias("id"), F.col("udb_transaction_no").alias("rtr_no"), F.col("udb_transaction_year").alias("rtr_year"))
    return a.join(rm, "id").join(ra, "id").join(transactions, ["rtr_no", "rtr_year"]).join(b, "_rel", "left").join(c, "name_id", "left").drop("_rel", "name_id", "rtr_no", "rtr_year")


def cluster_residents(joined: DataFrame) -> DataFrame:
    """Person number, else passport and birth date, else request and sponsor."""
    return RESIDENT.keyed(joined).withColumn("entity_person_id", hashed_id("R:"))


def golden_residents(joined: DataFrame) -> DataFrame:
    """The latest record of each resident."""
    dated = cluster_residents(joined).withColumn("updated_at", _latest("rtr_create_date", "creation_date"))
    return RESIDENTS.of(best_row(dated, "entity_person_id", F.col("updated_at").desc_nulls_last(), F.asc("id"), F.asc("rma_seqno")))


def alias_residents(joined: DataFrame) -> DataFrame:
    return _alias(cluster_residents(joined), F.asc("entity_person_id")).drop("cluster_key").withColumn("source", F.lit("echannels_residency_requests"))
