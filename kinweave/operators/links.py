"""Links between entities: parents, spouses, family books, sponsorship."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .resolve import first_of


def _entity(alias: DataFrame, number: str, entity: str) -> DataFrame:
    return alias.where("entity_person_id is not null").select(F.col("spm_person_no").alias(number), F.col("entity_person_id").alias(entity))


def parent_links(detail: DataFrame, alias: DataFrame) -> DataFrame:
    """(parent, child, parent_type, source, confidence), one row for each parent and child."""
    of = lambda kind: detail.select(F.col("spm_person_no").alias("_child"), F.col(f"spm_person_no_{kind}").alias("_parent")).where("_child is not null and _parent is not null").distinct()
    both = of("father").withColumn("parent_type", F.lit("father")).unionByName(of("mother").withColumn("parent_type", F.lit("mother")))
    linked = both.join(_entity(alias, "_child", "child_entity_person_id"), "_child").join(_entity(alias, "_parent", "parent_entity_person_id"), "_parent")
    linked = linked.select("parent_entity_person_id", "child_entity_person_id", "parent_type", F.concat(F.lit("crd_"), F.col("parent_type")).alias("source"), F.lit(1.0).alias("confidence"))
    return first_of(linked, ["parent_entity_person_id", "child_entity_person_id"], [F.asc("parent_type")])


def spouse_links(detail: DataFrame, master: DataFrame, alias: DataFrame) -> DataFrame:
    """Head of a book and its members with relation code 2, never a person with itself."""
    heads = master.join(_entity(alias, "spm_person_no", "husband_entity_person_id"), "spm_person_no").select("crm_seq", "husband_entity_person_id")
    wives = detail.where("rel1_code = 2").join(_entity(alias, "spm_person_no", "wife_entity_person_id"), "spm_person_no").select("crm_seq", "wife_entity_person_id").distinct()
    pairs = heads.join(wives, "crm_seq").where("husband_entity_person_id <> wife_entity_person_id")
    return pairs.select("husband_entity_person_id", "wife_entity_person_id").distinct().withColumn("source", F.lit("rel1_code=2")).withColumn("confidence", F.lit(0.9))


def spouse_edges(detail: DataFrame) -> DataFrame:
    """Undirected pairs of person numbers: codes 1 and 2 of one book, smaller number first."""
    of = lambda code, name: detail.where(F.col("rel1_code") == code).select("crm_seq", F.col("spm_person_no").alias(name))
    pairs = of(1, "a").join(of(2, "b"), "crm_seq").select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
    return pairs.distinct().withColumn("type", F.lit("SPOUSE_OF"))


def parent_edges(detail: DataFrame) -> DataFrame:
    """(src parent, dst child, type, parent_sex) over person numbers."""
    of = lambda kind, sex: detail.where(f"spm_person_no_{kind} is not null").select(F.col(f"spm_person_no_{kind}").alias("src"), F.col("spm_person_no").alias("dst"), F.lit("PARENT_OF").alias("type"), F.lit(sex).alias("parent_sex"))
    return of("father", "M").unionByName(of("mother", "F")).distinct()


def book_members(detail: DataFrame) -> DataFrame:
    return detail.where("crm_seq is not null").select("crm_seq", F.col("spm_person_no").alias("person")).distinct()


def with_relation(detail: DataFrame, relations: DataFrame) -> DataFrame:
    """Details with the description of their relation code."""
    return detail.join(relations.withColumnRenamed("code", "rel1_code"), "rel1_code", "left")


def family_membership(detail: DataFrame, master: DataFrame, alias: DataFrame) -> DataFrame:
    """Entities of a book; an entry in the details comes before one as head."""
    e = _entity(alias, "spm_person_no", "entity_person_id")
    rows = detail.select("spm_person_no", "crm_seq").withColumn("source", F.lit("crd")).unionByName(master.select("spm_person_no", "crm_seq").withColumn("source", F.lit("crm")))
    rows = rows.where("crm_seq is not null").join(e, "spm_person_no").select("entity_person_id", "crm_seq", F.concat(F.lit("FAM:"), F.col("crm_seq")).alias("family_book_id"), "source")
    return first_of(rows.distinct(), ["entity_person_id", "crm_seq"], [F.asc("source")])


def all_sponsors(citizen_alias: DataFrame, resident_alias: DataFrame) -> DataFrame:
    """(sponsor_spm, sponsor_entity_id, sponsor_type); a number known in both populations has two rows."""
    of = lambda df, kind: df.select(F.col("spm_person_no").alias("sponsor_spm"), F.col("entity_person_id").alias("sponsor_entity_id"), F.lit(kind).alias("sponsor_type"))
    return of(citizen_alias, "citizen").unionByName(of(resident_alias, "resident"))


def _sponsored(residents: DataFrame, sponsors: DataFrame) -> DataFrame:
    s = sponsors.where("sponsor_entity_id is not null").withColumnRenamed("sponsor_spm", "sponsor_number")
    return residents.where("sponsor_number is not null and entity_person_id is not null").join(s, "sponsor_number")


def sponsorship_links(residents: DataFrame, sponsors: DataFrame) -> DataFrame:
    rows = _sponsored(residents, sponsors).select(F.col("sponsor_entity_id").alias("sponsor_entity_person_id"), F.col("entity_person_id").alias("sponsored_entity_person_id"), "relation_to_sponsor", "relationship_code", "sponsor_type")
    return rows.distinct().withColumn("source", F.lit("echannels_residency")).withColumn("confidence", F.lit(1.0))


def family_groups(residents: DataFrame, sponsors: DataFrame) -> DataFrame:
    rows = _sponsored(residents, sponsors).select("entity_person_id", F.col("sponsor_entity_id").alias("sponsor_id"), "sponsor_number", F.concat(F.lit("SPON:"), F.col("sponsor_number")).alias("family_group_id"))
    return rows.distinct().withColumn("source", F.lit("sponsorship"))
