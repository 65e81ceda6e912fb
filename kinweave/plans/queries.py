"""The registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

import uuid
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import kin as K
from ..functions import text as T
from ..operators import catalogue, ego, graph, keyed, layout, links, lookup, payload, reports, resolve, search, upsert
from ..operators.tables import settle, shared_dir
from ..sources import bronze
from .stages import STAGES, Silver, silver

#: Person numbers of the queries about one person, or one pair.
ONE, OTHER = "P0000000100", "P0000000109"


class Registry:
    """Silver tables over a data folder: planned where a query is about how they are made, else those that are kept."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def _bronze(self, f) -> DataFrame:
        return f(self.spark, self.dir)

    @cached_property
    def silver(self) -> Silver:
        return silver(self.spark, self.dir)

    def kept(self, name: str) -> DataFrame:
        """A silver table, written once for all queries."""
        return self.silver.table(name)

    @cached_property
    def persons(self) -> DataFrame:
        return self._bronze(bronze.person_master)

    @cached_property
    def detail(self) -> DataFrame:
        return self._bronze(bronze.record_detail)

    @cached_property
    def master(self) -> DataFrame:
        return self._bronze(bronze.record_master)

    @cached_property
    def citizens(self) -> DataFrame:
        return resolve.golden_citizens(self.persons)

    @cached_property
    def citizen_alias(self) -> DataFrame:
        return resolve.alias_citizens(self.persons)

    @cached_property
    def basic(self) -> DataFrame:
        return resolve.basic_persons(self.persons)

    @cached_property
    def joined(self) -> DataFrame:
        return resolve.residency_join(*(self._bronze(f) for f in (bronze.residency_requests, bronze.family_relationships, bronze.value_languages, bronze.request_master, bronze.request_applications, bronze.residency_transactions)))

    @cached_property
    def residents(self) -> DataFrame:
        return resolve.golden_residents(self.joined)

    @cached_property
    def resident_table(self) -> DataFrame:
        """The residents as they are kept: links, names and networks read them."""
        return self.kept("residents")

    @cached_property
    def resident_ids(self) -> DataFrame:
        return self.resident_table.select(F.col("entity_person_id").alias("id"))

    @cached_property
    def resident_alias(self) -> DataFrame:
        return resolve.alias_residents(self.joined)

    @cached_property
    def parents(self) -> DataFrame:
        return links.parent_links(self.detail, self.citizen_alias)

    @cached_property
    def spouses(self) -> DataFrame:
        return links.spouse_links(self.detail, self.master, self.citizen_alias)

    @cached_property
    def sponsors(self) -> DataFrame:
        return links.all_sponsors(self.citizen_alias, self.resident_alias)

    @cached_property
    def sponsorship(self) -> DataFrame:
        return self.kept("sponsorship")

    @cached_property
    def groups(self) -> DataFrame:
        return self.kept("groups")

    @cached_property
    def child_of(self) -> DataFrame:
        return self.kept("child_of")

    @cached_property
    def spouse_of(self) -> DataFrame:
        return self.kept("spouse_of")

    @cached_property
    def people(self) -> DataFrame:
        return self.kept("people")

    @cached_property
    def egos(self) -> DataFrame:
        return self.people.select("id")

    @cached_property
    def ego_people(self) -> DataFrame:
        return self.kept("citizens").select(F.col("entity_person_id").alias("id"), F.coalesce("full_name_en", "full_name").alias("label"), "sex")

    @cached_property
    def ego(self) -> tuple[DataFrame, DataFrame]:
        return ego.citizen_ego(self.ego_people, self.kept("parents"), self.kept("spouses"))

    @cached_property
    def names(self) -> DataFrame:
        cols = [F.col("entity_person_id").alias("id"), F.col("full_name").alias("label"), "sex", "person_type"]
        return self.kept("citizens").select(*cols).unionByName(self.resident_table.select(*cols))

    @cached_property
    def network(self) -> tuple[DataFrame, DataFrame]:
        return ego.resident_ego(self.resident_table, self.sponsorship, self.groups, self.names.drop("person_type"))

    @cached_property
    def sponsored_by(self) -> DataFrame:
        return self.sponsorship.select(F.col("sponsored_entity_person_id").alias("child"), F.col("sponsor_entity_person_id").alias("parent")).distinct()

    @cached_property
    def tiers(self) -> DataFrame:
        return graph.five_tier_nodes(self.egos, self.people, self.child_of, self.spouse_of)

    @cached_property
    def cache(self) -> DataFrame:
        return self.silver.documents()

    @cached_property
    def one(self) -> list[str]:
        """The entity of one person number, by a lookup."""
        return [r[0] for r in lookup.find(self.kept("number_index"), "spm_person_no", [ONE]).select("entity_person_id").collect()]

    def ego_of(self, ids: list[str], lang: str = "en", depth: int = 3) -> tuple[DataFrame, DataFrame]:
        return lookup.networks_of(self.kept("entity_steps"), self.kept("entity_index"), ids, lang, depth)

    def ego_of_one(self, lang: str = "en", depth: int = 3) -> tuple[DataFrame, DataFrame]:
        return self.ego_of(self.one, lang, depth)

    def tree_of_one(self) -> tuple[DataFrame, DataFrame]:
        return lookup.tree_of(self.kept("person_steps"), self.kept("person_index"), [ONE])

    @cached_property
    def pairs(self) -> DataFrame:
        """Pairs of persons nine numbers apart."""
        k = self._bronze(bronze.pedigree).select("k")
        other = k.select((F.col("k") - 9).alias("k"))
        no = lambda c: F.concat(F.lit("P"), F.lpad(c.cast("string"), 10, "0"))
        return k.join(other, "k").select(no(F.col("k")).alias("a"), no(F.col("k") + 9).alias("b"))


def _files(r: Registry, name: str) -> str:
    """A new folder below the shared one."""
    return f"{shared_dir(r.spark)}/registry/{name}-{uuid.uuid4().hex}"


def _csv(r: Registry) -> DataFrame:
    """Details exported as a delimited file and read back by their declared schema, with a file that is absent."""
    path = _files(r, "csv")
    upsert.export_csv(r.detail.select(*bronze.DETAIL_SCHEMA.names), path)
    return bronze.read_csv(r.spark, path, bronze.DETAIL_SCHEMA).unionByName(bronze.read_optional_csv(r.spark, f"{path}-absent", bronze.DETAIL_SCHEMA))


def _id_file(r: Registry) -> DataFrame:
    """Heads of books as a file of ids, and the persons that it names."""
    path = _files(r, "ids")
    r.master.select(F.col("spm_person_no").alias("value")).write.text(path)
    return r.people.join(bronze.read_ids(r.spark, path), "id", "left_semi")


def _table(r: Registry) -> DataFrame:
    """All persons in a partitioned table, then all women merged over them with other values, twice."""
    path = _files(r, "table")
    people = r.people.select("id", "label", F.coalesce("sex", F.lit("?")).alias("sex"))
    new = people.where("sex = 'F'").select("id", F.upper("label").alias("label"), "sex", F.lit("new").alias("state"))
    upsert.upsert_table(r.spark, path, people.withColumn("state", F.lit("old")), ["id"], partition_by=["sex"])
    for _ in range(2):
        upsert.upsert_table(r.spark, path, new, ["id"], partition_by=["sex"])
    return upsert.read_table(r.spark, path).select("id", "label", "sex", "state")


def _cached(r: Registry) -> DataFrame:
    """The document of one person, looked up in the cache of all entities: one bucket of it is read."""
    return r.silver.documents_of(r.one).select("entity_person_id", "ego_json")


def _exported(r: Registry) -> DataFrame:
    """The whole cache exported as JSON lines, and read back as roots and their numbers of nodes and edges."""
    path = _files(r, "json")
    upsert.export_json(r.cache, path)
    doc = F.from_json("value", "root string, lang string, nodes array<struct<id string>>, edges array<struct<source string>>")
    return r.spark.read.text(path).select(doc.alias("d")).select("d.root", "d.lang", F.size("d.nodes").alias("nodes"), F.size("d.edges").alias("edges"))


def _keyed(r: Registry) -> DataFrame:
    """All persons laid out by key; then, in one write, men get other values and persons of unknown sex go; all of it again, which changes nothing."""
    path = _files(r, "keyed")
    people = r.people.select("id", "label", "sex", F.lit("old").alias("state"))
    keyed.create(people, path, ["id"], 16)
    men = people.where("sex = 'M'").withColumns({"label": F.upper("label"), "state": F.lit("new")})
    for _ in range(2):
        keyed.upsert(r.spark, path, men, ["id"], gone=people.where("sex is null").select("id"))
    return keyed.read(r.spark, path).select("id", "label", "sex", "state")


def _lca_one(r: Registry) -> DataFrame:
    """Common ancestors of one pair, and of a person with itself."""
    return lookup.common_ancestors_of(r.kept("person_steps"), r.kept("person_index"), [(ONE, OTHER), (ONE, ONE)], limit=20)


def _details(r: Registry) -> DataFrame:
    """The network of one person, with further details of its nodes by the same index."""
    nodes = r.ego_of_one()[0]
    who = [x[0] for x in nodes.select("id").distinct().collect()]
    more = lookup.find(r.kept("entity_index"), "id", who).select(F.col("id").alias("entity_person_id"), F.col("label_ar").alias("full_name_ar"), F.lit(None).cast("string").alias("full_name"), "dob")
    return ego.with_details(nodes, more)


def _stage_counts(r: Registry) -> DataFrame:
    """All silver tables, made where they are lacking, and their rows."""
    r.silver.run()
    rows = [r.kept(s.name).agg(F.lit(s.name).alias("stage"), F.count("*").alias("n")) for s in STAGES]
    return reduce(DataFrame.unionByName, rows)


def _beyond(r: Registry) -> DataFrame:
    """Which bounds of the operators refuse a value one beyond them, for each of the sexes that persons have; and a network of an id that nobody has."""
    tried = {
        "depth of networks": lambda v: r.ego_of(r.one, depth=v),
        "depth of trees": lambda v: graph.check_depth(v),
        "depth of sponsorship": lambda v: graph.check_depth(v, 3),
        "common ancestors": lambda v: graph.common_ancestors(None, None, None, limit=v),
    }
    most = {"depth of networks": 5, "depth of trees": 5, "depth of sponsorship": 3, "common ancestors": 20}

    def refused(name: str, value: int) -> bool:
        try:
            tried[name](value)
        except ValueError:
            return True
        return False

    bounds = F.array(*(F.struct(F.lit(n).alias("what"), F.lit(refused(n, 0)).alias("below"), F.lit(refused(n, m + 1)).alias("above")) for n, m in most.items()))
    egos = r.ego_of(["nobody", *r.one], depth=1)[0].select("ego").distinct().count()
    per = r.people.groupBy("sex").agg(F.count("*").alias("persons"))
    return per.select("sex", "persons", F.explode(bounds).alias("b")).select("sex", "persons", "b.*", F.lit(egos).cast("long").alias("egos"))


def _paths(r: Registry) -> DataFrame:
    """The signatures by which citizens are reached within two generations, with the sex of whom they lead to."""
    return settle(_counted(r, 2), "paths")


def _counted(r: Registry, depth: int) -> DataFrame:
    steps = settle(ego.kin_steps(r.kept("parents"), r.kept("spouses")), "steps")
    return ego.path_counts(r.ego_people.select("id"), steps, r.ego_people.select("id", "sex"), depth)


def _groups(r: Registry) -> DataFrame:
    """Nodes of all networks by kin group, counted by signature and sex: a term is made of these two alone."""
    paths = settle(_counted(r, 3), "paths")
    return reports.kin_group_counts(paths.select(K.kin_en("path", "sex").alias("kin"), "n"))


def _text_time(df: DataFrame) -> DataFrame:
    return df.withColumn("updated_at", F.col("updated_at").cast("string")) if "updated_at" in df.columns else df


def _query(f):
    return lambda spark, sf_dir: _text_time(f(Registry(spark, sf_dir)))


def _upsert(r: Registry) -> DataFrame:
    """All persons with a parent, then all parents with other values merged over them: some are new, some change, some stay."""
    has = lambda column: r.people.join(r.child_of.select(F.col(column).alias("id")).distinct(), "id", "left_semi")
    base = has("child").select("id", "label", F.lit("old").alias("state"))
    new = has("parent").select("id", F.upper("label").alias("label"), F.lit("new").alias("state"))
    return upsert.merge(base, new, ["id"])


def _properties(r: Registry) -> DataFrame:
    """All persons with a parent; then properties of all parents merged over them: their label replaced, a count given, and a state that only new rows get."""
    has = lambda column: r.people.join(r.child_of.select(F.col(column).alias("id")).distinct(), "id", "left_semi")
    base = has("child").select("id", "label", "sex", F.lit("known").alias("state"))
    counts = r.child_of.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("children"))
    given = has("parent").join(counts, "id").select("id", F.upper("label").alias("label"), "children", F.lit("made").alias("state"))
    return upsert.merge_properties(base, given, ["id"], on_create=("state",))


def _daily(r: Registry) -> DataFrame:
    """Entities as a table of the catalogue, in folders by the day of their last change, replaced once; those of a month, counted by sex."""
    name = f"gold_{uuid.uuid4().hex}"
    catalogue.ensure_namespace(r.spark, name, _files(r, "namespace"))
    rows = r.kept("citizens").select("entity_person_id", "sex", "updated_at")
    catalogue.save(rows.where("sex = 'F'"), f"{name}.entities", day_of="updated_at")
    catalogue.save(rows, f"{name}.entities", day_of="updated_at")
    month = catalogue.within(r.spark.table(f"{name}.entities"), "updated_at", "2020-01-01 12:00:00", "2020-02-01 00:00:00")
    return month.groupBy("sex").agg(F.count("*").alias("n"), F.min("entity_person_id").alias("first"))


def _autocreate(r: Registry) -> DataFrame:
    known = r.residents.select(F.col("entity_person_id").alias("id"), "person_type")
    ends = r.sponsorship.select(F.col("sponsor_entity_person_id").alias("id"))
    return upsert.with_missing(known, ends, F.when(F.col("id").startswith("C:"), "citizen").otherwise("resident"))


def _roundtrip(r: Registry) -> DataFrame:
    return payload.sizes(r.cache)


def _relation_labels(r: Registry) -> DataFrame:
    codes = r._bronze(bronze.residency_requests).select(F.col("lookup_family_relationship_id").alias("code")).distinct()
    return codes.select("code", T.relation_label("code").alias("en"), T.relation_label("code", "ar").alias("ar"))


def _with_parents(r: Registry) -> DataFrame:
    """A cache that holds the entities with a linked parent, for the coverage report."""
    return r.parents.select(F.col("child_entity_person_id").alias("entity_person_id")).distinct()


def _latest(r: Registry) -> DataFrame:
    c = r.citizens.select("entity_person_id", F.col("full_name").alias("ego_json"), F.col("updated_at").alias("generated_at"))
    return reports.latest(c).withColumn("generated_at", F.col("generated_at").cast("string"))


def _round(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def _layout(r: Registry) -> DataFrame:
    t = settle(r.tiers, "tiers")
    return _round(layout.five_tier_layout(t, graph.induced_edges(t, r.child_of, r.spouse_of)))


def _shown(r: Registry) -> tuple[DataFrame, DataFrame]:
    """The five-tier trees with the parents of spouses, which the layout shows as a cluster, and the edges among all of these."""
    tiers = r.tiers.select("ego", "id", "kin")
    known = r.egos.withColumnRenamed("id", "inlaw")
    more = graph.inlaws(r.child_of, r.spouse_of).join(r.egos, "id", "left_semi").join(known, "inlaw", "left_semi").select(F.col("id").alias("ego"), F.col("inlaw").alias("id"), F.lit("in-law").alias("kin"))
    nodes = settle(tiers.unionByName(more.join(tiers, ["ego", "id"], "left_anti")), "shown")
    return nodes, graph.induced_edges(nodes, r.child_of, r.spouse_of)


def _clustered(r: Registry, make) -> DataFrame:
    nodes, edges = _shown(r)
    return make(nodes, layout.cluster_members(nodes, edges))


#: Parts of names: some are in few names, some in nearly all, some in none, some too short for a trigram.
TERMS = ["CUSTOMER#00000001", "customer", "0123", "#000000", "99", "er#00000001", "x", "nobody", ""]


def _named(r: Registry, term: str) -> DataFrame:
    found = search.named(r.kept("name_grams"), r.kept("name_postings"), r.kept("person_index"), term)
    return found.select("id", "label")


FUNCTIONS = {
    # normalising, keys, ids
    "normalize_person": lambda r: resolve.normalize_citizens(r.persons).select("spm_person_no", "name_ar_norm", "name_en_norm", F.col("dob_norm").cast("string").alias("dob_norm"), "national_id_norm", "gender_norm"),
    "cluster_key_citizen": lambda r: resolve.cluster_citizens(r.persons).select("spm_person_no", "cluster_key"),
    "cluster_key_basic": lambda r: resolve.cluster_basic(r.basic).select("spm_person_no", "cluster_key"),
    "cluster_key_resident": lambda r: resolve.cluster_residents(r.joined).select("id", "rma_seqno", "cluster_key"),
    "entity_id_sha256": lambda r: resolve.cluster_citizens(r.persons).select("spm_person_no", "entity_person_id"),
    "entity_id_sha1": lambda r: resolve.cluster_basic(r.basic).select("spm_person_no", "entity_person_id"),
    "completeness_score": lambda r: r.persons.select("spm_person_no", T.completeness(resolve.CITIZEN_VALUES).alias("completeness")),
    "sex_whitelist": lambda r: r.people.select("id", T.sex_known("sex").alias("sex")),
    # golden records and aliases
    "golden_citizen": lambda r: r.citizens,
    "golden_basic": lambda r: resolve.golden_basic(r.basic),
    "golden_resident": lambda r: r.residents,
    "alias_citizen": lambda r: r.citizen_alias.drop("cluster_key"),
    "alias_basic": lambda r: resolve.alias_basic(r.basic),
    "alias_resident": lambda r: r.resident_alias,
    "residency_six_way_join": lambda r: r.joined.select("id", "sponsor_number", "spm_person_no", "person_to_sponsor_relation", F.col("rtr_create_date").cast("string").alias("rtr_create_date"), "rma_seqno", "rma_year"),
    # links
    "parent_links": lambda r: r.parents,
    "spouse_links_head": lambda r: r.spouses,
    "spouse_edges_canonical": lambda r: links.spouse_edges(r.detail),
    "parent_edges": lambda r: links.parent_edges(r.detail),
    "book_members": lambda r: links.book_members(r.detail),
    "family_membership": lambda r: links.family_membership(r.detail, r.master, r.citizen_alias),
    "sponsor_union": lambda r: r.sponsors,
    "sponsorship_links": lambda r: links.sponsorship_links(r.resident_table, links.all_sponsors(r.kept("citizen_alias"), r.kept("resident_alias"))),
    "family_groups": lambda r: links.family_groups(r.resident_table, links.all_sponsors(r.kept("citizen_alias"), r.kept("resident_alias"))),
    "detail_with_relation": lambda r: links.with_relation(r.detail, r._bronze(bronze.family_relationships).select((F.col("id").cast("int") + 1).alias("code"), F.col("name_id").alias("description"))),
    # relations
    "siblings": lambda r: graph.siblings(r.child_of),
    "grandparents": lambda r: graph.grandparents(r.child_of),
    "grandchildren": lambda r: graph.grandchildren(r.child_of),
    "inlaws": lambda r: graph.inlaws(r.child_of, r.spouse_of),
    "symmetric_edges": lambda r: graph.symmetric(r.spouse_of),
    "ego_fixed_nodes": lambda r: graph.fixed_ego(r.people, r.child_of, r.spouse_of)[0],
    "ego_fixed_edges": lambda r: graph.fixed_ego(r.people, r.child_of, r.spouse_of)[1],
    # kin terms and labels
    "kin_terms_en": lambda r: _paths(r).withColumn("kin", K.kin_en("path", "sex")),
    "kin_terms_ar": lambda r: _paths(r).withColumn("kin", K.kin_ar("path", "sex")),
    "ego_cluster": lambda r: _paths(r).withColumn("kin", K.kin_en("path", "sex")).select("path", "sex", "n", K.kin_cluster("kin").alias("cluster")),
    "relation_label": _relation_labels,
    "edge_label": lambda r: graph.induced_edges(settle(r.tiers, "tiers"), r.child_of, r.spouse_of).select("type", T.edge_label("type").alias("label")).distinct(),
    "first_words": lambda r: r._bronze(lambda s, d: bronze.table(s, d, "documents")).select("doc_id", T.first_words("text", 2).alias("words")),
    "name_search": lambda r: _named(r, "CUSTOMER#00000001"),
    "name_search_terms": lambda r: reduce(DataFrame.unionByName, [_named(r, t).select(F.lit(t).alias("term"), "id", "label") for t in TERMS]),
    # networks
    "ego_citizen_nodes": lambda r: r.ego[0],
    "ego_citizen_edges": lambda r: r.ego[1],
    "ego_resident_nodes": lambda r: r.network[0],
    "ego_resident_edges": lambda r: r.network[1],
    "ego_resident_folded": lambda r: ego.folded_networks(r.resident_table, r.sponsorship, r.groups)[0],
    "ego_resident_unfolded": lambda r: ego.unfolded(*ego.folded_networks(r.resident_table, r.sponsorship, r.groups), r.names.drop("person_type")),
    "tree_five_tier_nodes": lambda r: r.tiers,
    "tree_five_tier_edges": lambda r: graph.induced_edges(settle(r.tiers, "tiers"), r.child_of, r.spouse_of),
    "tree_citizen_kin": lambda r: graph.citizen_tree_nodes(r.egos, r.people, r.child_of, r.spouse_of),
    "tree_resident": lambda r: graph.resident_tree(r.resident_ids, r.names, r.sponsored_by)[0],
    "tree_resident_edges": lambda r: graph.resident_tree(r.resident_ids, r.names, r.sponsored_by)[1],
    "tree_resident_relations": lambda r: graph.resident_tree(r.resident_ids, r.names, r.sponsored_by, links=r.sponsorship)[1],
    "tree_unified": lambda r: graph.tree_of_either(r.egos, r.people, r.child_of, r.spouse_of, r.resident_ids, r.names, r.sponsored_by),
    "sponsored_family": lambda r: graph.sponsored_family(r.sponsored_by, r.residents.select(F.col("entity_person_id").alias("id")), r.sponsored_by.select(F.col("parent").alias("id"))),
    "lca_pairs": lambda r: graph.common_ancestors(r.pairs, r.child_of, r.people, limit=None, depth=None, bulk=True).drop("rank"),
    "lca_topk": lambda r: graph.common_ancestors(r.pairs, r.child_of, r.people, limit=1, depth=None, bulk=True),
    "relationships_of": lambda r: graph.relationships(graph.induced_edges(settle(r.tiers, "tiers"), r.child_of, r.spouse_of)),
    "layout_five_tier": _layout,
    "layout_bounds": lambda r: _round(layout.bounding_box(_layout(r))),
    "layout_clusters": lambda r: _round(_clustered(r, layout.clusters)),
    "layout_cluster_members": lambda r: _clustered(r, lambda nodes, members: members),
    "layout_cluster_edges": lambda r: _clustered(r, layout.cluster_edges),
    # one person
    "ego_one_nodes": lambda r: r.ego_of_one()[0],
    "ego_one_edges": lambda r: r.ego_of_one()[1],
    "ego_one_nodes_ar": lambda r: r.ego_of_one(lang="ar")[0].drop("cluster"),
    "ego_one_nodes_depth1": lambda r: r.ego_of_one(depth=1)[0],
    "ego_one_details": _details,
    "ego_resident_one_nodes": lambda r: ego.resident_ego(r.resident_table, r.sponsorship, r.groups, r.names.drop("person_type"), ids=r.resident_ids.agg(F.min("id").alias("id")))[0],
    "tree_one": lambda r: r.tree_of_one()[0],
    "tree_one_edges": lambda r: r.tree_of_one()[1],
    "lca_one": _lca_one,
    "cache_one": _cached,
    # files and tables
    "csv_roundtrip": _csv,
    "id_file": _id_file,
    "table_upsert": _table,
    "table_keyed": _keyed,
    "cache_export": _exported,
    "stage_counts": _stage_counts,
    "bounds_refused": _beyond,
    # cache and loads
    "upsert_merge": _upsert,
    "upsert_properties": _properties,
    "table_daily": _daily,
    "edge_endpoint_check": lambda r: upsert.loadable_edges(r.sponsorship.select(F.col("sponsored_entity_person_id").alias("src"), F.col("sponsor_entity_person_id").alias("dst")), r.residents.select(F.col("entity_person_id").alias("id"))),
    "sponsor_autocreate": _autocreate,
    "payload_json": lambda r: r.cache.select("entity_person_id", "ego_json"),
    "payload_roundtrip": _roundtrip,
    "payload_adjacency": lambda r: payload.adjacency_of(r.cache),
    # reports
    "dup_entities_having": lambda r: upsert.repeated_keys(r.citizen_alias, ["entity_person_id"]),
    "count_by_person_type": lambda r: reports.count_by_type(r.citizens, r.residents),
    "cache_coverage": lambda r: reports.coverage(r.citizens, _with_parents(r)),
    "top_parents": lambda r: reports.top(r.parents, "parent_entity_person_id"),
    "largest_books": lambda r: reports.top(links.family_membership(r.detail, r.master, r.citizen_alias), "family_book_id"),
    "top_sponsors": lambda r: reports.top(r.sponsorship, "sponsor_entity_person_id"),
    "latest_cached": _latest,
    "kin_group_counts": _groups,
}

QUERIES = {name: _query(f) for name, f in FUNCTIONS.items()}
