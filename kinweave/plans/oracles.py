"""DuckDB SQL for each query name."""

from __future__ import annotations

from .oracle import RELATION, kin_ar, kin_en, sql

_PATHS = "SELECT path, sex, count(*) AS n FROM ego_reach WHERE g <= 2 GROUP BY 1, 2"
_REL_AR = "CASE code WHEN '2' THEN 'زوجة' WHEN '3' THEN 'ابن' WHEN '4' THEN 'ابنة' WHEN '5' THEN 'أخ' WHEN '6' THEN 'أخت' WHEN '7' THEN 'أب' WHEN '8' THEN 'أم' ELSE 'فرد من العائلة' END"
_FIXED = """SELECT ego, id, o, CASE o WHEN 0 THEN 'self' WHEN 1 THEN CASE sex WHEN 'M' THEN 'husband' WHEN 'F' THEN 'wife' ELSE 'spouse' END WHEN 2 THEN CASE sex WHEN 'M' THEN 'father' WHEN 'F' THEN 'mother' ELSE 'parent' END
  WHEN 3 THEN CASE sex WHEN 'M' THEN 'son' WHEN 'F' THEN 'daughter' ELSE 'child' END ELSE CASE sex WHEN 'M' THEN 'brother' WHEN 'F' THEN 'sister' ELSE 'sibling' END END AS kin
  FROM (SELECT ego, id, min(o) AS o FROM (SELECT id AS ego, id, 0 AS o FROM people UNION ALL SELECT a, b, 1 FROM spouse_sym UNION ALL SELECT child, parent, 2 FROM child_of UNION ALL SELECT parent, child, 3 FROM child_of
    UNION ALL SELECT id, sibling, 4 FROM sibs) WHERE ego IN (SELECT id FROM people) GROUP BY 1, 2) x LEFT JOIN people p USING (id)"""
_CLUSTERS = """SELECT DISTINCT id AS ego, '__cluster_grandparents__' AS id, 'grandparents' AS kin FROM gpar WHERE id IN (SELECT id FROM people) UNION ALL
  SELECT DISTINCT grandparent, '__cluster_grandchildren__', 'grandchildren' FROM gpar WHERE grandparent IN (SELECT id FROM people) UNION ALL SELECT DISTINCT id, '__cluster_inlaws__', 'inlaws' FROM inl WHERE id IN (SELECT id FROM people)"""
_LAYOUT = """SELECT ego, id, CAST(round(x, 6) AS DOUBLE) AS x, CAST(y AS DOUBLE) AS y FROM (
  SELECT ego, id, 0.0::DOUBLE AS x, 0.0::DOUBLE AS y FROM tier_nodes WHERE kin = 'self'
  UNION ALL SELECT ego, id, 3.2::DOUBLE * row_number() OVER (PARTITION BY ego ORDER BY id), 0.0 FROM tier_nodes WHERE kin IN ('husband', 'wife', 'spouse')
  UNION ALL SELECT ego, id, CASE WHEN i % 2 = 0 THEN -(i // 2 + 1) * 3.2::DOUBLE ELSE (m + i // 2 + 1) * 3.2::DOUBLE END, 0.0 FROM (SELECT t.ego, t.id, row_number() OVER (PARTITION BY t.ego ORDER BY t.id) - 1 AS i,
    (SELECT count(*) FROM tier_nodes s WHERE s.ego = t.ego AND s.kin IN ('husband', 'wife', 'spouse')) AS m FROM tier_nodes t WHERE t.kin IN ('brother', 'sister', 'sibling'))
  UNION ALL SELECT ego, id, CASE kin WHEN 'father' THEN -2.88::DOUBLE ELSE 2.88::DOUBLE END, -1.8 FROM tier_nodes WHERE kin IN ('father', 'mother')
  UNION ALL SELECT ego, id, slot * 1.6::DOUBLE + (row_number() OVER (PARTITION BY ego, slot ORDER BY id) - 1 - (count(*) OVER (PARTITION BY ego, slot) - 1) / 2.0::DOUBLE) * 3.2::DOUBLE, 1.8 FROM (
    SELECT k.ego, k.id, coalesce(min(s.i), 0) AS slot FROM tier_nodes k LEFT JOIN (tier_edges e JOIN (SELECT ego, id, row_number() OVER (PARTITION BY ego ORDER BY id) AS i FROM tier_nodes WHERE kin IN ('husband', 'wife', 'spouse')) s ON s.ego = e.ego AND s.id = e.target AND e.type = 'CHILD_OF')
      ON e.ego = k.ego AND e.source = k.id WHERE k.kin IN ('son', 'daughter', 'child') GROUP BY 1, 2))"""
_TOP = "SELECT {k}, count(*) AS n FROM {t} GROUP BY 1 ORDER BY n DESC, {k} LIMIT 10"

_ONE = "(SELECT entity_person_id FROM cit_alias WHERE spm_person_no = 'P0000000100')"
_JSON = """SELECT n.ego AS entity_person_id, CAST(to_json(struct_pack(root := n.ego, lang := 'en', depth := 3, nodes := n.nodes, edges := coalesce(e.edges, []), generated_at := '2024-01-01T00:00:00Z')) AS VARCHAR) AS ego_json
  FROM (SELECT ego, list(struct_pack(id := id, label := label, sex := sex, kin := kin, cluster := cluster) ORDER BY id) AS nodes FROM ego_nodes GROUP BY 1) n
  LEFT JOIN (SELECT ego, list(struct_pack(source := source, target := target, type := type) ORDER BY source, target, type) AS edges FROM ego_edges GROUP BY 1) e USING (ego)"""
# one person to depth 1, walked from that person alone: spouses of spouses without end, one generation, and their spouses
_WED = "wed_{b} AS (SELECT id, n, path FROM {a} UNION SELECT s.t, w.n + 1, w.path || 'S' FROM wed_{b} w JOIN ego_steps s ON s.f = w.id AND s.kind = 'S' WHERE w.n < 12), best_{b} AS (SELECT id, min(n) AS n, arg_min(path, (n, path)) AS path FROM wed_{b} GROUP BY 1)"
_NEAR = f"""SELECT * FROM (WITH RECURSIVE me AS (SELECT DISTINCT entity_person_id AS id, 0 AS n, '' AS path FROM cit_alias WHERE spm_person_no = 'P0000000100'), {_WED.format(a='me', b='a')},
  next AS (SELECT s.t AS id, b.n + 1 AS n, b.path || s.kind AS path FROM best_a b JOIN ego_steps s ON s.f = b.id AND s.kind <> 'S'), {_WED.format(a='next', b='b')},
  near AS (SELECT * FROM best_a UNION ALL SELECT * FROM best_b WHERE id NOT IN (SELECT id FROM best_a)),
  termed AS (SELECT m.id AS ego, x.id, coalesce(p.label, x.id) AS label, p.sex, CASE WHEN m.id = x.id THEN 'self' ELSE {kin_en('x.path', 'p.sex')} END AS kin FROM near x CROSS JOIN me m LEFT JOIN ego_people p ON p.id = x.id)
  SELECT *, CASE WHEN kin LIKE '%-in-law%' OR kin = 'spouse' THEN 'inlaws' WHEN kin IN ('grandfather', 'grandmother', 'grandparent') THEN 'ancestors' WHEN kin IN ('grandson', 'granddaughter', 'grandchild') THEN 'descendants' END AS cluster FROM termed)"""
_STAGES = {
    "citizens": "cit_gold", "citizen_alias": "cit_alias", "parents": "plinks", "spouses": "slinks", "people": "people", "child_of": "child_of", "spouse_of": "spouse_of", "residency": "joined", "residents": "res_gold",
    "resident_alias": "res_alias", "sponsorship": "slinks_r", "groups": "fgroups", "entity_steps": "ego_steps", "entity_index": "cit_gold", "number_index": "cit_alias", "person_index": "people", "name_grams": "gram_n", "name_postings": "(SELECT id FROM gram_of JOIN gram_n USING (gram) WHERE n * 16 <= (SELECT count(*) FROM people))", "ego_cache": "ego_people",
    "person_steps": "(SELECT child, parent, 'U' FROM child_of UNION SELECT parent, child, 'D' FROM child_of UNION SELECT a, b, 'S' FROM spouse_sym)",
}
_FINAL = {
    "stage_counts": " UNION ALL ".join(f"SELECT '{name}' AS stage, count(*) AS n FROM {of}" for name, of in _STAGES.items()),
    "bounds_refused": """SELECT sex, count(*) AS persons, what, true AS below, true AS above, CAST(1 AS BIGINT) AS egos FROM people, (VALUES ('depth of networks'), ('depth of trees'), ('depth of sponsorship'), ('common ancestors')) w(what) GROUP BY sex, what""",
    "table_keyed": "SELECT id, CASE WHEN sex = 'M' THEN upper(label) ELSE label END AS label, sex, CASE WHEN sex = 'M' THEN 'new' ELSE 'old' END AS state FROM people WHERE sex IS NOT NULL",
    "cache_export": "SELECT n.ego AS root, 'en' AS lang, CAST(n.nodes AS INTEGER) AS nodes, CAST(coalesce(e.edges, 0) AS INTEGER) AS edges FROM (SELECT ego, count(*) AS nodes FROM ego_nodes GROUP BY 1) n LEFT JOIN (SELECT ego, count(*) AS edges FROM ego_edges GROUP BY 1) e USING (ego)",
    "ego_resident_unfolded": "SELECT * FROM net_nodes",
    "ego_resident_folded": """SELECT * FROM (WITH res AS (SELECT entity_person_id AS ego FROM res_gold), grp AS (SELECT DISTINCT entity_person_id AS m, family_group_id AS g FROM fgroups),
    ahead AS (SELECT ego, ego AS f, 1 AS level FROM res UNION ALL SELECT DISTINCT r.ego, v.t, 2 FROM res r JOIN net_moves v ON v.f = r.ego AND v.way < 3 WHERE v.t <> r.ego)
  SELECT ego, 0 AS level, CAST(NULL AS VARCHAR) AS "from", 0 AS way, ego AS at, CAST(1 AS BIGINT) AS n, 'self' AS role, CAST(NULL AS VARCHAR) AS relation FROM res
  UNION ALL SELECT a.ego, a.level, a.f, 1, v.t, 1, v.role, v.relation FROM ahead a JOIN net_moves v ON v.f = a.f AND v.way = 1 WHERE v.t <> a.ego
  UNION ALL SELECT a.ego, a.level, a.f, 2, a.f, d.n, NULL, NULL FROM ahead a JOIN (SELECT f, count(*) AS n FROM net_moves WHERE way = 2 GROUP BY 1) d ON d.f = a.f
  UNION ALL SELECT a.ego, a.level, a.f, 3, x.g, y.n, NULL, NULL FROM ahead a JOIN grp x ON x.m = a.f JOIN (SELECT g, count(*) AS n FROM grp GROUP BY 1) y ON y.g = x.g)""",
    "upsert_properties": """SELECT p.id, CASE WHEN c.n IS NULL THEN p.label ELSE upper(p.label) END AS label, CASE WHEN k.child IS NOT NULL THEN p.sex END AS sex, c.n AS children, CASE WHEN k.child IS NOT NULL THEN 'known' ELSE 'made' END AS state
  FROM people p LEFT JOIN (SELECT parent, count(*) AS n FROM child_of GROUP BY 1) c ON c.parent = p.id LEFT JOIN (SELECT DISTINCT child FROM child_of) k ON k.child = p.id WHERE c.n IS NOT NULL OR k.child IS NOT NULL""",
    "table_daily": "SELECT sex, count(*) AS n, min(entity_person_id) AS first FROM cit_gold WHERE CAST(updated_at AS TIMESTAMP) >= TIMESTAMP '2020-01-01 12:00:00' AND CAST(updated_at AS TIMESTAMP) < TIMESTAMP '2020-02-01 00:00:00' GROUP BY 1",
    "tree_one_edges": "SELECT * FROM tier_edges WHERE ego = 'P0000000100'",
    "ego_one_nodes": f"SELECT * FROM ego_nodes WHERE ego IN {_ONE}",
    "ego_one_edges": f"SELECT * FROM ego_edges WHERE ego IN {_ONE}",
    "ego_one_nodes_ar": f"SELECT ego, id, coalesce(label, id) AS label, sex, CASE WHEN ego = id THEN {kin_ar("''", "CAST(NULL AS VARCHAR)")} ELSE {kin_ar('path', 'sex')} END AS kin FROM ego_reach WHERE ego IN {_ONE}",
    "ego_one_nodes_depth1": _NEAR,
    "ego_one_details": f"SELECT n.*, coalesce(c.full_name_ar, c.full_name) AS label_ar, CAST(c.dob AS VARCHAR) AS dob FROM ego_nodes n LEFT JOIN cit_gold c ON c.entity_person_id = n.id WHERE n.ego IN {_ONE}",
    "ego_resident_one_nodes": "SELECT * FROM net_nodes WHERE ego = (SELECT min(entity_person_id) FROM res_gold)",
    "tree_one": "SELECT * FROM tier_nodes WHERE ego = 'P0000000100'",
    "lca_one": """SELECT a, b, ancestor_id, full_name, da, db, total_depth, CAST(rank AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY a, b ORDER BY total_depth, da, db, ancestor_id) AS rank FROM (
  WITH RECURSIVE up(start, id, d) AS (SELECT id, id, 0 FROM people WHERE id IN ('P0000000100', 'P0000000109') UNION SELECT u.start, c.parent, u.d + 1 FROM up u JOIN child_of c ON c.child = u.id),
    near AS (SELECT start, id, min(d) AS d FROM up GROUP BY 1, 2)
  SELECT x.start AS a, y.start AS b, x.id AS ancestor_id, p.label AS full_name, x.d AS da, y.d AS db, x.d + y.d AS total_depth
  FROM near x JOIN near y USING (id) LEFT JOIN people p ON p.id = x.id WHERE x.start = 'P0000000100')) WHERE rank <= 20""",
    "cache_one": f"SELECT * FROM ({_JSON}) WHERE entity_person_id IN {_ONE}",
    "payload_json": _JSON,
    "csv_roundtrip": "SELECT me AS spm_person_no, father AS spm_person_no_father, mother AS spm_person_no_mother, crm_seq, rel1 AS rel1_code FROM detail",
    "id_file": "SELECT * FROM people WHERE id IN (SELECT head FROM master)",
    "table_upsert": "SELECT id, CASE WHEN sex = 'F' THEN upper(label) ELSE label END AS label, coalesce(sex, '?') AS sex, CASE WHEN sex = 'F' THEN 'new' ELSE 'old' END AS state FROM people",
    "normalize_person": "SELECT spm_person_no, name_ar_norm, name_en_norm, CAST(dob_norm AS VARCHAR) AS dob_norm, national_id_norm, gender_norm FROM cit_norm",
    "cluster_key_citizen": "SELECT spm_person_no, cluster_key FROM cit_key",
    "cluster_key_basic": "SELECT spm_person_no, cluster_key FROM basic_key",
    "cluster_key_resident": "SELECT id, rma_seqno, cluster_key FROM res_ent",
    "entity_id_sha256": "SELECT spm_person_no, eid AS entity_person_id FROM cit_ent",
    "entity_id_sha1": "SELECT spm_person_no, eid AS entity_person_id FROM basic_ent",
    "completeness_score": "SELECT primary_spm_person_no AS spm_person_no, completeness FROM cit_score",
    "sex_whitelist": "SELECT id, coalesce(sex, '') AS sex FROM people",
    "golden_citizen": "SELECT * FROM cit_gold",
    "golden_basic": "SELECT * FROM basic_gold",
    "golden_resident": "SELECT * FROM res_gold",
    "alias_citizen": "SELECT entity_person_id, spm_person_no, confidence, source FROM cit_alias",
    "alias_basic": "SELECT DISTINCT eid AS entity_person_id, spm_person_no, CAST(CASE WHEN cluster_key <> spm_person_no THEN 0.8 ELSE 1.0 END AS DOUBLE) AS confidence FROM basic_ent",
    "alias_resident": "SELECT * FROM res_alias",
    "residency_six_way_join": "SELECT id, sponsor_number, spm_person_no, person_to_sponsor_relation, CAST(rtr_create_date AS VARCHAR) AS rtr_create_date, rma_seqno, rma_year FROM joined",
    "parent_links": "SELECT * FROM plinks",
    "spouse_links_head": "SELECT * FROM slinks",
    "spouse_edges_canonical": "SELECT a AS src, b AS dst, 'SPOUSE_OF' AS type FROM spouse_of",
    "parent_edges": "SELECT DISTINCT * FROM (SELECT father AS src, me AS dst, 'PARENT_OF' AS type, 'M' AS parent_sex FROM detail WHERE father IS NOT NULL UNION ALL SELECT mother, me, 'PARENT_OF', 'F' FROM detail WHERE mother IS NOT NULL)",
    "book_members": "SELECT DISTINCT crm_seq, me AS person FROM detail",
    "family_membership": "SELECT * FROM membership",
    "sponsor_union": "SELECT * FROM sponsors",
    "sponsorship_links": "SELECT * FROM slinks_r",
    "family_groups": "SELECT * FROM fgroups",
    "detail_with_relation": "SELECT d.rel1 AS rel1_code, d.me AS spm_person_no, d.father AS spm_person_no_father, d.mother AS spm_person_no_mother, d.crm_seq, 100 + r.r_regionkey AS description FROM detail d LEFT JOIN region r ON r.r_regionkey + 1 = d.rel1",
    "siblings": "SELECT * FROM sibs",
    "grandparents": "SELECT * FROM gpar",
    "grandchildren": "SELECT grandparent AS id, id AS grandchild FROM gpar",
    "inlaws": "SELECT * FROM inl",
    "symmetric_edges": "SELECT * FROM spouse_sym",
    "ego_fixed_nodes": f"SELECT ego, id, kin FROM ({_FIXED}) UNION ALL {_CLUSTERS}",
    "ego_fixed_edges": f"""SELECT * FROM (WITH fx AS ({_FIXED}), cl AS ({_CLUSTERS})
  SELECT DISTINCT x.ego, c.child AS source, c.parent AS target, 'CHILD_OF' AS type FROM fx x JOIN child_of c ON c.child = x.id JOIN fx y ON y.ego = x.ego AND y.id = c.parent
  UNION ALL SELECT DISTINCT x.ego, s.a, s.b, 'SPOUSE_OF' FROM fx x JOIN spouse_of s ON s.a = x.id JOIN fx y ON y.ego = x.ego AND y.id = s.b
  UNION ALL SELECT c.ego, c.id, coalesce(f.id, c.ego), 'ancestor' FROM cl c LEFT JOIN fx f ON f.ego = c.ego AND f.o = 2 WHERE c.kin = 'grandparents'
  UNION ALL SELECT c.ego, c.id, coalesce(f.id, c.ego), 'descendant' FROM cl c LEFT JOIN fx f ON f.ego = c.ego AND f.o = 3 WHERE c.kin = 'grandchildren'
  UNION ALL SELECT c.ego, c.id, f.id, 'in-law' FROM cl c JOIN fx f ON f.ego = c.ego AND f.o = 1 WHERE c.kin = 'inlaws')""",
    "kin_terms_en": f"SELECT path, sex, n, {kin_en('path', 'sex')} AS kin FROM ({_PATHS})",
    "kin_terms_ar": f"SELECT path, sex, n, {kin_ar('path', 'sex')} AS kin FROM ({_PATHS})",
    "ego_cluster": f"SELECT path, sex, n, CASE WHEN kin LIKE '%-in-law%' OR kin = 'spouse' THEN 'inlaws' WHEN kin IN ('grandfather', 'grandmother', 'grandparent') THEN 'ancestors' WHEN kin IN ('grandson', 'granddaughter', 'grandchild') THEN 'descendants' END AS cluster FROM (SELECT path, sex, n, {kin_en('path', 'sex')} AS kin FROM ({_PATHS}))",
    "relation_label": f"SELECT DISTINCT code, {RELATION.format('code')} AS en, {_REL_AR} AS ar FROM (SELECT lookup_family_relationship_id AS code FROM req)",
    "edge_label": "SELECT DISTINCT type, CASE type WHEN 'CHILD_OF' THEN 'Child of' WHEN 'SPOUSE_OF' THEN 'Spouse of' END AS label FROM tier_edges",
    "first_words": r"SELECT doc_id, array_to_string(list_slice(regexp_split_to_array(trim(text), '\s+'), 1, 2), ' ') AS words FROM documents",
    "name_search_terms": """SELECT term, id, label FROM people, (VALUES ('CUSTOMER#00000001'), ('customer'), ('0123'), ('#000000'), ('99'), ('er#00000001'), ('x'), ('nobody'), ('')) t(term) WHERE contains(lower(label), lower(term))""",
    "name_search": "SELECT id, label FROM people WHERE lower(label) LIKE '%customer#00000001%'",
    "ego_citizen_nodes": "SELECT * FROM ego_nodes",
    "ego_citizen_edges": "SELECT * FROM ego_edges",
    "ego_resident_nodes": "SELECT * FROM net_nodes",
    "ego_resident_edges": "SELECT * FROM net_edges",
    "tree_resident_relations": """SELECT e.*, r.relation FROM (SELECT DISTINCT x.ego, s.child AS source, s.parent AS target, 'SPONSORED_BY' AS type FROM rtree x JOIN spon s ON s.child = x.id JOIN rtree y ON y.ego = x.ego AND y.id = s.parent) e LEFT JOIN (SELECT sponsored_entity_person_id AS c, sponsor_entity_person_id AS p, min(relation_to_sponsor) AS relation FROM slinks_r GROUP BY 1, 2) r ON r.c = e.source AND r.p = e.target""",
    "tree_five_tier_nodes": "SELECT * FROM tier_nodes",
    "tree_five_tier_edges": "SELECT * FROM tier_edges",
    "tree_citizen_kin": "SELECT * FROM ctree",
    "tree_resident": "SELECT * FROM rtree",
    "tree_resident_edges": "SELECT DISTINCT x.ego, s.child AS source, s.parent AS target, 'SPONSORED_BY' AS type FROM rtree x JOIN spon s ON s.child = x.id JOIN rtree y ON y.ego = x.ego AND y.id = s.parent",
    "tree_unified": "SELECT ego, id, label, sex, person_type FROM ctree UNION ALL SELECT * FROM rtree WHERE ego NOT IN (SELECT ego FROM ctree)",
    "sponsored_family": "SELECT parent AS sponsor, count(*) AS n, string_agg(child, ',' ORDER BY child) AS sponsored FROM spon GROUP BY 1",
    "lca_pairs": "SELECT a, b, ancestor_id, full_name, da, db, total_depth FROM lca",
    "lca_topk": "SELECT * FROM lca WHERE rank <= 1",
    "relationships_of": """SELECT DISTINCT * FROM (SELECT ego, 'parent' AS relation, target AS id FROM tier_edges WHERE type = 'CHILD_OF' AND source = ego UNION ALL SELECT ego, 'child', source FROM tier_edges WHERE type = 'CHILD_OF' AND target = ego
  UNION ALL SELECT ego, 'spouse', CASE WHEN source = ego THEN target ELSE source END FROM tier_edges WHERE type = 'SPOUSE_OF' AND ego IN (source, target))""",
    "layout_five_tier": _LAYOUT,
    "layout_cluster_members": "SELECT * FROM clustered",
    "layout_clusters": """SELECT m.ego, '__cluster_' || cluster || '__' AS id, count(*) AS n, CAST(round(CASE cluster WHEN 'grandparents_f' THEN -2.88 WHEN 'grandparents_m' THEN 2.88 WHEN 'grandchildren' THEN 0
    ELSE (coalesce(any_value(w.k) + 1.5, 2.5)) * 3.2 END, 6) AS DOUBLE) AS x, CAST(CASE cluster WHEN 'inlaws' THEN -1.8 WHEN 'grandchildren' THEN 3.6 ELSE -3.6 END AS DOUBLE) AS y
  FROM clustered m LEFT JOIN (SELECT ego, count(*) AS k FROM tier_nodes WHERE kin IN ('husband', 'wife', 'spouse') GROUP BY 1) w ON w.ego = m.ego GROUP BY m.ego, cluster""",
    "layout_cluster_edges": """SELECT c.ego, '__cluster_' || c.cluster || '__' AS source, coalesce(t.id, c.ego) AS target, CASE c.cluster WHEN 'inlaws' THEN 'IN_LAW' WHEN 'grandchildren' THEN 'DESCENDANT' WHEN 'grandparents_f' THEN 'PATERNAL_GP' ELSE 'MATERNAL_GP' END AS type
  FROM (SELECT DISTINCT ego, cluster FROM clustered) c LEFT JOIN (SELECT ego, id, 'inlaws' AS cluster FROM tier_nodes WHERE kin IN ('husband', 'wife', 'spouse') UNION ALL SELECT ego, id, 'grandchildren' FROM tier_nodes WHERE kin IN ('son', 'daughter', 'child')
    UNION ALL SELECT ego, fa, 'grandparents_f' FROM elders UNION ALL SELECT ego, mo, 'grandparents_m' FROM elders) t ON t.ego = c.ego AND t.cluster = c.cluster""",
    "layout_bounds": f"SELECT ego, min(x) AS min_x, max(x) AS max_x, min(y) AS min_y, max(y) AS max_y, round((min(x) + max(x)) / 2, 6) AS mid_x, round((min(y) + max(y)) / 2, 6) AS mid_y FROM ({_LAYOUT}) GROUP BY 1",
    "upsert_merge": """SELECT id, label, 'old' AS state FROM people WHERE id IN (SELECT child FROM child_of) AND id NOT IN (SELECT parent FROM child_of WHERE parent IS NOT NULL)
  UNION ALL SELECT id, upper(label), 'new' FROM people WHERE id IN (SELECT parent FROM child_of)""",
    "edge_endpoint_check": "SELECT DISTINCT child AS src, parent AS dst FROM spon WHERE child IN (SELECT entity_person_id FROM res_gold) AND parent IN (SELECT entity_person_id FROM res_gold)",
    "sponsor_autocreate": "SELECT entity_person_id AS id, person_type FROM res_gold UNION ALL SELECT DISTINCT parent, CASE WHEN parent LIKE 'C:%' THEN 'citizen' ELSE 'resident' END FROM spon WHERE parent NOT IN (SELECT entity_person_id FROM res_gold)",
    "payload_roundtrip": "SELECT n.ego, n.nodes, coalesce(e.edges, 0) AS edges FROM (SELECT ego, count(*) AS nodes FROM ego_nodes GROUP BY 1) n LEFT JOIN (SELECT ego, count(*) AS edges FROM ego_edges GROUP BY 1) e USING (ego)",
    "payload_adjacency": "SELECT DISTINCT ego, target AS a, source AS b, type AS kind FROM ego_edges",
    "dup_entities_having": "SELECT entity_person_id, count(*) AS n FROM cit_alias GROUP BY 1 HAVING count(*) > 1",
    "count_by_person_type": "SELECT person_type, count(*) AS n FROM (SELECT person_type FROM cit_gold UNION ALL SELECT person_type FROM res_gold) GROUP BY 1",
    "cache_coverage": "SELECT count(*) AS persons, count(child) AS cached, CAST(round(count(child) * 100.0 / count(*), 2) AS DOUBLE) AS percent FROM cit_gold LEFT JOIN (SELECT DISTINCT child_entity_person_id AS child FROM plinks) ON child = entity_person_id",
    "top_parents": _TOP.format(k="parent_entity_person_id", t="plinks"),
    "largest_books": _TOP.format(k="family_book_id", t="membership"),
    "top_sponsors": _TOP.format(k="sponsor_entity_person_id", t="slinks_r"),
    "latest_cached": "SELECT entity_person_id, length(full_name) AS json_chars, updated_at AS generated_at FROM cit_gold ORDER BY updated_at DESC NULLS LAST, entity_person_id LIMIT 20",
    "kin_group_counts": """SELECT CASE WHEN kin = 'self' THEN 'self' WHEN kin IN ('father', 'mother', 'parent') THEN 'parents' WHEN kin IN ('son', 'daughter', 'child') THEN 'children' WHEN kin IN ('spouse', 'husband', 'wife') THEN 'spouses'
  WHEN kin IN ('brother', 'sister', 'sibling') THEN 'siblings' WHEN kin IN ('grandfather', 'grandmother', 'grandparent') THEN 'grandparents' ELSE 'other' END AS kin_group, count(*) AS n FROM ego_nodes GROUP BY 1""",
}

SQL = {name: sql(text) for name, text in _FINAL.items()}
