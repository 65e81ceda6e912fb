"""DuckDB SQL with the same meaning as the queries, written apart from them: named subqueries that refer to each other."""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}


def part(name: str, sql: str) -> None:
    PARTS[name] = sql


def sql(final: str, recursive: bool = False) -> str:
    """``final`` with all subqueries that it needs, in order."""
    need: set[str] = set()
    todo = [final]
    while todo:
        text = todo.pop()
        for name in PARTS:
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(PARTS[name])
    ctes = ",\n".join(f"{n} AS ({PARTS[n]})" for n in PARTS if n in need)
    return f"WITH {'RECURSIVE ' if recursive or 'RECURSE' in ctes else ''}{ctes}\n{final}" if ctes else final


# ------------------------------------------------------------------ bronze

part(
    "pedigree",
    """SELECT k, fa, CASE WHEN k % 4 = 3 AND fa % 4 = 0 THEN fa + 29 ELSE fa + 31 END AS mo
  FROM (SELECT c_custkey AS k, CASE WHEN c_custkey >= 40 THEN ((c_custkey - 40) // 4) * 2 END AS fa FROM customer)""",
)
_PM = """SELECT c_custkey AS k, 'P' || lpad(CAST(c_custkey + {shift} AS VARCHAR), 10, '0') AS spm_person_no,
    {aname} || c_name AS spm_full_aname, CASE WHEN c_custkey % 19 <> 2 THEN '  ' || c_name || ' ' END AS spm_full_ename,
    CASE WHEN c_custkey % 29 = 5 THEN 'unknown' WHEN c_custkey % 11 <> 4 THEN CAST(DATE '1950-01-01' + CAST(c_custkey * 37 % 20000 AS INTEGER) AS VARCHAR) END AS spm_dob,
    CASE WHEN c_custkey % 13 = 0 THEN '  ' WHEN c_custkey % 5 <> 3 THEN '784{dash}' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') || ' 1' END AS spm_national_id,
    CASE WHEN c_custkey % 17 <> 9 THEN 1 + c_custkey % 2 END AS spm_gender, {place} AS spm_place_of_birth_eng, c_nationkey AS nat_code_curr_nat,
    CAST(c_custkey % 7 AS INTEGER) AS emi_code, {cit} AS cit_code,
    CASE WHEN c_custkey % 4 <> 1 THEN 'n' || CAST(100000 + c_custkey AS VARCHAR) END AS passport, '+971 50-' || CAST(1000000 + c_custkey AS VARCHAR) AS mobile,
    'Person' || CAST(c_custkey AS VARCHAR) || '@Example.org' AS email, {modified} AS spm_modified_date, TIMESTAMP '2019-01-01' + to_minutes(c_custkey) AS spm_created_date
  FROM customer"""
part(
    "pm",
    _PM.format(shift=0, aname="'ar '", dash="-", place="c_mktsegment", cit="CAST(c_custkey % 10 AS INTEGER)", modified="CASE WHEN c_custkey % 3 <> 0 THEN TIMESTAMP '2020-01-01' + to_hours(c_custkey) END")
    + " UNION ALL "
    + _PM.format(shift=1000000, aname="' AR '", dash="", place="CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END", cit="CAST(NULL AS INTEGER)", modified="TIMESTAMP '2021-01-01' + to_hours(c_custkey)")
    + " WHERE c_custkey % 7 = 0",
)
part(
    "books",
    """SELECT DISTINCT fa AS book, fa AS k, CAST(NULL AS BIGINT) AS fa, CAST(NULL AS BIGINT) AS mo, 1 AS rel1 FROM pedigree WHERE fa IS NOT NULL
  UNION ALL SELECT DISTINCT fa, mo, NULL, NULL, 2 FROM pedigree WHERE fa IS NOT NULL
  UNION ALL SELECT fa, k, fa, mo, CASE WHEN k % 2 = 0 THEN 3 ELSE 4 END FROM pedigree WHERE fa IS NOT NULL""",
)
part(
    "detail",
    """SELECT 'P' || lpad(CAST(CASE WHEN rel1 >= 3 AND k % 14 = 0 THEN k + 1000000 ELSE k END AS VARCHAR), 10, '0') AS me, 'P' || lpad(CAST(fa AS VARCHAR), 10, '0') AS father,
    'P' || lpad(CAST(mo AS VARCHAR), 10, '0') AS mother, 'F' || lpad(CAST(book AS VARCHAR), 6, '0') AS crm_seq, rel1 FROM books""",
)
part("master", "SELECT crm_seq, me AS head FROM detail WHERE rel1 = 1")
part(
    "req",
    """SELECT CASE WHEN o_custkey % 9 = 4 THEN 'R' || lpad(CAST(o_custkey % 200 AS VARCHAR), 8, '0') WHEN o_custkey % 23 <> 1 THEN 'P' || lpad(CAST(o_custkey AS VARCHAR), 10, '0') END AS sponsor_number,
    o_orderkey AS id, CASE WHEN o_orderkey % 6 <> 5 THEN ' Resident ' || CAST(o_orderkey AS VARCHAR) END AS english_full_name, 'ar resident ' || CAST(o_orderkey AS VARCHAR) AS arabic_full_name,
    CAST(DATE '1960-01-01' + CAST(o_orderkey * 13 % 15000 AS INTEGER) AS VARCHAR) AS date_of_birth,
    CASE WHEN o_orderkey % 4 <> 1 THEN 'p-' || CAST(o_orderkey % 900 AS VARCHAR) || ' x' END AS passport_number, '050' || CAST(o_orderkey AS VARCHAR) AS local_mobile_number,
    'r' || CAST(o_orderkey AS VARCHAR) || '@example.org' AS email_address, CAST(o_custkey % 25 AS INTEGER) AS lookup_curr_nationality_id,
    CASE WHEN o_orderkey % 15 <> 7 THEN CAST(1 + o_orderkey % 2 AS INTEGER) END AS lookup_gender_id, substr(o_orderpriority, 1, 1) AS lookup_family_relationship_id, o_orderdate AS creation_date FROM orders""",
)
part(
    "joined",
    """SELECT a.*, lower(r.r_name) || '_2' AS person_to_sponsor_relation,
    CASE WHEN rt.l_orderkey % 5 <> 2 THEN 'R' || lpad(CAST(rt.l_orderkey AS VARCHAR), 8, '0') END AS spm_person_no,
    CASE WHEN rt.l_linenumber <> 2 THEN rt.l_shipdate END AS rtr_create_date, rt.l_linenumber AS rma_seqno, 2000 + rt.l_linenumber AS rma_year
  FROM req a JOIN orders o ON o.o_orderkey = a.id AND (o.o_orderstatus = 'F' OR o.o_orderkey % 3 = 0)
  JOIN lineitem ra ON ra.l_orderkey = a.id AND ra.l_linenumber <= 2 JOIN lineitem rt ON rt.l_orderkey = ra.l_orderkey AND rt.l_linenumber = ra.l_linenumber
  LEFT JOIN region r ON r.r_regionkey = TRY_CAST(a.lookup_family_relationship_id AS INTEGER)
  WHERE a.lookup_family_relationship_id IN ('2', '3', '4')""",
)

# ------------------------------------------------------------------ resolution

part(
    "cit_norm",
    r"""SELECT *, lower(trim(spm_full_aname)) AS name_ar_norm, lower(trim(spm_full_ename)) AS name_en_norm, TRY_CAST(spm_dob AS DATE) AS dob_norm,
    nullif(regexp_replace(spm_national_id, '[\s\-]+', '', 'g'), '') AS national_id_norm, CAST(spm_gender AS VARCHAR) AS gender_norm FROM pm""",
)
part(
    "cit_key",
    """SELECT *, CASE WHEN national_id_norm IS NOT NULL AND dob_norm IS NOT NULL THEN 'NID|' || national_id_norm || '|' || CAST(dob_norm AS VARCHAR)
      WHEN name_ar_norm IS NOT NULL AND dob_norm IS NOT NULL AND gender_norm IS NOT NULL THEN 'NAME|' || name_ar_norm || '|' || CAST(dob_norm AS VARCHAR) || '|' || gender_norm
      ELSE spm_person_no END AS cluster_key FROM cit_norm""",
)
part("cit_ent", "SELECT *, 'C:' || sha256(cluster_key) AS eid FROM cit_key")
_has = lambda cols: " + ".join(f"CASE WHEN {c} IS NOT NULL AND CAST({c} AS VARCHAR) <> '' THEN 1 ELSE 0 END" for c in cols)
_not_null = lambda cols: " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in cols)
part(
    "cit_gold",
    f"""SELECT eid AS entity_person_id, spm_person_no AS primary_spm_person_no, spm_full_aname AS full_name_ar, spm_full_ename AS full_name_en, coalesce(spm_full_ename, spm_full_aname) AS full_name,
    CASE spm_gender WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS sex, spm_dob AS dob, spm_national_id AS national_id, spm_place_of_birth_eng AS place_of_birth, nat_code_curr_nat AS nationality_code,
    emi_code AS emirate_code, cit_code AS city_code, CAST(up AS VARCHAR) AS updated_at, score AS completeness, 'citizen' AS person_type
  FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY score DESC, up DESC NULLS LAST, spm_person_no) AS r
    FROM (SELECT *, coalesce(spm_modified_date, spm_created_date) AS up,
      {_has(["spm_full_aname", "spm_full_ename", "spm_gender", "spm_dob", "spm_national_id", "spm_place_of_birth_eng", "nat_code_curr_nat", "emi_code", "cit_code"])} AS score FROM cit_ent)) WHERE r = 1""",
)
part("cit_score", f"SELECT spm_person_no AS primary_spm_person_no, {_has(['spm_full_aname', 'spm_full_ename', 'spm_gender', 'spm_dob', 'spm_national_id', 'spm_place_of_birth_eng', 'nat_code_curr_nat', 'emi_code', 'cit_code'])} AS completeness FROM pm")
part("cit_alias", "SELECT eid AS entity_person_id, spm_person_no, cluster_key, CAST(CASE WHEN cluster_key LIKE 'NID|%' THEN 1.0 WHEN cluster_key LIKE 'NAME|%' THEN 0.9 ELSE 0.8 END AS DOUBLE) AS confidence, 'person_master' AS source FROM cit_ent")
part("basic", "SELECT spm_person_no, spm_full_ename AS full_name, CASE spm_gender WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS sex, spm_dob AS dob, spm_national_id AS national_id, passport, mobile, email, coalesce(spm_modified_date, spm_created_date) AS updated_at FROM pm")
part(
    "basic_key",
    r"""SELECT *, CASE WHEN nid IS NOT NULL THEN concat_ws('|', 'NID', nid, lower(full_name), CAST(TRY_CAST(dob AS DATE) AS VARCHAR))
      WHEN passport IS NOT NULL THEN concat_ws('|', 'PASS', upper(passport), lower(full_name), CAST(TRY_CAST(dob AS DATE) AS VARCHAR)) ELSE spm_person_no END AS cluster_key
    FROM (SELECT *, nullif(regexp_replace(national_id, '\s+', '', 'g'), '') AS nid FROM basic)""",
)
part("basic_ent", "SELECT *, sha1(coalesce(cluster_key, '')) AS eid FROM basic_key")
part(
    "basic_gold",
    f"""SELECT eid AS entity_person_id, spm_person_no AS primary_spm_person_no, full_name, sex, dob, national_id, passport, mobile, email, CAST(updated_at AS VARCHAR) AS updated_at, score AS completeness
  FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY score DESC, updated_at DESC NULLS LAST, spm_person_no) AS r
    FROM (SELECT *, {_not_null(["full_name", "sex", "dob", "national_id", "passport", "mobile", "email", "spm_person_no", "updated_at"])} AS score FROM basic_ent)) WHERE r = 1""",
)
part(
    "res_ent",
    r"""SELECT *, 'R:' || sha256(cluster_key) AS eid FROM (SELECT *, CASE WHEN spm_person_no IS NOT NULL THEN 'SPM|' || spm_person_no
      WHEN passport_norm IS NOT NULL AND TRY_CAST(date_of_birth AS DATE) IS NOT NULL THEN 'PASS|' || passport_norm || '|' || CAST(TRY_CAST(date_of_birth AS DATE) AS VARCHAR)
      ELSE concat_ws('|', 'REQ', CAST(id AS VARCHAR), sponsor_number) END AS cluster_key
    FROM (SELECT *, upper(nullif(regexp_replace(passport_number, '[\s\-]+', '', 'g'), '')) AS passport_norm FROM joined))""",
)
part(
    "res_gold",
    """SELECT eid AS entity_person_id, spm_person_no AS primary_spm_person_no, arabic_full_name AS full_name_ar, english_full_name AS full_name_en, coalesce(english_full_name, arabic_full_name) AS full_name,
    CASE lookup_gender_id WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS sex, date_of_birth AS dob, passport_number AS passport, local_mobile_number AS mobile, email_address AS email,
    lookup_curr_nationality_id AS nationality_code, sponsor_number, person_to_sponsor_relation AS relation_to_sponsor, lookup_family_relationship_id AS relationship_code,
    rma_seqno AS residency_seq, rma_year AS residency_year, CAST(up AS VARCHAR) AS updated_at, 'resident' AS person_type
  FROM (SELECT *, row_number() OVER (PARTITION BY eid ORDER BY up DESC NULLS LAST, id, rma_seqno) AS r FROM (SELECT *, coalesce(rtr_create_date, creation_date) AS up FROM res_ent)) WHERE r = 1""",
)
part("res_alias", "SELECT DISTINCT eid AS entity_person_id, spm_person_no, CAST(1.0 AS DOUBLE) AS confidence, 'echannels_residency_requests' AS source FROM res_ent WHERE spm_person_no IS NOT NULL")

# ------------------------------------------------------------------ links

part(
    "plinks",
    """SELECT parent_entity_person_id, child_entity_person_id, min(t) AS parent_type, 'crd_' || min(t) AS source, CAST(1.0 AS DOUBLE) AS confidence FROM (
    SELECT p.entity_person_id AS parent_entity_person_id, c.entity_person_id AS child_entity_person_id, 'father' AS t FROM detail d JOIN cit_alias c ON c.spm_person_no = d.me JOIN cit_alias p ON p.spm_person_no = d.father
    UNION ALL SELECT p.entity_person_id, c.entity_person_id, 'mother' FROM detail d JOIN cit_alias c ON c.spm_person_no = d.me JOIN cit_alias p ON p.spm_person_no = d.mother) GROUP BY 1, 2""",
)
part(
    "slinks",
    """SELECT DISTINCT h.entity_person_id AS husband_entity_person_id, w.entity_person_id AS wife_entity_person_id, 'rel1_code=2' AS source, CAST(0.9 AS DOUBLE) AS confidence
  FROM master m JOIN cit_alias h ON h.spm_person_no = m.head JOIN detail d ON d.crm_seq = m.crm_seq AND d.rel1 = 2 JOIN cit_alias w ON w.spm_person_no = d.me WHERE h.entity_person_id <> w.entity_person_id""",
)
part("spouse_of", "SELECT DISTINCT least(h.me, w.me) AS a, greatest(h.me, w.me) AS b FROM detail h JOIN detail w ON h.crm_seq = w.crm_seq AND h.rel1 = 1 AND w.rel1 = 2")
part("spouse_sym", "SELECT a, b FROM spouse_of UNION SELECT b, a FROM spouse_of")
part("child_of", "SELECT me AS child, father AS parent FROM detail WHERE father IS NOT NULL UNION SELECT me, mother FROM detail WHERE mother IS NOT NULL")
part("people", "SELECT spm_person_no AS id, coalesce(spm_full_ename, spm_full_aname) AS label, CASE spm_gender WHEN 1 THEN 'M' WHEN 2 THEN 'F' END AS sex FROM pm")
part(
    "membership",
    """SELECT entity_person_id, crm_seq, 'FAM:' || crm_seq AS family_book_id, min(s) AS source FROM (
    SELECT a.entity_person_id, d.crm_seq, 'crd' AS s FROM detail d JOIN cit_alias a ON a.spm_person_no = d.me UNION ALL SELECT a.entity_person_id, m.crm_seq, 'crm' FROM master m JOIN cit_alias a ON a.spm_person_no = m.head) GROUP BY 1, 2""",
)
part("sponsors", "SELECT spm_person_no AS sponsor_spm, entity_person_id AS sponsor_entity_id, 'citizen' AS sponsor_type FROM cit_alias UNION ALL SELECT spm_person_no, entity_person_id, 'resident' FROM res_alias")
part(
    "slinks_r",
    """SELECT DISTINCT s.sponsor_entity_id AS sponsor_entity_person_id, r.entity_person_id AS sponsored_entity_person_id, r.relation_to_sponsor, r.relationship_code, s.sponsor_type, 'echannels_residency' AS source, CAST(1.0 AS DOUBLE) AS confidence
  FROM res_gold r JOIN sponsors s ON s.sponsor_spm = r.sponsor_number""",
)
part("fgroups", "SELECT DISTINCT r.entity_person_id, s.sponsor_entity_id AS sponsor_id, r.sponsor_number, 'SPON:' || r.sponsor_number AS family_group_id, 'sponsorship' AS source FROM res_gold r JOIN sponsors s ON s.sponsor_spm = r.sponsor_number")
part("sibs", "SELECT DISTINCT x.child AS id, y.child AS sibling FROM child_of x JOIN child_of y ON x.parent = y.parent AND x.child <> y.child")
part("gpar", "SELECT DISTINCT x.child AS id, y.parent AS grandparent FROM child_of x JOIN child_of y ON y.child = x.parent")
part("inl", "SELECT DISTINCT s.a AS id, c.parent AS inlaw FROM spouse_sym s JOIN child_of c ON c.child = s.b WHERE NOT EXISTS (SELECT 1 FROM child_of o WHERE o.child = s.a AND o.parent = c.parent)")


def sexed(m: str, f: str, x: str, sex: str = "sex") -> str:
    return f"CASE {sex} WHEN 'M' THEN '{m}' WHEN 'F' THEN '{f}' ELSE '{x}' END"


# ------------------------------------------------------------------ kin terms


def kin_en(path: str, sex: str) -> str:
    u, d, s = (f"(length({path}) - length(replace({path}, '{x}', '')))" for x in "UDS")
    k = f"(least({u}, {d}) - 1)"
    away = f"abs({u} - {d})"
    nth = f"CASE {k} WHEN 1 THEN 'first' WHEN 2 THEN 'second' WHEN 3 THEN 'third' WHEN 4 THEN 'fourth' ELSE CAST({k} AS VARCHAR) || 'th' END"
    removed = f"CASE {away} WHEN 0 THEN '' WHEN 1 THEN ' once removed' WHEN 2 THEN ' twice removed' ELSE ' ' || CAST({away} AS VARCHAR) || ' times removed' END"
    cousin = f"{nth} || ' cousin' || {removed}"
    return f"""CASE WHEN {path} = '' THEN 'self' WHEN {u} = 0 AND {d} = 0 THEN 'spouse'
      WHEN {u} = 1 AND {d} = 0 THEN {sexed('father', 'mother', 'parent', sex)} WHEN {u} = 2 AND {d} = 0 THEN {sexed('grandfather', 'grandmother', 'grandparent', sex)}
      WHEN {u} = 0 AND {d} = 1 THEN {sexed('son', 'daughter', 'child', sex)} WHEN {u} = 0 AND {d} = 2 THEN {sexed('grandson', 'granddaughter', 'grandchild', sex)}
      WHEN {u} = 1 AND {d} = 1 AND {s} = 0 THEN {sexed('brother', 'sister', 'sibling', sex)}
      WHEN {u} = 1 AND {d} = 2 THEN {sexed('nephew', 'niece', 'nibling', sex)} WHEN {u} = 2 AND {d} = 1 THEN {sexed('uncle', 'aunt', 'aunt/uncle', sex)}
      WHEN {u} >= 2 AND {d} >= 2 AND {s} = 0 THEN {cousin}
      WHEN {s} >= 1 AND {u} = 1 AND {d} = 1 THEN {sexed('brother', 'sister', 'sibling', sex)} || '-in-law'
      WHEN {s} >= 1 AND {u} >= 2 AND {d} >= 2 THEN {cousin} || '-in-law' WHEN {s} >= 1 THEN 'relative-in-law' ELSE 'relative' END"""


def kin_ar(path: str, sex: str) -> str:
    u, d, s = (f"(length({path}) - length(replace({path}, '{x}', '')))" for x in "UDS")
    cousin = f"CASE WHEN {sex} = 'M' THEN 'ابن العم/الخال' ELSE 'ابنة العم/الخالة' END"
    sibling = sexed("الأخ", "الأخت", "الأخ/الأخت", sex)
    return f"""CASE WHEN {path} = '' THEN 'أنا' WHEN {u} = 0 AND {d} = 0 THEN 'زوج/زوجة'
      WHEN {u} = 1 AND {d} = 0 THEN {sexed('الأب', 'الأم', 'الوالد', sex)} WHEN {u} = 2 AND {d} = 0 THEN {sexed('الجد', 'الجدة', 'الجد/الجدة', sex)}
      WHEN {u} = 0 AND {d} = 1 THEN {sexed('الابن', 'الابنة', 'الابن/الابنة', sex)} WHEN {u} = 0 AND {d} = 2 THEN {sexed('الحفيد', 'الحفيدة', 'الحفيد/الحفيدة', sex)}
      WHEN {u} = 1 AND {d} = 1 AND {s} = 0 THEN {sibling}
      WHEN {u} = 1 AND {d} = 2 THEN {sexed('ابن الأخ/الأخت', 'ابنة الأخ/الأخت', 'ابنة الأخ/الأخت', sex)} WHEN {u} = 2 AND {d} = 1 THEN {sexed('العم/الخال', 'العمة/الخالة', 'العمة/الخالة', sex)}
      WHEN {u} >= 2 AND {d} >= 2 AND {s} = 0 THEN {cousin}
      WHEN {s} >= 1 AND {u} = 1 AND {d} = 1 THEN {sibling} || ' (نسَب)' WHEN {s} >= 1 AND {u} >= 2 AND {d} >= 2 THEN {cousin} || ' (نسَب)' WHEN {s} >= 1 THEN 'قريب (نسَب)' ELSE 'قريب' END"""


# ------------------------------------------------------------------ citizens' ego networks, level by level

DEPTH, SPOUSE_ROUNDS = 3, 4
part("ego_steps", """SELECT DISTINCT * FROM (SELECT child_entity_person_id AS f, parent_entity_person_id AS t, 'U' AS kind FROM plinks UNION ALL SELECT parent_entity_person_id, child_entity_person_id, 'D' FROM plinks
  UNION ALL SELECT husband_entity_person_id, wife_entity_person_id, 'S' FROM slinks UNION ALL SELECT wife_entity_person_id, husband_entity_person_id, 'S' FROM slinks)""")
part("ego_people", "SELECT entity_person_id AS id, coalesce(full_name_en, full_name) AS label, sex FROM cit_gold")
_BEST = "SELECT ego, id, min(n) AS n, arg_min(path, (n, path)) AS path FROM ({}) GROUP BY ego, id"
_seen = None
for _g in range(DEPTH + 1):
    _not_seen = f" WHERE NOT EXISTS (SELECT 1 FROM {_seen} z WHERE z.ego = y.ego AND z.id = y.id)" if _seen else ""
    if _g:
        part(f"ego_{_g}_0", _BEST.format(f"SELECT * FROM (SELECT x.ego, s.t AS id, x.n + 1 AS n, x.path || s.kind AS path FROM ego_{_g - 1}_{SPOUSE_ROUNDS} x JOIN ego_steps s ON s.f = x.id AND s.kind <> 'S') y{_not_seen}"))
    else:
        part("ego_0_0", "SELECT id AS ego, id, 0 AS n, '' AS path FROM ego_people")
    for _r in range(1, SPOUSE_ROUNDS + 1):
        part(f"ego_{_g}_{_r}", _BEST.format(f"SELECT * FROM ego_{_g}_{_r - 1} UNION ALL SELECT * FROM (SELECT x.ego, s.t AS id, x.n + 1 AS n, x.path || s.kind AS path FROM ego_{_g}_{_r - 1} x JOIN ego_steps s ON s.f = x.id AND s.kind = 'S') y{_not_seen}"))
    part(f"ego_seen_{_g}", (f"SELECT * FROM {_seen} UNION ALL " if _seen else "") + f"SELECT ego, id, {_g} AS g, path FROM ego_{_g}_{SPOUSE_ROUNDS}")
    _seen = f"ego_seen_{_g}"
part("ego_reach", f"SELECT r.ego, r.id, r.g, CASE WHEN r.ego = r.id THEN '' ELSE r.path END AS path, p.label, p.sex FROM {_seen} r LEFT JOIN ego_people p ON p.id = r.id")
part("ego_kin", f"SELECT ego, id, coalesce(label, id) AS label, sex, {kin_en('path', 'sex')} AS kin FROM ego_reach")
part("ego_nodes", """SELECT *, CASE WHEN kin LIKE '%-in-law%' OR kin = 'spouse' THEN 'inlaws' WHEN kin IN ('grandfather', 'grandmother', 'grandparent') THEN 'ancestors'
  WHEN kin IN ('grandson', 'granddaughter', 'grandchild') THEN 'descendants' END AS cluster FROM ego_kin""")
part(
    "ego_edges",
    f"""SELECT DISTINCT ego, source, target, type FROM (SELECT r.ego, s.kind, CASE s.kind WHEN 'D' THEN s.t ELSE s.f END AS source, CASE s.kind WHEN 'D' THEN s.f ELSE s.t END AS target,
    CASE s.kind WHEN 'S' THEN 'SPOUSE_OF' ELSE 'CHILD_OF' END AS type FROM ego_reach r JOIN ego_steps s ON s.f = r.id WHERE s.kind = 'S' OR r.g < {DEPTH}) UNION
    SELECT DISTINCT r.ego, s.t, s.f, 'SPOUSE_OF' FROM ego_reach r JOIN ego_steps s ON s.f = r.id WHERE s.kind = 'S'""",
)

# ------------------------------------------------------------------ residents' ego networks

RELATION = "CASE {} WHEN '2' THEN 'wife' WHEN '3' THEN 'son' WHEN '4' THEN 'daughter' WHEN '5' THEN 'brother' WHEN '6' THEN 'sister' WHEN '7' THEN 'father' WHEN '8' THEN 'mother' WHEN '9' THEN 'other_family_member' ELSE 'family_member' END"
part(
    "net_moves",
    f"""SELECT sponsored_entity_person_id AS f, t, 1 AS way, CASE k WHEN 'citizen' THEN 'citizen_sponsor' ELSE 'resident_sponsor' END AS role, rel AS relation FROM (
    SELECT sponsored_entity_person_id, sponsor_entity_person_id AS t, sponsor_type AS k, relation_to_sponsor AS rel, row_number() OVER (PARTITION BY sponsored_entity_person_id ORDER BY sponsor_type, sponsor_entity_person_id, relation_to_sponsor NULLS FIRST) AS r FROM slinks_r) WHERE r = 1
  UNION ALL SELECT sponsor_entity_person_id, sponsored_entity_person_id, 2, 'sponsored_resident', {RELATION.format('min(relationship_code)')} FROM slinks_r GROUP BY 1, 2
  UNION ALL SELECT DISTINCT a.entity_person_id, b.entity_person_id, 3, 'family_member', {RELATION.format('r.relationship_code')} FROM fgroups a JOIN fgroups b ON a.family_group_id = b.family_group_id AND a.entity_person_id <> b.entity_person_id
    JOIN res_gold r ON r.entity_person_id = b.entity_person_id""",
)
part("net_0", "SELECT entity_person_id AS ego, entity_person_id AS id, CAST(NULL AS VARCHAR) AS f, 0 AS way, 'self' AS role, CAST(NULL AS VARCHAR) AS relation FROM res_gold")
_all = "net_0"
for _d in (1, 2):
    part(
        f"net_{_d}",
        f"""SELECT ego, id, f, way, role, relation FROM (SELECT x.ego, m.t AS id, m.f, m.way, m.role, m.relation, row_number() OVER (PARTITION BY x.ego, m.t ORDER BY m.way, m.f, m.role, m.relation NULLS FIRST) AS r
      FROM net_{_d - 1} x JOIN net_moves m ON m.f = x.id WHERE x.way < 3 AND NOT EXISTS (SELECT 1 FROM {_all} z WHERE z.ego = x.ego AND z.id = m.t)) WHERE r = 1""",
    )
    part(f"net_all_{_d}", f"SELECT * FROM {_all} UNION ALL SELECT * FROM net_{_d}")
    _all = f"net_all_{_d}"
part("net_names", "SELECT entity_person_id AS id, full_name AS label, sex, person_type FROM cit_gold UNION ALL SELECT entity_person_id, full_name, sex, person_type FROM res_gold")
part("net_nodes", f"SELECT x.ego, x.id, coalesce(n.label, x.id) AS label, n.sex, x.role, x.relation, CASE x.way WHEN 0 THEN 'ego' WHEN 1 THEN 'sponsors' WHEN 2 THEN 'sponsored' ELSE 'family' END AS cluster FROM {_all} x LEFT JOIN net_names n ON n.id = x.id")
part("net_edges", f"SELECT ego, CASE way WHEN 2 THEN id ELSE f END AS source, CASE way WHEN 2 THEN f ELSE id END AS target, CASE way WHEN 3 THEN 'SAME_FAMILY_GROUP' ELSE 'SPONSORED_BY' END AS type FROM {_all} WHERE way > 0")

# ------------------------------------------------------------------ trees

part("up2", "SELECT child AS ego, parent AS id FROM child_of UNION SELECT id, grandparent FROM gpar")
part("down2", "SELECT id AS ego, ego AS id FROM up2")
part(
    "tiers",
    f"""SELECT DISTINCT e.ego, p.id, coalesce(p.label, p.id) AS label, p.sex FROM (SELECT id AS ego, id FROM people UNION SELECT a, b FROM spouse_sym UNION SELECT * FROM up2 UNION SELECT * FROM down2 UNION SELECT id, sibling FROM sibs) e
    JOIN people q ON q.id = e.ego JOIN people p ON p.id = e.id""",
)
part("side", "SELECT c.child AS ego, min(c.parent) FILTER (p.sex = 'M') AS fa, min(c.parent) FILTER (p.sex = 'F') AS mo FROM child_of c JOIN people p ON p.id = c.parent GROUP BY 1")
part(
    "tier_nodes",
    f"""SELECT t.*, CASE WHEN ego = id THEN 'self' WHEN (ego, id) IN (SELECT (a, b) FROM spouse_sym) THEN {sexed('husband', 'wife', 'spouse')}
    WHEN (ego, id) IN (SELECT (child, parent) FROM child_of) THEN {sexed('father', 'mother', 'parent')} WHEN (ego, id) IN (SELECT (parent, child) FROM child_of) THEN {sexed('son', 'daughter', 'child')}
    WHEN (ego, id) IN (SELECT (id, sibling) FROM sibs) THEN {sexed('brother', 'sister', 'sibling')}
    WHEN (ego, id) IN (SELECT (s.ego, c.parent) FROM side s JOIN child_of c ON c.child = s.fa) THEN {sexed('paternal grandfather', 'paternal grandmother', 'paternal grandparent')}
    WHEN (ego, id) IN (SELECT (s.ego, c.parent) FROM side s JOIN child_of c ON c.child = s.mo) THEN {sexed('maternal grandfather', 'maternal grandmother', 'maternal grandparent')}
    WHEN (ego, id) IN (SELECT (g.grandparent, g.id) FROM gpar g) THEN {sexed('grandson', 'granddaughter', 'grandchild')} ELSE '' END AS kin FROM tiers t""",
)
part("tier_edges", """SELECT DISTINCT x.ego, c.child AS source, c.parent AS target, 'CHILD_OF' AS type FROM tiers x JOIN child_of c ON c.child = x.id JOIN tiers y ON y.ego = x.ego AND y.id = c.parent
  UNION ALL SELECT DISTINCT x.ego, s.a, s.b, 'SPOUSE_OF' FROM tiers x JOIN spouse_of s ON s.a = x.id JOIN tiers y ON y.ego = x.ego AND y.id = s.b""")
part("shown", "SELECT ego, id, kin FROM tier_nodes UNION ALL SELECT i.id, i.inlaw, 'in-law' FROM inl i WHERE i.id IN (SELECT id FROM people) AND i.inlaw IN (SELECT id FROM people) AND (i.id, i.inlaw) NOT IN (SELECT (ego, id) FROM tier_nodes)")
part("elders", "SELECT ego, min(id) FILTER (kin = 'father') AS fa, min(id) FILTER (kin = 'mother') AS mo FROM tier_nodes GROUP BY 1")
part(
    "clustered",
    """SELECT DISTINCT m.ego, m.cluster, m.id FROM (SELECT e.ego, 'grandparents_f' AS cluster, c.parent AS id FROM elders e JOIN child_of c ON c.child = e.fa
      UNION ALL SELECT e.ego, 'grandparents_m', c.parent FROM elders e JOIN child_of c ON c.child = e.mo
      UNION ALL SELECT w.ego, 'inlaws', c.parent FROM shown w JOIN child_of c ON c.child = w.id WHERE w.kin IN ('husband', 'wife', 'spouse') AND NOT EXISTS (SELECT 1 FROM child_of o WHERE o.child = w.ego AND o.parent = c.parent)
      UNION ALL SELECT k.ego, 'grandchildren', c.child FROM (SELECT s.ego, s.id FROM shown s JOIN child_of o ON o.parent = s.ego AND o.child = s.id) k JOIN child_of c ON c.parent = k.id) m
    JOIN shown s ON s.ego = m.ego AND s.id = m.id""",
)
part("gram_of", "SELECT DISTINCT id, substr(lower(label), i, 3) AS gram FROM (SELECT id, label, unnest(range(1, length(label) - 1)) AS i FROM people)")
part("gram_n", "SELECT gram, count(*) AS n FROM gram_of GROUP BY 1 UNION ALL SELECT '', count(*) FROM people")
part(
    "ctree",
    """SELECT e.ego, e.id, coalesce(p.label, p.id) AS label, p.sex, 'citizen' AS person_type, e.kin FROM (SELECT ego, id, arg_min(kin, o) AS kin FROM (
      SELECT id AS ego, id, 0 AS o, 'self' AS kin FROM people UNION ALL SELECT a, b, 1, 'spouse' FROM spouse_sym UNION ALL SELECT child, parent, 2, 'parent' FROM child_of UNION ALL SELECT parent, child, 2, 'child' FROM child_of
      UNION ALL SELECT id, grandparent, 3, 'relative' FROM gpar UNION ALL SELECT grandparent, id, 3, 'relative' FROM gpar) GROUP BY 1, 2) e JOIN people p ON p.id = e.id JOIN people q ON q.id = e.ego""",
)
part("spon", "SELECT DISTINCT sponsored_entity_person_id AS child, sponsor_entity_person_id AS parent FROM slinks_r")
part(
    "rtree",
    """SELECT DISTINCT e.ego, e.id, coalesce(n.label, n.id) AS label, n.sex, n.person_type FROM (SELECT entity_person_id AS ego, entity_person_id AS id FROM res_gold UNION SELECT child, parent FROM spon UNION SELECT parent, child FROM spon
    UNION SELECT x.child, y.parent FROM spon x JOIN spon y ON y.child = x.parent UNION SELECT y.parent, x.child FROM spon x JOIN spon y ON y.child = x.parent) e JOIN net_names n ON n.id = e.id JOIN res_gold r ON r.entity_person_id = e.ego""",
)
part("pairs", "SELECT DISTINCT 'P' || lpad(CAST(k AS VARCHAR), 10, '0') AS a, 'P' || lpad(CAST(k + 9 AS VARCHAR), 10, '0') AS b FROM pedigree WHERE k + 9 IN (SELECT k FROM pedigree)")
part("anc", """SELECT id, rel, min(d) AS d FROM (WITH RECURSIVE up(id, rel, d) AS (SELECT id, id, 0 FROM people UNION SELECT u.id, c.parent, u.d + 1 FROM up u JOIN child_of c ON c.child = u.rel) SELECT * FROM up) GROUP BY 1, 2""")
part(
    "lca",
    """SELECT p.a, p.b, x.rel AS ancestor_id, n.label AS full_name, x.d AS da, y.d AS db, x.d + y.d AS total_depth, CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY x.d + y.d, x.d, y.d, x.rel) AS INTEGER) AS rank
    FROM pairs p JOIN anc x ON x.id = p.a JOIN anc y ON y.id = p.b AND y.rel = x.rel LEFT JOIN people n ON n.id = x.rel""",
)
