"""DuckDB oracle SQL for the registered queries.

Each statement re-derives the release mapping from the raw tables (the CTE
prelude below) and computes the query's answer independently of the Spark
code path: first-seen labels by ``row_number``, ids by ``row_number`` over the
same sort keys, prefix matching by ``starts_with`` (a nested loop, fine for a
check), variants by regular expressions for depth-1 parentheticals.
"""

from __future__ import annotations

import re

from conceptnorm.functions.names import ABBREVIATION_PATTERN
from conceptnorm.sources.fixtures import FAULTY
from conceptnorm.functions.scalars import CURIE_PATTERN, LOWER_ASCII, UPPER_ASCII, WS_CLASS


def _lower(x: str) -> str:
    return f"translate({x}, '{UPPER_ASCII}', '{LOWER_ASCII}')"


def _s(key: str) -> str:
    return f"CAST({key} AS VARCHAR)"


# the release mapping (sources.fixtures) in SQL
PRELUDE = f"""
mem AS (
  SELECT 'OrganismTaxon.txt' AS file_name, 1 AS file_ord, CAST(n_nationkey AS BIGINT) AS rec_key,
         CAST(0 AS INTEGER) AS pos, 'TAXON:' || {_s('n_nationkey')} AS curie,
         n_name AS label, CAST(NULL AS VARCHAR) AS taxon
  FROM nation
  UNION ALL
  SELECT 'Gene.txt', 2, c_custkey, 0, 'CUST:' || {_s('c_custkey')}, c_name,
         'TAXON:' || CASE WHEN c_custkey % 5 = 0 THEN c_mktsegment ELSE {_s('c_nationkey')} END FROM customer
  UNION ALL
  SELECT 'Gene.txt', 2, c_custkey, 1, 'ENS:' || {_s('c_custkey')}, NULL, NULL
  FROM customer WHERE c_custkey % 3 = 0
  UNION ALL
  SELECT 'MolecularMixture.txt', 3, p_partkey, 0, 'PART:' || {_s('p_partkey')}, p_name, NULL FROM part
  UNION ALL
  SELECT 'MolecularMixture.txt', 3, s.l_partkey,
         CAST(row_number() OVER (PARTITION BY s.l_partkey ORDER BY s.l_suppkey) AS INTEGER),
         'SUPP:' || {_s('s.l_suppkey')}, NULL, NULL
  FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) s
  WHERE s.l_partkey IN (SELECT p_partkey FROM part)
  UNION ALL
  SELECT 'SmallMolecule.txt', 4, s_suppkey, 0, 'SUPP:' || {_s('s_suppkey')}, s_name, NULL FROM supplier
),
recs AS (
  SELECT 'OrganismTaxon.txt' AS file_name, 1 AS file_ord, CAST(n_nationkey AS BIGINT) AS rec_key,
         'biolink:OrganismTaxon' AS type_curie, CAST(NULL AS DOUBLE) AS ic,
         n_name AS preferred_name, 'TAXON:' || {_s('n_nationkey')} AS primary_curie
  FROM nation
  UNION ALL
  SELECT 'Gene.txt', 2, c_custkey, 'biolink:Gene',
         CASE WHEN c_acctbal < 0 THEN NULL ELSE c_acctbal / 100 END, c_name,
         'CUST:' || {_s('c_custkey')} FROM customer
  UNION ALL
  SELECT 'MolecularMixture.txt', 3, p_partkey, 'biolink:' || p_type, CAST(p_size AS DOUBLE),
         p_name, 'PART:' || {_s('p_partkey')} FROM part
  UNION ALL
  SELECT 'SmallMolecule.txt', 4, s_suppkey, 'biolink:Drug', NULL, s_name,
         'SUPP:' || {_s('s_suppkey')} FROM supplier
),
clq AS (SELECT *, row_number() OVER (ORDER BY file_ord, rec_key) AS clique_id FROM recs),
ms AS (
  SELECT m.file_name, m.file_ord, m.rec_key, m.pos, m.curie, m.label, m.taxon,
         c.clique_id, c.primary_curie, c.type_curie, c.ic, c.preferred_name
  FROM mem m JOIN clq c ON c.file_ord = m.file_ord AND c.rec_key = m.rec_key
),
fl AS (
  SELECT curie, label FROM (
    SELECT curie, label, row_number() OVER (PARTITION BY curie ORDER BY clique_id, pos) AS rn
    FROM ms) WHERE rn = 1
),
ident AS (
  SELECT row_number() OVER (ORDER BY curie) AS id, curie, label FROM (
    SELECT curie, label FROM fl
    UNION ALL
    SELECT DISTINCT taxon, 'unknown taxon' FROM ms
    WHERE taxon IS NOT NULL AND taxon NOT IN (SELECT curie FROM fl))
),
typ AS (SELECT row_number() OVER (ORDER BY curie) AS id, curie
        FROM (SELECT DISTINCT type_curie AS curie FROM recs)),
dsc AS (
  SELECT row_number() OVER (ORDER BY c.clique_id, d.doc_id) AS description_id,
         c.primary_curie AS curie, d.text AS description
  FROM documents d
  JOIN clq c ON c.file_ord = 3 AND c.rec_key = CAST(floor(d.doc_id / 2) AS BIGINT)
),
cgrp AS (
  SELECT 1 AS conflation_type, CAST(floor(p_partkey / 4) AS BIGINT) AS g, 0 AS o, p_partkey AS k,
         'PART:' || {_s('p_partkey')} AS curie FROM part
  UNION ALL
  SELECT 1, s_suppkey, 1, s_suppkey, 'SUPP:' || {_s('s_suppkey')} FROM supplier
  UNION ALL
  SELECT 2, CAST(floor(c_custkey / 3) AS BIGINT), 0, c_custkey, 'CUST:' || {_s('c_custkey')} FROM customer
  UNION ALL
  SELECT 2, p_partkey, 1, p_partkey, 'PART:' || {_s('p_partkey')} FROM part
  WHERE p_partkey % 7 = 0 AND p_partkey IN (SELECT CAST(floor(c_custkey / 3) AS BIGINT) FROM customer)
),
cw AS (
  SELECT dense_rank() OVER (ORDER BY conflation_type, g) AS cluster_id, g,
         CAST(conflation_type AS INTEGER) AS conflation_type, curie AS member_curie, pos,
         CAST(CASE WHEN pos = 0 THEN 1 ELSE 0 END AS INTEGER) AS is_canonical
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY conflation_type, g ORDER BY o, k) - 1 AS INTEGER) AS pos
        FROM cgrp)
)
"""

_WS = WS_CLASS


def _norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{_WS}]+', ' ', 'g'), ' ')"


def _strip(x: str) -> str:
    # one trailing parenthetical, in it parentheses of one level
    pat = f"^(.*?)[{_WS}]*\\((?:[^()]|\\([^()]*\\))*\\)[{_WS}]*$"
    return (f"(CASE WHEN regexp_matches({x}, '{pat}') "
            f"THEN nullif(regexp_extract({x}, '{pat}', 1), '') END)")


def _singular(v: str) -> str:
    tail = f"string_split({v}, ' ')[-1]"
    head = f"(CASE WHEN length({v}) > length({tail}) THEN left({v}, length({v}) - length({tail}) - 1) || ' ' ELSE '' END)"
    return (f"(CASE WHEN length({v}) < 5 THEN NULL WHEN length({tail}) < 4 THEN NULL "
            f"WHEN suffix({tail}, 'ies') AND length({tail}) > 4 THEN {head} || left({tail}, length({tail}) - 3) || 'y' "
            f"WHEN suffix({tail}, 's') AND NOT suffix({tail}, 'ss') THEN {head} || left({tail}, length({tail}) - 1) "
            f"END)")


NAMES = """
qn AS (
  SELECT DISTINCT name FROM (
    SELECT p_name AS name FROM part
    UNION ALL SELECT p_name || 's' FROM part
    UNION ALL SELECT p_name || ' (abc def)' FROM part
    UNION ALL SELECT upper(p_name) FROM part
    UNION ALL SELECT reverse(p_name) FROM part
    UNION ALL SELECT replace(c_name, '#', ' (AB1)#') FROM customer
    UNION ALL SELECT c_name || ' (of 1 (see 2) or 3)' FROM customer)
),
"""

VARIANTS = NAMES + f"""
s1 AS (SELECT name, {_strip('name')} AS v1 FROM qn),
s2 AS (SELECT name, v1, {_strip('v1')} AS v2 FROM s1),
s3 AS (SELECT name, v1, v2, {_strip('v2')} AS v3 FROM s2),
cand AS (
  SELECT name, 0 AS seq, {_norm('name')} AS v FROM qn
  UNION ALL SELECT name, 1, {_norm('v1')} FROM s3
  UNION ALL SELECT name, 2, {_norm('v2')} FROM s3
  UNION ALL SELECT name, 3, {_norm('v3')} FROM s3
  UNION ALL SELECT name, 4, {_norm(f"regexp_replace(name, '{ABBREVIATION_PATTERN}', '', 'g')")} FROM qn
),
base AS (
  SELECT name, v, min(seq) AS seq FROM cand WHERE v IS NOT NULL AND v <> '' GROUP BY name, v
),
allv AS (
  SELECT name, v, seq FROM base
  UNION ALL SELECT name, {_singular('v')}, 100 + seq FROM base
),
var AS (
  SELECT name, CAST(row_number() OVER (PARTITION BY name ORDER BY seq) - 1 AS INTEGER) AS variant_ord,
         v AS variant
  FROM (SELECT name, v, min(seq) AS seq FROM allv WHERE v IS NOT NULL AND v <> '' GROUP BY name, v)
)
"""


def _with(*extra: str) -> str:
    return "WITH " + PRELUDE + "".join("," + e for e in extra) + "\n"


ORACLE: dict[str, str] = {}

ORACLE["members_exploded"] = _with() + """
SELECT file_name, rec_key AS record_key, pos AS member_pos, curie, label, primary_curie FROM ms
"""

ORACLE["identifiers_first_label"] = _with() + "SELECT id, curie, label FROM ident"

ORACLE["cliques_table"] = _with() + """
SELECT clique_id, primary_curie, type_curie, ic, preferred_name FROM clq
"""

ORACLE["membership_table"] = _with() + "SELECT curie AS member_curie, clique_id FROM ms"

ORACLE["taxon_links"] = _with() + """
SELECT DISTINCT curie, taxon AS taxon_curie FROM ms WHERE taxon IS NOT NULL
"""

ORACLE["descriptions_table"] = _with() + "SELECT description_id, curie, description FROM dsc"

ORACLE["types_table"] = _with() + "SELECT id, curie FROM typ"

ORACLE["table_row_counts"] = _with() + """
SELECT 'types' AS table_name, CAST(count(*) AS BIGINT) AS row_count FROM typ
UNION ALL SELECT 'identifiers', count(*) FROM ident
UNION ALL SELECT 'cliques', count(*) FROM clq
UNION ALL SELECT 'descriptions', count(*) FROM dsc
UNION ALL SELECT 'identifiers_descriptions', count(*) FROM dsc
UNION ALL SELECT 'identifiers_cliques', count(*) FROM ms
UNION ALL SELECT 'identifiers_taxa', count(*) FROM (SELECT DISTINCT curie, taxon FROM ms WHERE taxon IS NOT NULL)
UNION ALL SELECT 'conflation_clusters', count(DISTINCT cluster_id) FROM cw
UNION ALL SELECT 'conflation_members', count(*) FROM cw
"""

ORACLE["max_ids"] = _with() + """
SELECT 'types' AS table_name, CAST(count(*) AS BIGINT) AS max_id FROM typ
UNION ALL SELECT 'identifiers', count(*) FROM ident
UNION ALL SELECT 'cliques', count(*) FROM clq
UNION ALL SELECT 'descriptions', count(*) FROM dsc
UNION ALL SELECT 'conflation_clusters', count(DISTINCT cluster_id) FROM cw
"""

ORACLE["preferred_bulk"] = _with() + """
SELECT i.curie AS input_curie, m.primary_curie AS preferred_curie, m.type_curie
FROM ident i JOIN ms m ON m.curie = i.curie
"""

ORACLE["preferred_one"] = _with() + f"""
SELECT m.curie AS input_curie, m.primary_curie AS preferred_curie, m.type_curie FROM ms m
WHERE m.curie = (SELECT 'SUPP:' || {_s('min(s_suppkey)')} FROM supplier)
"""

ORACLE["edges_normalized"] = _with() + f"""
SELECT l.l_orderkey, l.l_linenumber,
       a.curie AS subject_curie, a.primary_curie AS subject_preferred, a.type_curie AS subject_type,
       b.curie AS object_curie, b.primary_curie AS object_preferred, b.type_curie AS object_type
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN ms a ON a.curie = 'CUST:' || {_s('o.o_custkey')}
JOIN ms b ON b.curie = 'PART:' || {_s('l.l_partkey')}
"""

ORACLE["conflation_clusters_resolved"] = _with() + """
SELECT cluster_id, conflation_type, member_curie, pos AS member_pos, is_canonical FROM cw
"""

ORACLE["conflation_bulk"] = _with() + """
SELECT q.member_curie AS query_curie, b.member_curie, b.is_canonical AS member_is_canonical,
       b.conflation_type AS conflation_type_id
FROM (SELECT DISTINCT member_curie FROM cw) q
JOIN cw a ON a.member_curie = q.member_curie JOIN cw b ON a.cluster_id = b.cluster_id
"""

ORACLE["conflation_factored"] = _with() + f"""
SELECT 'link' AS kind, cw.cluster_id, cw.member_curie AS curie, CAST(NULL AS INTEGER) AS is_canonical,
       CAST(NULL AS INTEGER) AS conflation_type_id
FROM customer JOIN cw ON cw.member_curie = 'CUST:' || {_s('c_custkey')}
UNION ALL
SELECT 'member', cluster_id, member_curie, is_canonical, conflation_type FROM cw
WHERE cluster_id IN (SELECT x.cluster_id FROM cw x WHERE x.member_curie IN (SELECT 'CUST:' || {_s('c_custkey')} FROM customer))
"""

ORACLE["conflation_one"] = _with() + f"""
SELECT a.member_curie AS query_curie, b.member_curie, b.is_canonical
FROM cw a JOIN cw b ON a.cluster_id = b.cluster_id
WHERE b.conflation_type = 2
  AND a.member_curie = (SELECT 'CUST:' || {_s('min(c_custkey)')} FROM customer)
"""

ORACLE["preferred_cliques"] = _with() + """
SELECT c.primary_curie AS identifier, d.description, c.preferred_name AS label, c.ic, c.type_curie
FROM clq c LEFT JOIN dsc d ON d.curie = c.primary_curie
"""

ORACLE["any_cliques"] = _with() + """
SELECT m.curie AS input_curie, m.clique_id, m.primary_curie AS identifier, d.description,
       m.preferred_name AS label, m.ic, m.type_curie
FROM ident i JOIN ms m ON m.curie = i.curie
LEFT JOIN dsc d ON d.curie = m.primary_curie
"""

ORACLE["synonyms"] = _with() + """
SELECT DISTINCT m.primary_curie AS preferred_curie, m.curie AS synonym_curie FROM ms m
"""

ORACLE["taxon"] = _with() + """
SELECT i.curie, t.taxon_curie FROM ident i
LEFT JOIN (SELECT curie, min(taxon) AS taxon_curie FROM ms WHERE taxon IS NOT NULL GROUP BY curie) t
  ON t.curie = i.curie
"""

ORACLE["label"] = _with() + f"""
SELECT x.curie, i.label FROM (
  SELECT 'CUST:' || {_s('c_custkey')} AS curie FROM customer
  UNION ALL SELECT 'ENS:' || {_s('c_custkey')} FROM customer) x
LEFT JOIN ident i ON i.curie = x.curie
"""

# names as one long list of (clique, name), met through whatever belongs to the clique
ORACLE["all_names"] = _with("""
named AS (
  SELECT clique_id, preferred_name AS name FROM clq
  UNION SELECT ms.clique_id, ident.label FROM ms JOIN ident USING (curie)
)""", """
belongs AS (SELECT curie, clique_id FROM ms UNION SELECT primary_curie, clique_id FROM clq)""") + """
SELECT curie, name FROM (
  SELECT curie, label AS name FROM ident
  UNION SELECT belongs.curie, named.name FROM belongs JOIN named USING (clique_id))
WHERE trim(name, ' ') <> ''
"""

# types as one list of (identifier, type), spread over clusters; alone, an identifier is its own
ORACLE["categories"] = _with("""
typed AS (SELECT curie, type_curie FROM ms UNION SELECT primary_curie, type_curie FROM clq)""", """
groups AS (
  SELECT curie, 'self ' || curie AS g FROM ident
  UNION SELECT member_curie, 'cluster ' || cluster_id FROM cw
)""", """
spread AS (SELECT DISTINCT g, type_curie FROM groups JOIN typed USING (curie))""") + """
SELECT DISTINCT curie, type_curie AS category FROM groups JOIN spread USING (g)
WHERE curie IN (SELECT curie FROM ident)
"""

ORACLE["all_names_ordered"] = f"""
SELECT curie, row_number() OVER (PARTITION BY curie ORDER BY {_lower('name')}, name) AS position, name FROM ({ORACLE["all_names"]})
"""

ORACLE["categories_ordered"] = f"""
SELECT curie, row_number() OVER (PARTITION BY curie ORDER BY {_lower('category')}, category) AS position, category
FROM ({ORACLE["categories"]})
"""

ORACLE["name_variants"] = _with(VARIANTS) + "SELECT name, variant_ord, variant FROM var"

ORACLE["name_to_curie"] = _with(VARIANTS, f"""
lab AS (
  SELECT curie, label, {_lower('label')} AS lkey FROM ident
  WHERE label IS NOT NULL AND NOT starts_with({_lower('curie')}, 'pmid:')
)""", f"""
hits AS (
  SELECT v.name, v.variant_ord, l.lkey, l.label, l.curie
  FROM var v JOIN lab l ON starts_with(l.lkey, {_lower('v.variant')})
)""", """
best AS (
  SELECT name, curie, label FROM (
    SELECT *, row_number() OVER (PARTITION BY name ORDER BY variant_ord, lkey, label, curie) AS rn
    FROM hits) WHERE rn = 1
)""") + """
SELECT q.name, b.curie, b.label FROM qn q LEFT JOIN best b ON b.name = q.name
"""

ORACLE["sample_identifiers"] = _with() + """
SELECT curie FROM ident ORDER BY md5('42' || curie), curie LIMIT 100
"""

ORACLE["sample_third"] = _with() + """
SELECT curie FROM ident QUALIFY row_number() OVER (ORDER BY md5('42' || curie), curie) <= (SELECT count(*) // 3 FROM ident)
"""

ORACLE["ids_to_curies"] = _with() + """
SELECT id, curie FROM ident WHERE id IN (SELECT o_orderkey FROM orders)
"""

ORACLE["conflation_missing"] = _with("""
known AS (SELECT DISTINCT curie FROM mem WHERE file_name <> 'Gene.txt')""", """
flag AS (
  SELECT cw.*, (k2.curie IS NULL) AS missing FROM cw LEFT JOIN known k2 ON k2.curie = cw.member_curie
)""", """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY cluster_id ORDER BY member_curie) AS rn
  FROM flag WHERE missing
)""") + """
SELECT max(CASE WHEN f.pos = 0 THEN f.member_curie END) AS canonical_curie,
       bool_or(f.pos = 0 AND f.missing) AS canonical_missing,
       count(*) FILTER (WHERE f.missing) AS n_missing,
       (SELECT string_agg(r.member_curie, ' ' ORDER BY r.member_curie) FROM ranked r
        WHERE r.cluster_id = f.cluster_id AND r.rn <= 10) AS first_missing
FROM flag f GROUP BY f.cluster_id HAVING count(*) FILTER (WHERE f.missing) > 0
"""

# a line repeats its canonical member where its cluster's number divides by five
_FLAGS = """
valid AS (SELECT DISTINCT curie FROM mem WHERE file_ord IN (1, 2))""", """
flags AS (
  SELECT cw.cluster_id, max(cw.conflation_type) AS conflation_type, max(cw.g) % 5 = 0 AS repeated,
         max(CASE WHEN cw.pos = 0 THEN cw.member_curie END) AS canonical_curie,
         bool_and(v.curie IS NOT NULL) AS kept, count(*) AS n,
         '["' || string_agg(cw.member_curie, '","' ORDER BY cw.pos) AS listed
  FROM cw LEFT JOIN valid v ON v.curie = cw.member_curie GROUP BY cw.cluster_id
)"""

ORACLE["clusters_filtered"] = _with(*_FLAGS) + """
SELECT canonical_curie, conflation_type, CAST(n + repeated::INT AS INTEGER) AS n_members, kept FROM flags
"""

ORACLE["cluster_filter_stats"] = _with(*_FLAGS) + """
SELECT count(*) AS total, count(*) FILTER (WHERE kept) AS kept,
       count(*) FILTER (WHERE NOT kept) AS dropped,
       round(CAST(count(*) FILTER (WHERE NOT kept) AS DOUBLE) * 100 / count(*), 2) AS dropped_pct,
       count(*) FILTER (WHERE kept AND repeated) AS kept_with_duplicates
FROM flags
"""

ORACLE["kept_cluster_lines"] = _with(*_FLAGS) + """
SELECT listed || CASE WHEN repeated THEN '","' || canonical_curie ELSE '' END || '"]' AS value FROM flags WHERE kept
"""

ORACLE["curie_harvest"] = _with() + f"""
SELECT DISTINCT x AS curie FROM (
  SELECT type_curie AS x FROM recs
  UNION ALL SELECT preferred_name FROM recs
  UNION ALL SELECT curie FROM mem
  UNION ALL SELECT label FROM mem
  UNION ALL SELECT taxon FROM mem
  UNION ALL SELECT description FROM dsc
) WHERE x IS NOT NULL AND regexp_matches(x, '{CURIE_PATTERN}')
"""

_ZERO_CHECKS = [
    "unique_identifiers_taxa", "unique_conflation_members", "fk_cliques_primary",
    "fk_cliques_type", "fk_idesc_description", "fk_idesc_identifier", "fk_icliques_identifier",
    "fk_icliques_clique", "fk_itaxa_identifier", "fk_itaxa_taxon", "fk_members_cluster",
    "fk_members_identifier", "check_conflation_type", "check_is_canonical",
    "not_null_identifiers_curie", "not_null_cliques_columns", "not_null_descriptions_desc",
]

ORACLE["audit_report"] = _with() + """
SELECT 'unique_types_curie' AS check_name,
       CAST((SELECT count(*) FROM (SELECT curie FROM typ GROUP BY curie HAVING count(*) > 1)) AS BIGINT) AS violations
UNION ALL SELECT 'unique_identifiers_curie',
       (SELECT count(*) FROM (SELECT curie FROM ident GROUP BY curie HAVING count(*) > 1))
UNION ALL SELECT 'unique_cliques_primary_type',
       (SELECT count(*) FROM (SELECT primary_curie, type_curie FROM clq GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'empty_cliques',
       (SELECT count(*) FROM clq WHERE clique_id NOT IN (SELECT clique_id FROM ms))
UNION ALL SELECT 'one_canonical_per_cluster',
       (SELECT count(*) FROM (SELECT cluster_id FROM cw GROUP BY cluster_id HAVING sum(is_canonical) <> 1))
""" + "".join(
    f"UNION ALL SELECT '{name}', (SELECT count(*) FROM (SELECT curie FROM ident WHERE curie IS NULL))\n"
    for name in _ZERO_CHECKS)

_REAPPEND = f"""
dup AS (
  SELECT primary_curie, type_curie FROM recs
  UNION ALL SELECT 'SUPP:' || {_s('s_suppkey')}, 'biolink:Drug' FROM supplier
)"""

ORACLE["audit_unique_reappend"] = _with(_REAPPEND) + """
SELECT primary_curie, type_curie, count(*) AS n FROM dup GROUP BY ALL HAVING count(*) > 1
"""

ORACLE["duplicate_primary_type"] = _with(_REAPPEND) + """
SELECT primary_curie, type_curie, count(*) AS n FROM dup GROUP BY ALL HAVING count(*) > 1
ORDER BY primary_curie, type_curie LIMIT 10
"""

ORACLE["file_type_profile"] = _with() + """
SELECT file_name, arg_min(type_curie, rec_key) AS first_type,
       count(DISTINCT type_curie) AS n_types, count(*) AS n_records,
       false AS first_type_missing
FROM recs GROUP BY file_name
"""

ORACLE["required_columns"] = _with() + """
SELECT DISTINCT file_name, '' AS missing, 'ic,identifiers,preferred_name,taxa,type' AS present FROM recs
"""

ORACLE["ingest_from_files"] = ORACLE["identifiers_first_label"]

ORACLE["append_new_identifiers"] = _with(f"""
known3 AS (
  SELECT curie FROM mem WHERE file_ord <= 3
  UNION SELECT taxon FROM mem WHERE file_ord <= 3 AND taxon IS NOT NULL
)""") + f"""
SELECT i.curie, i.label, false AS is_new FROM ident i WHERE i.curie IN (SELECT curie FROM known3)
UNION ALL
SELECT 'SUPP:' || {_s('s_suppkey')}, s_name, true FROM supplier
WHERE 'SUPP:' || {_s('s_suppkey')} NOT IN (SELECT curie FROM known3)
"""

# suppliers stay known where a part lists them
ORACLE["rejected_rows"] = _with("""
known4 AS (SELECT DISTINCT curie FROM mem WHERE file_ord IN (1, 3))""", """
lost AS (
  SELECT cw.cluster_id, max(cw.conflation_type) AS t, max(cw.g) AS g, count(*) FILTER (WHERE k4.curie IS NULL) AS n,
         bool_or(cw.pos = 0 AND k4.curie IS NULL) AS canon, max(CASE WHEN cw.pos = 0 THEN cw.member_curie END) AS canonical_curie,
         '["' || string_agg(cw.member_curie, '","' ORDER BY cw.pos) AS listed
  FROM cw LEFT JOIN known4 k4 ON k4.curie = cw.member_curie GROUP BY cw.cluster_id
)""") + """
SELECT file_name, rec_key AS line_key, 'type not in vocabulary: biolink:Drug' AS reason, preferred_name AS value
FROM recs WHERE file_name = 'SmallMolecule.txt'
UNION ALL
SELECT CASE t WHEN 1 THEN 'DrugChemical.txt' ELSE 'GeneProtein.txt' END, 2 * g,
       CASE WHEN canon THEN 'canonical CURIE missing; ' ELSE '' END || 'missing: ' || n,
       listed || CASE WHEN g % 5 = 0 THEN '","' || canonical_curie ELSE '' END || '"]'
FROM lost WHERE n > 0
"""

ORACLE["rebuild_conflation"] = ORACLE["conflation_clusters_resolved"]

ORACLE["stream_append_identifiers"] = _with() + "SELECT curie, label FROM ident"

_KEYS = "'ic,identifiers,preferred_name,taxa,type'"
ORACLE["odd_release"] = f"""
WITH gene AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'biolink:Protein' ELSE 'biolink:Gene' END AS t FROM customer),
drug AS (SELECT s_suppkey AS k, s_suppkey % 5 = 0 AS bad, s_suppkey % 2 = 0 AND s_suppkey % 5 <> 0 AS typed FROM supplier),
prof AS (
  SELECT 'OrganismTaxon.txt' AS file_name, count(*) AS n_records, 0 AS n_malformed, 'biolink:OrganismTaxon' AS first_type,
         1 AS n_types, '' AS missing, {_KEYS} AS present FROM nation
  UNION ALL SELECT 'Gene.txt.0' || (k % 2), count(*), 0, arg_min(t, k), count(DISTINCT t), '', {_KEYS} FROM gene GROUP BY k % 2
  UNION ALL SELECT 'Protein.txt', count(*), 0, 'biolink:Protein', 1,
         CASE WHEN bool_or(p_partkey % 3 = 0) THEN 'taxa' ELSE 'ic,taxa' END,
         CASE WHEN bool_or(p_partkey % 3 = 0) THEN 'ic,' ELSE '' END || 'identifiers,preferred_name,type' FROM part
  UNION ALL SELECT 'Drug.txt', count(*), count(*) FILTER (WHERE bad), CASE WHEN arg_min(typed, k) THEN 'biolink:Drug' END,
         max(CAST(typed AS INTEGER)), CASE WHEN bool_or(typed) THEN '' ELSE 'type' END,
         'ic,identifiers,preferred_name,taxa' || CASE WHEN bool_or(typed) THEN ',type' ELSE '' END FROM drug
),
chosen(file_name, selected, file_ord, note) AS (
  VALUES ('OrganismTaxon.txt', true, 1, NULL), ('Drug.txt', true, 2, NULL), ('Gene.txt.00', true, 3, NULL),
         ('Gene.txt.01', true, 4, NULL), ('Protein.txt', true, 5, NULL), ('Gene.txt', false, NULL, 'replaced by shards'),
         ('README.md', false, NULL, 'unrecognized file name')
)
SELECT c.file_name, c.selected, c.file_ord, c.note, CAST(p.n_records AS BIGINT) AS n_records,
       CAST(p.n_malformed AS BIGINT) AS n_malformed, p.first_type, CAST(p.n_types AS BIGINT) AS n_types, p.missing, p.present
FROM chosen c LEFT JOIN prof p ON p.file_name = c.file_name
"""

ORACLE["release_manifest"] = _with() + """
SELECT DISTINCT file_name, true AS selected, CAST(file_ord AS INTEGER) AS file_ord,
       CAST(NULL AS VARCHAR) AS note
FROM recs
"""


def _faulty_tables() -> str:
    out = []
    for name, (columns, keep) in FAULTY.items():
        listed = ", ".join(columns).replace("AS STRING", "AS VARCHAR")
        out.append(f"{name} AS (SELECT * FROM (SELECT {listed} FROM (SELECT CAST(p_partkey AS BIGINT) AS k FROM part)) WHERE {keep})")
    return ",\n".join(out)


def _duplicates(table: str, keys: str) -> str:
    return f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1)"


def _orphans(child: str, column: str, parent: str) -> str:
    return (f"(SELECT c.{column} FROM {child} c WHERE c.{column} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.id = c.{column}))")


def _rows(table: str, bad: str) -> str:
    return f"(SELECT * FROM {table} WHERE {bad})"


_CHECKS = {
    "unique_types_curie": _duplicates("types", "curie"),
    "unique_identifiers_curie": _duplicates("identifiers", "curie"),
    "unique_cliques_primary_type": _duplicates("cliques", "primary_identifier_id, type_id"),
    "unique_identifiers_taxa": _duplicates("identifiers_taxa", "identifier_id, taxa_identifier_id"),
    "unique_conflation_members": _duplicates("conflation_members", "cluster_id, identifier_id"),
    "fk_cliques_primary": _orphans("cliques", "primary_identifier_id", "identifiers"),
    "fk_cliques_type": _orphans("cliques", "type_id", "types"),
    "fk_idesc_description": _orphans("identifiers_descriptions", "description_id", "descriptions"),
    "fk_idesc_identifier": _orphans("identifiers_descriptions", "identifier_id", "identifiers"),
    "fk_icliques_identifier": _orphans("identifiers_cliques", "identifier_id", "identifiers"),
    "fk_icliques_clique": _orphans("identifiers_cliques", "clique_id", "cliques"),
    "fk_itaxa_identifier": _orphans("identifiers_taxa", "identifier_id", "identifiers"),
    "fk_itaxa_taxon": _orphans("identifiers_taxa", "taxa_identifier_id", "identifiers"),
    "fk_members_cluster": _orphans("conflation_members", "cluster_id", "conflation_clusters"),
    "fk_members_identifier": _orphans("conflation_members", "identifier_id", "identifiers"),
    "check_conflation_type": _rows("conflation_clusters", "type IS NULL OR type NOT IN (1, 2)"),
    "check_is_canonical": _rows("conflation_members", "is_canonical IS NULL OR is_canonical NOT IN (0, 1)"),
    "not_null_identifiers_curie": _rows("identifiers", "curie IS NULL"),
    "not_null_cliques_columns": _rows("cliques", "primary_identifier_id IS NULL OR type_id IS NULL OR preferred_name IS NULL"),
    "not_null_descriptions_desc": _rows("descriptions", '"desc" IS NULL'),
    "empty_cliques": "(SELECT id FROM cliques WHERE id NOT IN (SELECT clique_id FROM identifiers_cliques))",
    "one_canonical_per_cluster":
        "(SELECT cluster_id FROM conflation_members GROUP BY cluster_id HAVING sum(is_canonical) <> 1)",
}

ORACLE["audit_violations"] = "WITH " + re.sub(r"AS desc\b", 'AS "desc"', _faulty_tables()) + "\n" + \
    "\nUNION ALL ".join(f"SELECT '{name}' AS check_name, CAST((SELECT count(*) FROM {rows}) AS BIGINT) AS violations"
                        for name, rows in _CHECKS.items())

ORACLE["malformed_lines"] = f"""
WITH s AS (
  SELECT s_suppkey AS k, '{{"type":"biolink:Drug","ic":null,"identifiers":[{{"i":"SUPP:' || {_s('s_suppkey')}
    || '"}}],"preferred_name":"' || s_name || '","taxa":[]}}' AS good FROM supplier
),
v AS (
  SELECT k, CASE k % 7 WHEN 0 THEN left(good, 30) WHEN 1 THEN good || ' xyz' WHEN 2 THEN '[1,2]'
    WHEN 3 THEN replace(good, '"ic":null', '"ic":"abc"') ELSE good END AS value FROM s
),
l AS (
  SELECT k, value, row_number() OVER (ORDER BY k, n) AS line_number, n FROM (
    SELECT k, value, 0 AS n FROM v UNION ALL SELECT k, '', 1 FROM v WHERE k % 5 = 0)
)
SELECT 'SmallMolecule.txt' AS file_name, line_number, left(value, 200) AS preview FROM l WHERE n = 0 AND k % 7 < 4
"""

# values at any depth of lines that are written out here, as JSON
ORACLE["curie_harvest_any"] = r"""
WITH inner_lines AS (
  SELECT c_custkey AS k, '{"type":"biolink:Gene","identifiers":[{"i":"CUST:' || c_custkey || '","xrefs":{"same":["ENS:' || c_custkey
    || '",{"deep":[["ORD:' || c_custkey || '",7,null,true],"a b: no CURIE"]}]}}],"KEY:' || c_custkey || '":{"ref":"NATION:'
    || c_nationkey || '","n":' || c_custkey || '},"seg\u006dent":"SEG\u003a' || c_mktsegment || '","name":"' || c_name || '"}' AS line
  FROM customer),
lines AS (
  SELECT k, CASE WHEN k % 3 = 0 THEN '{"wrapped":[{"more":' || line || '},"WRAP:' || k || '"]}' ELSE line END AS line FROM inner_lines)
SELECT DISTINCT json_extract_string(t.atom, '$') AS curie FROM lines, json_tree(line) t
WHERE t.type = 'VARCHAR' AND regexp_matches(json_extract_string(t.atom, '$'), '^[A-Za-z][A-Za-z0-9._-]*:[^\s]+$')
"""

# the whole store with the appended rows (``added``), audited in full: only what they broke is left,
# as the release itself breaks nothing
ORACLE["audit_append"] = _with(f"""
ai AS (
  SELECT 1000000000000 + s_suppkey AS id, 'SUPP:' || {_s('s_suppkey')} AS curie FROM supplier
  UNION ALL SELECT 2000000000000 + c_custkey, 'NEW:' || {_s('c_custkey')} FROM customer)""", f"""
ac AS (
  SELECT 1000000000000 + s_suppkey AS id, ident.id AS primary_identifier_id, typ.id AS type_id, s_name AS preferred_name
  FROM supplier JOIN ident ON ident.curie = 'SUPP:' || {_s('s_suppkey')} JOIN typ ON typ.curie = 'biolink:Drug'
  UNION ALL
  SELECT 2000000000000 + c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 4000000000000 ELSE 2000000000000 END + c_custkey, typ.id,
         CASE WHEN c_custkey % 7 = 0 THEN c_name END
  FROM customer JOIN typ ON typ.curie = 'biolink:Gene' WHERE c_custkey % 7 < 2)""", f"""
am AS (
  SELECT ident.id AS identifier_id, 1000000000000 + s_suppkey AS clique_id
  FROM supplier JOIN ident ON ident.curie = 'SUPP:' || {_s('s_suppkey')} WHERE s_suppkey % 2 = 0
  UNION ALL SELECT 2000000000000 + c_custkey, 2000000000000 + c_custkey FROM customer WHERE c_custkey % 7 = 0
  UNION ALL SELECT 2000000000000 + c_custkey, 4000000000000 + c_custkey FROM customer WHERE c_custkey % 7 = 2)""", """
lk AS (SELECT DISTINCT a.id AS identifier_id, b.id AS taxa_identifier_id
       FROM ms JOIN ident a ON a.curie = ms.curie JOIN ident b ON b.curie = ms.taxon)""", """
rl AS (SELECT * FROM lk WHERE identifier_id % 2 = 0)""", """
cm AS (SELECT cw.cluster_id, ident.id AS identifier_id, cw.is_canonical FROM cw JOIN ident ON ident.curie = cw.member_curie)""", """
an AS (SELECT DISTINCT cluster_id, cluster_id + 6000000000000 AS identifier_id, 1 + cluster_id % 3 AS is_canonical
       FROM cw WHERE cluster_id % 3 < 2)""", """
wi AS (SELECT id, curie FROM ident UNION ALL SELECT * FROM ai)""", """
wc AS (SELECT c.clique_id AS id, i.id AS primary_identifier_id, t.id AS type_id, c.preferred_name
       FROM clq c JOIN ident i ON i.curie = c.primary_curie JOIN typ t ON t.curie = c.type_curie UNION ALL SELECT * FROM ac)""", """
wm AS (SELECT i.id AS identifier_id, ms.clique_id FROM ms JOIN ident i ON i.curie = ms.curie UNION ALL SELECT * FROM am)""", """
wl AS (SELECT * FROM lk UNION ALL SELECT * FROM rl)""", """
wn AS (SELECT * FROM cm UNION ALL SELECT * FROM an)""") + """
SELECT 'unique_identifiers_curie' AS check_name, curie AS row_key FROM wi GROUP BY curie HAVING count(*) > 1
UNION ALL SELECT 'unique_cliques_primary_type', primary_identifier_id || ',' || type_id FROM wc
  GROUP BY primary_identifier_id, type_id HAVING count(*) > 1
UNION ALL SELECT 'unique_identifiers_taxa', identifier_id || ',' || taxa_identifier_id FROM wl
  GROUP BY identifier_id, taxa_identifier_id HAVING count(*) > 1
UNION ALL SELECT 'unique_conflation_members', identifier_id || ',' || cluster_id FROM wn
  GROUP BY identifier_id, cluster_id HAVING count(*) > 1
UNION ALL SELECT 'fk_cliques_primary', CAST(primary_identifier_id AS VARCHAR) FROM wc WHERE primary_identifier_id NOT IN (SELECT id FROM wi)
UNION ALL SELECT 'fk_cliques_type', CAST(type_id AS VARCHAR) FROM wc WHERE type_id NOT IN (SELECT id FROM typ)
UNION ALL SELECT 'fk_icliques_identifier', CAST(identifier_id AS VARCHAR) FROM wm WHERE identifier_id NOT IN (SELECT id FROM wi)
UNION ALL SELECT 'fk_icliques_clique', CAST(clique_id AS VARCHAR) FROM wm WHERE clique_id NOT IN (SELECT id FROM wc)
UNION ALL SELECT 'fk_itaxa_identifier', CAST(identifier_id AS VARCHAR) FROM wl WHERE identifier_id NOT IN (SELECT id FROM wi)
UNION ALL SELECT 'fk_itaxa_taxon', CAST(taxa_identifier_id AS VARCHAR) FROM wl WHERE taxa_identifier_id NOT IN (SELECT id FROM wi)
UNION ALL SELECT 'fk_members_cluster', CAST(cluster_id AS VARCHAR) FROM wn WHERE cluster_id NOT IN (SELECT cluster_id FROM cw)
UNION ALL SELECT 'fk_members_identifier', CAST(identifier_id AS VARCHAR) FROM wn WHERE identifier_id NOT IN (SELECT id FROM wi)
UNION ALL SELECT 'not_null_identifiers_curie', CAST(id AS VARCHAR) FROM wi WHERE curie IS NULL
UNION ALL SELECT 'not_null_cliques_columns', CAST(id AS VARCHAR) FROM wc
  WHERE primary_identifier_id IS NULL OR type_id IS NULL OR preferred_name IS NULL
UNION ALL SELECT 'empty_cliques', CAST(id AS VARCHAR) FROM wc WHERE id NOT IN (SELECT clique_id FROM wm)
UNION ALL SELECT 'check_is_canonical', cluster_id || ',' || identifier_id FROM wn WHERE is_canonical NOT IN (0, 1)
UNION ALL SELECT 'one_canonical_per_cluster', CAST(cluster_id AS VARCHAR) FROM wn GROUP BY cluster_id HAVING sum(is_canonical) <> 1
"""
