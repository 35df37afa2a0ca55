"""SQL for the audit and release queries, written apart from the operators."""

from __future__ import annotations

from ..operators.units import UNITS
from .problems_sql import coded, numbered, squeezed


def strip(c: str) -> str:
    return rf"regexp_replace({c}, '^[\s\x{{00A0}}]+|[\s\x{{00A0}}]+$', '', 'g')"


def blank(c: str) -> str:
    return f"({c} IS NULL OR {strip(c)} = '')"


_FKS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_custkey", "orders", "o_custkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "antibody_id", "antibody_metadata", "antibody_id"),
]


def _key(c: str) -> str:
    return f"nullif(upper({strip(f'CAST({c} AS VARCHAR)')}), '')"


def _fk(c: str, cc: str, p: str, pc: str) -> str:
    return f"""SELECT '{c}.{cc}->{p}.{pc}' AS relationship, count(*) AS child_rows, count(k) AS "references", count(*) FILTER (hit) AS matched,
  count(k) - count(*) FILTER (hit) AS unmatched, count(DISTINCT k) FILTER (NOT hit) AS distinct_orphans,
  coalesce((SELECT string_agg(k, '|' ORDER BY k) FROM (SELECT DISTINCT {_key(cc)} k FROM {c} WHERE {_key(cc)} IS NOT NULL AND {_key(cc)} NOT IN
    (SELECT {_key(pc)} FROM {p} WHERE {_key(pc)} IS NOT NULL) ORDER BY k LIMIT 10)), '') AS example_orphans,
  CASE WHEN count(k) = 0 THEN 'no_references' WHEN count(k) = count(*) FILTER (hit) THEN 'verified' ELSE 'has_orphans' END AS status
FROM (SELECT {_key(cc)} k, {_key(cc)} IN (SELECT {_key(pc)} FROM {p} WHERE {_key(pc)} IS NOT NULL) hit FROM {c})"""


FK_AUDIT = " UNION ALL ".join(_fk(*x) for x in _FKS)
FK_ORPHANS = """SELECT CAST(o_orderkey AS VARCHAR) AS orphan, count(*) AS n_references FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1"""

_CATALOGUE = {"orders": "o_custkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
FK_BEST = "SELECT child, parent, matched, unmatched, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY child ORDER BY matched DESC, parent) AS INTEGER) rank FROM (" + " UNION ALL ".join(
    f"SELECT '{a}' child, '{b}' parent, count(*) FILTER ({x} IN (SELECT {y} FROM {b})) matched, count(*) FILTER ({x} NOT IN (SELECT {y} FROM {b})) unmatched FROM {a}"
    for a, x in _CATALOGUE.items() for b, y in _CATALOGUE.items() if a != b
) + ")) WHERE rank <= 2"

_KEYS = [
    ("orders", ["o_orderkey"]), ("customer", ["c_custkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("labels", ["label_id"]),
    ("antibody_metadata", ["antibody_id"]), ("measurements", ["record_id"]), ("record_lineage", ["lineage_id"]),
]


def _key_sql(t: str, columns: list[str]) -> str:
    value = " || chr(31) || ".join(f"upper(trim(CAST({c} AS VARCHAR)))" for c in columns)
    return f"""SELECT '{t}' AS table_name, '{"+".join(columns)}' AS key_columns, count(*) AS row_count, count(k) AS non_missing, count(DISTINCT k) AS distinct_values,
  count(k) - count(DISTINCT k) AS duplicate_values, count(*) - count(k) AS missing_values,
  CASE WHEN count(*) = 0 THEN 'empty' WHEN count(*) = count(DISTINCT k) THEN 'confirmed_candidate' WHEN count(k) = count(DISTINCT k) THEN 'candidate_with_missing'
    ELSE 'not_unique' END AS status FROM (SELECT {value} k FROM {t})"""


KEY_UNIQUENESS = " UNION ALL ".join(_key_sql(t, c) for t, c in _KEYS)

METADATA = ["record_id", "antibody_id", "antibody_name", "Format", "hc_subtype", "lc_subtype", "Highest_Clin_Trial", "Target", "Species", "PDB", "production_host", "tag"]


def _type(v: str) -> str:
    return (
        f"CASE WHEN {v} = '' THEN 'empty' WHEN lower({v}) IN ('true', 'false') THEN 'boolean' WHEN regexp_matches({v}, '^[+-]?[0-9]+(_[0-9]+)*$') THEN 'integer' "
        rf"WHEN regexp_matches({v}, '^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$') OR regexp_matches(lower({v}), '^[+-]?(nan|inf|infinity)$') THEN 'number' ELSE 'string' END"
    )


def _long(t: str, columns: list[str], order: str) -> str:
    return " UNION ALL ".join(f"SELECT '{c}' column_name, coalesce({strip(f'CAST({c} AS VARCHAR)')}, '') v, {order} r FROM {t}" for c in columns)


COLUMN_PROFILE = f"""WITH long AS ({_long("antibody_metadata", METADATA, "excel_row")}),
vals AS (SELECT column_name, v, count(*) n, min(r) f, {_type("v")} t FROM long GROUP BY 1, 2),
kinds AS (SELECT column_name, t, sum(n) n, min(f) f FROM vals WHERE v <> '' GROUP BY 1, 2),
kind AS (SELECT column_name, t FROM kinds QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, f) = 1),
firsts AS (SELECT column_name, v, row_number() OVER (PARTITION BY column_name ORDER BY f, v) k FROM vals WHERE v <> ''),
samples AS (SELECT column_name, string_agg(substr(v, 1, 160), '; ' ORDER BY k) s FROM firsts WHERE k <= 3 GROUP BY 1)
SELECT vals.column_name, CAST(coalesce(sum(n) FILTER (v <> ''), 0) AS BIGINT) AS non_missing, CAST(coalesce(sum(n) FILTER (v = ''), 0) AS BIGINT) AS missing,
  count(*) FILTER (v <> '') AS distinct_values, coalesce(any_value(kind.t), 'empty') AS dominant_type, coalesce(any_value(s), '') AS samples
FROM vals LEFT JOIN kind USING (column_name) LEFT JOIN samples USING (column_name) GROUP BY 1"""

_MEASURED = ["pH", "temperature", "concentration", "unit", "reported_value", "statistic_type"]
COLUMN_TYPES = f"""SELECT column_name, type, count(*) AS n_values, count(DISTINCT v) AS n_distinct
FROM (SELECT column_name, v, {_type("v")} AS type FROM ({_long("measurements", _MEASURED, "source_excel_row")})) GROUP BY 1, 2"""


def _table_sql(t: str, columns: list[str]) -> str:
    parts = [f"coalesce({strip(f'CAST({c} AS VARCHAR)')}, '')" for c in columns]
    return (
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) - count(DISTINCT {' || chr(31) || '.join(parts)}) AS duplicate_rows, "
        f"count(*) FILTER ({' || '.join(parts)} = '') AS empty_rows, {len(columns)} AS column_count FROM {t}"
    )


TABLE_PROFILE = " UNION ALL ".join([
    _table_sql("antibody_metadata", METADATA),
    _table_sql("identity_relationship_members", ["record_id", "relationship_group_id", "antibody_id", "antibody_names", "metadata_available"]),
    _table_sql("part", ["p_name", "p_brand", "p_type"]),
])

DUPLICATE_GROUPS = """WITH f AS (SELECT doc_id, sha256(text) sha, concat_ws('/', source, source_study_id, doc_kind) name FROM documents)
SELECT 'exact_content' AS group_kind, sha AS group_key, count(*) AS n_items, min(doc_id) AS first_item, max(doc_id) AS last_item FROM f WHERE sha IS NOT NULL GROUP BY sha HAVING count(*) > 1
UNION ALL SELECT 'same_name_other_content', name, count(*), min(doc_id), max(doc_id) FROM f GROUP BY name HAVING count(DISTINCT coalesce(sha, '')) > 1"""

LARGEST_DOCUMENTS = "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC NULLS LAST, doc_id LIMIT 100"
EXTENSION_SUMMARY = r"""SELECT coalesce(nullif(lower(regexp_extract(input_file, '[^/\\.](\.[^./\\]+)$', 1)), ''), '[no extension]') AS extension, count(*) AS file_count,
CAST(sum(length(input_file)) AS BIGINT) AS total_bytes FROM record_lineage GROUP BY 1"""
_PATH = "lower(replace(output_table, '\\', '/'))"
PATH_CATEGORIES = rf"""SELECT CASE
  WHEN regexp_matches({_PATH}, '(^|/)(raw|source|sources|original)(/|_|$)') THEN 'raw_source' WHEN regexp_matches({_PATH}, 'metadata.*\.(xlsx|csv|tsv|json)$') THEN 'metadata'
  WHEN regexp_matches({_PATH}, 'sequence.*\.(xlsx|csv|tsv|json|fasta|fa)$') THEN 'sequence' WHEN regexp_matches({_PATH}, '(^|/)releases?(/|$)') THEN 'release' ELSE 'unclassified' END AS category,
  count(*) AS n_paths FROM record_lineage GROUP BY 1"""

SEQ_CLASS = f"""SELECT source, CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN 'paired_vh_vl' WHEN NOT {blank("VH")} THEN 'heavy_only'
  WHEN NOT {blank("VL")} THEN 'light_only' ELSE 'no_sequence' END AS sequence_class, count(*) AS n_records FROM labels GROUP BY 1, 2"""


def _release(c: str) -> str:
    return rf"upper(regexp_replace({c}, '[\s\x{{00A0}}]+', '', 'g'))"


def _pair(h: str, l: str) -> str:
    return f"CASE WHEN NOT {blank(h)} AND NOT {blank(l)} THEN sha256({_release(h)} || chr(31) || {_release(l)}) END"


SEQ_FINGERPRINT = f"""SELECT label_id AS record, CASE WHEN NOT {blank("VH")} THEN sha256({_release("VH")}) END AS vh_sha, CASE WHEN NOT {blank("VL")} THEN sha256({_release("VL")}) END AS vl_sha,
  {_pair("VH", "VL")} AS pair_sha, CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN 'paired_vh_vl' WHEN NOT {blank("VH")} THEN 'heavy_only' ELSE 'light_only' END AS basis
FROM labels WHERE NOT {blank("VH")} OR NOT {blank("VL")}"""

_OUTSIDE = "[^ABCDEFGHIKLMNPQRSTUVWXYZ*]"
SEQ_QC = rf"""WITH p AS (SELECT *, {_pair("VH", "VL")} pair, concat(VH, VL) both_chains FROM labels)
SELECT label_id AS record, CAST(coalesce(length({_release("VH")}), 0) AS INTEGER) AS vh_length, CAST(coalesce(length({_release("VL")}), 0) AS INTEGER) AS vl_length,
  array_to_string(list_sort(list_distinct(regexp_extract_all({_release("both_chains")}, '{_OUTSIDE}'))), '') AS illegal, contains(both_chains, '*') AS has_stop,
  regexp_matches(both_chains, '[\s\x{{00A0}}]') AS has_space, CASE WHEN pair IS NULL THEN 0 ELSE count(*) OVER (PARTITION BY pair) END AS pair_group_size FROM p"""


def _seq_profile(role: str, c: str) -> str:
    s = rf"upper(regexp_replace({c}, '[\s*]+', '', 'g'))"
    return f"""SELECT '{role}' AS role, count(*) AS n_values, count(DISTINCT {s}) AS n_distinct, CAST(min(length({s})) AS INTEGER) AS shortest, CAST(max(length({s})) AS INTEGER) AS longest,
  quantile_cont(length({s}), 0.5) AS median_length, count(*) FILTER (regexp_matches({s}, '{_OUTSIDE}')) AS n_illegal FROM labels WHERE NOT {blank(c)}"""


SEQ_TABLE_PROFILE = _seq_profile("vh", "VH") + " UNION ALL " + _seq_profile("vl", "VL")

_NAME = rf"nullif(lower(regexp_replace(trim(nfc_normalize(antibody_name), ' ' || chr(9) || chr(10) || chr(160)), '[\s\x{{00A0}}]+', ' ', 'g')), '')"
_MARK = r"\b(?:mutant|variant|wild[\s_-]*type|wt|parent|parental|mutein)\b"
_IDENTITY = f"""names AS (SELECT DISTINCT {coded("antibody_id", "DOTAD")} id, {_NAME} name FROM antibody_metadata WHERE antibody_id IS NOT NULL AND {_NAME} IS NOT NULL),
pairs AS (SELECT DISTINCT {coded("antibody_id", "DOTAD")} id, {_pair("VH", "VL")} pair FROM labels WHERE {coded("antibody_id", "DOTAD")} IS NOT NULL AND {_pair("VH", "VL")} IS NOT NULL),
np AS (SELECT DISTINCT name, pair, id FROM names JOIN pairs USING (id)),
roots AS (SELECT DISTINCT id, trim(regexp_replace(regexp_replace(name, '{_MARK}', ' ', 'g'), '[^0-9a-z]+', ' ', 'g')) root, regexp_matches(name, '{_MARK}') marked FROM names)"""
IDENTITY_CANDIDATES = f"""WITH {_IDENTITY}
SELECT 'same_id_different_pairs' AS category, id AS conflict_key, count(*) AS n_members, min(pair) AS member_a, max(pair) AS member_b FROM pairs GROUP BY id HAVING count(*) > 1
UNION ALL SELECT 'different_ids_same_pair', pair, count(*), min(id), max(id) FROM pairs GROUP BY pair HAVING count(*) > 1
UNION ALL SELECT 'same_normalized_name_different_pairs', name, count(DISTINCT pair), min(pair), max(pair) FROM np
  WHERE name IN (SELECT name FROM names GROUP BY name HAVING count(*) > 1) GROUP BY name HAVING count(DISTINCT pair) > 1
UNION ALL SELECT 'different_names_same_pair', pair, count(DISTINCT name), min(name), max(name) FROM np
  WHERE pair IN (SELECT pair FROM pairs GROUP BY pair HAVING count(*) = 1) GROUP BY pair HAVING count(DISTINCT name) > 1
UNION ALL SELECT 'alias_across_ids', name, count(*), min(id), max(id) FROM names GROUP BY name HAVING count(*) > 1
UNION ALL SELECT 'parent_mutant_candidate', root, count(DISTINCT id), min(id), max(id) FROM roots WHERE root <> '' GROUP BY root HAVING count(DISTINCT id) > 1 AND bool_or(marked)"""


def _context(c: str) -> str:
    return f"nullif(lower(trim({c})), '')"


_NONE = "('', 'na', 'n/a', 'nan', 'null', 'none', 'nd', 'n.d.', '--', '-', '?', '??', 'unknown', 'tbd', 'tbc')"


def _value(c: str) -> str:
    return f"CASE WHEN {_context(c)} IN {_NONE} THEN NULL ELSE {_context(c)} END"


RELATIONSHIP_GROUPS = f"""WITH {_IDENTITY}, ctx AS (
  SELECT {coded("antibody_id", "DOTAD")} id, {_NAME} name, {_value("Format")} fmt, {_value("Target")} tgt, {_value("Highest_Clin_Trial")} stg FROM antibody_metadata WHERE antibody_id IS NOT NULL
), shared AS (SELECT pair, count(*) n, min(id) first_id, count(*) FILTER (id IN (SELECT id FROM ctx)) known FROM pairs GROUP BY pair HAVING count(*) > 1
), facts AS (
  SELECT pair, count(DISTINCT name) nn, count(DISTINCT fmt) nf, count(DISTINCT tgt) nt, count(DISTINCT stg) ns FROM pairs JOIN ctx USING (id) GROUP BY pair
), rts AS (SELECT pair, min(root) r1, max(root) r2, bool_or(marked) m FROM pairs JOIN roots USING (id) WHERE root <> '' GROUP BY pair
), classed AS (SELECT shared.*, CASE WHEN known < n AND known > 0 THEN 'metadata_to_sequence_only_link' WHEN coalesce(nn, 0) <= 1 THEN 'same_name_same_pair'
  WHEN r1 = r2 AND m THEN 'parent_derivative_candidate' WHEN nf > 1 THEN 'same_variable_domain_distinct_format'
  WHEN nt > 1 OR ns > 1 THEN 'same_variable_domain_distinct_product' ELSE 'different_name_same_pair_same_context' END c
  FROM shared LEFT JOIN facts USING (pair) LEFT JOIN rts USING (pair))
SELECT pair AS pair_fingerprint, n AS member_count, first_id, c AS relationship_class, CASE WHEN c IN ('metadata_to_sequence_only_link', 'same_variable_domain_distinct_product') THEN 'HIGH'
  WHEN c = 'same_name_same_pair' THEN 'LOW' ELSE 'MEDIUM' END AS review_priority FROM classed"""
RELATIONSHIP_MEMBERS = f"""WITH {_IDENTITY} SELECT pair AS pair_fingerprint, id, id IN (SELECT antibody_id FROM antibody_metadata WHERE antibody_id IS NOT NULL) AS metadata_available
FROM pairs WHERE pair IN (SELECT pair FROM pairs GROUP BY pair HAVING count(*) > 1)"""
COVERAGE_STATUS = f"""WITH a AS (SELECT {coded("antibody_id", "DOTAD")} id, count(*) n FROM antibody_metadata GROUP BY 1), b AS (SELECT {coded("antibody_id", "DOTAD")} id, count(*) n FROM labels GROUP BY 1)
SELECT coalesce(a.id, b.id) AS id, coalesce(a.n, 0) AS n_left, coalesce(b.n, 0) AS n_right, CASE WHEN b.n IS NULL THEN 'metadata_only' WHEN a.n IS NULL THEN 'labels_only' ELSE 'in_both' END AS status
FROM (SELECT * FROM a WHERE id IS NOT NULL) a FULL JOIN (SELECT * FROM b WHERE id IS NOT NULL) b ON a.id = b.id"""

# Conversions are fixed values, so both sides take them from one table; spellings are matched in SQL's own way.
_CONVERSIONS = ", ".join(
    f"('{q}', '{key}', '{kind}', CAST({a!r} AS DOUBLE), CAST({b!r} AS DOUBLE))" for q, units in UNITS.items() if q not in ("concentration", "temperature") for _, kind, a, b, keys in units for key in keys
)


def _convert(x: str) -> str:
    return f"CASE kind WHEN 'power' THEN power(CAST(10 AS DOUBLE), a * ({x}) + b) ELSE a * ({x}) + b END"


_MEASURED_CTE = f"""conversions(q, spelling, kind, a, b) AS (VALUES {_CONVERSIONS}), delivered AS (
  SELECT DISTINCT ON (record_id) record_id, record_layer, source_block_id AS block, {coded("DOTAD_ID", "DOTAD")} id, technical_replicate, assay_endpoint, unit, reported_value,
    CASE WHEN lower(assay_endpoint) LIKE '%hic%' THEN 'hic_rt' WHEN lower(assay_endpoint) LIKE '%tm1%' THEN 'tm1' WHEN lower(assay_endpoint) LIKE '%tit_r%' THEN 'titer'
      WHEN lower(assay_endpoint) LIKE '%titre%' THEN 'titer' WHEN lower(assay_endpoint) LIKE '%visc%' THEN 'viscosity' WHEN lower(assay_endpoint) LIKE '%monomer%' THEN 'monomer' ELSE 'kd' END endpoint,
    coalesce(CAST(production_batch AS VARCHAR), '') batch, coalesce({_value("production_host")}, '') host, coalesce({_value("tag")}, '') tag
  FROM measurements ORDER BY record_id, loaded_at DESC NULLS LAST, withdrawn_at IS NOT NULL DESC, reported_value DESC
), spelled AS ({numbered("delivered", "endpoint")}), m AS (
  SELECT s.* EXCLUDE (x, ukey), {_convert("x")} v, least({_convert("x - (0.005 + 1e-10)")}, {_convert("x + (0.005 + 1e-10)")}) low, greatest({_convert("x - (0.005 + 1e-10)")}, {_convert("x + (0.005 + 1e-10)")}) high
  FROM spelled s LEFT JOIN conversions c ON c.q = s.endpoint AND c.spelling = s.ukey
)"""
_REBUILT = f"""{_MEASURED_CTE}, cells AS (
  SELECT block, id, endpoint, batch, host, tag, count(v) n, sum(CAST(v AS DECIMAL(38, 12))) total FROM m WHERE record_layer = 'raw' AND abs(v) < 1e20 GROUP BY ALL
), joined AS (
  SELECT s.record_id, s.block, s.id, s.endpoint, s.v reported, s.low, s.high, coalesce(sum(c.n), 0) n, sum(c.total) total, concat_ws('|',
    CASE WHEN min(c.batch) <> max(c.batch) THEN 'batch' END, CASE WHEN s.host = '' AND min(c.host) <> max(c.host) THEN 'host' END, CASE WHEN s.tag = '' AND min(c.tag) <> max(c.tag) THEN 'tag' END) ambiguous
  FROM (SELECT * FROM m WHERE record_layer = 'summary') s LEFT JOIN cells c ON s.block IS NOT DISTINCT FROM c.block AND s.id IS NOT DISTINCT FROM c.id AND s.endpoint = c.endpoint
    AND (s.host = '' OR s.host = c.host) AND (s.tag = '' OR s.tag = c.tag) GROUP BY s.record_id, s.block, s.id, s.endpoint, s.v, s.low, s.high, s.host, s.tag
), judged AS (SELECT *, CASE WHEN n > 0 AND ambiguous = '' THEN CAST(total AS DOUBLE) / n END again FROM joined
), verdicts AS (SELECT *, CASE WHEN ambiguous <> '' THEN 'partially_verified' 
  WHEN n = 0 AND NOT EXISTS (FROM cells c WHERE c.block IS NOT DISTINCT FROM judged.block AND c.endpoint = judged.endpoint) THEN 'summary_only_no_raw_counterpart'
  WHEN n = 0 THEN 'missing_raw_input' WHEN reported IS NULL THEN 'partially_verified'
  WHEN block = 'DVPa1' AND again BETWEEN low AND high THEN 'verified_at_reported_precision' WHEN block <> 'DVPa1' AND abs(reported - again) <= 1e-12 THEN 'verified_exact'
  WHEN block <> 'DVPa1' AND abs(reported - again) <= greatest(1e-8 * greatest(abs(reported), abs(again)), 1e-8) THEN 'verified_rounding' ELSE 'not_reproducible' END status FROM judged)"""
RECONSTRUCT_SUMMARY = f"WITH {_REBUILT} SELECT record_id, block, id, endpoint, CAST(n AS BIGINT) AS n, ambiguous, status FROM verdicts"
RECON_STATUS = f"WITH {_REBUILT} SELECT block, endpoint, status, count(*) AS n_summaries FROM verdicts GROUP BY ALL"
REPLICATE_STRUCTURE = f"""WITH {_MEASURED_CTE} SELECT block, id, endpoint, count(v) AS n_values, count(DISTINCT technical_replicate) AS n_replicates, count(DISTINCT nullif(batch, '')) AS n_batch,
  count(DISTINCT nullif(host, '')) AS n_host, count(DISTINCT nullif(tag, '')) AS n_tag FROM m WHERE record_layer = 'raw' GROUP BY 1, 2, 3"""
AMBIGUITY_GUARD = """SELECT l_partkey, count(*) AS n_rows, concat_ws('|', CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END, CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END) AS varying
FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) > 1 OR count(DISTINCT l_linestatus) > 1"""
LEAVE_ONE_OUT = """WITH r AS (SELECT l_orderkey, l_linenumber * 1000000 + l_partkey row_id, l_quantity v FROM lineitem),
f AS (SELECT l_orderkey, (sum(v) - first(v ORDER BY row_id, v)) / (count(*) - 1) reported, sum(CAST(v AS DECIMAL(38, 12))) total, count(*) n FROM r GROUP BY 1 HAVING count(*) > 1)
SELECT l_orderkey, min(row_id) AS left_out, count(*) AS n_candidates FROM r JOIN f USING (l_orderkey)
WHERE abs(CAST(total - CAST(v AS DECIMAL(38, 12)) AS DOUBLE) / (n - 1) - reported) <= 1e-8 GROUP BY 1"""

LINEAGE_CLOSURE = """WITH RECURSIVE e AS (
  SELECT 'order:' || o_orderkey c, 'customer:' || o_custkey p FROM orders UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation
), walk AS (SELECT c record, p ancestor, 1 depth FROM e UNION SELECT walk.record, e.p, walk.depth + 1 FROM walk JOIN e ON e.c = walk.ancestor)
SELECT record, ancestor, min(depth) AS depth FROM walk GROUP BY 1, 2"""
_TABLE = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(output_table, ' ' || chr(9) || chr(10) || chr(160))), '^.*[/\\]', ''), '\.(tsv|csv|parquet|txt|xlsx|json)(\.gz)?$', ''), '[\s\-_.]+', '_', 'g')"
_TABLES = ["antibody_metadata", "identity_review_queue", "identity_relationship_groups", "identity_relationship_members", "measurements"]
LINEAGE_COVERAGE = f"""WITH r AS ({" UNION ".join(f"SELECT '{t}' table_name, lower({squeezed('record_id')}) k FROM {t}" for t in _TABLES)}),
e AS (SELECT DISTINCT {_TABLE} t, lower({squeezed("output_record_id")}) k FROM record_lineage)
SELECT table_name, count(*) AS n_records, count(e.k) AS n_covered, count(e.k) / count(*) AS share FROM r LEFT JOIN e ON e.t = r.table_name AND e.k = r.k WHERE r.k <> '' GROUP BY 1"""
_REQUIRED = ["lineage_id", "output_table", "output_record_id", "input_file", "input_sheet", "input_column_or_columns", "transformation_rule_id"]
LINEAGE_RULES = " UNION ALL ".join(
    [f"SELECT 'blank_{c}' AS rule, count(*) FILTER ({c} IS NULL OR trim({c}) = '') AS violations FROM record_lineage" for c in _REQUIRED]
    + ["SELECT 'bad_hash', count(*) FILTER (NOT regexp_matches(input_file_sha256, '^[0-9a-f]{64}$')) FROM record_lineage",
       "SELECT 'bad_commit', count(*) FILTER (NOT regexp_matches(transformation_script_commit, '^[0-9a-f]{40}$')) FROM record_lineage",
       "SELECT 'bad_row', count(*) FILTER (input_excel_row < 1) FROM record_lineage",
       "SELECT 'repeated_id', count(*) FROM (SELECT lineage_id FROM record_lineage GROUP BY 1 HAVING count(*) > 1)"]
)
_IDS = {"antibody_metadata": "antibody_id", "measurements": "record_id", "labels": "antibody_id", "record_lineage": "lineage_id", "orders": "o_custkey"}
CORE_COUNTS = " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, unnest(['rows', 'ids', 'distinct_ids', 'repeated_ids']) AS metric, unnest([count(*), count(k), count(DISTINCT k), count(k) - count(DISTINCT k)]) AS value "
    f"FROM (SELECT nullif({strip(f'CAST({c} AS VARCHAR)')}, '') k FROM {t})" for t, c in _IDS.items()
)
_GROUPED = """d AS (SELECT relationship_group_id g, max(member_count) declared FROM identity_relationship_groups GROUP BY 1),
a AS (SELECT relationship_group_id g, count(DISTINCT record_id) actual FROM identity_relationship_members GROUP BY 1)"""
DECLARED_VS_ACTUAL = f"""WITH {_GROUPED}, j AS (SELECT coalesce(d.g, a.g) g, coalesce(declared, 0) declared, coalesce(actual, 0) actual FROM d FULL JOIN a ON d.g = a.g),
u AS (SELECT * FROM j UNION ALL SELECT 'TOTAL', CAST(sum(declared) AS BIGINT), CAST(sum(actual) AS BIGINT) FROM j)
SELECT g AS relationship_group_id, declared, actual, actual - declared AS difference,
  CASE WHEN actual = declared THEN 'equal' WHEN declared = 0 THEN 'undeclared' WHEN actual = 0 THEN 'absent' ELSE 'differs' END AS status FROM u"""
CLAIM_VERDICTS = f"""WITH {_GROUPED}, c AS (SELECT DISTINCT record_id, relationship_group_id g, member_count FROM identity_relationship_groups)
SELECT CASE WHEN actual IS NULL THEN 'unresolved' WHEN member_count IS NULL THEN 'not_numeric' WHEN actual = member_count THEN 'verified_exact'
  WHEN abs(actual - member_count) <= 0.01 * abs(member_count) THEN 'verified_rounding' ELSE 'contradicted' END AS verdict, count(*) AS n_claims FROM c LEFT JOIN a USING (g) GROUP BY 1"""
UNIQUE_LOOKUP = f"""WITH m AS (SELECT antibody_id id, count(*) n FROM antibody_metadata WHERE antibody_id IS NOT NULL GROUP BY 1)
SELECT CASE WHEN n IS NULL THEN 'no_match' WHEN n = 1 THEN 'one_match' ELSE 'several_matches' END AS match_status, count(*) AS n_rows, count(*) FILTER (n = 1) AS n_looked_up
FROM (SELECT {coded("antibody_id", "DOTAD")} id FROM labels) l LEFT JOIN m ON l.id = m.id GROUP BY 1"""
LAST_DELIVERY = """SELECT record_id, antibody_id, antibody_name, withdrawn_at IS NOT NULL AS is_withdrawn FROM antibody_metadata
QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY loaded_at DESC NULLS LAST, withdrawn_at IS NOT NULL DESC) = 1"""
CONTENT_DIFF = """WITH r AS (SELECT record_id, loaded_at, coalesce(CAST(withdrawn_at AS VARCHAR), 'live') c FROM antibody_metadata)
SELECT record_id, 'changed' AS change FROM r GROUP BY 1 HAVING first(c ORDER BY loaded_at, c) <> first(c ORDER BY loaded_at DESC, c DESC)"""
SET_DIFF = """WITH a AS (SELECT DISTINCT c_custkey k FROM customer), b AS (SELECT DISTINCT o_custkey k FROM orders)
SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, (SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) AS n_both,
  (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS n_left_only, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS n_right_only"""
INCREMENTAL_NEW_IDS = f"""WITH r AS (SELECT source_block_id c, {coded("DOTAD_ID", "DOTAD")} id FROM measurements), f AS (SELECT id, min(c) c FROM r WHERE id IS NOT NULL GROUP BY 1),
n AS (SELECT c, count(*) n FROM f GROUP BY 1)
SELECT r.c AS component, count(*) AS n_rows, count(DISTINCT id) AS distinct_ids, coalesce(any_value(n.n), 0) AS new_ids FROM r LEFT JOIN n ON n.c = r.c WHERE id IS NOT NULL GROUP BY 1"""
OVERLAP_FINGERPRINTS = f"""WITH r AS (SELECT source LIKE 'DVP%' curated, {_pair("VH", "VL")} k FROM labels), a AS (SELECT DISTINCT k FROM r WHERE curated AND k IS NOT NULL),
b AS (SELECT DISTINCT k FROM r WHERE NOT curated AND k IS NOT NULL)
SELECT (SELECT count(*) FROM a) AS n_left, (SELECT count(*) FROM b) AS n_right, (SELECT count(*) FROM a WHERE k IN (SELECT k FROM b)) AS n_both,
  (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) AS n_left_only, (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS n_right_only"""
COVERAGE_BY_FAMILY = f"""SELECT lower(coalesce(assay_method, '')) AS family, count(*) AS n_rows, count(DISTINCT {coded("DOTAD_ID", "DOTAD")}) AS n_ids FROM measurements GROUP BY 1"""
SPLIT_LEAKAGE = f"""SELECT g AS grp, count(DISTINCT s) AS n_splits, count(*) AS n_rows FROM (SELECT {coded("sequence_group", "SG")} g,
  CASE WHEN lower(trim(split, ' ' || chr(9))) IN ('dev', 'val', 'valid', 'validation') THEN 'valid' WHEN lower(trim(split, ' ' || chr(9))) IN ('train', 'training') THEN 'train'
    WHEN lower(trim(split, ' ' || chr(9))) IN ('test', 'testing') THEN 'test' WHEN {_value("split")} IS NOT NULL THEN {_value("split")} END s
  FROM labels) WHERE g IS NOT NULL AND s IS NOT NULL GROUP BY 1 HAVING count(DISTINCT s) > 1"""
RELEASE_STATUS = """SELECT source, count(*) AS n_rows, coalesce(bool_or(length(text) > 1000), false) AS any_long_text, bool_and(source_study_id IS NOT NULL) AS all_cited,
  CASE WHEN NOT bool_and(source_study_id IS NOT NULL) THEN 'needs_citation' WHEN bool_or(length(text) > 1000) THEN 'needs_licence_review' ELSE 'releasable' END AS status FROM documents GROUP BY 1"""
TEXT_FLAGS = r"""SELECT doc_id AS record, length(text) > 1000 AS is_long, regexp_matches(text, 'licen[cs]e') AS names_licence,
  regexp_matches(text, '(/home/|/Users/|[A-Z]:\\Users\\)[A-Za-z0-9._-]+') AS personal_path, regexp_matches(text, '10\.[0-9]{4,9}/[^\s"<>)\],;]+') AS has_doi, regexp_matches(text, 'https?://') AS has_url
FROM documents WHERE text IS NOT NULL"""
_CATEGORIES = [
    ("correlation", ["pearson", "spearman", "correlation", "r ="]), ("pca", ["pca", "pc1", "pc2", "pc3", "variance"]), ("statistical_test", ["p <", "p =", "wilcoxon", "test"]),
    ("concordance", ["concordance"]), ("coverage", ["coverage", "covered"]), ("missingness", ["missing", "completeness"]), ("benchmark", ["benchmark", "task"]),
    ("resource_size", ["entry", "record", "annotation", "resource"]), ("composition", ["%", "format"]),
]
CLAIM_CATEGORIES = (
    "SELECT CASE " + " ".join(f"WHEN {' OR '.join(f'contains(lower(text), {chr(39)}{m}{chr(39)})' for m in marks)} THEN '{name}'" for name, marks in _CATEGORIES)
    + " ELSE 'other' END AS category, count(*) AS n_texts FROM documents WHERE text IS NOT NULL GROUP BY 1"
)
VOCABULARY_CHECK = "SELECT status AS value, count(*) AS n FROM identity_review_queue WHERE status IS NULL OR status NOT IN ('PENDING_REVIEW', 'CONFIRMED', 'REJECTED') GROUP BY 1"
RELEASE_RULES = """SELECT 'labels' AS table_name, unnest(['split_named', 'antibody_written', 'value_finite']) AS rule, unnest([count(*) FILTER (NOT coalesce(split IN ('train', 'valid', 'test'), false)),
  count(*) FILTER (NOT coalesce(regexp_matches(antibody_id, '^DOTAD-[0-9]{8}$'), false)), count(*) FILTER (NOT coalesce(abs(label_value) < 1e300, false))]) AS violations FROM labels
UNION ALL SELECT 'lineitem', unnest(['quantity_positive', 'discount_share']), unnest([count(*) FILTER (NOT l_quantity > 0), count(*) FILTER (NOT l_discount BETWEEN 0 AND 1)]) FROM lineitem"""
SET_EQUALITY = """SELECT 'left_only' AS side, relationship_group_id AS value FROM (SELECT relationship_group_id FROM identity_relationship_groups EXCEPT SELECT relationship_group_id FROM identity_relationship_members)
UNION ALL SELECT 'right_only', relationship_group_id FROM (SELECT relationship_group_id FROM identity_relationship_members EXCEPT SELECT relationship_group_id FROM identity_relationship_groups)"""


def _part(label: str, c: str, shown: str) -> str:
    return f"CASE WHEN NOT {blank(c)} THEN '{label}=' || {strip(shown)} END"


CONDITION_KEYS = f"""SELECT coalesce(nullif(concat_ws('|', {_part("host", "production_host", "lower(production_host)")}, {_part("tag", "tag", "tag")}, {_part("pH", "pH", "pH")}), ''),
  'UNSPECIFIED_CONDITION') AS condition, count(*) AS n_rows FROM measurements GROUP BY 1"""
FIRST_VALUES = f"""SELECT coalesce({strip(f'CASE WHEN NOT {blank("PDB")} THEN PDB WHEN NOT {blank("clinical_indication")} THEN clinical_indication WHEN NOT {blank("Target")} THEN Target END')}, '') AS value,
  count(*) AS n_rows FROM antibody_metadata GROUP BY 1"""
ALIAS_ROWS = f"SELECT DISTINCT antibody_id AS id, antibody_name AS alias, {_NAME} AS normal_name FROM antibody_metadata WHERE NOT {blank('antibody_name')}"
PAYLOAD_CELLS = f"""WITH c AS (SELECT unnest(from_json(source_payload_json, '[{{"column_index":"INTEGER","header":"VARCHAR","value":"VARCHAR"}}]')) c FROM measurements),
f AS (SELECT c.header AS header, coalesce(c.value, '') v, c.column_index i FROM c)
SELECT header, {_type("v")} AS type, count(*) AS n_cells, min(i) AS first_index FROM f GROUP BY 1, 2"""
AVAILABILITY = """SELECT coalesce(lower(trim(metadata_available)) IN ('true', '1', 'yes'), false) AS available, TRY_CAST(antibody_names AS DOUBLE) IS NOT NULL AS numeric_name, count(*) AS n_rows
FROM identity_relationship_members GROUP BY 1, 2"""
EVENT_PATHS = """SELECT DISTINCT CASE WHEN value > 50 THEN 'user/' || user_id ELSE event_type END AS source, CASE WHEN value > 50 THEN event_type ELSE 'user/' || user_id END AS target,
  CASE WHEN value > 50 THEN 'script_to_output' ELSE 'input_to_script' END AS edge_type FROM events"""

PROVENANCE_ROWS = """SELECT record_id, antibody_id, Format, excel_row AS source_row, 'metadata.xlsx' AS source_file, 'metadata' AS source_sheet, '1.0' AS release_version FROM antibody_metadata"""
BLOCK_DESCRIPTIONS = f"""SELECT source_block_id, record_layer, count(*) AS n_rows, count(DISTINCT {coded("DOTAD_ID", "DOTAD")}) AS n_ids, count(DISTINCT input_file) AS n_sources, min(input_file) AS first_source
FROM measurements GROUP BY 1, 2"""
SHEET_COUNTS = """SELECT *, CAST(row_number() OVER (ORDER BY first_ordinal NULLS LAST, input_sheet NULLS FIRST) AS INTEGER) AS place
FROM (SELECT input_sheet, count(*) AS n, min(input_excel_row) AS first_ordinal FROM record_lineage GROUP BY 1)"""
_CONFLICTS = ["same_id_different_pairs", "different_ids_same_pair", "same_normalized_name_different_pairs", "different_names_same_pair", "alias_across_ids", "parent_mutant_candidate"]
CATEGORY_PLACES = f"""SELECT category, CAST(list_position({_CONFLICTS}, category) AS INTEGER) AS place, count(*) AS n, first(conflict_key ORDER BY lower(conflict_key), conflict_key) AS first_key
FROM ({IDENTITY_CANDIDATES}) GROUP BY 1"""
TABLE_PATHS = r"""SELECT regexp_replace(replace(output_table, '\', '/'), '^release/', '') AS path, count(*) AS n_edges FROM record_lineage WHERE output_table IS NOT NULL GROUP BY 1"""
FIRST_EDGE = f"SELECT lineage_id, output_table FROM record_lineage WHERE {_TABLE} = 'measurements' ORDER BY lineage_id, output_table LIMIT 1"
OPEN_REVIEWS = f"SELECT record_id, review_id, status FROM identity_review_queue WHERE {blank('status')} OR status NOT IN ('CONFIRMED', 'REJECTED')"
CHAIN_FINGERPRINTS = f"""SELECT basis, count(*) AS n_records, count(DISTINCT CASE WHEN basis = 'paired_vh_vl' THEN h || '|' || l END) AS n_pairs, count(DISTINCT CASE WHEN basis = 'heavy_only' THEN h END) AS n_heavy_only,
  count(DISTINCT CASE WHEN basis = 'light_only' THEN l END) AS n_light_only, CAST(0 AS BIGINT) AS n_full
FROM (SELECT {_release("VH")} h, {_release("VL")} l, CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN 'paired_vh_vl' WHEN NOT {blank("VH")} THEN 'heavy_only' ELSE 'light_only' END basis
  FROM labels WHERE NOT {blank("VH")} OR NOT {blank("VL")}) GROUP BY 1"""


def _metric(c: str) -> str:
    return rf"CASE WHEN NOT {blank(c)} THEN nullif(regexp_replace(upper(trim({c})), '[\x{{FEFF}} \-]+', '', 'g'), '') END"


BEST_IDENTITY = f"""SELECT CASE WHEN h IS NOT NULL AND l IS NOT NULL THEN 'heavy_light' WHEN h IS NOT NULL THEN 'heavy_only' WHEN l IS NOT NULL THEN 'sequence' END AS kind, count(*) AS n_records,
  count(DISTINCT CASE WHEN h IS NOT NULL AND l IS NOT NULL THEN h || '|' || l ELSE coalesce(h, l) END) AS n_identities FROM (SELECT {_metric("VH")} h, {_metric("VL")} l FROM labels) GROUP BY 1"""
_AUDIT = r"upper(regexp_replace({c}, '[\s\x{{00A0}}*]+', '', 'g'))"
PAIR_PROFILE = f"""WITH r AS (SELECT CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN 'pair' WHEN NOT {blank("VH")} THEN 'heavy' WHEN NOT {blank("VL")} THEN 'light' ELSE 'none' END has,
  CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN regexp_replace({_AUDIT.format(c="VH")} || '|' || {_AUDIT.format(c="VL")}, '[^\x00-\x7F]', '', 'g') END pair FROM labels),
p AS (SELECT pair, count(*) n FROM r WHERE pair IS NOT NULL GROUP BY 1)
SELECT count(*) FILTER (has = 'pair') AS n_paired, count(*) FILTER (has = 'heavy') AS n_heavy_only, count(*) FILTER (has = 'light') AS n_light_only, count(*) FILTER (has = 'none') AS n_without,
  (SELECT count(*) FROM p) AS n_distinct_pairs, (SELECT count(*) FROM p WHERE n > 1) AS n_repeated_pairs, CAST((SELECT coalesce(sum(n), 0) FROM p WHERE n > 1) AS BIGINT) AS n_in_repeated_pairs FROM r"""


def _conflict(way: str, key: str, label: str) -> str:
    return f"SELECT '{way}' AS conflict, {key} AS key, count(*) AS n_labels, min({label}) AS first_label, max({label}) AS last_label FROM u GROUP BY {key} HAVING count(*) > 1"


LABEL_CONFLICTS = f"""WITH u AS (SELECT DISTINCT pair, id FROM (SELECT {_pair("VH", "VL")} pair, {coded("antibody_id", "DOTAD")} id FROM labels) WHERE pair IS NOT NULL AND id IS NOT NULL)
{_conflict("pair_with_several_antibodies", "pair", "id")} UNION ALL {_conflict("antibody_with_several_pairs", "id", "pair")}"""
SHEET_CROSSCHECK = """WITH e AS (SELECT input_file f, input_sheet s, min(input_file_sha256) h FROM record_lineage GROUP BY 1, 2),
k AS (SELECT lower(input_file) f, source_sheet s, min(input_file_sha256) h FROM measurements GROUP BY 1, 2)
SELECT CASE WHEN k.f IS NULL THEN 'not_found' WHEN e.h IS NOT DISTINCT FROM k.h THEN 'match' ELSE 'differs' END AS status, count(*) AS n_sheets FROM e LEFT JOIN k ON lower(e.f) = k.f AND e.s = k.s GROUP BY 1"""
COMPONENT_METRICS = f"""WITH r AS (SELECT source_block_id c, {coded("DOTAD_ID", "DOTAD")} id, loaded_at FROM measurements), o AS (SELECT c, row_number() OVER (ORDER BY min(loaded_at), c) p FROM r GROUP BY 1),
f AS (SELECT id, min(p) p FROM r JOIN o USING (c) WHERE id IS NOT NULL GROUP BY 1)
SELECT c AS component, count(*) AS n_rows, count(DISTINCT id) AS distinct_ids, (SELECT count(*) FROM f WHERE f.p = any_value(o.p)) AS new_ids FROM r JOIN o USING (c) WHERE id IS NOT NULL GROUP BY 1"""
ENDPOINT_COVERAGE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER (NOT {blank(c)}) AS n_filled FROM measurements" for c in ("assay_method", "assay_endpoint", "pH", "temperature", "concentration", "unit", "reported_value")
)

_MEASURED_NUMBER = r"TRY_CAST(replace(regexp_extract(trim(reported_value), '^([+-]?[0-9]+(?:[.,][0-9]+)?(?:e[+-]?[0-9]+)?)', 1), ',', '.') AS DOUBLE)"
MEASUREMENT_ROWS = f"""SELECT record_id, {coded("DOTAD_ID", "DOTAD")} AS antibody_id,
  CASE WHEN lower(assay_endpoint) LIKE '%hic%' THEN 'hic_rt' WHEN lower(assay_endpoint) LIKE '%tm1%' THEN 'tm1' WHEN lower(assay_endpoint) LIKE '%tit_r%' THEN 'titer'
    WHEN lower(assay_endpoint) LIKE '%titre%' THEN 'titer' WHEN lower(assay_endpoint) LIKE '%visc%' THEN 'viscosity' WHEN lower(assay_endpoint) LIKE '%monomer%' THEN 'monomer'
    WHEN assay_endpoint IS NOT NULL THEN 'kd' END AS endpoint, {_MEASURED_NUMBER} AS value,
  coalesce(nullif(concat_ws('|', {_part("method", "assay_method", "assay_method")}, {_part("pH", "pH", "pH")}, {_part("host", "production_host", "lower(production_host)")}, {_part("tag", "tag", "tag")},
    CASE WHEN production_batch IS NOT NULL THEN 'batch=' || production_batch END), ''), 'UNSPECIFIED_CONDITION') AS condition,
  concat_ws('!', input_file, source_sheet, source_excel_row) AS source_ref FROM measurements"""
SEQUENCE_ROWS = f"""SELECT label_id, {_release("VH")} AS vh, {_release("VL")} AS vl, CASE WHEN NOT {blank("VH")} AND NOT {blank("VL")} THEN 'paired_vh_vl' WHEN NOT {blank("VH")} THEN 'heavy_only'
  WHEN NOT {blank("VL")} THEN 'light_only' ELSE 'no_sequence' END AS sequence_class FROM labels"""
UNKNOWN_RULES = """SELECT transformation_rule_id AS rule, count(*) AS n_edges FROM record_lineage
WHERE transformation_rule_id IS NULL OR transformation_rule_id NOT IN ('COPY_ROW', 'NORMALISE_UNITS') GROUP BY 1"""
DEFAULT_UNITS = """WITH u AS (SELECT source_block_id b, min(default_unit) lo, max(default_unit) hi FROM source_unit_defaults WHERE quantity = 'concentration' GROUP BY 1)
SELECT CASE WHEN lo IS NULL THEN 'undocumented' WHEN lo <> hi THEN 'ambiguous' ELSE lo END AS unit, count(*) AS n_rows FROM measurements LEFT JOIN u ON b = source_block_id GROUP BY 1"""
STALE_RECORDS = """WITH n AS (SELECT max(loaded_at) newest_input FROM antibody_metadata)
SELECT record_id, loaded_at, newest_input FROM identity_relationship_groups, n WHERE loaded_at < newest_input"""

SQL = {
    "fk_audit": FK_AUDIT, "fk_orphans": FK_ORPHANS, "fk_orphan_report": FK_ORPHANS + " ORDER BY orphan LIMIT 1000", "fk_best_parents": FK_BEST, "key_uniqueness": KEY_UNIQUENESS,
    "column_profile": COLUMN_PROFILE, "column_types": COLUMN_TYPES, "table_profile": TABLE_PROFILE, "duplicate_groups": DUPLICATE_GROUPS, "largest_documents": LARGEST_DOCUMENTS,
    "extension_summary": EXTENSION_SUMMARY, "path_categories": PATH_CATEGORIES, "seq_class": SEQ_CLASS, "seq_fingerprint": SEQ_FINGERPRINT, "seq_qc": SEQ_QC,
    "seq_table_profile": SEQ_TABLE_PROFILE, "identity_candidates": IDENTITY_CANDIDATES, "relationship_groups": RELATIONSHIP_GROUPS, "relationship_members": RELATIONSHIP_MEMBERS,
    "coverage_status": COVERAGE_STATUS, "reconstruct_summary": RECONSTRUCT_SUMMARY, "recon_status": RECON_STATUS, "ambiguity_guard": AMBIGUITY_GUARD,
    "replicate_structure": REPLICATE_STRUCTURE, "leave_one_out": LEAVE_ONE_OUT, "lineage_closure": LINEAGE_CLOSURE, "lineage_coverage": LINEAGE_COVERAGE, "lineage_rules": LINEAGE_RULES,
    "core_counts": CORE_COUNTS, "declared_vs_actual": DECLARED_VS_ACTUAL, "unique_lookup": UNIQUE_LOOKUP, "last_delivery": LAST_DELIVERY, "content_diff": CONTENT_DIFF, "set_diff": SET_DIFF,
    "incremental_new_ids": INCREMENTAL_NEW_IDS, "overlap_fingerprints": OVERLAP_FINGERPRINTS, "coverage_by_family": COVERAGE_BY_FAMILY, "split_leakage": SPLIT_LEAKAGE,
    "release_status": RELEASE_STATUS, "text_flags": TEXT_FLAGS, "claim_categories": CLAIM_CATEGORIES, "claim_verdicts": CLAIM_VERDICTS, "vocabulary_check": VOCABULARY_CHECK,
    "release_rules": RELEASE_RULES, "set_equality": SET_EQUALITY, "condition_keys": CONDITION_KEYS, "first_values": FIRST_VALUES, "alias_rows": ALIAS_ROWS,
    "provenance_rows": PROVENANCE_ROWS, "block_descriptions": BLOCK_DESCRIPTIONS, "sheet_counts": SHEET_COUNTS, "category_places": CATEGORY_PLACES, "table_paths": TABLE_PATHS,
    "first_edge": FIRST_EDGE, "open_reviews": OPEN_REVIEWS, "chain_fingerprints": CHAIN_FINGERPRINTS, "best_identity": BEST_IDENTITY, "pair_profile": PAIR_PROFILE,
    "label_conflicts": LABEL_CONFLICTS, "sheet_crosscheck": SHEET_CROSSCHECK, "component_metrics": COMPONENT_METRICS, "endpoint_coverage": ENDPOINT_COVERAGE,
    "measurement_rows": MEASUREMENT_ROWS, "sequence_rows": SEQUENCE_ROWS, "unknown_rules": UNKNOWN_RULES, "default_units": DEFAULT_UNITS, "stale_records": STALE_RECORDS,
    "payload_cells": PAYLOAD_CELLS, "availability": AVAILABILITY, "event_paths": EVENT_PATHS,
}
