"""SQL for the general data problems, written apart from the operators."""

from __future__ import annotations

_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = "".join(chr(0x21 + i) for i in range(94)) + " "
_NARROW_SQL = _NARROW.replace("'", "''")
_SPACE = r"[\s\p{Z}\p{Cc}\p{Cf}]+"


def squeezed(c: str) -> str:
    return f"regexp_replace(translate({c}, '{_WIDE}', '{_NARROW_SQL}'), '{_SPACE}', '', 'g')"


def coded(c: str, prefix: str) -> str:
    plain = f"upper({squeezed(c)})"
    number = rf"regexp_extract({plain}, '^{prefix}[\p{{Pd}}\p{{Pc}}−./:]*0*([0-9]+)$', 1)"
    blank = "('','NA','N/A','NAN','NULL','NONE','ND','N.D.','--','-','?','??','UNKNOWN','TBD','TBC')"
    return (
        f"CASE WHEN {plain} IN {blank} THEN NULL WHEN {number} = '' THEN {plain} "
        f"ELSE '{prefix}-' || repeat('0', greatest(0, 8 - length({number}))) || {number} END"
    )


_TABLE = r"regexp_replace(regexp_replace(regexp_replace(lower(trim(output_table, ' ' || chr(9) || chr(10) || chr(160))), '^.*[/\\]', ''), '\.(tsv|csv|parquet|txt|xlsx|json)(\.gz)?$', ''), '[\s\-_.]+', '_', 'g')"

_REFS = f"""
keys AS (
  SELECT 'antibody_metadata' t, lower({squeezed("record_id")}) k, loaded_at, withdrawn_at FROM antibody_metadata
  UNION ALL SELECT 'measurements', lower({squeezed("record_id")}), loaded_at, withdrawn_at FROM measurements
  UNION ALL SELECT 'identity_review_queue', lower({squeezed("record_id")}), loaded_at, withdrawn_at FROM identity_review_queue
  UNION ALL SELECT 'identity_relationship_groups', lower({squeezed("record_id")}), loaded_at, withdrawn_at FROM identity_relationship_groups
  UNION ALL SELECT 'identity_relationship_members', lower({squeezed("record_id")}), loaded_at, NULL FROM identity_relationship_members
  UNION ALL SELECT 'antibody', {coded("antibody_id", "DOTAD")}, loaded_at, withdrawn_at FROM antibody_metadata
), target AS (
  SELECT t, k, min(loaded_at) first_at, bool_and(withdrawn_at IS NOT NULL) gone FROM keys WHERE k IS NOT NULL GROUP BY t, k
), refs AS (
  SELECT DISTINCT 'record_lineage' ref_table, lineage_id ref_id, loaded_at, {_TABLE} t, lower({squeezed("output_record_id")}) k FROM record_lineage
  UNION
  SELECT DISTINCT 'identity_relationship_members', record_id, loaded_at, 'antibody', {coded("antibody_id", "DOTAD")} FROM identity_relationship_members
), cases AS (
  SELECT r.*, CASE WHEN target.k IS NULL THEN 'missing' WHEN gone THEN 'withdrawn' WHEN first_at > r.loaded_at THEN 'late' ELSE 'ok' END state
  FROM refs r LEFT JOIN target ON r.t = target.t AND r.k = target.k
  WHERE r.k IS NOT NULL AND r.k <> '' AND r.t IN ('antibody', 'antibody_metadata', 'measurements', 'identity_review_queue',
    'identity_relationship_groups', 'identity_relationship_members')
)"""

P4_FOUND = f"WITH {_REFS} SELECT DISTINCT ref_table, ref_id, strftime(loaded_at, '%Y-%m') AS period FROM cases WHERE state <> 'ok'"
# The same judgement as of a moment: what had arrived, was withdrawn and referred before it.
_AS_OF = f"""{_REFS}, span AS (SELECT min(loaded_at) a, max(loaded_at) b FROM cases), cuts AS (
  SELECT DISTINCT strftime(cut, '%Y-%m') as_of, cut FROM (SELECT date_trunc('month', a + (b - a) * i / 3) cut, a FROM span, (VALUES (1), (2)) v(i)) WHERE cut > a
  UNION ALL SELECT 'end', NULL
), held AS (
  SELECT as_of, t, k, count(*) FILTER (cut IS NULL OR loaded_at IS NULL OR loaded_at < cut) came,
    count(*) FILTER (withdrawn_at IS NOT NULL AND (cut IS NULL OR withdrawn_at < cut)) went FROM keys, cuts WHERE k IS NOT NULL GROUP BY ALL
), then_open AS (
  SELECT cuts.as_of, c.*, CASE WHEN coalesce(came, 0) = 0 THEN 'missing' WHEN came <= went THEN 'withdrawn' END open_state
  FROM cases c JOIN cuts ON cut IS NULL OR c.loaded_at IS NULL OR c.loaded_at < cut LEFT JOIN held ON held.as_of = cuts.as_of AND held.t = c.t AND held.k = c.k
)"""
P4_REPORT = f"""WITH {_AS_OF} SELECT as_of, ref_table, strftime(loaded_at, '%Y-%m') AS period, open_state AS state, count(*) AS n_references
FROM then_open WHERE open_state IS NOT NULL GROUP BY ALL
UNION ALL SELECT 'end', ref_table, strftime(loaded_at, '%Y-%m'), 'late', count(*) FROM cases WHERE state = 'late' GROUP BY ALL"""

_UNITS = """
units(q, u, spelling, kind, a, b, common) AS (VALUES
  ('concentration','mg/mL','mg/ml','l',1.0,0.0,true), ('concentration','mg/mL','mgml-1','l',1.0,0.0,true), ('concentration','mg/mL','mgperml','l',1.0,0.0,true),
  ('concentration','g/L','g/l','l',1.0,0.0,false), ('concentration','g/L','gl-1','l',1.0,0.0,false), ('concentration','g/L','gramperlitre','l',1.0,0.0,false),
  ('concentration','ug/mL','ug/ml','l',0.001,0.0,false), ('concentration','ug/mL','ugml-1','l',0.001,0.0,false), ('concentration','ug/mL','mcg/ml','l',0.001,0.0,false),
  ('concentration','ug/mL','microgram/ml','l',0.001,0.0,false), ('concentration','ng/uL','ng/ul','l',0.001,0.0,false),
  ('concentration','mg/L','mg/l','l',0.001,0.0,false), ('concentration','mg/L','mgl-1','l',0.001,0.0,false), ('concentration','% w/v','%w/v','l',10.0,0.0,false),
  ('temp','C','c','l',1.0,0.0,true), ('temp','C','°c','l',1.0,0.0,true), ('temp','C','℃','l',1.0,0.0,true), ('temp','C','degc','l',1.0,0.0,true),
  ('temp','C','celsius','l',1.0,0.0,true), ('temp','C','degreescelsius','l',1.0,0.0,true), ('temp','K','k','l',1.0,-273.15,false), ('temp','K','kelvin','l',1.0,-273.15,false),
  ('temp','F','f','f',0.0,0.0,false), ('temp','F','°f','f',0.0,0.0,false), ('temp','F','℉','f',0.0,0.0,false), ('temp','F','degf','f',0.0,0.0,false),
  ('temp','F','degreesfahrenheit','f',0.0,0.0,false),
  ('hic_rt','min','min','l',1.0,0.0,true), ('hic_rt','min','minutes','l',1.0,0.0,true), ('hic_rt','s','s','d',60.0,0.0,false), ('hic_rt','s','sec','d',60.0,0.0,false),
  ('hic_rt','s','secs','d',60.0,0.0,false), ('hic_rt','s','seconds','d',60.0,0.0,false), ('hic_rt','ms','ms','d',60000.0,0.0,false), ('hic_rt','ms','msec','d',60000.0,0.0,false),
  ('hic_rt','ms','milliseconds','d',60000.0,0.0,false),
  ('titer','mg/L','mg/l','l',1.0,0.0,true), ('titer','mg/L','mgl-1','l',1.0,0.0,true), ('titer','ug/mL','ug/ml','l',1.0,0.0,false), ('titer','g/L','g/l','l',1000.0,0.0,false),
  ('titer','g/L','gl-1','l',1000.0,0.0,false), ('titer','mg/mL','mg/ml','l',1000.0,0.0,false), ('titer','mg/mL','mgperml','l',1000.0,0.0,false),
  ('kd','nM','nm','l',1.0,0.0,true), ('kd','nM','nanomolar','l',1.0,0.0,true), ('kd','nM','nmol/l','l',1.0,0.0,true), ('kd','pM','pm','l',0.001,0.0,false),
  ('kd','pM','picomolar','l',0.001,0.0,false), ('kd','pM','pmol/l','l',0.001,0.0,false), ('kd','uM','um','l',1000.0,0.0,false), ('kd','uM','umol/l','l',1000.0,0.0,false),
  ('kd','M','m','l',1e9,0.0,false), ('kd','M','mol/l','l',1e9,0.0,false), ('kd','pKD','pkd','p',-1.0,9.0,false), ('kd','pKD','-log10m','p',-1.0,9.0,false),
  ('kd','log10 M','log10m','p',1.0,9.0,false), ('kd','log10 M','logm','p',1.0,9.0,false),
  ('viscosity','mPas','mpas','l',1.0,0.0,true), ('viscosity','cP','cp','l',1.0,0.0,false), ('viscosity','cP','centipoise','l',1.0,0.0,false),
  ('viscosity','P','p','l',100.0,0.0,false), ('viscosity','P','poise','l',100.0,0.0,false), ('viscosity','Pas','pas','l',1000.0,0.0,false),
  ('monomer','%','%','l',1.0,0.0,true), ('monomer','%','percent','l',1.0,0.0,true), ('monomer','%','pct','l',1.0,0.0,true), ('monomer','‰','‰','d',10.0,0.0,false),
  ('monomer','‰','permille','d',10.0,0.0,false), ('monomer','fraction','fraction','l',100.0,0.0,false), ('monomer','fraction','ratio0-1','l',100.0,0.0,false),
  ('monomer','fraction','mol/mol','l',100.0,0.0,false)
)"""


def _key(c: str) -> str:
    return rf"translate(regexp_replace(lower({c}), '[\s\p{{Z}}\.\*·⋅()\[\]]+', '', 'g'), 'µμ⁻¹', 'uu-1')"


_NUM = r"^\s*([+-]?[0-9]+(?:[.,][0-9]+)?(?:e[+-]?[0-9]+)?)\s*(.*)$"

_NAMED = r"(\((.+)\)|\[(.+)\]|, *(.+)| in (.+))$"
_IN_ENDPOINT = " || ".join(f"regexp_extract(assay_endpoint, '{_NAMED}', {i})" for i in (2, 3, 4, 5))
_WRITTEN = f"CASE WHEN unit IS NULL OR trim(unit) IN ('', '--', 'n/a') THEN {_IN_ENDPOINT} ELSE unit END"


def _cell(cell: str, named: str) -> str:
    return f"""TRY_CAST(replace(regexp_extract({cell}, '{_NUM}', 1), ',', '.') AS DOUBLE) x,
    CASE WHEN trim(regexp_extract({cell}, '{_NUM}', 2)) <> '' THEN regexp_extract({cell}, '{_NUM}', 2) ELSE {named} END written"""


def numbered(rows: str, quantity: str) -> str:
    """``rows`` (block, assay_endpoint, unit, reported_value and ``quantity``) with the number ``x`` of reported_value and the key ``ukey`` of its unit."""
    return f"""SELECT p.* EXCLUDE (written), CASE WHEN trim(written) <> '' THEN {_key("written")} ELSE {_key("d.default_unit")} END ukey
    FROM (SELECT *, {_cell("reported_value", _WRITTEN)} FROM {rows}) p LEFT JOIN source_unit_defaults d ON d.source_block_id = p.block AND d.quantity = p.{quantity}"""


_CELLS = f"""{_UNITS}, cells AS (
  SELECT record_id, source_block_id block, 'concentration' field, 'concentration' q, 'concentration' uq, concentration cell, '' named FROM measurements
  UNION ALL SELECT record_id, source_block_id, 'temperature', 'temperature', 'temp', temperature, '' FROM measurements
  UNION ALL SELECT record_id, source_block_id, 'reported_value', q, CASE q WHEN 'tm1' THEN 'temp' ELSE q END, reported_value, {_WRITTEN}
  FROM (SELECT *, CASE WHEN lower(assay_endpoint) LIKE '%hic%' THEN 'hic_rt' WHEN lower(assay_endpoint) LIKE '%tm1%' THEN 'tm1' WHEN lower(assay_endpoint) LIKE 'tit%' THEN 'titer'
    WHEN lower(assay_endpoint) LIKE '%visc%' THEN 'viscosity' WHEN lower(assay_endpoint) LIKE '%monomer%' THEN 'monomer' ELSE 'kd' END q FROM measurements)
), parsed AS (
  SELECT record_id, block, field, q, uq, {_cell("cell", "named")} FROM cells
), named AS (
  SELECT p.*, CASE WHEN trim(written) <> '' THEN {_key("written")} ELSE {_key("d.default_unit")} END ukey
  FROM parsed p LEFT JOIN source_unit_defaults d ON d.source_block_id = p.block AND d.quantity = p.q WHERE x IS NOT NULL
)"""


def _common(x: str) -> str:
    return f"CASE kind WHEN 'l' THEN a * {x} + b WHEN 'd' THEN {x} / a WHEN 'f' THEN ({x} - 32) * 5 / 9 ELSE power(10, a * {x} + b) END"


P5_FOUND = f"""WITH {_CELLS}
SELECT record_id, field AS quantity, CAST(min(round(1000 * {_common("x")})) AS BIGINT) AS common_value
FROM named JOIN units ON units.q = named.uq AND units.spelling = named.ukey WHERE NOT common GROUP BY record_id, field"""
P5_CLASSES = f"""WITH {_CELLS}
SELECT named.q AS quantity, CASE WHEN trim(written) <> '' THEN 'written' ELSE 'documented' END AS unit_source, round({_common("CAST(1 AS DOUBLE)")}, 6) AS common_of_one, count(*) AS n_values
FROM named JOIN units ON units.q = named.uq AND units.spelling = named.ukey GROUP BY ALL"""

SQL = {"p4_found": P4_FOUND, "p4_report": P4_REPORT, "p5_found": P5_FOUND, "p5_classes": P5_CLASSES}
