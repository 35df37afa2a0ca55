"""SQL for the training-data queries that SQL can express on whole tables."""

from __future__ import annotations

_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = ("".join(chr(0x21 + i) for i in range(94)) + " ").replace("'", "''")


def _coded(c: str, prefix: str) -> str:
    plain = rf"upper(regexp_replace(translate({c}, '{_WIDE}', '{_NARROW}'), '[\s\p{{Z}}]+', '', 'g'))"
    number = rf"regexp_extract({plain}, '^{prefix}[\p{{Pd}}_]?0*([0-9]+)$', 1)"
    return f"CASE WHEN {number} <> '' THEN '{prefix}-' || lpad({number}, 8, '0') END"


P1_FOUND = f"""WITH RECURSIVE raw AS (
  SELECT {_coded("antibody_id_a", "DOTAD")} a, {_coded("antibody_id_b", "DOTAD")} b FROM identity_review_queue
  WHERE withdrawn_at IS NULL AND (status IS NULL OR upper(trim(status)) <> 'REJECTED')
), e AS (SELECT DISTINCT a, b FROM raw WHERE a <> b UNION SELECT DISTINCT b, a FROM raw WHERE a <> b
), reach(v, r) USING KEY (v) AS (
  SELECT v, min(r) FROM (SELECT a v, least(a, min(b)) r FROM e GROUP BY a) GROUP BY v
  UNION
  SELECT e.b, min(reach.r) FROM reach JOIN e ON e.a = reach.v JOIN recurring.reach cur ON cur.v = e.b WHERE reach.r < cur.r GROUP BY e.b
) SELECT v AS antibody_id, r AS group_antibody_id FROM reach"""

P2_FOUND = f"""WITH RECURSIVE rows0 AS (
  SELECT label_id, {_coded("antibody_id", "DOTAD")} ab, {_coded("sequence_group", "SG")} sg,
    CASE lower(trim(split, ' ' || chr(9))) WHEN 'train' THEN 'train' WHEN 'training' THEN 'train' WHEN 'test' THEN 'test' WHEN 'testing' THEN 'test'
      WHEN 'valid' THEN 'valid' WHEN 'val' THEN 'valid' WHEN 'dev' THEN 'valid' WHEN 'validation' THEN 'valid' END s FROM labels
), e AS (SELECT DISTINCT ab a, sg b FROM rows0 WHERE ab IS NOT NULL AND sg IS NOT NULL UNION SELECT DISTINCT sg, ab FROM rows0 WHERE ab IS NOT NULL AND sg IS NOT NULL
), reach(v, r) USING KEY (v) AS (
  SELECT v, min(r) FROM (SELECT a v, least(a, min(b)) r FROM e GROUP BY a) GROUP BY v
  UNION
  SELECT e.b, min(reach.r) FROM reach JOIN e ON e.a = reach.v JOIN recurring.reach cur ON cur.v = e.b WHERE reach.r < cur.r GROUP BY e.b
), named AS (
  SELECT label_id, s, coalesce(r, ab, sg, 'record ' || label_id) g FROM rows0 LEFT JOIN reach ON v = coalesce(ab, sg)
) SELECT label_id FROM named WHERE g IN (SELECT g FROM named GROUP BY g HAVING count(DISTINCT s) > 1)"""

def _residues(c: str) -> str:
    return rf"nullif(regexp_replace(regexp_replace(upper(translate({c}, '{_WIDE}', '{_NARROW}')), '[\s\p{{Z}}\p{{Cc}}\p{{Cf}}\p{{Pd}}._~−]+', '', 'g'), '\*+$', ''), '')"


# All pairs of distinct sequences whose lengths allow it, by edit distance alone.
_OVERLAPS = f"""r AS (
  SELECT label_id, source, {_residues("VH")} h, {_residues("VL")} l,
    CASE lower(trim(split, ' ' || chr(9))) WHEN 'train' THEN 'train' WHEN 'training' THEN 'train' WHEN 'test' THEN 'test' WHEN 'testing' THEN 'test'
      WHEN 'valid' THEN 'valid' WHEN 'val' THEN 'valid' WHEN 'dev' THEN 'valid' WHEN 'validation' THEN 'valid' END s FROM labels
), u AS (SELECT * FROM r WHERE h IS NOT NULL AND l IS NOT NULL AND s IS NOT NULL
), a AS (SELECT DISTINCT h, l FROM u WHERE s <> 'train'), b AS (SELECT DISTINCT h, l FROM u WHERE s = 'train'
), near AS MATERIALIZED (
  SELECT a.h ha, a.l la, b.h hb, b.l lb FROM a JOIN b ON abs(length(a.h) - length(b.h)) + abs(length(a.l) - length(b.l)) <= 5
), pairs AS (SELECT *, levenshtein(ha, hb) + levenshtein(la, lb) e FROM near)"""
P3_FOUND = f"""WITH {_OVERLAPS}
SELECT least(x.label_id, y.label_id) AS label_id_a, greatest(x.label_id, y.label_id) AS label_id_b
FROM pairs JOIN u x ON x.h = ha AND x.l = la AND x.s <> 'train' JOIN u y ON y.h = hb AND y.l = lb AND y.s = 'train' WHERE e <= 5"""
P3_REPORT = f"""WITH {_OVERLAPS}
SELECT x.s AS split, x.source AS held_source, y.source AS train_source, e = 0 AS equal, count(*) AS n_pairs
FROM pairs JOIN u x ON x.h = ha AND x.l = la AND x.s <> 'train' JOIN u y ON y.h = hb AND y.l = lb AND y.s = 'train' WHERE e <= 5 GROUP BY ALL"""

SQL = {"p1_found": P1_FOUND, "p2_found": P2_FOUND, "p3_found": P3_FOUND, "p3_report": P3_REPORT}
