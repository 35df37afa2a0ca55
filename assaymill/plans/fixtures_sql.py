"""Literal rows that the queries of ``fixtures`` give: recorded from a run and read against the inputs, so they guard against changes.

They are not a second way to the result; where SQL can express an operator over tables, its SQL is in ``reference_sql``.
"""

from __future__ import annotations

# query: columns with their SQL types, and rows
EXPECTED: dict[str, tuple[str, list[tuple]]] = {
    "src_workbook_cells": ("sheet VARCHAR, excel_row INTEGER, column_index INTEGER, header VARCHAR, value VARCHAR, value_type VARCHAR", [
        ('metadata', 3, 1, 'antibody_id', 'DOTAD-001', 'string'),
        ('metadata', 3, 2, 'name', 'example', 'string'),
        ('metadata', 3, 3, '', 'extra', 'string'),
        ('metadata', 3, 4, 'name', 'alias', 'string'),
    ]),
    "src_workbook_records": ("sheet VARCHAR, excel_row INTEGER, id VARCHAR, hic_rt_mean VARCHAR, hic_rt_stddev VARCHAR, hic_rt_replicates VARCHAR", [
        ('values', 4, 'A', '2.5', '0.5', '2'),
        ('values', 6, 'B', '2', None, 'true'),
        ('values', 7, 'C', None, '1', '3'),
    ]),
    "src_workbook_profile": ("sheet VARCHAR, data_rows BIGINT, last_row INTEGER, column_count INTEGER, formula_cells BIGINT, cached_values BIGINT, header_confidence VARCHAR, place INTEGER", [
        ('metadata', 1, 3, 4, 0, 0, 'medium', 1),
        ('values', 3, 7, 4, 2, 1, 'high', 2),
    ]),
    "src_delimited": ("file VARCHAR, id VARCHAR, text VARCHAR", [
        ('latin.csv', '1', 'é'),
        ('latin.csv', '2', 'ü'),
        ('marked.csv', '1', 'é'),
        ('plain.csv', '1', ' lead "q"'),
        ('plain.csv', '2', ''),
        ('tabs.tsv', '1', 'a,b'),
    ]),
    "src_json": ("file VARCHAR, shape VARCHAR, _mapping_key VARCHAR, record VARCHAR", [
        ('dicts.json', 'dict_of_dicts', 'k', '{"a":1}'),
        ('list.json', 'list', None, '{"a":1}'),
        ('list.json', 'list', None, '{"a":2}'),
        ('lists.json', 'dict_of_lists', 'k', '{"a":1}'),
        ('lists.json', 'dict_of_lists', 'l', '{"a":2}'),
        ('object.json', 'object', None, '{"a": 1, "b": [2]}'),
        ('scalar.json', 'scalar', None, '7'),
    ]),
    "src_database": ("table_name VARCHAR, row_count BIGINT, columns VARCHAR", [
        ('empty', 0, 'z'),
        ('t', 2, 'x|y'),
    ]),
    "src_archive_members": ("member VARCHAR, depth INTEGER, size BIGINT, status VARCHAR, note VARCHAR", [
        ('../bad.csv', 0, 4, 'path_traversal', ''),
        ('__MACOSX/x.csv', 0, 3, 'safe', ''),
        ('broken.zip', 0, 4, 'safe', 'broken'),
        ('nested/in.zip', 0, 234, 'safe', 'opened'),
        ('nested/in.zip!note.txt', 1, 19, 'safe', ''),
        ('nested/in.zip!u.tsv', 1, 15, 'safe', ''),
        ('t.csv', 0, 8, 'safe', ''),
    ]),
    "src_archive_counts": ("archive VARCHAR, n_members BIGINT, n_files BIGINT, n_directories BIGINT, n_nested BIGINT, n_unsafe BIGINT", [
        ('data.zip', 7, 7, 0, 2, 1),
    ]),
    "src_archive_tables": ("member VARCHAR, row_no INTEGER, cells VARCHAR, is_header BOOLEAN", [
        ('../bad.csv', 1, 'a|b', True),
        ('nested/in.zip!note.txt', 1, 'see /home/someone/x', True),
        ('nested/in.zip!u.tsv', 1, 'vh|kd', True),
        ('nested/in.zip!u.tsv', 2, 'EVQL|1.5', False),
        ('t.csv', 1, 'x|y', True),
        ('t.csv', 2, '1|2', False),
    ]),
    "src_private_texts": ("archive VARCHAR, member VARCHAR, finding VARCHAR", [
        ('data.zip', 'broken.zip', 'broken'),
        ('data.zip', 'nested/in.zip!note.txt', 'personal_path'),
    ]),
    "script_edges": ("source VARCHAR, target VARCHAR, edge_type VARCHAR, exists BOOLEAN", [
        ('in/data.csv', 'run.py', 'input_to_script', True),
        ('plot.R', 'out/plot.png', 'script_to_output', True),
        ('run.py', 'fig.pdf', 'script_to_output', False),
        ('run.py', 'res.tsv', 'script_to_output', False),
    ]),
    "sink_report": ("line_no INTEGER, text VARCHAR", [
        (1, '# Checks'),
        (2, ''),
        (3, '4 of 5 rules hold.'),
        (4, ''),
        (5, '- none.tsv: file_present (1 violations)'),
        (6, ''),
    ]),
    "config_scope": ("step VARCHAR, outcome VARCHAR", [
        ('changed', 'changed: plain.csv'),
        ('empty', 'no file selected'),
        ('exact', 'plain.csv'),
        ('locked', '1'),
        ('missing', 'missing: ROOT/plain.csv; unexpected: ROOT/tabs.tsv'),
        ('outside', 'outside: ABOVE/x'),
    ]),
    "src_document": ("paragraph_index INTEGER, kind VARCHAR, text VARCHAR, section VARCHAR", [
        (0, 'paragraph', 'Title text', 'Front matter'),
        (1, 'paragraph', 'Methods', 'Methods'),
        (2, 'paragraph', 'We hold 324,000 records [12] in 2024.', 'Methods'),
        (3, 'table_row', 'a | b', 'Methods'),
        (4, 'table_row', 'c | d', 'Methods'),
        (5, 'paragraph', 'References', 'References'),
        (6, 'paragraph', 'PMID 1', 'References'),
    ]),
    "src_markdown_table": ("line_no INTEGER, cells VARCHAR", [
        (2, 'File|Rows'),
        (4, 't.csv|1'),
        (5, 'u.tsv|1'),
    ]),
    "src_inventory": ("filename VARCHAR, extension VARCHAR, media_type VARCHAR, kinds VARCHAR, is_binary BOOLEAN, is_hidden BOOLEAN", [
        ('README.md', '.md', 'text/markdown', 'documentation', False, False),
        ('base.sqlite', '.sqlite', 'application/vnd.sqlite3', 'database', True, False),
        ('book.xlsx', '.xlsx', 'application/vnd.openxmlformats-officedocument.spreadsheetml.sheet', 'spreadsheet', True, False),
        ('data.zip', '.zip', 'application/zip', 'archive', True, False),
        ('dicts.json', '.json', 'application/json', '', False, False),
        ('latin.csv', '.csv', 'text/csv', 'delimited_text', False, False),
        ('list.json', '.json', 'application/json', '', False, False),
        ('lists.json', '.json', 'application/json', '', False, False),
        ('marked.csv', '.csv', 'text/csv', 'delimited_text', True, False),
        ('object.json', '.json', 'application/json', '', False, False),
        ('paper.docx', '.docx', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document', 'documentation', True, False),
        ('plain.csv', '.csv', 'text/csv', 'delimited_text', False, False),
        ('plot.R', '.r', 'application/octet-stream', 'script', False, False),
        ('run.py', '.py', 'text/x-python', 'script', False, False),
        ('scalar.json', '.json', 'application/json', '', False, False),
        ('tabs.tsv', '.tsv', 'text/tab-separated-values', 'delimited_text', False, False),
    ]),
    "src_scripts": ("script VARCHAR, what VARCHAR, kind VARCHAR", [
        ('plot.R', 'Unclassified script/config', 'purpose'),
        ('plot.R', 'dplyr', 'package'),
        ('plot.R', 'ggplot2', 'package'),
        ('plot.R', 'out/plot.png', 'output'),
        ('run.py', 'Figure generation or capture', 'purpose'),
        ('run.py', 'a.b', 'package'),
        ('run.py', 'fig.pdf', 'output'),
        ('run.py', 'in/data.csv', 'input'),
        ('run.py', 'os', 'package'),
        ('run.py', 'res.tsv', 'output'),
    ]),
    "sink_table": ("line_no INTEGER, text VARCHAR", [
        (1, 'i\tt\tx\tb\tl\td\tat\tm'),
        (2, '1\t"a ""q"""\t\t\t\t\t\t'),
        (3, '2\t"tab\there"\t1.5\ttrue\t[1.0,null]\t2025-01-02\t2025-01-02T03:04:05\t1.50'),
        (4, ''),
    ]),
    "sink_union": ("line_no INTEGER, text VARCHAR", [
        (1, 'i\ta\tb\\r'),
        (2, '1\tx\t\\r'),
        (3, '2\t\t0.1\\r'),
        (4, ''),
    ]),
    "sink_json": ("line_no INTEGER, text VARCHAR", [
        (0, '[{"b":1,"a":null}]'),
        (1, '{'),
        (2, '  "a": ['),
        (3, '    1,'),
        (4, '    null,'),
        (5, '    "é"'),
        (6, '  ],'),
        (7, '  "b": null'),
        (8, '}'),
        (9, ''),
    ]),
    "sink_release": ("step VARCHAR, outcome VARCHAR", [
        ('again __MACOSX/x.csv', 'reused'),
        ('again broken.zip', 'reused'),
        ('again nested/in.zip', 'reused'),
        ('again t.csv', 'reused'),
        ('extract ../bad.csv', 'blocked:path_traversal'),
        ('extract __MACOSX/x.csv', 'extracted'),
        ('extract broken.zip', 'extracted'),
        ('extract nested/in.zip', 'extracted'),
        ('extract t.csv', 'extracted'),
        ('problems', ''),
        ('problems after', 'changed: README.md'),
        ('published', '10.5281/zenodo.1 of 2026-01-31'),
        ('same archive', 'True'),
    ]),
    "header_forms": ("header VARCHAR, token VARCHAR, percent VARCHAR, endpoint VARCHAR, raw_endpoint VARCHAR, batch VARCHAR, column_token VARCHAR, roles VARCHAR, confidence VARCHAR, identifier VARCHAR", [
        ('!!', '', '', '', '', None, '', '', 'low', 'unnamed'),
        ('Assay Data - average（3）', 'assay_data_average_3', 'assay_data_average_3', 'assay_data_average_3', 'assay_data_average_3', None, 'assay_data_average_3', 'assay', 'medium', 'assay_data_average_3'),
        ('DLS kD pH7.0', 'dls_kd_ph7_0', 'dls_kd_ph7_0', 'dls_kd_ph7', 'dls_kd_ph7', None, 'dls_kd_ph7_0', 'condition', 'medium', 'dls_kd_ph7_0'),
        ('HMW %', 'hmw', 'hmw_%', 'hmw_%', 'hmw_%', None, 'hmw', '', 'low', 'hmw'),
        ('hic_rt_Avg', 'hic_rt_avg', 'hic_rt_avg', 'hic_rt_avg', 'hic_rt_avg', None, 'hic_rt_avg', '', 'low', 'hic_rt_avg'),
        ('titer_productionbatch2', 'titer_productionbatch2', 'titer_productionbatch2', 'titer_productionbatch2', 'titer', '2', 'titer_productionbatch2', '', 'low', 'titer_productionbatch2'),
    ]),
    "header_summaries": ("id VARCHAR, endpoint VARCHAR, function VARCHAR, batch VARCHAR, reported DOUBLE, reported_n DOUBLE, reported_sd DOUBLE", [
        ('D1', 'hic_rt', 'avg', None, 8.0, 2.0, 1.4),
        ('D1', 'hic_rt', 'median', None, 7.5, 2.0, 1.4),
        ('D1', 'titer', 'mean', '1', 110.0, None, None),
    ]),
    "header_columns": ("kind VARCHAR, header VARCHAR, value VARCHAR", [
        ('field', '', 'source_column_3'),
        ('field', 'id', 'id'),
        ('field', 'x', 'x__source_column_2'),
        ('field', 'x', 'x__source_column_4'),
        ('role', 'Light chain', 'light'),
        ('role', 'VL', 'vl'),
        ('role', 'cdr_h3', 'cdr'),
        ('role', 'hc_sequence', 'heavy'),
        ('role', 'heavy_vh', 'vh'),
        ('role', 'sequence', 'sequence'),
    ]),
    "payload_values": ("id INTEGER, value VARCHAR, first_existing VARCHAR", [
        (1, '7', '1'),
        (2, None, '2'),
        (3, None, '3'),
    ]),
    "sequence_classes": ("id VARCHAR, sequence_class VARCHAR, identity_kind VARCHAR, identity VARCHAR", [
        ('both', 'mixed_or_other', 'sequence', 'EVQLV'),
        ('cdr', 'cdr_only', 'cdr', 'GFT'),
        ('full', 'full_length_only', 'sequence', 'EVQLV'),
        ('heavy', 'heavy_only', 'heavy_only', 'EVQL'),
        ('light', 'light_only', 'sequence', 'DIQMT'),
        ('mixed', 'mixed_or_other', 'heavy_only', 'EVQL'),
        ('none', 'no_sequence', None, None),
        ('paired', 'paired_vh_vl', 'heavy_light', 'EVQL|DIQM'),
    ]),
    "sequence_forms": ("c VARCHAR, release VARCHAR, audit VARCHAR, metric VARCHAR, looks BOOLEAN", [
        (' ev ql-s*', 'EVQL-S*', 'EVQL-S', 'EVQLS*', True),
        ('12', '12', '12', '12', False),
        ('\ufeffEVQ LSGx', '\ufeffEVQLSGX', '\ufeffEVQLSGX', 'EVQLSGX', True),
        ('ＥＶＱＬＳＧ', 'EVQLSG', 'ＥＶＱＬＳＧ', 'ＥＶＱＬＳＧ', False),
    ]),
    "script_unique_by": ("id INTEGER, unique_by VARCHAR", [
        (1, 'vh_vl_pair'),
        (2, 'not_stated'),
        (3, 'identifier'),
        (4, 'not_stated'),
        (5, 'not_stated'),
    ]),
    "recon_verdicts": ("record VARCHAR, recomputed DOUBLE, n BIGINT, ambiguous VARCHAR, value_status VARCHAR, sd_status VARCHAR, count_status VARCHAR, status VARCHAR", [
        ('a', 9.0, 3, '', 'verified_exact', 'not_compared', 'not_compared', 'verified_exact'),
        ('b', 7.0, 2, '', 'verified_at_reported_precision', 'not_compared', 'not_compared', 'verified_at_reported_precision'),
        ('c', None, 2, 'host', 'not_compared', 'not_compared', 'not_compared', 'partially_verified'),
        ('d', 2.735, 2, '', 'verified_exact', 'verified_exact', 'verified_exact', 'verified_with_documented_filter'),
        ('e', 2.735, 2, '', 'verified_exact', 'not_compared', 'not_reproducible', 'partially_verified'),
        ('f', 1.0, 1, '', 'verified_rounding', 'not_compared', 'verified_exact', 'verified_with_documented_filter'),
        ('g', 12.0, 3, '', 'not_reproducible', 'not_compared', 'not_reproducible', 'verified_against_source_summary_with_unexplained_raw_exclusion'),
        ('h', 5.0, 2, '', 'verified_exact', 'not_reproducible', 'verified_exact', 'partially_verified'),
        ('i', None, 0, '', 'not_compared', 'not_compared', 'not_compared', 'missing_raw_input'),
        ('j', None, 0, '', 'not_compared', 'not_compared', 'not_compared', 'summary_only_no_raw_counterpart'),
        ('k', 5.0, 1, '', 'verified_at_reported_precision', 'not_compared', 'verified_exact', 'verified_at_reported_precision'),
        ('l', 9.0, 1, '', 'verified_at_reported_precision', 'not_compared', 'not_compared', 'verified_at_reported_precision'),
    ]),
    "recon_contributors": ("record VARCHAR, raw_id VARCHAR, host VARCHAR, value DOUBLE", [
        ('a', 'g1:1::20.0', '', 20.0),
        ('a', 'g1:1::7.0', '', 7.0),
        ('a', 'g1:1::9.0', '', 9.0),
        ('b', 'g2:2:CHO:5.0', 'CHO', 5.0),
        ('b', 'g2:2:HEK:9.0', 'HEK', 9.0),
        ('k', 'g2:2:CHO:5.0', 'CHO', 5.0),
    ]),
    "claim_statements": ("record INTEGER, claim VARCHAR, start INTEGER, token VARCHAR, value DOUBLE, unit VARCHAR", [
        (1, '', 58, '68', 68.0, '%'),
        (1, '', 71, '5', 5000000.0, 'million'),
        (1, 'resource_size', 3, 'hold 324,000 records', None, ''),
    ]),
    "claim_sources": ("claim VARCHAR, path VARCHAR, score BIGINT, rank INTEGER", [
        ('c1', 'experimental.tsv', 1, 2),
        ('c1', 'x/Metadata_statistics.csv', 2, 1),
        ('c2', 'benchmark/set.csv', 1, 1),
    ]),
    "claim_rules": ("rule VARCHAR, id VARCHAR", [
        ('no_command', 'b'),
        ('unresolved', 'c'),
        ('unresolved', 'd'),
    ]),
    "source_texts": ("id INTEGER, link VARCHAR, doi VARCHAR, licence VARCHAR, kind VARCHAR, attribution VARCHAR", [
        (1, 'CC BY 4.0', '10.5281/zenodo.1', 'CC-BY-4.0', 'dataset', 'Title 1; https://doi.org/10.5281/zenodo.1'),
        (2, '', None, 'Apache-2.0', 'preprint', 'Title 2'),
        (3, '', None, 'MIT', 'journal_article', 'Title 3'),
        (4, '', None, None, 'unknown', 'Title 4'),
    ]),
    "registry_rows": ("what VARCHAR, k VARCHAR, value VARCHAR", [
        ('companion', 't.csv', '1|none|listed|2'),
        ('companion', 'u.tsv', 'unknown|none|audit|2'),
        ('conflict_x', 'p', 'a|b'),
        ('conflict_y', 'b', 'p|q'),
        ('explicit', 's2', 'o'),
        ('override', 's1', 'old|10.1/a|true'),
        ('override', 's2', 'o|d|false'),
        ('override', 's3', 'false'),
        ('singleton', 'vocabulary', 'missing'),
    ]),
    "lineage_leaves": ("record VARCHAR, kind VARCHAR, source VARCHAR, rule VARCHAR, depth INTEGER", [
        ('a', 'embedded', 'f1', None, 0),
        ('a', 'embedded', 'f2', None, 0),
        ('b', 'embedded', 'f1', None, 1),
        ('b', 'embedded', 'f2', None, 1),
        ('b', 'own', 'own.csv', 'COPY_ROW', 1),
        ('c', 'own', 'own.csv', 'COPY_ROW', 0),
        ('d', 'embedded', 'f1', None, 2),
        ('d', 'embedded', 'f2', None, 2),
        ('d', 'own', 'own.csv', 'COPY_ROW', 2),
        ('e', 'dictionary', 'dict', None, 0),
    ]),
    "output_rules": ("rule VARCHAR, violations BIGINT", [
        ('error_unnamed', 1),
        ('hash_malformed', 1),
        ('hash_missing', 1),
        ('input_changed', 1),
        ('no_columns', 1),
        ('path_unsafe', 1),
        ('paths_clash', 1),
        ('required_empty', 1),
        ('required_missing', 1),
        ('rows_differ', 1),
        ('rows_negative', 0),
        ('tables_clash', 1),
        ('temporary_left', 1),
    ]),
    "text_findings": ("record INTEGER, finding VARCHAR", [
        (1, 'personal_path'),
        (2, 'token:TODO'),
        (3, 'personal_path'),
        (3, 'token:TODO'),
    ]),
    "file_versions": ("group_kind VARCHAR, group_key VARCHAR, n_items BIGINT, first_item INTEGER, last_item INTEGER", [
        ('version_family', 'data.csv', 3, 0, 2),
        ('version_family', 'x.zip', 2, 5, 6),
    ]),
    "upserts": ("k VARCHAR, v INTEGER, at INTEGER", [
        ('a', 1, 0),
        ('b', 5, 2),
        ('c', 6, 1),
    ]),
    "path_kinds": ("path VARCHAR, category VARCHAR, extension VARCHAR", [
        ('Sources\\b.bin', 'raw_source', '.bin'),
        ('assets/data/k.json', 'website_export', '.json'),
        ('benchmark.bin', 'benchmark', '.bin'),
        ('experimental_avg.tsv', 'experimental_summary', '.tsv'),
        ('experimental_raw_1.csv', 'experimental_raw', '.csv'),
        ('figure1_input.dat', 'figure_input', '.dat'),
        ('literature_notes.tsv', 'literature_curation', '.tsv'),
        ('manuscript.docx', 'manuscript', '.docx'),
        ('metadata_v1.csv', 'metadata', '.csv'),
        ('notes.md', 'documentation', '.md'),
        ('other.bin', 'unclassified', '.bin'),
        ('raw/a.csv', 'raw_source', '.csv'),
        ('results_plot.png', 'figure_output', '.png'),
        ('run.py', 'script', '.py'),
        ('sequence.fasta', 'sequence', '.fasta'),
        ('tmp.bin', 'intermediate', '.bin'),
        ('v1/release/z', 'release', '[no extension]'),
        ('x/references.xlsx', 'source_download', '.xlsx'),
        ('x/titeseq.dat', 'binding_affinity', '.dat'),
    ]),
    "src_row_limit": ("sheet VARCHAR, excel_row INTEGER, column_index INTEGER, value VARCHAR", [
        ('metadata', 3, 1, 'DOTAD-001'),
        ('metadata', 3, 2, 'example'),
        ('metadata', 3, 3, 'extra'),
        ('metadata', 3, 4, 'alias'),
        ('values', 4, 1, 'A'),
        ('values', 4, 2, '2.5'),
        ('values', 4, 3, '0.5'),
        ('values', 4, 4, '2'),
    ]),
    "ordinals": ("what VARCHAR, path VARCHAR, value VARCHAR", [
        ('clash', 'A', '2'),
        ('group', 'A', 'DG00001'),
        ('group', 'a', 'DG00002'),
        ('group', 'b', 'DG00003'),
    ]),
    "claim_differences": ("k VARCHAR, claimed DOUBLE, fact DOUBLE, difference DOUBLE, relative_difference DOUBLE, verdict VARCHAR", [
        ('a', 2.0, 2.0, 0.0, 0.0, 'verified_exact'),
        ('b', 100.0, 100.5, 0.5, 0.005, 'verified_rounding'),
        ('c', 5.0, 9.0, 4.0, 0.8, 'contradicted'),
        ('d', 1.0, None, None, None, 'unresolved'),
        ('e', 0.0, 1e-12, 0.0, None, 'contradicted'),
        ('f', None, 3.0, None, None, 'not_numeric'),
    ]),
    "metric_rows": ("metric VARCHAR, value DOUBLE", [
        ('fact:rows', 7.0),
        ('fact:tables', 3.0),
        ('rows', 7.0),
        ('status:error', 1.0),
        ('status:ok', 2.0),
        ('tables', 3.0),
    ]),
}


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else repr(value)


def values_sql(columns: str, rows: list[tuple]) -> str:
    """A SELECT of literal rows."""
    typed = [c.rsplit(" ", 1) for c in columns.split(", ")]
    listed = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    selected = ", ".join(f'CAST("{name}" AS {kind}) AS "{name}"' for name, kind in typed)
    names = ", ".join(f'"{name}"' for name, _ in typed)
    return f"SELECT {selected} FROM (VALUES {listed}) t({names})"


SQL = {name: values_sql(*expected) for name, expected in EXPECTED.items()}
