"""Queries of operators on files, headers and small records: each builds its input, whole, and is compared with literal rows.

Files are built in the session's shared folder (a local one: these are small examples).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import identifier_token
from ..operators import claims, comparison, documents, headers, inventory, lineage, profiling, reconstruct, registry, rows, sequences, validation
from ..session import Scratch
from ..sinks import examples, release, text
from ..sources import archives, flat, ooxml, register_all
from .fixtures_sql import SQL  # noqa: F401


def _files(spark: SparkSession) -> str:
    """A folder with one example file of each format."""
    register_all(spark)
    root = Scratch(spark, "examples").root.removeprefix("file://")
    if "://" in root:
        raise ValueError("examples are built in local folders only")
    return str(examples.build(root))


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, text) of a written file; carriage returns show as \\r."""
    with open(path, encoding="utf-8", newline="") as file:
        found = file.read().replace("\r", "\\r").split("\n")
    return spark.createDataFrame(list(enumerate(found, 1)), "line_no int, text string")


def src_workbook_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of a workbook with their physical rows; row 1 is the header, blank rows are skipped."""
    cells = spark.read.format("xlsx_cells").option("sheet", "metadata").load(f"{_files(spark)}/book.xlsx")
    return cells.select("sheet", "excel_row", "column_index", "header", "value", "value_type")


def src_workbook_records(spark: SparkSession, d: str) -> DataFrame:
    """Rows of a sheet whose header is its first filled row, with formulas and cached values."""
    cells = spark.read.format("xlsx_cells").option("header", "first_nonempty").option("sheet", "values").load(f"{_files(spark)}/book.xlsx")
    return ooxml.records(cells, profiling.header_names(["id", "hic_rt_mean", "hic_rt_stddev", "hic_rt_replicates"])).drop("file")


def src_workbook_profile(spark: SparkSession, d: str) -> DataFrame:
    path = f"{_files(spark)}/book.xlsx"
    cells = spark.read.format("xlsx_cells").option("header", "first_nonempty").load(path)
    order = spark.createDataFrame(list(enumerate(ooxml.sheet_names(path), 1)), "place int, sheet string")
    return ooxml.workbook_profile(cells).drop("file").join(order, "sheet")


def src_delimited(spark: SparkSession, d: str) -> DataFrame:
    """Delimited files in three encodings and three delimiters, and a missing one."""
    root = _files(spark)
    parts = [flat.read_delimited(spark, f"{root}/{n}").select(F.lit(n).alias("file"), "id", "text") for n in ("plain.csv", "marked.csv", "latin.csv", "tabs.tsv")]
    missing = flat.read_delimited(spark, f"{root}/none.csv").select(F.lit("none.csv").alias("file"), F.lit("").alias("id"), F.lit("").alias("text"))
    return reduce(DataFrame.unionByName, [*parts, missing])


def src_json(spark: SparkSession, d: str) -> DataFrame:
    """Records of JSON documents, each file by its own shape."""
    return flat.read_json_records(spark, f"{_files(spark)}/*.json")


def src_database(spark: SparkSession, d: str) -> DataFrame:
    found = spark.read.format("sqlite_tables").load(f"{_files(spark)}/base.sqlite")
    return found.select("table_name", "row_count", F.array_join("columns", "|").alias("columns"))


def src_archive_members(spark: SparkSession, d: str) -> DataFrame:
    """Members of an archive, nested ones included, with their safety and whether nested archives were opened."""
    return archives.inspected(spark.read.format("zip_members").load(f"{_files(spark)}/data.zip")).select("member", "depth", "size", "status", "note")


def src_archive_counts(spark: SparkSession, d: str) -> DataFrame:
    return archives.member_counts(archives.inspected(spark.read.format("zip_members").load(f"{_files(spark)}/data.zip")))


def src_archive_tables(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the tables inside an archive, without resource forks, and which row is the header."""
    found = spark.read.format("zip_tables").load(f"{_files(spark)}/data.zip")
    head = archives.header_rows(found.filter("row_no <= 25"), ["vh", "sequence"], ["kd", "fitness"]).withColumnRenamed("row_no", "header_row")
    return found.join(head, ["archive", "member"]).select("member", "row_no", F.array_join("cells", "|").alias("cells"), (F.col("row_no") == F.col("header_row")).alias("is_header"))


def src_private_texts(spark: SparkSession, d: str) -> DataFrame:
    """Personal paths inside the members of archives."""
    return archives.private_texts(spark, f"{_files(spark)}/data.zip", {"personal_path": validation.PERSONAL_PATH})


def src_document(spark: SparkSession, d: str) -> DataFrame:
    """Paragraphs and table rows of a document with the section they stand in."""
    blocks = spark.read.format("docx_paragraphs").load(f"{_files(spark)}/paper.docx")
    return documents.carry_sections(blocks, "file", "paragraph_index", "text", F.col("text").isin("Methods", "References")).select("paragraph_index", "kind", "text", "section")


def src_markdown_table(spark: SparkSession, d: str) -> DataFrame:
    lines = flat.numbered_lines(spark, f"{_files(spark)}/README.md")
    return documents.markdown_rows(lines, "line_no", "text").select("line_no", F.array_join("cells", "|").alias("cells"))


def src_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Files of a folder with media type, kinds and category."""
    found = flat.file_inventory(spark, _files(spark))
    kinds = F.array_join(F.array_compact(F.array(*(F.when(F.col(f"is_{k}"), k) for k in inventory.FILE_KINDS))), "|")
    return found.select("filename", "extension", "media_type", kinds.alias("kinds"), "is_binary", "is_hidden")


def src_scripts(spark: SparkSession, d: str) -> DataFrame:
    """What scripts load, read and write."""
    found = flat.scripts(spark, f"{_files(spark)}/{{run.py,plot.R}}").withColumn("script", F.regexp_extract("path", r"([^/]+)$", 1))
    suffix = F.regexp_extract("script", r"(\.[^.]+)$", 1)
    loads = found.select("script", F.explode(documents.packages_of(F.col("text"), suffix)).alias("what"), F.lit("package").alias("kind"))
    names = documents.script_references(found, "script", "text").select("script", F.col("reference").alias("what"), F.col("direction").alias("kind"))
    purpose = found.select("script", documents.script_purpose(F.col("script"), F.col("text")).alias("what"), F.lit("purpose").alias("kind"))
    return loads.unionByName(names).unionByName(purpose)


def script_edges(spark: SparkSession, d: str) -> DataFrame:
    """Edges between scripts and the files they name, and whether those are there."""
    found = flat.scripts(spark, f"{_files(spark)}/{{run.py,plot.R}}").withColumn("script", F.regexp_extract("path", r"([^/]+)$", 1))
    named = documents.script_references(found, "script", "text")
    files = spark.createDataFrame([("/project/in/data.csv",), ("/project/out/plot.png",), ("/project/other.csv",)], "path string")
    there = documents.resolve_references(named, files, "path").select("reference", "exists").distinct()
    edges = documents.dependency_edges(named)
    return edges.join(there, F.col("reference") == F.when(F.col("edge_type") == "input_to_script", F.col("source")).otherwise(F.col("target"))).select("source", "target", "edge_type", "exists")


def sink_report(spark: SparkSession, d: str) -> DataFrame:
    """A short report of rules, and a release folder's checks."""
    root = _files(spark)
    checks = validation.release_checks(spark, root, {"tabs.tsv": 1, "none.tsv": 2}, [])
    lines = validation.report_markdown(checks, "Checks").split("\n")
    return spark.createDataFrame(list(enumerate(lines, 1)), "line_no int, text string")


def config_scope(spark: SparkSession, d: str) -> DataFrame:
    """A locked configuration, and selections of files against the declared ones."""
    import json
    from pathlib import Path

    from . import config

    root = Path(_files(spark))
    (root / "run.json").write_text(json.dumps({"release_version": "1", "inputs": {"plain.csv": release.sha256_file(root / "plain.csv")}}))
    out = [("locked", config.RunConfig.load(str(root / "run.json"), str(root)).release_version)]
    for name, selected in (("exact", ["plain.csv"]), ("empty", []), ("missing", ["tabs.tsv"]), ("outside", ["plain.csv", "../x"])):
        try:
            out.append((name, ";".join(p.name for p in config.resolve_scope(str(root), ["plain.csv"], selected))))
        except config.ScopeError as error:
            out.append((name, str(error).replace(str(root.resolve()), "ROOT").replace(str(root.resolve().parent), "ABOVE")))
    (root / "plain.csv").write_text("changed")
    try:
        config.RunConfig.load(str(root / "run.json"), str(root))
    except config.ScopeError as error:
        out.append(("changed", str(error)))
    return spark.createDataFrame(out, "step string, outcome string")


def sink_table(spark: SparkSession, d: str) -> DataFrame:
    """A table of every type as deterministic text: the lines of the file."""
    df = spark.sql("""SELECT * FROM VALUES (2, 'tab\there', 1.5D, true, array(1.0D, double('NaN')), date'2025-01-02', timestamp_ntz'2025-01-02 03:04:05.678', 1.50BD),
      (1, 'a "q"', double('Infinity'), cast(null as boolean), cast(null as array<double>), null, null, null) t(i, t, x, b, l, d, at, m)""")
    path = f"{_files(spark)}/table.tsv"
    text.write_tsv(df.repartition(3), path, ["i"])
    return _lines(spark, path)


def sink_union(spark: SparkSession, d: str) -> DataFrame:
    """Tables of different columns in one file with CRLF line ends."""
    a, b = spark.createDataFrame([(1, "x")], "i int, a string"), spark.createDataFrame([(2, 0.1)], "i int, b double")
    path = f"{_files(spark)}/union.tsv"
    text.write_union([a, b], path, ["i"])
    return _lines(spark, path)


def sink_json(spark: SparkSession, d: str) -> DataFrame:
    """JSON with sorted keys, and compact JSON in its own order, non-finite numbers as null."""
    path = f"{_files(spark)}/value.json"
    text.write_json({"b": float("nan"), "a": [1, None, "é"]}, path)
    compact = text.payload_json([{"b": 1, "a": float("inf")}])
    return _lines(spark, path).unionByName(spark.createDataFrame([(0, compact)], "line_no int, text string"))


def sink_release(spark: SparkSession, d: str) -> DataFrame:
    """A release: what safe extraction did, whether archives are the same whatever the files' times, and checksum problems after a change."""
    from pathlib import Path

    root = _files(spark)
    log = [(f"extract {name}", outcome) for name, outcome in release.safe_extract(f"{root}/data.zip", f"{root}/x")]
    log += [(f"again {name}", outcome) for name, outcome in release.safe_extract(f"{root}/data.zip", f"{root}/x") if outcome == "reused"]
    folder = Path(root) / "r"
    folder.mkdir()
    (folder / "README.md").write_text("{{DOI}} of {{DATE}}")
    out = release.publish(str(folder), f"{root}/p", {"DOI": "10.5281/zenodo.1", "DATE": "2026-01-31"})
    log += [("published", (out / "README.md").read_text()), ("problems", ";".join(release.verify_checksums(str(out))))]
    (out / "README.md").write_text("changed")
    log += [("problems after", ";".join(release.verify_checksums(str(out))))]
    for name in ("1.zip", "2.zip"):
        release.deterministic_zip(str(folder), f"{root}/{name}")
        (folder / "README.md").touch()
    log += [("same archive", str(release.sha256_file(f"{root}/1.zip") == release.sha256_file(f"{root}/2.zip")))]
    return spark.createDataFrame(log, "step string, outcome string")


HEADERS = ["DLS kD pH7.0", "HMW %", "titer_productionbatch2", "Assay Data - average（3）", "hic_rt_Avg", "!!"]


def header_forms(spark: SparkSession, d: str) -> DataFrame:
    """Token forms of headers: plain, keeping the percent sign, endpoint and batch, column token, roles and confidence."""
    data = [
        (h, headers.header_token(h), headers.header_token(h, True), headers.canonical_endpoint(h), *headers.endpoint_and_batch(headers.canonical_endpoint(h)), profiling.column_token(h),
         "|".join(profiling.semantic_roles(h)), profiling.role_confidence(h)) for h in HEADERS
    ]
    df = spark.createDataFrame(data, "header string, token string, percent string, endpoint string, raw_endpoint string, batch string, column_token string, roles string, confidence string")
    return df.withColumn("identifier", identifier_token(F.col("header")))


def header_summaries(spark: SparkSession, d: str) -> DataFrame:
    """Summary columns of a sheet as rows, each with its count and spread."""
    df = spark.createDataFrame([("D1", "8.0", "1.4", "2", "110", "7.5"), ("D2", "", None, None, "x", None)], "id string, hic_rt_Avg string, hic_rt_stddev string, hic_rt_replicates string, titer_productionbatch1_mean string, hic_rt_median string")
    return headers.long_summaries(df, ["id"])


def header_columns(spark: SparkSession, d: str) -> DataFrame:
    """Sequence roles of columns by their names, and field names of a sheet with blank and repeated headers."""
    names = ["heavy_vh", "VL", "hc_sequence", "Light chain", "cdr_h3", "sequence", "name"]
    found = [("role", n, r) for n, r in profiling.sequence_columns(names).items()] + [("field", h or "", f) for h, f in zip(["id", "x", "", "x"], profiling.header_names(["id", "x", "", "x"]))]
    return spark.createDataFrame(found, "kind string, header string, value string")


def payload_values(spark: SparkSession, d: str) -> DataFrame:
    """The first cell of a payload under a header, null where that cell is, and the first column that exists under one of several names."""
    data = [(1, [(1, " HIC  rt", "7"), (2, "hic rt", "9")]), (2, [(2, "hic rt", "5"), (1, "HIC RT", None)]), (3, [])]
    df = spark.createDataFrame(data, "id int, payload array<struct<column_index:int,header:string,value:string>>")
    first = rows.first_existing({"b": F.col("id").cast("string"), "c": F.lit("c")}, "a", "b", "c")
    return df.select("id", rows.payload_lookup(F.col("payload"), "HIC RT").alias("value"), first.alias("first_existing"))


def sequence_classes(spark: SparkSession, d: str) -> DataFrame:
    """Seven classes of records by the chains they hold, and the fallback identity of each."""
    df = spark.sql("""SELECT * FROM VALUES ('paired', 'EVQL', 'DIQM', null, null, null, null), ('heavy', 'EVQL', null, 'EVQLV', null, null, null), ('light', ' ', 'DIQM', null, 'DIQMT', null, null),
      ('full', null, null, 'EVQLV', 'DIQMT', null, null), ('cdr', null, null, null, null, 'GFT', null), ('none', null, '', null, null, null, null), ('mixed', 'EVQL', null, null, 'DIQMT', null, null),
      ('both', null, null, 'EVQLV', null, 'GFT', 'RAS') t(id, vh, vl, heavy, light, h_cdr, l_cdr)""")
    have = {c: sequences.present(F.col(c)) for c in ("heavy", "light", "h_cdr", "l_cdr")}
    kind = sequences.sequence_class(F.col("vh"), F.col("vl"), *have.values())
    best = sequences.fallback_fingerprint(F.col("vh"), F.col("vl"), F.coalesce("heavy", "light"), [F.col("h_cdr"), F.col("l_cdr")])
    return df.select("id", kind.alias("sequence_class"), best["kind"].alias("identity_kind"), F.array_join(best["parts"], "|").alias("identity"))


def sequence_forms(spark: SparkSession, d: str) -> DataFrame:
    """Normal forms of a chain for release, audit and metrics, and whether a text looks like one."""
    df = spark.createDataFrame([(" ev ql-s*",), ("ＥＶＱＬＳＧ",), ("\ufeffEVQ LSGx",), ("12", )], "c string")
    c = F.col("c")
    return df.select("c", sequences.release_sequence(c).alias("release"), sequences.audit_sequence(c).alias("audit"), sequences.metric_sequence(c).alias("metric"), sequences.looks_like_sequence(c).alias("looks"))


def script_unique_by(spark: SparkSession, d: str) -> DataFrame:
    """What scripts count as a unique sequence."""
    df = spark.createDataFrame([(1, "df.drop_duplicates(subset=['vh','vl'])"), (2, "n = df['heavy'].nunique()"), (3, "distinct(DOTAD_ID)"), (4, "print(1)"), (5, None)], "id int, t string")
    return df.select("id", sequences.unique_definition(F.col("t")).alias("unique_by"))


RAW = [
    ("g1", "1", "hic", "1", "", 7.0), ("g1", "1", "hic", "1", "", 9.0), ("g1", "1", "hic", "1", "", 20.0), ("g2", "2", "hic", "", "CHO", 5.0), ("g2", "2", "hic", "", "HEK", 9.0),
    ("g3", "4", "tm", "", "", 2.73), ("g3", "4", "tm", "", "", 2.74), ("g3", "7", "tm", "", "", 1.0), ("g4", "8", "kd", "", "", 4.0), ("g4", "8", "kd", "", "", 6.0),
]
SUMMARY = [
    ("a", "g1", "1", "hic", "1", "", 9.0, None, None, "median", None), ("b", "g2", "2", "hic", "", "", 7.0, None, None, "mean", ["host"]), ("c", "g2", "2", "hic", "", "", 7.0, None, None, "mean", None),
    ("d", "g3", "4", "tm", "", "", 2.735, 2.0, 0.00707106781186547, "mean", None), ("e", "g3", "4", "tm", "", "", 2.735, 3.0, None, "mean", None), ("f", "g3", "7", "tm", "", "", 1.000000008, 1.0, None, "mean", None),
    ("g", "g1", "1", "hic", "1", "", 8.0, 2.0, None, "mean", None), ("h", "g4", "8", "kd", "", "", 5.0, 2.0, 9.9, "mean", None), ("i", "g4", "9", "kd", "", "", 5.0, None, None, "mean", None),
    ("j", "g5", "9", "kd", "", "", 5.0, None, None, "mean", None), ("k", "g2", "2", "hic", "", "CHO", 5.0, 1.0, None, "mean", None), ("l", "g2", "2", "hic", "", "HEK", 8.996, None, None, "mean", None),
]
_KEYS = ["block", "id", "endpoint"]


def _recon_input(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    summary = spark.createDataFrame(SUMMARY, "record string, block string, id string, endpoint string, batch string, host string, reported double, reported_n double, reported_sd double, function string, ignored array<string>")
    raw = spark.createDataFrame(RAW, "block string, id string, endpoint string, batch string, host string, value double").withColumn("raw_id", F.concat_ws(":", "block", "id", "host", F.col("value").cast("string")))
    policy = spark.createDataFrame([("g1", "hic", False, False, True), ("g2", "hic", True, False, False), ("g3", "tm", False, True, False)], "block string, endpoint string, two_decimals boolean, documented_filter boolean, may_exclude boolean")
    return summary, raw, policy


def recon_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Medians, ignored conditions, policies, counts and spreads: all statuses of rebuilt summaries."""
    summary, raw, policy = _recon_input(spark)
    found = reconstruct.reconstruct(summary, raw.drop("raw_id"), "record", _KEYS, ["batch", "host"], policy=policy)
    return found.select("record", F.round("recomputed", 6).alias("recomputed"), "n", "ambiguous", "value_status", "sd_status", "count_status", "status")


def recon_contributors(spark: SparkSession, d: str) -> DataFrame:
    """The raw rows behind each summary."""
    summary, raw, _ = _recon_input(spark)
    return reconstruct.contributors(summary.filter("record in ('a', 'b', 'k')"), raw, "record", "raw_id", _KEYS, ["batch", "host"], ["host", "value"])


def claim_statements(spark: SparkSession, d: str) -> DataFrame:
    """Numeric statements: registered ones first, and those that state nothing left out."""
    said = "We hold 324,000 records [12] from 2024 (3) at v. 2.1, and 68% of about 5 million. See Figure 4 and Fig. 7."
    df = spark.createDataFrame([(1, said), (2, "no number"), (3, None), (4, "PMID 7 and 8 rows"), (5, "Grant no. 55")], "id int, t string")
    return claims.numeric_claims(df, "id", "t", {"resource_size": r"hold [\d,]+ records"}).select("record", F.coalesce("claim", F.lit("")).alias("claim"), "start", "token", "value", "unit")


def claim_sources(spark: SparkSession, d: str) -> DataFrame:
    """The files whose paths fit each claim best."""
    known = spark.createDataFrame([("c1", "coverage share"), ("c2", "benchmark"), ("c3", "nothing")], "claim string, about string")
    files = spark.createDataFrame([("x/Metadata_statistics.csv",), ("experimental.tsv",), ("benchmark/set.csv",), ("other",)], "path string")
    return claims.candidate_sources(known, files, "claim", F.col("about"), "path")


def claim_rules(spark: SparkSession, d: str) -> DataFrame:
    """Mappings that count as verified without a command, and statuses that are not resolved."""
    df = spark.createDataFrame([("a", "verified_exact", "run"), ("b", "verified_rounding", " "), ("c", "contradictory", None), ("d", None, None)], "id string, status string, command string")
    bad = validation.mapping_violations(df, "status", "command", "id").select(F.lit("no_command").alias("rule"), "id")
    return bad.unionByName(rows.unresolved(df, "status", ["verified_exact", "verified_rounding"], "id").select(F.lit("unresolved").alias("rule"), "id"))


def source_texts(spark: SparkSession, d: str) -> DataFrame:
    """Links, identifiers, licences, attribution and kind of publication that texts tell."""
    df = spark.createDataFrame([(1, "[CC BY 4.0](https://doi.org/10.5281/zenodo.1.)"), (2, "Apache License 2.0, biorxiv"), (3, "MIT licence of a journal"), (4, "plain")], "id int, t string")
    t = F.col("t")
    return df.select(
        "id", documents.link_text(t).alias("link"), documents.doi_of(t).alias("doi"), documents.licence_name(t).alias("licence"), registry.publication_type(t).alias("kind"),
        registry.attribution(F.concat(F.lit("Title "), F.col("id").cast("string")), F.lit(None).cast("string"), t).alias("attribution"),
    )


def registry_rows(spark: SparkSession, d: str) -> DataFrame:
    """Overrides by key, definitions in full, conflicts of labels both ways, companions with defaults."""
    base = spark.createDataFrame([("s1", "old", None), ("s2", "o", "d"), ("s3", None, None)], "k string, title string, doi string")
    over = spark.createDataFrame([("s1", None, "10.1/a")], "k string, title string, doi string")
    fixed = registry.apply_overrides(base, over, "k").select(F.lit("override").alias("what"), "k", F.concat_ws("|", "title", "doi", F.col("overridden").cast("string")).alias("value"))
    full = registry.explicit_mappings(base, ["title", "doi"]).select(F.lit("explicit").alias("what"), "k", F.col("title").alias("value"))
    pairs = spark.createDataFrame([("p", "a"), ("p", "b"), ("q", "b")], "x string, y string")
    ways = [registry.label_conflicts(pairs, F.col(a), F.col(b)).select(F.lit(f"conflict_{a}").alias("what"), F.col("key").alias("k"), F.concat_ws("|", "first_label", "last_label").alias("value")) for a, b in ("xy", "yx")]
    listed, audited = spark.createDataFrame([("t.csv", "1")], "path string, rows string"), spark.createDataFrame([("t.csv",), ("u.tsv",)], "path string")
    counts = spark.createDataFrame([(2,)], "n_members int")
    companions = rows.companion_rows(listed, audited, "path", {"path": "", "rows": "unknown", "licence": "none"}, counts)
    companions = companions.select(F.lit("companion").alias("what"), F.col("path").alias("k"), F.concat_ws("|", "rows", "licence", "record_source", F.col("n_members").cast("string")).alias("value"))
    single = rows.singleton_if(spark, True, {"k": "vocabulary", "value": "missing"}).unionByName(rows.singleton_if(spark, False, {"k": "x", "value": "y"})).select(F.lit("singleton").alias("what"), "k", "value")
    return reduce(DataFrame.unionByName, [fixed, full, *ways, companions, single])


def lineage_leaves(spark: SparkSession, d: str) -> DataFrame:
    """Where records come from, through references to other records, with the rule of each edge."""
    data = [("a", '["f1","f2"]', "x|y", None, None), ("b", "[]", " a | c|", "o", None), ("c", None, "", "own.csv", "d"), ("d", None, "b", None, "dict"), ("e", None, None, None, "dict")]
    refs = lineage.leaf_references(spark.createDataFrame(data, "id string, e string, r string, o string, d string"), "id", "e", "r", "o", "d")
    edges = lineage.edge_rows(refs, spark.createDataFrame([("own", "COPY_ROW"), ("reference", "DERIVE")], "kind string, rule string"))
    reach = lineage.closure(refs.filter("kind = 'reference'"), "record", "source").select(F.col("record").alias("from_record"), F.col("ancestor"), "depth")
    own = edges.filter("kind <> 'reference'").select(F.col("record").alias("ancestor"), "kind", "source", "rule")
    through = reach.join(own, "ancestor").select(F.col("from_record").alias("record"), "kind", "source", "rule", "depth")
    return edges.filter("kind <> 'reference'").select("record", "kind", "source", "rule", F.lit(0).alias("depth")).unionByName(through)


def output_rules(spark: SparkSession, d: str) -> DataFrame:
    """Twelve checks of a finished output tree."""
    good = "0" * 64
    files = [("a.tsv", 5, good, None), ("A.tsv", 0, good, None), ("b.tsv", 0, "x", None), ("in.csv", 3, good, "1" * 64), ("run.tmp", 1, None, None), ("../x", 1, good, None)]
    tables = [("t", 3, 3, 2, None), ("T", 3, 4, 2, None), ("u", 0, None, 0, None), ("v", None, None, None, " ")]
    return validation.output_checks(
        spark.createDataFrame(files, "path string, size long, sha256 string, sha256_before string"), spark.createDataFrame(tables, "table_name string, row_count long, declared_rows long, column_count int, error string"),
        ["a.tsv", "b.tsv", "missing.tsv"],
    )


def text_findings(spark: SparkSession, d: str) -> DataFrame:
    """Personal paths and prohibited tokens."""
    df = spark.createDataFrame([(1, "see /home/someone/x"), (2, "TODO: remove"), (3, "C:\\Users\\me and todo"), (4, "fine"), (5, None)], "id int, t string")
    return validation.text_safety(df, "id", "t", ["TODO", "confidential"])


def file_versions(spark: SparkSession, d: str) -> DataFrame:
    """Files whose names differ by marks of versions only."""
    df = spark.createDataFrame([(i, n) for i, n in enumerate(["Data_v1.csv", "data v2.csv", "data_final.csv", "data.tsv", "other.csv", "x-2.0.zip", "x_old.zip", None])], "i int, name string")
    return inventory.version_families(df, "i", "name")


def upserts(spark: SparkSession, d: str) -> DataFrame:
    """A keyed table with new rows: the last new row of a key counts, others stay."""
    old, new = spark.createDataFrame([("a", 1, 0), ("b", 2, 0)], "k string, v int, at int"), spark.createDataFrame([("b", 5, 2), ("b", 4, 1), ("c", 6, 1)], "k string, v int, at int")
    return comparison.rebuild_table(old, new, "k", F.col("at"))


PATHS = [
    "raw/a.csv", "x/references.xlsx", "literature_notes.tsv", "metadata_v1.csv", "sequence.fasta", "experimental_raw_1.csv", "experimental_avg.tsv", "x/titeseq.dat", "benchmark.bin", "tmp.bin", "v1/release/z",
    "assets/data/k.json", "figure1_input.dat", "results_plot.png", "run.py", "notes.md", "manuscript.docx", "other.bin", "Sources\\b.bin",
]


def path_kinds(spark: SparkSession, d: str) -> DataFrame:
    """Every category of a path, by the first rule that fits."""
    df = spark.createDataFrame([(p,) for p in PATHS], "path string")
    return df.select("path", inventory.path_category(F.col("path")).alias("category"), inventory.extension_of(F.col("path")).alias("extension"))


def src_row_limit(spark: SparkSession, d: str) -> DataFrame:
    """The first rows of each sheet (a limit is the feature)."""
    cells = spark.read.format("xlsx_cells").option("header", "first_nonempty").option("row_limit", "1").load(f"{_files(spark)}/book.xlsx")
    return cells.select("sheet", "excel_row", "column_index", "value")


def ordinals(spark: SparkSession, d: str) -> DataFrame:
    """Running numbers over groups, and paths that clash."""
    df = spark.createDataFrame([("b",), ("a",), ("A",)], "path string")
    numbered = inventory.ordinal_ids(df, "DG", 5, "path").select(F.lit("group").alias("what"), "path", F.col("group_id").alias("value"))
    return numbered.unionByName(inventory.clashing_paths(df, "path").select(F.lit("clash").alias("what"), F.col("first_path").alias("path"), F.col("n").cast("string").alias("value")))


def claim_differences(spark: SparkSession, d: str) -> DataFrame:
    """Claims against facts with absolute and relative differences."""
    told = spark.createDataFrame([("a", 2.0), ("b", 100.0), ("c", 5.0), ("d", 1.0), ("e", 0.0), ("f", None)], "k string, claimed double")
    return claims.claim_verdicts(told, spark.createDataFrame([("a", 2.0), ("b", 100.5), ("c", 9.0), ("e", 1e-12), ("f", 3.0)], "k string, fact double"), "k")


def metric_rows(spark: SparkSession, d: str) -> DataFrame:
    """Facts and table summaries as rows of metrics."""
    profiles = spark.createDataFrame([("t", 3, "ok"), ("u", 4, "ok"), ("v", 0, "error")], "t string, row_count long, read_status string")
    facts = claims.fact_table({"tables": profiles.agg(F.count(F.lit(1))), "rows": profiles.agg(F.sum("row_count"))})
    return profiling.profile_summary(profiles, "read_status").withColumn("value", F.col("value").cast("double")).unionByName(facts.select(F.concat(F.lit("fact:"), "metric").alias("metric"), F.col("fact").alias("value")))


QUERIES = {
    f.__name__: f
    for f in (
        src_workbook_cells, src_workbook_records, src_workbook_profile, src_delimited, src_json, src_database, src_archive_members, src_archive_counts, src_archive_tables, src_private_texts,
        script_edges, sink_report, config_scope, src_document, src_markdown_table, src_inventory, src_scripts, sink_table, sink_union, sink_json, sink_release, header_forms, header_summaries, header_columns, payload_values,
        sequence_classes, sequence_forms, script_unique_by, recon_verdicts, recon_contributors, claim_statements, claim_sources, claim_rules, source_texts, registry_rows, lineage_leaves,
        output_rules, text_findings, file_versions, upserts, path_kinds, src_row_limit, ordinals, claim_differences, metric_rows,
    )
}
