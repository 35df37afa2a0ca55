from datetime import datetime

import pytest
from pyspark.sql import functions as F

from assaymill.operators import claims, comparison, documents, identity, integrity, inventory, lineage, profiling, reconstruct, sequences, statistics, validation
from tests.conftest import rows


def test_candidate_and_foreign_keys(spark):
    parent = spark.createDataFrame([("DOTAD-1",), ("DOTAD-2",)], "DOTAD_ID string")
    child = spark.createDataFrame([("DOTAD-1",), ("dotad-3",), ("",), (None,)], "antibody_id string")
    key = integrity.key_audit(parent, "p", ["DOTAD_ID"]).first()
    assert (key["status"], key["duplicate_values"]) == ("confirmed_candidate", 0)
    fk = integrity.foreign_key_audit(child, "antibody_id", parent, "DOTAD_ID", "c->p").first()
    assert (fk["matched"], fk["unmatched"], fk["example_orphans"], fk["child_rows"]) == (1, 1, "DOTAD-3", 4)
    assert rows(integrity.orphan_keys(child, "antibody_id", parent, "DOTAD_ID")) == [("DOTAD-3", 1)]
    empty = integrity.foreign_key_audit(child.limit(0), "antibody_id", parent, "DOTAD_ID", "e").first()
    assert (empty["child_rows"], empty["status"], empty["example_orphans"]) == (0, "no_references", "")


def test_zero_is_a_key_unless_told_otherwise(spark):
    df = spark.createDataFrame([(0,), (1,)], "k long")
    assert [integrity.key_audit(df, "t", ["k"], z).first()["non_missing"] for z in (False, True)] == [2, 1]


def test_best_parents(spark):
    audits = spark.createDataFrame([("c", "p1", 3), ("c", "p2", 5), ("c", "p3", 5), ("d", "p1", 0)], "child string, parent string, matched long")
    assert rows(integrity.best_parents(audits), "child", "parent", "rank") == [("c", "p2", 1), ("c", "p3", 2), ("d", "p1", 1)]


def test_profiles(spark):
    data = [(1, "b", "x", "ACD"), (2, "a", "1", "ACD"), (3, " a ", "2", None), (4, None, "y", ""), (4, None, "y", "")]
    df = spark.createDataFrame(data, "n int, v string, w string, vh_sequence string")
    got = {r["column_name"]: r for r in profiling.column_profile(df, F.col("n"), ["v", "w", "vh_sequence"]).collect()}
    assert (got["v"]["non_missing"], got["v"]["missing"], got["v"]["distinct_values"], got["v"]["samples"]) == (3, 2, 2, "b; a")
    assert got["w"]["dominant_type"] == "string" and got["vh_sequence"]["samples"] == "[sequence redacted]"
    table = profiling.table_profile(df, "t", ["n", "v", "w"]).first()
    assert (table["row_count"], table["duplicate_rows"], table["empty_rows"]) == (5, 1, 0)
    assert profiling.column_profile(df.limit(0), F.col("n"), ["v"]).count() == 0
    tie = spark.createDataFrame([(1, "b"), (2, "7")], "n int, v string")
    assert profiling.column_profile(tie, F.col("n"), ["v"]).first()["dominant_type"] == "string"


def test_headers_and_roles():
    assert profiling.header_names(["antibody_id", "metric", "", "metric"]) == ["antibody_id", "metric__source_column_2", "source_column_3", "metric__source_column_4"]
    assert "sequence" in profiling.semantic_roles("heavy_vh") and profiling.semantic_roles("plain") == [] and profiling.role_confidence("doi") == "high"


def test_inventory(spark):
    df = spark.createDataFrame([(1, "a", "x.csv"), (2, "a", "y.csv"), (3, "b", "x.csv"), (4, None, "z")], "id int, c string, name string")
    got = rows(inventory.duplicate_groups(df, "id", F.col("c"), F.col("name")), "group_kind", "n_items", "first_item", "last_item")
    assert got == [("exact_content", 2, 1, 2), ("same_name_other_content", 2, 1, 3)]
    assert rows(inventory.extension_summary(df, "name", "id")) == [(".csv", 3, 6), ("[no extension]", 1, 4)]
    assert [r["id"] for r in inventory.largest(df, "id", "name", 2).collect()] == [4, 3]
    ids = inventory.ordinal_ids(df, "DG", 5, "id").orderBy("id").first()
    assert ids["group_id"] == "DG00001"
    paths = spark.createDataFrame([("../bad",), ("/bad",), ("root\\..\\bad",), ("c:x",), ("root/ok",), ("ROOT/ok",)], "p string")
    status = [r[0] for r in paths.select(inventory.member_status(F.col("p"), F.lit(False))).collect()]
    assert status == ["path_traversal", "absolute_path", "path_traversal", "drive_qualified_path", "safe", "safe"]
    assert rows(inventory.clashing_paths(paths, "p"), "folded", "n") == [("root/ok", 2)]
    kinds = spark.createDataFrame([("data/raw/x.csv",), ("a/metadata_v1.tsv",), ("make.py",), ("x",)], "p string").select(inventory.path_category(F.col("p")))
    assert [r[0] for r in kinds.collect()] == ["raw_source", "metadata", "script", "unclassified"]


def test_sequences(spark):
    df = spark.createDataFrame([("P1", " aa \n", "cc\t"), ("H1", "AA@*", None), ("L1", None, "TT"), ("N", " ", ""), ("P2", "AA", "CC")], "id string, VH string, VL string")
    prints = {r["record"]: r for r in sequences.fingerprints(df, "id", "VH", "VL").collect()}
    assert prints["H1"]["vh_sha"] == "d0e56b071a07d070adfa06e2595e1a11eea299a23a18bc2cb67a1cdc7a830c8c"
    assert prints["P1"]["vh_sha"] == "58bb119c35513a451d24dc20ef0e9031ec85b35bfc919d263e7e5d9868909cb5"
    assert prints["P1"]["vl_sha"] == "a56362a10c816abf206d72cb914e2d5ca454eb9c7e744f88b1a1422c379e9942"
    assert prints["P1"]["pair_sha"] == prints["P2"]["pair_sha"] == "4b2016000a419e860c94b91f5068a1da704e58b980dc6e869ce421d393332a2d"
    assert "N" not in prints and prints["L1"]["basis"] == "light_only"
    qc = {r["record"]: r for r in sequences.quality(df, "id", "VH", "VL").collect()}
    assert (qc["H1"]["illegal"], qc["H1"]["has_stop"], qc["P1"]["pair_group_size"], qc["N"]["pair_group_size"]) == ("@", True, 2, 0)
    no, yes = F.lit(False), F.lit(True)
    got = df.select(sequences.sequence_class(F.col("VH"), F.col("VL"), no, no, no, no).alias("c"), sequences.sequence_class(F.col("VH"), F.col("VL"), no, yes, no, no).alias("f"))
    assert [tuple(r) for r in got.collect()] == [
        ("paired_vh_vl", "paired_vh_vl"), ("heavy_only", "mixed_or_other"), ("light_only", "light_only"), ("no_sequence", "full_length_only"), ("paired_vh_vl", "paired_vh_vl")
    ]
    text = spark.createDataFrame([("ACD-EF1*",)], "s string").select(sequences.illegal_characters(F.col("s")), sequences.audit_pair_sha(F.lit(" acd ef* "), F.lit("GGH\nII")), sequences.audit_pair_sha(F.lit("ACDEF"), F.lit("gghii"))).first()
    assert text[0] == "-1" and text[1] == text[2]


def test_identity(spark):
    names = spark.createDataFrame([("1", "abc"), ("2", "abc"), ("3", "abc mutant"), ("4", "solo")], "id string, name string")
    pairs = spark.createDataFrame([("1", "p"), ("2", "p"), ("1", "q"), ("4", "s")], "id string, pair string")
    got = {(r["category"], r["conflict_key"]): r["n_members"] for r in identity.identity_candidates(names, pairs).collect()}
    assert got == {
        ("same_id_different_pairs", "1"): 2, ("different_ids_same_pair", "p"): 2, ("same_normalized_name_different_pairs", "abc"): 2, ("alias_across_ids", "abc"): 2,
        ("parent_mutant_candidate", "abc"): 3,
    }
    context = names.select("id", "name", F.lit("igg").alias("format"), F.lit(None).cast("string").alias("target"), F.lit(None).cast("string").alias("stage"))
    groups = identity.relationship_groups(pairs, context, names.filter("id <> '2'").select("id")).collect()
    assert [(g["pair_fingerprint"], g["member_count"], g["relationship_class"]) for g in groups] == [("p", 2, "metadata_to_sequence_only_link")]
    assert rows(identity.members_of(pairs, names.select("id"))) == [("p", "1", True), ("p", "2", True)]
    assert rows(identity.coverage(names.select("id"), pairs.select("id"), "a", "b")) == [("1", 1, 2, "in_both"), ("2", 1, 1, "in_both"), ("3", 1, 0, "a_only"), ("4", 1, 1, "in_both")]


RAW = "block string, id string, endpoint string, batch string, host string, value double"
SUMMARY = "record string, block string, id string, endpoint string, batch string, host string, reported double, reported_n long, reported_sd double"


def test_reconstruction(spark):
    raw = [
        ("g1", "1", "hic", "1", "", 7.0), ("g1", "1", "hic", "1", "", 9.0), ("g2", "2", "hic", "", "CHO", 5.0), ("g2", "2", "hic", "", "HEK", 9.0), ("g3", "3", "hic", "", "", 3.0),
        ("g3", "4", "tm", "", "", 2.73), ("g3", "4", "tm", "", "", 2.74), ("g1", "5", "tm", "1", "", 72.405), ("g1", "6", "tm", "1", "", 72.4052), ("g3", "7", "tm", "", "", 1.0),
    ]
    summary = [
        ("a", "g1", "1", "hic", "", "", 8.0, 2, 1.41421356237), ("b", "g2", "2", "hic", "", "CHO", 5.0, 1, None), ("c", "g2", "2", "hic", "", "", 7.0, 2, None),
        ("d", "g3", "3", "hic", "", "", 3.0, 1, None), ("e", "g3", "4", "tm", "", "", 2.74, None, None), ("f", "g1", "5", "tm", "", "", 72.40, None, None),
        ("g", "g1", "6", "tm", "", "", 72.40, None, None), ("h", "g3", "7", "tm", "", "", 1.000000008, None, None), ("i", "g3", "7", "tm", "", "", 1.0, 2, None),
        ("j", "g3", "9", "tm", "", "", 1.0, None, None), ("k", "g3", "7", "tm", "", "", None, None, None),
        ("l", "g3", "7", "kd", "", "", 1.0, None, None),
    ]
    got = reconstruct.reconstruct(
        spark.createDataFrame(summary, SUMMARY), spark.createDataFrame(raw, RAW), "record", ["block", "id", "endpoint"], ["batch", "host"], F.col("block") == "g1"
    )
    assert dict(rows(got, "record", "status")) == {
        "a": "verified_at_reported_precision", "b": "verified_exact", "c": "partially_verified", "d": "verified_exact", "e": "not_reproducible", "f": "verified_at_reported_precision",
        "g": "not_reproducible", "h": "verified_rounding", "i": "partially_verified", "j": "missing_raw_input", "k": "partially_verified", "l": "summary_only_no_raw_counterpart",
    }
    assert {r["record"]: r["ambiguous"] for r in got.collect()}["c"] == "host"


def test_replicates_and_leave_one_out(spark):
    raw = spark.createDataFrame([("k", 1, 1.0, "x"), ("k", 2, 2.0, "y"), ("k", 3, 9.0, ""), ("l", 1, 4.0, "x")], "k string, i int, value double, host string")
    assert rows(reconstruct.replicate_structure(raw, ["k"], "i", ["host"])) == [("k", 3, 3, 2), ("l", 1, 1, 1)]
    assert rows(reconstruct.ambiguous_conditions(raw, ["k"], ["host"])) == [("k", 3, "host")]
    reported = spark.createDataFrame([("k", 1.5, 2)], "k string, reported double, reported_n long")
    assert rows(reconstruct.leave_one_out(raw, ["k"], "i", reported)) == [("k", 3, 1)]


def test_lineage(spark):
    edges = spark.createDataFrame([("review", "cand"), ("cand", "meta"), ("review", "cand"), ("x", None)], "child string, parent string")
    assert rows(lineage.closure(edges)) == [("cand", "meta", 1), ("review", "cand", 1), ("review", "meta", 2)]
    assert lineage.closure(edges.limit(0)).count() == 0
    with pytest.raises(lineage.LineageCycle):
        lineage.closure(spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "child string, parent string"))
    records = spark.createDataFrame([("t", "1"), ("t", "2"), ("u", "3")], "t string, record string")
    assert rows(lineage.coverage(records, records.filter("record <> '2'"), "t"), "t", "n_covered", "share") == [("t", 1, 0.5), ("u", 1, 1.0)]


def test_comparison(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "k string, x int")
    right = spark.createDataFrame([("a", 10), ("b", 20), ("b", 21), (None, 5)], "k string, y int")
    assert rows(comparison.unique_lookup(left, right, "k", "y"), "k", "looked_up", "match_status") == [("a", 10, "one_match"), ("b", None, "several_matches"), ("c", None, "no_match")]
    assert rows(comparison.last_wins(right.filter("k is not null"), ["k"], F.col("y"))) == [("a", 10), ("b", 21)]
    assert rows(comparison.first_wins(right.filter("k is not null"), ["k"], F.col("y"))) == [("a", 10), ("b", 20)]
    declared, actual = left.select("k", F.col("x").alias("declared")), right.filter("k is not null").groupBy("k").agg(F.count(F.lit(1)).alias("actual"))
    assert rows(comparison.declared_vs_actual(declared, actual, "k"), "k", "difference", "status") == [("TOTAL", -3, "differs"), ("a", 0, "equal"), ("b", 0, "equal"), ("c", -3, "absent")]
    diff = comparison.content_diff(left, spark.createDataFrame([("a", 1), ("b", 9), ("d", 4)], "k string, x int"), "k", "x")
    assert rows(diff) == [("b", "changed"), ("c", "removed"), ("d", "added")]
    assert rows(comparison.set_comparison(left.select("k"), right.select("k"), "k")) == [(3, 2, 2, 1, 0)]
    parts = spark.createDataFrame([("1", "a"), ("1", "a"), ("2", "a"), ("2", "b")], "c string, i string")
    assert rows(comparison.new_per_component(parts, "c", "i")) == [("1", 2, 1, 1), ("2", 2, 2, 1)]
    assert rows(comparison.split_leakage(parts, F.col("i"), F.col("c"))) == [("a", 2, 3)]
    assert rows(comparison.rebuild_table(left, left.filter("k = 'a'").withColumn("x", F.lit(7)), "k")) == [("a", 7), ("b", 2), ("c", 3)]


def test_claims(spark):
    text = "We hold 324,000 records [12] from 2024 (3) at v. 2.1, and 68% of about 5 million. See Figure 4. " + "x " * 60 + "DOI 10.1/x 7"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id int, t string")
    got = [(r["token"], r["value"], r["unit"]) for r in claims.numeric_claims(df, "id", "t").orderBy("start").collect()]
    assert got[:1] == [("324,000", 324000.0, "records")] and ("68", 68.0, "%") in got and ("5", 5e6, "million") in got and not {"12", "2024", "3", "4", "7"} & {t for t, _, _ in got}
    verdicts = claims.claim_verdicts(
        spark.createDataFrame([("a", 2.0), ("b", 100.0), ("c", 5.0), ("d", 1.0)], "k string, claimed double"), spark.createDataFrame([("a", 2.0), ("b", 100.5), ("c", 9.0)], "k string, fact double"), "k"
    )
    assert rows(verdicts, "k", "verdict") == [("a", "verified_exact"), ("b", "verified_rounding"), ("c", "contradicted"), ("d", "unresolved")]


@pytest.mark.parametrize("rule, text", [
    ("reference_list", "as shown [3, 5-7] before"), ("year", "since 1999 on"), ("version", "with Python 3.13 and R 4.2"), ("record_id", "of DOTAD-00012.1 here"), ("label", "see Table 4 and Fig. 2"),
    ("second_figure", "Figures 2 and 3"), ("numbered_source", "project: 88 is"), ("marker", "authors (12) of"), ("link", "at https://x.org/5/7 is"), ("near_identifier", "55 by DOI"),
    ("near_funding", "funded by grant 77 and 12 more"), ("near_date", "March 3, 2020 with 15 rows"),
])
def test_numbers_that_state_nothing(rule, text):
    assert list(claims.stated(text)) == [] and rule in claims.EXCLUSIONS
    assert [c[2] for c in claims.stated("We counted 15 rows, version 3 of 7.5 million.")] == ["15", "3", "7.5"]


def test_registered_claims_and_candidates(spark):
    df = spark.createDataFrame([(1, "A total of 324,000 records in 12 tables."), (2, "none")], "id int, t string")
    got = claims.numeric_claims(df, "id", "t", {"total": r"total of [\d,]+ records", "absent": "zzz"})
    assert rows(got, "claim", "token", "value") == [("total", "total of 324,000 records", None), (None, "12", 12.0)]
    known = spark.createDataFrame([("c1", "coverage share"), ("c2", "benchmark"), ("c3", "nothing")], "claim string, about string")
    files = spark.createDataFrame([("x/Metadata_statistics.csv",), ("experimental.tsv",), ("benchmark/set.csv",), ("other",)], "path string")
    assert rows(claims.candidate_sources(known, files, "claim", F.col("about"), "path")) == [
        ("c1", "experimental.tsv", 1, 2), ("c1", "x/Metadata_statistics.csv", 2, 1), ("c2", "benchmark/set.csv", 1, 1),
    ]


def test_documents(spark):
    script = 'df = read_csv("in/data.csv")\nout_file = path.join(FIGURES_DIR, "Figure (final).pdf")\npage.pdf\ndf.to_csv("res.tsv")\n'
    found = documents.script_references(spark.createDataFrame([("s.py", script), ("e.py", None)], "p string, t string"), "p", "t")
    assert rows(found, "reference", "direction") == [("Figure (final).pdf", "output"), ("in/data.csv", "input"), ("res.tsv", "output")]
    assert documents.dependency_edges(found).count() == 3
    files = spark.createDataFrame([("/root/in/data.csv",)], "path string")
    assert dict(rows(documents.resolve_references(found, files, "path"), "reference", "exists")) == {"Figure (final).pdf": False, "in/data.csv": True, "res.tsv": False}
    packages = spark.createDataFrame([("import os\nfrom a.b import c\n",)], "t string").select(documents.packages_of(F.col("t"), F.lit(".py"))).first()[0]
    assert packages == ["a.b", "os"]
    lines = spark.createDataFrame([(1, "| a | b |"), (2, "|---|:-:|"), (3, "| 1 | 2 |"), (4, "text")], "n int, t string")
    assert [r["cells"] for r in documents.markdown_rows(lines, "n", "t").orderBy("n").collect()] == [["a", "b"], ["1", "2"]]
    paragraphs = spark.createDataFrame([("d", 1, "x"), ("d", 2, "Methods"), ("d", 3, "y")], "d string, n int, t string")
    got = documents.carry_sections(paragraphs, "d", "n", "t", F.col("t") == "Methods").orderBy("n").collect()
    assert [r["section"] for r in got] == ["Front matter", "Methods", "Methods"]
    c = F.col("t")
    links = spark.createDataFrame([("[CC BY 4.0](https://doi.org/10.5281/zenodo.1.)",)], "t string")
    assert tuple(links.select(documents.link_text(c), documents.licence_name(c), documents.doi_of(c)).first()) == ("CC BY 4.0", "CC-BY-4.0", "10.5281/zenodo.1")


def test_validation(spark):
    df = spark.createDataFrame([("a", 1), ("b", None), (None, -1)], "v string, n int")
    got = validation.row_rules(df, "t", {"filled": F.col("v").isNotNull(), "positive": F.col("n") > 0})
    assert rows(got) == [("t", "filled", 1), ("t", "positive", 2)]
    assert "2 violations" in validation.report_markdown(got, "Check")
    assert rows(validation.vocabulary(df, F.col("v"), ["a"])) == [("b", 1), (None, 1)]
    assert dict(rows(validation.core_counts({"t": (df, "v")}), "metric", "value")) == {"rows": 3, "ids": 2, "distinct_ids": 2, "repeated_ids": 0}
    assert rows(validation.set_equality(df.select("v"), df.filter("v = 'a'").select("v"), "v")) == [("left_only", "b"), ("left_only", None)]


def test_explained_variance(spark):
    import numpy as np

    x = np.random.default_rng(1).normal(size=(200, 4)) @ np.diag([5, 2, 1, 1]) + 3
    x[:, 1] += x[:, 0]
    got = [r["share"] for r in statistics.explained_variance(spark.createDataFrame([(v.tolist(),) for v in x] + [(None,), ([1.0],), ([float("nan")] * 4,)], "v array<double>"), "v", 4, 2).orderBy("component").collect()]
    z = (x - x.mean(axis=0)) / x.std(axis=0, ddof=1)
    s = np.linalg.svd(z, compute_uv=False) ** 2
    assert np.allclose(got, (s / s.sum())[:2])
    assert statistics.explained_variance(spark.createDataFrame([], "v array<double>"), "v", 4).count() == 0


def test_results_do_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i % 7, datetime(2025, 1, 1 + i % 5), str(i % 11)) for i in range(200)], "k int, at timestamp, v string")
    seen = []
    for n in (1, 5):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        seen.append(rows(comparison.last_wins(df, ["k"], F.struct("at", "v"))))
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert seen[0] == seen[1]
