import json

import pytest
from pyspark.sql import functions as F

from assaymill.operators import headers, registry
from assaymill.plans import audit
from tests.conftest import rows
from tests.test_files import workbook


def test_headers(spark):
    assert headers.canonical_endpoint("DLS kD pH7.0") == "dls_kd_ph7" and headers.header_token("HMW %", True) == "hmw_%" and headers.header_token("HMW %") == "hmw"
    assert headers.endpoint_and_batch("titer_productionbatch2") == ("titer", "2") and headers.endpoint_and_batch("dlskd_pbsph7.4", {"dlskd_pbsph7.4": "dlskd_ph7.4"}) == ("dlskd_ph7.4", None)
    df = spark.createDataFrame([("D1", "8.0", "1.4", "2", "110"), ("D2", "", None, None, "x")], "antibody_id string, hic_rt_Avg string, hic_rt_stddev string, hic_rt_replicates string, titer_productionbatch1_mean string")
    got = headers.long_summaries(df, ["antibody_id"])
    assert rows(got, "antibody_id", "endpoint", "function", "batch", "reported", "reported_n") == [("D1", "hic_rt", "avg", None, 8.0, 2.0), ("D1", "titer", "mean", "1", 110.0, None)]
    assert headers.long_summaries(df.select("antibody_id"), ["antibody_id"]).count() == 0
    raw = spark.createDataFrame([("D1", 7.0, None)], "antibody_id string, `HIC RT` double, other double")
    assert rows(headers.long_replicates(raw, ["antibody_id"], ["hic_rt"])) == [("D1", "hic_rt", 7.0)]
    assert headers.resolve(["a", "Antibody ID", "antibody_id"], ("id", "antibody id")) == "Antibody ID" and headers.resolve(["a"], ("b",)) is None
    assert rows(raw.select(headers.picked(raw, "nope", "HIC_RT").alias("x"))) == [(7.0,)]


def test_registry(spark):
    base = spark.createDataFrame([("s1", "old", None), ("s2_x", "o", "d"), ("s3", None, None)], "k string, title string, doi string")
    over = spark.createDataFrame([("s1", None, "10.1/a")], "k string, title string, doi string")
    assert rows(registry.apply_overrides(base, over, "k")) == [("s1", "old", "10.1/a", True), ("s2_x", "o", "d", False), ("s3", None, None, False)]
    prefixed = spark.createDataFrame([("s", "short"), ("s2", "long")], "p string, title string")
    assert rows(registry.override_by_prefix(base, prefixed, "k", "p"), "k", "title") == [("s1", "short"), ("s2_x", "long"), ("s3", "short")]
    assert rows(registry.evidence(base, "k", ["title", "doi"], ["OLD", "d"])) == [("s1", "OLD"), ("s1", "d"), ("s2_x", "d")]
    texts = spark.createDataFrame([("a", "under CC BY 4.0"), ("a", "Apache 2"), ("b", "MIT"), ("c", None)], "g string, t string")
    assert rows(registry.licences(texts, "g", "t"), "g", "conflict") == [("a", True), ("b", False)]
    assert rows(registry.explicit_mappings(base, ["title", "doi"]), "k") == [("s2_x",)]
    assert rows(registry.label_conflicts(texts, F.col("g"), F.col("t"))) == [("a", 2, "Apache 2", "under CC BY 4.0")]
    assert base.limit(1).select(registry.attribution(F.lit("T "), F.lit(None).cast("string"), F.lit("see 10.5281/z.1"))).first()[0] == "T; https://doi.org/10.5281/z.1"


def test_audit_run(spark, tmp_path):
    data = tmp_path / "in"
    data.mkdir()
    (data / "a.csv").write_text("antibody_id,x\nD1,1\nD2,2\n")
    (data / "b.csv").write_text("antibody_id,x\nD1,1\nD3,\n")
    (data / "copy.csv").write_text("antibody_id,x\nD1,1\nD2,2\n")
    (data / "bad.xlsx").write_text("no workbook")
    workbook(str(data / "w.xlsx"), {"s": {1: ["id", "v", "v"], 2: ["r1", 1, 2]}})
    got = audit.run(spark, str(data), str(tmp_path / "out"))
    assert got == {"mode": "full", "files": 5, "tables": 4, "errors": 1, "inputs_changed": False}
    out = tmp_path / "out"
    assert not (out / "active_run.json").exists() and json.loads((out / "run_metadata.json").read_text())["tables"] == 4
    assert "exact_content" in (out / "duplicate_files.tsv").read_text() and "v__source_column_3" in (out / "column_profiles.tsv").read_text()
    links = (out / "foreign_keys.tsv").read_text()
    assert "b.csv.antibody_id->a.csv.antibody_id\t2\t2\t1\t1\t1\tD3\thas_orphans" in links
    with pytest.raises(ValueError):
        audit.run(spark, str(data), str(out), "other")


def test_config_and_scope(tmp_path):
    from assaymill.plans import config
    from assaymill.sinks.release import sha256_file

    (tmp_path / "a.csv").write_text("x\n")
    file = tmp_path / "c.json"
    file.write_text(json.dumps({"release_version": "1", "inputs": {"a.csv": sha256_file(tmp_path / "a.csv")}}))
    assert config.RunConfig.load(str(file), str(tmp_path)).release_version == "1"
    (tmp_path / "a.csv").write_text("y\n")
    with pytest.raises(config.ScopeError, match="changed"):
        config.RunConfig.load(str(file), str(tmp_path))
    file.write_text("{}")
    with pytest.raises(ValueError, match="missing settings"):
        config.RunConfig.load(str(file), str(tmp_path))
    assert config.resolve_scope(str(tmp_path), ["a.csv"], ["a.csv"]) == [(tmp_path / "a.csv").resolve()]
    for selected in ([], ["b.csv"], ["a.csv", "c.json"], ["a.csv", "../x"]):
        with pytest.raises(config.ScopeError):
            config.resolve_scope(str(tmp_path), ["a.csv"], selected)


def test_candidates_facts_and_summaries(spark, tmp_path):
    from assaymill.operators import claims, lineage, profiling, validation
    from assaymill.sinks.release import verify_checksums, write_checksums

    sources = spark.createDataFrame([(f"s{i:02}",) for i in range(21)], "src string")
    facts = claims.fact_table({"n": sources.agg(F.count(F.lit(1)))})
    assert rows(facts) == [("n", 21.0)]
    records = spark.createDataFrame([("a", '["f1","f2"]', "x|y", None, None), ("b", "[]", " x | y|", "o", None), ("c", None, "", "own.csv", "d"), ("d", None, None, None, "dict")], "id string, e string, r string, o string, d string")
    refs = lineage.leaf_references(records, "id", "e", "r", "o", "d")
    assert rows(refs) == [("a", "embedded", "f1"), ("a", "embedded", "f2"), ("b", "reference", "x"), ("b", "reference", "y"), ("c", "own", "own.csv"), ("d", "dictionary", "dict")]
    edges = lineage.edge_rows(refs, spark.createDataFrame([("own", "COPY")], "kind string, rule string"))
    assert edges.select("lineage_id").distinct().count() == 6 and rows(edges.filter("rule is not null"), "record") == [("c",)]
    with pytest.raises(ValueError, match="without lineage"):
        lineage.leaf_references(spark.createDataFrame([("z", None, None, None, None)], records.schema), "id", "e", "r", "o", "d")
    profiles = spark.createDataFrame([("t", 3, "ok"), ("u", 4, "ok"), ("v", 0, "error")], "t string, row_count long, read_status string")
    assert rows(profiling.profile_summary(profiles, "read_status")) == [("rows", 7), ("status:error", 1), ("status:ok", 2), ("tables", 3)]
    (tmp_path / "t.tsv").write_text("a\tb\n1\t2\n")
    write_checksums(str(tmp_path))
    checks = validation.release_checks(spark, str(tmp_path), {"t.tsv": 1, "u.tsv": 2}, verify_checksums(str(tmp_path)))
    assert rows(checks.filter("violations > 0")) == [("u.tsv", "file_present", 1)]
