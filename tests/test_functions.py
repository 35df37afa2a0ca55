import pytest
from pyspark.sql import functions as F

from assaymill.functions import blanks, text
from tests.conftest import rows


def one(spark, expression, *values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return [r[0] for r in df.select(expression(F.col("v")).alias("x")).collect()]


def test_antibody_id_spellings(spark):
    spelled = ["DOTAD-00001234", "dotad 1234", "ＤＯＴＡＤ-００００１２３４", " DOTAD_1234\t", "DOTAD‐00001234\xa0", "DOTAD–1234", "DOTAD00001234"]
    assert set(one(spark, text.antibody_id, *spelled)) == {"DOTAD-00001234"}


def test_antibody_id_of_other_shapes_stays_another_id(spark):
    assert one(spark, text.antibody_id, "DOTAD-00060763.2", "TMP-0-58654", "", " ", None, "n/a") == ["DOTAD-00060763.2", "TMP-0-58654", None, None, None, None]


def test_record_and_table_keys(spark):
    assert one(spark, text.record_key, " EXP: dvpa1_raw:1\n", "exp:DVPA1_raw:1", "ＥＸＰ:dvpa1_raw:1", "  ", None) == ["exp:dvpa1_raw:1"] * 3 + [None, None]
    assert set(one(spark, text.table_key, "release/identity/Antibody Metadata.tsv", "ANTIBODY-METADATA ", "antibody_metadata")) == {"antibody_metadata"}


def test_residues(spark):
    assert one(spark, text.residues, " ac-d..ef* ", "ACDEF", "A*CD", "--", "", None) == ["ACDEF", "ACDEF", "A*CD", None, None, None]


def test_clean_and_placeholders(spark):
    assert one(spark, text.clean, " a \t b ", "plain", "ｆｕｌｌ　ｗｉｄｔｈ", None, "") == ["a b", "plain", "full width", None, ""]
    assert one(spark, text.value_or_null, "N/A", "--", " x ", None) == [None, None, "x", None]


def test_python_text_functions(spark):
    assert one(spark, text.casefold_name, "  Béta ", "STRASSE\tx", None) == ["béta", "strasse x", None]
    assert one(spark, text.identifier_token, "Assay Data - average（3）", "!!") == ["assay_data_average_3", "unnamed"]
    numbers = spark.createDataFrame([(1.5,), (1e22,), (float("nan"),), (None,)], "v double")
    assert [r[0] for r in numbers.select(text.python_number_text(F.col("v"))).collect()] == ["1.5", "1e+22", "", None]


def test_four_blanks(spark):
    df = spark.createDataFrame([(None,), ("",), (" \t",), ("0",), ("NaN",), ("x",)], "v string")
    c = F.col("v")
    got = df.select(blanks.cell_blank(c), blanks.empty(c), blanks.falsy(c, True), blanks.placeholder(c)).collect()
    assert [tuple(r) for r in got] == [
        (True, True, True, True), (True, True, True, True), (True, False, True, True), (False, False, True, False), (False, False, False, True), (False, False, False, False)
    ]


def test_types_and_numbers(spark):
    assert one(spark, blanks.inferred_type, "true", "12", "1.5e3", "nan", "x", " ", None) == ["boolean", "integer", "number", "number", "string", "empty", "empty"]
    assert one(spark, blanks.tolerant_float, "1.5", "inf", "x", None) == [1.5, None, None, None]
    assert one(spark, blanks.tolerant_int, "1,234", "12.0", None) == [1234, None, None]


def test_condition_key(spark):
    df = spark.createDataFrame([("CHO", None), (None, " "), ("CHO", "His")], "host string, tag string")
    got = df.select(blanks.condition_key({"host": F.col("host"), "tag": F.col("tag")}).alias("k"))
    assert rows(got) == [("UNSPECIFIED_CONDITION",), ("host=CHO",), ("host=CHO|tag=His",)]


def test_scratch_tables_are_released(spark):
    from pathlib import Path

    from assaymill import session

    scratch = session.Scratch(spark, "release")
    df = scratch.put(spark.range(3), "rows")
    folder = Path(scratch.root.removeprefix("file://"))
    assert df.count() == 3 and folder.is_dir()
    assert session.release_scratch() >= 1 and not folder.exists() and session.release_scratch() == 0


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from assaymill import session

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getConf=lambda: {}, master="spark://host:7077", applicationId="x"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_folder(bare)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: "hdfs://shared"))
    assert session.shared_folder(named) == "hdfs://shared"
