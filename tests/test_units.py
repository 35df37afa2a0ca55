import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from assaymill.operators import units
from tests.conftest import rows

SCHEMA = "record_id string, source_block_id string, assay_endpoint string, unit string, concentration string, temperature string, reported_value string"
DEFAULTS = "source_block_id string, quantity string, default_unit string"


def harmonised(spark, data, defaults=()):
    return units.harmonise(spark.createDataFrame(data, SCHEMA), spark.createDataFrame(list(defaults), DEFAULTS))


CONCENTRATIONS = [
    ("1.5% w/v", 15000), ("1,5 %(w/v)", 15000), ("250 µg/mL", 250), ("250 mcg/mL", 250), ("2.5e+02 ug mL-1", 250), ("+3 g/L", 3000), ("100000ng/µL", 100000), ("7 mg·L⁻¹", 7),
]
REPORTED = [
    ("kd", "pKD", "9", 1000), ("kd (-log10(M))", None, "9", 1000), ("bli_kd", "log10 M", "-9", 1000), ("KD, µM", "", "0,5", 500000), ("affinity KD", "--", "2.5 pM", 3),
    ("HIC retention time", "ms", "600000", 10000), ("hic_rt in s", None, "90", 1500), ("Tm1", "℉", "212", 100000), ("tm1 [K]", None, "300", 26850), ("visc_150", "cp", "3", 3000),
    ("viscosity", None, "0.2 Pa s", 200000), ("monomer, ratio (0-1)", None, "0.985", 98500), ("sec_monomer", "‰", "985", 98500), ("titre", "g L-1", "1.2", 1200000),
]


def test_conversions(spark):
    data = [(f"c{i:02}", "b", "tm1", None, cell, None, None) for i, (cell, _) in enumerate(CONCENTRATIONS)]
    data += [(f"r{i:02}", "b", endpoint, unit, None, None, cell) for i, (endpoint, unit, cell, _) in enumerate(REPORTED)]
    wanted = [(f"c{i:02}", "concentration", v) for i, (_, v) in enumerate(CONCENTRATIONS)] + [(f"r{i:02}", "reported_value", v) for i, (*_, v) in enumerate(REPORTED)]
    assert rows(units.converted(harmonised(spark, data))) == wanted


def test_common_units_are_no_cases_and_placeholders_no_values(spark):
    data = [
        ("a", "b", "hic_rt", "Min", "5 MG/ML", "20 deg C", "3"), ("b", "b", "hic_rt", "min", "nd", "n/a", "nan"), ("c", "b", "hic_rt", None, "--", None, ""),
        ("d", "b", None, "min", "1.2.3 g/L", "x", "4"),
    ]
    found = harmonised(spark, data)
    assert rows(units.converted(found)) == []
    assert found.count() == 3


def test_documented_default_holds_and_records_come_once(spark):
    data = [("r", "b", "tm1", None, None, "300", None)] * 2
    found = harmonised(spark, data, [("b", "temperature", "K")])
    assert rows(units.converted(found)) == [("r", "temperature", 26850)]
    assert {r["unit_source"] for r in found.collect()} == {"documented"}


def test_mixture_tells_undocumented_units_apart():
    values = np.concatenate([np.full(50, 300.0), np.full(50, 5.0)])
    bins = np.array([int(np.floor(np.log10(v) * units.BINS)) + 1 - units.LOW * units.BINS for v in values])
    post = units.fit_units("hic_rt", bins, np.ones(100), np.log(5), 0.3)
    names = [u[0] for u in units.UNITS["hic_rt"]]
    assert names[post[0].argmax()] == "s" and names[post[-1].argmax()] == "min" and post.max(axis=1).min() > units.SURE


def test_few_values_give_no_false_certainty():
    bins = np.array([int(np.floor(np.log10(7.6) * units.BINS)) + 1 - units.LOW * units.BINS])  # 7.6 nM, or a pKD of 7.6
    assert units.fit_units("kd", bins, np.ones(1), np.log(5), 2.5).max() < units.SURE


def test_units_of_one_factor_are_one_class():
    assert [c[0] for c in units.factor_classes("concentration")] == ["mg/mL", "µg/mL", "% w/v"]
    assert all(c[0] == units.UNITS[q][0][0] for q in units.UNITS for c in units.factor_classes(q)[:1])


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no test tables")
def test_mixture_finds_masked_defaults(spark):
    """With the documented defaults withheld, the fitted classes are the documented ones."""
    rows = spark.read.parquet("/root/testdata/sf0.01/measurements.parquet")
    defaults = spark.read.parquet("/root/testdata/sf0.01/source_unit_defaults.parquet")
    keys = ["record_id", "field", "x"]
    known = units.harmonise(rows, defaults).filter("unit_source = 'documented'").select(*keys, F.col("common_value").alias("known")).dropDuplicates(keys)
    fitted = units.harmonise(rows, defaults.limit(0)).filter("unit_source = 'fitted'").select(*keys, "common_value", "flag").dropDuplicates(keys)
    right = F.abs(F.col("common_value") - F.col("known")) <= 1e-9 * F.abs("known") + 1e-12
    told = known.join(fitted, keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("flag").isNotNull().cast("int")).alias("unsure"), F.sum((F.col("flag").isNull() & ~right).cast("int")).alias("wrong")
    ).first()
    assert told["n"] > 2000 and told["unsure"] < 0.05 * told["n"] and told["wrong"] <= 0.01 * told["n"]


def test_values_out_of_range_stay(spark):
    data = [("a", "b", "kd", "pKD", None, None, "-400"), ("b", "b", "kd", "M", None, None, "1e12"), ("c", "b", "kd", "pM", None, None, "1e999"), ("d", "b", "kd", "pM", None, None, "1e-200")]
    found = harmonised(spark, data)
    assert rows(units.converted(found)) == [("a", "reported_value", None), ("b", "reported_value", None), ("d", "reported_value", 0)]
    assert rows(found.filter("flag = 'out_of_range'"), "record_id") == [("a",), ("b",)]


def test_fitted_unit_and_flags(spark):
    known = [(f"k{i}", "a", "hic_rt", "min", None, None, str(4 + i % 5)) for i in range(40)]
    bare = [(f"s{i}", "b", "hic_rt", None, None, None, str(60 * (4 + i % 5))) for i in range(40)]
    wrong = [(f"w{i}", "c", "hic_rt", None, None, None, str(60 * (4 + i % 5))) for i in range(40)]
    got = harmonised(spark, known + bare + wrong + [("u", "a", "hic_rt", "parsec", None, None, "5")], [("c", "hic_rt", "min")])
    by = {r["record_id"]: r for r in got.collect()}
    assert (by["s0"]["unit"], by["s0"]["unit_source"], round(by["s0"]["common_value"], 6)) == ("s", "fitted", 4.0)
    assert by["w0"]["unit"] == "min" and by["w0"]["flag"] == "contradicts_fit"
    assert by["u"]["flag"] == "unknown_unit"


def test_empty_and_clashing_columns(spark):
    assert harmonised(spark, []).count() == 0
    data = spark.createDataFrame([("r", "b", "tm1", "K", None, None, "300", 1, 2)], SCHEMA + ", quantity int, x int")
    assert rows(units.converted(units.harmonise(data, spark.createDataFrame([], DEFAULTS)))) == [("r", "reported_value", 26850)]


def test_bins_round_trip(spark):
    df = spark.createDataFrame([(v,) for v in (0.0, 1e-9, -7.5, 123.4, 1e300)], "x double").select("x", units.value_bin(F.col("x")).alias("b"))
    for r in df.collect():
        centre = units.bin_centre(np.array([r["b"]]))[0]
        assert centre == r["x"] == 0 or r["x"] == 1e300 or abs(centre / r["x"] - 1) < 0.06
