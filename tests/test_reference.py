"""Audit queries over small tables written for one case each."""

from datetime import datetime

from assaymill.plans import reference
from tests.conftest import rows

MEASUREMENTS = (
    "record_id string, record_layer string, source_block_id string, DOTAD_ID string, assay_endpoint string, unit string, reported_value string, "
    "loaded_at timestamp, withdrawn_at timestamp, technical_replicate int, production_batch int, production_host string, tag string, statistic_type string"
)


def write(spark, folder, name, data, schema):
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")


def measurements(spark, folder, data):
    """(record, layer, block, antibody, endpoint, unit, value, day of loading) rows, and the blocks' default units."""
    filled = [(*r[:7], datetime(2025, 1, r[7]), None, 1, None, None, None, "mean" if r[1] == "summary" else None) for r in data]
    write(spark, folder, "measurements", filled, MEASUREMENTS)
    write(spark, folder, "source_unit_defaults", [("B", "hic_rt", "s"), ("B", "kd", "pM")], "source_block_id string, quantity string, default_unit string")
    return str(folder)


def test_summaries_are_rebuilt_in_common_units(spark, tmp_path):
    d = measurements(spark, tmp_path, [
        ("r1", "raw", "A", "DOTAD-1", "HIC RT", "min", "5", 1), ("r2", "raw", "A", "DOTAD-1", "HIC RT (s)", None, "360", 1),
        ("s1", "summary", "A", "DOTAD-1", "HIC RT", None, "330000 ms", 1),
        ("s2", "summary", "A", "DOTAD-1", "HIC RT", "min", "182.5", 1),  # the mean of the bare numbers
        ("r3", "raw", "B", "DOTAD-2", "hic_rt", None, "300", 1), ("s3", "summary", "B", "DOTAD-2", "hic_rt", "min", "5", 1),
        ("r4", "raw", "B", "DOTAD-3", "kd", "pKD", "9", 1), ("r5", "raw", "B", "DOTAD-3", "kd", None, "3000", 1), ("s4", "summary", "B", "DOTAD-3", "KD", "nM", "2", 1),
        ("r6", "raw", "B", "DOTAD-4", "titer", "g/L", "1,5", 1), ("s5", "summary", "B", "DOTAD-4", "titre", "mg/L", "1500", 1), ("s6", "summary", "B", "DOTAD-4", "titre", "mg/L", "n/a", 1),
        ("s7", "summary", "B", "DOTAD-5", "titre", "mg/L", "x", 1), ("r7", "raw", "B", "DOTAD-6", "kd", "pKD", "-400", 1), ("s8", "summary", "B", "DOTAD-6", "kd", "nM", "1", 1),
    ])
    verified = {(r["record_id"], r["status"] in ("verified_exact", "verified_rounding")) for r in reference.reconstruct_summary(spark, d).filter("record_id < 's6'").collect()}
    assert verified == {("s1", True), ("s2", False), ("s3", True), ("s4", True), ("s5", True)}
    rest = reference.reconstruct_summary(spark, d).filter("record_id >= 's6'")
    assert rows(rest, "record_id", "n", "status") == [("s6", 1, "partially_verified"), ("s7", 0, "missing_raw_input"), ("s8", 0, "missing_raw_input")]  # blocks with raw rows of the endpoint
    assert sum(n for *_, n in rows(reference.recon_status(spark, d))) == 8


def test_two_decimals_are_those_of_the_reported_unit(spark, tmp_path):
    d = measurements(spark, tmp_path, [
        ("r1", "raw", "DVPa1", "DOTAD-1", "hic_rt", "min", "5.50005", 1), ("s1", "summary", "DVPa1", "DOTAD-1", "hic_rt", "s", "330.00", 1),
        ("s2", "summary", "DVPa1", "DOTAD-1", "hic_rt", "s", "330.24", 1), ("s3", "summary", "DVPa1", "DOTAD-1", "hic_rt", "min", "5.50", 1),
        ("r2", "raw", "DVPa1", "DOTAD-2", "titer", "mg/L", "1504", 1), ("s4", "summary", "DVPa1", "DOTAD-2", "titer", "g/L", "1.50", 1),
        ("r3", "raw", "DVPa1", "DOTAD-3", "kd", "nM", "1.01", 1), ("s5", "summary", "DVPa1", "DOTAD-3", "kd", "pKD", "9.00", 1),
    ])
    near, off = "verified_at_reported_precision", "not_reproducible"
    assert rows(reference.reconstruct_summary(spark, d), "record_id", "status") == [("s1", near), ("s2", off), ("s3", near), ("s4", near), ("s5", near)]


def test_the_last_delivery_of_a_record_counts(spark, tmp_path):
    def of(records):
        return [("s1", "summary", "A", "DOTAD-1", "tm1", "°C", "70", 1), *(("r1", "raw", "A", "DOTAD-1", "tm1", "°C", v, day) for v, day in records)]

    for i, records in enumerate(([("60", 1), ("70", 2)], [("70", 2), ("60", 1)], [("70", 3), ("n/a", 2)], [("n/a", 2), ("70", 3)])):
        d = measurements(spark, tmp_path / str(i), of(records))
        assert rows(reference.reconstruct_summary(spark, d), "n", "status") == [(1, "verified_exact")]


def test_lineage_edges_meet_records_spelled_otherwise(spark, tmp_path):
    for name in ("antibody_metadata", "identity_review_queue", "identity_relationship_groups", "identity_relationship_members"):
        write(spark, tmp_path, name, [("x:1",), ("x:1",), ("x:2",)], "record_id string")
    write(spark, tmp_path, "measurements", [("EXP:a:1",), ("EXP:a:2",), ("exp:a:2 ",), ("EXP:a:3",), ("EXP:a:4",), ("EXP:a:5",), (None,)], "record_id string")
    edges = [
        ("measurements", " exp:A:1"), ("out/Measurements.tsv", "ＥＸＰ：a：２"), ("measurements", "EXP:a:3"), ("measurements", "exp: A:3\t"), ("measurements", "EXP:a-4"),
        ("measurements", None), ("measurements", " "), ("antibody_metadata", "EXP:a:5"), ("identity review queue", "X:1"), (None, "x:1"),
    ]
    write(spark, tmp_path, "record_lineage", edges, "output_table string, output_record_id string")
    assert rows(reference.lineage_coverage(spark, str(tmp_path)), "table_name", "n_records", "n_covered") == [
        ("antibody_metadata", 2, 0), ("identity_relationship_groups", 2, 0), ("identity_relationship_members", 2, 0), ("identity_review_queue", 2, 1), ("measurements", 6, 3),
    ]


def test_other_names_of_a_split_are_no_leak(spark, tmp_path):
    data = [
        ("SG-1", "valid"), ("sg 1", "dev"), ("SG-1", "Validation"), ("SG-1", "val "), ("SG-00000002", "test"), ("SG-2", "Testing"), ("SG-3", "train"), ("SG-3", "Training"), ("SG-3", "TRAIN\t"),
        ("SG-4", "dev"), ("SG-4", "testing"), ("SG-4", "test"), ("SG-5", "valid"), ("SG-5", "none"), ("SG-5", None), ("SG-5", " "), (None, "train"), (None, "test"),
    ]
    write(spark, tmp_path, "labels", data, "sequence_group string, split string")
    assert rows(reference.split_leakage(spark, str(tmp_path))) == [("SG-00000004", 2, 3)]
