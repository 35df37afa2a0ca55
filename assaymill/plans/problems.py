"""Queries of the general data problems, at production parameters over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import antibody_id, record_key, table_key
from ..operators.orphans import OrphanLedger, orphan_ledger, parents, references
from ..operators.units import converted, harmonise, to_common, unit_table
from ..session import table
from .problems_sql import SQL  # noqa: F401

#: Delivered tables with record ids, and their withdrawal column (fixed values).
DELIVERED = {
    "antibody_metadata": ("record_id", "withdrawn_at"),
    "measurements": ("record_id", "withdrawn_at"),
    "identity_review_queue": ("record_id", "withdrawn_at"),
    "identity_relationship_groups": ("record_id", "withdrawn_at"),
    "identity_relationship_members": ("record_id", None),
}
ANTIBODIES = "antibody of antibody_metadata"


def reference_ledger(spark: SparkSession, d: str) -> OrphanLedger:
    lineage = table(spark, d, "record_lineage").withColumn("_table", table_key(F.col("output_table")))
    lineage = lineage.filter(F.col("_table").isin(list(DELIVERED)))
    refs = references(lineage, "record_lineage", "lineage_id", "loaded_at", F.col("_table"), record_key(F.col("output_record_id")))
    members = table(spark, d, "identity_relationship_members")
    refs = refs.unionByName(
        references(members, "identity_relationship_members", "record_id", "loaded_at", F.lit(ANTIBODIES), antibody_id(F.col("antibody_id")))
    )
    rows = [parents(table(spark, d, t), t, record_key(F.col(key)), withdrawn=gone) for t, (key, gone) in DELIVERED.items()]
    rows.append(parents(table(spark, d, "antibody_metadata"), ANTIBODIES, antibody_id(F.col("antibody_id"))))
    return orphan_ledger(spark, refs, reduce(DataFrame.unionByName, rows))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """References whose target is missing, withdrawn or loaded later."""
    found = reference_ledger(spark, d).orphans
    return found.select("ref_table", "ref_id", F.date_format("ref_at", "yyyy-MM").alias("period")).distinct()


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    """References waiting for a record per table, month and state, as of the end of each stretch of time; at the end, late ones as well."""
    ledger = reference_ledger(spark, d)
    late = ledger.orphans.filter("state = 'late'").groupBy(F.lit("end").alias("as_of"), "ref_table", F.date_format("ref_at", "yyyy-MM").alias("period"), "state")
    return ledger.snapshots.unionByName(late.agg(F.count(F.lit(1)).alias("n_references")))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Values whose unit is not the common one, converted."""
    return converted(harmonise(table(spark, d, "measurements"), table(spark, d, "source_unit_defaults")))


def p5_flags(spark: SparkSession, d: str) -> DataFrame:
    """How the unit of each value came to be known, and how many are flagged, per quantity."""
    rows = harmonise(table(spark, d, "measurements"), table(spark, d, "source_unit_defaults"))
    return rows.groupBy("quantity", "unit_source", F.coalesce("flag", F.lit("")).alias("flag")).agg(F.count(F.lit(1)).alias("n_values"))


def p5_classes(spark: SparkSession, d: str) -> DataFrame:
    """Values per quantity, way in which the unit came to be known, and factor class (told by what one of its units is in the common unit)."""
    rows = harmonise(table(spark, d, "measurements"), table(spark, d, "source_unit_defaults"))
    one = unit_table(spark).select(F.col("uq").alias("quantity"), "unit", F.round(to_common(F.lit(1.0), F.col("kind"), F.col("a"), F.col("b")), 6).alias("common_of_one")).distinct()
    return rows.join(F.broadcast(one), ["quantity", "unit"]).groupBy("quantity", "unit_source", "common_of_one").agg(F.count(F.lit(1)).alias("n_values"))


QUERIES = {"p4_found": p4_found, "p4_report": p4_report, "p5_found": p5_found, "p5_flags": p5_flags, "p5_classes": p5_classes}

