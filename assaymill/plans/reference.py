"""Queries of the audit and release operators over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.blanks import cell_blank, condition_key, first_nonblank, inferred_type, strip, tolerant_float, truthy
from ..functions.text import antibody_id, clean, compact_header, identifier_token, record_key, sequence_group_id, split_name, table_key, value_or_null
from ..operators import claims, comparison, documents, identity, integrity, inventory, lineage, profiling, reconstruct, registry, sequences, validation
from ..operators import rows as row_forms
from ..operators.statistics import explained_variance
from ..operators.units import endpoint_quantity, harmonise, number_text, number_value, rounding_range
from ..session import Scratch, table
from .reference_sql import SQL  # noqa: F401

FOREIGN_KEYS = [
    ("lineitem", "l_orderkey", "orders", "o_orderkey"), ("orders", "o_orderkey", "lineitem", "l_orderkey"), ("orders", "o_custkey", "customer", "c_custkey"),
    ("customer", "c_custkey", "orders", "o_custkey"), ("lineitem", "l_partkey", "part", "p_partkey"), ("customer", "c_nationkey", "nation", "n_nationkey"),
    ("nation", "n_regionkey", "region", "r_regionkey"), ("labels", "antibody_id", "antibody_metadata", "antibody_id"),
]


def fk_audit(spark: SparkSession, d: str) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        integrity.foreign_key_audit(table(spark, d, c), cc, table(spark, d, p), pc, f"{c}.{cc}->{p}.{pc}") for c, cc, p, pc in FOREIGN_KEYS
    ])


def fk_orphans(spark: SparkSession, d: str) -> DataFrame:
    return integrity.orphan_keys(table(spark, d, "orders"), "o_orderkey", table(spark, d, "lineitem"), "l_orderkey")


def fk_orphan_report(spark: SparkSession, d: str) -> DataFrame:
    """The first 1,000 orphans of each relationship, as a report lists them."""
    return fk_orphans(spark, d).orderBy("orphan").limit(1000)


def fk_best_parents(spark: SparkSession, d: str) -> DataFrame:
    """The two parents whose keys match each child column most."""
    catalogue = {"orders": "o_custkey", "customer": "c_custkey", "part": "p_partkey", "supplier": "s_suppkey", "nation": "n_nationkey"}
    pairs = integrity.relationship_candidates(spark, list(catalogue.items()))
    return integrity.best_parents(integrity.matched_references({t: (table(spark, d, t), c) for t, c in catalogue.items()}, pairs))


def key_uniqueness(spark: SparkSession, d: str) -> DataFrame:
    keys = [
        ("orders", ["o_orderkey"]), ("customer", ["c_custkey"]), ("lineitem", ["l_orderkey", "l_linenumber"]), ("labels", ["label_id"]),
        ("antibody_metadata", ["antibody_id"]), ("measurements", ["record_id"]), ("record_lineage", ["lineage_id"]),
    ]
    return reduce(DataFrame.unionByName, [integrity.key_audit(table(spark, d, t), t, c) for t, c in keys])


METADATA = ["record_id", "antibody_id", "antibody_name", "Format", "hc_subtype", "lc_subtype", "Highest_Clin_Trial", "Target", "Species", "PDB", "production_host", "tag"]


def column_profile(spark: SparkSession, d: str) -> DataFrame:
    return profiling.column_profile(table(spark, d, "antibody_metadata"), F.col("excel_row"), METADATA)


def column_types(spark: SparkSession, d: str) -> DataFrame:
    """How many values of each inferred type every text column of measurements holds."""
    values = profiling.values_by_column(table(spark, d, "measurements"), F.col("source_excel_row"), ["pH", "temperature", "concentration", "unit", "reported_value", "statistic_type"])
    return values.groupBy("column_name", inferred_type(F.col("value")).alias("type")).agg(F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_distinct"))


def table_profile(spark: SparkSession, d: str) -> DataFrame:
    members = ["record_id", "relationship_group_id", "antibody_id", "antibody_names", "metadata_available"]
    return reduce(DataFrame.unionByName, [
        profiling.table_profile(table(spark, d, "antibody_metadata"), "antibody_metadata", METADATA),
        profiling.table_profile(table(spark, d, "identity_relationship_members"), "identity_relationship_members", members),
        profiling.table_profile(table(spark, d, "part"), "part", ["p_name", "p_brand", "p_type"]),
    ])


def column_roles(spark: SparkSession, d: str) -> DataFrame:
    """Semantic roles and confidence of every column of the domain tables (schemas only)."""
    names = [(t, c) for t in ("measurements", "labels", "record_lineage", "antibody_metadata") for c in table(spark, d, t).columns]
    rows = [(t, c, "|".join(profiling.semantic_roles(c)) or "unknown", profiling.role_confidence(c)) for t, c in names]
    return spark.createDataFrame(rows, "table_name string, column_name string, roles string, confidence string")


def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    return inventory.duplicate_groups(table(spark, d, "documents"), "doc_id", F.col("text"), F.concat_ws("/", "source", "source_study_id", "doc_kind"))


def largest_documents(spark: SparkSession, d: str) -> DataFrame:
    return inventory.largest(table(spark, d, "documents").select("doc_id", "source", "n_chars"), "n_chars", "doc_id")


def extension_summary(spark: SparkSession, d: str) -> DataFrame:
    return inventory.extension_summary(table(spark, d, "record_lineage").withColumn("size", F.length("input_file").cast("bigint")), "input_file", "size")


def path_categories(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "record_lineage").select(inventory.path_category(F.col("output_table")).alias("category"))
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n_paths"))


def seq_class(spark: SparkSession, d: str) -> DataFrame:
    no = F.lit(False)
    kind = sequences.sequence_class(F.col("VH"), F.col("VL"), no, no, no, no)
    return table(spark, d, "labels").groupBy("source", kind.alias("sequence_class")).agg(F.count(F.lit(1)).alias("n_records"))


def seq_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    return sequences.fingerprints(table(spark, d, "labels"), "label_id", "VH", "VL")


def seq_qc(spark: SparkSession, d: str) -> DataFrame:
    return sequences.quality(table(spark, d, "labels"), "label_id", "VH", "VL")


def seq_table_profile(spark: SparkSession, d: str) -> DataFrame:
    return sequences.table_profile(table(spark, d, "labels"), {"vh": "VH", "vl": "VL"})


def _names(spark: SparkSession, d: str) -> DataFrame:
    # case folding needs Python, so names are made distinct first
    rows = table(spark, d, "antibody_metadata").select(antibody_id(F.col("antibody_id")).alias("id"), "antibody_name").filter("id is not null and antibody_name is not null").distinct()
    return identity.distinct_rows(rows, id=F.col("id"), name=identity.normal_name(F.col("antibody_name")))


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    return identity.distinct_rows(table(spark, d, "labels"), id=antibody_id(F.col("antibody_id")), pair=sequences.pair_sha(F.col("VH"), F.col("VL")))


def identity_candidates(spark: SparkSession, d: str) -> DataFrame:
    return identity.identity_candidates(_names(spark, d), _pairs(spark, d))


def relationship_groups(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "antibody_metadata").filter("antibody_id is not null")
    rows = rows.select(antibody_id(F.col("antibody_id")).alias("id"), "antibody_name", "Format", "Target", "Highest_Clin_Trial").distinct()
    context = rows.select(
        "id", identity.normal_name(F.col("antibody_name")).alias("name"), F.lower(value_or_null(F.col("Format"))).alias("format"),
        F.lower(value_or_null(F.col("Target"))).alias("target"), F.lower(value_or_null(F.col("Highest_Clin_Trial"))).alias("stage"),
    )
    return identity.relationship_groups(_pairs(spark, d), context, context.select("id").distinct())


def relationship_members(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "antibody_metadata").filter("antibody_id is not null").select(antibody_id(F.col("antibody_id")).alias("id")).distinct()
    return identity.members_of(_pairs(spark, d), known)


def coverage_status(spark: SparkSession, d: str) -> DataFrame:
    left = table(spark, d, "antibody_metadata").select(antibody_id(F.col("antibody_id")).alias("id"))
    return identity.coverage(left, table(spark, d, "labels").select(antibody_id(F.col("antibody_id")).alias("id")), "metadata", "labels")


def _delivered(spark: SparkSession, d: str) -> DataFrame:
    """Delivered measurements of known endpoints: ``row`` (keys, conditions and a parsed number), and the cells its unit is told from."""
    rows = table(spark, d, "measurements").withColumn("endpoint", endpoint_quantity(F.lower(clean(F.col("assay_endpoint"))))).filter("endpoint is not null")
    row = F.struct(
        "record_id", "loaded_at", F.col("withdrawn_at").isNotNull().alias("is_withdrawn"), "record_layer", F.col("source_block_id").alias("block"),
        antibody_id(F.col("DOTAD_ID")).alias("id"), "endpoint", "technical_replicate", F.coalesce(F.col("production_batch").cast("string"), F.lit("")).alias("batch"),
        F.lower(F.coalesce(value_or_null(F.col("production_host")), F.lit(""))).alias("host"), F.lower(F.coalesce(value_or_null(F.col("tag")), F.lit(""))).alias("tag"),
        number_value(number_text(clean(F.col("reported_value")))).alias("value"), F.lower(F.coalesce("statistic_type", F.lit(""))).alias("statistic"),
    )
    none = F.lit(None).cast("string")
    return rows.select(row.alias("row"), "source_block_id", "assay_endpoint", "unit", "reported_value", none.alias("concentration"), none.alias("temperature"))


def _chosen(rows: DataFrame) -> DataFrame:
    """One delivery of each record: the last loaded, a withdrawn one before a live one, then the largest content."""
    return comparison.last_wins(rows, ["record_id"], F.struct("loaded_at", "is_withdrawn", *(c for c in rows.columns if c not in ("record_id", "loaded_at", "is_withdrawn"))))


def _measured(spark: SparkSession, d: str) -> DataFrame:
    """Measurements in long form: keys, conditions and the number as it is written."""
    return _chosen(_delivered(spark, d).select("row.*"))


def _harmonised(spark: SparkSession, d: str) -> DataFrame:
    """Measurements in long form with the value in the endpoint's common unit, and the range (low, high) that its two decimals leave open.

    Units are told over all delivered rows, as for p5_found. A value of 1e20 or more, or not finite, counts as none: exact sums do not hold it.
    """
    rows = _delivered(spark, d)
    numbers = rounding_range(harmonise(rows, table(spark, d, "source_unit_defaults"), "row"), reconstruct.TWO_DECIMALS)
    known = F.abs("common_value") < 1e20
    numbers = numbers.select(F.col("record_id").dropFields("value").alias("row"), *(F.when(known, F.col(c)).alias(n) for c, n in (("common_value", "value"), ("low", "low"), ("high", "high"))))
    empty = [F.lit(None).cast("double").alias(c) for c in ("value", "low", "high")]
    bare = rows.filter("row.value is null").select(F.col("row").dropFields("value").alias("row"), *empty)
    return _chosen(numbers.unionByName(bare).select("row.*", "value", "low", "high"))


def _rebuilt(spark: SparkSession, d: str) -> DataFrame:
    rows = Scratch(spark, "measured").put(_harmonised(spark, d), "rows")
    raw = rows.filter("record_layer = 'raw'").select("block", "id", "endpoint", "batch", "host", "tag", "value")
    summary = rows.filter("record_layer = 'summary'").select("record_id", "block", "id", "endpoint", F.lit("").alias("batch"), "host", "tag", F.col("value").alias("reported"), "low", "high")
    return reconstruct.reconstruct(summary, raw, "record_id", ["block", "id", "endpoint"], ["batch", "host", "tag"], F.col("block") == "DVPa1")


def reconstruct_summary(spark: SparkSession, d: str) -> DataFrame:
    return _rebuilt(spark, d).select("record_id", "block", "id", "endpoint", "n", "ambiguous", "status")


def recon_status(spark: SparkSession, d: str) -> DataFrame:
    return reconstruct.status_summary(_rebuilt(spark, d), "block", "endpoint")


def ambiguity_guard(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "lineitem").select("l_partkey", "l_returnflag", "l_linestatus")
    return reconstruct.ambiguous_conditions(raw, ["l_partkey"], ["l_returnflag", "l_linestatus"])


def replicate_structure(spark: SparkSession, d: str) -> DataFrame:
    raw = _measured(spark, d).filter("record_layer = 'raw'")
    return reconstruct.replicate_structure(raw, ["block", "id", "endpoint"], "technical_replicate", ["batch", "host", "tag"])


def leave_one_out(spark: SparkSession, d: str) -> DataFrame:
    """Line items without which the quantity's mean of an order is that of its lines but the first."""
    raw = table(spark, d, "lineitem").select("l_orderkey", (F.col("l_linenumber") * 1000000 + F.col("l_partkey")).alias("row"), F.col("l_quantity").alias("value"))
    first = raw.groupBy("l_orderkey").agg(F.min(F.struct("row", "value")).alias("f"), F.sum("value").alias("s"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    reported = first.select("l_orderkey", ((F.col("s") - F.col("f.value")) / (F.col("n") - 1)).alias("reported"), (F.col("n") - 1).alias("reported_n"))
    return reconstruct.leave_one_out(raw, ["l_orderkey"], "row", reported)


def _geo_edges(spark: SparkSession, d: str) -> DataFrame:
    def edge(t, child, c, parent, p):
        return table(spark, d, t).select(F.concat(F.lit(f"{child}:"), F.col(c).cast("string")).alias("child"), F.concat(F.lit(f"{parent}:"), F.col(p).cast("string")).alias("parent"))

    return reduce(DataFrame.unionByName, [
        edge("orders", "order", "o_orderkey", "customer", "o_custkey"), edge("customer", "customer", "c_custkey", "nation", "c_nationkey"),
        edge("nation", "nation", "n_nationkey", "region", "n_regionkey"),
    ])


def lineage_closure(spark: SparkSession, d: str) -> DataFrame:
    return lineage.closure(_geo_edges(spark, d))


def lineage_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Share of the records of each delivered table that have a lineage edge."""
    names = ["antibody_metadata", "identity_review_queue", "identity_relationship_groups", "identity_relationship_members", "measurements"]
    records = reduce(DataFrame.unionByName, [table(spark, d, t).select(F.lit(t).alias("table_name"), F.concat(F.lit(f"{t}|"), record_key(F.col("record_id"))).alias("record")) for t in names])
    edges = table(spark, d, "record_lineage").select(F.concat(table_key(F.col("output_table")), F.lit("|"), record_key(F.col("output_record_id"))).alias("record"))
    return lineage.coverage(records, edges, "table_name")


def lineage_rules(spark: SparkSession, d: str) -> DataFrame:
    required = ["lineage_id", "output_table", "output_record_id", "input_file", "input_sheet", "input_column_or_columns", "transformation_rule_id"]
    return lineage.edge_rules(table(spark, d, "record_lineage"), required, "input_file_sha256", "transformation_script_commit", "input_excel_row", "lineage_id")


def core_counts(spark: SparkSession, d: str) -> DataFrame:
    ids = {"antibody_metadata": "antibody_id", "measurements": "record_id", "labels": "antibody_id", "record_lineage": "lineage_id", "orders": "o_custkey"}
    return validation.core_counts({t: (table(spark, d, t), c) for t, c in ids.items()})


def declared_vs_actual(spark: SparkSession, d: str) -> DataFrame:
    """Members declared by relationship groups against members found."""
    declared = table(spark, d, "identity_relationship_groups").groupBy("relationship_group_id").agg(F.max("member_count").alias("declared"))
    actual = table(spark, d, "identity_relationship_members").select("relationship_group_id", "record_id").distinct().groupBy("relationship_group_id").agg(F.count(F.lit(1)).alias("actual"))
    return comparison.declared_vs_actual(declared, actual, "relationship_group_id")


def unique_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Label rows by how many metadata records their antibody has."""
    labels = table(spark, d, "labels").select("label_id", antibody_id(F.col("antibody_id")).alias("id"))
    found = comparison.unique_lookup(labels, table(spark, d, "antibody_metadata").select(antibody_id(F.col("antibody_id")).alias("id"), "record_id"), "id", "record_id")
    return found.groupBy("match_status").agg(F.count(F.lit(1)).alias("n_rows"), F.count("looked_up").alias("n_looked_up"))


def last_delivery(spark: SparkSession, d: str) -> DataFrame:
    """The last delivery of every metadata record."""
    rows = table(spark, d, "antibody_metadata").select("record_id", "loaded_at", "antibody_id", "antibody_name", "withdrawn_at")
    last = comparison.last_wins(rows, ["record_id"], F.struct("loaded_at", F.col("withdrawn_at").isNotNull()))
    return last.select("record_id", "antibody_id", "antibody_name", F.col("withdrawn_at").isNotNull().alias("is_withdrawn"))


def content_diff(spark: SparkSession, d: str) -> DataFrame:
    """What changed between the earliest and the latest delivery of metadata records, by status of withdrawal."""
    rows = table(spark, d, "antibody_metadata").select("record_id", "loaded_at", F.coalesce(F.col("withdrawn_at").cast("string"), F.lit("live")).alias("content"))
    first, last = comparison.first_wins(rows, ["record_id"], F.struct("loaded_at", "content")), comparison.last_wins(rows, ["record_id"], F.struct("loaded_at", "content"))
    return comparison.content_diff(first, last, "record_id", "content")


def set_diff(spark: SparkSession, d: str) -> DataFrame:
    return comparison.set_comparison(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), "k")


def incremental_new_ids(spark: SparkSession, d: str) -> DataFrame:
    """Antibodies that each block of measurements adds to the blocks before it."""
    rows = table(spark, d, "measurements").select(F.col("source_block_id").alias("component"), antibody_id(F.col("DOTAD_ID")).alias("id"))
    return comparison.new_per_component(rows, "component", "id")


def overlap_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Pair fingerprints shared by curated blocks and literature."""
    rows = table(spark, d, "labels").select(F.col("source").startswith("DVP").alias("curated"), sequences.pair_sha(F.col("VH"), F.col("VL")).alias("pair"))
    return comparison.set_comparison(rows.filter("curated"), rows.filter("not curated"), "pair")


def coverage_by_family(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "measurements").select(F.lower(F.coalesce(F.col("assay_method"), F.lit(""))).alias("family"), antibody_id(F.col("DOTAD_ID")).alias("id"))
    return rows.groupBy("family", "id").agg(F.count(F.lit(1)).alias("n")).groupBy("family").agg(F.sum("n").alias("n_rows"), F.count("id").alias("n_ids"))


def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    return comparison.split_leakage(table(spark, d, "labels"), sequence_group_id(F.col("sequence_group")), split_name(F.col("split")))


def release_status(spark: SparkSession, d: str) -> DataFrame:
    return documents.release_status(table(spark, d, "documents"), "source", F.col("text"), F.col("source_study_id").isNotNull())


def text_flags(spark: SparkSession, d: str) -> DataFrame:
    return documents.text_flags(table(spark, d, "documents"), "doc_id", "text")


def numeric_claims(spark: SparkSession, d: str) -> DataFrame:
    """Numeric statements of all documents, counted per document and unit."""
    return claims.numeric_claims(table(spark, d, "documents"), "doc_id", "text").groupBy("record", "unit").agg(F.count(F.lit(1)).alias("n_claims"), F.max("value").alias("largest"))


def claim_categories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").filter("text is not null").groupBy(claims.claim_category(F.col("text")).alias("category")).agg(F.count(F.lit(1)).alias("n_texts"))


def claim_verdicts(spark: SparkSession, d: str) -> DataFrame:
    """Declared group sizes as claims, against the members found."""
    claimed = table(spark, d, "identity_relationship_groups").select("record_id", "relationship_group_id", F.col("member_count").cast("double").alias("claimed")).distinct()
    facts = table(spark, d, "identity_relationship_members").select("relationship_group_id", "record_id").distinct().groupBy("relationship_group_id").agg(F.count(F.lit(1)).cast("double").alias("fact"))
    return claims.claim_verdicts(claimed, facts, "relationship_group_id").groupBy("verdict").agg(F.count(F.lit(1)).alias("n_claims"))


def vocabulary_check(spark: SparkSession, d: str) -> DataFrame:
    return validation.vocabulary(table(spark, d, "identity_review_queue"), F.col("status"), ["PENDING_REVIEW", "CONFIRMED", "REJECTED"])


def release_rules(spark: SparkSession, d: str) -> DataFrame:
    labels = {"split_named": F.col("split").isin("train", "valid", "test"), "antibody_written": F.col("antibody_id").rlike("^DOTAD-[0-9]{8}$"), "value_finite": F.abs("label_value") < 1e300}
    lines = {"quantity_positive": F.col("l_quantity") > 0, "discount_share": F.col("l_discount").between(0, 1)}
    return validation.row_rules(table(spark, d, "labels"), "labels", labels).unionByName(validation.row_rules(table(spark, d, "lineitem"), "lineitem", lines))


def set_equality(spark: SparkSession, d: str) -> DataFrame:
    """Relationship groups that stand in one of the two relationship tables only."""
    return validation.set_equality(table(spark, d, "identity_relationship_groups"), table(spark, d, "identity_relationship_members"), "relationship_group_id")


def condition_keys(spark: SparkSession, d: str) -> DataFrame:
    fields = {"host": F.lower(F.col("production_host")), "tag": F.col("tag"), "pH": F.col("pH")}
    return table(spark, d, "measurements").groupBy(condition_key(fields).alias("condition")).agg(F.count(F.lit(1)).alias("n_rows"))


def first_values(spark: SparkSession, d: str) -> DataFrame:
    """The first filled of three context columns, counted."""
    value = first_nonblank(F.col("PDB"), F.col("clinical_indication"), F.col("Target"))
    return table(spark, d, "antibody_metadata").groupBy(F.coalesce(strip(value), F.lit("")).alias("value")).agg(F.count(F.lit(1)).alias("n_rows"))


def alias_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every written form of an antibody's name with its normal form."""
    rows = table(spark, d, "antibody_metadata").filter(~cell_blank(F.col("antibody_name")))
    return rows.select(antibody_id(F.col("antibody_id")).alias("id"), F.col("antibody_name").alias("alias"), identity.normal_name(F.col("antibody_name")).alias("normal_name")).distinct()


def header_tokens(spark: SparkSession, d: str) -> DataFrame:
    """Token forms of every distinct endpoint spelling."""
    names = table(spark, d, "measurements").select(F.col("assay_endpoint").alias("endpoint")).filter("endpoint is not null").distinct()
    return names.select("endpoint", identifier_token(F.col("endpoint")).alias("token"), compact_header(F.col("endpoint")).alias("compact"))


def payload_cells(spark: SparkSession, d: str) -> DataFrame:
    """Cells of the ordered source payloads, counted per header and type of value."""
    cells = F.from_json("source_payload_json", "array<struct<column_index:int, header:string, value:string>>")
    rows = table(spark, d, "measurements").select(F.explode(cells).alias("c")).select("c.*")
    return rows.groupBy("header", inferred_type(F.col("value")).alias("type")).agg(F.count(F.lit(1)).alias("n_cells"), F.min("column_index").alias("first_index"))


def availability(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "identity_relationship_members").select(truthy(F.col("metadata_available")).alias("available"), tolerant_float(F.col("antibody_names")).isNotNull().alias("numeric_name"))
    return rows.groupBy("available", "numeric_name").agg(F.count(F.lit(1)).alias("n_rows"))


def event_paths(spark: SparkSession, d: str) -> DataFrame:
    """Edges between event types and users, as dependency edges of two kinds."""
    rows = table(spark, d, "events").select(
        F.concat(F.lit("user/"), F.col("user_id").cast("string")).alias("script"), F.col("event_type").alias("reference"),
        F.when(F.col("value") > 50, "output").otherwise("input").alias("direction"),
    )
    return documents.dependency_edges(rows)


def pca_explained_variance(spark: SparkSession, d: str) -> DataFrame:
    return explained_variance(table(spark, d, "embeddings"), "embedding", 64)


def provenance_rows(spark: SparkSession, d: str) -> DataFrame:
    """Metadata rows with where they come from."""
    df = table(spark, d, "antibody_metadata").select("record_id", "antibody_id", "excel_row", "Format")
    return row_forms.with_provenance(df, F.col("excel_row"), source_file="metadata.xlsx", source_sheet="metadata", release_version="1.0").drop("excel_row")


def block_descriptions(spark: SparkSession, d: str) -> DataFrame:
    """One description row per block and layer of measurements."""
    return row_forms.describe_blocks(table(spark, d, "measurements"), "source_block_id", "record_layer", antibody_id(F.col("DOTAD_ID")), "input_file")


def sheet_counts(spark: SparkSession, d: str) -> DataFrame:
    """Lineage edges per input sheet, in the order in which sheets first occur."""
    return row_forms.counted_in_order(table(spark, d, "record_lineage"), "input_sheet", "input_excel_row")


CONFLICTS = ["same_id_different_pairs", "different_ids_same_pair", "same_normalized_name_different_pairs", "different_names_same_pair", "alias_across_ids", "parent_mutant_candidate"]


def category_places(spark: SparkSession, d: str) -> DataFrame:
    """Categories of identity candidates in their fixed order, with the first key of each whatever its case."""
    found = identity_candidates(spark, d).select("category", "conflict_key", row_forms.category_place(F.col("category"), CONFLICTS).cast("int").alias("place"))
    first = found.groupBy("category", "place").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*(c.alias(n) for c, n in zip(row_forms.folded_order(F.col("conflict_key")), ("folded", "key"))))).alias("f"))
    return first.select("category", "place", "n", F.col("f.key").alias("first_key"))


def table_paths(spark: SparkSession, d: str) -> DataFrame:
    """Output tables of lineage edges below a release folder."""
    paths = table(spark, d, "record_lineage").filter("output_table is not null")
    return paths.groupBy(row_forms.relative_path(F.col("output_table"), "release/").alias("path")).agg(F.count(F.lit(1)).alias("n_edges"))


def first_edge(spark: SparkSession, d: str) -> DataFrame:
    """The first edge of the measurements table, by its id."""
    edges = table(spark, d, "record_lineage").select("lineage_id", "output_table")
    return row_forms.first_row(edges, table_key(F.col("output_table")) == "measurements", "lineage_id", "output_table")


def open_reviews(spark: SparkSession, d: str) -> DataFrame:
    """Reviews that are not decided."""
    return row_forms.unresolved(table(spark, d, "identity_review_queue"), "status", ["CONFIRMED", "REJECTED"], "record_id", "review_id")


def chain_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    """Hashes of chains alone and together, counted by basis."""
    none = F.lit(None).cast("string")
    found = sequences.all_fingerprints(table(spark, d, "labels"), "label_id", F.col("VH"), F.col("VL"), none, none)
    return found.groupBy("basis").agg(
        F.count(F.lit(1)).alias("n_records"), F.count_distinct("pair_sha").alias("n_pairs"), F.count_distinct("heavy_only_sha").alias("n_heavy_only"),
        F.count_distinct("light_only_sha").alias("n_light_only"), F.count_distinct("full_sha").alias("n_full"),
    )


def best_identity(spark: SparkSession, d: str) -> DataFrame:
    """Records and distinct identities by the kind of the best identity a label has."""
    best = sequences.fallback_fingerprint(F.col("VH"), F.col("VL"), F.col("VL"), [])
    found = table(spark, d, "labels").select(best["kind"].alias("kind"), F.array_join(best["parts"], "|").alias("identity"))
    return found.groupBy("kind").agg(F.count(F.lit(1)).alias("n_records"), F.count_distinct("identity").alias("n_identities"))


def pair_profile(spark: SparkSession, d: str) -> DataFrame:
    return sequences.pair_profile(table(spark, d, "labels"), "VH", "VL")


def label_conflicts(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of chains that stand under several antibodies, and antibodies with several pairs."""
    df, pair, name = table(spark, d, "labels"), sequences.pair_sha(F.col("VH"), F.col("VL")), antibody_id(F.col("antibody_id"))
    ways = {"pair_with_several_antibodies": (pair, name), "antibody_with_several_pairs": (name, pair)}
    return reduce(DataFrame.unionByName, [registry.label_conflicts(df, a, b).select(F.lit(way).alias("conflict"), "key", "n_labels", "first_label", "last_label") for way, (a, b) in ways.items()])


def sheet_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    """Sheets that lineage edges name, against the sheets measurements come from, by file and sheet, compared by their hash."""
    edges = table(spark, d, "record_lineage").groupBy("input_file", "input_sheet").agg(F.min("input_file_sha256").alias("sha"))
    known = table(spark, d, "measurements").groupBy(F.col("input_file"), F.col("source_sheet").alias("input_sheet")).agg(F.min("input_file_sha256").alias("sha"))
    found = comparison.two_key_crosscheck(edges, known, "input_file", "input_sheet", ["sha"])
    return found.groupBy("status").agg(F.count(F.lit(1)).alias("n_sheets"))


def component_metrics(spark: SparkSession, d: str) -> DataFrame:
    """Antibodies that each block of measurements adds, blocks in the order of their first delivery."""
    df = table(spark, d, "measurements").select(F.col("source_block_id").alias("component"), antibody_id(F.col("DOTAD_ID")).alias("id"), "loaded_at")
    return comparison.new_per_component(df, "component", "id", F.col("loaded_at"))


def endpoint_coverage(spark: SparkSession, d: str) -> DataFrame:
    """Filled cells of measurements per column that counts as an annotation by its role."""
    df = table(spark, d, "measurements")
    wanted = [c for c in df.columns if {"assay", "value", "unit", "condition"} & set(profiling.semantic_roles(c))]
    filled = df.agg(*(F.count(F.when(~cell_blank(F.col(c).cast("string")), 1)).alias(c) for c in wanted))
    return filled.select(F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_filled")) for c in wanted))).alias("r")).select("r.*")


def measurement_rows(spark: SparkSession, d: str) -> DataFrame:
    """Every delivered measurement in the layout of a release."""
    conditions = {"method": F.col("assay_method"), "pH": F.col("pH"), "host": F.lower(F.col("production_host")), "tag": F.col("tag"), "batch": F.col("production_batch").cast("string")}
    return row_forms.measurement_rows(
        table(spark, d, "measurements"), "record_id", antibody_id(F.col("DOTAD_ID")), endpoint_quantity(F.lower(clean(F.col("assay_endpoint")))),
        number_value(number_text(clean(F.col("reported_value")))), conditions, ["input_file", "source_sheet", "source_excel_row"],
    )


def sequence_rows(spark: SparkSession, d: str) -> DataFrame:
    """Labels with their chains in release form and their class."""
    no, h, l = F.lit(False), F.col("VH"), F.col("VL")
    kind = sequences.sequence_class(h, l, no, no, no, no)
    return table(spark, d, "labels").select("label_id", sequences.release_sequence(h).alias("vh"), sequences.release_sequence(l).alias("vl"), kind.alias("sequence_class"))


def unknown_rules(spark: SparkSession, d: str) -> DataFrame:
    """Transformation rules that edges name outside a rule table of two."""
    return lineage.unknown_rules(table(spark, d, "record_lineage"), "transformation_rule_id", ["COPY_ROW", "NORMALISE_UNITS"])


def default_units(spark: SparkSession, d: str) -> DataFrame:
    """Measurements per documented unit of their block's concentrations, through a registry join."""
    units = table(spark, d, "source_unit_defaults").filter("quantity = 'concentration'").select("source_block_id", F.col("default_unit").alias("unit"))
    rows = table(spark, d, "measurements").select("source_block_id")
    return row_forms.registry_join(rows, units, "source_block_id", "unit", "undocumented").groupBy("unit").agg(F.count(F.lit(1)).alias("n_rows"))


def stale_records(spark: SparkSession, d: str) -> DataFrame:
    """Relationship groups loaded before the newest metadata record."""
    return row_forms.stale(table(spark, d, "identity_relationship_groups").select("record_id", "loaded_at"), table(spark, d, "antibody_metadata"), "record_id", "loaded_at")


QUERIES = {
    f.__name__: f
    for f in (
        fk_audit, fk_orphans, fk_orphan_report, fk_best_parents, key_uniqueness, column_profile, column_types, table_profile, column_roles, duplicate_groups,
        largest_documents, extension_summary, path_categories, seq_class, seq_fingerprint, seq_qc, seq_table_profile, identity_candidates, relationship_groups,
        relationship_members, coverage_status, reconstruct_summary, recon_status, ambiguity_guard, replicate_structure, leave_one_out, lineage_closure,
        lineage_coverage, lineage_rules, core_counts, declared_vs_actual, unique_lookup, last_delivery, content_diff, set_diff, incremental_new_ids,
        overlap_fingerprints, coverage_by_family, split_leakage, release_status, text_flags, numeric_claims, claim_categories, claim_verdicts, vocabulary_check,
        release_rules, set_equality, condition_keys, first_values, alias_rows, header_tokens, payload_cells, availability, event_paths, pca_explained_variance,
        provenance_rows, block_descriptions, sheet_counts, category_places, table_paths, first_edge, open_reviews, chain_fingerprints, best_identity, pair_profile, label_conflicts,
        sheet_crosscheck, component_metrics, endpoint_coverage, measurement_rows, sequence_rows, unknown_rules, default_units, stale_records,
    )
}
