"""Identity conflicts and relationship groups: found and reported, never merged.

Inputs are three narrow tables: names (id, name), pairs (id, pair) and aliases (id, alias), made distinct
before anything is grouped. Candidate rows describe groups by counts and by their smallest and largest
member, so no group is collected into one cell; ``members_of`` gives the members as rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import casefold_name

#: Words that mark a variant of a parent.
MARKERS = r"\b(?:mutant|variant|wild[\s_-]*type|wt|parent|parental|mutein)\b"


def normal_name(c: Column) -> Column:
    return F.nullif(casefold_name(c), F.lit(""))


def parent_root(name: Column) -> Column:
    """A normalised name without variant markers and punctuation."""
    return F.trim(F.regexp_replace(F.regexp_replace(name, MARKERS, " "), "[^0-9a-z]+", " "))


def has_marker(name: Column) -> Column:
    return name.rlike(MARKERS)


def _groups(rows: DataFrame, category: str, key: str, member: str) -> DataFrame:
    """Keys with more than one distinct member."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(member).alias("a"), F.max(member).alias("b")).filter("n > 1").select(
        F.lit(category).alias("category"), F.col(key).cast("string").alias("conflict_key"), F.col("n").alias("n_members"), F.col("a").cast("string").alias("member_a"),
        F.col("b").cast("string").alias("member_b"),
    )


def distinct_rows(df: DataFrame, **columns: Column) -> DataFrame:
    """Distinct rows of the named columns without nulls."""
    out = df.select(*(c.alias(n) for n, c in columns.items()))
    return out.filter(reduce(Column.__and__, (F.col(n).isNotNull() for n in columns))).distinct()


def identity_candidates(names: DataFrame, pairs: DataFrame) -> DataFrame:
    """Six kinds of conflict between ids (``id``), normalised names (``name``) and pair fingerprints (``pair``)."""
    named_pairs = names.join(pairs, "id")
    ids_per_pair = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("ids"))
    by_name = named_pairs.select("name", "pair").distinct()
    wide_names = names.groupBy("name").agg(F.count(F.lit(1)).alias("ids")).filter("ids > 1").select("name")
    by_pair = named_pairs.select("pair", "name").distinct().join(ids_per_pair.filter("ids = 1").select("pair"), "pair")
    rooted = names.select("id", parent_root(F.col("name")).alias("root"), has_marker(F.col("name")).alias("marked")).filter("root <> ''")
    marked = rooted.groupBy("root").agg(F.max("marked").alias("m")).filter("m").select("root")
    return reduce(DataFrame.unionByName, [
        _groups(pairs, "same_id_different_pairs", "id", "pair"),
        _groups(pairs, "different_ids_same_pair", "pair", "id"),
        _groups(by_name.join(wide_names, "name"), "same_normalized_name_different_pairs", "name", "pair"),
        _groups(by_pair, "different_names_same_pair", "pair", "name"),
        _groups(names, "alias_across_ids", "name", "id"),
        _groups(rooted.select("root", "id").distinct().join(marked, "root"), "parent_mutant_candidate", "root", "id"),
    ])


def relationship_groups(pairs: DataFrame, context: DataFrame, known: DataFrame) -> DataFrame:
    """One row per pair shared by several ids, with the class of their relationship and its priority.

    ``context``: id, name (normalised), format, target, stage, several rows per id at will; ``known``: ids with metadata.
    """
    shared = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("ids")).filter("ids > 1").select("pair")
    members = pairs.join(shared, "pair").join(known.withColumn("in_metadata", F.lit(1)), "id", "left")
    sizes = members.groupBy("pair").agg(F.count(F.lit(1)).alias("member_count"), F.count("in_metadata").alias("n_known"), F.min("id").alias("first_id"))
    # what is known of an id, each fact once, so an id with very many rows is joined as often as it has facts
    kinds = ("name", "format", "target", "stage")
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("value")) for c in kinds)))
    known_facts = context.select("id", cells.alias("c")).select("id", "c.*").filter("value is not null").distinct()
    facts = members.select("pair", "id").join(known_facts, "id").select("pair", "kind", "value").distinct()
    root = F.when(F.col("kind") == "name", F.nullif(parent_root(F.col("value")), F.lit("")))
    counted = facts.groupBy("pair").agg(
        *(F.count(F.when(F.col("kind") == c, 1)).alias(f"n_{c}") for c in kinds), F.min(root).alias("r1"), F.max(root).alias("r2"),
        F.max(F.when(root.isNotNull(), has_marker(F.col("value")))).alias("marked"),
    )
    sizes = sizes.join(counted, "pair", "left")
    n = {c: F.coalesce(F.col(f"n_{c}"), F.lit(0)) for c in ("name", "format", "target", "stage")}
    kind = (
        F.when((F.col("n_known") < F.col("member_count")) & (F.col("n_known") > 0), "metadata_to_sequence_only_link").when(n["name"] <= 1, "same_name_same_pair")
        .when((F.col("r1") == F.col("r2")) & F.col("marked"), "parent_derivative_candidate").when(n["format"] > 1, "same_variable_domain_distinct_format")
        .when((n["target"] > 1) | (n["stage"] > 1), "same_variable_domain_distinct_product").otherwise("different_name_same_pair_same_context")
    )
    out = sizes.withColumn("relationship_class", kind)
    high = F.col("relationship_class").isin("metadata_to_sequence_only_link", "same_variable_domain_distinct_product")
    return out.select(
        F.col("pair").alias("pair_fingerprint"), "member_count", "first_id", "relationship_class",
        F.when(high, "HIGH").when(F.col("relationship_class") == "same_name_same_pair", "LOW").otherwise("MEDIUM").alias("review_priority"),
    )


def members_of(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """(pair_fingerprint, id, metadata_available) of the pairs that several ids share."""
    shared = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("ids")).filter("ids > 1").select("pair")
    rows = pairs.join(shared, "pair").join(known.withColumn("hit", F.lit(True)), "id", "left")
    return rows.select(F.col("pair").alias("pair_fingerprint"), "id", F.coalesce("hit", F.lit(False)).alias("metadata_available"))


def coverage(left: DataFrame, right: DataFrame, left_name: str, right_name: str) -> DataFrame:
    """(id, n_left, n_right, status): full outer coverage of the ids of two tables, counted before the join."""
    a = left.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n_left"))
    b = right.filter("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("n_right"))
    joined = a.join(b, "id", "full_outer").na.fill(0, ["n_left", "n_right"])
    status = F.when(F.col("n_right") == 0, f"{left_name}_only").when(F.col("n_left") == 0, f"{right_name}_only").otherwise("in_both")
    return joined.select("id", "n_left", "n_right", status.alias("status"))
