"""Candidate keys, foreign keys, orphans, and the parents a child column most likely refers to.

Children are counted per key before any join, so a key that holds a third of all rows costs one row
in the shuffle; parents are reduced to distinct keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.blanks import falsy, strip
from ..session import Scratch


def key_value(c: Column, zero_is_missing: bool = False) -> Column:
    """Trimmed and upper-cased key; null where missing."""
    return F.when(~falsy(c, zero_is_missing), F.upper(strip(c.cast("string"))))


def key_audit(df: DataFrame, table: str, columns: list[str], zero_is_missing: bool = False) -> DataFrame:
    """One row: how far the columns together are a key of the table."""
    values = [_keys(df, c, zero_is_missing, _plain(df, c)) for c in columns]
    present = reduce(Column.__and__, (v.isNotNull() for v in values))
    value = values[0] if len(values) == 1 else F.struct(*(v.alias(f"k{i}") for i, v in enumerate(values)))
    counted = df.select(F.when(present, value).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = counted.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0)).alias("non_missing"),
        F.count("k").alias("distinct_values"),
    )
    duplicates, missing = F.col("non_missing") - F.col("distinct_values"), F.col("row_count") - F.col("non_missing")
    return out.select(
        F.lit(table).alias("table_name"), F.lit("+".join(columns)).alias("key_columns"), "row_count", "non_missing", "distinct_values",
        duplicates.alias("duplicate_values"), missing.alias("missing_values"),
        F.when(F.col("row_count") == 0, "empty").when((duplicates == 0) & (missing == 0), "confirmed_candidate")
        .when(duplicates == 0, "candidate_with_missing").otherwise("not_unique").alias("status"),
    )


def _plain(df: DataFrame, column: str) -> bool:
    """Is the column an integral key that needs no written form?"""
    return df.schema[column].dataType.typeName() in ("long", "integer", "short", "byte")


def _keys(df: DataFrame, column: str, zero_is_missing: bool, plain: bool) -> Column:
    if not plain:
        return key_value(F.col(column), zero_is_missing)
    return F.when(F.col(column) != 0, F.col(column)) if zero_is_missing else F.col(column)


def child_counts(child: DataFrame, column: str, zero_is_missing: bool = False, plain: bool = False) -> DataFrame:
    return child.select(_keys(child, column, zero_is_missing, plain).alias("k")).groupBy("k").agg(F.count(F.lit(1)).alias("n"))


def distinct_keys(parent: DataFrame, column: str, zero_is_missing: bool = False, plain: bool = False) -> DataFrame:
    return parent.select(_keys(parent, column, zero_is_missing, plain).alias("k")).filter("k is not null").distinct()


def foreign_key_audit(child: DataFrame, column: str, parent: DataFrame, parent_column: str, name: str, zero_is_missing: bool = False) -> DataFrame:
    """One row: references matched and unmatched, distinct orphans and the first ten of them.

    The join runs once: its orphans are written with their counts, and what is matched follows from the child's own totals. Integral keys
    are compared as such.
    """
    plain = _plain(child, column) and _plain(parent, parent_column)
    orphans = Scratch(child.sparkSession, "orphans-of").put(orphan_keys(child, column, parent, parent_column, zero_is_missing), "orphans")
    first = orphans.orderBy("orphan").limit(10).agg(F.array_join(F.array_sort(F.collect_list("orphan")), "|").alias("example_orphans"))
    lost = orphans.agg(F.count(F.lit(1)).alias("distinct_orphans"), F.coalesce(F.sum("n_references"), F.lit(0)).alias("unmatched"))
    key = _keys(child, column, zero_is_missing, plain)
    total = child.agg(F.count(F.lit(1)).alias("child_rows"), F.count(key).alias("references"))
    return total.crossJoin(F.broadcast(lost)).crossJoin(F.broadcast(first)).select(  # one row each
        F.lit(name).alias("relationship"), "child_rows", "references", (F.col("references") - F.col("unmatched")).alias("matched"), "unmatched", "distinct_orphans", "example_orphans",
        F.when(F.col("references") == 0, "no_references").when(F.col("unmatched") == 0, "verified").otherwise("has_orphans").alias("status"),
    )


def orphan_keys(child: DataFrame, column: str, parent: DataFrame, parent_column: str, zero_is_missing: bool = False) -> DataFrame:
    """(orphan, n_references): every distinct reference without a parent."""
    plain = _plain(child, column) and _plain(parent, parent_column)
    counts = child_counts(child, column, zero_is_missing, plain).filter("k is not null")
    lost = counts.join(distinct_keys(parent, parent_column, zero_is_missing, plain), "k", "left_anti")
    return lost.select(F.col("k").cast("string").alias("orphan"), F.col("n").alias("n_references"))


def relationship_candidates(spark: SparkSession, catalogue: list[tuple[str, str]]) -> DataFrame:
    """Pairs of key columns of different tables, from a catalogue of (table, column): metadata, never data."""
    rows = [(a, x, b, y) for a, x in catalogue for b, y in catalogue if a != b]
    return spark.createDataFrame(rows, "child_table string, child_column string, parent_table string, parent_column string")


def matched_references(tables: dict[str, tuple[DataFrame, str]], pairs: DataFrame) -> DataFrame:
    """(child, parent, matched, unmatched) of all ``pairs`` (child_table, parent_table) at once: counted keys of all tables meet their distinct keys in one join."""
    plain = all(_plain(df, c) for df, c in tables.values())
    counted = [child_counts(df, c, plain=plain).filter("k is not null").select(F.lit(name).alias("table"), "k", "n") for name, (df, c) in tables.items()]
    keys = reduce(DataFrame.unionByName, counted)
    total = keys.groupBy(F.col("table").alias("child")).agg(F.sum("n").alias("all_references"))
    wanted = F.broadcast(pairs.select(F.col("child_table").alias("child"), F.col("parent_table").alias("parent")).distinct())  # pairs of tables
    met = keys.select(F.col("table").alias("child"), "k", "n").join(keys.select(F.col("table").alias("parent"), "k"), "k").groupBy("child", "parent").agg(F.sum("n").alias("matched"))
    found = wanted.join(met, ["child", "parent"], "left").join(total, "child", "left").na.fill(0, ["matched", "all_references"])
    return found.select("child", "parent", "matched", (F.col("all_references") - F.col("matched")).alias("unmatched"))


def best_parents(audits: DataFrame, k: int = 2) -> DataFrame:
    """The ``k`` relationships of each child that match most, ties by parent name."""
    order = Window.partitionBy("child").orderBy(F.desc("matched"), "parent")
    return audits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
