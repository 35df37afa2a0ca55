"""Splits that keep related records together.

Records that share an entity (a sequence group, an antibody, ...) form one
component of the graph of entities; a hash of the component, uniform in [0, 1),
falls into one of the ranges that the wanted proportions cut. A component
with records of several sources uses the mean of their proportions, weighted by its
records, so it stays whole; a component larger than a range can hold makes the split uneven,
which ``split_report`` shows.

Defined cases: null and placeholder entities link nothing (a record without any is a
component of its own); a missing split is no split; repeated rows are kept; sources
without a plan take the mean proportions of the plan; an empty table gives an empty result; other columns are
not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import split_name  # noqa: F401
from ..operators.skew import attach
from ..session import Scratch
from .components import star_components

SPLITS = ["train", "valid", "test"]


def record_components(records: DataFrame, record: str, entities: dict[str, Column], keep: list[str] = ()) -> DataFrame:
    """(record, component, kept columns): records linked directly or through others have one component.

    ``entities`` names each kind of entity and gives its column in key form. A
    component is named by its smallest entity, or by the record where it has none.
    """
    kinds = list(entities)
    rows = records.select(
        F.col(record).alias("record"), *keep, *(F.concat(F.lit(f"{kind}|"), column).alias(f"_{kind}") for kind, column in entities.items())
    )
    rows = Scratch(records.sparkSession, "split-rows").put(rows, "rows")
    # a record's entities form a path through its first entity; distinct paths only
    links = reduce(DataFrame.unionByName, [
        rows.select(F.coalesce(*(F.col(f"_{k}") for k in kinds)).alias("a"), F.col(f"_{k}").alias("b")).distinct() for k in kinds
    ])
    found = star_components(links)
    rows = rows.withColumn("_first", F.coalesce(*(F.col(f"_{k}") for k in kinds), F.concat(F.lit("record|"), F.col("record").cast("string"))))
    linked = attach(rows, found.withColumnRenamed("vertex", "_first"), "_first", "left")
    return linked.select("record", F.coalesce("component", "_first").alias("component"), *keep)


def torn_records(records: DataFrame, record: str, entities: dict[str, Column], split: Column) -> DataFrame:
    """(record): records whose component stands in more than one split."""
    rows = record_components(records.withColumn("_split", split), record, entities, ["_split"])
    rows = Scratch(records.sparkSession, "torn").put(rows, "rows")
    torn = rows.groupBy("component").agg(F.min("_split").alias("a"), F.max("_split").alias("b")).filter("a < b").select("component")
    return attach(rows, torn, "component").select("record")


def assign_splits(records: DataFrame, plan: DataFrame, record: str, source: str, entities: dict[str, Column]) -> DataFrame:
    """(record, source, split, component): whole components in the proportions of ``plan`` (source, split, fraction)."""
    rows = record_components(records.withColumn("_source", F.col(source)), record, entities, ["_source"])
    rows = Scratch(records.sparkSession, "assign").put(rows, "rows")
    shares = plan.groupBy("source").pivot("split", SPLITS).agg(F.sum("fraction")).na.fill(0.0, SPLITS)
    default = plan.groupBy("split").agg(F.avg("fraction").alias("f")).groupBy().pivot("split", SPLITS).agg(F.sum("f")).na.fill(0.0)
    counted = rows.groupBy("component", "_source").agg(F.count(F.lit(1)).alias("n"))
    counted = counted.join(shares, F.col("_source") == F.col("source"), "left").join(
        F.broadcast(default.select(*(F.col(s).alias(f"_{s}") for s in SPLITS)))  # one row
    )
    mixed = counted.groupBy("component").agg(*(F.sum(F.col("n") * F.coalesce(s, f"_{s}")).alias(s) for s in SPLITS))
    whole = sum(F.col(s) for s in SPLITS)
    point = F.pmod(F.xxhash64("component"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    drawn = mixed.select(
        "component",
        F.when(point < F.col("train") / whole, "train").when(point < (F.col("train") + F.col("valid")) / whole, "valid").otherwise("test").alias("split"),
    )
    return attach(rows, drawn, "component").select("record", F.col("_source").alias("source"), "split", "component")


def split_report(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, split, n_rows, share, wanted): how far each source's rows keep to its proportions."""
    counted = assigned.groupBy("source", "split").agg(F.count(F.lit(1)).alias("n_rows"))
    total = counted.groupBy("source").agg(F.sum("n_rows").alias("all_rows"))
    wanted = plan.groupBy("source", "split").agg(F.sum("fraction").alias("wanted"))
    joined = wanted.join(counted, ["source", "split"], "full_outer").join(total, "source")
    return joined.select("source", "split", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), (F.coalesce("n_rows", F.lit(0)) / F.col("all_rows")).alias("share"), "wanted")
