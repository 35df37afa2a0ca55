"""Lookups with match counts, declared-versus-found checks, set comparisons and release metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique_lookup(left: DataFrame, right: DataFrame, key: str, value: str) -> DataFrame:
    """``left`` with the value of its key where exactly one right row has the key, and how the match came out."""
    found = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias("_v"))
    joined = left.join(found, key, "left")
    return joined.select(
        *left.columns, F.when(F.col("_n") == 1, F.col("_v")).alias("looked_up"),
        F.when(F.col("_n").isNull(), "no_match").when(F.col("_n") == 1, "one_match").otherwise("several_matches").alias("match_status"),
    )


def last_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """The last row of each key, by an aggregate (no window over unbounded groups)."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def first_wins(df: DataFrame, keys: list[str], order: Column) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("_r")).select(*keys, "_r.*")


def declared_vs_actual(declared: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """Full outer comparison of ``declared`` (key, declared) with ``actual`` (key, actual), and a total row."""
    joined = declared.join(actual, key, "full_outer").select(key, F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("actual", F.lit(0)).alias("actual"))
    total = joined.agg(F.lit("TOTAL").alias(key), F.coalesce(F.sum("declared"), F.lit(0)).alias("declared"), F.coalesce(F.sum("actual"), F.lit(0)).alias("actual"))
    out = joined.unionByName(total).withColumn("difference", F.col("actual") - F.col("declared"))
    return out.withColumn("status", F.when(F.col("difference") == 0, "equal").when(F.col("declared") == 0, "undeclared").when(F.col("actual") == 0, "absent").otherwise("differs"))


def content_diff(base: DataFrame, other: DataFrame, key: str, content: str) -> DataFrame:
    """(key, change): added, removed or changed keys between two tables of unique keys."""
    joined = base.select(key, F.col(content).alias("_a"), F.lit(1).alias("_x")).join(other.select(key, F.col(content).alias("_b"), F.lit(1).alias("_y")), key, "full_outer")
    change = F.when(F.col("_x").isNull(), "added").when(F.col("_y").isNull(), "removed").when(~F.col("_a").eqNullSafe(F.col("_b")), "changed")
    return joined.select(key, change.alias("change")).filter("change is not null")


def set_comparison(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """One row: distinct values on the left, on the right, on both, on one side only; counted from one grouped union."""
    sides = left.select(F.col(column).alias("v"), F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(F.col(column).alias("v"), F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    each = sides.filter("v is not null").groupBy("v").agg(F.max("l").alias("l"), F.max("r").alias("r"))
    return each.agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("n_left"), F.coalesce(F.sum("r"), F.lit(0)).alias("n_right"),
        F.coalesce(F.sum(F.col("l") * F.col("r")), F.lit(0)).alias("n_both"), F.coalesce(F.sum(F.col("l") * (1 - F.col("r"))), F.lit(0)).alias("n_left_only"),
        F.coalesce(F.sum(F.col("r") * (1 - F.col("l"))), F.lit(0)).alias("n_right_only"),
    )


def new_per_component(df: DataFrame, component: str, identifier: str, order: Column | None = None) -> DataFrame:
    """Per component: rows, distinct ids, and ids that no earlier component has.

    Components come in the order of ``order`` (its smallest value per component, ties by name), or by name.
    """
    place = F.struct(F.min(order if order is not None else F.col(component)).alias("at"), F.col(component).alias("name"))
    places = df.groupBy(component).agg(place.alias("place"))
    pairs = df.filter(F.col(identifier).isNotNull()).groupBy(component, identifier).agg(F.count(F.lit(1)).alias("n")).join(places, component)
    first = pairs.groupBy(identifier).agg(F.min("place").alias("first"))
    new = first.groupBy(F.col("first.name").alias(component)).agg(F.count(F.lit(1)).alias("new_ids"))
    total = pairs.groupBy(component).agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("distinct_ids"))
    return total.join(new, component, "left").select(component, "n_rows", "distinct_ids", F.coalesce("new_ids", F.lit(0)).alias("new_ids"))


def split_leakage(df: DataFrame, group: Column, split: Column) -> DataFrame:
    """(group, n_splits, n_rows): groups that stand in several splits."""
    pairs = df.select(group.alias("grp"), split.alias("split")).filter("grp is not null and split is not null").groupBy("grp", "split").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("grp").agg(F.count(F.lit(1)).alias("n_splits"), F.sum("n").alias("n_rows")).filter("n_splits > 1")


def rebuild_table(old: DataFrame, new: DataFrame, key: str, order: Column | None = None) -> DataFrame:
    """Rows of both tables, the new one's where a key is in both: a keyed upsert without a driver loop.

    With ``order``, of several new rows of a key the last counts; without it all of them stay. The result is a table to be sorted and written by the caller.
    """
    fresh = new if order is None else last_wins(new, [key], order)
    return old.join(fresh.select(key).distinct(), key, "left_anti").unionByName(fresh, allowMissingColumns=True)


def two_key_crosscheck(left: DataFrame, right: DataFrame, first: str, second: str, facts: list[str]) -> DataFrame:
    """``left`` rows against ``right`` rows of the same pair of keys (the first whatever its case): ``match``, ``differs`` or ``not_found``.

    ``facts`` are the columns compared (null equals null); right keys that repeat count by their smallest facts.
    """
    known = right.groupBy(F.lower(first).alias("_first"), F.col(second).alias("_second")).agg(F.min(F.struct(*facts)).alias("_facts"))
    joined = left.join(known, (F.lower(first) == F.col("_first")) & (F.col(second) == F.col("_second")), "left")
    same = F.lit(True)
    for fact in facts:
        same = same & F.col(fact).eqNullSafe(F.col(f"_facts.{fact}"))
    status = F.when(F.col("_first").isNull(), "not_found").when(same, "match").otherwise("differs")
    return joined.select(*left.columns, *(F.col(f"_facts.{f}").alias(f"found_{f}") for f in facts), status.alias("status"))
