"""Keys, counts and profiles over unbounded event streams, with bounded state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def distinct_events(events: DataFrame, key: list[str], at: str, delay: str = "10 minutes") -> DataFrame:
    """Events once per key, as long as repeats arrive within ``delay`` of each other."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark(key)


def window_profile(events: DataFrame, at: str, kind: str, value: str, width: str = "1 hour", delay: str = "2 hours") -> DataFrame:
    """Per window and kind: rows, filled values, smallest, largest and mean; late rows within ``delay`` still count."""
    windowed = events.withWatermark(at, delay).groupBy(F.window(at, width).alias("w"), F.col(kind).alias("kind"))
    return windowed.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(value).alias("n_values"), F.min(value).alias("smallest"), F.max(value).alias("largest"), F.avg(value).alias("mean"),
        F.approx_count_distinct(value).alias("about_distinct"),
    ).select(F.col("w.start").alias("window_start"), "kind", "n_rows", "n_values", "smallest", "largest", "mean", "about_distinct")


def matched_references(references: DataFrame, parents: DataFrame, key: str, at: str, parent_at: str, within: str = "1 hour") -> DataFrame:
    """References with their parent where it arrives within ``within`` on either side, and without one where it does not."""
    left = references.withWatermark(at, within).alias("r")
    right = parents.select(F.col(key).alias("_k"), F.col(parent_at).alias("_at")).withWatermark("_at", within).alias("p")
    near = F.expr(f"r.{key} = p._k AND p._at BETWEEN r.{at} - INTERVAL {within} AND r.{at} + INTERVAL {within}")
    return left.join(right, near, "left_outer").select("r.*", F.col("p._k").isNotNull().alias("has_parent"))
