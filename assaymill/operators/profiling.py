"""Profiles of tables and columns.

Columns are unpivoted to (position, value) and counted per distinct value first (with the first row
it stands in), so types, samples and distinct counts are computed on distinct values and the
shuffle carries each value once per map task. Counts are exact: nothing is capped.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.blanks import inferred_type, strip

# Roles of columns in order, with the fragments of a name that suggest them; ``=`` asks for the whole name, ``$`` for its end, ``+`` joins fragments that must all be there.
ROLES = [
    ("primary_key", ["=id", "$_id"]), ("foreign_key", ["=id", "$_id"]), ("source", ["source", "reference", "study"]), ("doi", ["doi"]), ("pmid", ["pmid", "pubmed"]),
    ("dotad_id", ["dotad+id", "=antibody_id"]), ("sequence", ["sequence", "_vh", "_vl", "_hc", "_lc", "cdr"]), ("assay", ["assay", "endpoint", "metric"]),
    ("value", ["value", "score", "measurement", "mean", "median"]), ("unit", ["unit"]), ("condition", ["condition", "ph", "temperature", "concentration"]),
    ("version", ["version", "release"]),
]
# Sequence roles of columns, the first that fits.
SEQUENCE_ROLES = [
    ("cdr", ["cdr"]), ("vh", ["=vh", "$_vh", "vh_", "heavy_variable", "variable_heavy"]), ("vl", ["=vl", "$_vl", "vl_", "light_variable", "variable_light"]),
    ("heavy", ["heavy", "=hc", "$_hc", "hc_"]), ("light", ["light", "=lc", "$_lc", "lc_"]), ("sequence", ["sequence", "=seq", "$_seq"]),
]
# Names that leave no doubt.
CERTAIN = ["=dotad_id", "=antibody_id", "=pmid", "=doi", "=unit", "=value", "=sequence"]
_TESTS = {"=": str.__eq__, "$": str.endswith}


def column_token(name: str) -> str:
    """The name's runs of letters and digits, in lower case, joined by underscores."""
    return "_".join(re.findall("[a-z0-9]+", name.lower()))


def suggests(token: str, fragments: list[str]) -> bool:
    """Does a name hold one of the fragments?"""
    return any(_TESTS[f[0]](token, f[1:]) if f[0] in _TESTS else all(part in token for part in f.split("+")) for f in fragments)


def semantic_roles(name: str) -> list[str]:
    """Roles a column's name suggests (plan time)."""
    token = column_token(name)
    return [role for role, fragments in ROLES if suggests(token, fragments)]


def role_confidence(name: str) -> str:
    levels = [("high", suggests(column_token(name), CERTAIN)), ("medium", bool(semantic_roles(name))), ("low", True)]
    return next(level for level, holds in levels if holds)


def sequence_columns(names: list[str]) -> dict[str, str]:
    """(plan time) The sequence role each column of a table has by its name: heavy, light, vh, vl, cdr or sequence; others are left out."""
    found = ((n, next((role for role, fragments in SEQUENCE_ROLES if suggests(column_token(n), fragments)), None)) for n in names)
    return {name: role for name, role in found if role}


def values_by_column(df: DataFrame, order: Column, columns: list[str]) -> DataFrame:
    """(ordinal, column_name, value, n, first_row) of distinct stripped values; blanks have the value ''."""
    cells = F.array(*(
        F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column_name"), F.coalesce(strip(F.col(c).cast("string")), F.lit("")).alias("value"))
        for i, c in enumerate(columns)
    ))
    long = df.select(order.alias("row_no"), F.explode(cells).alias("cell")).select("row_no", "cell.*")
    return long.groupBy("ordinal", "column_name", "value").agg(F.count(F.lit(1)).alias("n"), F.min("row_no").alias("first_row"))


def column_profile(df: DataFrame, order: Column, columns: list[str], samples: int = 3) -> DataFrame:
    """One row per column: filled, missing and distinct counts, dominant type (ties to the one seen first), first distinct samples."""
    values = values_by_column(df, order, columns).withColumn("type", inferred_type(F.col("value")))
    filled = F.col("value") != ""
    counts = values.groupBy("ordinal", "column_name").agg(
        F.coalesce(F.sum(F.when(filled, F.col("n"))), F.lit(0)).alias("non_missing"), F.coalesce(F.sum(F.when(~filled, F.col("n"))), F.lit(0)).alias("missing"),
        F.count(F.when(filled, 1)).alias("distinct_values"),
    )
    kinds = values.filter(filled).groupBy("ordinal", "type").agg(F.sum("n").alias("n"), F.min("first_row").alias("first_row"))
    kind = kinds.groupBy("ordinal").agg(F.max_by("type", F.struct("n", -F.col("first_row"))).alias("dominant_type"))
    rank = F.row_number().over(Window.partitionBy("ordinal").orderBy("first_row", "value"))
    first = values.filter(filled).withColumn("rank", rank).filter(F.col("rank") <= samples)  # a group-limited window
    hidden = [c for c in columns if "sequence" in semantic_roles(c)]
    shown = F.when(F.col("column_name").isin(hidden), F.lit("[sequence redacted]")).otherwise(F.substring("value", 1, 160)) if hidden else F.substring("value", 1, 160)
    sample = first.withColumn("shown", shown).groupBy("ordinal").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "shown"))), lambda x: x["shown"]), "; ").alias("samples")
    )
    return counts.join(kind, "ordinal", "left").join(sample, "ordinal", "left").select(
        "column_name", "non_missing", "missing", "distinct_values", F.coalesce("dominant_type", F.lit("empty")).alias("dominant_type"),
        F.coalesce("samples", F.lit("")).alias("samples"),
    )


def table_profile(df: DataFrame, name: str, columns: list[str]) -> DataFrame:
    """One row: rows, full-row repeats, rows without any value, columns."""
    texts = [F.coalesce(strip(F.col(c).cast("string")), F.lit("")) for c in columns]
    rows = df.select(F.concat_ws("\x1f", *texts).alias("k"), (F.concat(*texts) == "").alias("blank"))
    counted = rows.groupBy("k", "blank").agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(
        F.lit(name).alias("table_name"), F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"),
        F.coalesce(F.sum(F.when(F.col("blank"), F.col("n"))), F.lit(0)).alias("empty_rows"), F.lit(len(columns)).alias("column_count"),
    )


def header_names(headers: list[str | None], reserved: set[str] = frozenset()) -> list[str]:
    """Field names of a sheet: blanks by position, repeats and reserved names with their position."""
    plain = [(h or "").strip() or f"source_column_{i + 1}" for i, h in enumerate(headers)]
    return [h if plain.count(h) == 1 and h not in reserved else f"{h}__source_column_{i + 1}" for i, h in enumerate(plain)]


def profile_summary(profiles: DataFrame, status: str) -> DataFrame:
    """(metric, value): number of tables, rows in all, and tables per read status, as metric rows."""
    total = profiles.agg(F.count(F.lit(1)).alias("tables"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"))
    metrics = F.array(F.struct(F.lit("tables").alias("metric"), F.col("tables").alias("value")), F.struct(F.lit("rows").alias("metric"), F.col("rows").alias("value")))
    per_status = profiles.groupBy(status).agg(F.count(F.lit(1)).alias("value"))
    return total.select(F.explode(metrics).alias("m")).select("m.*").unionByName(per_status.select(F.concat(F.lit("status:"), status).alias("metric"), "value"))
