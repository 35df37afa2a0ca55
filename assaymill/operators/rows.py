"""Rows that projections make: provenance, defaults, descriptions, single rows and orders."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.blanks import cell_blank, condition_key, strip


def with_provenance(df: DataFrame, row: Column, **facts: Any) -> DataFrame:
    """All columns, the physical row they come from, and fixed facts about where that is (file, sheet, release)."""
    return df.select("*", row.alias("source_row"), *(F.lit(value).alias(name) for name, value in facts.items()))


def completed(df: DataFrame, fields: dict[str, Any]) -> DataFrame:
    """The fields in their order: the column where ``df`` has it and it is filled, else the default; other columns are dropped."""
    kinds = dict(df.dtypes)

    def field(name: str, default: Any) -> Column:
        if name not in kinds:
            return F.lit(default)
        return F.coalesce(F.when(~cell_blank(F.col(name)), F.col(name)) if kinds[name] == "string" else F.col(name), F.lit(default))

    return df.select(*(field(name, default).alias(name) for name, default in fields.items()))


def companion_rows(listed: DataFrame, audited: DataFrame, path: str, fields: dict[str, Any], counts: DataFrame) -> DataFrame:
    """Files a document lists and files an audit found, as rows of one record layout with defaults; ``record_source`` tells which.

    ``counts`` is one row of facts about the archive, which every row carries.
    """
    fresh = audited.join(listed.select(path).distinct(), path, "left_anti")
    parts = [completed(df, fields).withColumn("record_source", F.lit(name)) for df, name in ((listed, "listed"), (fresh, "audit"))]
    return parts[0].unionByName(parts[1]).crossJoin(F.broadcast(counts))  # one row


def describe_blocks(df: DataFrame, block: str, layer: str, identifier: Column, source: str) -> DataFrame:
    """(block, layer, n_rows, n_ids, n_sources, first_source): one description row per block and layer; counts and the first source, not lists."""
    cells = df.groupBy(block, layer, identifier.alias("_id"), F.col(source).alias("_source")).agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(block, layer).agg(
        F.sum("n").alias("n_rows"), F.count_distinct("_id").alias("n_ids"), F.count_distinct("_source").alias("n_sources"), F.min("_source").alias("first_source")
    )


def singleton_if(spark: SparkSession, holds: bool, row: dict[str, str]) -> DataFrame:
    """A table of the one row, or of none."""
    return spark.createDataFrame([tuple(row.values())] if holds else [], ", ".join(f"{name} string" for name in row))


def first_row(df: DataFrame, condition: Column, *order: Any) -> DataFrame:
    """The first row that meets the condition, in an explicit order."""
    return df.filter(condition).orderBy(*order).limit(1)


def unresolved(df: DataFrame, status: str, resolved: list[str], *ids: str) -> DataFrame:
    """Rows whose status is missing or none of the resolved ones; with ``ids``, only those columns and the status."""
    rows = df.filter(cell_blank(F.col(status)) | ~F.col(status).isin(resolved))
    return rows.select(*ids, status) if ids else rows


def counted_in_order(df: DataFrame, key: str, ordinal: str) -> DataFrame:
    """(key, n, first_ordinal, place): rows per key, and the keys' places by where each occurs first (ties by name)."""
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min(ordinal).alias("first_ordinal"))
    return counted.withColumn("place", F.row_number().over(Window.orderBy(F.col("first_ordinal").asc_nulls_last(), key)))  # keys, not rows


def category_place(column: Column, order: list[str]) -> Column:
    """Place of a category in a given order; categories outside it come last."""
    place = F.array_position(F.array(*map(F.lit, order)), column)
    return F.when(F.coalesce(place, F.lit(0)) == 0, F.lit(len(order) + 1)).otherwise(place)


def folded_order(column: Column) -> list[Column]:
    """Sort keys whatever the case, ties by the text itself."""
    return [F.lower(column), column]


def relative_path(path: Column, root: str) -> Column:
    """The path below a root folder, with forward slashes; paths elsewhere stay whole."""
    plain = F.translate(path, "\\", "/")
    base = root.replace("\\", "/").rstrip("/") + "/"
    return F.when(F.startswith(plain, F.lit(base)), F.substring(plain, len(base) + 1, 1 << 30)).otherwise(plain)


def first_existing(values: dict[str, Column], *names: str) -> Column:
    """The value of the first of the names that there is a column for, null or not."""
    return next((values[name] for name in names if name in values), F.lit(None))


def payload_lookup(payload: Column, header: str) -> Column:
    """The value under the first cell of a payload (an array of column_index, header, value) whose header is that, whatever its case and blanks."""
    wanted = F.lit(" ".join(header.lower().split()))
    cells = F.filter(F.array_sort(payload), lambda c: F.lower(F.regexp_replace(strip(c["header"]), r"\s+", " ")) == wanted)
    return F.try_element_at(cells, F.lit(1))["value"]


def measurement_rows(df: DataFrame, record: str, identifier: Column, endpoint: Column, value: Column, conditions: dict[str, Column], source: list[str]) -> DataFrame:
    """One row per measurement: record, antibody, endpoint, number, the key of its conditions and where it comes from (the parts joined by ``!``)."""
    where = F.concat_ws("!", *(F.col(c).cast("string") for c in source))
    return df.select(F.col(record).alias("record_id"), identifier.alias("antibody_id"), endpoint.alias("endpoint"), value.alias("value"), condition_key(conditions).alias("condition"), where.alias("source_ref"))


def stale(outputs: DataFrame, inputs: DataFrame, path: str, at: str) -> DataFrame:
    """(path, at, newest_input): outputs older than the newest input."""
    newest = inputs.agg(F.max(at).alias("newest_input"))
    return outputs.select(path, at).crossJoin(F.broadcast(newest)).filter(F.col(at) < F.col("newest_input"))  # one row


def registry_join(df: DataFrame, registry: DataFrame, key: str, value: str, missing: str) -> DataFrame:
    """``df`` with the registry's value of its key; ``missing`` where the registry has none. Keys that repeat in the registry with several values are an error of it and come out as ``ambiguous``."""
    known = registry.groupBy(key).agg(F.min(value).alias("_low"), F.max(value).alias("_high"))
    joined = df.join(known, key, "left")
    found = F.when(F.col("_low").isNull(), F.lit(missing)).when(F.col("_low") != F.col("_high"), F.lit("ambiguous")).otherwise(F.col("_low"))
    return joined.select(*df.columns, found.alias(value))
