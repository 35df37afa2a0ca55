"""Rules over finished tables: every rule is a row with its number of violations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import strip


def row_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """(table_name, rule, violations) of row predicates that must hold (null counts as a violation), in one pass."""
    counted = df.agg(*(F.count(F.when(~F.coalesce(holds, F.lit(False)), 1)).alias(name) for name, holds in rules.items()))
    rows = F.array(*(F.struct(F.lit(name).alias("rule"), F.col(name).alias("violations")) for name in rules))
    return counted.select(F.lit(table).alias("table_name"), F.explode(rows).alias("r")).select("table_name", "r.*")


def vocabulary(df: DataFrame, column: Column, allowed: list[str]) -> DataFrame:
    """(value, n) of values outside a controlled vocabulary."""
    counted = df.select(column.alias("value")).groupBy("value").agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("value").isNull() | ~F.col("value").isin(allowed))


def core_counts(tables: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """(table_name, metric, value): rows, filled ids, distinct ids and repeated ids of tables with an id column."""
    parts = []
    for name, (df, column) in tables.items():
        integral = df.schema[column].dataType.typeName() in ("long", "integer", "short", "byte")
        key = F.col(column) if integral else F.nullif(strip(F.col(column).cast("string")), F.lit(""))
        counted = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
        one = counted.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.when(F.col("k").isNotNull(), F.col("n"))), F.lit(0)).alias("ids"), F.count("k").alias("distinct_ids")
        )
        metrics = F.array(*(F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in {
            "rows": F.col("rows"), "ids": F.col("ids"), "distinct_ids": F.col("distinct_ids"), "repeated_ids": F.col("ids") - F.col("distinct_ids"),
        }.items()))
        parts.append(one.select(F.lit(name).alias("table_name"), F.explode(metrics).alias("m")).select("table_name", "m.*"))
    return reduce(DataFrame.unionByName, parts)


def set_equality(left: DataFrame, right: DataFrame, column: str) -> DataFrame:
    """(side, value): values that stand on one side only."""
    a, b = left.select(column).distinct(), right.select(column).distinct()
    return a.join(b, column, "left_anti").select(F.lit("left_only").alias("side"), F.col(column).alias("value")).unionByName(
        b.join(a, column, "left_anti").select(F.lit("right_only").alias("side"), F.col(column).alias("value"))
    )


def report_markdown(rules: DataFrame, title: str) -> str:
    """A short report of a rules table (rules, not data, are collected)."""
    rows = rules.orderBy("table_name", "rule").collect()
    failed = [r for r in rows if r["violations"]]
    lines = [f"# {title}", "", f"{len(rows) - len(failed)} of {len(rows)} rules hold.", ""]
    lines += [f"- {r['table_name']}: {r['rule']} ({r['violations']} violations)" for r in failed]
    return "\n".join(lines) + "\n"


def release_checks(spark, folder: str, expected: dict[str, int], problems: list[str]) -> DataFrame:
    """(table_name, rule, violations) of a finished release folder: declared tables are there with their rows, checksums hold, no run is open.

    ``expected``: file name to row count; ``problems``: what the checksum verification found.
    """
    from pathlib import Path

    rows = [(name, "file_present", int(not (Path(folder) / name).is_file())) for name in sorted(expected)]
    for name, count in sorted(expected.items()):
        if (Path(folder) / name).is_file():
            found = spark.read.csv(f"{folder}/{name}", sep="\t", header=True, multiLine=True, quote='"', escape='"').count()
            rows.append((name, "row_count", abs(found - count)))
    rows.append(("release", "checksums", len(problems)))
    rows.append(("release", "no_open_run", int((Path(folder) / "active_run.json").exists())))
    return spark.createDataFrame(rows, "table_name string, rule string, violations long")


def mapping_violations(mappings: DataFrame, status: str, command: str, *ids: str) -> DataFrame:
    """Mapped claims that count as verified without a command that reproduces them."""
    named = F.coalesce(F.trim(command), F.lit("")) != ""
    return mappings.filter(F.startswith(F.col(status), F.lit("verified")) & ~named).select(*ids, status)


def text_safety(texts: DataFrame, record: str, text: str, tokens: list[str]) -> DataFrame:
    """(record, finding): personal paths and prohibited tokens (whatever their case) of texts; each finding once a text."""
    low = F.lower(text)
    findings = [F.when(F.col(text).rlike(PERSONAL_PATH), F.lit("personal_path")), *(F.when(F.contains(low, F.lit(t.lower())), F.lit(f"token:{t}")) for t in tokens)]
    return texts.select(F.col(record).alias("record"), F.explode(F.array_compact(F.array(*findings))).alias("finding"))


# Folders of a person on a machine.
PERSONAL_PATH = r"(/home/|/Users/|[A-Z]:\\Users\\)[A-Za-z0-9._-]+"


def output_checks(files: DataFrame, tables: DataFrame, required: list[str]) -> DataFrame:
    """(rule, violations) of a finished output tree: ``files`` (path, size, sha256, sha256_before) and ``tables`` (table_name, row_count, declared_rows, column_count, error).

    Required files are there and not empty, paths do not repeat whatever their case, nothing temporary is left, inputs did not change, tables have their
    declared rows and some columns, no two tables share a name, every error is named.
    """
    known = files.filter(F.col("path").isin(required)).agg(F.count_distinct("path").alias("n")).select(F.lit("required_missing").alias("rule"), (F.lit(len(set(required))) - F.col("n")).alias("violations"))
    row_rules = {
        "required_empty": F.col("path").isin(required) & (F.col("size") == 0), "temporary_left": F.col("path").rlike(r"(\.tmp|~|/active_run\.json)$|^active_run\.json$"),
        "hash_missing": F.col("sha256").isNull(), "hash_malformed": ~F.col("sha256").rlike("^[0-9a-f]{64}$"), "input_changed": F.col("sha256_before").isNotNull() & (F.col("sha256_before") != F.col("sha256")),
        "path_unsafe": F.col("path").rlike(r"^/|(^|/)\.\.(/|$)"),
    }
    table_rules = {
        "rows_differ": F.col("declared_rows").isNotNull() & ~F.col("row_count").eqNullSafe(F.col("declared_rows")), "no_columns": F.col("error").isNull() & (F.coalesce("column_count", F.lit(0)) == 0),
        "error_unnamed": F.col("error").isNotNull() & (F.trim("error") == ""), "rows_negative": F.col("row_count") < 0,
    }

    def counted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
        one = df.agg(*(F.count(F.when(broken, 1)).alias(rule) for rule, broken in rules.items()))
        return one.select(F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.col(r).alias("violations")) for r in rules))).alias("r")).select("r.*")

    def repeated(df: DataFrame, key: Column, rule: str) -> DataFrame:
        return df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("violations"))

    parts = [known, counted(files, row_rules), repeated(files, F.lower("path"), "paths_clash"), counted(tables, table_rules), repeated(tables, F.lower("table_name"), "tables_clash")]
    return reduce(DataFrame.unionByName, parts)
