"""Text operators: licences, identifiers, markdown tables, script references and unsafe texts."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

DOI = r"(10\.[0-9]{4,9}/[^\s\"<>)\],;]+)"
# Endings of data files that a script may name, and names that are no files.
ENDINGS = ["csv", "tsv", "txt", "xlsx", "xlsm", "json", "parquet", "sqlite", "db", "zip", "png", "pdf", "svg"]
NO_FILES = ["csv.zip", ".csv.zip", "zipfile.zip"]
# What a line holds that writes, and that reads, the files it names; texts, and patterns.
WRITING = [
    "to_csv", "to_excel", "write.csv", "write.table", "writefile", "write_text", "write_bytes", "json.dump", "savefig", "ggsave", "screenshot", "page.pdf", "tofile", "--output",
]
WRITING_PATTERNS = [
    r"\boutput\s*:", r"\boutput(?:_file|_path|_json)?\b\s*=", r"\bout(?:put)?_[a-z0-9_]*\s*=",
    r"(?:path\.join|file\.path)\(\s*(?:figure|fig|panel|temp|output|result)[a-z0-9_]*_dir\b",
]
READING = ["read_csv", "read_excel", "read_text", "json.load", "--input"]
READING_PATTERNS = [r"\binput\s*:"]
# How scripts load packages, by ending.
LOADING = [
    ([".py"], r"(?m)^\s*(?:from|import)\s+([A-Za-z0-9_.-]+)"),
    ([".r", ".rmd"], r"(?i)(?:library|require)\s*\(\s*['\"]?([^'\")]+)"),
    ([".js", ".ts"], r"(?:from\s+|require\()['\"]([^'\"]+)"),
]
# What a script is for, by a text in its path, the first that fits.
PURPOSES = [
    ("numbering", "Build sequence numbering website export"), ("hydrophobic", "Build hydrophobicity website export"), ("liabilit", "Build sequence liability website export"),
    ("scorecard", "Build heuristic scorecard website export"), ("statistics", "Build website statistics aggregate"),
]


def doi_of(c: Column) -> Column:
    return F.nullif(F.regexp_replace(F.regexp_extract(c, DOI, 1), r"\.+$", ""), F.lit(""))


def link_text(c: Column) -> Column:
    return F.regexp_extract(c, r"\[([^\]]*)\]\(([^)]*)\)", 1)


def link_target(c: Column) -> Column:
    return F.regexp_extract(c, r"\[([^\]]*)\]\(([^)]*)\)", 2)


def licence_name(c: Column) -> Column:
    """A licence a text names, in one spelling; null for none."""
    low = F.lower(c)
    return (
        F.when(low.rlike(r"cc0|public domain"), "CC0-1.0").when(low.rlike(r"cc[ -]by[ -]nc"), "CC-BY-NC-4.0").when(low.rlike(r"cc[ -]by"), "CC-BY-4.0")
        .when(low.rlike(r"apache"), "Apache-2.0").when(low.rlike(r"\bmit\b"), "MIT").when(low.rlike(r"licen[cs]e"), "unnamed licence")
    )


def text_flags(df: DataFrame, record: str, text: str) -> DataFrame:
    """Per text: long, names a licence, holds a personal path, a DOI or a web address."""
    c = F.col(text)
    return df.filter(c.isNotNull()).select(
        F.col(record).alias("record"), (F.length(c) > 1000).alias("is_long"), c.rlike("licen[cs]e").alias("names_licence"),
        c.rlike(r"(/home/|/Users/|[A-Z]:\\Users\\)[A-Za-z0-9._-]+").alias("personal_path"), c.rlike(DOI).alias("has_doi"), c.rlike("https?://").alias("has_url"),
    )


def release_status(df: DataFrame, group: str, text: Column, cited: Column, long: int = 1000) -> DataFrame:
    """Per group: any long text, every row cited, and whether it may be released as it is."""
    out = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.bool_or(F.length(text) > long), F.lit(False)).alias("any_long_text"), F.bool_and(F.coalesce(cited, F.lit(False))).alias("all_cited")
    )
    return out.withColumn("status", F.when(~F.col("all_cited"), "needs_citation").when(F.col("any_long_text"), "needs_licence_review").otherwise("releasable"))


def markdown_rows(lines: DataFrame, order: str, text: str) -> DataFrame:
    """(order, cells) of the table rows of markdown lines, separator rows left out."""
    rows = lines.filter(F.trim(text).startswith("|"))
    cells = F.transform(F.split(F.regexp_replace(F.trim(text), r"^\||\|$", ""), r"\|"), lambda x: F.trim(x))
    return rows.select(order, cells.alias("cells")).filter(~F.forall("cells", lambda x: x.rlike("^:?-+:?$")))


def carry_sections(paragraphs: DataFrame, document: str, order: str, text: str, heading: Column) -> DataFrame:
    """Adds the section each paragraph stands in: the last heading of its document up to it."""
    before = Window.partitionBy(document).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return paragraphs.withColumn("section", F.coalesce(F.last(F.when(heading, F.col(text)), ignorenulls=True).over(before), F.lit("Front matter")))


def script_references(scripts: DataFrame, path: str, text: str) -> DataFrame:
    """(script, reference, direction) of the data files whole scripts name: quoted names, and bare paths with a folder.

    A file is an output where a line that names it writes, an input where one reads or where none writes. One pattern with
    alternatives takes each place once, so a path inside quotes is not found twice. Null texts name nothing.
    """
    ending = rf"\.(?:{'|'.join(ENDINGS)})"
    named = rf"(?i)'[^'\n]*?{ending}'|\"[^\"\n]*?{ending}\"|[\w./\\()-]*[/\\][\w./\\()-]*?{ending}(?!\w)"

    def holds(line: Column, texts: list[str], patterns: list[str]) -> Column:
        return line.rlike("|".join([*(re.escape(t) for t in texts), *patterns]))

    lines = scripts.select(F.col(path).alias("script"), F.explode(F.split(text, r"\r?\n")).alias("line"))
    low = F.lower("line")
    found = lines.select(
        "script", F.explode(F.regexp_extract_all("line", F.lit(named), F.lit(0))).alias("reference"),
        holds(low, WRITING, WRITING_PATTERNS).alias("writes"), holds(low, READING, READING_PATTERNS).alias("reads"),
    ).withColumn("reference", F.regexp_replace("reference", "^['\"]|['\"]$", ""))
    plain = F.lower("reference")
    found = found.filter(~F.contains("reference", F.lit("://")) & ~plain.isin(NO_FILES) & ~F.startswith(plain, F.lit("zipfile.")))
    sides = found.groupBy("script", "reference").agg(F.bool_or("writes").alias("writes"), F.bool_or("reads").alias("reads"))
    named_sides = F.array(F.when(F.col("reads") | ~F.col("writes"), "input"), F.when(F.col("writes"), "output"))
    return sides.select("script", "reference", F.explode(F.array_compact(named_sides)).alias("direction"))


def packages_of(text: Column, suffix: Column) -> Column:
    """Sorted distinct packages a script loads, by the ways of its ending."""
    none = F.array().cast("array<string>")
    found = [F.when(F.lower(suffix).isin(endings), F.regexp_extract_all(text, F.lit(pattern), F.lit(1))).otherwise(none) for endings, pattern in LOADING]
    return F.array_sort(F.array_distinct(F.concat(*found)))


def script_purpose(path: Column, text: Column) -> Column:
    """What a script is for, told by its path and, for figures, by its beginning as well."""
    low = F.lower(path)
    rules = [(F.startswith(low, F.lit("assets/js/")), "Vendored website runtime/library"), *((F.contains(low, F.lit(mark)), purpose) for mark, purpose in PURPOSES)]
    rules.append((F.contains(F.concat_ws(" ", low, F.lower(F.substring(text, 1, 2000))), F.lit("fig")), "Figure generation or capture"))
    return F.coalesce(*(F.when(rule, F.lit(purpose)) for rule, purpose in rules), F.lit("Unclassified script/config"))


def dependency_edges(references: DataFrame) -> DataFrame:
    """(source, target, edge_type): inputs point at scripts, scripts at outputs."""
    inputs = references.filter("direction = 'input'").select(F.col("reference").alias("source"), F.col("script").alias("target"), F.lit("input_to_script").alias("edge_type"))
    outputs = references.filter("direction = 'output'").select(F.col("script").alias("source"), F.col("reference").alias("target"), F.lit("script_to_output").alias("edge_type"))
    return inputs.unionByName(outputs).distinct()


def resolve_references(references: DataFrame, files: DataFrame, path: str) -> DataFrame:
    """Adds ``exists``: a file whose path is the reference or ends with it. Every path suffix is an equality key, so no cross join is needed."""
    parts = F.split(F.regexp_replace(F.col(path), r"\\", "/"), "/")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "/"))
    known = files.select(F.explode(suffixes).alias("_suffix")).distinct().withColumn("_hit", F.lit(True))
    key = F.regexp_replace(F.regexp_replace("reference", r"\\", "/"), r"^(\./)+", "")
    return references.withColumn("_suffix", key).join(known, "_suffix", "left").withColumn("exists", F.coalesce("_hit", F.lit(False))).drop("_suffix", "_hit")
