"""File-like inventories: duplicate groups, extensions, largest items, categories, archive members."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Ordered rules of a path's category; the first that matches wins.
CATEGORY_RULES = [
    ("raw_source", r"(^|/)(raw|source|sources|original)(/|_|$)"),
    ("source_download", r"references?\.xlsx$|affinity_benchmark.*\.zip$"),
    ("literature_curation", r"literature.*\.(xlsx|csv|tsv|json)$|references?\.(xlsx|csv|tsv|json)$"),
    ("metadata", r"metadata.*\.(xlsx|csv|tsv|json)$"),
    ("sequence", r"sequence.*\.(xlsx|csv|tsv|json|fasta|fa)$|numbering.*\.json$"),
    ("experimental_raw", r"experimental.*raw.*\.(xlsx|csv|tsv|json)$"),
    ("experimental_summary", r"experimental.*(avg|average|summary).*\.(xlsx|csv|tsv|json)$"),
    ("binding_affinity", r"(affinity|binding|titeseq)"),
    ("benchmark", r"benchmark"),
    ("intermediate", r"(rollback|backup|tmp|intermediate|derived)"),
    ("release", r"(^|/)releases?(/|$)"),
    ("website_export", r"assets/data/.*\.json$"),
    ("figure_input", r"(figure|fig)[^/]*input"),
    ("figure_output", r"(figure|fig|results|output).*(png|pdf|svg|tiff?)$"),
    ("script", r"\.(py|r|rmd|ipynb|js|sql|sh|ps1|yml|yaml)$"),
    ("documentation", r"\.(md|rst|txt)$"),
    ("manuscript", r"(manuscript|article).*\.docx$"),
]


# Kinds of files by their endings.
FILE_KINDS = {
    "archive": [".zip", ".tar", ".gz", ".tgz", ".bz2", ".7z", ".rar"], "spreadsheet": [".xlsx", ".xlsm", ".xls", ".ods"], "delimited_text": [".csv", ".tsv", ".txt"],
    "sequence_file": [".fasta", ".fa", ".faa", ".fna", ".fastq"], "script": [".py", ".r", ".rmd", ".ipynb", ".js", ".ts", ".sql", ".sh", ".ps1"],
    "documentation": [".md", ".rst", ".txt", ".docx", ".pdf"], "figure": [".png", ".jpg", ".jpeg", ".tif", ".tiff", ".svg", ".pdf"], "database": [".sqlite", ".sqlite3", ".db", ".parquet"],
}
#: Kinds that are never text.
BINARY_KINDS = ["archive", "spreadsheet", "figure", "database"]
# Media types by ending.
MEDIA_TYPES = {
    ".csv": "text/csv", ".tsv": "text/tab-separated-values", ".txt": "text/plain", ".json": "application/json", ".md": "text/markdown", ".py": "text/x-python", ".zip": "application/zip",
    ".xlsx": "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet", ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".png": "image/png", ".pdf": "application/pdf", ".svg": "image/svg+xml", ".sqlite": "application/vnd.sqlite3",
}


def kind_flags(extension: Column) -> dict[str, Column]:
    """One truth value per kind of file."""
    return {f"is_{kind}": extension.isin(endings) for kind, endings in FILE_KINDS.items()}


def media_type(extension: Column) -> Column:
    return F.coalesce(*(F.when(extension == ending, F.lit(kind)) for ending, kind in MEDIA_TYPES.items()), F.lit("application/octet-stream"))


def is_binary(extension: Column, head: Column) -> Column:
    """Is a file no text? By its kind, or its first bytes: a zero byte, or over three tenths outside printable ASCII."""
    text = F.decode(head, "ISO-8859-1")
    outside = F.length(F.regexp_replace(text, r"[\x20-\x7E\x08\x0C\n\r\t]", ""))
    by_kind = extension.isin([e for kind in BINARY_KINDS for e in FILE_KINDS[kind]])
    return by_kind | F.coalesce(F.contains(text, F.lit("\x00")) | (outside / F.nullif(F.length(text), F.lit(0)) > 0.3), F.lit(False))


def path_category(path: Column, rules: list[tuple[str, str]] = CATEGORY_RULES) -> Column:
    low = F.lower(F.regexp_replace(path, r"\\", "/"))
    out = None
    for name, pattern in rules:
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return out.otherwise("unclassified")


def extension_of(path: Column) -> Column:
    ext = F.lower(F.regexp_extract(path, r"[^/\\.](\.[^./\\]+)$", 1))
    return F.coalesce(F.nullif(ext, F.lit("")), F.lit("[no extension]"))


def extension_summary(files: DataFrame, path: str, size: str) -> DataFrame:
    return files.groupBy(extension_of(F.col(path)).alias("extension")).agg(F.count(F.lit(1)).alias("file_count"), F.sum(size).alias("total_bytes"))


def largest(files: DataFrame, size: str, order: str, k: int = 100) -> DataFrame:
    """The ``k`` largest rows, ties by ``order``: a top-k report."""
    return files.orderBy(F.desc_nulls_last(size), order).limit(k)


def duplicate_groups(items: DataFrame, item: str, content: Column, name: Column | None = None) -> DataFrame:
    """(group_kind, group_key, n_items, first_item, last_item) of items with one content, and of one name with several contents.

    Groups are described by aggregates, so a group with a third of all items is one row; members
    come from a join with the items' keys where they are wanted.
    """
    rows = items.select(F.col(item).alias("item"), F.sha2(content, 256).alias("sha"), (name if name is not None else F.lit(None).cast("string")).alias("name"))
    exact = rows.filter("sha is not null").groupBy("sha").agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("first_item"), F.max("item").alias("last_item"))
    out = exact.filter("n > 1").select(F.lit("exact_content").alias("group_kind"), F.col("sha").alias("group_key"), F.col("n").alias("n_items"), "first_item", "last_item")
    if name is None:
        return out
    same = rows.filter("name is not null").groupBy("name", "sha").agg(F.count(F.lit(1)).alias("n"), F.min("item").alias("a"), F.max("item").alias("b"))
    same = same.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), F.sum("n").alias("n"), F.min("a").alias("first_item"), F.max("b").alias("last_item"))
    return out.unionByName(
        same.filter("kinds > 1").select(F.lit("same_name_other_content").alias("group_kind"), F.col("name").alias("group_key"), F.col("n").alias("n_items"), "first_item", "last_item")
    )


# Parts of a file's name that tell versions of one file apart.
VERSION_MARK = r"(?i)(?:[_\-. ](?:v(?:ersion)?\s*)?\d+(?:\.\d+)*|[_\-. ](?:final|latest|old|copy|\(\d+\)))"


def version_stem(name: Column) -> Column:
    """A file's name in lower case without marks of versions, with its ending."""
    ending = F.lower(F.regexp_extract(name, r"[^.](\.[^.]*)$", 1))
    stem = F.lower(F.regexp_replace(F.substring(name, F.lit(1), F.length(name) - F.length(ending)), VERSION_MARK, ""))
    return F.concat(F.btrim(stem, F.lit(" _-.")), ending)


def version_families(items: DataFrame, item: str, name: str) -> DataFrame:
    """(group_kind, group_key, n_items, first_item, last_item) of files whose names differ by marks of versions only; nothing is preferred or removed."""
    cells = items.filter(F.col(name).isNotNull()).groupBy(version_stem(F.col(name)).alias("key"), F.lower(name).alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.min(item).alias("a"), F.max(item).alias("b")
    )
    families = cells.groupBy("key").agg(F.count(F.lit(1)).alias("names"), F.sum("n").alias("n"), F.min("a").alias("first_item"), F.max("b").alias("last_item")).filter("names > 1")
    return families.select(F.lit("version_family").alias("group_kind"), F.col("key").alias("group_key"), F.col("n").alias("n_items"), "first_item", "last_item")


def ordinal_ids(groups: DataFrame, prefix: str, width: int, *order: str) -> DataFrame:
    """Adds ``group_id``: a running number over a total order. For reports, whose rows are groups, not data."""
    number = F.row_number().over(Window.orderBy(*order))
    return groups.withColumn("group_id", F.format_string(f"{prefix}%0{width}d", number))


# Why a member path is unsafe, with the form such paths have (backslashes count as slashes).
UNSAFE_PATHS = [("absolute_path", r"^/"), ("drive_qualified_path", r"^.:"), ("path_traversal", r"(^|/)\.\.(/|$)")]


def member_status(path: Column, is_symlink: Column) -> Column:
    """``safe``, or the reasons an archive member is not, joined by commas."""
    plain = F.translate(path, "\\", "/")
    reasons = F.concat_ws(",", *(F.when(plain.rlike(form), reason) for reason, form in UNSAFE_PATHS), F.when(is_symlink, "symlink"))
    return F.coalesce(F.nullif(reasons, F.lit("")), F.lit("safe"))


def clashing_paths(members: DataFrame, path: str) -> DataFrame:
    """Paths that occur twice, or that only letter case tells apart."""
    return members.groupBy(F.lower(path).alias("folded")).agg(F.count(F.lit(1)).alias("n"), F.min(path).alias("first_path")).filter("n > 1")
