"""Registries of sources: evidence, overrides, conflicts and field mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import cell_blank, strip
from .documents import doi_of, licence_name


def apply_overrides(base: DataFrame, overrides: DataFrame, key: str) -> DataFrame:
    """``base`` with every filled value of its key's override in place of its own; ``overridden`` tells where."""
    columns = [c for c in overrides.columns if c != key]
    fresh = overrides.select(key, *(F.col(c).alias(f"_new_{c}") for c in columns), F.lit(True).alias("_hit"))
    joined = base.join(fresh, key, "left")
    changed = [F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns]
    return joined.select(*changed, F.coalesce("_hit", F.lit(False)).alias("overridden"))


def override_by_prefix(base: DataFrame, overrides: DataFrame, key: str, prefix: str) -> DataFrame:
    """As ``apply_overrides``, where an override holds for every key that starts with its prefix (the longest wins).

    Prefixes are matched as equality keys of the lengths that occur, so no cross join is needed.
    """
    lengths = sorted({r[0] for r in overrides.select(F.length(prefix)).distinct().collect()}, reverse=True)  # lengths of names
    starts = base.select(key).distinct().withColumn("_p", F.explode(F.array(*(F.substring(key, 1, n) for n in lengths)))) if lengths else None
    if starts is None:
        return base.withColumn("overridden", F.lit(False))
    hits = starts.join(overrides, F.col("_p") == F.col(prefix)).groupBy(key).agg(
        F.max_by(F.struct(*(c for c in overrides.columns if c != prefix)), F.length("_p")).alias("_o")
    )
    return apply_overrides(base, hits.select(key, "_o.*"), key)


def evidence(df: DataFrame, record: str, texts: list[str], words: list[str]) -> DataFrame:
    """(record, word): records one of whose texts holds a word, whatever its case."""
    whole = F.lower(F.concat_ws("\n", *texts))
    hits = F.filter(F.array(*(F.lit(w) for w in words)), lambda w: whole.contains(F.lower(w)))
    return df.select(F.col(record).alias("record"), F.explode(hits).alias("word"))


def licences(df: DataFrame, group: str, text: str) -> DataFrame:
    """Per group: licences its texts name, and whether they conflict."""
    named = df.select(group, licence_name(F.col(text)).alias("licence")).filter("licence is not null").distinct()
    return named.groupBy(group).agg(F.count(F.lit(1)).alias("n_licences"), F.min("licence").alias("first_licence"), F.max("licence").alias("last_licence")).withColumn(
        "conflict", F.col("n_licences") > 1
    )


def attribution(title: Column, authors: Column, text: Column) -> Column:
    """Title, authors and the DOI a text holds, joined by ``; ``."""
    return F.concat_ws("; ", strip(title), strip(authors), F.concat(F.lit("https://doi.org/"), doi_of(text)))


# Kinds of publications, by what a source's texts hold, the first that fits.
PUBLICATIONS = [
    ("preprint", r"biorxiv|medrxiv|arxiv|preprint"), ("patent", r"\bpatent\b|\bwo ?[0-9]{4}|\bus ?[0-9]{7,}"), ("dataset", r"zenodo|figshare|dryad|dataset"),
    ("journal_article", r"10\.[0-9]{4,9}/|\bjournal\b|pmid"),
]


def publication_type(text: Column) -> Column:
    """The kind of publication a source's texts tell; ``unknown`` where they do not."""
    low = F.lower(text)
    return F.coalesce(*(F.when(low.rlike(pattern), F.lit(kind)) for kind, pattern in PUBLICATIONS), F.lit("unknown"))


def explicit_mappings(dictionary: DataFrame, definition: list[str]) -> DataFrame:
    """Dictionary rows that name a definition in full: every definition column is filled."""
    filled = F.lit(True)
    for column in definition:
        filled = filled & ~cell_blank(F.col(column))
    return dictionary.filter(filled)


def label_conflicts(df: DataFrame, key: Column, label: Column) -> DataFrame:
    """(key, n_labels, first_label, last_label): keys with several labels; swap the arguments for the other direction."""
    pairs = df.select(key.alias("key"), label.alias("label")).filter("key is not null and label is not null").distinct()
    return pairs.groupBy("key").agg(F.count(F.lit(1)).alias("n_labels"), F.min("label").alias("first_label"), F.max("label").alias("last_label")).filter("n_labels > 1")
