"""Numeric statements in texts, and claims against recomputed facts."""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# What counts as a numeric statement, and its units.
NUMBER = re.compile(
    r"(?<![\w.])(?:approximately\s+|about\s+|~\s*)?(?P<number>\d{1,3}(?:,\d{3})+|\d+(?:\.\d+)?)"
    r"(?:\s*(?P<unit>million|billion|%|fold|pairs?|entries|records?|antibodies|assays?))?",
    re.I,
)
SCALE = {"million": 1e6, "billion": 1e9}
# Rules by which a number states nothing. Each names the stretch of text it takes, and how many characters around it as well.
EXCLUSIONS = {
    "reference_list": (r"\[[\d,\s;–-]{1,60}\]", 0),
    "year": (r"(?<![\w.,])(?:19|20)\d\d(?!\d|[.,]\d)", 0),
    "version": (r"(?:version|v\.?|python|\br)\s*\d+(?:\.\d+)+", 0),
    "record_id": (r"DOTAD[-\s]*\d+(?:\.\d+)*", 0),
    "label": (r"(?:fig(?:ure)?s?|tables?|sections?)\.?\s*\d+(?:\.\d+)?", 0),
    "second_figure": (r"figures?\s+\d+\s+(?:and|to|[-–])\s*\d+", 0),
    "numbered_source": (r"(?:pmid|doi|grant|fund|project|award|no\.)\s*[:#]?\s*\d+", 0),
    "marker": (r"\(\d{1,3}\)", 0),
    "link": (r"https?://\S*", 0),
    "near_identifier": (r"\b(?:PMID|DOI)\b", 80),
    "near_funding": (r"grant\s+nos?\.?|funded by|funding|natural science foundation", 80),
    "near_date": (r"(?:January|February|March|April|May|June|July|August|September|October|November|December)\s+\d{1,2},\s+\d{4}", 80),
}
# Categories of statements with the texts that tell them, the first that fits.
CATEGORIES = [
    ("correlation", ["pearson", "spearman", "correlation", "r ="]), ("pca", ["pca", "pc1", "pc2", "pc3", "variance"]),
    ("statistical_test", ["p <", "p =", "wilcoxon", "test"]), ("concordance", ["concordance"]), ("coverage", ["coverage", "covered"]),
    ("missingness", ["missing", "completeness"]), ("benchmark", ["benchmark", "task"]), ("resource_size", ["entry", "record", "annotation", "resource"]),
    ("composition", ["%", "format"]),
]
# Words in a claim's metric or category, and the words that paths of its sources hold.
SOURCE_WORDS = [
    (["sequence", "entry", "resource_size"], ["sequence", "dataset", "metadata", "benchmark"]), (["annotation", "record"], ["experimental", "literature", "dataset", "benchmark"]),
    (["coverage", "missing", "composition", "subset"], ["statistics", "metadata", "experimental"]),
    (["correlation", "pca", "concordance", "pair"], ["statistics", "figure", "harmon", "experimental"]), (["benchmark"], ["benchmark"]),
]
#: Characters of context on either side of a statement.
CONTEXT = 180
_RULES = [(re.compile(pattern, re.I), reach) for pattern, reach in EXCLUSIONS.values()]


def silent_stretches(text: str) -> list[tuple[int, int]]:
    """Disjoint stretches of a text whose numbers state nothing, in order."""
    found = sorted((m.start() - reach, m.end() + reach) for pattern, reach in _RULES for m in pattern.finditer(text))
    out: list[tuple[int, int]] = []
    for low, high in found:
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], high))
        else:
            out.append((low, high))
    return out


def stated(text: str, registered: list[tuple[str, re.Pattern]] = ()) -> Iterator[tuple[str | None, int, str, float | None, str, str]]:
    """(claim, start, token, value, unit, context) of the statements of a text: first those of registered patterns, then other numbers outside them."""

    def around(low: int, high: int) -> str:
        return text[max(0, low - CONTEXT) : high + CONTEXT]

    taken = []
    for claim, pattern in registered:
        if match := pattern.search(text):
            taken.append(match.span())
            yield claim, match.start(), match[0], None, "", around(*match.span())
    silent = silent_stretches(text)
    starts = [low for low, _ in silent]
    for match in NUMBER.finditer(text):
        low, high = match.span("number")
        at = bisect_right(starts, high - 1) - 1
        if (at >= 0 and silent[at][1] > low) or any(a < match.end() and match.start() < b for a, b in taken):
            continue
        unit = (match["unit"] or "").lower()
        yield None, low, match["number"], float(match["number"].replace(",", "")) * SCALE.get(unit, 1), unit, around(low, match.end())


def numeric_claims(df: DataFrame, record: str, text: str, registered: dict[str, str] | None = None) -> DataFrame:
    """(record, claim, start, token, value, unit, context): one row per statement; positions need Python, so texts with digits run in Arrow batches.

    ``registered``: patterns (by claim id) that are looked for first; numbers inside what they match are not stated again.
    """
    kind = df.schema[record].dataType.simpleString()
    wanted = dict(registered or {})

    def run(batches):
        patterns = [(claim, re.compile(pattern, re.I)) for claim, pattern in wanted.items()]
        for batch in batches:
            rows = [(r, *c) for r, t in zip(batch["record"], batch["text"]) for c in stated(t, patterns)]
            yield pd.DataFrame(rows, columns=["record", "claim", "start", "token", "value", "unit", "context"])

    texts = df.select(F.col(record).alias("record"), F.col(text).alias("text")).filter(F.col("text").isNotNull())
    if not wanted:
        texts = texts.filter(F.col("text").rlike("[0-9]"))
    return texts.mapInPandas(run, f"record {kind}, claim string, start int, token string, value double, unit string, context string")


def claim_category(text: Column) -> Column:
    """The first category one of whose words the text holds."""
    low, out = F.lower(text), None
    for name, marks in CATEGORIES:
        hit = low.contains(marks[0])
        for mark in marks[1:]:
            hit = hit | low.contains(mark)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out.otherwise("other")


def differences(claimed: Column, recomputed: Column) -> tuple[Column, Column]:
    """(absolute, relative) difference of two numbers to nine decimals; the relative one is null where the claim is zero."""
    absolute = recomputed - claimed
    return F.round(absolute, 9), F.round(absolute / F.nullif(claimed, F.lit(0.0)), 9)


def claim_verdicts(claims: DataFrame, facts: DataFrame, key: str, tolerance: float = 0.01) -> DataFrame:
    """Claims (key, claimed) with the fact of their key (key, fact): differences (recomputed - claimed) and verdict."""
    joined = claims.join(facts.groupBy(key).agg(F.first("fact").alias("fact")), key, "left")
    absolute, relative = differences(F.col("claimed"), F.col("fact"))
    difference = F.col("fact") - F.col("claimed")
    return joined.select(
        *claims.columns, "fact", absolute.alias("difference"), relative.alias("relative_difference"),
        F.when(F.col("fact").isNull(), "unresolved").when(F.col("claimed").isNull(), "not_numeric").when(difference == 0, "verified_exact")
        .when(F.abs(difference) <= tolerance * F.abs(F.col("claimed")), "verified_rounding").otherwise("contradicted").alias("verdict"),
    )


def candidate_sources(claims: DataFrame, files: DataFrame, claim: str, about: Column, path: str, k: int = 12) -> DataFrame:
    """(claim, path, score, rank): the ``k`` files whose paths hold most of the words that a claim's metric and category (``about``) call for.

    Claims meet paths by equality of words: the words are a fixed table, so each path is marked with those it holds once.
    """
    low = F.col("low")
    called = F.array_distinct(F.flatten(F.array(*(
        F.when(F.exists(F.array(*map(F.lit, marks)), lambda m: F.contains(low, m)), F.array(*map(F.lit, words))).otherwise(F.array().cast("array<string>"))
        for marks, words in SOURCE_WORDS
    ))))
    words = F.array(*map(F.lit, sorted({w for _, group in SOURCE_WORDS for w in group})))
    held = files.select(F.col(path).alias("path")).select("path", F.explode(F.filter(words, lambda w: F.contains(F.lower("path"), w))).alias("word")).distinct()
    wanted = claims.select(F.col(claim).alias("claim"), F.lower(about).alias("low")).select("claim", F.explode(called).alias("word")).distinct()
    scored = wanted.join(held, "word").groupBy("claim", "path").agg(F.count(F.lit(1)).alias("score"))
    order = Window.partitionBy("claim").orderBy(F.desc("score"), "path")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def fact_table(facts: dict[str, DataFrame]) -> DataFrame:
    """(metric, fact) of one-row, one-column results: every fact is a small query of its own."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("metric"), F.col(df.columns[0]).cast("double").alias("fact")) for name, df in facts.items()])
