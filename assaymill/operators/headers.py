"""Plan-time resolution of headers: which column means what. Works on schemas, never on rows."""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Suffixes of summary columns.
CENTRES, COUNTS, SPREADS = ("avg", "mean", "median"), ("replicates", "count"), ("stddev", "sd")


def header_token(header: str, keep_percent: bool = False) -> str:
    """NFKC, lower case, runs of other characters as one underscore."""
    outside = r"[^0-9a-z%]+" if keep_percent else r"[^0-9a-z]+"
    return re.sub(outside, "_", unicodedata.normalize("NFKC", header).strip().lower()).strip("_")


def canonical_endpoint(header: str) -> str:
    """Token of an endpoint, with ``ph7_0`` written ``ph7``."""
    return re.sub(r"ph([0-9]+)_0(?=_|$)", r"ph\1", header_token(header, True))


def endpoint_and_batch(endpoint: str, aliases: dict[str, str] | None = None) -> tuple[str, str | None]:
    """(raw endpoint, production batch or None) of a summary endpoint such as ``titer_productionbatch2``."""
    match = re.fullmatch(r"(.+)_productionbatch([0-9]+)", endpoint)
    name, batch = (match[1], match[2]) if match else (endpoint, None)
    return (aliases or {}).get(name, name), batch


@dataclass(frozen=True)
class SummaryMetric:
    endpoint: str
    function: str
    column: str
    count_column: str | None
    spread_column: str | None


def summary_metrics(columns: list[str]) -> list[SummaryMetric]:
    """Summary columns of a sheet, each with the columns of its count and spread."""
    by_token = {header_token(c, True): c for c in reversed(columns)}
    out = []
    for column in columns:
        token = header_token(column, True)
        match = re.fullmatch(rf"(.+)_({'|'.join(CENTRES)})", token)
        if match:
            count = next((by_token[f"{match[1]}_{s}"] for s in COUNTS if f"{match[1]}_{s}" in by_token), None)
            spread = next((by_token[f"{match[1]}_{s}"] for s in SPREADS if f"{match[1]}_{s}" in by_token), None)
            out.append(SummaryMetric(canonical_endpoint(match[1]), match[2], column, count, spread))
    return out


def resolve(columns: list[str], wanted: tuple[str, ...]) -> str | None:
    """The column whose token is the first of ``wanted`` that is there; the first of equal headers."""
    tokens = [header_token(c) for c in columns]
    return next((columns[tokens.index(header_token(w))] for w in wanted if header_token(w) in tokens), None)


def picked(df: DataFrame, *wanted: str) -> Column:
    """The column that exists under the first of the names (its nulls stay null), or null where none does."""
    column = resolve(df.columns, wanted)
    return F.col(f"`{column}`") if column else F.lit(None).cast("string")


def long_summaries(df: DataFrame, keep: list[str]) -> DataFrame:
    """Summary columns as rows: kept columns, endpoint, function, batch, reported, reported_n, reported_sd."""
    def number(column: str | None) -> Column:
        return F.col(f"`{column}`").cast("string").try_cast("double") if column else F.lit(None).cast("double")

    metrics = summary_metrics(df.columns)
    if not metrics:
        return df.select(*keep, *(F.lit(None).cast(t).alias(n) for n, t in _LONG)).limit(0)
    cells = F.array(*(
        F.struct(
            F.lit(endpoint_and_batch(m.endpoint)[0]).alias("endpoint"), F.lit(m.function).alias("function"), F.lit(endpoint_and_batch(m.endpoint)[1]).alias("batch"),
            number(m.column).alias("reported"), number(m.count_column).alias("reported_n"), number(m.spread_column).alias("reported_sd"),
        )
        for m in metrics
    ))
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*").filter("reported is not null")


_LONG = [("endpoint", "string"), ("function", "string"), ("batch", "string"), ("reported", "double"), ("reported_n", "double"), ("reported_sd", "double")]


def long_replicates(df: DataFrame, keep: list[str], endpoints: list[str]) -> DataFrame:
    """Replicate columns as rows: kept columns, endpoint, value; columns that are no endpoint are left out."""
    wanted = {canonical_endpoint(e) for e in endpoints}
    columns = [c for c in df.columns if canonical_endpoint(c) in wanted]
    if not columns:
        return df.select(*keep, F.lit(None).cast("string").alias("endpoint"), F.lit(None).cast("double").alias("value")).limit(0)
    cells = F.array(*(F.struct(F.lit(canonical_endpoint(c)).alias("endpoint"), F.col(f"`{c}`").cast("string").try_cast("double").alias("value")) for c in columns))
    return df.select(*keep, F.explode(cells).alias("c")).select(*keep, "c.*").filter("value is not null")
