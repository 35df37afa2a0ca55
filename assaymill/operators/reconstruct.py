"""Reported summaries rebuilt from raw replicates, with explicit tolerances.

Raw and summary values are in long form (block, id, endpoint, conditions, value); each value is
parsed once. Raw rows are pre-aggregated per combination of conditions, and a summary meets those few
combinations: an equality join with a residual in which a blank or ignored condition of the summary matches any value. A
summary that leaves a condition open which the raw rows vary is not aggregated. Sums and sums of squares are exact decimals, so
means and standard deviations do not depend on the order of rows; medians are taken over counts of distinct values.

A policy (keys, ``two_decimals``, ``documented_filter``, ``may_exclude``, each optional) says per key how close a summary must come, whether its raw
rows passed a documented filter, and whether one unexplained raw row may be missing from it.

Defined cases: null values count for nothing; blank keys match blank keys; values whose square is beyond the decimals have no standard deviation;
a summary of an endpoint that its block has no raw rows of has no counterpart; empty tables give empty results.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import is_close

EXACT, RELATIVE, TWO_DECIMALS = 1e-12, 1e-8, 0.005 + 1e-10
DECIMAL = "decimal(38,12)"
#: What a summary may report besides its value.
REPORTED = {"reported": "double", "reported_n": "double", "reported_sd": "double", "low": "double", "high": "double", "function": "string", "ignored": "array<string>"}
POLICY = ("two_decimals", "documented_filter", "may_exclude")


def raw_statistics(raw: DataFrame, keys: list[str], conditions: list[str]) -> DataFrame:
    """Per keys and conditions: count, exact sum and exact sum of squares (null where a square is beyond the decimals)."""
    square = (F.col("value") * F.col("value")).try_cast(DECIMAL)
    return raw.groupBy(*keys, *conditions).agg(
        F.count("value").alias("n"), F.sum(F.col("value").cast(DECIMAL)).alias("total"), F.when(F.count(square) == F.count("value"), F.sum(square)).alias("squares")
    )


def _meets(keys: list[str], conditions: list[str]) -> Column:
    """Does a raw row (alias r) belong to a summary (alias s)? A blank key matches a blank key; open and ignored conditions match all."""
    equal = (F.col(f"s.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys)
    return reduce(Column.__and__, [*equal, *(_is_open(c) | (F.col(f"s.{c}") == F.coalesce(F.col(f"r.{c}"), F.lit(""))) for c in conditions)])


def _is_open(c: str) -> Column:
    return (F.coalesce(F.col(f"s.{c}"), F.lit("")) == "") | F.coalesce(F.array_contains(F.col("s.ignored"), c), F.lit(False))


def reconstruct(
    summary: DataFrame, raw: DataFrame, summary_id: str, keys: list[str], conditions: list[str], two_decimals: Column | None = None, policy: DataFrame | None = None,
) -> DataFrame:
    """One row per summary value: recomputed value, standard deviation and count, and the statuses of each and overall.

    ``summary``: summary_id, keys, conditions, reported (double), and optionally reported_n, reported_sd, function (``median``, else mean),
    ignored (names of conditions that do not count), and low and high (the range that two reported decimals leave open, where reported is converted
    from another unit); ``raw``: keys, conditions, value (double). Conditions are texts, blank or null where open. ``policy``: some of the keys, with
    flags; ``two_decimals`` is its flag as a column of the summary's keys.
    """
    had = set(summary.columns)
    for name, kind in REPORTED.items():
        if name not in had:
            summary = summary.withColumn(name, F.lit(None).cast(kind))
    if "low" not in had:
        summary = summary.withColumn("low", F.col("reported") - TWO_DECIMALS).withColumn("high", F.col("reported") + TWO_DECIMALS)
    raw = raw.filter("value is not null")
    cells = raw_statistics(raw, keys, conditions)
    joined = summary.alias("s").join(cells.alias("r"), _meets(keys, conditions), "left")
    open_spread = []
    for c in conditions:
        value = F.coalesce(F.col(f"r.{c}"), F.lit(""))
        counts = F.bool_or((F.coalesce(F.col(f"s.{c}"), F.lit("")) == "") & ~F.coalesce(F.array_contains(F.col("s.ignored"), c), F.lit(False)))
        open_spread.append(F.when(counts & (F.min(F.when(F.col("r.n").isNotNull(), value)) != F.max(F.when(F.col("r.n").isNotNull(), value))), F.lit(c)))
    grouped = joined.groupBy(F.col(f"s.{summary_id}").alias(summary_id), *(F.col(f"s.{c}").alias(c) for c in [*keys, *REPORTED])).agg(
        F.coalesce(F.sum("r.n"), F.lit(0)).alias("n"), F.sum("r.total").alias("total"), F.when(F.count("r.squares") == F.count("r.n"), F.sum("r.squares")).alias("squares"),
        F.concat_ws("|", *open_spread).alias("ambiguous"),
    )
    grouped = _with_medians(grouped, summary, raw, summary_id, keys, conditions) if "function" in had else grouped.withColumn("median", F.lit(None).cast("double"))
    # whether a block has raw rows of an endpoint at all; keys are few beside rows
    kept = [k for k in keys if k != "id"] or keys
    present = raw.select(*kept).distinct().withColumn("has_raw", F.lit(True))
    grouped = grouped.alias("g").join(present.alias("p"), reduce(Column.__and__, (F.col(f"g.{k}").eqNullSafe(F.col(f"p.{k}")) for k in kept)), "left").select("g.*", "p.has_raw")
    if policy is not None:
        grouped = grouped.join(policy, [k for k in keys if k in policy.columns], "left")
    for flag in POLICY:
        given = two_decimals if flag == "two_decimals" and two_decimals is not None else None
        value = F.coalesce(F.col(flag), F.lit(False)) if policy is not None and flag in policy.columns else F.lit(False)
        grouped = grouped.withColumn(flag, F.coalesce(given, F.lit(False)) | value if given is not None else value)
    usable = (F.col("n") > 0) & (F.col("ambiguous") == "")
    mean = F.when(usable, F.col("total").cast("double") / F.col("n"))
    out = grouped.withColumn("mean", mean).withColumn("recomputed", F.when(F.lower("function") == "median", F.when(usable, F.col("median"))).otherwise(F.col("mean")))
    spread = (F.col("squares").cast("double") - F.col("n") * F.col("mean") * F.col("mean")) / (F.col("n") - 1)
    out = out.withColumn("recomputed_sd", F.when((F.col("n") > 1) & F.col("mean").isNotNull(), F.sqrt(F.greatest(spread, F.lit(0.0)))))
    out = _with_exclusions(out, summary, raw, summary_id, keys, conditions) if policy is not None and "may_exclude" in policy.columns else out.withColumn("left_out", F.lit(False))
    for name, status in statuses().items():
        out = out.withColumn(name, status)
    return out.select(summary_id, *keys, "reported", "recomputed", "recomputed_sd", "n", "ambiguous", *statuses())


def _with_medians(grouped: DataFrame, summary: DataFrame, raw: DataFrame, summary_id: str, keys: list[str], conditions: list[str]) -> DataFrame:
    """Adds ``median`` to the summaries that report one, over the counts of distinct raw values."""
    counted = raw.groupBy(*keys, *conditions, "value").agg(F.count(F.lit(1)).alias("times"))
    wanted = summary.filter(F.lower("function") == "median")
    met = wanted.alias("s").join(counted.alias("r"), _meets(keys, conditions)).select(F.col(f"s.{summary_id}").alias(summary_id), "r.value", "r.times")
    return grouped.join(met.groupBy(summary_id).agg(F.expr("percentile(value, 0.5, times)").alias("median")), summary_id, "left")


def _with_exclusions(out: DataFrame, summary: DataFrame, raw: DataFrame, summary_id: str, keys: list[str], conditions: list[str]) -> DataFrame:
    """Adds ``left_out``: the mean of all raw values but one is the reported one, which counts one value less. Distinct values are tried, by subtraction."""
    cases = out.filter(F.col("may_exclude") & (F.col("ambiguous") == "") & (F.col("n") == F.col("reported_n") + 1) & (F.col("n") > 1)).select(summary_id, "total", "n", F.col("reported").alias("wanted"))
    counted = raw.groupBy(*keys, *conditions, "value").agg(F.count(F.lit(1)).alias("times"))
    met = summary.alias("s").join(counted.alias("r"), _meets(keys, conditions)).select(F.col(f"s.{summary_id}").alias(summary_id), "r.value").join(cases, summary_id)
    rest = (F.col("total") - F.col("value").cast(DECIMAL)).cast("double") / (F.col("n") - 1)
    hits = met.filter(F.abs(rest - F.col("wanted")) <= RELATIVE).select(summary_id).distinct().withColumn("left_out", F.lit(True))
    return out.join(hits, summary_id, "left").withColumn("left_out", F.coalesce("left_out", F.lit(False)))


def statuses() -> dict[str, Column]:
    """Statuses of a rebuilt summary: of its value, standard deviation and count, and overall; the order of the cases matters."""
    coarse, n = F.col("two_decimals"), F.col("n")
    judged = F.col("recomputed").isNotNull() & F.col("reported").isNotNull()
    value_exact = F.abs(F.col("reported") - F.col("recomputed")) <= EXACT
    value_near = F.when(coarse, F.col("recomputed").between(F.col("low"), F.col("high"))).otherwise(is_close(F.col("reported"), F.col("recomputed"), RELATIVE, RELATIVE))
    gap = F.abs(F.col("reported_sd") - F.col("recomputed_sd"))
    sd_near = F.when(coarse, gap <= TWO_DECIMALS).otherwise(is_close(F.col("reported_sd"), F.col("recomputed_sd"), RELATIVE, RELATIVE))
    has_sd, has_count = F.col("reported_sd").isNotNull(), F.col("reported_n").isNotNull()
    sd_fails = has_sd & ~F.coalesce(sd_near, F.lit(False))
    count_fails = has_count & (F.col("reported_n") != n)
    exact = value_exact & (~has_sd | F.coalesce(gap <= EXACT, F.lit(False)))

    def graded(holds_exactly: Column, holds: Column) -> Column:
        return F.when(holds & coarse, "verified_at_reported_precision").when(holds_exactly, "verified_exact").when(holds, "verified_rounding").otherwise("not_reproducible")

    return {
        "value_status": F.when(~judged, "not_compared").otherwise(graded(value_exact, value_near)),
        "sd_status": F.when(~judged | ~has_sd, "not_compared").when(F.col("recomputed_sd").isNull(), "not_reproducible").otherwise(graded(gap <= EXACT, sd_near)),
        "count_status": F.when(~judged | ~has_count, "not_compared").when(count_fails, "not_reproducible").otherwise("verified_exact"),
        "status": F.when(F.col("ambiguous") != "", "partially_verified").when((n == 0) & F.col("has_raw").isNull(), "summary_only_no_raw_counterpart")
        .when(n == 0, "missing_raw_input").when(~judged, "partially_verified")
        .when(~value_near & F.col("left_out"), "verified_against_source_summary_with_unexplained_raw_exclusion").when(~value_near, "not_reproducible")
        .when(sd_fails | count_fails, "partially_verified").when(F.col("documented_filter"), "verified_with_documented_filter").otherwise(graded(exact, value_near)),
    }


def contributors(summary: DataFrame, raw: DataFrame, summary_id: str, raw_id: str, keys: list[str], conditions: list[str], sources: list[str]) -> DataFrame:
    """(summary_id, raw_id, sources): the raw rows that stand behind each summary, with where they come from; rows, not lists."""
    if "ignored" not in summary.columns:
        summary = summary.withColumn("ignored", F.lit(None).cast("array<string>"))
    met = summary.alias("s").join(raw.filter("value is not null").alias("r"), _meets(keys, conditions))
    return met.select(F.col(f"s.{summary_id}").alias(summary_id), F.col(f"r.{raw_id}").alias(raw_id), *(F.col(f"r.{c}").alias(c) for c in sources)).distinct()


def status_summary(rebuilt: DataFrame, *by: str) -> DataFrame:
    return rebuilt.groupBy(*by, "status").agg(F.count(F.lit(1)).alias("n_summaries"))


def ambiguous_conditions(raw: DataFrame, keys: list[str], conditions: list[str]) -> DataFrame:
    """Keys whose raw rows vary in a condition (a blank counts as a value), with the conditions that vary."""
    spread = [F.when(F.min(F.coalesce(c, F.lit(""))) != F.max(F.coalesce(c, F.lit(""))), F.lit(c)) for c in conditions]
    return raw.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), F.concat_ws("|", *spread).alias("varying")).filter("varying <> ''")


def replicate_structure(raw: DataFrame, keys: list[str], replicate: str, sets: list[str]) -> DataFrame:
    """Per keys: values, distinct replicates and distinct values of each of ``sets``; counts, not collected lists.

    Rows are counted per combination first, so the distinct counts run over combinations.
    """
    cells = raw.groupBy(*keys, replicate, *sets).agg(F.count("value").alias("values"))
    return cells.groupBy(*keys).agg(
        F.sum("values").alias("n_values"), F.count_distinct(replicate).alias("n_replicates"), *(F.count_distinct(F.nullif(F.col(c), F.lit(""))).alias(f"n_{c}") for c in sets)
    )


def leave_one_out(raw: DataFrame, keys: list[str], order: str, reported: DataFrame) -> DataFrame:
    """(keys, left_out): the first raw row without which the mean of the others is the reported one.

    Sums and counts per key give every leave-one-out mean by subtraction; groups are never collected.
    ``reported`` has keys, reported and reported_n = count - 1.
    """
    totals = raw.groupBy(*keys).agg(F.sum(F.col("value").cast(DECIMAL)).alias("total"), F.count("value").alias("n"))
    cases = totals.join(reported, keys).filter("n = reported_n + 1 and n > 1")
    tried = raw.join(cases, keys).withColumn("rest", (F.col("total") - F.col("value").cast(DECIMAL)).cast("double") / (F.col("n") - 1))
    fits = tried.filter(F.abs(F.col("rest") - F.col("reported")) <= RELATIVE)
    return fits.groupBy(*keys).agg(F.min(order).alias("left_out"), F.count(F.lit(1)).alias("n_candidates"))
