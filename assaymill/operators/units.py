"""Quantities recorded in different units, brought to one unit per quantity.

A value is a number with, possibly, a unit in the same cell; else its unit is
named in a unit column, in the name of the endpoint, or nowhere. Where it is
named nowhere, a mixture over the log of the value in the common unit tells it. Its components are the
*factor classes* of the quantity (units with one conversion, such as mg/mL and g/L, are one class, as no number can tell them
apart); they share one centre and spread, learned per quantity from the values whose unit is written, and
are offset by their conversions. Per block of rows the posterior averages over the explanations "all in one class, but for
few strays" and "in several classes, with fitted weights", each weighed by how well it explains all values of the block, so
that few values give no false certainty. A documented default of the block is a prior that puts all weight on its class, so it
always decides; the posterior without it then tells whether the values bear it out.

The mixture sees a histogram (counts of all values per block and bin), so
nothing but bounded tables of bins reaches a Python worker.

Defined cases: null, blank and placeholder cells give no value; a cell that is not
a number followed by at most one unit text, or whose number is beyond the range of a double, gives none either; a written unit of
unknown spelling counts as unwritten but is flagged ``unknown_unit``; values
whose unit is unwritten, undocumented and not told apart by the mixture are kept
and flagged ``uncertain``; a converted value too large for its column stands with a null and is flagged ``out_of_range``;
extra columns are carried or dropped by the caller; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import PLACEHOLDERS, clean
from ..session import Scratch

# Per quantity the units, how a value becomes the common unit, and spellings in key form
# (lower case, no white space, dots, asterisks, middle dots or brackets, micro as u, raised digits lowered).
# linear: common = a * x + b; power: common = 10 ** (a * x + b). The first unit is the common one.
UNITS: dict[str, list[tuple[str, str, float, float, list[str]]]] = {
    "concentration": [
        ("mg/mL", "linear", 1.0, 0.0, ["mg/ml", "mgml-1", "mgperml"]),
        ("g/L", "linear", 1.0, 0.0, ["g/l", "gl-1", "gperl", "gramperlitre", "gramperliter", "gramsperlitre"]),
        ("µg/mL", "linear", 1e-3, 0.0, ["ug/ml", "ugml-1", "ugperml", "mcg/ml", "microgram/ml", "microgramperml"]),
        ("ng/µL", "linear", 1e-3, 0.0, ["ng/ul", "ngul-1", "ngperul"]),
        ("mg/L", "linear", 1e-3, 0.0, ["mg/l", "mgl-1", "mgperl"]),
        ("% w/v", "linear", 10.0, 0.0, ["%w/v", "w/v%", "percentw/v"]),
    ],
    "temperature": [
        ("°C", "linear", 1.0, 0.0, ["c", "°c", "℃", "degc", "degreec", "degreesc", "celsius", "degreescelsius", "degreecelsius"]),
        ("K", "linear", 1.0, -273.15, ["k", "kelvin", "degk"]),
        ("°F", "linear", 5 / 9, -160 / 9, ["f", "°f", "℉", "degf", "degreef", "degreesf", "fahrenheit", "degreesfahrenheit", "degreefahrenheit"]),
    ],
    "hic_rt": [
        ("min", "linear", 1.0, 0.0, ["min", "mins", "minute", "minutes"]),
        ("s", "linear", 1 / 60, 0.0, ["s", "sec", "secs", "second", "seconds"]),
        ("ms", "linear", 1 / 60000, 0.0, ["ms", "msec", "msecs", "millisecond", "milliseconds"]),
    ],
    "titer": [
        ("mg/L", "linear", 1.0, 0.0, ["mg/l", "mgl-1", "mgperl"]),
        ("µg/mL", "linear", 1.0, 0.0, ["ug/ml", "ugml-1", "ugperml", "mcg/ml", "microgram/ml", "microgramperml"]),
        ("ng/µL", "linear", 1.0, 0.0, ["ng/ul", "ngul-1", "ngperul"]),
        ("g/L", "linear", 1e3, 0.0, ["g/l", "gl-1", "gperl", "gramperlitre", "gramperliter", "gramsperlitre"]),
        ("mg/mL", "linear", 1e3, 0.0, ["mg/ml", "mgml-1", "mgperml"]),
    ],
    "kd": [
        ("nM", "linear", 1.0, 0.0, ["nm", "nanomolar", "nmol/l", "nmoll-1"]),
        ("pM", "linear", 1e-3, 0.0, ["pm", "picomolar", "pmol/l", "pmoll-1"]),
        ("µM", "linear", 1e3, 0.0, ["um", "micromolar", "umol/l", "umoll-1"]),
        ("M", "linear", 1e9, 0.0, ["m", "molar", "mol/l", "moll-1"]),
        ("pKD", "power", -1.0, 9.0, ["pkd", "-log10m", "-logm"]),
        ("log10 M", "power", 1.0, 9.0, ["log10m", "logm"]),
    ],
    "viscosity": [
        ("mPa·s", "linear", 1.0, 0.0, ["mpas"]),
        ("cP", "linear", 1.0, 0.0, ["cp", "cps", "centipoise"]),
        ("P", "linear", 1e2, 0.0, ["p", "poise"]),
        ("Pa·s", "linear", 1e3, 0.0, ["pas"]),
    ],
    "monomer": [
        ("%", "linear", 1.0, 0.0, ["%", "percent", "pct"]),
        ("‰", "linear", 0.1, 0.0, ["‰", "permille", "permil"]),
        ("fraction", "linear", 1e2, 0.0, ["fraction", "ratio0-1", "ratio", "mol/mol"]),
    ],
}
UNITS["tm1"] = UNITS["temperature"]

#: Quantities on a scale with a shifted zero enter the mixture on their absolute scale.
SHIFT = {"temperature": 273.15, "tm1": 273.15}
#: Bins per decade, and the lowest decade of a double.
BINS, LOW = 40, -324
#: Below this posterior a unit is flagged uncertain.
SURE = 0.95
#: Thousandths of a common unit from here on do not fit a bigint.
LARGEST = 9.2e18
#: Share of values that may stray in a block of one class.
STRAY = 1e-3

_NUMBER = r"([+\-−]?(?:[0-9]+(?:[.,][0-9]*)?|[.,][0-9]+)(?:[eE][+\-−]?[0-9]+)?)(?![0-9.,])"




def factor_classes(quantity: str) -> list[tuple[str, str, float, float, list[str]]]:
    """(name, kind, a, b, units) per conversion; the name is the class's first unit, which is the common unit where it is among them."""
    classes: dict[tuple, list[str]] = {}
    for unit, kind, a, b, _ in UNITS[quantity]:
        classes.setdefault((kind, a, b), []).append(unit)
    return [(units[0], *conversion, units) for conversion, units in classes.items()]


def unit_key(c):
    """Key form of a unit's spelling: lower case without white space, dots, asterisks, middle dots and brackets."""
    return F.translate(F.lower(F.trim(c)), "µμº⁻¹²³−‐–\u00a0\u202f\u3000\t· .*⋅()[]", "uu°-123---")


def number_text(cleaned):
    """The number a cleaned cell starts with; empty where it has none."""
    return F.regexp_extract(cleaned, rf"^{_NUMBER}", 1)


def number_value(text):
    """A number text as double: a comma is a decimal mark; null where it is beyond the range of a double."""
    value = F.translate(text, ",−", ".-").try_cast("double")
    return F.when(F.abs(value) < float("inf"), value)


def endpoint_unit(cleaned):
    """The unit named inside an endpoint's name: ``x (unit)``, ``x [unit]``, ``x, unit`` or ``x in unit``; empty where none is."""
    return F.regexp_extract(cleaned, r"^[^(\[,]*?(?:\s*[(\[,]\s*|\s+in\s+)(.+)$", 1)


def endpoint_quantity(low):
    """The quantity a lower-case endpoint name stands for, whatever its prefixes and suffixes; null for others."""
    return (
        F.when(low.contains("hic"), "hic_rt").when(low.contains("tm1") | low.contains("melting"), "tm1")
        .when(low.contains("titer") | low.contains("titre"), "titer").when(low.contains("visc"), "viscosity")
        .when(low.contains("monomer"), "monomer").when(low.rlike(r"(^|[^a-z])kd([^a-z]|$)"), "kd")
    )


def unit_table(spark: SparkSession) -> DataFrame:
    """Spellings with their unit and conversion; a fixed table of some 120 rows."""
    rows = [
        (q, key, unit, kind, float(a), float(b), i == 0)
        for q, units in UNITS.items()
        for i, (unit, kind, a, b, keys) in enumerate(units)
        for key in keys
    ]
    return spark.createDataFrame(rows, "uq string, ukey string, unit string, kind string, a double, b double, is_common boolean")


def to_common(x, kind, a, b):
    return F.when(kind == "power", F.pow(F.lit(10.0), a * x + b)).otherwise(a * x + b)


def long_values(df: DataFrame, id_col: str, block: str) -> DataFrame:
    """One row per quantity cell: id, block, result column, quantity, number, written unit's key (null where unwritten).

    Each text is cleaned and matched once: every step is a projection of its own,
    and the last one meets the explode, through which nothing is pushed.
    """
    cells = {"concentration": "concentration", "temperature": "temperature", "reported_value": "reported_value"}
    df = df.select(
        F.col(id_col).alias("record_id"), F.col(block).alias("block"), *(clean(F.col(c)).alias(c) for c in cells),
        unit_key(F.col("unit")).alias("_unit"), clean(F.col("assay_endpoint")).alias("_endpoint"),
    )
    df = df.select(
        "record_id", "block", *cells, "_unit", F.lower("_endpoint").alias("_low"), endpoint_unit(F.col("_endpoint")).alias("_named"),
        *(number_text(F.col(c)).alias(f"{c}_n") for c in cells),
    )
    rest = {c: F.expr(f"substring({c}, length({c}_n) + 1)") for c in cells}
    df = df.select(
        "record_id", "block", endpoint_quantity(F.col("_low")).alias("_quantity"),
        F.when(F.col("_unit").isin(PLACEHOLDERS) | F.col("_unit").isNull(), unit_key(F.col("_named"))).otherwise(F.col("_unit")).alias("_unit"),
        *(number_value(F.col(f"{c}_n")).alias(f"{c}_x") for c in cells), *(unit_key(rest[c]).alias(f"{c}_u") for c in cells),
    )
    quantity = {"concentration": F.lit("concentration"), "temperature": F.lit("temperature"), "reported_value": F.col("_quantity")}
    named = {"reported_value": F.col("_unit")}
    df = df.select(
        "record_id", "block",
        F.explode(F.array(*(
            F.struct(
                F.lit(c).alias("field"), quantity[c].alias("quantity"), F.col(f"{c}_x").alias("x"),
                F.when(F.col(f"{c}_u") != "", F.col(f"{c}_u")).otherwise(named.get(c, F.lit(None).cast("string"))).alias("ukey"),
            )
            for c in cells
        ))).alias("c"),
    ).select("record_id", "block", "c.*")
    return df.filter(F.col("x").isNotNull() & F.col("quantity").isNotNull()).withColumn(
        "ukey", F.when(F.col("ukey").isin(PLACEHOLDERS), F.lit(None)).otherwise(F.col("ukey"))
    )


def value_bin(x):
    """Bin of a value: sign and a fixed number of bins per decade, over all doubles; zero has a bin of its own."""
    level = F.floor(F.log10(F.abs(x)) * BINS).cast("int")
    return F.when(x == 0, F.lit(0)).otherwise(F.signum(x).cast("int") * (level + F.lit(1 - LOW * BINS)))


def bin_centre(bins: np.ndarray) -> np.ndarray:
    level = np.abs(bins) - 1 + LOW * BINS
    with np.errstate(all="ignore"):
        return np.where(bins == 0, 0.0, np.sign(bins) * 10.0 ** np.minimum((level + 0.5) / BINS, 308.25))


def _log_density(quantity: str, x: np.ndarray, mu: float, sigma: float) -> np.ndarray:
    """Log density of each value under each factor class of the quantity, over the log of the common value."""
    classes = factor_classes(quantity)
    out = np.full((len(x), len(classes)), -745.0)
    shift = SHIFT.get(quantity, 0.0)
    for k, (_, kind, a, b, _) in enumerate(classes):
        with np.errstate(all="ignore"):
            if kind == "power":
                t, slope = (a * x + b) * math.log(10), np.full(len(x), abs(a) * math.log(10))
            else:
                y = a * x + b + shift
                t, slope = np.log(y), abs(a) / y
            value = -0.5 * ((t - mu) / sigma) ** 2 - math.log(sigma) + np.log(slope)
        good = np.isfinite(value)
        out[good, k] = np.maximum(value[good], -745.0)
    return out


def _log_sum(values: np.ndarray) -> np.ndarray:
    top = values.max(axis=1, keepdims=True)
    return (top + np.log(np.exp(values - top).sum(axis=1, keepdims=True)))[:, 0]


def fit_units(quantity: str, bins: np.ndarray, counts: np.ndarray, mu: float, sigma: float, rounds: int = 60) -> np.ndarray:
    """Posterior of each factor class for each bin of one block.

    Centre and spread are those of the values with a written unit; the offsets of
    the components are the known conversions. Explanations: one class holds all but ``STRAY`` of the block, for each class; or
    weights fitted by EM, charged for each fitted weight.
    """
    density = _log_density(quantity, bin_centre(bins), mu, max(sigma, 1e-3))
    classes, total = density.shape[1], max(counts.sum(), 1.0)
    weight = np.full(classes, 1.0 / classes)
    for _ in range(rounds):
        post = density + np.log(weight)
        post = np.exp(post - post.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        new = (post * counts[:, None]).sum(axis=0) / total
        new = np.maximum(new, 1e-9) / np.maximum(new, 1e-9).sum()
        if np.abs(new - weight).max() < 1e-7:
            break
        weight = new
    stray = STRAY / max(classes - 1, 1)
    weights = [weight, *(np.where(np.arange(classes) == k, 1 - STRAY, stray) for k in range(classes))]
    explained, posts = [], []
    for k, w in enumerate(weights):
        joint = density + np.log(w)
        whole = _log_sum(joint)
        posts.append(np.exp(joint - whole[:, None]))
        explained.append(float((whole * counts).sum()) - (0.5 * (classes - 1) * math.log(total + 1) if k == 0 else 0.0))
    share = np.exp(np.array(explained) - max(explained))
    return sum(p * s for p, s in zip(posts, share / share.sum()))


def unit_posteriors(values: DataFrame, units: DataFrame) -> DataFrame:
    """(block, quantity, bin, unit_fit, posterior, posteriors) of the values without a written unit.

    ``values``: block, quantity, x, ukey; ``units``: the table of ``unit_table``.
    """
    shift = F.when(F.col("quantity").isin(list(SHIFT)), F.lit(273.15)).otherwise(F.lit(0.0))
    written = values.join(F.broadcast(units), (F.col("quantity") == F.col("uq")) & (F.col("ukey") == F.col("_ukey")))
    t = F.log(to_common(F.col("x"), F.col("kind"), F.col("a"), F.col("b")) + shift)
    centre = written.select("quantity", t.alias("t")).filter("t is not null and not isnan(t) and abs(t) < 700").groupBy("quantity").agg(
        F.avg("t").alias("mu"), F.coalesce(F.stddev_pop("t"), F.lit(1.0)).alias("sigma")
    )
    bins = values.filter("unwritten").groupBy("block", "quantity", value_bin(F.col("x")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # one row per quantity: at most as many as UNITS has
    grouped = bins.join(F.broadcast(centre), "quantity", "left")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        quantity = pdf["quantity"].iloc[0]
        mu, sigma = pdf["mu"].iloc[0], pdf["sigma"].iloc[0]
        names = [c[0] for c in factor_classes(quantity)]
        if mu is None or not np.isfinite(mu):
            post = np.full((len(pdf), len(names)), 1.0 / len(names))
        else:
            post = fit_units(quantity, pdf["bin"].to_numpy(), pdf["n"].to_numpy(float), float(mu), float(sigma))
        best = post.argmax(axis=1)
        return pd.DataFrame({
            "block": pdf["block"], "quantity": quantity, "bin": pdf["bin"], "unit_fit": [names[i] for i in best],
            "fit_posterior": post.max(axis=1), "posteriors": [dict(zip(names, map(float, p))) for p in post],
        })

    return grouped.groupBy("block", "quantity").applyInPandas(
        fit, "block string, quantity string, bin int, unit_fit string, fit_posterior double, posteriors map<string,double>"
    )


def harmonise(df: DataFrame, defaults: DataFrame, id_col: str = "record_id", block: str = "source_block_id") -> DataFrame:
    """Every quantity cell of ``df`` in the common unit.

    ``defaults``: source_block_id, quantity, default_unit. Result: record_id, block,
    field, quantity, x, unit, common_value, is_common, unit_source (``written``,
    ``documented``, ``fitted``), confidence, flag (null, ``uncertain``,
    ``contradicts_fit``, ``unknown_unit`` or ``out_of_range``). One row per delivered cell.
    A fitted unit is the first of its factor class.
    """
    spark = df.sparkSession
    table = unit_table(spark)
    values = long_values(df, id_col, block)
    keyed = F.broadcast(table.select("uq", F.col("ukey").alias("_ukey"), F.col("unit").alias("written_unit")))
    values = values.join(keyed, (F.col("quantity") == F.col("uq")) & (F.col("ukey") == F.col("_ukey")), "left").drop("uq", "_ukey")
    values = values.withColumn("unwritten", F.col("written_unit").isNull())
    values = Scratch(spark, "units").put(values, "values")
    spelled = table.select("uq", F.col("ukey").alias("_ukey"), "kind", "a", "b")
    fitted = unit_posteriors(values, spelled)
    documented = (
        defaults.select(F.col("source_block_id").alias("block"), "quantity", unit_key(F.col("default_unit")).alias("_ukey"))
        .join(F.broadcast(table.select(F.col("uq").alias("quantity"), F.col("ukey").alias("_ukey"), F.col("unit").alias("default_unit"))), ["quantity", "_ukey"])
        .groupBy("block", "quantity").agg(F.min("default_unit").alias("default_unit"))
    )
    classes = spark.createDataFrame(
        [(q, u, c[0]) for q in UNITS for c in factor_classes(q) for u in c[4]], "quantity string, default_unit string, default_class string"
    )
    documented = documented.join(F.broadcast(classes), ["quantity", "default_unit"])
    # per (block, quantity) one small table of bins and the prior; AQE picks the join by its measured size.
    # A documented default has all prior weight, so the posterior under the prior is its class with certainty.
    fill = fitted.join(documented, ["block", "quantity"], "left").select(
        "block", "quantity", "bin", F.coalesce("default_unit", "unit_fit").alias("filled"), F.coalesce("default_class", "unit_fit").alias("filled_class"), "unit_fit", "fit_posterior",
        F.coalesce(F.element_at("posteriors", F.coalesce("default_class", "unit_fit")), F.lit(0.0)).alias("filled_posterior"),
        F.col("default_unit").isNotNull().alias("is_documented"),
    )
    named = values.filter("not unwritten").select(
        "record_id", "block", "field", "quantity", "x", F.col("written_unit").alias("unit"), F.lit("written").alias("unit_source"),
        F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("flag"),
    )
    unnamed = (
        values.filter("unwritten").withColumn("bin", value_bin(F.col("x"))).join(fill, ["block", "quantity", "bin"], "left")
        .select(
            "record_id", "block", "field", "quantity", "x", F.col("filled").alias("unit"),
            F.when(F.col("is_documented"), "documented").otherwise("fitted").alias("unit_source"), F.col("filled_posterior").alias("confidence"),
            F.when(F.col("ukey").isNotNull(), "unknown_unit")
            .when(F.col("is_documented") & (F.col("filled_class") != F.col("unit_fit")) & (F.col("fit_posterior") >= SURE), "contradicts_fit")
            .when(F.col("filled_posterior") < SURE, "uncertain").alias("flag"),
        )
    )
    rules = table.select("uq", F.col("unit").alias("_unit"), "kind", "a", "b", "is_common").distinct()
    common = to_common(F.col("x"), F.col("kind"), F.col("a"), F.col("b"))
    return (
        named.unionByName(unnamed)
        .join(F.broadcast(rules), (F.col("quantity") == F.col("uq")) & (F.col("unit") == F.col("_unit")), "left")
        .select(
            "record_id", "block", "field", "quantity", "x", "unit", common.alias("common_value"), "is_common", "unit_source", "confidence",
            F.when(~(F.abs(common) * 1000 < LARGEST), "out_of_range").otherwise(F.col("flag")).alias("flag"),
        )
    )


def rounding_range(harmonised: DataFrame, half: float) -> DataFrame:
    """``harmonised`` with low and high: the common values of a number ``half`` smaller and larger in the unit it is written in."""
    rules = unit_table(harmonised.sparkSession).select("uq", F.col("unit").alias("_unit"), "kind", "a", "b").distinct()
    rows = harmonised.join(F.broadcast(rules), (F.col("quantity") == F.col("uq")) & (F.col("unit") == F.col("_unit")), "left")
    ends = [to_common(F.col("x") + F.lit(step), F.col("kind"), F.col("a"), F.col("b")) for step in (-half, half)]
    return rows.select(*harmonised.columns, F.least(*ends).alias("low"), F.greatest(*ends).alias("high"))


def converted(harmonised: DataFrame) -> DataFrame:
    """(record_id, quantity, common_value in thousandths): each value whose unit is not the common one, once per record.

    Deliveries of one record agree; where they do not, the smallest value is kept. A value too large for a bigint is null.
    """
    thousandths = F.round(F.col("common_value") * 1000)
    return (
        harmonised.filter("not is_common").select("record_id", F.col("field").alias("quantity"), F.when(F.abs(thousandths) < LARGEST, thousandths.cast("bigint")).alias("v"))
        .groupBy("record_id", "quantity").agg(F.min("v").alias("common_value"))
    )
