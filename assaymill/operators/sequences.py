"""Sequence classes, fingerprints and quality control."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.blanks import cell_blank
from ..functions.text import nfkc

PROTEIN = "ABCDEFGHIKLMNPQRSTUVWXYZ"
DNA = "ACGTUNRYSWKMBDHV"


def release_sequence(c: Column) -> Column:
    """Compatibility form (NFKC), upper case, without any white space; stop and gap marks stay. ASCII texts need no Unicode step."""
    return F.regexp_replace(F.upper(F.when(c.rlike(r"[^\x00-\x7F]"), nfkc(c)).otherwise(c)), r"(?U)\s+", "")


def audit_sequence(c: Column) -> Column:
    """Upper case without white space and stop marks."""
    return F.regexp_replace(F.upper(c), r"(?U)[\s*]+", "")


def metric_sequence(c: Column) -> Column:
    """Upper case without byte-order mark, blanks and gap marks."""
    return F.regexp_replace(F.upper(F.trim(c)), "[\\x{FEFF} \\-]+", "")


def looks_like_sequence(c: Column, least: int = 6) -> Column:
    text = metric_sequence(c)
    return F.coalesce((F.length(text) >= least) & text.rlike(f"^[{PROTEIN}*]+$"), F.lit(False))


def sha(c: Column) -> Column:
    return F.sha2(c, 256)


def pair_sha(vh: Column, vl: Column) -> Column:
    """Hash of a pair of release sequences; null where one is missing."""
    a, b = release_sequence(vh), release_sequence(vl)
    return F.when(~cell_blank(vh) & ~cell_blank(vl), F.sha2(F.concat(a, F.lit("\x1f"), b), 256))


def audit_pair_sha(vh: Column, vl: Column) -> Column:
    plain = F.regexp_replace(F.concat(audit_sequence(vh), F.lit("|"), audit_sequence(vl)), r"[^\x00-\x7F]", "")
    return F.sha2(plain, 256)


def present(c: Column) -> Column:
    return ~cell_blank(c)


def sequence_class(vh: Column, vl: Column, heavy_full: Column, light_full: Column, heavy_cdr: Column, light_cdr: Column) -> Column:
    """Which chains a record holds; the arguments after the first two are truth values."""
    h, l = present(vh), present(vl)
    full, cdr = heavy_full | light_full, heavy_cdr | light_cdr
    return (
        F.when(h & l, "paired_vh_vl").when(h & (light_full | light_cdr), "mixed_or_other").when(h, "heavy_only")
        .when(l & (heavy_full | heavy_cdr), "mixed_or_other").when(l, "light_only").when(full & ~cdr, "full_length_only")
        .when(cdr & ~full, "cdr_only").when(~full & ~cdr, "no_sequence").otherwise("mixed_or_other")
    )


def illegal_characters(c: Column, alphabet: str = PROTEIN) -> Column:
    """Sorted distinct characters outside the alphabet and the stop mark, as one text."""
    rest = F.regexp_replace(release_sequence(c), f"[{alphabet}*]+", "")
    return F.when(rest == "", F.lit("")).otherwise(F.array_join(F.array_sort(F.array_distinct(F.split(rest, "(?!^)"))), ""))


def fingerprints(df: DataFrame, record: str, vh: str, vl: str) -> DataFrame:
    """(record, vh_sha, vl_sha, pair_sha, basis); records without any chain are dropped."""
    h, l = F.col(vh), F.col(vl)
    return df.filter(present(h) | present(l)).select(
        F.col(record).alias("record"), F.when(present(h), sha(release_sequence(h))).alias("vh_sha"), F.when(present(l), sha(release_sequence(l))).alias("vl_sha"),
        pair_sha(h, l).alias("pair_sha"),
        F.when(present(h) & present(l), "paired_vh_vl").when(present(h), "heavy_only").otherwise("light_only").alias("basis"),
    )


def quality(df: DataFrame, record: str, vh: str, vl: str) -> DataFrame:
    """One row per record: lengths, illegal characters, stop marks, white space, size of its duplicate pair group."""
    h, l = F.col(vh), F.col(vl)
    rows = df.select(
        F.col(record).alias("record"), F.coalesce(F.length(release_sequence(h)), F.lit(0)).alias("vh_length"),
        F.coalesce(F.length(release_sequence(l)), F.lit(0)).alias("vl_length"),
        illegal_characters(F.concat_ws("", h, l)).alias("illegal"), F.coalesce(F.concat_ws("", h, l).contains("*"), F.lit(False)).alias("has_stop"),
        F.coalesce(F.concat_ws("", h, l).rlike(r"(?U)\s"), F.lit(False)).alias("has_space"), pair_sha(h, l).alias("pair"),
    )
    groups = rows.filter("pair is not null").groupBy("pair").agg(F.count(F.lit(1)).alias("pair_group_size"))
    return rows.join(groups, "pair", "left").select(
        "record", "vh_length", "vl_length", "illegal", "has_stop", "has_space", F.coalesce("pair_group_size", F.lit(0)).alias("pair_group_size")
    )


def table_profile(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """Per field: filled values, distinct sequences, shortest, median and longest, values with illegal characters."""
    cells = F.array(*(F.struct(F.lit(role).alias("role"), F.col(c).alias("value")) for role, c in fields.items()))
    long = df.select(F.explode(cells).alias("c")).select("c.*").filter(present(F.col("value")))
    counted = long.select("role", audit_sequence(F.col("value")).alias("s")).groupBy("role", "s").agg(F.count(F.lit(1)).alias("n"))
    return counted.groupBy("role").agg(
        F.sum("n").alias("n_values"), F.count(F.lit(1)).alias("n_distinct"), F.min(F.length("s")).alias("shortest"), F.max(F.length("s")).alias("longest"),
        F.expr("percentile(length(s), 0.5, n)").alias("median_length"),
        F.coalesce(F.sum(F.when(illegal_characters(F.col("s")) != "", F.col("n"))), F.lit(0)).alias("n_illegal"),
    )


def all_fingerprints(df: DataFrame, record: str, vh: Column, vl: Column, heavy: Column, light: Column) -> DataFrame:
    """(record, vh_sha, vl_sha, pair_sha, heavy_only_sha, light_only_sha, full_sha, basis) of records with any chain.

    A chain alone has a hash of its own kind; full chains (heavy and light, one may be missing) are hashed together, each part marked as protein or
    nucleotide, as the same letters mean different things.
    """

    def part(c: Column) -> Column:
        text = release_sequence(c)
        kind = F.when(text.rlike("^[ACGTUN]+$"), "dna").otherwise("protein")
        return F.when(present(c), F.concat_ws(":", kind, text)).otherwise(F.lit(""))

    h, l, full = present(vh), present(vl), present(heavy) | present(light)
    rows = df.filter(h | l | full)
    return rows.select(
        F.col(record).alias("record"), F.when(h, sha(release_sequence(vh))).alias("vh_sha"), F.when(l, sha(release_sequence(vl))).alias("vl_sha"), pair_sha(vh, vl).alias("pair_sha"),
        F.when(h & ~l, sha(F.concat(F.lit("heavy\x1f"), release_sequence(vh)))).alias("heavy_only_sha"), F.when(l & ~h, sha(F.concat(F.lit("light\x1f"), release_sequence(vl)))).alias("light_only_sha"),
        F.when(full, sha(F.concat_ws("\x1f", part(heavy), part(light)))).alias("full_sha"),
        F.when(h & l, "paired_vh_vl").when(h, "heavy_only").when(l, "light_only").otherwise("full_chain").alias("basis"),
    )


#: Kinds of fallback fingerprints in order.
FALLBACKS = ["heavy_light", "heavy_only", "sequence", "cdr"]


def fallback_fingerprint(heavy: Column, light: Column, sequence: Column, cdrs: list[Column]) -> Column:
    """struct(kind, parts): the best identity a record has: both chains, else the heavy chain, else a sequence, else its CDRs; null for none."""
    def plain(c: Column) -> Column:
        return F.when(present(c), F.nullif(metric_sequence(c), F.lit("")))

    h, l, s = plain(heavy), plain(light), plain(sequence)
    loops = F.array_compact(F.array(*(plain(c) for c in cdrs))) if cdrs else F.array().cast("array<string>")

    def found(kind: str, parts: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), parts.alias("parts"))

    return (
        F.when(h.isNotNull() & l.isNotNull(), found("heavy_light", F.array(h, l))).when(h.isNotNull(), found("heavy_only", F.array(h)))
        .when(s.isNotNull(), found("sequence", F.array(s))).when(F.size(loops) > 0, found("cdr", loops))
    )


# How a script's text tells which identity its "unique" sequences have, the first that fits.
UNIQUE_BY = [
    ("vh_vl_pair", r"(?s)(drop_duplicates|distinct|unique|nunique|group_?by)[^\n]{0,80}(vh[^\n]{0,20}vl|heavy[^\n]{0,20}light)"),
    ("single_chain", r"(?s)(drop_duplicates|distinct|unique|nunique|group_?by)[^\n]{0,80}(vh|vl|heavy|light|sequence)"),
    ("identifier", r"(?s)(drop_duplicates|distinct|unique|nunique|group_?by)[^\n]{0,80}(antibody_id|dotad_id|\bid\b)"),
]


def unique_definition(text: Column) -> Column:
    """What a script counts as a unique sequence; ``not_stated`` where it does not say."""
    return F.coalesce(*(F.when(F.lower(text).rlike(pattern), F.lit(name)) for name, pattern in UNIQUE_BY), F.lit("not_stated"))


def pair_profile(df: DataFrame, vh: str, vl: str) -> DataFrame:
    """One row: records with both, one or no chain, distinct pairs, pairs that occur several times and the records they hold."""
    h, l = present(F.col(vh)), present(F.col(vl))
    rows = df.select(F.when(h & l, "pair").when(h, "heavy").when(l, "light").otherwise("none").alias("has"), F.when(h & l, audit_pair_sha(F.col(vh), F.col(vl))).alias("pair"))
    counted = rows.groupBy("has", "pair").agg(F.count(F.lit(1)).alias("n"))

    def of(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("has") == kind, F.col("n"))), F.lit(0))

    repeated = (F.col("has") == "pair") & (F.col("n") > 1)
    return counted.agg(
        of("pair").alias("n_paired"), of("heavy").alias("n_heavy_only"), of("light").alias("n_light_only"), of("none").alias("n_without"), F.count("pair").alias("n_distinct_pairs"),
        F.count(F.when(repeated, 1)).alias("n_repeated_pairs"), F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("n_in_repeated_pairs"),
    )
