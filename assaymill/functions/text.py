"""Column expressions for written forms: width, white space, ids, placeholders.

All of them stay inside the JVM. Spark has no Unicode normalisation function, so
width folding is a ``translate`` whose tables follow from the block layout of
the full-width forms.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Full-width forms U+FF01..U+FF5E sit at a constant distance from ASCII.
_WIDE = "".join(chr(0xFF01 + i) for i in range(94)) + "　"
_NARROW = "".join(chr(0x21 + i) for i in range(94)) + " "

#: Any white space, format or control character, in Java's regular expressions.
ANY_SPACE = r"[\s\p{Z}\p{Cc}\p{Cf}]+"

#: Texts that stand for "no value" (fixed values).
PLACEHOLDERS = ["", "na", "n/a", "nan", "null", "none", "nd", "n.d.", "--", "-", "?", "??", "unknown", "tbd", "tbc"]


def fold_width(c: Column) -> Column:
    return F.translate(c, _WIDE, _NARROW)


def squeeze(c: Column) -> Column:
    """Width folded and every kind of white space removed (plain ASCII words take a short way)."""
    return F.when(c.rlike("[^!-~]"), F.regexp_replace(fold_width(c), ANY_SPACE, "")).otherwise(c)


def clean(c: Column) -> Column:
    """Width folded, outer white space of every kind removed, inner runs one blank (clean ASCII takes a short way)."""
    return F.when(c.rlike("[^ -~]|^ | $|  "), F.trim(F.regexp_replace(fold_width(c), ANY_SPACE, " "))).otherwise(c)


def is_placeholder(c: Column) -> Column:
    return c.isNull() | F.lower(clean(c)).isin(PLACEHOLDERS)


def value_or_null(c: Column) -> Column:
    """``clean(c)``, or null where the text is a placeholder."""
    return F.when(is_placeholder(c), F.lit(None).cast("string")).otherwise(clean(c))


def coded_id(c: Column, prefix: str, digits: int = 8) -> Column:
    """Written form ``PREFIX-00000000`` of an id spelled in any case, width, spacing, separator or zero padding.

    A text of another shape comes back squeezed and upper-cased, so that it stays
    an id of its own; placeholders come back null.
    """
    squeezed = F.upper(squeeze(c))
    number = F.regexp_extract(squeezed, rf"^{prefix}[\p{{Pd}}\p{{Pc}}−./:]*0*([0-9]+)$", 1)
    return (
        F.when(F.lower(squeezed).isin(PLACEHOLDERS), F.lit(None).cast("string"))
        .when(number == "", squeezed)
        .otherwise(F.concat(F.lit(f"{prefix}-"), F.lpad(number, F.greatest(F.length(number), F.lit(digits)), F.lit("0"))))
    )


def antibody_id(c: Column) -> Column:
    return coded_id(c, "DOTAD")


def sequence_group_id(c: Column) -> Column:
    return coded_id(c, "SG")


def record_key(c: Column) -> Column:
    """Key of a record id: the same whatever its case, width and white space; null where blank."""
    return F.nullif(F.lower(squeeze(c)), F.lit(""))


def table_key(c: Column) -> Column:
    """Name of a table without folders, ending, case, width and separator spelling."""
    plain = F.lower(clean(c))
    plain = F.regexp_replace(plain, r"^.*[/\\]", "")
    plain = F.regexp_replace(plain, r"\.(tsv|csv|parquet|txt|xlsx|json)(\.gz)?$", "")
    return F.regexp_replace(F.trim(plain), r"[\s\p{Pd}_.]+", "_")


def split_name(c: Column) -> Column:
    """``train``, ``valid`` or ``test`` for its various names; null for none; other names in lower case."""
    low = F.lower(clean(c))
    return (
        F.when(is_placeholder(c), F.lit(None).cast("string")).when(low.isin("train", "training", "trn"), "train")
        .when(low.isin("valid", "val", "dev", "validation", "development"), "valid").when(low.isin("test", "testing", "tst"), "test").otherwise(low)
    )


def residues(c: Column) -> Column:
    """Residues of a chain: upper case without white space, gap marks and closing ``*``; null where none is left."""
    letters = F.regexp_replace(F.upper(squeeze(c)), r"[\p{Pd}._~−]+", "")
    untidy = F.nullif(F.regexp_replace(letters, r"\*+$", ""), F.lit(""))
    return F.when(c.rlike("[^A-Z]"), untidy).when(c == "", F.lit(None).cast("string")).otherwise(c)


def _arrow(function, returns="string"):
    @F.pandas_udf(returns)
    def apply(texts: pd.Series) -> pd.Series:
        return texts.map(function, na_action="ignore")

    return apply


def nfkc(c: Column) -> Column:
    """Unicode NFKC (no built-in in Spark), in Arrow batches."""
    return _arrow(lambda t: unicodedata.normalize("NFKC", t))(c)


def casefold_name(c: Column) -> Column:
    """NFKC, trimmed, case-folded, inner white space collapsed; null for null."""
    return _arrow(lambda t: " ".join(unicodedata.normalize("NFKC", t).split()).casefold())(c)


def identifier_token(c: Column) -> Column:
    """NFKC, lower case, runs outside ``0-9a-z`` as one underscore; ``unnamed`` where nothing is left."""
    token = F.regexp_replace(F.regexp_replace(F.lower(nfkc(c)), "[^0-9a-z]+", "_"), "^_+|_+$", "")
    return F.when(token == "", F.lit("unnamed")).otherwise(token)


def compact_header(c: Column) -> Column:
    """Lower case, only ``0-9a-z``."""
    return F.regexp_replace(F.lower(c), "[^0-9a-z]", "")


def python_number_text(c: Column) -> Column:
    """Fifteen significant digits, trailing zeros dropped; empty for non-finite values, null for null."""

    @F.pandas_udf("string")
    def apply(numbers: pd.Series) -> pd.Series:
        return pd.Series([f"{x:.15g}" if abs(x) < float("inf") else "" for x in numbers], dtype=object)

    return F.when(c.isNull(), F.lit(None).cast("string")).otherwise(apply(c))
