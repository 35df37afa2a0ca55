"""The four meanings of "blank" that audited tables need; choose one per operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EDGE = r"^[\s\x{00A0}]+|[\s\x{00A0}]+$"


def strip(c: Column) -> Column:
    """Outer white space of any kind removed (SQL ``trim`` removes blanks only)."""
    return F.regexp_replace(c, _EDGE, "")


def cell_blank(c: Column) -> Column:
    """Null, or text of white space only: a blank cell of a sheet."""
    return c.isNull() | (strip(c.cast("string")) == "")


def empty(c: Column) -> Column:
    """Null or the empty text; white space is a value."""
    return c.isNull() | (c.cast("string") == "")


def falsy(c: Column, zero_is_missing: bool = False) -> Column:
    """Null or empty after stripping; with ``zero_is_missing`` also 0 and false, as where truth values are tested."""
    text = strip(c.cast("string"))
    out = c.isNull() | (text == "")
    return out | text.isin("0", "0.0", "false") if zero_is_missing else out


def placeholder(c: Column) -> Column:
    """Null or a text that stands for a missing measurement."""
    return c.isNull() | F.lower(strip(c.cast("string"))).isin("", "na", "n/a", "nan", "null", "none", "nd", "--")


def first_nonblank(*columns: Column) -> Column:
    """The first value that is not blank."""
    return F.coalesce(*(F.when(~cell_blank(c), c) for c in columns))


def condition_key(fields: dict[str, Column], missing: str = "UNSPECIFIED_CONDITION") -> Column:
    """``name=value`` of every non-blank field, joined by ``|``; ``missing`` where there is none."""
    parts = [F.when(~cell_blank(c), F.concat(F.lit(f"{name}="), strip(c.cast("string")))) for name, c in fields.items()]
    joined = F.concat_ws("|", *parts)
    return F.when(joined == "", F.lit(missing)).otherwise(joined)


def inferred_type(c: Column, text_booleans: bool = True) -> Column:
    """``empty``, ``boolean``, ``integer``, ``number`` or ``string`` of a text value."""
    text = strip(c.cast("string"))
    out = F.when(c.isNull() | (text == ""), "empty")
    if text_booleans:
        out = out.when(F.lower(text).isin("true", "false"), "boolean")
    whole = text.rlike(r"^[+-]?[0-9]+(_[0-9]+)*$")
    number = text.rlike(r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$") | F.lower(text).rlike(r"^[+-]?(nan|inf|infinity)$")
    return out.when(whole, "integer").when(number, "number").otherwise("string")


def tolerant_float(c: Column) -> Column:
    """A finite double, or null."""
    x = strip(c.cast("string")).try_cast("double")
    return F.when(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), x)


def tolerant_int(c: Column) -> Column:
    """A whole number written with or without thousands separators; null otherwise."""
    return F.regexp_replace(strip(c.cast("string")), ",", "").try_cast("bigint")


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(strip(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def is_close(a: Column, b: Column, relative: float, absolute: float) -> Column:
    """Within the larger of a relative and an absolute tolerance."""
    return F.abs(a - b) <= F.greatest(F.lit(relative) * F.greatest(F.abs(a), F.abs(b)), F.lit(absolute))
