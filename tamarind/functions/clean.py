"""Cleaning and casting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace()), i.e. the
# Unicode White_Space set plus the separators U+001C-U+001F.  Spark's trim() removes
# only ' ', so strip() trims this explicit set with btrim (no regular expression).
PY_WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
                 + "".join(chr(c) for c in range(0x2000, 0x200B))
                 + "\u2028\u2029\u202f\u205f\u3000")

_LONG_LIMIT = 9.2e18


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """trim Unicode white space on both ends; null stays null."""
    return F.btrim(_c(c).cast("string"), F.lit(PY_WHITESPACE))


def coalesce_first(*cols) -> Column:
    """first non-null (``a.combine_first(b)``)."""
    return F.coalesce(*[_c(c) for c in cols])


def blank_to_null(c) -> Column:
    """F2/P10: exactly ``""`` becomes null."""
    return F.nullif(_c(c), F.lit(""))


def clean_str(c) -> Column:
    """null or the text 'nan' (any case, unstripped) -> '', else stripped text."""
    s = _c(c).cast("string")
    return F.when(s.isNull() | (F.lower(s) == "nan"), F.lit("")).otherwise(strip(s))


def to_text(c) -> Column:
    """value as text; null stays null (not the text 'None')."""
    return _c(c).cast("string")


# How a missing value reads once turned into text.
MISSING_TOKENS = ["None", "nan", "<NA>"]


def clean_token(c, tokens=MISSING_TOKENS) -> Column:
    """text, with null and the exact texts ``tokens`` -> ''."""
    s = _c(c).cast("string")
    return F.when(s.isNull() | s.isin(list(tokens)), F.lit("")).otherwise(s)


# Integer text (after trimming): a cheap pattern test first, so that malformed text
# never reaches the string -> bigint cast (its failure path is slow).
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"


def int_or_null(s: Column, typ: str = "bigint") -> Column:
    """Text -> integer when it is integer text, else null (no slow failing cast)."""
    return F.when(s.rlike(INT_TEXT), s.try_cast(typ))


# Number text as pandas' to_numeric reads it (decimal, exponent, inf, nan).  Text that
# does not match is null without trying the cast, whose failure path is slow.
NUM_TEXT = r"(?i)^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?|inf|infinity|nan)\s*$"


def double_or_null(s: Column) -> Column:
    return F.when(s.rlike(NUM_TEXT), s.try_cast("double"))


def to_long(c) -> Column:
    """coercing number -> bigint.  Bad text, fractions and out-of-range values
    give null; integers beyond 2^53 are taken exactly."""
    s = _c(c).cast("string")
    d = double_or_null(s)
    exact = int_or_null(s)
    via_double = F.when(
        d.isNotNull() & (F.abs(d) < F.lit(_LONG_LIMIT)) & (d == F.floor(d)), d.cast("bigint"))
    return F.coalesce(exact, via_double)


def to_long_or_zero(c) -> Column:
    """``to_long`` with 0 for null/bad."""
    return F.coalesce(to_long(c), F.lit(0).cast("bigint"))


def to_double(c, default: float | None = None) -> Column:
    """F8: coercing number -> double; ``default`` replaces null/bad when given."""
    raw = double_or_null(_c(c).cast("string"))
    d = F.when(~F.isnan(raw), raw)  # 'nan' text reads as missing, as in pandas
    return d if default is None else F.coalesce(d, F.lit(float(default)))


# The accepted spellings of a boolean, compared after strip + lower.
TRUE_WORDS = ["true", "1", "t", "y", "yes", "active"]
FALSE_WORDS = ["false", "0", "f", "n", "no", "inactive"]


def norm_bool(c) -> Column:
    """boolean from loose text; anything else (and null) -> null."""
    s = F.lower(strip(_c(c).cast("string")))
    return (F.when(s.isin(TRUE_WORDS), F.lit(True))
            .when(s.isin(FALSE_WORDS), F.lit(False))
            .otherwise(F.lit(None).cast("boolean")))
