"""Text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zfill(c, width: int) -> Column:
    """left-pad with '0' to ``width``; longer text is kept whole (lpad would cut it)."""
    s = _c(c).cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def full_name(first, last) -> Column:
    """first + ' ' + last; null when either is null."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def join_words(*parts) -> Column:
    """parts joined by ' ', null when any part is null."""
    out = []
    for i, p in enumerate(parts):
        if i:
            out.append(F.lit(" "))
        out.append(_c(p))
    return F.concat(*out)


def first_token(c) -> Column:
    """text before the first ' '."""
    return F.split_part(_c(c).cast("string"), F.lit(" "), F.lit(1))


def phone_pad9(c) -> Column:
    """a 9-character phone gets a leading '0'; other lengths unchanged."""
    s = _c(c)
    return F.when(F.length(s) == 9, F.concat(F.lit("0"), s)).otherwise(s)


def phone_prefix0(c) -> Column:
    """always prefix '0'; null stays null."""
    return F.concat(F.lit("0"), _c(c).cast("string"))
