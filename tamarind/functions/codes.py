"""Flags and code -> label maps.

Maps are CASE chains over literals: they stay in codegen and need no join.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tamarind.functions.clean import _c, strip

# ---------------------------------------------------------------------------
# Fixed values (must equal the studied system's, for identical labels)
# ---------------------------------------------------------------------------
# Active flags, case-sensitive: N/false -> 0, Y/true -> 1.
FLAG_YN_TF = {"N": "0", "false": "0", "Y": "1", "true": "1"}
# Active flags, Y/N only.
FLAG_YN = {"N": "0", "Y": "1"}
# Active flags after upper-casing.
FLAG_UPPER_YN_TF = {"N": "0", "FALSE": "0", "Y": "1", "TRUE": "1"}
# Active flags after lower-casing.
FLAG_LOWER_YN_TF = {"n": "0", "false": "0", "y": "1", "true": "1"}
# is_deleted after lower-casing ("nan" is how a missing value reads as text).
IS_DELETED = {"true": "1", "false": "0", "1": "1", "0": "0", "nan": "0"}
# Disabled device: these values mean "disabled" (0); everything else is 1.
DISABLED_VALUES = ["N", "false", "0"]
# Gender spellings (upper-cased) -> label; anything else -> "not stated".
GENDER = {
    "WOMAN": "หญิง", "FEMALE": "หญิง", "FAMALE": "หญิง",
    "MEN": "ชาย", "MALE": "ชาย", "MAN": "ชาย",
    "FEMALE/MAN": "PreferNotToRespond", "MAN/FEMALE": "PreferNotToRespond", "COMPANY": "PreferNotToRespond",
}
GENDER_UNKNOWN = "ไม่ระบุเพศ"
# Project type code -> label ("domitory" as spelt in the source).
PROJECT_TYPE = {
    "1": "condominium", "2": "housing community", "3": "apartment",
    "4": "housing community", "5": "housing community", "6": "domitory",
    "7": "housing community", "8": "resort", "9": "company", "999": "other",
}
# Unit living type code -> label.
LIVING_TYPE = {"1": "อยู่เอง", "2": "ปล่อยเช่า", "3": "เช่าพื้นที่ส่วนกลาง"}
# Bank book type and use type -> label.
BOOKBANK_TYPE = {"S": "สะสมทรัพย์", "C": "กระแสรายวัน", "F": "ฝากประจำ"}
BOOKBANK_USETYPE = {"P": "จ่ายชำระ", "R": "รับชำระ", "B": "รับและจ่ายชำระ"}
# Public-company markers in a company name (regular expression).
PCL_PATTERN = "มหาชน|PCL"
PCL_PATTERN_TH_ONLY = "มหาชน"
# ---------------------------------------------------------------------------


def map_values(c, mapping: dict, default=None, passthrough: bool = True) -> Column:
    """Exact-match code -> label.  Unknown codes pass through unless ``passthrough``
    is False, in which case they become ``default``."""
    col = _c(c).cast("string")
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    fallback = col if passthrough else F.lit(default).cast("string")
    return fallback if expr is None else expr.otherwise(fallback)


def flag_map(c, mapping: dict, case: str | None = None, do_strip: bool = False) -> Column:
    """F10a-d: upper/lower/strip first (as asked), then map; unmatched values stay
    (upper-/lower-cased)."""
    col = _c(c).cast("string")
    if do_strip:
        col = strip(col)
    if case == "upper":
        col = F.upper(col)
    elif case == "lower":
        col = F.lower(col)
    return map_values(col, mapping)


def disabled_flag(c) -> Column:
    """F10e: N/false/0 -> '0'; everything else, null included, -> '1'."""
    col = _c(c).cast("string")
    return F.when(col.isin(DISABLED_VALUES), F.lit("0")).otherwise(F.lit("1"))


def tri_flag(c) -> Column:
    """F10f: true/1 -> '1', false/0 -> '0' (after lower-casing), else null."""
    col = F.lower(_c(c).cast("string"))
    return (F.when(col.isin("true", "1"), F.lit("1"))
            .when(col.isin("false", "0"), F.lit("0"))
            .otherwise(F.lit(None).cast("string")))


def is_deleted_flag(c) -> Column:
    """F10g: lower-case then map; a missing value counts as not deleted ('0')."""
    col = F.lower(_c(c).cast("string"))
    return F.when(col.isNull(), F.lit("0")).otherwise(map_values(col, IS_DELETED))


def gender_label(c) -> Column:
    """upper-case, map the nine spellings, everything else -> not stated."""
    return map_values(F.upper(_c(c).cast("string")), GENDER, default=GENDER_UNKNOWN, passthrough=False)


def corporate_type(c, pattern: str = PCL_PATTERN) -> Column:
    """'PCL' when the name matches ``pattern``, else 'LOCAL' (null -> LOCAL)."""
    return F.when(F.coalesce(_c(c).cast("string").rlike(pattern), F.lit(False)), F.lit("PCL")).otherwise(F.lit("LOCAL"))


def user_type(unit_id) -> Column:
    """F16: no unit (null -> '0') -> 'GU', else 'RU'."""
    return F.when(F.coalesce(_c(unit_id).cast("string"), F.lit("0")) == "0", F.lit("GU")).otherwise(F.lit("RU"))
