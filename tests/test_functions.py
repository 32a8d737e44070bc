"""Table-driven checks of the column functions (F1-F38) on hand-written values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind.functions.codes import FLAG_LOWER_YN_TF, FLAG_UPPER_YN_TF, LIVING_TYPE

NBSP = " "


def one(spark, col_expr, values, dtype="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {dtype}")
    return [r[0] for r in df.orderBy("i").select(col_expr(F.col("v"))).collect()]


def test_strip_and_clean(spark):
    vals = [None, "", " x ", f"x{NBSP}", "nan", "NaN", " nan", "a b"]
    assert one(spark, fn.strip, vals) == [None, "", "x", "x", "nan", "NaN", "nan", "a b"]
    # 'nan' is tested before stripping (as the studied code does): ' nan' stays 'nan'
    assert one(spark, fn.clean_str, vals) == ["", "", "x", "x", "", "", "nan", "a b"]
    assert one(spark, fn.blank_to_null, vals)[:3] == [None, None, " x "]


def test_to_long_and_double(spark):
    vals = [None, "", "abc", "1.0", "1.5", " 42 ", "nan", "-7", "12345678901234567", "1e3"]
    assert one(spark, fn.to_long, vals) == [None, None, None, 1, None, 42, None, -7, 12345678901234567, 1000]
    assert one(spark, fn.to_long_or_zero, vals)[:3] == [0, 0, 0]
    assert one(spark, lambda c: fn.to_double(c, 0.0), vals)[:7] == [0.0, 0.0, 0.0, 1.0, 1.5, 42.0, 0.0]


def test_norm_bool(spark):
    vals = ["yes", "No", " t ", "F", "active", "INACTIVE", "maybe", None, "1", "0"]
    assert one(spark, fn.norm_bool, vals) == [True, False, True, False, True, False, None, None, True, False]


def test_flags_and_maps(spark):
    vals = ["Y", "n", "TRUE", "false", None, "X"]
    assert one(spark, lambda c: fn.flag_map(c, FLAG_UPPER_YN_TF, case="upper"), vals) == ["1", "0", "1", "0", None, "X"]
    assert one(spark, lambda c: fn.flag_map(c, FLAG_LOWER_YN_TF, case="lower"), vals) == ["1", "0", "1", "0", None, "x"]
    assert one(spark, fn.disabled_flag, ["N", "false", "0", None, "true"]) == ["0", "0", "0", "1", "1"]
    assert one(spark, fn.tri_flag, ["TRUE", "0", None, "x"]) == ["1", "0", None, None]
    assert one(spark, fn.is_deleted_flag, ["True", "0", None, "nan", "x"]) == ["1", "0", "0", "0", "x"]
    assert one(spark, fn.gender_label, ["male", "Famale", "company", None]) == ["ชาย", "หญิง", "PreferNotToRespond", "ไม่ระบุเพศ"]
    assert one(spark, lambda c: fn.map_values(c, LIVING_TYPE), ["1", "4", None]) == ["อยู่เอง", "4", None]
    assert one(spark, fn.corporate_type, ["Acme PCL", "บริษัท (มหาชน)", None, "Acme"]) == ["PCL", "PCL", "LOCAL", "LOCAL"]


def test_dates(spark):
    vals = ["2024-01-15 10:00:00", "2024-1-5", "2024-01-15", "junk", None, "2567-03-01 00:00:00", "2024-01-15T08:00:00"]
    assert one(spark, fn.date_id_from_text, vals) == [
        dt.date(2024, 1, 15), None, dt.date(2024, 1, 15), None, None, None, dt.date(2024, 1, 15)]
    assert one(spark, fn.to_ts, vals)[:3] == [dt.datetime(2024, 1, 15, 10), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 15)]
    # beyond the pandas timestamp range -> null
    assert one(spark, fn.to_ts, ["2567-03-01 00:00:00", "1600-01-01"]) == [None, None]
    assert one(spark, lambda c: fn.be_to_ce(c, 2400), ["2567-03-01", "2400-01-01", "2401-01-01", "ab12", None]) == [
        "2024-03-01", "2400-01-01", "1858-01-01", "ab12", None]
    assert one(spark, lambda c: fn.be_to_ce(c, 2500, 2600, 10), ["2567-03-01", "2600-01-01", "2567"]) == [
        "2024-03-01", "2600-01-01", "2567"]
    assert one(spark, fn.epoch_to_ts, ["0", "1700000000.5", "junk"]) == [
        dt.datetime(1970, 1, 1), dt.datetime(2023, 11, 14, 22, 13, 20, 500000), None]


def test_epochs_beyond_the_timestamps_are_null(spark):
    """Seconds that fit a timestamp of Spark but neither the range here nor the interval's decimal."""
    far = ["9223372036.5", "9223372037", "-9223372036.25", "-9223372037", "1e10", "1e12", "1071983203200", "9.9e12", "-9.9e12", "1e300", "nan", "inf", None]
    assert one(spark, fn.epoch_to_ts, far) == [dt.datetime(2262, 4, 11, 23, 47, 16, 500000), None, dt.datetime(1677, 9, 21, 0, 12, 43, 750000)] + [None] * 10


def test_text(spark):
    assert one(spark, lambda c: fn.zfill(c, 2), ["5", "123", None]) == ["05", "123", None]
    assert one(spark, fn.phone_pad9, ["812345678", "0812345678", None]) == ["0812345678", "0812345678", None]
    assert one(spark, fn.phone_prefix0, ["8", None]) == ["08", None]
    assert one(spark, fn.first_token, ["a b c", "abc", ""]) == ["a", "abc", ""]
    assert one(spark, lambda c: fn.full_name(c, F.lit("Z")), ["A", None]) == ["A Z", None]
