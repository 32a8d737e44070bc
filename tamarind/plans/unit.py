"""Unit tables: dim_unit (T32) and fact_unit."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind.functions.codes import FLAG_LOWER_YN_TF, FLAG_UPPER_YN_TF, LIVING_TYPE
from tamarind.operators import lookup_join, unpivot, with_audit
from tamarind.plans.common import AUDIT, finish, schema
from tamarind.spec import LATEST, Source, TableSpec

DIM_UNIT = schema(f"""{AUDIT}, addr_id:long, unit_number:str, room_number:str, own_area_ratio:dbl,
    living_type:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str,
    unit_id:str, project_id:str, date_id:date""")

FACT_UNIT = schema(f"""{AUDIT}, transfer_date:ts, move_in_date:ts, move_out_date:ts, resident_type:str,
    rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str, unit_id:str,
    project_id:str, party_id:str, date_id:date""")

OWNER_COLS = ["fcownerid", "fcownerid2", "fcownerid3", "fccurrentownerid"]


def build_dim_unit(src: dict, ctx):
    """Unit ⟕ newest branch -> project; text cleaning, ratio, labels, flags."""
    room = src["tmRoomH"].select(
        F.col("fcbrnid").alias("branch_key"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
        F.col("fcid").alias("unit_id"),
        fn.clean_str("fccode").alias("unit_number"),
        fn.clean_str("fcaddressno").alias("room_number"),
        fn.to_double("fcownerratio", 0.0).alias("own_area_ratio"),
        fn.map_values("fcleveingtype", LIVING_TYPE).alias("living_type"),
        F.lit(None).cast("bigint").alias("addr_id"),
        fn.flag_map("fcisactive", FLAG_UPPER_YN_TF, case="upper").alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"),
        F.col("fccreateby").alias("crtd_by"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"),
        fn.coalesce_first("fcupdateby", "fccreateby").alias("updt_by"),
    )
    branch = src["tmBRN"].select(F.col("fcid").alias("branch_of"), F.col("fccomid").alias("project_id"))
    df = lookup_join(room, branch, "branch_key", "branch_of", "left", small=True)
    return finish(with_audit(df, ctx.run_ts), DIM_UNIT)


def build_fact_unit(src: dict, ctx):
    """One row per (unit, owner column) with a non-blank owner ⟕ newest branch. A room is
    cleaned once, before its owners become rows."""
    room = src["tmRoomH"]
    present = [c for c in OWNER_COLS if c in room.columns]  # P9
    updt_by = fn.clean_str("fcupdateby")
    cleaned = room.select(
        *present, F.col("fcbrnid").alias("branch_key"),
        fn.date_id_from_ts(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
        fn.to_ts(fn.be_to_ce("fttransferdate", 2500)).alias("transfer_date"),
        fn.to_ts(fn.be_to_ce("ftdatein", 2500)).alias("move_in_date"),
        fn.to_ts(fn.be_to_ce("ftdateout", 2500)).alias("move_out_date"),
        fn.clean_str(fn.map_values(fn.strip("fcleveingtype"), LIVING_TYPE)).alias("resident_type"),
        fn.clean_str("fcid").alias("unit_id"),
        fn.clean_str("fccreateby").alias("crtd_by"),
        fn.coalesce_first(updt_by, fn.clean_str("fccreateby")).alias("updt_by"),  # D24: never falls back
        fn.flag_map("fcisactive", FLAG_LOWER_YN_TF, case="lower").alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"),
    )
    keep = [c for c in cleaned.columns if c not in present]
    owners = unpivot(cleaned, keep, present, "owner_col", "ownerid")
    owners = owners.where(F.col("ownerid").isNotNull() & (fn.strip("ownerid") != "")).drop("owner_col")
    branch = src["tmBRN"].select(F.col("fcid").alias("branch_of"), fn.clean_str("fccomid").alias("project_id"))
    df = lookup_join(owners.withColumn("party_id", fn.clean_str("ownerid")), branch, "branch_key", "branch_of", "left", small=True)
    return finish(with_audit(df.withColumn("project_id", F.coalesce("project_id", F.lit(""))), ctx.run_ts), FACT_UNIT)


ROOM_COLS = ("fcid", "fccode", "fcbrnid", "fcaddressno", "fcownerratio", "fcleveingtype", "fcownerid",
             "fcownerid2", "fcownerid3", "fccurrentownerid", "fcisactive", "ftcreatedate", "fccreateby",
             "ftupdatedate", "fcupdateby")
ROOM_FACT_COLS = ("fcbrnid", "fcid", "fcownerid", "fcownerid2", "fcownerid3", "fccurrentownerid",
                  "fttransferdate", "ftdatein", "ftdateout", "fcleveingtype", "fcisactive", "ftcreatedate",
                  "fccreateby", "ftupdatedate", "fcupdateby")

SPECS = (
    TableSpec("dim_unit", "dim_unit", ("date_id", "unit_id"), (
        Source("tmRoomH", "tmRoomH", columns=ROOM_COLS),
        Source("tmBRN", "tmBRN", columns=("fcid", "fccomid"), kind=LATEST, keys=("fcid",)),
    ), build_dim_unit, DIM_UNIT),
    TableSpec("fact_unit", "fact_unit", ("date_id", "unit_id"), (
        Source("tmRoomH", "tmRoomH", columns=ROOM_FACT_COLS),
        Source("tmBRN", "tmBRN", columns=("fcid", "fccomid", "fccode"), kind=LATEST, keys=("fcid",)),
    ), build_fact_unit, FACT_UNIT),
)
