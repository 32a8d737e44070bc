"""Company tables (T16-T18) and the shared invitation / audit-log builders used by
the project tables (T29, T30)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind.operators import blank_strings_to_null, col_or, lookup_join, suffix_columns, with_audit
from tamarind.plans.common import AUDIT, finish, schema
from tamarind.spec import LATEST, Source, TableSpec

PMS = dict(app="pmsmanagement", source_type="postgresql")

DIM_PMSCOMPANY = schema(f"""{AUDIT}, date_id:date, company_id:long, company_cd:str, company_nm_th:str,
    company_nm_en:str, is_active:str, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")


def invitation_schema(entity: str, with_role: bool):
    role = "role_id:long, " if with_role else ""
    return schema(f"""{AUDIT}, date_id:date, record_id:long, invite_id:long, pms{entity}_id:long,
        invite_status:str, {role}invite_by:str, invite_email:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str,
        updt_dttm:ts, updt_by:str""")


def history_schema(entity: str):
    return schema(f"""{AUDIT}, date_id:date, record_id:long, pms{entity}_id:long, action_type:str, desc:str,
        action_email:str, reason:str, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")


FACT_INV_COMPANY = invitation_schema("company", False)
FACT_INVHIST_COMPANY = history_schema("company")


def build_dim_pmscompany(src: dict, ctx):
    """Companies.  D4: the studied code always writes '' for crtd_by/updt_by (it
    renames, then fetches the old name); we carry the cleaned values."""
    df = src["companies"]
    df = with_audit(df, ctx.run_ts).select(
        "*",
        fn.date_id_from_text(fn.coalesce_first("updated_at", "created_at")).alias("date_id"),
        F.col("id").cast("bigint").alias("company_id"), F.col("code").alias("company_cd"),
        F.col("name_th").alias("company_nm_th"), fn.clean_token("name_en", ["nan"]).alias("company_nm_en"),
        F.lit("1").alias("rec_actv_flag"),
        fn.to_ts("created_at").alias("crtd_dttm"), fn.to_ts("updated_at").alias("updt_dttm"),
        fn.clean_token(col_or(df, "created_by")).alias("crtd_by"),
        fn.clean_token(col_or(df, "updated_by")).alias("updt_by"),
    )
    return finish(df, DIM_PMSCOMPANY)


def build_invitation_link(entity: str, with_role: bool):
    """Invitation answers of a company/project ⟕ newest invitation."""
    sch = invitation_schema(entity, with_role)

    def build(src: dict, ctx):
        link = src[f"invitation_{'companies' if entity == 'company' else 'projects'}"]
        inv = suffix_columns(src["invitations"], "_invitations")
        df = lookup_join(link, inv, "invitation_id", "id_invitations", "left")
        df = blank_strings_to_null(df)
        responded = fn.to_ts("responded_at")
        cols = [
            fn.date_id_from_ts("responded_at").alias("date_id"),
            F.col("id").alias("record_id"), F.col("invitation_id").alias("invite_id"),
            fn.to_long(f"{entity}_id").alias(f"pms{entity}_id"),
            fn.clean_str("status").alias("invite_status"),
            fn.clean_str(col_or(df, "invited_by_invitations")).alias("invite_by"),
            fn.clean_str(col_or(df, "email_invitations")).alias("invite_email"),
            F.lit("1").alias("rec_actv_flag"), responded.alias("crtd_dttm"), responded.alias("updt_dttm"),
            F.lit(None).cast("string").alias("crtd_by"), F.lit(None).cast("string").alias("updt_by"),
        ]
        if with_role:
            cols.append(fn.to_long(col_or(df, "role_id")).alias("role_id"))
        df = with_audit(df, ctx.run_ts).select("dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note", *cols)
        return finish(df, sch)
    return build


def build_invitation_history(entity: str):
    """Audit log of a company/project, insert-only (created = updated)."""
    sch = history_schema(entity)

    def build(src: dict, ctx):
        df = src[f"{entity}_audit_logs"]
        created = fn.to_ts("created_at")
        crtd_by = col_or(df, "created_by")
        df = with_audit(df, ctx.run_ts).select(
            "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
            fn.date_id_from_ts("created_at").alias("date_id"),
            fn.to_long("id").alias("record_id"), fn.to_long(f"{entity}_id").alias(f"pms{entity}_id"),
            fn.clean_str(col_or(df, "action_type")).alias("action_type"),
            fn.clean_str(col_or(df, "description")).alias("desc"),
            fn.clean_str(col_or(df, "target_email")).alias("action_email"),
            fn.clean_str(col_or(df, "reason")).alias("reason"),
            F.lit("1").alias("rec_actv_flag"), created.alias("crtd_dttm"), created.alias("updt_dttm"),
            crtd_by.alias("crtd_by"), crtd_by.alias("updt_by"),
        )
        return finish(df, sch)
    return build


SPECS = [
    TableSpec("dim_pmscompany", "dim_pmscompany", ("date_id", "company_id"),
              (Source("companies", "companies", **PMS),), build_dim_pmscompany, DIM_PMSCOMPANY, full_default=True),
    TableSpec("fact_pmsinvitation_company", "fact_pmsinvitation_company", ("date_id", "record_id"), (
        Source("invitation_companies", "invitation_companies", **PMS),
        Source("invitations", "invitations", kind=LATEST, keys=("id",), **PMS),
    ), build_invitation_link("company", False), FACT_INV_COMPANY),
    TableSpec("fact_pmsinvitationhist_company", "fact_pmsinvitationhist_company", ("date_id", "record_id"),
              (Source("company_audit_logs", "company_audit_logs", **PMS),),
              build_invitation_history("company"), FACT_INVHIST_COMPANY),
]
