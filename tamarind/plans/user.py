"""User-domain tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind.functions.codes import FLAG_UPPER_YN_TF, FLAG_YN, FLAG_YN_TF, PCL_PATTERN
from tamarind.operators import (
    blank_strings_to_null, fanout_join, last_value_per_key, lookup_join, lower_columns, rename, suffix_columns,
    unpivot, with_audit,
)
from tamarind.plans.common import AUDIT, finish, schema
from tamarind.plans.unit import OWNER_COLS
from tamarind.sources.warehouse import member_parties
from tamarind.spec import HISTORY, LATEST, Source, TableSpec, WAREHOUSE

DIM_PARTY = schema(f"""{AUDIT}, full_nm_th:str, titl_th:str, frst_nm_th:str, last_nm_th:str, full_nm_en:str,
    titl_en:str, frst_nm_en:str, last_nm_en:str, dob:ts, age:long, th_id:str, passport_no:str, cnty_cd:str,
    mob_no:str, email:str, edu:str, occu:str, income_range:str, mrtl_sts:str, rlgn:str, gndr:str, fam_size:str,
    totl_kid:dbl, totl_eldr:dbl, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str,
    party_type_id:long, party_id:str, date_id:date, mem_sts:str, mem_crtd_dttm:ts, mem_ref_code:str,
    corporate_type:str, nationality_id:str""")

FACT_AUTHUSER = schema(f"""{AUDIT}, date_id:date, auth_id:long, mobile_user_id:str, phone_number:str,
    country_code:str, is_deleted:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str""")

FACT_USER = schema(f"""{AUDIT}, date_id:date, user_id:str, usergroup_id:str, user_cd:str, user_nm:str,
    user_status:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str""")

FACT_UNITRESIDENT = schema(f"""{AUDIT}, date_id:date, corhist_id:str, unit_id:str, party_id:str, resident_type:str,
    move_in_date:ts, move_out_date:ts, hisrory_status:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str,
    updt_dttm:ts, updt_by:str""")


def _null(t: str = "string"):
    return F.lit(None).cast(t)


def build_fact_authuser(src: dict, ctx):
    """Auth users; date_id from the lake partition the row was read from."""
    df = blank_strings_to_null(src["users"])
    df = with_audit(df, ctx.run_ts).select(
        "*",
        fn.date_id_from_parts("calendar_year", "month_no", "day_of_month").alias("date_id"),
        fn.to_long("id").alias("auth_id"),
        fn.clean_str("phone_number").alias("phone_number_c"),
        fn.clean_str("country_code").alias("country_code_c"),
        fn.is_deleted_flag("is_deleted").alias("is_deleted_c"),
        F.lit("1").alias("rec_actv_flag"),
        fn.to_ts("created_time").alias("crtd_dttm"),
        fn.to_ts("updated_time").alias("updt_dttm"),
        _null().alias("crtd_by"), _null().alias("updt_by"),
    ).drop("phone_number", "country_code", "is_deleted").withColumnsRenamed(
        {"phone_number_c": "phone_number", "country_code_c": "country_code", "is_deleted_c": "is_deleted"})
    return finish(df, FACT_AUTHUSER)


def party_nulls(names) -> list:
    return [_null().alias(n) for n in names]


def build_dim_party_homeservice(src: dict, ctx):
    """Home-service providers as parties of type 4 (no distinct)."""
    df = lower_columns(src["seekster_provider"])
    full = fn.coalesce_first("provider_name", "registered_name")
    create_s = F.col("create_date").cast("string").try_cast("double")
    update_s = F.col("update_date").cast("string").try_cast("double")
    crtd = fn.epoch_to_ts(create_s)
    updt = fn.epoch_to_ts(F.coalesce(update_s, create_s))
    df = with_audit(df, ctx.run_ts).select(
        "*",
        full.alias("full_nm_th"), full.alias("full_nm_en"),
        *party_nulls(["titl_th", "frst_nm_th", "last_nm_th", "titl_en", "frst_nm_en", "last_nm_en", "th_id",
                      "passport_no", "cnty_cd", "mob_no", "email", "edu", "occu", "income_range", "mrtl_sts",
                      "rlgn", "gndr", "fam_size", "mem_ref_code", "mem_sts", "nationality_id"]),
        _null("timestamp_ntz").alias("dob"), _null("timestamp_ntz").alias("mem_crtd_dttm"),
        _null("bigint").alias("age"), _null("double").alias("totl_kid"), _null("double").alias("totl_eldr"),
        fn.tri_flag("is_active").alias("rec_actv_flag"),
        crtd.alias("crtd_dttm"), updt.alias("updt_dttm"),
        F.col("create_by").alias("crtd_by"), F.col("provider_id").alias("party_id"),
        fn.coalesce_first("update_by", "create_by").alias("updt_by"),
        F.lit(4).cast("bigint").alias("party_type_id"),
        fn.corporate_type(full).alias("corporate_type"),
        fn.date_id_from_text(F.coalesce(updt, crtd)).alias("date_id"),
    )
    return finish(df, DIM_PARTY, distinct=False)


def build_fact_user(src: dict, ctx):
    """Back-office users; Buddhist years above 2400 fixed before parsing."""
    df = lower_columns(src["tmUSR"])
    crtd_by = fn.clean_str("fccreator")
    df = with_audit(df, ctx.run_ts).select(
        "*",
        fn.date_id_from_text(fn.be_to_ce(fn.coalesce_first("ftupdatedate", "ftcreatedate"), 2400), day_width=2)
        .alias("date_id"),
        fn.clean_str("fcid").alias("user_id"), fn.clean_str("fcusgid").alias("usergroup_id"),
        fn.clean_str("fccode").alias("user_cd"), fn.clean_str("fcname").alias("user_nm"),
        fn.flag_map("fcisactive", FLAG_YN, case="upper").alias("user_status"),
        _null().alias("rec_actv_flag"),
        fn.to_ts(fn.be_to_ce("ftcreatedate", 2400)).alias("crtd_dttm"),
        fn.to_ts(fn.be_to_ce("ftupdatedate", 2400)).alias("updt_dttm"),
        crtd_by.alias("crtd_by"),
        F.coalesce(fn.blank_to_null(fn.clean_str("fcupdateby")), crtd_by).alias("updt_by"),
    )
    return finish(df, FACT_USER)


def build_fact_unitresident(src: dict, ctx):
    """Residence history; date_id is the run date."""
    df = blank_strings_to_null(lower_columns(src["ttCORHist"]))
    df = with_audit(df, ctx.run_ts).select(
        "*",
        F.lit(ctx.run_ts.date()).alias("date_id"),
        fn.clean_str("fcid").alias("corhist_id"), fn.clean_str("fcroomid").alias("unit_id"),
        fn.clean_str("fccornewrentalid").alias("party_id"), fn.clean_str("fctype").alias("resident_type"),
        fn.clean_str("fcisactive").alias("hisrory_status"),
        fn.clean_str("fccreator").alias("crtd_by"), fn.clean_str("fcupdateby").alias("updt_by"),
        fn.to_ts(fn.be_to_ce("ftdatein", 2400)).alias("move_in_date"),
        fn.to_ts(fn.be_to_ce("ftdateout", 2400)).alias("move_out_date"),
        fn.to_ts(fn.be_to_ce("ftcreatedate", 2400)).alias("crtd_dttm"),
        fn.to_ts(fn.be_to_ce("ftupdatedate", 2400)).alias("updt_dttm"),
        F.lit("1").alias("rec_actv_flag"),
    )
    return finish(df, FACT_UNITRESIDENT)


SPECS = [
    TableSpec("fact_authuser", "fact_authuser", ("date_id", "auth_id"),
              (Source("users", "users", app="authentication", source_type="postgresql"),),
              build_fact_authuser, FACT_AUTHUSER, row_local=True),
    TableSpec("dim_party_homeservice", "dim_party", ("date_id", "party_id", "party_type_id"),
              (Source("seekster_provider", "seekster_provider", app="homeservice",
                      columns=("provider_id", "provider_name", "registered_name", "is_active", "create_date",
                               "create_by", "update_date", "update_by")),),
              build_dim_party_homeservice, DIM_PARTY),
    TableSpec("fact_user", "fact_user", ("date_id", "user_id", "usergroup_id"),
              (Source("tmUSR", "tmUSR"),), build_fact_user, FACT_USER, full_default=True),
    TableSpec("fact_unitresident", "fact_unitresident", ("date_id", "corhist_id"),
              (Source("ttCORHist", "ttCORHist"),), build_fact_unitresident, FACT_UNITRESIDENT, full_default=True),
]


FACT_PMSINVITATIONS = schema(f"""{AUDIT}, date_id:date, invite_id:long, invite_email:str, invite_status:str,
    expired_dttm:ts, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str""")

FACT_PMSUSER_ROLE = schema(f"""{AUDIT}, date_id:date, record_id:long, user_id:long, role_id:long,
    pmscompany_id:long, pmsproject_id:long, is_active:bool, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts,
    updt_by:str, updt_dttm:ts""")


def build_fact_pmsinvitations(src: dict, ctx):
    """Invitations as sent (created = updated)."""
    df = src["invitations"]
    created = fn.to_ts("created_at")
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_ts("created_at").alias("date_id"), F.col("id").alias("invite_id"),
        fn.clean_str("email").alias("invite_email"), fn.clean_str("status").alias("invite_status"),
        fn.to_ts("expires_at").alias("expired_dttm"), F.lit("1").alias("rec_actv_flag"),
        created.alias("crtd_dttm"), created.alias("updt_dttm"),
        F.col("invited_by").alias("crtd_by"), F.col("invited_by").alias("updt_by"),
    )
    return finish(df, FACT_PMSINVITATIONS)


def build_fact_pmsuser_role(src: dict, ctx):
    """User roles per company/project; ids coerced with 0 for bad values."""
    df = src["user_roles"]
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_ts(fn.coalesce_first("updated_at", "created_at")).alias("date_id"),
        fn.to_long_or_zero("id").alias("record_id"), fn.to_long_or_zero("user_id").alias("user_id"),
        fn.to_long_or_zero("role_id").alias("role_id"), fn.to_long_or_zero("company_id").alias("pmscompany_id"),
        fn.to_long_or_zero("project_id").alias("pmsproject_id"), fn.norm_bool("is_active").alias("is_active"),
        F.lit("1").alias("rec_actv_flag"),
        fn.clean_str("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"),
        fn.clean_str("updated_by").alias("updt_by"), fn.to_ts("updated_at").alias("updt_dttm"),
    )
    return finish(df, FACT_PMSUSER_ROLE)


_PMS = dict(app="pmsmanagement", source_type="postgresql")
SPECS += [
    TableSpec("fact_pmsinvitations", "fact_pmsinvitations", ("date_id", "invite_id"),
              (Source("invitations", "invitations", **_PMS),), build_fact_pmsinvitations, FACT_PMSINVITATIONS),
    TableSpec("fact_pmsuser_role", "fact_pmsuser_role", ("date_id", "record_id"),
              (Source("user_roles", "user_roles", **_PMS),), build_fact_pmsuser_role, FACT_PMSUSER_ROLE),
]


DIM_DEVICE_DETAIL = schema(f"""{AUDIT}, last_login_dttm:ts, device_nm:str, platform:str, version:str,
    rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_by:str, updt_dttm:ts, device_id:str, date_id:date""")
FACT_USERCONSENT = schema(f"""{AUDIT}, date_id:date, uconsent_id:long, user_id:long, consent_id:long,
    consent_type:str, consent_sts:str, version_id:long, version_nm:str, consent_topic:str, uconsent_sts:str,
    rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str""")
DIM_PMSUSERPROFILE = schema(f"""{AUDIT}, date_id:date, user_id:long, email:str, is_active:bool,
    last_login_dttm:ts, token_expired_dttm:ts, token_version:long, profile_id:long, first_name:str,
    last_name:str, country_cd:str, phone_number:str, profile_updt_by:str, profile_updt_dttm:ts,
    rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")


def build_dim_device_detail(src: dict, ctx):
    """Devices ⟕ newest login of the disabled rows of each device (no distinct)."""
    raw = lower_columns(src["gu_device"])
    disabled = raw.where(F.col("is_enable") == "false").select(
        F.col("device_id").alias("device_id_cl"),
        fn.to_ts(fn.coalesce_first("updated_date", "created_date")).alias("lastlogin"))  # raw text: '' wins
    last = last_value_per_key(disabled.where(F.col("device_id_cl").isNotNull()), "device_id_cl", "lastlogin")
    df = lookup_join(raw, last, "device_id", "device_id_cl", "left")
    df = blank_strings_to_null(df)
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("lastlogin").alias("last_login_dttm"), F.col("device_name").alias("device_nm"), "platform",
        F.col("os_version").alias("version"), fn.disabled_flag("is_enable").alias("rec_actv_flag"),
        fn.to_ts("created_date").alias("crtd_dttm"), F.col("customer_id").cast("string").alias("crtd_by"),
        F.col("customer_id").cast("string").alias("updt_by"), fn.to_ts("updated_date").alias("updt_dttm"),
        "device_id", fn.date_id_from_ts(fn.coalesce_first("updated_date", "created_date")).alias("date_id"),
    )
    return finish(df, DIM_DEVICE_DETAIL, distinct=False)


def build_fact_userconsent(src: dict, ctx):
    """User consents ⟕ newest consent ⟕ newest versions of its type (fan-out;
    a null type matches a null type, as the studied merge does — J11). Each input is cleaned
    before the joins; a type has few values, so versions are broadcast or their keys split."""
    given = blank_strings_to_null(src["users_consent"], but=("consent_id",))
    fact = given.select(
        F.col("consent_id").alias("consent_key"), fn.date_id_from_parts("calendar_year", "month_no", "day_of_month").alias("date_id"),
        fn.to_long("id").alias("uconsent_id"), fn.to_long("user_id").alias("user_id"), fn.to_long("consent_id").alias("consent_id"),
        fn.clean_str("status").alias("uconsent_sts"), fn.to_ts("created_date").alias("crtd_dttm"), fn.clean_str("created_by").alias("crtd_by"),
        fn.to_ts("updated_date").alias("updt_dttm"), fn.clean_str("updated_by").alias("updt_by"))
    consent = src["consents"].select(
        F.col("id").alias("key_of_consent"), F.col("type").alias("type_key"), fn.clean_str("type").alias("consent_type"),
        fn.clean_str("status").alias("consent_sts"), fn.clean_str("version").alias("version_nm"), fn.clean_str("topic").alias("consent_topic"))
    version = src["consent_versions"].select(F.col("type").alias("key_of_type"), fn.to_long("version").alias("version_id"))
    df = lookup_join(fact, consent, "consent_key", "key_of_consent", "left")
    df = fanout_join(df, version, "type_key", "key_of_type", "left", null_safe=True)
    names = {c: F.coalesce(c, F.lit("")) for c in ("consent_type", "consent_sts", "version_nm", "consent_topic")}
    df = df.withColumns({"rec_actv_flag": F.lit("1"), **names})
    return finish(with_audit(df, ctx.run_ts), FACT_USERCONSENT)


def build_dim_pmsuserprofile(src: dict, ctx):
    """PMS users ⟕ newest profile."""
    prof = suffix_columns(src["profiles"], "_profiles")
    df = blank_strings_to_null(lookup_join(src["users"], prof, "id", "id_profiles", "left"))
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_ts(fn.coalesce_first("created_at", "updated_at")).alias("date_id"),
        fn.to_long("id").alias("user_id"), "email", fn.norm_bool("is_active").alias("is_active"),
        fn.to_ts("last_login_at").alias("last_login_dttm"),
        fn.to_ts("refresh_token_expired_at").alias("token_expired_dttm"),
        fn.to_long("token_version").alias("token_version"), fn.to_long("id_profiles").alias("profile_id"),
        fn.clean_str("first_name_profiles").alias("first_name"), fn.clean_str("last_name_profiles").alias("last_name"),
        fn.clean_str("country_code_profiles").alias("country_cd"),
        fn.clean_str("phone_number_profiles").alias("phone_number"),
        F.col("updated_by_profiles").alias("profile_updt_by"),
        fn.to_ts("updated_at_profiles").alias("profile_updt_dttm"), F.lit("1").alias("rec_actv_flag"),
        F.col("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"),
        F.col("updated_by").alias("updt_by"), fn.to_ts("updated_at").alias("updt_dttm"),
    )
    return finish(df, DIM_PMSUSERPROFILE)


_PDPA = dict(app="pdpa", source_type="postgresql")
SPECS += [
    TableSpec("dim_device_detail", "dim_device_detail", ("date_id", "device_id"),
              (Source("gu_device", "gu_device", app="notification", source_type="postgresql"),),
              build_dim_device_detail, DIM_DEVICE_DETAIL),
    TableSpec("fact_userconsent", "fact_userconsent", ("date_id", "uconsent_id"), (
        Source("users_consent", "users_consent", **_PDPA),
        Source("consents", "consents", kind=LATEST, keys=("id",), **_PDPA),
        Source("consent_versions", "consent_versions", kind=LATEST, keys=("id",), **_PDPA),
    ), build_fact_userconsent, FACT_USERCONSENT, row_local=True),
    TableSpec("dim_pmsuserprofile", "dim_pmsuserprofile", ("date_id", "user_id"), (
        Source("users", "users", **_PMS),
        Source("profiles", "profiles", kind=LATEST, keys=("id",), **_PMS),
    ), build_dim_pmsuserprofile, DIM_PMSUSERPROFILE),
]


# fixed values: columns of the source and target tables
_PERM_COLS = ["view", "insert", "update", "delete", "print", "cancel", "approve"]
_PERM_SRC = ["fcselect", "fcinsert", "fcupdate", "fcdelete", "fcprint", "fccancel", "fcapprove"]
DIM_USERPERMISSION = schema(f"""{AUDIT}, date_id:date, user_id:str, user_cd:str, user_nm:str, user_status:str,
    user_crtddttm:ts, user_updtdttm:ts, project_id:str, branch_id:str, usergroup_id:str, usergroup_nm:str,
    usergroup_status:str, mnu_id:str, mnu_nm_eng:str, mnu_nm_thai:str, view:str, insert:str, update:str,
    delete:str, print:str, cancel:str, approve:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts,
    updt_by:str""")
FACT_USERPERMISSION = schema(f"""{AUDIT}, date_id:date, project_id:str, branch_id:str, usergroup_id:str,
    usergroup_nm:str, usergroup_status:str, mnu_id:str, mnu_nm_eng:str, mnu_nm_thai:str, view:str, insert:str,
    update:str, delete:str, print:str, cancel:str, approve:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str,
    updt_dttm:ts, updt_by:str""")


def _cleaned(df, key: str, key_name: str, **columns):
    """A lookup side: its raw key and its cleaned columns, so that it is cleaned before the join."""
    return df.select(F.col(key).alias(key_name), *[c.alias(name) for name, c in columns.items()])


def _permissions(src: dict, given, group, users=None):
    """Permission ⋈ branch ⋈ group [⋈ users of the group] ⋈ menu — inner joins of cleaned
    sides, one distinct at the end instead of one after each join (same result set)."""
    branch = _cleaned(lower_columns(src["tmBRN"]), "fcid", "branch_of", project_id=fn.clean_str("fccomid"))
    menu = _cleaned(lower_columns(src["tmMNU"]), "fcid", "menu_of", mnu_nm_eng=fn.clean_str("fccode"), mnu_nm_thai=fn.clean_str("fcname"))
    df = lookup_join(given, branch, "branch_key", "branch_of", "inner", small=True)
    df = lookup_join(df, menu, "menu_key", "menu_of", "inner", small=True)
    df = lookup_join(df, group, "group_key", "group_of", "inner", small=True)
    return df if users is None else lookup_join(df, users, "group_key", "users_of", "inner")  # J7: group -> its users


def _given_permissions(src: dict, **columns):
    """The permission rows with their raw keys, ids and flags."""
    aut = lower_columns(src["tmAUT"])
    return aut.select(F.col("fcbrnid").alias("branch_key"), F.col("fcusgid").alias("group_key"), F.col("fcmnuid").alias("menu_key"),
                      fn.clean_str("fcbrnid").alias("branch_id"), fn.clean_str("fcmnuid").alias("mnu_id"),
                      *[F.col(s).alias(t) for s, t in zip(_PERM_SRC, _PERM_COLS)], *[c.alias(name) for name, c in columns.items()])


def build_dim_userpermission(src: dict, ctx):
    """Menu permissions per user (via the user's group), branch and project."""
    given = _given_permissions(src, date_id=fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")))
    group = _cleaned(lower_columns(src["tmUSG"]), "fcid", "group_of", usergroup_id=fn.clean_str("fcid"), usergroup_nm=fn.clean_str("fcname"),
                     usergroup_status=F.col("fcisactive"), crtd_dttm=fn.to_ts("ftcreatedate"), updt_dttm=fn.to_ts("ftupdatedate"),
                     crtd_by=F.col("fccreator"), updt_by=F.col("fcupdateby"))
    users = _cleaned(lower_columns(src["tmUSR"]), "fcusgid", "users_of", user_id=fn.clean_str("fcid"), user_cd=fn.clean_str("fccode"),
                     user_nm=fn.clean_str("fcname"), user_status=F.col("fcisactive"), user_crtddttm=fn.to_ts("ftcreatedate"),
                     user_updtdttm=fn.to_ts("ftupdatedate"), rec_actv_flag=fn.flag_map("fcisactive", FLAG_UPPER_YN_TF, case="upper"))
    return finish(with_audit(_permissions(src, given, group, users), ctx.run_ts), DIM_USERPERMISSION)


def build_fact_userpermission(src: dict, ctx):
    """Menu permissions per group, branch and project; Buddhist years above 2400 fixed."""
    given = _given_permissions(src, date_id=fn.date_id_from_text(fn.be_to_ce(fn.coalesce_first("ftupdatedate", "ftcreatedate"), 2400), day_width=2),
                               usergroup_id=fn.clean_str("fcusgid"), crtd_dttm=fn.to_ts(fn.be_to_ce("ftcreatedate", 2400)),
                               updt_dttm=fn.to_ts(fn.be_to_ce("ftupdatedate", 2400)))
    group = _cleaned(lower_columns(src["tmUSG"]), "fcid", "group_of", usergroup_nm=fn.clean_str("fcname"),
                     usergroup_status=fn.flag_map("fcisactive", FLAG_YN, case="upper"))
    nothing = {c: F.lit(None).cast("string") for c in ("rec_actv_flag", "crtd_by", "updt_by")}
    return finish(with_audit(_permissions(src, given, group).withColumns(nothing), ctx.run_ts), FACT_USERPERMISSION)


_AUT_COLS = ("fcusgid", "fcbrnid", "fcmnuid", "fcselect", "fcinsert", "fcupdate", "fcdelete", "fcprint", "fccancel",
             "fcapprove", "ftcreatedate", "ftupdatedate")
_BRN = Source("tmBRN", "tmBRN", columns=("fcid", "fccomid"), kind=LATEST, keys=("fcid",))
_MNU = Source("tmMNU", "tmMNU", columns=("fcid", "fccode", "fcname"), kind=LATEST, keys=("fcid",))
SPECS += [
    TableSpec("dim_userpermission", "dim_userpermission",
              ("date_id", "project_id", "branch_id", "usergroup_id", "user_id", "mnu_id"), (
                  Source("tmAUT", "tmAUT", columns=_AUT_COLS), _BRN,
                  Source("tmUSG", "tmUSG", columns=("fcid", "fcname", "fcisactive", "ftcreatedate", "fccreator",
                                                    "ftupdatedate", "fcupdateby"), kind=LATEST, keys=("fcid",)),
                  Source("tmUSR", "tmUSR", columns=("fcid", "fcusgid", "fccode", "fcname", "fcisactive", "ftcreatedate",
                                                    "fccreator", "ftupdatedate", "fcupdateby"),
                         kind=LATEST, keys=("fcid",)),
                  _MNU,
              ), build_dim_userpermission, DIM_USERPERMISSION, full_default=True),
    TableSpec("fact_userpermission", "fact_userpermission", ("date_id", "project_id", "branch_id", "usergroup_id", "mnu_id"), (
        Source("tmAUT", "tmAUT", columns=_AUT_COLS), _BRN,
        Source("tmUSG", "tmUSG", columns=("fcid", "fcname", "fcisactive"), kind=LATEST, keys=("fcid",)),
        _MNU,
    ), build_fact_userpermission, FACT_USERPERMISSION, full_default=True),
]


def _party_common(run_ts):
    none = lambda n, t="string": F.lit(None).cast(t).alias(n)
    return none, [none("totl_kid", "double"), none("totl_eldr", "double"), none("mem_sts"),
                  none("mem_crtd_dttm", "timestamp_ntz"), none("nationality_id")]


def build_dim_party_gu(src: dict, ctx):
    """App users as parties of type 2 ⟕ mobile customer on phone ⟕ newest gender.
    D14: the customer join adds no column; with the final distinct Catalyst drops it."""
    mu = rename(lower_columns(src["tmmobileuser"]),
                {"fcuserid": "fcid", "ftbirthdate": "ftbirthday", "fcemail": "fcshipemail", "fngender": "fcsex"})
    name = fn.full_name("fcfirstname", "fclastname")
    mu = mu.select("*", name.alias("fcname"), fn.phone_prefix0("fcphoneno").alias("fcshipmobile"),
                   fn.strip("fcsex").alias("fcsex_s"))
    cus = lower_columns(src["customer"]).select(fn.phone_prefix0("phonenumber").alias("phonenumber_new_c"))
    mg = lower_columns(src["tmMobileGender"]).select(fn.strip(F.col("fcid").cast("string")).alias("fcid_mg"),
                                                     F.col("fcnameth").alias("fcnameth_mg"))
    df = lookup_join(mu, cus, "fcshipmobile", "phonenumber_new_c", "left")
    df = lookup_join(df, mg, "fcsex_s", "fcid_mg", "left", small=True)
    dob = fn.to_ts(fn.be_to_ce("ftbirthday", 2500, upper=2600, min_len=10))
    crtd = fn.to_ts("ftcreatedate")
    none, tail = _party_common(ctx.run_ts)
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("fcname").alias("full_nm_th"), none("titl_th"), F.col("fcfirstname").alias("frst_nm_th"),
        F.col("fclastname").alias("last_nm_th"), F.col("fcname").alias("full_nm_en"), none("titl_en"),
        F.col("fcfirstname").alias("frst_nm_en"), F.col("fclastname").alias("last_nm_en"),
        dob.alias("dob"), fn.age_years(ctx.run_ts, dob).cast("bigint").alias("age"),
        F.col("fctaxid").alias("th_id"), F.col("fctaxid").alias("passport_no"), F.col("fccountrycode").alias("cnty_cd"),
        F.col("fcshipmobile").alias("mob_no"), F.col("fcshipemail").alias("email"), none("edu"), none("occu"),
        none("income_range"), none("mrtl_sts"), none("rlgn"), F.col("fcnameth_mg").alias("gndr"), none("fam_size"),
        fn.flag_map("fcisactive", FLAG_YN).alias("rec_actv_flag"),
        crtd.alias("crtd_dttm"), F.col("fccreateby").alias("crtd_by"),
        F.coalesce(fn.to_ts("ftupdatedate"), crtd).alias("updt_dttm"),
        fn.coalesce_first("fcupdateby", "fccreateby").alias("updt_by"),
        F.lit(2).cast("bigint").alias("party_type_id"), F.col("fcid").alias("party_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
        none("mem_ref_code"), fn.corporate_type("fcname", PCL_PATTERN).alias("corporate_type"), *tail,
    )
    return finish(df, DIM_PARTY)


def build_dim_party_ru(src: dict, ctx):
    """T4: unit owners (any of the four owner columns of the newest unit rows) as
    parties of type 1.  Only the owner id is used, so the distinct owners join the
    parties as a semi join."""
    room = lower_columns(src["tmRoomH"])
    present = [c for c in OWNER_COLS if c in room.columns]
    owners = (unpivot(room.select("fcid", *present), ["fcid"], present, "owner_col", "fcid_owner")
              .select("fcid_owner").where(F.coalesce(F.col("fcid_owner"), F.lit("")) != "").distinct())
    cor = lower_columns(src["tmCOR"])
    df = cor.join(owners, cor["fcid"] == owners["fcid_owner"], "left_semi")
    dob = fn.to_ts(fn.be_to_ce("ftbirthday", 2500))
    crtd = fn.to_ts("ftcreatedate")
    none, tail = _party_common(ctx.run_ts)
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("fcname").alias("full_nm_th"), *[none(c) for c in ("titl_th", "frst_nm_th", "last_nm_th", "titl_en",
                                                                  "frst_nm_en", "last_nm_en")],
        F.col("fcengname").alias("full_nm_en"), dob.alias("dob"),
        F.when(dob.isNotNull(), fn.age_years(ctx.run_ts, dob))
        .otherwise(fn.to_double("fnage", 0.0)).cast("bigint").alias("age"),
        F.col("fctaxid").alias("th_id"), F.col("fcpassport").alias("passport_no"),
        F.col("fccountrycode").alias("cnty_cd"), F.col("fcshipmobile").alias("mob_no"),
        F.col("fcshipemail").alias("email"), F.col("fceducation").alias("edu"), none("occu"), none("income_range"),
        F.col("fcmarrystatus").alias("mrtl_sts"), none("rlgn"), fn.gender_label("fcsex").alias("gndr"),
        none("fam_size"), fn.flag_map("fcisactive", FLAG_YN_TF).alias("rec_actv_flag"),
        crtd.alias("crtd_dttm"), F.col("fccreator").alias("crtd_by"),
        F.coalesce(fn.to_ts("ftupdatedate"), crtd).alias("updt_dttm"),
        fn.coalesce_first("fcupdateby", "fccreator").alias("updt_by"),
        F.lit(1).cast("bigint").alias("party_type_id"), F.col("fcid").alias("party_id"),
        fn.date_id_from_ts(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
        none("mem_ref_code"), fn.corporate_type("fcname").alias("corporate_type"), *tail,
    )
    return finish(df, DIM_PARTY, distinct=False)


_PARTY_PK = ("date_id", "party_id", "party_type_id")
SPECS += [
    TableSpec("dim_party_gu", "dim_party", _PARTY_PK, (
        Source("tmmobileuser", "tmmobileuser", columns=(
            "fcfirstname", "fclastname", "fcuserid", "ftbirthdate", "fctaxid", "fccountrycode", "fcphoneno", "fcemail",
            "fngender", "fcisactive", "ftcreatedate", "fccreateby", "ftupdatedate", "fcupdateby")),
        Source("tmMobileGender", "tmMobileGender", columns=("fcid", "fcnameth", "fcnameen", "fcisactive", "fcisdefualt"),
               kind=LATEST, keys=("fcid",)),
        Source("customer", "customer", app="mobileregister", columns=("id", "phonenumber"), kind=LATEST, keys=("id",)),
    ), build_dim_party_gu, DIM_PARTY),
    TableSpec("dim_party_ru", "dim_party", _PARTY_PK, (
        Source("tmCOR", "tmCOR", columns=(
            "fcid", "fcname", "fcengname", "ftbirthday", "fnage", "fctaxid", "fcpassport", "fccountrycode",
            "fcshipmobile", "fcshipemail", "fceducation", "fcmarrystatus", "fcsex", "fcisactive", "ftcreatedate",
            "fccreator", "fcupdateby", "ftupdatedate", "fccode", "fccomid")),
        Source("tmRoomH", "tmRoomH", columns=("fcid", "fcownerid", "fcownerid2", "fcownerid3", "fccurrentownerid",
                                              "fcownerratio"), kind=LATEST, keys=("fcid",)),
    ), build_dim_party_ru, DIM_PARTY),
]


DIM_MOBILE_USER = schema(f"""{AUDIT}, date_id:date, customer_id:long, unit_id:str, device_id:str, user_name:str,
    country_code:str, mobile_phone:str, user_type:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str,
    history_status:str""")
MOBILE_OWNER_COLS = ["fcownerid", "fccurrentownerid", "fcownerid2", "fcownerid3"]
RESIDENT_TYPES = ["Rential", "Stay"]  # fixed values, as spelt in the source


def build_dim_mobile_user(src: dict, ctx):
    """App customers matched by phone to unit owners and residents (history of
    units, residences and parties), plus their devices. The histories come with repeats, which
    are dropped once only the columns that count are left."""
    room = src["tmRoomH_mobileuser"].select("fcid", *MOBILE_OWNER_COLS).distinct()
    owned = (unpivot(room.select("fcid", *MOBILE_OWNER_COLS), ["fcid"], MOBILE_OWNER_COLS, "owner_type", "fcownerid")
             .where(F.col("fcownerid").isNotNull() & (F.col("fcownerid") != "")))
    some_owner = reduce(or_, [F.col(c).isNotNull() & (F.col(c) != "") for c in MOBILE_OWNER_COLS])
    rooms = room.where(some_owner).select(fn.strip("fcid").alias("room_k"))
    residents = src["ttCORHist_mobileuser"].where(fn.strip("fctype").isin(RESIDENT_TYPES))
    cor = src["tmCOR"].withColumn("fcshipmobile", fn.strip("fcshipmobile"))
    cor_all = (cor.where(F.col("fcshipmobile").isNotNull() & (F.col("fcshipmobile") != ""))
               .select("fcid", fn.phone_pad9("fcshipmobile").alias("mobile_phone")).distinct())
    # owners: party (stripped id) = unit owner (stripped)
    owner_all = (cor_all.select(fn.strip("fcid").alias("k"), "mobile_phone")
                 .join(owned.select(fn.strip("fcownerid").alias("k"), F.col("fcid").alias("fcid_room")), "k"))
    # residents: residence (stripped renter) = party id (as is); their room has to be an owned one
    res = residents.select(fn.strip("fccornewrentalid").alias("fcid"), fn.strip("fcroomid").alias("room_k")).distinct()
    resident_all = res.join(rooms, "room_k", "left_semi").join(cor_all, "fcid")
    corall = (owner_all.select("mobile_phone", "fcid_room")
              .unionByName(resident_all.select("mobile_phone", F.col("room_k").alias("fcid_room")))
              .select(fn.strip("mobile_phone").alias("mobile_phone_cor"), "fcid_room").distinct())
    cus = src["customer"]
    cus = cus.select("*", fn.strip(fn.phone_pad9(fn.strip("phonenumber"))).alias("mobile_phone"))
    device = src["gu_device"].select(F.col("customer_id").cast("string").alias("customer_id_device"),
                                     F.col("device_id")).distinct()
    df = lookup_join(cus, corall, "mobile_phone", "mobile_phone_cor", "left")
    # a device without customer belongs to customers without id: null matches null here
    df = lookup_join(df, device, F.col("id").cast("string"), "customer_id_device", "left", null_safe=True)
    crtd = fn.to_ts("creationtime")
    unit = F.coalesce(F.col("fcid_room"), F.lit("0"))
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_text(fn.coalesce_first("lastmodificationtime", "creationtime")).alias("date_id"),
        F.col("id").cast("bigint").alias("customer_id"), unit.alias("unit_id"), "device_id",
        F.col("username").alias("user_name"), F.col("phonenumbercountrycode").alias("country_code"), "mobile_phone",
        fn.user_type(unit).alias("user_type"), crtd.alias("crtd_dttm"), F.col("creatoruserid").alias("crtd_by"),
        F.coalesce(fn.to_ts("lastmodificationtime"), crtd).alias("updt_dttm"),
        fn.coalesce_first("lastmodifieruserid", "creatoruserid").alias("updt_by"), F.lit("N").alias("history_status"),
    )
    return finish(df, DIM_MOBILE_USER)


SPECS += [
    TableSpec("dim_mobile_user", "dim_mobile_user", ("date_id", "customer_id", "unit_id"), (
        Source("customer", "customer", app="mobileregister", columns=(
            "id", "username", "phonenumbercountrycode", "phonenumber", "creationtime", "creatoruserid",
            "lastmodificationtime", "lastmodifieruserid")),
        Source("tmRoomH_mobileuser", "tmRoomH_mobileuser", kind=HISTORY, repeats=True, columns=(
            "fcid", "fcownerid", "fccurrentownerid", "fcownerid2", "fcownerid3", "ftcreatedate", "ftupdatedate")),
        Source("ttCORHist_mobileuser", "ttCORHist_mobileuser", kind=HISTORY, repeats=True, columns=(
            "fcid", "fccornewrentalid", "fcroomid", "fctype", "ftcreatedate", "ftupdatedate")),
        Source("tmCOR", "tmCOR", kind=HISTORY, repeats=True, columns=("fcid", "fcshipmobile", "ftcreatedate", "ftupdatedate")),
        Source("gu_device", "gu_device", app="notification", source_type="postgresql",
               columns=("customer_id", "device_id")),
    ), build_dim_mobile_user, DIM_MOBILE_USER, full_default=True, sort=("customer_id",)),
]


def build_dim_party_memberstatus(src: dict, ctx):
    """T5: loyalty members among the warehouse parties (type 1/2, lower-cased id in the
    day's members, J9 semi join) matched on (phone, user id) with the newest app user,
    ⟕ newest share-a-friend link for the referral code.  Reads and rewrites dim_party:
    the sink stages before it overwrites (never a static overwrite of the read path)."""
    ml = suffix_columns(lower_columns(src["tmMemberLoyalty"]).distinct(), "_member")
    party = member_parties(src["dim_party"], ml.select("fcuserid_member"))
    mu = lower_columns(src["tmmobileuser"]).select(
        F.col("fcuserid").alias("fcuserid_mobile"), fn.phone_prefix0("fcphoneno").alias("fcphoneno_mobile"))
    sf = lower_columns(src["tmShareFriend"]).select(F.col("fcuserid").alias("fcuserid_share"),
                                                    F.col("fcfrienduserid").alias("fcfrienduserid_share"))
    df = lookup_join(ml, mu, "fcuserid_member", "fcuserid_mobile", "inner")
    df = lookup_join(df, party, ["fcphoneno_mobile", "fcuserid_mobile"], ["mob_no", "party_id"], "inner")
    df = lookup_join(df, sf, "fcuserid_mobile", "fcfrienduserid_share", "left")
    keep = [c for c in DIM_PARTY.fieldNames()
            if c not in ("dwh_updt_dttm", "mem_sts", "mem_crtd_dttm", "mem_ref_code", "totl_kid", "totl_eldr")]
    df = df.select(
        *[party[c] for c in keep],
        fn.run_clock(ctx.run_ts).alias("dwh_updt_dttm"), F.lit("1").alias("mem_sts"),
        fn.to_ts("ftcreatedate_member").alias("mem_crtd_dttm"),
        F.coalesce(F.col("fcuserid_share"), F.lit("-")).alias("mem_ref_code"),
        party["totl_kid"].cast("double").alias("totl_kid"), party["totl_eldr"].cast("double").alias("totl_eldr"),
    )
    return finish(df, DIM_PARTY)


SPECS += [
    TableSpec("dim_party_memberstatus", "dim_party", _PARTY_PK, (
        Source("tmMemberLoyalty", "tmMemberLoyalty", app="loyalty", columns=("fcuserid", "ftcreatedate", "ftupdatedate")),
        Source("dim_party", "dim_party", kind=WAREHOUSE, schema=DIM_PARTY),
        Source("tmmobileuser", "tmmobileuser", columns=("fcphoneno", "fcuserid", "fnnatid"), kind=LATEST,
               keys=("fcuserid",)),
        Source("tmShareFriend", "tmShareFriend", app="loyalty", columns=("fcuserid", "fcfrienduserid"), kind=LATEST,
               keys=("fcuserid", "fcfrienduserid")),
    ), build_dim_party_memberstatus, DIM_PARTY),
]
