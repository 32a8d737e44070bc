"""Project tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tamarind import functions as fn
from tamarind.functions.codes import (
    BOOKBANK_TYPE, BOOKBANK_USETYPE, FLAG_UPPER_YN_TF, FLAG_YN, FLAG_YN_TF, PCL_PATTERN_TH_ONLY,
    PROJECT_TYPE,
)
from tamarind.operators import (
    PLACE, blank_strings_to_null, col_or, lookup_join, lower_columns, pack_flags, placed_join,
    streamed_join, suffix_columns, unpack_flag, unpivot_groups, with_audit,
)
from tamarind.plans.common import AUDIT, finish, schema
from tamarind.plans.company import (
    build_invitation_history, build_invitation_link, history_schema, invitation_schema, PMS,
)
from tamarind.sources.lake import tasks_by_rows
from tamarind.sources.warehouse import project_with_default
from tamarind.spec import LATEST, Source, TableSpec, WAREHOUSE

DIM_PMSPROJECT = schema(f"""{AUDIT}, date_id:date, project_id:long, project_cd:str, project_nm_th:str,
    project_nm_en:str, ref_pmsproject_id:str, is_active:str, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts,
    updt_by:str, updt_dttm:ts""")
FACT_INV_PROJECT = invitation_schema("project", True)
FACT_INVHIST_PROJECT = history_schema("project")


def build_dim_pmsproject(src: dict, ctx):
    """PMS projects."""
    df = src["projects"]
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_ts(fn.coalesce_first("updated_at", "created_at")).alias("date_id"),
        F.col("id").cast("bigint").alias("project_id"), F.col("code").alias("project_cd"),
        F.col("name_th").alias("project_nm_th"), F.col("name_en").alias("project_nm_en"),
        F.col("pms_project_id").alias("ref_pmsproject_id"), "is_active", F.lit("1").alias("rec_actv_flag"),
        F.col("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"),
        F.col("updated_by").alias("updt_by"), fn.to_ts("updated_at").alias("updt_dttm"),
    )
    return finish(df, DIM_PMSPROJECT)


SPECS = [
    TableSpec("dim_pmsproject", "dim_pmsproject", ("date_id", "project_id"),
              (Source("projects", "projects", **PMS),), build_dim_pmsproject, DIM_PMSPROJECT, full_default=True),
    TableSpec("fact_pmsinvitation_project", "fact_pmsinvitation_project", ("date_id", "record_id"), (
        Source("invitation_projects", "invitation_projects", **PMS),
        Source("invitations", "invitations", kind=LATEST, keys=("id",), **PMS),
    ), build_invitation_link("project", True), FACT_INV_PROJECT),
    TableSpec("fact_pmsinvitationhist_project", "fact_pmsinvitationhist_project", ("date_id", "record_id"),
              (Source("project_audit_logs", "project_audit_logs", **PMS),),
              build_invitation_history("project"), FACT_INVHIST_PROJECT),
]


DIM_ADDRESS_TYPE = schema(f"""{AUDIT}, addr_type_name_th:str, addr_type_name_en:str, rec_actv_flag:str,
    crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str, addr_type_id:long, date_id:date""")
DIM_POSTCODE = schema(f"""{AUDIT}, zip_cd:str, sub_dstc_th:str, sub_dstc_en:str, dstc_th:str, dstc_en:str,
    prvn_th:str, prvn_en:str, region_th:str, region_en:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str,
    updt_dttm:ts, updt_by:str, postcode_id:long, date_id:date""")
DIM_PROJECT_PROFILE = schema(f"""{AUDIT}, start_selling_price:long, selling_price_per_square_meter:long,
    project_status:str, segment_name:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts,
    updt_by:str, project_profile_id:str, date_id:date, corporate_type:str""")
DIM_PROJECT = schema(f"""{AUDIT}, project_code:str, project_name:str, unit:dbl, car_parking_slot:dbl,
    commonfee_amount_mavg:dbl, tax_id:str, type:str, address:str, subdistrict:str, district:str, province:str,
    postal_code:str, latitude:str, longtitude:str, pmc_id:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str,
    updt_dttm:ts, updt_by:str, project_id:str, project_profile_id:str, date_id:date, IsContractActive:str,
    corporate_Type:str, project_shortcode:str, phone_no:str""")


def build_dim_address_type(src: dict, ctx):
    """Address types (no distinct)."""
    df = lower_columns(src["tmMobileAddressType"])
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("fcaddressnameth").alias("addr_type_name_th"), F.col("fcaddressnameen").alias("addr_type_name_en"),
        fn.flag_map("fcisactive", FLAG_YN).alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"), F.col("fccreateby").alias("crtd_by"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"), fn.coalesce_first("fcupdateby", "fccreateby").alias("updt_by"),
        F.col("fnid").cast("bigint").alias("addr_type_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
    )
    return finish(df, DIM_ADDRESS_TYPE, distinct=False)


def build_dim_postcode(src: dict, ctx):
    """Post codes with cleaned place names."""
    df = lower_columns(src["tmPostCode"])
    names = {"fcpostcode": "zip_cd", "fcsubdistrictth": "sub_dstc_th", "fcsubdistricten": "sub_dstc_en",
             "fcdistrictth": "dstc_th", "fcdistricten": "dstc_en", "fcprovinceth": "prvn_th",
             "fcprovinceen": "prvn_en", "fcregionth": "region_th", "fcregionen": "region_en"}
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        *[fn.clean_str(k).alias(v) for k, v in names.items() if k in df.columns],
        F.col("fcisactive").alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"), F.col("fccreator").alias("crtd_by"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"), F.col("fcupdateby").alias("updt_by"),
        fn.to_long("fnid").alias("postcode_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
    )
    return finish(df, DIM_POSTCODE)


def build_dim_project_profile(src: dict, ctx):
    """Project profiles (segment, status, zero prices)."""
    df = lower_columns(src["tmCOM"])
    seg = fn.clean_str("fcname")
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.lit(0).cast("bigint").alias("start_selling_price"),
        F.lit(0).cast("bigint").alias("selling_price_per_square_meter"),
        F.col("fcisactive").alias("project_status"), seg.alias("segment_name"), F.lit("1").alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"), F.col("fccreator").alias("crtd_by"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"), fn.coalesce_first("fcupdateby", "fccreator").alias("updt_by"),
        F.col("fcid").alias("project_profile_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate")).alias("date_id"),
        fn.corporate_type(seg).alias("corporate_type"),
    )
    return finish(df, DIM_PROJECT_PROFILE)


def build_dim_project(src: dict, ctx):
    """Projects ⟕ newest company type; type label, address text, counts."""
    com = suffix_columns(src["tmCOM"], "_com")
    ct = suffix_columns(src["tmCOM_Type"].select("fcid", "fnitemno"), "_comtype")
    df = lookup_join(com, ct, "fcremark33_com", "fcid_comtype", "left", small=True)
    name = fn.clean_str("fcname_com")
    address = fn.strip(F.concat_ws(" ", fn.clean_str("fcaddr11_com"), fn.clean_str("fcaddr12_com"),
                                   fn.clean_str("fcaddr13_com")))
    none = F.lit(None).cast("string")
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("fccode_com").alias("project_code"), name.alias("project_name"),
        fn.to_double("fntotalunit_com", 0.0).alias("unit"), fn.to_double("fntotalcarpark_com", 0.0).alias("car_parking_slot"),
        F.lit(None).cast("double").alias("commonfee_amount_mavg"), F.col("fctaxid_com").alias("tax_id"),
        fn.map_values("fnitemno_comtype", PROJECT_TYPE).alias("type"), address.alias("address"),
        none.alias("subdistrict"), none.alias("district"), none.alias("province"), none.alias("postal_code"),
        F.col("fcremark34_com").alias("latitude"), F.col("fcremark35_com").alias("longtitude"),
        F.col("fcremark32_com").alias("pmc_id"),
        fn.flag_map("fcisactive_com", FLAG_UPPER_YN_TF, case="upper").alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate_com").alias("crtd_dttm"), F.col("fccreator_com").alias("crtd_by"),
        fn.to_ts("ftupdatedate_com").alias("updt_dttm"), F.col("fcupdateby_com").alias("updt_by"),
        F.col("fcid_com").alias("project_id"), F.col("fcid_com").alias("project_profile_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate_com", "ftcreatedate_com")).alias("date_id"),
        none.alias("IsContractActive"), fn.corporate_type(name, PCL_PATTERN_TH_ONLY).alias("corporate_Type"),
        F.col("fccomshortcode_com").alias("project_shortcode"), F.col("fctel_com").alias("phone_no"),
    )
    return finish(df, DIM_PROJECT)


_COM_COLS = ("fcid", "fccode", "fcname", "fctaxid", "fcremark32", "fcremark33", "fcremark34", "fcremark35", "fcaddr11",
             "fcaddr12", "fcaddr13", "fntotalunit", "fntotalcarpark", "fcisactive", "ftcreatedate", "fccreator",
             "ftupdatedate", "fcupdateby", "fccomshortcode", "fctel")
SPECS += [
    TableSpec("dim_address_type", "dim_address_type", ("date_id", "addr_type_id"),
              (Source("tmMobileAddressType", "tmMobileAddressType"),), build_dim_address_type, DIM_ADDRESS_TYPE,
              full_default=True),
    TableSpec("dim_postcode", "dim_postcode", ("date_id", "postcode_id"),
              (Source("tmPostCode", "tmPostCode", columns=(
                  "fnid", "fcpostcode", "fcsubdistrictth", "fcsubdistricten", "fcdistrictth", "fcdistricten",
                  "fcprovinceth", "fcprovinceen", "fcregionth", "fcregionen", "fcisactive", "ftcreatedate",
                  "fccreator", "ftupdatedate", "fcupdateby")),), build_dim_postcode, DIM_POSTCODE, full_default=True),
    TableSpec("dim_project_profile", "dim_project_profile", ("date_id", "project_profile_id"),
              (Source("tmCOM", "tmCOM", columns=("fcid", "fcname", "fcisactive", "ftcreatedate", "fccreator",
                                                 "ftupdatedate", "fcupdateby")),),
              build_dim_project_profile, DIM_PROJECT_PROFILE, full_default=True),
    TableSpec("dim_project", "dim_project", ("date_id", "project_id", "project_profile_id"), (
        Source("tmCOM", "tmCOM", columns=_COM_COLS),
        Source("tmCOM_Type", "tmCOM_Type", columns=("fcid", "fnitemno", "fccode", "fcname", "fcisactive"),
               kind=LATEST, keys=("fcid",)),
    ), build_dim_project, DIM_PROJECT),
]


DIM_PMSROLE_PERMISSION = schema(f"""{AUDIT}, date_id:date, record_id:long, role_id:long, module_id:long,
    is_all:bool, is_view:bool, is_create:bool, is_edit:bool, is_print:bool, is_approve:bool, is_cancel:bool,
    is_allowed:bool, pmscompany_id:long, pmsproject_id:long, role_cd:str, role_nm_th:str, role_nm_en:str,
    role_category:str, role_desc:str, role_issystem:bool, role_isactive:bool, role_crtd_by:str, role_crtd_dttm:ts,
    role_updt_by:str, role_updt_dttm:ts, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")
FACT_PMSCOMPANY_PROJECTS = schema(f"""{AUDIT}, date_id:date, mapping_log_id:long, mapping_id:long, company_id:long,
    company_cd:str, company_nm_th:str, project_id:long, ref_pmsproject_id:str, pmsproject_nm_th:str, status_nm:str,
    rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")
FACT_PMSPROJECT_FEATURES = schema(f"""{AUDIT}, date_id:date, project_id:long, feature_id:long, feature_enabled:str,
    company_id:long, rec_actv_flag:str, crtd_by:str, crtd_dttm:ts, updt_by:str, updt_dttm:ts""")

# fixed values: columns of the source and target tables
PERMISSIONS = [("can_all", "is_all"), ("can_view", "is_view"), ("can_create", "is_create"), ("can_edit", "is_edit"),
               ("can_print", "is_print"), ("can_approve", "is_approve"), ("can_cancel", "is_cancel"),
               ("allowed", "is_allowed")]


def build_dim_pmsrole_permission(src: dict, ctx):
    """Role permissions ⟕ the day's roles (null id matches null id, J11). Each side is
    cleaned before they meet, a role once instead of once for each of its permissions. Permissions
    go through one shuffle, without the columns of their role: equal rows of the result have equal
    role numbers, so the join's tasks make the distinct too."""
    given = blank_strings_to_null(src["role_permissions"], but=("role_id",))
    permission = given.select(
        F.col("role_id").alias("role_key"),
        fn.date_id_from_ts(fn.coalesce_first("created_at", "updated_at")).alias("date_id"),
        fn.to_long("id").alias("record_id"), fn.to_long("role_id").alias("role_id"),
        fn.to_long("module_permission_id").alias("module_id"),
        pack_flags([fn.norm_bool(old) for old, _ in PERMISSIONS]).alias("flags"),
        F.col("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"),
        F.col("updated_by").alias("updt_by"), fn.to_ts("updated_at").alias("updt_dttm"))
    role = blank_strings_to_null(src["roles"], but=("id",)).select(
        F.col("id").alias("key_of_role"), fn.to_long("id").alias("number_of_role"),
        fn.to_long("company_id").alias("pmscompany_id"), fn.to_long("project_id").alias("pmsproject_id"),
        F.col("code").alias("role_cd"), F.col("name_th").alias("role_nm_th"), F.col("name_en").alias("role_nm_en"),
        F.col("category").alias("role_category"), F.col("description").alias("role_desc"),
        fn.norm_bool("is_system").alias("role_issystem"), fn.norm_bool("is_active").alias("role_isactive"),
        F.col("created_by").alias("role_crtd_by"), fn.to_ts("created_at").alias("role_crtd_dttm"),
        F.col("updated_by").alias("role_updt_by"), fn.to_ts("updated_at").alias("role_updt_dttm"))
    df = placed_join(permission, role, "role_key", "key_of_role", "role_id", "number_of_role", tasks_by_rows(given))
    own = [F.col(f.name).cast(f.dataType).alias(f.name) for f in DIM_PMSROLE_PERMISSION if f.name in df.columns]
    df = df.select(*own, "flags", PLACE).distinct()
    df = df.withColumns({new: unpack_flag("flags", i) for i, (_, new) in enumerate(PERMISSIONS)})
    return finish(with_audit(df, ctx.run_ts).withColumn("rec_actv_flag", F.lit("1")), DIM_PMSROLE_PERMISSION, distinct=False)


def build_fact_pmscompany_projects(src: dict, ctx):
    """Mapping log ⟕ newest company ⟕ newest project, each cleaned before the join. Only the
    distinct at the end holds log rows in memory, and its tasks go by the number of them."""
    log = src["companies_projects_logs"]
    status = fn.clean_str(col_or(log, "action_type"))
    log = blank_strings_to_null(log, but=("company_id", "project_id")).select(
        F.col("company_id").alias("company_key"), F.col("project_id").alias("project_key"),
        fn.date_id_from_ts("created_at").alias("date_id"), fn.to_long("id").alias("mapping_log_id"),
        fn.to_long("company_project_id").alias("mapping_id"), fn.to_long("company_id").alias("company_id"),
        fn.to_long("project_id").alias("project_id"), status.alias("status_nm"),
        F.col("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"))
    company, project = src["companies"], src["projects"]
    company = company.select(F.col("id").alias("key_of_company"), fn.clean_str(col_or(company, "code")).alias("company_cd"),
                             fn.clean_str(col_or(company, "name_th")).alias("company_nm_th"))
    project = project.select(F.col("id").alias("key_of_project"), fn.blank_to_null("pms_project_id").alias("ref_pmsproject_id"),
                             fn.clean_str(col_or(project, "name_th")).alias("pmsproject_nm_th"))
    df = streamed_join(log, company, "company_key", "key_of_company")
    df = streamed_join(df, project, "project_key", "key_of_project")
    # a row without a company or project has blank names
    names = {c: F.coalesce(c, F.lit("")) for c in ("company_cd", "company_nm_th", "pmsproject_nm_th")}
    df = with_audit(df.withColumns(names), ctx.run_ts).withColumns({
        "rec_actv_flag": F.lit("1"), "updt_by": F.lit(None).cast("string"), "updt_dttm": F.lit(None).cast("timestamp_ntz")})
    return finish(df, FACT_PMSCOMPANY_PROJECTS, tasks=tasks_by_rows(log),
                  same=("dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note", "rec_actv_flag", "updt_by", "updt_dttm"))


def build_fact_pmsproject_features(src: dict, ctx):
    """Features ⟕ the newest mapping per *company*, joined on the project (D13);
    null project ids match each other (J11)."""
    cp = suffix_columns(src["companies_projects"], "_company")
    df = blank_strings_to_null(lookup_join(src["project_features"], cp, "project_id", "project_id_company",
                                           "left", null_safe=True))
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_ts(fn.coalesce_first("updated_at", "created_at")).alias("date_id"),
        fn.to_long("project_id").alias("project_id"), fn.to_long("feature_id").alias("feature_id"),
        fn.clean_str(col_or(df, "enabled")).alias("feature_enabled"),
        fn.to_long("company_id_company").alias("company_id"), F.lit("1").alias("rec_actv_flag"),
        fn.clean_str("created_by").alias("crtd_by"), fn.to_ts("created_at").alias("crtd_dttm"),
        fn.clean_str("updated_by").alias("updt_by"), fn.to_ts("updated_at").alias("updt_dttm"),
    )
    return finish(df, FACT_PMSPROJECT_FEATURES)


SPECS += [
    TableSpec("dim_pmsrole_permission", "dim_pmsrole_permission", ("date_id", "record_id"), (
        Source("role_permissions", "role_permissions", dealt=True, **PMS),
        Source("roles", "roles", dealt=True, **PMS),
    ), build_dim_pmsrole_permission, DIM_PMSROLE_PERMISSION),
    TableSpec("fact_pmscompany_projects", "fact_pmscompany_projects", ("date_id", "mapping_log_id"), (
        Source("companies_projects_logs", "companies_projects_logs", **PMS),
        Source("companies", "companies", kind=LATEST, keys=("id",), **PMS),
        Source("projects", "projects", kind=LATEST, keys=("id",), **PMS),
    ), build_fact_pmscompany_projects, FACT_PMSCOMPANY_PROJECTS),
    TableSpec("fact_pmsproject_features", "fact_pmsproject_features", ("date_id", "project_id", "feature_id"), (
        Source("project_features", "project_features", **PMS),
        Source("companies_projects", "companies_projects", kind=LATEST, keys=("company_id",), **PMS),
    ), build_fact_pmsproject_features, FACT_PMSPROJECT_FEATURES),
]


DIM_ADDRESS = schema(f"""{AUDIT}, addr_no:str, sub_dstc:str, dstc:str, prvn:str, zip_cd:str, rec_actv_flag:str,
    crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str, ref_addr_id:str, party_id:str, addr_type_id:long,
    date_id:date, addr_id:str""")

# fixed values: addr_type_id -> (addr1, addr3, sub-district, district, zip) of each address group
ADDRESS_GROUPS = {
    5: ("fcaddress1", "fcaddress3", "fcaddresssubdistrict", "fcaddressdistrict", "fczipcode"),
    3: ("fcshipaddr1", "fcshipaddr3", "fcshipaddrsubdistrict", "fcshipaddrdistrict", "fcshipzipcode"),
    4: ("fcbilltoaddr1", "fcbilltoaddr3", "fcbilltoaddrsubdistrict", "fcbilltoaddrdistrict", "fcbilltozipcode"),
}


def build_dim_address(src: dict, ctx):
    """home/shipping/billing address groups of a party -> one row each (one scan),
    union-distinct; the key text is date + party + type."""
    df = lower_columns(src["tmCOR"])
    groups = {t: {"addr_no": a1, "prvn": a3, "sub_dstc": sub, "dstc": dist, "zip_cd": z}
              for t, (a1, a3, sub, dist, z) in ADDRESS_GROUPS.items()}
    common = ["fcid", "fcisactive", "ftcreatedate", "fccreator", "ftupdatedate", "fcupdateby"]
    rows = unpivot_groups(df, common, groups, tag_name="addr_type_id").distinct()
    date_id = fn.date_id_from_text(fn.coalesce_first("ftupdatedate", "ftcreatedate"))
    rows = with_audit(rows, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.first_token("addr_no").alias("addr_no"), "sub_dstc", "dstc", "prvn", "zip_cd",
        fn.flag_map("fcisactive", FLAG_YN_TF).alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate").alias("crtd_dttm"), F.col("fccreator").alias("crtd_by"),
        fn.to_ts("ftupdatedate").alias("updt_dttm"), fn.coalesce_first("fccreator", "fcupdateby").alias("updt_by"),
        F.lit(None).cast("string").alias("ref_addr_id"), F.col("fcid").alias("party_id"),
        F.col("addr_type_id").cast("bigint").alias("addr_type_id"), date_id.alias("date_id"),
        F.concat(date_id.cast("string"), F.col("fcid").cast("string"), F.col("addr_type_id").cast("string"))
        .alias("addr_id"),
    )
    return finish(rows, DIM_ADDRESS, distinct=False)


def build_dim_address_mobileuser(src: dict, ctx):
    """Mobile-user addresses ⟕ newest post code; no addr_id."""
    a = suffix_columns(lower_columns(src["tmMobileUser_Address"]), "_F")
    p = suffix_columns(lower_columns(src["tmPostCode"]).select(
        "fnid", "fcprovinceth", "fcdistrictth", "fcsubdistrictth", "fcpostcode"), "_P")
    df = lookup_join(a, p, "fnpostcodeid_F", "fnid_P", "left", small=True)
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        F.col("fcaddress_F").alias("addr_no"), F.col("fcsubdistrictth_P").alias("sub_dstc"),
        F.col("fcdistrictth_P").alias("dstc"), F.col("fcprovinceth_P").alias("prvn"),
        F.col("fcpostcode_P").alias("zip_cd"), fn.flag_map("fcisactive_F", FLAG_YN_TF).alias("rec_actv_flag"),
        fn.to_ts("ftcreatedate_F").alias("crtd_dttm"), F.col("fccreateby_F").alias("crtd_by"),
        fn.to_ts("ftupdatedate_F").alias("updt_dttm"), fn.coalesce_first("fccreateby_F", "fcupdateby_F").alias("updt_by"),
        F.col("fnid_F").cast("string").alias("ref_addr_id"), F.col("fcmobileuserid_F").cast("string").alias("party_id"),
        F.col("fcaddrtype_F").cast("int").cast("bigint").alias("addr_type_id"),
        fn.date_id_from_text(fn.coalesce_first("ftupdatedate_F", "ftcreatedate_F")).alias("date_id"),
        F.lit(None).cast("string").alias("addr_id"),
    )
    return finish(df, DIM_ADDRESS, distinct=False)


_COR_ADDR = ("fcid", "fcaddress1", "fcaddress2", "fcaddress3", "fcaddresssubdistrict", "fcaddressdistrict", "fczipcode",
             "fcshipaddr1", "fcshipaddr2", "fcshipaddr3", "fcshipaddrsubdistrict", "fcshipaddrdistrict", "fcshipzipcode",
             "fcbilltoaddr1", "fcbilltoaddr2", "fcbilltoaddr3", "fcbilltoaddrsubdistrict", "fcbilltoaddrdistrict",
             "fcbilltozipcode", "fcisactive", "ftcreatedate", "fccreator", "ftupdatedate", "fcupdateby")
SPECS += [
    TableSpec("dim_address", "dim_address", ("date_id", "addr_id"),
              (Source("tmCOR", "tmCOR", columns=_COR_ADDR),), build_dim_address, DIM_ADDRESS, append=True),
    TableSpec("dim_address_mobileuser", "dim_address", ("date_id", "addr_id"), (
        Source("tmMobileUser_Address", "tmMobileUser_Address", columns=(
            "fnid", "fcmobileuserid", "fcaddrtype", "fcaddress", "fnpostcodeid", "fcisactive", "fccreateby",
            "ftcreatedate", "fcupdateby", "ftupdatedate")),
        Source("tmPostCode", "tmPostCode", columns=("fnid", "fcprovinceth", "fcdistrictth", "fcsubdistrictth",
                                                    "fcpostcode"), kind=LATEST, keys=("fnid",)),
    ), build_dim_address_mobileuser, DIM_ADDRESS, append=True),
]


DIM_PROJECT_BOOKBANK = schema(f"""{AUDIT}, date_id:date, bookbank_id:str, bookbank_cd:str, bookbank_nm:str,
    bookbank_no:str, project_id:str, project_code:str, project_name:str, bank_id:str, bank_cd:str, bank_nm:str,
    account_id:str, account_cd:str, account_nm:str, accountod_id:str, accountod_cd:str, accountod_nm:str,
    bookbank_branch:str, bookbank_type:str, bookbank_usetype:str, opening_dttm:ts, numofdepositdays:long,
    duedate_dttm:ts, balance_amt:dbl, remark_nm:str, deposit_nm:str, interest_rate:str, objective:str,
    account_istransfer:str, rec_actv_flag:str, crtd_dttm:ts, crtd_by:str, updt_dttm:ts, updt_by:str""")
ERA_MAX_TS_YEAR = 2262  # the last year of a pandas timestamp: later years are Buddhist


def build_dim_project_bookbank(src: dict, ctx):
    """Bank books ⟕ newest branch ⟕ project (warehouse, newest, plus the '(not set)'
    row; only the branches' projects, by semi join) ⟕ bank ⟕ account ⟕ overdraft account
    (the same lookup in a second role, J5).  D23: a null update date falls back."""
    bkb = suffix_columns(lower_columns(src["tmBKB"]), "_BKB")
    brn = suffix_columns(lower_columns(src["tmBRN"]).select("fcid", "fccomid"), "_BRN")
    bnk = suffix_columns(lower_columns(src["tmBNK"]).select("fcid", "fccode", "fcname"), "_BNK")
    acc = lower_columns(src["tmACC"]).select("fcid", "fccode", "fcname")
    wanted = (bkb.select(F.col("fcbrnid_BKB").alias("fcid_BRN")).distinct()
              .join(brn, "fcid_BRN").select("fccomid_BRN").distinct())
    pro = suffix_columns(project_with_default(src["dim_project"], wanted), "_PRO")
    df = lookup_join(bkb, brn, "fcbrnid_BKB", "fcid_BRN", "left", small=True)
    df = lookup_join(df, pro, "fccomid_BRN", "project_id_PRO", "left", small=True)
    df = lookup_join(df, bnk, "fcbnkid_BKB", "fcid_BNK", "left", small=True)
    df = lookup_join(df, suffix_columns(acc, "_ACC"), "fcaccid_BKB", "fcid_ACC", "left", small=True)
    df = lookup_join(df, suffix_columns(acc, "_AOD"), "fcod_accid_BKB", "fcid_AOD", "left", small=True)
    era = lambda c: fn.be_to_ce(c, ERA_MAX_TS_YEAR)
    crt, upd = era("ftcreatedate_BKB"), era("ftupdatedate_BKB")
    cl = fn.clean_str
    df = with_audit(df, ctx.run_ts).select(
        "dwh_crtd_dttm", "dwh_updt_dttm", "dwh_note",
        fn.date_id_from_text(F.coalesce(upd, crt)).alias("date_id"),
        F.col("fcid_BKB").alias("bookbank_id"), cl("fccode_BKB").alias("bookbank_cd"), cl("fcname_BKB").alias("bookbank_nm"),
        cl("fcbookno_BKB").alias("bookbank_no"), F.col("project_id_PRO").alias("project_id"),
        cl("project_code_PRO").alias("project_code"), cl("project_name_PRO").alias("project_name"),
        F.col("fcid_BNK").alias("bank_id"), cl("fccode_BNK").alias("bank_cd"), cl("fcname_BNK").alias("bank_nm"),
        F.col("fcid_ACC").alias("account_id"), cl("fccode_ACC").alias("account_cd"), cl("fcname_ACC").alias("account_nm"),
        F.col("fcid_AOD").alias("accountod_id"), cl("fccode_AOD").alias("accountod_cd"),
        cl("fcname_AOD").alias("accountod_nm"), cl("fcbankbrname_BKB").alias("bookbank_branch"),
        fn.map_values("fcbankbooktype_BKB", BOOKBANK_TYPE).alias("bookbank_type"),
        fn.map_values("fcbankbookusetype_BKB", BOOKBANK_USETYPE).alias("bookbank_usetype"),
        fn.to_ts(era("ftbegdate_BKB")).alias("opening_dttm"), fn.to_long("fnday_BKB").alias("numofdepositdays"),
        fn.to_ts(era("ftduedate_BKB")).alias("duedate_dttm"), fn.to_double("fnbalamt_BKB").alias("balance_amt"),
        cl("fcremark1_BKB").alias("remark_nm"), cl("fcremark2_BKB").alias("deposit_nm"),
        F.col("fcremark3_BKB").alias("interest_rate"), cl("fcremark4_BKB").alias("objective"),
        F.col("fcremark5_BKB").alias("account_istransfer"),
        fn.flag_map("fcisactive_BKB", FLAG_UPPER_YN_TF, case="upper").alias("rec_actv_flag"),
        fn.to_ts(crt).alias("crtd_dttm"), F.col("fccreator_BKB").alias("crtd_by"), fn.to_ts(upd).alias("updt_dttm"),
        fn.coalesce_first("fcupdateby_BKB", "fccreator_BKB").alias("updt_by"),
    )
    return finish(df, DIM_PROJECT_BOOKBANK)


_BKB_COLS = ("fcid", "fccode", "fcname", "fcbrnid", "fcbnkid", "fcaccid", "fcod_accid", "fcbookno", "fcbankbrname",
             "fcbankbooktype", "fcbankbookusetype", "ftbegdate", "fnday", "ftduedate", "fnbalamt", "fcremark1",
             "fcremark2", "fcremark3", "fcremark4", "fcremark5", "fcisactive", "fccreator", "ftcreatedate",
             "fcupdateby", "ftupdatedate")
SPECS += [
    TableSpec("dim_project_bookbank", "dim_project_bookbank", ("date_id", "bookbank_id"), (
        Source("tmBKB", "tmBKB", columns=_BKB_COLS),
        Source("tmBRN", "tmBRN", columns=("fcid", "fccomid"), kind=LATEST, keys=("fcid",)),
        Source("tmBNK", "tmBNK", columns=("fcid", "fccode", "fcname"), kind=LATEST, keys=("fcid",)),
        Source("tmACC", "tmACC", columns=("fcid", "fccode", "fcname"), kind=LATEST, keys=("fcid",)),
        Source("dim_project", "dim_project", kind=WAREHOUSE,
               schema="project_id string, project_code string, project_name string, date_id date"),
    ), build_dim_project_bookbank, DIM_PROJECT_BOOKBANK),
]
