"""Builder queries: each of the table builders over adapter inputs, with its oracle."""

from __future__ import annotations

from tamarind.context import RunContext
from tamarind.functions.codes import (BOOKBANK_TYPE, BOOKBANK_USETYPE, FLAG_LOWER_YN_TF, FLAG_UPPER_YN_TF, FLAG_YN,
                                      FLAG_YN_TF, GENDER, IS_DELETED, LIVING_TYPE)
from tamarind.queries import sqlfn as q
from tamarind.queries.adapters import ADAPTERS
from tamarind.queries.tables import RUN_TS, select
from tamarind.sources.lake import PART_COLS, deal_small_scan, latest_per_key
from tamarind.spec import HISTORY, LAKE, LATEST

from tamarind.plans import company, project, unit, user

CTX = RunContext(lake_root="", run_ts=RUN_TS)


def adapter_inputs(spark, sf_dir, spec, overrides: dict | None = None) -> dict:
    """Each declared source, read from its adapter; newest-per-key sources ranked by
    the library's own ``latest_per_key``."""
    overrides = overrides or {}
    out = {}
    for s in spec.sources:
        src = overrides.get(s.alias, s.table)
        if callable(src):  # a warehouse table that Spark derives from the test tables
            out[s.alias] = src(spark, sf_dir)
            continue
        df = select(spark, sf_dir, ADAPTERS[src])
        if s.kind == LATEST:
            df = latest_per_key(df, s.keys, tie=s.tie)
        if s.columns:
            df = df.select(*[c for c in s.columns if c in df.columns and c not in PART_COLS])
        if s.kind == HISTORY:
            df = df if s.repeats else df.distinct()
        elif s.kind == LAKE:
            df = deal_small_scan(df, s.dealt)
        out[s.alias] = df
    return out


def make(spec, overrides=None):
    def run(spark, sf_dir):
        return spec.build(adapter_inputs(spark, sf_dir, spec, overrides), CTX)
    run.spec, run.overrides = spec, overrides
    return run


def A(name: str) -> str:
    return f"({ADAPTERS[name]})"


def L(name: str, keys: str) -> str:
    return f"({q.latest(ADAPTERS[name], keys)})"


QUERIES: dict = {}
ORACLES: dict = {}

# ---------------------------------------------------------------- unit -----
QUERIES["b_dim_unit"] = make(unit.SPECS[0])
ORACLES["b_dim_unit"] = f"""
WITH r AS {A('tmRoomH')}, b AS {L('tmBRN', 'fcid')}
SELECT DISTINCT {q.AUDIT},
  CAST(NULL AS BIGINT) AS addr_id,
  {q.clean('r.fccode')} AS unit_number,
  {q.clean('r.fcaddressno')} AS room_number,
  {q.to_double('r.fcownerratio', 0.0)} AS own_area_ratio,
  {q.case_map('r.fcleveingtype', LIVING_TYPE)} AS living_type,
  {q.case_map('upper(r.fcisactive)', FLAG_UPPER_YN_TF)} AS rec_actv_flag,
  {q.to_ts('r.ftcreatedate')} AS crtd_dttm, r.fccreateby AS crtd_by,
  {q.to_ts('r.ftupdatedate')} AS updt_dttm, coalesce(r.fcupdateby, r.fccreateby) AS updt_by,
  r.fcid AS unit_id, b.fccomid AS project_id,
  {q.date_text('coalesce(r.ftupdatedate, r.ftcreatedate)')} AS date_id
FROM r LEFT JOIN b ON r.fcbrnid = b.fcid"""

QUERIES["b_fact_unit"] = make(unit.SPECS[1])
ORACLES["b_fact_unit"] = f"""
WITH r AS {A('tmRoomH')}, b AS {L('tmBRN', 'fcid')},
owners AS (
  SELECT fcbrnid, fcid, fttransferdate, ftdatein, ftdateout, fcleveingtype, fcisactive, ftcreatedate, fccreateby,
         ftupdatedate, fcupdateby, fcownerid AS ownerid FROM r
  UNION ALL SELECT fcbrnid, fcid, fttransferdate, ftdatein, ftdateout, fcleveingtype, fcisactive, ftcreatedate, fccreateby,
         ftupdatedate, fcupdateby, fcownerid2 FROM r
  UNION ALL SELECT fcbrnid, fcid, fttransferdate, ftdatein, ftdateout, fcleveingtype, fcisactive, ftcreatedate, fccreateby,
         ftupdatedate, fcupdateby, fcownerid3 FROM r
  UNION ALL SELECT fcbrnid, fcid, fttransferdate, ftdatein, ftdateout, fcleveingtype, fcisactive, ftcreatedate, fccreateby,
         ftupdatedate, fcupdateby, fccurrentownerid FROM r
)
SELECT DISTINCT {q.AUDIT},
  {q.to_ts(q.be_to_ce('x.fttransferdate', 2500))} AS transfer_date,
  {q.to_ts(q.be_to_ce('x.ftdatein', 2500))} AS move_in_date,
  {q.to_ts(q.be_to_ce('x.ftdateout', 2500))} AS move_out_date,
  {q.clean(q.case_map(q.strip('x.fcleveingtype'), LIVING_TYPE))} AS resident_type,
  {q.case_map('lower(x.fcisactive)', FLAG_LOWER_YN_TF)} AS rec_actv_flag,
  {q.to_ts('x.ftcreatedate')} AS crtd_dttm, {q.clean('x.fccreateby')} AS crtd_by,
  {q.to_ts('x.ftupdatedate')} AS updt_dttm, {q.clean('x.fcupdateby')} AS updt_by,
  {q.clean('x.fcid')} AS unit_id, {q.clean('b.fccomid')} AS project_id, {q.clean('x.ownerid')} AS party_id,
  {q.date_ts('coalesce(x.ftupdatedate, x.ftcreatedate)')} AS date_id
FROM owners x LEFT JOIN b ON x.fcbrnid = b.fcid
WHERE x.ownerid IS NOT NULL AND {q.strip('x.ownerid')} <> ''"""


# ---------------------------------------------------------------- user -----
QUERIES["b_fact_authuser"] = make(user.SPECS[0], {"users": "auth_users"})
ORACLES["b_fact_authuser"] = f"""
WITH u AS (SELECT {q.nullif_all('id, mobile_user_id, phone_number, country_code, is_deleted, created_time, updated_time')},
  calendar_year, month_no, day_of_month FROM {A('auth_users')})
SELECT DISTINCT {q.AUDIT}, make_date(calendar_year, month_no, day_of_month) AS date_id, {q.to_long('id')} AS auth_id,
  mobile_user_id, {q.clean('phone_number')} AS phone_number, {q.clean('country_code')} AS country_code,
  CASE WHEN is_deleted IS NULL THEN '0' ELSE {q.case_map('lower(is_deleted)', IS_DELETED)} END AS is_deleted,
  '1' AS rec_actv_flag, {q.to_ts('created_time')} AS crtd_dttm, CAST(NULL AS VARCHAR) AS crtd_by,
  {q.to_ts('updated_time')} AS updt_dttm, CAST(NULL AS VARCHAR) AS updt_by
FROM u"""

_PARTY_NULLS = ("titl_th, frst_nm_th, last_nm_th, titl_en, frst_nm_en, last_nm_en, th_id, passport_no, cnty_cd, mob_no, "
                "email, edu, occu, income_range, mrtl_sts, rlgn, gndr, fam_size, mem_ref_code, mem_sts, nationality_id")
_CRT = "TRY_CAST(create_date AS DOUBLE)"
_UPD = "TRY_CAST(update_date AS DOUBLE)"
QUERIES["b_dim_party_homeservice"] = make(user.SPECS[1])
ORACLES["b_dim_party_homeservice"] = f"""
WITH p AS (SELECT *, coalesce(provider_name, registered_name) AS full_nm,
  {q.epoch(_CRT)} AS crtd, {q.epoch(f'coalesce({_UPD}, {_CRT})')} AS updt FROM {A('seekster_provider')})
SELECT {q.AUDIT}, full_nm AS full_nm_th, full_nm AS full_nm_en, {q.nulls(_PARTY_NULLS)},
  CAST(NULL AS TIMESTAMP) AS dob, CAST(NULL AS TIMESTAMP) AS mem_crtd_dttm, CAST(NULL AS BIGINT) AS age,
  CAST(NULL AS DOUBLE) AS totl_kid, CAST(NULL AS DOUBLE) AS totl_eldr,
  CASE WHEN lower(is_active) IN ('true', '1') THEN '1' WHEN lower(is_active) IN ('false', '0') THEN '0' END AS rec_actv_flag,
  crtd AS crtd_dttm, create_by AS crtd_by, updt AS updt_dttm, coalesce(update_by, create_by) AS updt_by,
  CAST(4 AS BIGINT) AS party_type_id, provider_id AS party_id,
  CASE WHEN coalesce(regexp_matches(full_nm, 'มหาชน|PCL'), FALSE) THEN 'PCL' ELSE 'LOCAL' END AS corporate_type,
  {q.date_text('CAST(coalesce(updt, crtd) AS STRING)')} AS date_id
FROM p"""

QUERIES["b_fact_user"] = make(user.SPECS[2])
ORACLES["b_fact_user"] = f"""
SELECT DISTINCT {q.AUDIT},
  {q.date_text(q.be_to_ce('coalesce(ftupdatedate, ftcreatedate)', 2400), 2)} AS date_id,
  {q.clean('fcid')} AS user_id, {q.clean('fcusgid')} AS usergroup_id, {q.clean('fccode')} AS user_cd,
  {q.clean('fcname')} AS user_nm, {q.case_map('upper(fcisactive)', FLAG_YN)} AS user_status,
  CAST(NULL AS VARCHAR) AS rec_actv_flag,
  {q.to_ts(q.be_to_ce('ftcreatedate', 2400))} AS crtd_dttm, {q.clean('fccreator')} AS crtd_by,
  {q.to_ts(q.be_to_ce('ftupdatedate', 2400))} AS updt_dttm,
  coalesce(NULLIF({q.clean('fcupdateby')}, ''), {q.clean('fccreator')}) AS updt_by
FROM {A('tmUSR')}"""

QUERIES["b_fact_unitresident"] = make(user.SPECS[3])
ORACLES["b_fact_unitresident"] = f"""
WITH h AS (SELECT {q.nullif_all('fcid, fcroomid, fccornewrentalid, fcisactive, fctype, ftdatein, ftdateout, ftcreatedate, fccreator, ftupdatedate, fcupdateby')}
  FROM {A('ttCORHist')})
SELECT DISTINCT {q.AUDIT}, DATE '2025-01-01' AS date_id,
  {q.clean('fcid')} AS corhist_id, {q.clean('fcroomid')} AS unit_id, {q.clean('fccornewrentalid')} AS party_id,
  {q.clean('fctype')} AS resident_type,
  {q.to_ts(q.be_to_ce('ftdatein', 2400))} AS move_in_date, {q.to_ts(q.be_to_ce('ftdateout', 2400))} AS move_out_date,
  {q.clean('fcisactive')} AS hisrory_status, '1' AS rec_actv_flag,
  {q.to_ts(q.be_to_ce('ftcreatedate', 2400))} AS crtd_dttm, {q.clean('fccreator')} AS crtd_by,
  {q.to_ts(q.be_to_ce('ftupdatedate', 2400))} AS updt_dttm, {q.clean('fcupdateby')} AS updt_by
FROM h"""


# ----------------------------------------------------------------- pms -----
_BOOL_T = "('true', '1', 't', 'y', 'yes', 'active')"
_BOOL_F = "('false', '0', 'f', 'n', 'no', 'inactive')"


def _bool(x):
    s_ = f"lower({q.strip(x)})"
    return f"(CASE WHEN {s_} IN {_BOOL_T} THEN TRUE WHEN {s_} IN {_BOOL_F} THEN FALSE END)"


def _tok(x, toks=("None", "nan", "<NA>")):
    lst = ", ".join(f"'{t}'" for t in toks)
    return f"(CASE WHEN {x} IS NULL OR {x} IN ({lst}) THEN '' ELSE {x} END)"


QUERIES["b_fact_pmsinvitations"] = make(user.SPECS[4])
ORACLES["b_fact_pmsinvitations"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.date_ts('created_at')} AS date_id, id AS invite_id,
  {q.clean('email')} AS invite_email, {q.clean('status')} AS invite_status, {q.to_ts('expires_at')} AS expired_dttm,
  '1' AS rec_actv_flag, {q.to_ts('created_at')} AS crtd_dttm, invited_by AS crtd_by,
  {q.to_ts('created_at')} AS updt_dttm, invited_by AS updt_by
FROM {A('invitations')}"""

QUERIES["b_fact_pmsuser_role"] = make(user.SPECS[5])
ORACLES["b_fact_pmsuser_role"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.date_ts('coalesce(updated_at, created_at)')} AS date_id,
  coalesce({q.to_long('id')}, 0) AS record_id, coalesce({q.to_long('user_id')}, 0) AS user_id,
  coalesce({q.to_long('role_id')}, 0) AS role_id, coalesce({q.to_long('company_id')}, 0) AS pmscompany_id,
  coalesce({q.to_long('project_id')}, 0) AS pmsproject_id, {_bool('is_active')} AS is_active,
  '1' AS rec_actv_flag, {q.clean('created_by')} AS crtd_by, {q.to_ts('created_at')} AS crtd_dttm,
  {q.clean('updated_by')} AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM {A('user_roles')}"""

QUERIES["b_dim_pmscompany"] = make(company.SPECS[0])
ORACLES["b_dim_pmscompany"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.date_text('coalesce(updated_at, created_at)')} AS date_id,
  CAST(id AS BIGINT) AS company_id, code AS company_cd, name_th AS company_nm_th,
  {_tok('name_en', ('nan',))} AS company_nm_en, is_active, '1' AS rec_actv_flag,
  {_tok('created_by')} AS crtd_by, {q.to_ts('created_at')} AS crtd_dttm,
  {_tok('updated_by')} AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM {A('companies')}"""


def _inv_link(entity, link, role):
    role_sql = f", {q.to_long('role_id')} AS role_id" if role else ""
    return f"""
WITH j AS (SELECT l.*, i.email AS email_i, i.invited_by AS invited_by_i
  FROM {A(link)} l LEFT JOIN {L('invitations', 'id')} i ON l.invitation_id = i.id),
n AS (SELECT id, invitation_id, NULLIF({entity}_id, '') AS {entity}_id, NULLIF(status, '') AS status,
  NULLIF(responded_at, '') AS responded_at, NULLIF(email_i, '') AS email_i, NULLIF(invited_by_i, '') AS invited_by_i
  {", NULLIF(role_id, '') AS role_id" if role else ""} FROM j)
SELECT DISTINCT {q.AUDIT}, {q.date_ts('responded_at')} AS date_id, id AS record_id, invitation_id AS invite_id,
  {q.to_long(entity + '_id')} AS pms{entity}_id, {q.clean('status')} AS invite_status,
  {q.clean('invited_by_i')} AS invite_by, {q.clean('email_i')} AS invite_email, '1' AS rec_actv_flag,
  {q.to_ts('responded_at')} AS crtd_dttm, CAST(NULL AS VARCHAR) AS crtd_by,
  {q.to_ts('responded_at')} AS updt_dttm, CAST(NULL AS VARCHAR) AS updt_by{role_sql}
FROM n"""


def _inv_hist(entity):
    return f"""
SELECT DISTINCT {q.AUDIT}, {q.date_ts('created_at')} AS date_id, {q.to_long('id')} AS record_id,
  {q.to_long(entity + '_id')} AS pms{entity}_id, {q.clean('action_type')} AS action_type,
  {q.clean('description')} AS "desc", {q.clean('target_email')} AS action_email, {q.clean('reason')} AS reason,
  '1' AS rec_actv_flag, created_by AS crtd_by, {q.to_ts('created_at')} AS crtd_dttm,
  created_by AS updt_by, {q.to_ts('created_at')} AS updt_dttm
FROM {A(entity + '_audit_logs')}"""


QUERIES["b_fact_pmsinvitation_company"] = make(company.SPECS[1])
ORACLES["b_fact_pmsinvitation_company"] = _inv_link("company", "invitation_companies", False)
QUERIES["b_fact_pmsinvitationhist_company"] = make(company.SPECS[2])
ORACLES["b_fact_pmsinvitationhist_company"] = _inv_hist("company")
QUERIES["b_fact_pmsinvitation_project"] = make(project.SPECS[1])
ORACLES["b_fact_pmsinvitation_project"] = _inv_link("project", "invitation_projects", True)
QUERIES["b_fact_pmsinvitationhist_project"] = make(project.SPECS[2])
ORACLES["b_fact_pmsinvitationhist_project"] = _inv_hist("project")

QUERIES["b_dim_pmsproject"] = make(project.SPECS[0])
ORACLES["b_dim_pmsproject"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.date_ts('coalesce(updated_at, created_at)')} AS date_id,
  CAST(id AS BIGINT) AS project_id, code AS project_cd, name_th AS project_nm_th, name_en AS project_nm_en,
  pms_project_id AS ref_pmsproject_id, is_active, '1' AS rec_actv_flag, created_by AS crtd_by,
  {q.to_ts('created_at')} AS crtd_dttm, updated_by AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM {A('projects')}"""


# ------------------------------------------------------------- project -----
from tamarind.functions.codes import PROJECT_TYPE as _PT  # noqa: E402

QUERIES["b_dim_address_type"] = make(project.SPECS[3])
ORACLES["b_dim_address_type"] = f"""
SELECT {q.AUDIT}, fcaddressnameth AS addr_type_name_th, fcaddressnameen AS addr_type_name_en,
  {q.case_map('fcisactive', FLAG_YN)} AS rec_actv_flag, {q.to_ts('ftcreatedate')} AS crtd_dttm,
  fccreateby AS crtd_by, {q.to_ts('ftupdatedate')} AS updt_dttm, coalesce(fcupdateby, fccreateby) AS updt_by,
  CAST(fnid AS BIGINT) AS addr_type_id, {q.date_text('coalesce(ftupdatedate, ftcreatedate)')} AS date_id
FROM {A('tmMobileAddressType')}"""

QUERIES["b_dim_postcode"] = make(project.SPECS[4])
ORACLES["b_dim_postcode"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.clean('fcpostcode')} AS zip_cd, {q.clean('fcsubdistrictth')} AS sub_dstc_th,
  {q.clean('fcsubdistricten')} AS sub_dstc_en, {q.clean('fcdistrictth')} AS dstc_th, {q.clean('fcdistricten')} AS dstc_en,
  {q.clean('fcprovinceth')} AS prvn_th, {q.clean('fcprovinceen')} AS prvn_en, {q.clean('fcregionth')} AS region_th,
  {q.clean('fcregionen')} AS region_en, fcisactive AS rec_actv_flag, {q.to_ts('ftcreatedate')} AS crtd_dttm,
  fccreator AS crtd_by, {q.to_ts('ftupdatedate')} AS updt_dttm, fcupdateby AS updt_by,
  {q.to_long('fnid')} AS postcode_id, {q.date_text('coalesce(ftupdatedate, ftcreatedate)')} AS date_id
FROM {A('tmPostCode')}"""

QUERIES["b_dim_project_profile"] = make(project.SPECS[5])
ORACLES["b_dim_project_profile"] = f"""
SELECT DISTINCT {q.AUDIT}, CAST(0 AS BIGINT) AS start_selling_price, CAST(0 AS BIGINT) AS selling_price_per_square_meter,
  fcisactive AS project_status, {q.clean('fcname')} AS segment_name, '1' AS rec_actv_flag,
  {q.to_ts('ftcreatedate')} AS crtd_dttm, fccreator AS crtd_by, {q.to_ts('ftupdatedate')} AS updt_dttm,
  coalesce(fcupdateby, fccreator) AS updt_by, fcid AS project_profile_id,
  {q.date_text('coalesce(ftupdatedate, ftcreatedate)')} AS date_id,
  CASE WHEN regexp_matches({q.clean('fcname')}, 'มหาชน|PCL') THEN 'PCL' ELSE 'LOCAL' END AS corporate_type
FROM {A('tmCOM')}"""

QUERIES["b_dim_project"] = make(project.SPECS[6])
ORACLES["b_dim_project"] = f"""
WITH c AS {A('tmCOM')}, t AS {L('tmCOM_Type', 'fcid')}
SELECT DISTINCT {q.AUDIT}, c.fccode AS project_code, {q.clean('c.fcname')} AS project_name,
  {q.to_double('c.fntotalunit', 0.0)} AS unit, {q.to_double('c.fntotalcarpark', 0.0)} AS car_parking_slot,
  CAST(NULL AS DOUBLE) AS commonfee_amount_mavg, c.fctaxid AS tax_id,
  {q.case_map('CAST(t.fnitemno AS STRING)', _PT)} AS type,
  {q.strip(q.clean('c.fcaddr11') + " || ' ' || " + q.clean('c.fcaddr12') + " || ' ' || " + q.clean('c.fcaddr13'))} AS address,
  {q.nulls('subdistrict, district, province, postal_code')}, c.fcremark34 AS latitude, c.fcremark35 AS longtitude,
  c.fcremark32 AS pmc_id, {q.case_map('upper(c.fcisactive)', FLAG_UPPER_YN_TF)} AS rec_actv_flag,
  {q.to_ts('c.ftcreatedate')} AS crtd_dttm, c.fccreator AS crtd_by, {q.to_ts('c.ftupdatedate')} AS updt_dttm,
  c.fcupdateby AS updt_by, c.fcid AS project_id, c.fcid AS project_profile_id,
  {q.date_text('coalesce(c.ftupdatedate, c.ftcreatedate)')} AS date_id, CAST(NULL AS VARCHAR) AS "IsContractActive",
  CASE WHEN regexp_matches({q.clean('c.fcname')}, 'มหาชน') THEN 'PCL' ELSE 'LOCAL' END AS "corporate_Type",
  c.fccomshortcode AS project_shortcode, c.fctel AS phone_no
FROM c LEFT JOIN t ON c.fcremark33 = t.fcid"""


# ------------------------------------------------------ user (lookups) -----
QUERIES["b_dim_device_detail"] = make(user.SPECS[6])
ORACLES["b_dim_device_detail"] = f"""
WITH d AS {A('gu_device')},
last AS (SELECT device_id AS device_id_cl, max({q.to_ts('coalesce(updated_date, created_date)')}) AS lastlogin
  FROM d WHERE is_enable = 'false' AND device_id IS NOT NULL GROUP BY device_id),
j AS (SELECT {q.nullif_all('device_id, device_name, platform, os_version, customer_id, is_enable, created_date, updated_date')},
  lastlogin FROM d LEFT JOIN last ON d.device_id = last.device_id_cl)
SELECT {q.AUDIT}, lastlogin AS last_login_dttm, device_name AS device_nm, platform, os_version AS version,
  CASE WHEN is_enable IN ('N', 'false', '0') THEN '0' ELSE '1' END AS rec_actv_flag,
  {q.to_ts('created_date')} AS crtd_dttm, customer_id AS crtd_by, customer_id AS updt_by,
  {q.to_ts('updated_date')} AS updt_dttm, device_id, {q.date_ts('coalesce(updated_date, created_date)')} AS date_id
FROM j"""

QUERIES["b_fact_userconsent"] = make(user.SPECS[7])
ORACLES["b_fact_userconsent"] = f"""
WITH j AS (SELECT u.*, c.type AS type_con, c.status AS status_con, c.version AS version_con, c.topic AS topic_con,
    v.version AS version_conver
  FROM {A('users_consent')} u LEFT JOIN {L('consents', 'id')} c ON u.consent_id = c.id
  LEFT JOIN {L('consent_versions', 'id')} v ON c.type IS NOT DISTINCT FROM v.type),
n AS (SELECT {q.nullif_all('id, user_id, consent_id, status, created_date, created_by, updated_date, updated_by, type_con, status_con, version_con, topic_con, version_conver')},
  calendar_year, month_no, day_of_month FROM j)
SELECT DISTINCT {q.AUDIT}, make_date(calendar_year, month_no, day_of_month) AS date_id,
  {q.to_long('id')} AS uconsent_id, {q.to_long('user_id')} AS user_id, {q.to_long('consent_id')} AS consent_id,
  {q.clean('type_con')} AS consent_type, {q.clean('status_con')} AS consent_sts, {q.to_long('version_conver')} AS version_id,
  {q.clean('version_con')} AS version_nm, {q.clean('topic_con')} AS consent_topic, {q.clean('status')} AS uconsent_sts,
  '1' AS rec_actv_flag, {q.to_ts('created_date')} AS crtd_dttm, {q.clean('created_by')} AS crtd_by,
  {q.to_ts('updated_date')} AS updt_dttm, {q.clean('updated_by')} AS updt_by
FROM n"""

QUERIES["b_dim_pmsuserprofile"] = make(user.SPECS[8], {"users": "pms_users"})
ORACLES["b_dim_pmsuserprofile"] = f"""
WITH j AS (SELECT u.*, p.id AS id_p, p.first_name AS fn_p, p.last_name AS ln_p, p.country_code AS cc_p,
    p.phone_number AS ph_p, p.updated_by AS ub_p, p.updated_at AS ua_p
  FROM {A('pms_users')} u LEFT JOIN {L('profiles', 'id')} p ON u.id = p.id),
n AS (SELECT id, id_p, {q.nullif_all('email, is_active, last_login_at, refresh_token_expired_at, token_version, created_at, created_by, updated_at, updated_by, fn_p, ln_p, cc_p, ph_p, ub_p, ua_p')} FROM j)
SELECT DISTINCT {q.AUDIT}, {q.date_ts('coalesce(created_at, updated_at)')} AS date_id, {q.to_long('id')} AS user_id,
  email, {_bool('is_active')} AS is_active, {q.to_ts('last_login_at')} AS last_login_dttm,
  {q.to_ts('refresh_token_expired_at')} AS token_expired_dttm, {q.to_long('token_version')} AS token_version,
  {q.to_long('id_p')} AS profile_id, {q.clean('fn_p')} AS first_name, {q.clean('ln_p')} AS last_name,
  {q.clean('cc_p')} AS country_cd, {q.clean('ph_p')} AS phone_number, ub_p AS profile_updt_by,
  {q.to_ts('ua_p')} AS profile_updt_dttm, '1' AS rec_actv_flag, created_by AS crtd_by, {q.to_ts('created_at')} AS crtd_dttm,
  updated_by AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM n"""


# ------------------------------------------------------ pms (lookups) -----
_PERMS = [("can_all", "is_all"), ("can_view", "is_view"), ("can_create", "is_create"), ("can_edit", "is_edit"),
          ("can_print", "is_print"), ("can_approve", "is_approve"), ("can_cancel", "is_cancel"), ("allowed", "is_allowed")]
_RP = "id, module_permission_id, can_all, can_view, can_create, can_edit, can_print, can_approve, can_cancel, allowed, created_at, created_by, updated_at, updated_by"
_RO = "company_id, project_id, code, name_th, name_en, category, description, is_system, is_active, created_by, created_at, updated_by, updated_at"
QUERIES["b_dim_pmsrole_permission"] = make(project.SPECS[7])
ORACLES["b_dim_pmsrole_permission"] = f"""
WITH j AS (SELECT p.*, p.role_id AS rid, {", ".join(f"r.{c} AS r_{c}" for c in _RO.split(", "))}
  FROM {A('role_permissions')} p LEFT JOIN {A('roles')} r ON p.role_id IS NOT DISTINCT FROM r.id),
n AS (SELECT rid, {q.nullif_all(_RP)}, {q.nullif_all(", ".join("r_" + c for c in _RO.split(", ")))} FROM j)
SELECT DISTINCT {q.AUDIT}, {q.date_ts('coalesce(created_at, updated_at)')} AS date_id,
  {q.to_long('id')} AS record_id, {q.to_long('rid')} AS role_id, {q.to_long('module_permission_id')} AS module_id,
  {", ".join(f"{_bool(o)} AS {n_}" for o, n_ in _PERMS)},
  {q.to_long('r_company_id')} AS pmscompany_id, {q.to_long('r_project_id')} AS pmsproject_id,
  r_code AS role_cd, r_name_th AS role_nm_th, r_name_en AS role_nm_en, r_category AS role_category,
  r_description AS role_desc, {_bool('r_is_system')} AS role_issystem, {_bool('r_is_active')} AS role_isactive,
  r_created_by AS role_crtd_by, {q.to_ts('r_created_at')} AS role_crtd_dttm, r_updated_by AS role_updt_by,
  {q.to_ts('r_updated_at')} AS role_updt_dttm, '1' AS rec_actv_flag, created_by AS crtd_by,
  {q.to_ts('created_at')} AS crtd_dttm, updated_by AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM n"""

QUERIES["b_fact_pmscompany_projects"] = make(project.SPECS[8])
ORACLES["b_fact_pmscompany_projects"] = f"""
WITH j AS (SELECT l.*, c.code AS c_code, c.name_th AS c_name_th, p.name_th AS p_name_th, p.pms_project_id AS p_ref
  FROM {A('companies_projects_logs')} l LEFT JOIN {L('companies', 'id')} c ON l.company_id = c.id
  LEFT JOIN {L('projects', 'id')} p ON l.project_id = p.id),
n AS (SELECT company_id, project_id, {q.nullif_all('id, company_project_id, action_type, created_at, created_by, c_code, c_name_th, p_name_th, p_ref')} FROM j)
SELECT DISTINCT {q.AUDIT}, {q.date_ts('created_at')} AS date_id, {q.to_long('id')} AS mapping_log_id,
  {q.to_long('company_project_id')} AS mapping_id, {q.to_long('company_id')} AS company_id,
  {q.clean('c_code')} AS company_cd, {q.clean('c_name_th')} AS company_nm_th, {q.to_long('project_id')} AS project_id,
  p_ref AS ref_pmsproject_id, {q.clean('p_name_th')} AS pmsproject_nm_th, {q.clean('action_type')} AS status_nm,
  '1' AS rec_actv_flag, created_by AS crtd_by, {q.to_ts('created_at')} AS crtd_dttm,
  CAST(NULL AS VARCHAR) AS updt_by, CAST(NULL AS TIMESTAMP) AS updt_dttm
FROM n"""

QUERIES["b_fact_pmsproject_features"] = make(project.SPECS[9])
ORACLES["b_fact_pmsproject_features"] = f"""
WITH j AS (SELECT f.*, c.company_id AS cid
  FROM {A('project_features')} f LEFT JOIN {L('companies_projects', 'company_id')} c
  ON f.project_id IS NOT DISTINCT FROM c.project_id),
n AS (SELECT project_id, cid, {q.nullif_all('feature_id, enabled, created_at, created_by, updated_at, updated_by')} FROM j)
SELECT DISTINCT {q.AUDIT}, {q.date_ts('coalesce(updated_at, created_at)')} AS date_id,
  {q.to_long('project_id')} AS project_id, {q.to_long('feature_id')} AS feature_id, {q.clean('enabled')} AS feature_enabled,
  {q.to_long('cid')} AS company_id, '1' AS rec_actv_flag, {q.clean('created_by')} AS crtd_by,
  {q.to_ts('created_at')} AS crtd_dttm, {q.clean('updated_by')} AS updt_by, {q.to_ts('updated_at')} AS updt_dttm
FROM n"""


# ------------------------------------------------------------ address -----
def _addr_group(t, a1, a3, sub, dist, z):
    return (f"SELECT fcid, fcisactive, ftcreatedate, fccreator, ftupdatedate, fcupdateby, {a1} AS addr_no, {a3} AS prvn, "
            f"{sub} AS sub_dstc, {dist} AS dstc, {z} AS zip_cd, {t} AS addr_type_id FROM c")


_DID = q.date_text('coalesce(ftupdatedate, ftcreatedate)')
QUERIES["b_dim_address"] = make(project.SPECS[10])
ORACLES["b_dim_address"] = f"""
WITH c AS {A('tmCOR')},
u AS (SELECT DISTINCT * FROM ({_addr_group(5, 'fcaddress1', 'fcaddress3', 'fcaddresssubdistrict', 'fcaddressdistrict', 'fczipcode')}
  UNION ALL {_addr_group(3, 'fcshipaddr1', 'fcshipaddr3', 'fcshipaddrsubdistrict', 'fcshipaddrdistrict', 'fcshipzipcode')}
  UNION ALL {_addr_group(4, 'fcbilltoaddr1', 'fcbilltoaddr3', 'fcbilltoaddrsubdistrict', 'fcbilltoaddrdistrict', 'fcbilltozipcode')}))
SELECT {q.AUDIT}, split_part(addr_no, ' ', 1) AS addr_no, sub_dstc, dstc, prvn, zip_cd,
  {q.case_map('fcisactive', FLAG_YN_TF)} AS rec_actv_flag,
  {q.to_ts('ftcreatedate')} AS crtd_dttm, fccreator AS crtd_by, {q.to_ts('ftupdatedate')} AS updt_dttm,
  coalesce(fccreator, fcupdateby) AS updt_by, CAST(NULL AS VARCHAR) AS ref_addr_id, fcid AS party_id,
  CAST(addr_type_id AS BIGINT) AS addr_type_id, {_DID} AS date_id,
  CAST({_DID} AS STRING) || fcid || CAST(addr_type_id AS STRING) AS addr_id
FROM u"""

QUERIES["b_dim_address_mobileuser"] = make(project.SPECS[11])
ORACLES["b_dim_address_mobileuser"] = f"""
WITH a AS {A('tmMobileUser_Address')}, p AS {L('tmPostCode', 'fnid')}
SELECT {q.AUDIT}, a.fcaddress AS addr_no, p.fcsubdistrictth AS sub_dstc, p.fcdistrictth AS dstc, p.fcprovinceth AS prvn,
  p.fcpostcode AS zip_cd, {q.case_map('a.fcisactive', FLAG_YN_TF)} AS rec_actv_flag,
  {q.to_ts('a.ftcreatedate')} AS crtd_dttm, a.fccreateby AS crtd_by, {q.to_ts('a.ftupdatedate')} AS updt_dttm,
  coalesce(a.fccreateby, a.fcupdateby) AS updt_by, CAST(a.fnid AS STRING) AS ref_addr_id, a.fcmobileuserid AS party_id,
  CAST(a.fcaddrtype AS BIGINT) AS addr_type_id, {q.date_text('coalesce(a.ftupdatedate, a.ftcreatedate)')} AS date_id,
  CAST(NULL AS VARCHAR) AS addr_id
FROM a LEFT JOIN p ON a.fnpostcodeid = p.fnid"""


# --------------------------------------------------------- permissions -----
_PERM_SQL = ", ".join(f"a.{s_} AS \"{t}\"" for s_, t in zip(
    ["fcselect", "fcinsert", "fcupdate", "fcdelete", "fcprint", "fccancel", "fcapprove"],
    ["view", "insert", "update", "delete", "print", "cancel", "approve"]))
_PERM_FROM = f"""FROM {A('tmAUT')} a JOIN {L('tmBRN', 'fcid')} b ON a.fcbrnid = b.fcid
  JOIN {L('tmUSG', 'fcid')} g ON a.fcusgid = g.fcid"""
_MNU_JOIN = f"JOIN {L('tmMNU', 'fcid')} m ON a.fcmnuid = m.fcid"

QUERIES["b_dim_userpermission"] = make(user.SPECS[9])
ORACLES["b_dim_userpermission"] = f"""
SELECT DISTINCT {q.AUDIT}, {q.date_text('coalesce(a.ftupdatedate, a.ftcreatedate)')} AS date_id,
  {q.clean('u.fcid')} AS user_id, {q.clean('u.fccode')} AS user_cd, {q.clean('u.fcname')} AS user_nm,
  u.fcisactive AS user_status, {q.to_ts('u.ftcreatedate')} AS user_crtddttm, {q.to_ts('u.ftupdatedate')} AS user_updtdttm,
  {q.clean('b.fccomid')} AS project_id, {q.clean('a.fcbrnid')} AS branch_id, {q.clean('g.fcid')} AS usergroup_id,
  {q.clean('g.fcname')} AS usergroup_nm, g.fcisactive AS usergroup_status, {q.clean('a.fcmnuid')} AS mnu_id,
  {q.clean('m.fccode')} AS mnu_nm_eng, {q.clean('m.fcname')} AS mnu_nm_thai, {_PERM_SQL},
  {q.case_map('upper(u.fcisactive)', FLAG_UPPER_YN_TF)} AS rec_actv_flag,
  {q.to_ts('g.ftcreatedate')} AS crtd_dttm, g.fccreator AS crtd_by, {q.to_ts('g.ftupdatedate')} AS updt_dttm,
  g.fcupdateby AS updt_by
{_PERM_FROM} JOIN {L('tmUSR', 'fcid')} u ON a.fcusgid = u.fcusgid {_MNU_JOIN}"""

QUERIES["b_fact_userpermission"] = make(user.SPECS[10])
ORACLES["b_fact_userpermission"] = f"""
SELECT DISTINCT {q.AUDIT},
  {q.date_text(q.be_to_ce('coalesce(a.ftupdatedate, a.ftcreatedate)', 2400), 2)} AS date_id,
  {q.clean('b.fccomid')} AS project_id, {q.clean('a.fcbrnid')} AS branch_id, {q.clean('a.fcusgid')} AS usergroup_id,
  {q.clean('g.fcname')} AS usergroup_nm, {q.case_map('upper(g.fcisactive)', FLAG_YN)} AS usergroup_status,
  {q.clean('a.fcmnuid')} AS mnu_id, {q.clean('m.fccode')} AS mnu_nm_eng, {q.clean('m.fcname')} AS mnu_nm_thai, {_PERM_SQL},
  CAST(NULL AS VARCHAR) AS rec_actv_flag, {q.to_ts(q.be_to_ce('a.ftcreatedate', 2400))} AS crtd_dttm,
  CAST(NULL AS VARCHAR) AS crtd_by, {q.to_ts(q.be_to_ce('a.ftupdatedate', 2400))} AS updt_dttm,
  CAST(NULL AS VARCHAR) AS updt_by
{_PERM_FROM} {_MNU_JOIN}"""


# --------------------------------------------------------------- party -----
_N = "CAST(NULL AS VARCHAR)"
_TAIL = f"CAST(NULL AS DOUBLE) AS totl_kid, CAST(NULL AS DOUBLE) AS totl_eldr, {_N} AS mem_sts, CAST(NULL AS TIMESTAMP) AS mem_crtd_dttm, {_N} AS nationality_id"

_GU_DOB = q.to_ts(q.be_to_ce('u.fcbirth', 2500, 2600, 10))
QUERIES["b_dim_party_gu"] = make(user.SPECS[11], {"customer": "mr_customer"})
ORACLES["b_dim_party_gu"] = f"""
WITH u AS (SELECT *, fcfirstname || ' ' || fclastname AS fcname, '0' || fcphoneno AS mob, {q.strip('fngender')} AS sex,
    ftbirthdate AS fcbirth FROM {A('tmmobileuser')}),
g AS (SELECT {q.strip('CAST(fcid AS STRING)')} AS gid, fcnameth FROM {L('tmMobileGender', 'fcid')})
SELECT DISTINCT {q.AUDIT}, u.fcname AS full_nm_th, {_N} AS titl_th, u.fcfirstname AS frst_nm_th, u.fclastname AS last_nm_th,
  u.fcname AS full_nm_en, {_N} AS titl_en, u.fcfirstname AS frst_nm_en, u.fclastname AS last_nm_en,
  {_GU_DOB} AS dob, CAST(2025 - year({_GU_DOB}) AS BIGINT) AS age, u.fctaxid AS th_id, u.fctaxid AS passport_no,
  u.fccountrycode AS cnty_cd, u.mob AS mob_no, u.fcemail AS email, {_N} AS edu, {_N} AS occu, {_N} AS income_range,
  {_N} AS mrtl_sts, {_N} AS rlgn, g.fcnameth AS gndr, {_N} AS fam_size,
  {q.case_map('u.fcisactive', FLAG_YN)} AS rec_actv_flag, {q.to_ts('u.ftcreatedate')} AS crtd_dttm,
  u.fccreateby AS crtd_by, coalesce({q.to_ts('u.ftupdatedate')}, {q.to_ts('u.ftcreatedate')}) AS updt_dttm,
  coalesce(u.fcupdateby, u.fccreateby) AS updt_by, CAST(2 AS BIGINT) AS party_type_id, u.fcuserid AS party_id,
  {q.date_text('coalesce(u.ftupdatedate, u.ftcreatedate)')} AS date_id, {_N} AS mem_ref_code,
  CASE WHEN coalesce(regexp_matches(u.fcname, 'มหาชน|PCL'), FALSE) THEN 'PCL' ELSE 'LOCAL' END AS corporate_type, {_TAIL}
FROM u LEFT JOIN (SELECT '0' || phonenumber AS ph FROM {A('mr_customer')}) cu ON u.mob = cu.ph LEFT JOIN g ON u.sex = g.gid"""

_RU_DOB = q.to_ts(q.be_to_ce('c.ftbirthday', 2500))
QUERIES["b_dim_party_ru"] = make(user.SPECS[12])
ORACLES["b_dim_party_ru"] = f"""
WITH r AS {L('tmRoomH', 'fcid')},
o AS (SELECT fcownerid AS oid FROM r UNION SELECT fcownerid2 FROM r UNION SELECT fcownerid3 FROM r
      UNION SELECT fccurrentownerid FROM r),
c AS (SELECT * FROM {A('tmCOR')} WHERE fcid IN (SELECT oid FROM o WHERE coalesce(oid, '') <> ''))
SELECT {q.AUDIT}, c.fcname AS full_nm_th, {q.nulls('titl_th, frst_nm_th, last_nm_th, titl_en, frst_nm_en, last_nm_en')},
  c.fcengname AS full_nm_en, {_RU_DOB} AS dob,
  CAST(CASE WHEN {_RU_DOB} IS NOT NULL THEN 2025 - year({_RU_DOB}) ELSE {q.to_double('c.fnage', 0.0)} END AS BIGINT) AS age,
  c.fctaxid AS th_id, c.fcpassport AS passport_no, c.fccountrycode AS cnty_cd, c.fcshipmobile AS mob_no,
  c.fcshipemail AS email, c.fceducation AS edu, {_N} AS occu, {_N} AS income_range, c.fcmarrystatus AS mrtl_sts,
  {_N} AS rlgn, {q.case_map('upper(c.fcsex)', GENDER, 'ไม่ระบุเพศ')} AS gndr, {_N} AS fam_size,
  {q.case_map('c.fcisactive', FLAG_YN_TF)} AS rec_actv_flag,
  {q.to_ts('c.ftcreatedate')} AS crtd_dttm, c.fccreator AS crtd_by,
  coalesce({q.to_ts('c.ftupdatedate')}, {q.to_ts('c.ftcreatedate')}) AS updt_dttm,
  coalesce(c.fcupdateby, c.fccreator) AS updt_by, CAST(1 AS BIGINT) AS party_type_id, c.fcid AS party_id,
  {q.date_ts('coalesce(c.ftupdatedate, c.ftcreatedate)')} AS date_id, {_N} AS mem_ref_code,
  CASE WHEN coalesce(regexp_matches(c.fcname, 'มหาชน|PCL'), FALSE) THEN 'PCL' ELSE 'LOCAL' END AS corporate_type, {_TAIL}
FROM c"""


# ---------------------------------------------------------- mobile user -----
def _pad9(x):
    return f"(CASE WHEN length({x}) = 9 THEN '0' || {x} ELSE {x} END)"


QUERIES["b_dim_mobile_user"] = make(user.SPECS[13], {"customer": "mr_customer"})
ORACLES["b_dim_mobile_user"] = f"""
WITH rh AS (SELECT DISTINCT fcid, fcownerid, fccurrentownerid, fcownerid2, fcownerid3, ftcreatedate, ftupdatedate
            FROM {A('tmRoomH_mobileuser')}),
rooms AS (SELECT DISTINCT * FROM (
  SELECT fcid, ftcreatedate, ftupdatedate, 'fcownerid' AS owner_type, fcownerid AS oid FROM rh
  UNION ALL SELECT fcid, ftcreatedate, ftupdatedate, 'fccurrentownerid', fccurrentownerid FROM rh
  UNION ALL SELECT fcid, ftcreatedate, ftupdatedate, 'fcownerid2', fcownerid2 FROM rh
  UNION ALL SELECT fcid, ftcreatedate, ftupdatedate, 'fcownerid3', fcownerid3 FROM rh) WHERE oid IS NOT NULL AND oid <> ''),
hist AS (SELECT DISTINCT fcid, fccornewrentalid, fcroomid, fctype, ftcreatedate, ftupdatedate FROM {A('ttCORHist_mobileuser')}),
res AS (SELECT DISTINCT fccornewrentalid, fcroomid FROM hist WHERE {q.strip('fctype')} IN ('Rential', 'Stay')),
cor0 AS (SELECT DISTINCT fcid, {q.strip('fcshipmobile')} AS ph FROM (SELECT DISTINCT fcid, fcshipmobile, ftcreatedate, ftupdatedate FROM {A('tmCOR')})),
cor_all AS (SELECT DISTINCT fcid, {_pad9('ph')} AS mobile_phone FROM cor0 WHERE ph IS NOT NULL AND ph <> ''),
owner_all AS (SELECT {q.strip('c.fcid')} AS fcid_cor, c.mobile_phone, r.fcid AS fcid_room
  FROM cor_all c JOIN rooms r ON {q.strip('c.fcid')} = {q.strip('r.oid')}),
resident_all AS (SELECT c.fcid AS fcid_cor, c.mobile_phone, {q.strip('r.fcid')} AS fcid_room
  FROM res h JOIN cor_all c ON {q.strip('h.fccornewrentalid')} = c.fcid
  JOIN rooms r ON {q.strip('h.fcroomid')} = {q.strip('r.fcid')}),
corall AS (SELECT DISTINCT {q.strip('mobile_phone')} AS mp, fcid_room FROM (SELECT DISTINCT * FROM (
  SELECT * FROM owner_all UNION ALL SELECT * FROM resident_all))),
dev AS (SELECT DISTINCT CAST(customer_id AS STRING) AS cid, device_id FROM {A('gu_device')}),
cus AS (SELECT *, {q.strip(_pad9(q.strip('phonenumber')))} AS mobile_phone FROM {A('mr_customer')}),
j AS (SELECT cus.*, corall.fcid_room, dev.device_id FROM cus LEFT JOIN corall ON cus.mobile_phone = corall.mp
  LEFT JOIN dev ON CAST(cus.id AS STRING) IS NOT DISTINCT FROM dev.cid)
SELECT DISTINCT {q.AUDIT}, {q.date_text('coalesce(lastmodificationtime, creationtime)')} AS date_id,
  CAST(id AS BIGINT) AS customer_id, coalesce(fcid_room, '0') AS unit_id, device_id, username AS user_name,
  phonenumbercountrycode AS country_code, mobile_phone,
  CASE WHEN coalesce(fcid_room, '0') = '0' THEN 'GU' ELSE 'RU' END AS user_type, {q.to_ts('creationtime')} AS crtd_dttm,
  creatoruserid AS crtd_by, coalesce({q.to_ts('lastmodificationtime')}, {q.to_ts('creationtime')}) AS updt_dttm,
  coalesce(lastmodifieruserid, creatoruserid) AS updt_by, 'N' AS history_status
FROM j"""


# ------------------------------------------------ warehouse-reading builders -----
def _dim_project_wh(spark, sf_dir):
    return QUERIES["b_dim_project"](spark, sf_dir).select("project_id", "project_code", "project_name", "date_id")


QUERIES["b_dim_project_bookbank"] = make(project.SPECS[12], {"dim_project": _dim_project_wh})
_E = lambda c: q.be_to_ce(c, 2262)
ORACLES["b_dim_project_bookbank"] = f"""
WITH k AS {A('tmBKB')}, b AS {L('tmBRN', 'fcid')}, n AS {L('tmBNK', 'fcid')}, a AS {L('tmACC', 'fcid')},
dp AS ({ORACLES['b_dim_project']}),
pro AS (SELECT project_id, project_code, project_name FROM (
    SELECT project_id, project_code, {q.strip('project_name')} AS project_name,
      ROW_NUMBER() OVER (PARTITION BY project_id ORDER BY date_id DESC) AS rn
    FROM dp WHERE project_id IN (SELECT b.fccomid FROM k JOIN b ON k.fcbrnid = b.fcid)) WHERE rn = 1
  UNION ALL SELECT '-1', '(not set)', '(not set)')
SELECT DISTINCT {q.AUDIT}, {q.date_text(f"coalesce({_E('k.ftupdatedate')}, {_E('k.ftcreatedate')})")} AS date_id,
  k.fcid AS bookbank_id, {q.clean('k.fccode')} AS bookbank_cd, {q.clean('k.fcname')} AS bookbank_nm,
  {q.clean('k.fcbookno')} AS bookbank_no, pro.project_id, {q.clean('pro.project_code')} AS project_code,
  {q.clean('pro.project_name')} AS project_name, n.fcid AS bank_id, {q.clean('n.fccode')} AS bank_cd,
  {q.clean('n.fcname')} AS bank_nm, a.fcid AS account_id, {q.clean('a.fccode')} AS account_cd,
  {q.clean('a.fcname')} AS account_nm, od.fcid AS accountod_id, {q.clean('od.fccode')} AS accountod_cd,
  {q.clean('od.fcname')} AS accountod_nm, {q.clean('k.fcbankbrname')} AS bookbank_branch,
  {q.case_map('k.fcbankbooktype', BOOKBANK_TYPE)} AS bookbank_type,
  {q.case_map('k.fcbankbookusetype', BOOKBANK_USETYPE)} AS bookbank_usetype,
  {q.to_ts(_E('k.ftbegdate'))} AS opening_dttm, {q.to_long('k.fnday')} AS numofdepositdays,
  {q.to_ts(_E('k.ftduedate'))} AS duedate_dttm, {q.to_double('k.fnbalamt')} AS balance_amt,
  {q.clean('k.fcremark1')} AS remark_nm, {q.clean('k.fcremark2')} AS deposit_nm, k.fcremark3 AS interest_rate,
  {q.clean('k.fcremark4')} AS objective, k.fcremark5 AS account_istransfer,
  {q.case_map('upper(k.fcisactive)', FLAG_UPPER_YN_TF)} AS rec_actv_flag,
  {q.to_ts(_E('k.ftcreatedate'))} AS crtd_dttm, k.fccreator AS crtd_by, {q.to_ts(_E('k.ftupdatedate'))} AS updt_dttm,
  coalesce(k.fcupdateby, k.fccreator) AS updt_by
FROM k LEFT JOIN b ON k.fcbrnid = b.fcid LEFT JOIN pro ON b.fccomid = pro.project_id
  LEFT JOIN n ON k.fcbnkid = n.fcid LEFT JOIN a ON k.fcaccid = a.fcid LEFT JOIN a od ON k.fcod_accid = od.fcid"""


def _dim_party_wh(spark, sf_dir):
    return QUERIES["b_dim_party_gu"](spark, sf_dir).unionByName(QUERIES["b_dim_party_ru"](spark, sf_dir))


_PARTY_COLS = [f.name for f in user.DIM_PARTY.fields]
_KEEP = [c for c in _PARTY_COLS if c not in ("dwh_updt_dttm", "mem_sts", "mem_crtd_dttm", "mem_ref_code")]
QUERIES["b_dim_party_memberstatus"] = make(user.SPECS[14], {"dim_party": _dim_party_wh})
ORACLES["b_dim_party_memberstatus"] = f"""
WITH dp AS (SELECT * FROM ({ORACLES['b_dim_party_gu']}) UNION ALL SELECT * FROM ({ORACLES['b_dim_party_ru']})),
ml AS (SELECT DISTINCT fcuserid, ftcreatedate, ftupdatedate FROM {A('tmMemberLoyalty')}),
party AS (SELECT DISTINCT * FROM dp WHERE party_type_id IN (1, 2) AND lower(party_id) IN (SELECT fcuserid FROM ml)),
mu AS (SELECT fcuserid, '0' || fcphoneno AS ph FROM {L('tmmobileuser', 'fcuserid')}),
sf AS (SELECT fcuserid, fcfrienduserid FROM {L('tmShareFriend', 'fcuserid, fcfrienduserid')})
SELECT DISTINCT {", ".join("p." + c for c in _KEEP)}, {q.RUN_TS} AS dwh_updt_dttm, '1' AS mem_sts,
  {q.to_ts('ml.ftcreatedate')} AS mem_crtd_dttm, coalesce(sf.fcuserid, '-') AS mem_ref_code
FROM ml JOIN mu ON ml.fcuserid = mu.fcuserid JOIN party p ON mu.ph = p.mob_no AND mu.fcuserid = p.party_id
  LEFT JOIN sf ON mu.fcuserid = sf.fcfrienduserid"""
