"""Adapters: one ANSI SELECT per source table, projecting a test table into that
source's shape.  The text runs unchanged on Spark SQL and on DuckDB (only functions
both share: ||, CASE, CAST, substr, lpad, year/month/day, %).  All variation comes
from arithmetic on keys, so every row of the test table is kept."""

from __future__ import annotations

NBSP = " "


def dirty_date(ts: str, k: str, salt: int = 0) -> str:
    """Date text with the usual dirt: null, blank, 'nan', junk, short form,
    Buddhist year, surrounding blanks; else the plain timestamp text."""
    plain = f"CAST({ts} AS STRING)"
    return f"""(CASE ({k} + {salt}) % 12
      WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'nan' WHEN 3 THEN 'not a date'
      WHEN 4 THEN CAST(year({ts}) AS STRING) || '-' || CAST(month({ts}) AS STRING) || '-' || CAST(day({ts}) AS STRING)
      WHEN 5 THEN CAST(year({ts}) + 543 AS STRING) || substr({plain}, 5)
      WHEN 6 THEN ' ' || {plain} || '{NBSP}'
      ELSE {plain} END)"""


def dirty_text(base: str, k: str, salt: int = 0) -> str:
    """Text with null, 'nan', 'NaN', blank and padded variants."""
    return f"""(CASE ({k} + {salt}) % 10
      WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN 'NaN' WHEN 3 THEN ''
      WHEN 4 THEN ' ' || {base} || '{NBSP}' ELSE {base} END)"""


def flag(k: str, salt: int = 0) -> str:
    """Active flags in every spelling met in the sources."""
    return f"""(CASE ({k} + {salt}) % 11
      WHEN 0 THEN 'Y' WHEN 1 THEN 'N' WHEN 2 THEN 'y' WHEN 3 THEN 'n' WHEN 4 THEN 'true'
      WHEN 5 THEN 'false' WHEN 6 THEN 'TRUE' WHEN 7 THEN '1' WHEN 8 THEN '0' WHEN 9 THEN NULL
      ELSE 'X' END)"""


ADAPTERS: dict[str, str] = {}

# units: one per order
ADAPTERS["tmRoomH"] = f"""
SELECT
  'U' || CAST(o_orderkey AS STRING) AS fcid,
  {dirty_text("'R' || CAST(o_orderkey % 900 AS STRING)", "o_orderkey")} AS fccode,
  'B' || CAST(o_orderkey % 45 AS STRING) AS fcbrnid,
  {dirty_text("CAST(o_custkey % 500 AS STRING) || '/' || CAST(o_orderkey % 7 AS STRING)", "o_orderkey", 3)} AS fcaddressno,
  (CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN '' WHEN 3 THEN 'nan'
     ELSE CAST(o_orderkey % 100 AS STRING) || '.' || CAST(o_custkey % 10 AS STRING) END) AS fcownerratio,
  (CASE o_orderkey % 7 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN ' 2 '
     WHEN 4 THEN '4' WHEN 5 THEN NULL ELSE '1' END) AS fcleveingtype,
  (CASE o_orderkey % 19 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' ' ELSE 'C' || CAST(o_custkey AS STRING) END) AS fcownerid,
  (CASE o_orderkey % 3 WHEN 0 THEN 'C' || CAST(o_custkey + 7 AS STRING) WHEN 1 THEN '{NBSP}' ELSE NULL END) AS fcownerid2,
  (CASE o_orderkey % 7 WHEN 0 THEN 'C' || CAST(o_custkey AS STRING) WHEN 1 THEN 'C' || CAST(o_custkey + 11 AS STRING) ELSE NULL END) AS fcownerid3,
  (CASE o_orderkey % 4 WHEN 0 THEN 'C' || CAST(o_custkey + 3 AS STRING) ELSE NULL END) AS fccurrentownerid,
  {dirty_date("o_orderdate", "o_orderkey", 1)} AS fttransferdate,
  {dirty_date("o_orderdate", "o_orderkey", 2)} AS ftdatein,
  {dirty_date("o_orderdate", "o_orderkey", 5)} AS ftdateout,
  {flag("o_orderkey")} AS fcisactive,
  {dirty_date("o_orderdate", "o_orderkey", 7)} AS ftcreatedate,
  (CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE 'user' || CAST(o_custkey % 50 AS STRING) END) AS fccreateby,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL
     ELSE {dirty_date("o_orderdate", "o_orderkey", 9)} END) AS ftupdatedate,
  (CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'editor' || CAST(o_orderkey % 30 AS STRING) END) AS fcupdateby,
  CAST(year(o_orderdate) AS INT) AS calendar_year, CAST(month(o_orderdate) AS INT) AS month_no,
  CAST(1 AS INT) AS day_of_month
FROM orders"""

# branches: 40 keys, several versions each (version = calendar year, unique per key)
ADAPTERS["tmBRN"] = """
SELECT
  'B' || CAST(s_suppkey % 40 AS STRING) AS fcid,
  'COM' || CAST((s_suppkey * 7) % 97 AS STRING) AS fccomid,
  'BR' || CAST(s_suppkey % 40 AS STRING) || '-' || CAST(s_suppkey % 3 AS STRING) AS fccode,
  CAST(2000 + floor(s_suppkey / 40) AS INT) AS calendar_year,
  CAST(1 + s_suppkey % 12 AS INT) AS month_no,
  CAST(1 + s_suppkey % 28 AS INT) AS day_of_month
FROM supplier"""

# dirty scalar values, one row per order (function checks F2-F38)
ADAPTERS["dirty_values"] = f"""
SELECT
  o_orderkey AS k,
  {dirty_text("o_orderpriority", "o_orderkey")} AS txt,
  (CASE o_orderkey % 13 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'abc' WHEN 3 THEN '1.0' WHEN 4 THEN '1.5'
     WHEN 5 THEN ' 42 ' WHEN 6 THEN 'nan' WHEN 7 THEN '-7' WHEN 8 THEN '12345678901234567'
     ELSE CAST(o_custkey AS STRING) END) AS num,
  {flag("o_orderkey")} AS flag,
  (CASE o_orderkey % 14 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN ' t ' WHEN 3 THEN 'F' WHEN 4 THEN 'active'
     WHEN 5 THEN 'INACTIVE' WHEN 6 THEN 'maybe' WHEN 7 THEN NULL WHEN 8 THEN '1' WHEN 9 THEN '0'
     WHEN 10 THEN 'true' ELSE 'false' END) AS boolish,
  (CASE o_orderkey % 12 WHEN 0 THEN 'woman' WHEN 1 THEN 'Female' WHEN 2 THEN 'famale' WHEN 3 THEN 'men'
     WHEN 4 THEN 'MALE' WHEN 5 THEN 'man' WHEN 6 THEN 'female/man' WHEN 7 THEN 'MAN/FEMALE' WHEN 8 THEN 'company'
     WHEN 9 THEN NULL WHEN 10 THEN 'x' ELSE '' END) AS sex,
  (CASE o_orderkey % 12 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' WHEN 3 THEN '4' WHEN 4 THEN '5'
     WHEN 5 THEN '6' WHEN 6 THEN '7' WHEN 7 THEN '8' WHEN 8 THEN '9' WHEN 9 THEN '999' WHEN 10 THEN NULL
     ELSE '10' END) AS code,
  (CASE o_orderkey % 8 WHEN 0 THEN 'S' WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN 'P' WHEN 4 THEN 'R'
     WHEN 5 THEN 'B' WHEN 6 THEN NULL ELSE 'Z' END) AS bookcode,
  (CASE o_orderkey % 6 WHEN 0 THEN 'บริษัท ทดสอบ จำกัด (มหาชน)' WHEN 1 THEN 'Acme PCL' WHEN 2 THEN NULL
     WHEN 3 THEN 'Acme pcl' ELSE 'Customer ' || CAST(o_custkey AS STRING) END) AS company,
  {dirty_date("o_orderdate", "o_orderkey")} AS dtext,
  (CASE o_orderkey % 9 WHEN 0 THEN NULL WHEN 1 THEN 'junk' WHEN 2 THEN '1700000000.5'
     ELSE CAST(o_orderkey * 86400 + 946684800 AS STRING) END) AS epoch,
  (CASE o_orderkey % 10 WHEN 0 THEN '2400' WHEN 1 THEN '2401' WHEN 2 THEN '2500' WHEN 3 THEN '2501'
     WHEN 4 THEN '2567' WHEN 5 THEN '2600' WHEN 6 THEN '2263' WHEN 7 THEN NULL WHEN 8 THEN 'ab12' ELSE CAST(year(o_orderdate) AS STRING) END)
    || '-' || lpad(CAST(month(o_orderdate) AS STRING), 2, '0') || '-' || lpad(CAST(day(o_orderdate) AS STRING), 2, '0') || ' 08:30:00' AS betext,
  (CASE o_orderkey % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(800000000 + o_custkey AS STRING) END) AS phone,
  (CASE o_orderkey % 5 WHEN 0 THEN NULL ELSE 'First' || CAST(o_custkey % 97 AS STRING) END) AS first_nm,
  (CASE o_orderkey % 6 WHEN 0 THEN NULL ELSE 'Last' || CAST(o_orderkey % 89 AS STRING) END) AS last_nm,
  o_orderdate AS ts,
  CAST(year(o_orderdate) AS INT) AS calendar_year, CAST(month(o_orderdate) AS INT) AS month_no,
  CAST(day(o_orderdate) AS INT) AS day_of_month
FROM orders"""


def kdate(k: str, salt: int = 0) -> str:
    """Dirty date text built from key arithmetic (for tables without a date column)."""
    y = f"(2010 + ({k} + {salt}) % 15)"
    m = f"(1 + ({k} + {salt}) % 12)"
    d = f"(1 + ({k} * 7 + {salt}) % 28)"
    hh = f"lpad(CAST(({k} + {salt}) % 24 AS STRING), 2, '0')"
    plain = (f"(CAST({y} AS STRING) || '-' || lpad(CAST({m} AS STRING), 2, '0') || '-' || "
             f"lpad(CAST({d} AS STRING), 2, '0') || ' ' || {hh} || ':15:00')")
    return f"""(CASE ({k} + {salt}) % 12
      WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'nan' WHEN 3 THEN 'not a date'
      WHEN 4 THEN CAST({y} AS STRING) || '-' || CAST({m} AS STRING) || '-' || CAST({d} AS STRING)
      WHEN 5 THEN CAST({y} + 543 AS STRING) || substr({plain}, 5)
      WHEN 6 THEN ' ' || {plain} || '{NBSP}'
      WHEN 7 THEN CAST({y} + 543 AS STRING) || '-' || lpad(CAST({m} AS STRING), 2, '0') || '-01'
      ELSE {plain} END)"""


def who(prefix: str, k: str, mod: int, salt: int = 0) -> str:
    """User names with null, blank and padded variants."""
    return f"""(CASE ({k} + {salt}) % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' {prefix}' || CAST({k} % {mod} AS STRING) || ' '
      ELSE '{prefix}' || CAST({k} % {mod} AS STRING) END)"""


# authentication users (one per customer)
ADAPTERS["auth_users"] = f"""
SELECT
  (CASE c_custkey % 17 WHEN 0 THEN 'abc' WHEN 1 THEN CAST(c_custkey AS STRING) || '.0' WHEN 2 THEN ''
     ELSE CAST(c_custkey AS STRING) END) AS id,
  (CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'MU' || CAST(c_custkey % 700 AS STRING) END) AS mobile_user_id,
  {dirty_text("CAST(800000000 + c_custkey AS STRING)", "c_custkey")} AS phone_number,
  (CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN ' 66 ' WHEN 2 THEN '' WHEN 3 THEN 'nan' ELSE '66' END) AS country_code,
  (CASE c_custkey % 8 WHEN 0 THEN 'true' WHEN 1 THEN 'false' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' WHEN 4 THEN '0'
     WHEN 5 THEN '' WHEN 6 THEN NULL ELSE 'False' END) AS is_deleted,
  {kdate("c_custkey")} AS created_time,
  {kdate("c_custkey", 3)} AS updated_time,
  CAST(2024 AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# home-service providers (one per supplier); epoch seconds as text
ADAPTERS["seekster_provider"] = f"""
SELECT
  'HS' || CAST(s_suppkey AS STRING) AS provider_id,
  (CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'บริษัท บริการ ' || CAST(s_suppkey AS STRING) || ' จำกัด (มหาชน)'
     ELSE s_name END) AS provider_name,
  (CASE s_suppkey % 3 WHEN 0 THEN NULL WHEN 1 THEN s_name || ' PCL' ELSE 'Reg ' || s_name END) AS registered_name,
  (CASE s_suppkey % 7 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN 'false' WHEN 3 THEN '0' WHEN 4 THEN 'TRUE'
     WHEN 5 THEN NULL ELSE 'x' END) AS is_active,
  (CASE s_suppkey % 11 WHEN 0 THEN NULL WHEN 1 THEN 'junk'
     ELSE CAST(1500000000 + s_suppkey * 86399 AS STRING) END) AS create_date,
  {who("creator", "s_suppkey", 13)} AS create_by,
  (CASE s_suppkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'bad' WHEN 2 THEN CAST(1600000000 + s_suppkey * 3600 AS STRING) || '.5'
     ELSE CAST(1600000000 + s_suppkey * 7200 AS STRING) END) AS update_date,
  (CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE 'upd' || CAST(s_suppkey % 5 AS STRING) END) AS update_by
FROM supplier"""

# back-office users (one per customer)
ADAPTERS["tmUSR"] = f"""
SELECT
  'USR' || CAST(c_custkey AS STRING) AS fcid,
  (CASE c_custkey % 10 WHEN 0 THEN NULL ELSE 'G' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) AS STRING) END) AS fcusgid,
  {dirty_text("'U' || CAST(c_custkey AS STRING)", "c_custkey")} AS fccode,
  {dirty_text("c_name", "c_custkey", 4)} AS fcname,
  {flag("c_custkey")} AS fcisactive,
  {kdate("c_custkey", 1)} AS ftcreatedate,
  {who("creator", "c_custkey", 17)} AS fccreator,
  (CASE c_custkey % 3 WHEN 0 THEN NULL ELSE {kdate("c_custkey", 5)} END) AS ftupdatedate,
  {who("editor", "c_custkey", 11, 4)} AS fcupdateby,
  CAST(2024 AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no, CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# residence history (one per line item)
ADAPTERS["ttCORHist"] = f"""
SELECT
  'H' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS fcid,
  {dirty_text("'U' || CAST(l_orderkey AS STRING)", "l_partkey")} AS fcroomid,
  (CASE l_suppkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'R' || CAST(l_partkey % 900 AS STRING) END) AS fccornewrentalid,
  {flag("l_partkey")} AS fcisactive,
  (CASE l_linenumber % 4 WHEN 0 THEN 'Rential' WHEN 1 THEN ' Stay ' WHEN 2 THEN 'Owner' ELSE NULL END) AS fctype,
  {dirty_date("l_shipdate", "l_orderkey")} AS ftdatein,
  {dirty_date("l_shipdate", "l_orderkey", 4)} AS ftdateout,
  {dirty_date("l_shipdate", "l_partkey", 2)} AS ftcreatedate,
  {who("creator", "l_suppkey", 7)} AS fccreator,
  {dirty_date("l_shipdate", "l_partkey", 8)} AS ftupdatedate,
  {who("editor", "l_partkey", 9)} AS fcupdateby
FROM lineitem"""


def numtext(k: str, base: str, salt: int = 0) -> str:
    """Numeric ids as text with junk, fractions and blanks."""
    return f"""(CASE ({k} + {salt}) % 10 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'x' || CAST({base} AS STRING)
      WHEN 3 THEN CAST({base} AS STRING) || '.0' WHEN 4 THEN CAST({base} AS STRING) || '.5'
      ELSE CAST({base} AS STRING) END)"""


def email(k: str, salt: int = 0) -> str:
    return dirty_text(f"'user' || CAST({k} % 997 AS STRING) || '@mail.test'", k, salt)


# property-management companies (one per supplier)
ADAPTERS["companies"] = f"""
SELECT
  s_suppkey AS id, 'CO' || CAST(s_suppkey AS STRING) AS code,
  {dirty_text("'บริษัท ' || s_name", "s_suppkey")} AS name_th,
  (CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN 'None' ELSE s_name || ' Co' END) AS name_en,
  (CASE s_suppkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE NULL END) AS is_active,
  {kdate("s_suppkey")} AS created_at, {who("admin", "s_suppkey", 7)} AS created_by,
  (CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE {kdate("s_suppkey", 6)} END) AS updated_at,
  (CASE s_suppkey % 6 WHEN 0 THEN 'nan' WHEN 1 THEN '<NA>' ELSE {who("editor", "s_suppkey", 5)} END) AS updated_by,
  CAST(2020 + floor(s_suppkey / 50) AS INT) AS calendar_year, CAST(1 + s_suppkey % 12 AS INT) AS month_no,
  CAST(1 + s_suppkey % 28 AS INT) AS day_of_month
FROM supplier"""

# property-management projects (one per part)
ADAPTERS["projects"] = f"""
SELECT
  p_partkey AS id, 'PJ' || CAST(p_partkey AS STRING) AS code,
  {dirty_text("'โครงการ ' || p_name", "p_partkey")} AS name_th, p_name || ' ' || p_brand AS name_en,
  (CASE p_partkey % 5 WHEN 0 THEN NULL ELSE 'PMS' || CAST(p_partkey % 300 AS STRING) END) AS pms_project_id,
  (CASE p_partkey % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE NULL END) AS is_active,
  {kdate("p_partkey", 2)} AS created_at, {who("admin", "p_partkey", 7)} AS created_by,
  (CASE p_partkey % 4 WHEN 0 THEN NULL ELSE {kdate("p_partkey", 8)} END) AS updated_at,
  {who("editor", "p_partkey", 5)} AS updated_by,
  CAST(2020 + floor(p_partkey / 500) AS INT) AS calendar_year, CAST(1 + p_partkey % 12 AS INT) AS month_no,
  CAST(1 + p_partkey % 28 AS INT) AS day_of_month
FROM part"""

# invitations: two versions per order (version = calendar year 2023/2024), never tied
def _invitation_version(v: int) -> str:
    return f"""
SELECT
  o_orderkey AS id, {email("o_orderkey", 3 + v)} AS email,
  (CASE (o_orderkey + {v}) % 5 WHEN 0 THEN 'pending' WHEN 1 THEN ' accepted ' WHEN 2 THEN 'expired'
     WHEN 3 THEN NULL ELSE 'nan' END) AS status,
  {dirty_date("o_orderdate", "o_orderkey", 1 + v)} AS expires_at,
  {dirty_date("o_orderdate", "o_orderkey", 5 * v)} AS created_at,
  {who("inviter", "o_custkey", 11, v)} AS invited_by,
  CAST({2023 + v} AS INT) AS calendar_year, CAST(month(o_orderdate) AS INT) AS month_no,
  CAST(day(o_orderdate) AS INT) AS day_of_month
FROM orders"""


ADAPTERS["invitations"] = _invitation_version(0) + "\nUNION ALL" + _invitation_version(1)

ADAPTERS["invitation_companies"] = f"""
SELECT
  o_orderkey AS id, o_orderkey + (CASE o_orderkey % 9 WHEN 0 THEN 100000000 ELSE 0 END) AS invitation_id,
  {numtext("o_orderkey", "o_custkey % 100")} AS company_id,
  (CASE o_orderkey % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN '' WHEN 2 THEN ' rejected ' ELSE NULL END) AS status,
  {dirty_date("o_orderdate", "o_orderkey", 2)} AS responded_at
FROM orders"""

ADAPTERS["invitation_projects"] = f"""
SELECT
  o_orderkey AS id, o_orderkey + (CASE o_orderkey % 7 WHEN 0 THEN 100000000 ELSE 0 END) AS invitation_id,
  {numtext("o_orderkey", "o_custkey % 2000", 4)} AS project_id,
  {numtext("o_orderkey", "o_orderkey % 9", 7)} AS role_id,
  (CASE o_orderkey % 4 WHEN 0 THEN 'accepted' WHEN 1 THEN '' WHEN 2 THEN ' rejected ' ELSE NULL END) AS status,
  {dirty_date("o_orderdate", "o_orderkey", 5)} AS responded_at
FROM orders"""

_AUDIT_LOG = """
SELECT
  event_id AS id, {numtext} AS {entity}_id,
  (CASE event_type WHEN 'click' THEN 'INVITE' WHEN 'view' THEN ' REMOVE ' WHEN 'error' THEN NULL ELSE upper(event_type) END) AS action_type,
  (CASE user_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 'nan' ELSE 'action by ' || CAST(user_id AS STRING) END) AS description,
  {email} AS target_email,
  (CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE props END) AS reason,
  CAST(ts AS STRING) AS created_at,
  (CASE user_id % 3 WHEN 0 THEN NULL ELSE 'u' || CAST(user_id AS STRING) END) AS created_by
FROM events"""
ADAPTERS["company_audit_logs"] = _AUDIT_LOG.format(numtext=numtext("event_id", "user_id % 100"), entity="company",
                                                   email=email("user_id"))
ADAPTERS["project_audit_logs"] = _AUDIT_LOG.format(numtext=numtext("event_id", "user_id % 300", 3), entity="project",
                                                   email=email("user_id", 2))

ADAPTERS["user_roles"] = f"""
SELECT
  {numtext("o_orderkey", "o_orderkey")} AS id, {numtext("o_orderkey", "o_custkey", 1)} AS user_id,
  {numtext("o_orderkey", "o_orderkey % 12", 2)} AS role_id, {numtext("o_orderkey", "o_custkey % 100", 3)} AS company_id,
  {numtext("o_orderkey", "o_custkey % 2000", 5)} AS project_id,
  (CASE o_orderkey % 9 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN ' t ' WHEN 3 THEN 'inactive' WHEN 4 THEN NULL
     WHEN 5 THEN 'maybe' WHEN 6 THEN '1' ELSE 'true' END) AS is_active,
  {dirty_date("o_orderdate", "o_orderkey")} AS created_at, {who("admin", "o_custkey", 9)} AS created_by,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE {dirty_date("o_orderdate", "o_orderkey", 6)} END) AS updated_at,
  {who("editor", "o_custkey", 6, 2)} AS updated_by
FROM orders"""

# mobile address types (one per supplier)
ADAPTERS["tmMobileAddressType"] = f"""
SELECT
  s_suppkey AS fnid, {dirty_text("'ที่อยู่ ' || CAST(s_nationkey AS STRING)", "s_suppkey")} AS fcaddressnameth,
  'Address ' || CAST(s_nationkey AS STRING) AS fcaddressnameen, {flag("s_suppkey", 2)} AS fcisactive,
  {kdate("s_suppkey")} AS ftcreatedate, {who("creator", "s_suppkey", 7)} AS fccreateby,
  (CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE {kdate("s_suppkey", 4)} END) AS ftupdatedate,
  (CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE 'editor' || CAST(s_suppkey % 5 AS STRING) END) AS fcupdateby
FROM supplier"""

# post codes: 700 codes, versions per code (version = year), one row per customer
ADAPTERS["tmPostCode"] = f"""
SELECT
  c_custkey % 700 AS fnid,
  {dirty_text("lpad(CAST(10000 + (c_custkey % 700) * 13 AS STRING), 5, '0')", "c_custkey")} AS fcpostcode,
  {dirty_text("'ตำบล ' || CAST(c_custkey % 700 AS STRING)", "c_custkey", 1)} AS fcsubdistrictth,
  {dirty_text("'Sub ' || CAST(c_custkey % 700 AS STRING)", "c_custkey", 2)} AS fcsubdistricten,
  {dirty_text("'อำเภอ ' || CAST(c_custkey % 70 AS STRING)", "c_custkey", 3)} AS fcdistrictth,
  {dirty_text("'District ' || CAST(c_custkey % 70 AS STRING)", "c_custkey", 4)} AS fcdistricten,
  {dirty_text("'จังหวัด ' || CAST(c_nationkey AS STRING)", "c_custkey", 5)} AS fcprovinceth,
  {dirty_text("'Province ' || CAST(c_nationkey AS STRING)", "c_custkey", 6)} AS fcprovinceen,
  {dirty_text("'ภาค ' || CAST(c_nationkey % 5 AS STRING)", "c_custkey", 7)} AS fcregionth,
  {dirty_text("'Region ' || CAST(c_nationkey % 5 AS STRING)", "c_custkey", 8)} AS fcregionen,
  {flag("c_custkey", 3)} AS fcisactive,
  {kdate("c_custkey", 2)} AS ftcreatedate, {who("creator", "c_custkey", 7)} AS fccreator,
  (CASE c_custkey % 3 WHEN 0 THEN NULL ELSE {kdate("c_custkey", 9)} END) AS ftupdatedate,
  {who("editor", "c_custkey", 5, 1)} AS fcupdateby,
  CAST(2000 + floor(c_custkey / 700) AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# company / project master (one per supplier)
ADAPTERS["tmCOM"] = f"""
SELECT
  'COM' || CAST(s_suppkey AS STRING) AS fcid, 'PRJ' || CAST(s_suppkey AS STRING) AS fccode,
  (CASE s_suppkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'nan' WHEN 2 THEN ' บริษัท ' || s_name || ' จำกัด (มหาชน) '
     WHEN 3 THEN s_name || ' PCL' ELSE s_name END) AS fcname,
  lpad(CAST(s_suppkey * 37 AS STRING), 13, '0') AS fctaxid,
  'PMC' || CAST(s_suppkey % 9 AS STRING) AS fcremark32,
  'T' || CAST(s_suppkey % 15 AS STRING) AS fcremark33,
  CAST(13 + s_suppkey % 5 AS STRING) || '.75' AS fcremark34, CAST(100 + s_suppkey % 5 AS STRING) || '.5' AS fcremark35,
  {dirty_text("CAST(s_suppkey AS STRING) || ' Moo ' || CAST(s_nationkey AS STRING)", "s_suppkey")} AS fcaddr11,
  {dirty_text("'Soi ' || CAST(s_suppkey % 31 AS STRING)", "s_suppkey", 3)} AS fcaddr12,
  {dirty_text("'Road ' || CAST(s_suppkey % 17 AS STRING)", "s_suppkey", 6)} AS fcaddr13,
  (CASE s_suppkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'abc' ELSE CAST(s_suppkey * 3 AS STRING) END) AS fntotalunit,
  (CASE s_suppkey % 4 WHEN 0 THEN NULL ELSE CAST(s_suppkey % 200 AS STRING) || '.0' END) AS fntotalcarpark,
  {flag("s_suppkey", 5)} AS fcisactive,
  {kdate("s_suppkey", 1)} AS ftcreatedate, {who("creator", "s_suppkey", 7)} AS fccreator,
  (CASE s_suppkey % 3 WHEN 0 THEN NULL ELSE {kdate("s_suppkey", 10)} END) AS ftupdatedate,
  {who("editor", "s_suppkey", 5, 2)} AS fcupdateby,
  'SC' || CAST(s_suppkey % 50 AS STRING) AS fccomshortcode, '02' || CAST(1000000 + s_suppkey AS STRING) AS fctel
FROM supplier"""

# company types: 12 keys, versions per key (version = year), one row per part
ADAPTERS["tmCOM_Type"] = f"""
SELECT
  'T' || CAST(p_partkey % 12 AS STRING) AS fcid,
  (CASE p_partkey % 11 WHEN 10 THEN NULL WHEN 9 THEN 999 ELSE CAST(1 + p_partkey % 11 AS INT) END) AS fnitemno,
  'CT' || CAST(p_partkey % 12 AS STRING) AS fccode, 'Type ' || p_type AS fcname, {flag("p_partkey")} AS fcisactive,
  CAST(2000 + floor(p_partkey / 12) AS INT) AS calendar_year, CAST(1 + p_partkey % 12 AS INT) AS month_no,
  CAST(1 + p_partkey % 28 AS INT) AS day_of_month
FROM part"""

# notification devices: one row per event (several rows per device)
ADAPTERS["gu_device"] = f"""
SELECT
  (CASE event_id % 50 WHEN 0 THEN NULL ELSE 'D' || CAST(user_id * 3 + event_id % 3 AS STRING) END) AS device_id,
  {dirty_text("'Phone ' || CAST(user_id % 40 AS STRING)", "event_id")} AS device_name,
  (CASE event_id % 3 WHEN 0 THEN 'ios' WHEN 1 THEN 'android' ELSE '' END) AS platform,
  CAST(10 + event_id % 7 AS STRING) || '.0' AS os_version,
  (CASE event_id % 9 WHEN 0 THEN NULL ELSE CAST(user_id AS STRING) END) AS customer_id,
  (CASE event_type WHEN 'error' THEN 'false' WHEN 'click' THEN 'N' WHEN 'view' THEN '0' WHEN 'signup' THEN ''
     ELSE 'true' END) AS is_enable,
  {dirty_date("ts", "event_id")} AS created_date,
  (CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE {dirty_date("ts", "event_id", 7)} END) AS updated_date
FROM events"""

# user consents: one per order, read from the day partition
ADAPTERS["users_consent"] = f"""
SELECT
  {numtext("o_orderkey", "o_orderkey")} AS id, {numtext("o_orderkey", "o_custkey", 2)} AS user_id,
  (CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE CAST(o_orderkey % 400 AS STRING) END) AS consent_id,
  (CASE o_orderkey % 5 WHEN 0 THEN 'accepted' WHEN 1 THEN ' declined ' WHEN 2 THEN 'nan' WHEN 3 THEN '' ELSE NULL END) AS status,
  {dirty_date("o_orderdate", "o_orderkey")} AS created_date, {who("u", "o_custkey", 50)} AS created_by,
  {dirty_date("o_orderdate", "o_orderkey", 3)} AS updated_date, {who("u", "o_custkey", 50, 5)} AS updated_by,
  CAST(year(o_orderdate) AS INT) AS calendar_year, CAST(month(o_orderdate) AS INT) AS month_no,
  CAST(day(o_orderdate) AS INT) AS day_of_month
FROM orders"""

# consents: 400 ids with versions (version = year), one row per part
ADAPTERS["consents"] = f"""
SELECT
  CAST(p_partkey % 400 AS STRING) AS id,
  (CASE p_partkey % 13 WHEN 0 THEN NULL ELSE 'T' || CAST(p_partkey % 40 AS STRING) END) AS type,
  (CASE p_partkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN ' draft ' WHEN 2 THEN '' ELSE NULL END) AS status,
  'v' || CAST(p_partkey % 5 AS STRING) AS version,
  {dirty_text("'Topic ' || p_type", "p_partkey")} AS topic,
  CAST(2000 + floor(p_partkey / 400) AS INT) AS calendar_year, CAST(1 + p_partkey % 12 AS INT) AS month_no,
  CAST(1 + p_partkey % 28 AS INT) AS day_of_month
FROM part"""

# consent versions: three per type (bounded fan-out), null type only for the first three suppliers
ADAPTERS["consent_versions"] = """
SELECT
  s_suppkey AS id,
  (CASE WHEN s_suppkey < 3 THEN NULL ELSE 'T' || CAST(CAST(floor(s_suppkey / 3) AS BIGINT) AS STRING) END) AS type,
  CAST(s_suppkey % 4 AS STRING) AS version,
  CAST(2020 AS INT) AS calendar_year, CAST(1 AS INT) AS month_no, CAST(1 AS INT) AS day_of_month
FROM supplier"""

# PMS users (one per customer) and their profiles (two versions per customer, some missing)
ADAPTERS["pms_users"] = f"""
SELECT
  c_custkey AS id, {email("c_custkey")} AS email,
  (CASE c_custkey % 7 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN ' t ' WHEN 3 THEN '' WHEN 4 THEN NULL
     WHEN 5 THEN 'inactive' ELSE 'true' END) AS is_active,
  {kdate("c_custkey", 1)} AS last_login_at, {kdate("c_custkey", 2)} AS refresh_token_expired_at,
  {numtext("c_custkey", "c_custkey % 9")} AS token_version,
  {kdate("c_custkey", 3)} AS created_at, {who("admin", "c_custkey", 7)} AS created_by,
  {kdate("c_custkey", 4)} AS updated_at, {who("editor", "c_custkey", 5)} AS updated_by
FROM customer"""


def _profile_version(v: int) -> str:
    return f"""
SELECT
  c_custkey + (CASE c_custkey % 8 WHEN 0 THEN 100000000 ELSE 0 END) AS id,
  {dirty_text("'First' || CAST(c_custkey % 97 AS STRING)", "c_custkey", v)} AS first_name,
  {dirty_text("'Last' || CAST(c_custkey % 89 AS STRING)", "c_custkey", 2 + v)} AS last_name,
  (CASE (c_custkey + {v}) % 4 WHEN 0 THEN '66' WHEN 1 THEN ' 66' WHEN 2 THEN '' ELSE NULL END) AS country_code,
  {dirty_text("CAST(800000000 + c_custkey AS STRING)", "c_custkey", 4 + v)} AS phone_number,
  {who("editor", "c_custkey", 5, v)} AS updated_by, {kdate("c_custkey", 6 + v)} AS updated_at,
  CAST({2023 + v} AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""


ADAPTERS["profiles"] = _profile_version(0) + "\nUNION ALL" + _profile_version(1)


def boolish(k: str, salt: int = 0) -> str:
    return f"""(CASE ({k} + {salt}) % 10 WHEN 0 THEN 'yes' WHEN 1 THEN 'No' WHEN 2 THEN ' t ' WHEN 3 THEN '' WHEN 4 THEN NULL
      WHEN 5 THEN 'inactive' WHEN 6 THEN '1' WHEN 7 THEN 'F' WHEN 8 THEN 'maybe' ELSE 'true' END)"""


# role permissions: one per line item
ADAPTERS["role_permissions"] = f"""
SELECT
  {numtext("l_orderkey", "l_orderkey * 10 + l_linenumber")} AS id,
  (CASE l_orderkey % 20 WHEN 0 THEN NULL ELSE l_partkey END) AS role_id,
  {numtext("l_partkey", "l_suppkey", 3)} AS module_permission_id,
  {boolish("l_orderkey")} AS can_all, {boolish("l_orderkey", 1)} AS can_view, {boolish("l_orderkey", 2)} AS can_create,
  {boolish("l_partkey")} AS can_edit, {boolish("l_partkey", 3)} AS can_print, {boolish("l_suppkey")} AS can_approve,
  {boolish("l_suppkey", 5)} AS can_cancel, {boolish("l_linenumber")} AS allowed,
  {dirty_date("l_shipdate", "l_orderkey")} AS created_at, {who("admin", "l_suppkey", 7)} AS created_by,
  {dirty_date("l_shipdate", "l_partkey", 4)} AS updated_at, {who("editor", "l_partkey", 5)} AS updated_by
FROM lineitem"""

# roles of the day: one per part, null id for the first three parts only
ADAPTERS["roles"] = f"""
SELECT
  (CASE WHEN p_partkey < 3 THEN NULL ELSE p_partkey END) AS id,
  {numtext("p_partkey", "p_partkey % 100")} AS company_id, {numtext("p_partkey", "p_partkey % 2000", 4)} AS project_id,
  'R' || CAST(p_partkey AS STRING) AS code, {dirty_text("'บทบาท ' || p_name", "p_partkey")} AS name_th,
  p_name AS name_en, p_type AS category, (CASE p_partkey % 3 WHEN 0 THEN NULL ELSE p_brand END) AS description,
  {boolish("p_partkey")} AS is_system, {boolish("p_partkey", 4)} AS is_active,
  {who("admin", "p_partkey", 7)} AS created_by, {kdate("p_partkey")} AS created_at,
  {who("editor", "p_partkey", 5)} AS updated_by, {kdate("p_partkey", 5)} AS updated_at
FROM part"""

# company-project mapping log: one per line item
ADAPTERS["companies_projects_logs"] = f"""
SELECT
  {numtext("l_orderkey", "l_orderkey * 10 + l_linenumber")} AS id,
  {numtext("l_partkey", "l_orderkey", 2)} AS company_project_id,
  (CASE l_orderkey % 15 WHEN 0 THEN NULL ELSE l_suppkey END) AS company_id,
  (CASE l_orderkey % 17 WHEN 0 THEN NULL ELSE l_partkey END) AS project_id,
  (CASE l_linenumber % 4 WHEN 0 THEN 'ADD' WHEN 1 THEN ' REMOVE ' WHEN 2 THEN '' ELSE NULL END) AS action_type,
  {dirty_date("l_shipdate", "l_orderkey")} AS created_at, {who("admin", "l_suppkey", 7)} AS created_by
FROM lineitem"""

# project features: one per order
ADAPTERS["project_features"] = f"""
SELECT
  (CASE o_orderkey % 19 WHEN 0 THEN NULL ELSE o_custkey % 2000 END) AS project_id,
  {numtext("o_orderkey", "o_orderkey % 40")} AS feature_id,
  (CASE o_orderkey % 5 WHEN 0 THEN 'true' WHEN 1 THEN ' false ' WHEN 2 THEN 'nan' WHEN 3 THEN '' ELSE NULL END) AS enabled,
  {dirty_date("o_orderdate", "o_orderkey")} AS created_at, {who("admin", "o_custkey", 7)} AS created_by,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE {dirty_date("o_orderdate", "o_orderkey", 6)} END) AS updated_at,
  {who("editor", "o_custkey", 5, 3)} AS updated_by
FROM orders"""

# company-project mapping: 100 companies, versions per company (version = year), one per order
ADAPTERS["companies_projects"] = """
SELECT
  o_orderkey % 100 AS company_id,
  (CASE o_orderkey % 13 WHEN 0 THEN NULL ELSE o_custkey % 2000 END) AS project_id,
  CAST(2000 + floor(o_orderkey / 100) AS INT) AS calendar_year, CAST(1 + o_orderkey % 12 AS INT) AS month_no,
  CAST(1 + o_orderkey % 28 AS INT) AS day_of_month
FROM orders"""

# parties (customers) with addresses and personal data, one per customer
ADAPTERS["tmCOR"] = f"""
SELECT
  'C' || CAST(c_custkey AS STRING) AS fcid,
  {dirty_text("'นาย ' || c_name", "c_custkey")} AS fcname,
  (CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN c_name || ' PCL' WHEN 2 THEN 'บริษัท ' || c_name || ' จำกัด (มหาชน)' ELSE c_name END) AS fcengname,
  (CASE c_custkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'junk'
     WHEN 3 THEN CAST(2500 + c_custkey % 40 AS STRING) || '-05-01 00:00:00'
     WHEN 4 THEN CAST(2400 + c_custkey % 200 AS STRING) || '-02-03'
     ELSE CAST(1950 + c_custkey % 50 AS STRING) || '-0' || CAST(1 + c_custkey % 9 AS STRING) || '-15 00:00:00' END) AS ftbirthday,
  (CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN 'x' ELSE CAST(20 + c_custkey % 60 AS STRING) END) AS fnage,
  lpad(CAST(c_custkey * 7919 AS STRING), 13, '0') AS fctaxid,
  (CASE c_custkey % 4 WHEN 0 THEN 'P' || CAST(c_custkey AS STRING) ELSE NULL END) AS fcpassport,
  (CASE c_custkey % 3 WHEN 0 THEN '66' WHEN 1 THEN NULL ELSE ' 66 ' END) AS fccountrycode,
  {dirty_text("CAST(800000000 + c_custkey AS STRING)", "c_custkey", 2)} AS fcshipmobile,
  {email("c_custkey", 5)} AS fcshipemail,
  (CASE c_custkey % 4 WHEN 0 THEN 'BA' WHEN 1 THEN 'MA' ELSE NULL END) AS fceducation,
  (CASE c_custkey % 3 WHEN 0 THEN 'S' WHEN 1 THEN 'M' ELSE NULL END) AS fcmarrystatus,
  (CASE c_custkey % 12 WHEN 0 THEN 'woman' WHEN 1 THEN 'Female' WHEN 2 THEN 'famale' WHEN 3 THEN 'men'
     WHEN 4 THEN 'MALE' WHEN 5 THEN 'man' WHEN 6 THEN 'female/man' WHEN 7 THEN 'MAN/FEMALE' WHEN 8 THEN 'company'
     WHEN 9 THEN NULL WHEN 10 THEN 'x' ELSE '' END) AS fcsex,
  'CODE' || CAST(c_custkey AS STRING) AS fccode, 'P' || CAST(c_nationkey AS STRING) AS fccomid,
  {dirty_text("CAST(c_custkey % 300 AS STRING) || '/' || CAST(c_nationkey AS STRING) || ' Moo 2'", "c_custkey", 1)} AS fcaddress1,
  'Building ' || CAST(c_custkey % 20 AS STRING) AS fcaddress2,
  {dirty_text("'จังหวัด ' || CAST(c_nationkey AS STRING)", "c_custkey", 3)} AS fcaddress3,
  {dirty_text("'ตำบล ' || CAST(c_custkey % 90 AS STRING)", "c_custkey", 4)} AS fcaddresssubdistrict,
  {dirty_text("'อำเภอ ' || CAST(c_custkey % 30 AS STRING)", "c_custkey", 5)} AS fcaddressdistrict,
  lpad(CAST(10000 + c_custkey % 900 AS STRING), 5, '0') AS fczipcode,
  (CASE c_custkey % 5 WHEN 0 THEN NULL ELSE CAST(c_custkey % 300 AS STRING) || ' Soi ' || CAST(c_custkey % 9 AS STRING) END) AS fcshipaddr1,
  NULL AS fcshipaddr2,
  (CASE c_custkey % 5 WHEN 0 THEN NULL ELSE 'จังหวัด ' || CAST(c_nationkey AS STRING) END) AS fcshipaddr3,
  'ตำบล ' || CAST(c_custkey % 91 AS STRING) AS fcshipaddrsubdistrict, 'อำเภอ ' || CAST(c_custkey % 31 AS STRING) AS fcshipaddrdistrict,
  lpad(CAST(10000 + c_custkey % 800 AS STRING), 5, '0') AS fcshipzipcode,
  (CASE c_custkey % 2 WHEN 0 THEN NULL ELSE ' ' || CAST(c_custkey % 300 AS STRING) || '/1' END) AS fcbilltoaddr1,
  NULL AS fcbilltoaddr2, 'จังหวัด ' || CAST(c_nationkey AS STRING) AS fcbilltoaddr3,
  (CASE c_custkey % 3 WHEN 0 THEN NULL ELSE 'ตำบล ' || CAST(c_custkey % 92 AS STRING) END) AS fcbilltoaddrsubdistrict,
  'อำเภอ ' || CAST(c_custkey % 32 AS STRING) AS fcbilltoaddrdistrict,
  lpad(CAST(10000 + c_custkey % 700 AS STRING), 5, '0') AS fcbilltozipcode,
  {flag("c_custkey", 4)} AS fcisactive,
  {kdate("c_custkey", 1)} AS ftcreatedate, {who("creator", "c_custkey", 7)} AS fccreator,
  (CASE c_custkey % 3 WHEN 0 THEN NULL ELSE {kdate("c_custkey", 7)} END) AS ftupdatedate,
  {who("editor", "c_custkey", 5, 1)} AS fcupdateby
FROM customer"""

# mobile-user addresses: one per order
ADAPTERS["tmMobileUser_Address"] = f"""
SELECT
  o_orderkey AS fnid, 'MU' || CAST(o_custkey AS STRING) AS fcmobileuserid,
  CAST(3 + o_orderkey % 3 AS STRING) AS fcaddrtype,
  {dirty_text("CAST(o_custkey % 300 AS STRING) || ' Moo ' || CAST(o_orderkey % 9 AS STRING)", "o_orderkey")} AS fcaddress,
  (CASE o_orderkey % 17 WHEN 0 THEN NULL ELSE o_custkey % 750 END) AS fnpostcodeid,
  {flag("o_orderkey", 6)} AS fcisactive, {who("creator", "o_custkey", 7)} AS fccreateby,
  {dirty_date("o_orderdate", "o_orderkey", 2)} AS ftcreatedate, {who("editor", "o_custkey", 5, 2)} AS fcupdateby,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE {dirty_date("o_orderdate", "o_orderkey", 8)} END) AS ftupdatedate
FROM orders"""


# permissions: one per order (group = customer block of ten, branch, menu)
ADAPTERS["tmAUT"] = f"""
SELECT
  'G' || CAST(CAST(floor(o_custkey / 10) AS BIGINT) AS STRING) AS fcusgid,
  {dirty_text("'B' || CAST(o_orderkey % 45 AS STRING)", "o_orderkey", 5)} AS fcbrnid,
  'M' || CAST(o_orderkey % 60 AS STRING) AS fcmnuid,
  (CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' ELSE NULL END) AS fcselect,
  (CASE o_orderkey % 4 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcinsert, (CASE o_orderkey % 5 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcupdate,
  (CASE o_orderkey % 6 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcdelete, (CASE o_orderkey % 7 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcprint,
  (CASE o_orderkey % 8 WHEN 0 THEN 'Y' ELSE 'N' END) AS fccancel, (CASE o_orderkey % 9 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcapprove,
  {dirty_date("o_orderdate", "o_orderkey", 1)} AS ftcreatedate,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE {dirty_date("o_orderdate", "o_orderkey", 5)} END) AS ftupdatedate
FROM orders"""

# user groups: one per block of ten customers, ten versions each (version = year)
ADAPTERS["tmUSG"] = f"""
SELECT
  'G' || CAST(CAST(floor(c_custkey / 10) AS BIGINT) AS STRING) AS fcid,
  {dirty_text("'Group ' || CAST(c_custkey % 10 AS STRING)", "c_custkey")} AS fcname, {flag("c_custkey", 6)} AS fcisactive,
  {kdate("c_custkey", 2)} AS ftcreatedate, {who("creator", "c_custkey", 7)} AS fccreator,
  {kdate("c_custkey", 8)} AS ftupdatedate, {who("editor", "c_custkey", 5, 3)} AS fcupdateby,
  CAST(2000 + c_custkey % 10 AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# menus: 50 keys, versions per key (version = year), one row per part
ADAPTERS["tmMNU"] = f"""
SELECT
  'M' || CAST(p_partkey % 50 AS STRING) AS fcid, {dirty_text("'MENU_' || p_type", "p_partkey")} AS fccode,
  {dirty_text("'เมนู ' || p_name", "p_partkey", 3)} AS fcname,
  CAST(2000 + floor(p_partkey / 50) AS INT) AS calendar_year, CAST(1 + p_partkey % 12 AS INT) AS month_no,
  CAST(1 + p_partkey % 28 AS INT) AS day_of_month
FROM part"""


# app users (one per customer)
ADAPTERS["tmmobileuser"] = f"""
SELECT
  {dirty_text("'First' || CAST(c_custkey % 97 AS STRING)", "c_custkey")} AS fcfirstname,
  (CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'บริษัท จำกัด (มหาชน)' WHEN 2 THEN 'Holdings PCL'
     ELSE 'Last' || CAST(c_custkey % 89 AS STRING) END) AS fclastname,
  (CASE c_custkey % 3 WHEN 0 THEN 'mu' ELSE 'MU' END) || CAST(c_custkey AS STRING) AS fcuserid,
  lpad(CAST(c_custkey * 31 AS STRING), 13, '0') AS fnnatid,
  (CASE c_custkey % 9 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'junk-value'
     WHEN 3 THEN CAST(2501 + c_custkey % 98 AS STRING) || '-04-01 00:00:00' WHEN 4 THEN '2600-01-01 00:00:00'
     WHEN 5 THEN CAST(2520 + c_custkey % 40 AS STRING) || '-1-2'
     ELSE CAST(1950 + c_custkey % 50 AS STRING) || '-06-15 00:00:00' END) AS ftbirthdate,
  lpad(CAST(c_custkey * 7919 AS STRING), 13, '0') AS fctaxid,
  (CASE c_custkey % 3 WHEN 0 THEN '66' WHEN 1 THEN NULL ELSE ' 66 ' END) AS fccountrycode,
  (CASE c_custkey % 8 WHEN 0 THEN NULL ELSE CAST(800000000 + c_custkey AS STRING) END) AS fcphoneno,
  {email("c_custkey", 1)} AS fcemail,
  (CASE c_custkey % 5 WHEN 0 THEN ' 1' WHEN 1 THEN '2' WHEN 2 THEN '3 ' WHEN 3 THEN NULL ELSE '9' END) AS fngender,
  {flag("c_custkey", 1)} AS fcisactive,
  {kdate("c_custkey", 3)} AS ftcreatedate, {who("creator", "c_custkey", 7)} AS fccreateby,
  (CASE c_custkey % 3 WHEN 0 THEN NULL ELSE {kdate("c_custkey", 9)} END) AS ftupdatedate,
  (CASE c_custkey % 4 WHEN 0 THEN NULL ELSE 'editor' || CAST(c_custkey % 5 AS STRING) END) AS fcupdateby,
  CAST(2024 AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no, CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# genders: codes 1/2/3 (and a padded one), versions per code (version = year), one per supplier
ADAPTERS["tmMobileGender"] = """
SELECT
  (CASE s_suppkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN ' 3 ' ELSE '4' END) AS fcid,
  (CASE s_suppkey % 4 WHEN 0 THEN 'ชาย' WHEN 1 THEN 'หญิง' WHEN 2 THEN 'ไม่ระบุ' ELSE NULL END) || CAST(s_suppkey % 3 AS STRING) AS fcnameth,
  (CASE s_suppkey % 4 WHEN 0 THEN 'Male' WHEN 1 THEN 'Female' ELSE 'Other' END) AS fcnameen,
  'Y' AS fcisactive, 'N' AS fcisdefualt,
  CAST(2000 + floor(s_suppkey / 4) AS INT) AS calendar_year, CAST(1 AS INT) AS month_no, CAST(1 AS INT) AS day_of_month
FROM supplier"""


def _mr_customer_version(v: int) -> str:
    return f"""
SELECT
  c_custkey AS id, 'user' || CAST(c_custkey AS STRING) AS username,
  (CASE (c_custkey + {v}) % 4 WHEN 0 THEN '+66' WHEN 1 THEN '66' ELSE NULL END) AS phonenumbercountrycode,
  (CASE (c_custkey + {v}) % 11 WHEN 0 THEN NULL WHEN 1 THEN ' ' || CAST(800000000 + c_custkey AS STRING)
     ELSE CAST(800000000 + c_custkey + {v} AS STRING) END) AS phonenumber,
  {kdate("c_custkey", 2 + v)} AS creationtime, 'cr' || CAST(c_custkey % 9 AS STRING) AS creatoruserid,
  {kdate("c_custkey", 6 + v)} AS lastmodificationtime, 'md' || CAST(c_custkey % 5 AS STRING) AS lastmodifieruserid,
  CAST({2023 + v} AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no,
  CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""


# mobile-register customers: two versions per customer
ADAPTERS["mr_customer"] = _mr_customer_version(0) + "\nUNION ALL" + _mr_customer_version(1)


# unit owners history for mobile users: one per order
ADAPTERS["tmRoomH_mobileuser"] = f"""
SELECT
  (CASE o_orderkey % 13 WHEN 0 THEN ' U' || CAST(o_orderkey AS STRING) ELSE 'U' || CAST(o_orderkey AS STRING) END) AS fcid,
  (CASE o_orderkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' C' || CAST(o_custkey AS STRING) || ' '
     ELSE 'C' || CAST(o_custkey AS STRING) END) AS fcownerid,
  (CASE o_orderkey % 4 WHEN 0 THEN 'C' || CAST(o_custkey + 5 AS STRING) ELSE NULL END) AS fccurrentownerid,
  (CASE o_orderkey % 3 WHEN 0 THEN 'C' || CAST(o_custkey + 9 AS STRING) WHEN 1 THEN '' ELSE NULL END) AS fcownerid2,
  (CASE o_orderkey % 7 WHEN 0 THEN 'C' || CAST(o_custkey AS STRING) ELSE NULL END) AS fcownerid3,
  {dirty_date("o_orderdate", "o_orderkey", 1)} AS ftcreatedate, {dirty_date("o_orderdate", "o_orderkey", 4)} AS ftupdatedate,
  CAST(year(o_orderdate) AS INT) AS calendar_year, CAST(month(o_orderdate) AS INT) AS month_no,
  CAST(day(o_orderdate) AS INT) AS day_of_month
FROM orders"""

# residence history for mobile users: one per line item
ADAPTERS["ttCORHist_mobileuser"] = f"""
SELECT
  'H' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING) AS fcid,
  (CASE l_partkey % 9 WHEN 0 THEN ' C' || CAST(l_partkey AS STRING) ELSE 'C' || CAST(l_partkey AS STRING) END) AS fccornewrentalid,
  (CASE l_suppkey % 5 WHEN 0 THEN 'U' || CAST(l_orderkey AS STRING) || ' ' ELSE 'U' || CAST(l_orderkey AS STRING) END) AS fcroomid,
  (CASE l_linenumber % 4 WHEN 0 THEN 'Rential' WHEN 1 THEN ' Stay ' WHEN 2 THEN 'Owner' ELSE NULL END) AS fctype,
  {dirty_date("l_shipdate", "l_orderkey")} AS ftcreatedate, {dirty_date("l_shipdate", "l_partkey", 3)} AS ftupdatedate,
  CAST(year(l_shipdate) AS INT) AS calendar_year, CAST(month(l_shipdate) AS INT) AS month_no,
  CAST(day(l_shipdate) AS INT) AS day_of_month
FROM lineitem"""


# bank books: one per order
ADAPTERS["tmBKB"] = f"""
SELECT
  'BKB' || CAST(o_orderkey AS STRING) AS fcid, {dirty_text("'BK' || CAST(o_orderkey AS STRING)", "o_orderkey")} AS fccode,
  {dirty_text("'บัญชี ' || CAST(o_custkey AS STRING)", "o_orderkey", 2)} AS fcname,
  'B' || CAST(o_orderkey % 45 AS STRING) AS fcbrnid, 'BNK' || CAST(o_orderkey % 25 AS STRING) AS fcbnkid,
  'ACC' || CAST(o_orderkey % 330 AS STRING) AS fcaccid,
  (CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE 'ACC' || CAST(o_custkey % 330 AS STRING) END) AS fcod_accid,
  {dirty_text("lpad(CAST(o_orderkey AS STRING), 10, '0')", "o_orderkey", 4)} AS fcbookno,
  {dirty_text("'Branch ' || CAST(o_custkey % 40 AS STRING)", "o_orderkey", 6)} AS fcbankbrname,
  (CASE o_orderkey % 5 WHEN 0 THEN 'S' WHEN 1 THEN 'C' WHEN 2 THEN 'F' WHEN 3 THEN 'X' ELSE NULL END) AS fcbankbooktype,
  (CASE o_orderkey % 4 WHEN 0 THEN 'P' WHEN 1 THEN 'R' WHEN 2 THEN 'B' ELSE NULL END) AS fcbankbookusetype,
  {dirty_date("o_orderdate", "o_orderkey", 3)} AS ftbegdate, {numtext("o_orderkey", "o_orderkey % 365")} AS fnday,
  {dirty_date("o_orderdate", "o_orderkey", 8)} AS ftduedate,
  (CASE o_orderkey % 6 WHEN 0 THEN NULL WHEN 1 THEN 'abc' WHEN 2 THEN 'nan' ELSE CAST(o_custkey AS STRING) || '.25' END) AS fnbalamt,
  {dirty_text("'remark ' || o_orderpriority", "o_orderkey", 1)} AS fcremark1,
  {dirty_text("'deposit ' || o_orderstatus", "o_orderkey", 3)} AS fcremark2,
  CAST(o_orderkey % 5 AS STRING) || '.5' AS fcremark3,
  {dirty_text("'goal ' || CAST(o_custkey % 7 AS STRING)", "o_orderkey", 5)} AS fcremark4,
  (CASE o_orderkey % 2 WHEN 0 THEN 'Y' ELSE 'N' END) AS fcremark5,
  {flag("o_orderkey", 3)} AS fcisactive, {who("creator", "o_custkey", 7)} AS fccreator,
  {dirty_date("o_orderdate", "o_orderkey", 1)} AS ftcreatedate, {who("editor", "o_custkey", 5, 1)} AS fcupdateby,
  (CASE o_orderkey % 3 WHEN 0 THEN NULL ELSE {dirty_date("o_orderdate", "o_orderkey", 6)} END) AS ftupdatedate
FROM orders"""

# banks: 20 keys with versions (version = year), one per supplier
ADAPTERS["tmBNK"] = """
SELECT 'BNK' || CAST(s_suppkey % 20 AS STRING) AS fcid, ' BK' || CAST(s_suppkey % 20 AS STRING) AS fccode,
  'Bank ' || s_name AS fcname,
  CAST(2000 + floor(s_suppkey / 20) AS INT) AS calendar_year, CAST(1 AS INT) AS month_no, CAST(1 AS INT) AS day_of_month
FROM supplier"""

# ledger accounts: 300 keys with versions (version = year), one per part
ADAPTERS["tmACC"] = f"""
SELECT 'ACC' || CAST(p_partkey % 300 AS STRING) AS fcid, {dirty_text("'A' || CAST(p_partkey % 300 AS STRING)", "p_partkey")} AS fccode,
  'Account ' || p_name AS fcname,
  CAST(2000 + floor(p_partkey / 300) AS INT) AS calendar_year, CAST(1 AS INT) AS month_no, CAST(1 AS INT) AS day_of_month
FROM part"""

# loyalty members: one membership for each app user
ADAPTERS["tmMemberLoyalty"] = f"""
SELECT
  (CASE c_custkey % 4 WHEN 0 THEN 'MU' ELSE 'mu' END) || CAST(c_custkey AS STRING) AS fcuserid,
  {kdate("c_custkey", 4)} AS ftcreatedate, {kdate("c_custkey", 11)} AS ftupdatedate,
  CAST(2024 AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no, CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer"""

# share-a-friend links: two referrers at most for each app user, in versions
ADAPTERS["tmShareFriend"] = """
SELECT 'REF' || CAST(c_custkey + v AS STRING) AS fcuserid, 'mu' || CAST(c_custkey AS STRING) AS fcfrienduserid,
  CAST(2023 + v AS INT) AS calendar_year, CAST(1 + c_custkey % 12 AS INT) AS month_no, CAST(1 + c_custkey % 28 AS INT) AS day_of_month
FROM customer CROSS JOIN (SELECT 0 AS v UNION ALL SELECT 1) WHERE (c_custkey + v) % 3 > 0"""
