"""All table specs in run order (M4).  Specs that share a warehouse table (K6) run in
this order; the dim_party member-status update reads what the other party builders
wrote, so it runs after them."""

from __future__ import annotations

from tamarind.plans import company, project, unit, user


def _by_name(specs):
    return {s.name: s for s in specs}


_USER = _by_name(user.SPECS)
_COMPANY = _by_name(company.SPECS)
_PROJECT = _by_name(project.SPECS)
_UNIT = _by_name(unit.SPECS)

ORDER = [
    # user domain
    ("user", "fact_authuser"), ("user", "dim_party_homeservice"), ("user", "dim_party_gu"),
    ("user", "dim_party_ru"), ("user", "dim_party_memberstatus"), ("user", "dim_userpermission"),
    ("user", "fact_user"), ("user", "fact_userpermission"), ("user", "dim_device_detail"),
    ("user", "dim_mobile_user"), ("user", "fact_unitresident"), ("user", "fact_userconsent"),
    ("user", "dim_pmsuserprofile"), ("user", "fact_pmsinvitations"), ("user", "fact_pmsuser_role"),
    # company domain
    ("company", "dim_pmscompany"), ("company", "fact_pmsinvitation_company"),
    ("company", "fact_pmsinvitationhist_company"),
    # project domain
    ("project", "dim_address"), ("project", "dim_address_mobileuser"), ("project", "dim_address_type"),
    ("project", "dim_postcode"), ("project", "dim_project"), ("project", "dim_project_profile"),
    ("project", "dim_project_bookbank"), ("project", "dim_pmsproject"), ("project", "dim_pmsrole_permission"),
    ("project", "fact_pmscompany_projects"), ("project", "fact_pmsinvitation_project"),
    ("project", "fact_pmsinvitationhist_project"), ("project", "fact_pmsproject_features"),
    # unit domain
    ("unit", "dim_unit"), ("unit", "fact_unit"),
]

_DOMAINS = {"user": _USER, "company": _COMPANY, "project": _PROJECT, "unit": _UNIT}
SPECS = [_DOMAINS[d][n] for d, n in ORDER]
BY_NAME = {s.name: s for s in SPECS}

assert len(SPECS) == 33 and len(BY_NAME) == 33, "every builder is registered exactly once"
assert sum(len(v) for v in _DOMAINS.values()) == 33, "no builder is left out of the run order"
