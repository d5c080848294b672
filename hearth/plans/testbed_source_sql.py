"""DuckDB oracles of the jobs bound in ``testbed_source``."""

from __future__ import annotations

from ..schemas import FLAT
from .liberia import OUTCOMES, RX_COLUMNS
from .schema_sql import duck_type
from .testbed_source import CID, PREFIX, TABLES
from .testbed_sql import full_months, full_years
from .unify import HIV_ENCOUNTER_TYPES, HIV_PROGRAMS


def _with(tables, *more: str) -> str:
    return "WITH " + ",\n".join([*(f"s_{n} AS MATERIALIZED ({TABLES[n]})" for n in dict.fromkeys(tables)), *more]) + "\n"


def _id(c: str) -> str:
    return f"CAST('{PREFIX}' || CAST({c} AS VARCHAR) AS BIGINT)"


def _columns(table: str) -> list[list[str]]:
    """(name, type) of a flat table's declared columns."""
    return [c.split() for c in FLAT[table].split(", ")]


def _select(table: str, **given: str) -> str:
    """Every declared column of a flat table: the given expression or null, in its declared type."""
    out = []
    for name, kind in _columns(table):
        out.append(f"CAST({given.pop(name, 'NULL')} AS {duck_type(kind)}) AS {name}")
    assert not given, given
    return "SELECT " + ",\n  ".join(out)


def _fold(c: str) -> str:
    return f"lower(trim({c}))"


def _ages(birth: str, at: str) -> tuple[str, str]:
    return tuple(f"CASE WHEN {birth} IS NOT NULL AND {at} IS NOT NULL THEN {fn(birth, f'CAST({at} AS DATE)')} END" for fn in (full_years, full_months))


def _best(name: str, table: str, key: str, order: str) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1)"


_CONCEPTS = _best("bc", "(SELECT * FROM s_concept_name WHERE NOT voided)", "concept_id",
                  f"({_fold('concept_name_type')} = 'fully_specified') DESC, ({_fold('locale')} = 'en') DESC, locale_preferred, concept_name_id") \
    + ",\nlc AS (SELECT c.concept_id AS k, bc.name AS v FROM s_concept c LEFT JOIN bc USING (concept_id))"
_LASTNAME = "concat_ws(' ', n.family_name_prefix, n.family_name, n.family_name2)"
_NAMES = _best("pn", "(SELECT * FROM s_person_name WHERE NOT voided)", "person_id", "preferred DESC, date_created DESC, person_name_id DESC")
_PROVIDERS = f"""pv AS (SELECT p.provider_id, p.uuid, coalesce(nullif(trim(CASE WHEN n.person_id IS NOT NULL THEN concat_ws(' ', n.given_name, n.middle_name,
  n.family_name_prefix, n.family_name, n.family_name2) END), ''), CASE WHEN trim(p.name) <> '' THEN p.name END, CASE WHEN trim(p.identifier) <> '' THEN p.identifier END,
  'Unknown') AS provider_name FROM s_provider p LEFT JOIN pn n USING (person_id))"""
_EP = f"""ep AS (SELECT x.encounter_provider_id, x.uuid, e.encounter_id, e.uuid AS encounter_uuid, pv.provider_name AS provider, r.name AS provider_role
  FROM s_encounter_provider x JOIN s_encounter e USING (encounter_id) LEFT JOIN pv USING (provider_id) LEFT JOIN s_encounter_role r USING (encounter_role_id)
  WHERE NOT x.voided AND NOT e.voided)"""
_EP_TABLES = ("encounter_provider", "encounter", "provider", "person_name", "encounter_role")
_ATTRIBUTES = _best("atr", "(SELECT a.*, t.name AS kind FROM s_person_attribute a JOIN s_person_attribute_type t USING (person_attribute_type_id) WHERE NOT a.voided)",
                    "person_id, kind", "date_created DESC, person_attribute_id DESC") \
    + ",\npa AS (SELECT person_id, " + ", ".join(f"max(value) FILTER (WHERE kind = '{k}') AS {c}" for k, c in (
        ("Cell Phone Number", "phone"), ("Mother''s Name", "mother"), ("Health Center", "center"), ("Test Patient", "test"))) + " FROM atr GROUP BY person_id)"
_Y, _M = _ages("pe.birthdate", "pe.death_date")
_OBS_Y, _OBS_M = _ages("pe.birthdate", "o.obs_datetime")
_E_Y, _E_M = _ages("pe.birthdate", "e.encounter_datetime")
_IDENT = """i.identifier IS NOT NULL AND trim(i.identifier) <> '' AND NOT i.voided
  AND EXISTS (SELECT 1 FROM s_patient p WHERE p.patient_id = i.patient_id AND NOT p.voided)"""


def _side(me: str, other: str, my_role: str, other_role: str) -> str:
    return f"""SELECT r.relationship_id, r.uuid, r.{me} AS patient_id, t.{my_role} AS patient_role, t.{other_role} AS related_person_role,
  CASE WHEN n.person_id IS NOT NULL THEN concat_ws(' ', n.given_name, n.middle_name, {_LASTNAME}) END AS related_person, r.start_date, r.date_created
  FROM s_relationship r JOIN s_relationship_type t ON t.relationship_type_id = r.relationship JOIN s_patient p ON p.patient_id = r.{me} AND NOT p.voided
  JOIN s_person m ON m.person_id = r.{me} AND NOT m.voided JOIN s_person o ON o.person_id = r.{other} AND NOT o.voided LEFT JOIN pn n ON n.person_id = o.person_id
  WHERE NOT r.voided AND r.person_a IS NOT NULL AND r.person_b IS NOT NULL AND t.{my_role} IS NOT NULL"""


_OBS_TABLES = ("obs", "person", "encounter", "encounter_type", "location", "form", "concept", "concept_name", "drug")
_OBS = """oo AS (SELECT o.*, pe.birthdate, et.name AS etype, l.name AS place, f.name AS form, q.v AS question, coalesce(a.v, d.name) AS answer,
  EXISTS (SELECT 1 FROM s_obs x WHERE NOT x.voided AND x.obs_group_id = o.obs_id) AS header
  FROM s_obs o JOIN s_person pe ON pe.person_id = o.person_id AND NOT pe.voided LEFT JOIN s_encounter e USING (encounter_id)
  LEFT JOIN s_encounter_type et ON et.encounter_type_id = e.encounter_type LEFT JOIN s_location l ON l.location_id = e.location_id
  LEFT JOIN s_form f ON f.form_id = e.form_id LEFT JOIN lc q ON q.k = o.concept_id LEFT JOIN lc a ON a.k = o.value_coded LEFT JOIN s_drug d ON d.drug_id = o.value_drug
  WHERE NOT o.voided)"""
_PP_Y, _PP_M = _ages("pe.birthdate", "x.date_enrolled")
_PC_Y, _PC_M = (f"CASE WHEN pe.birthdate IS NOT NULL THEN {fn('pe.birthdate', 'x.date_completed')} END" for fn in (full_years, full_months))
_FOSA = _best("fa", "(SELECT * FROM s_person_attribute WHERE person_attribute_type_id = 7 AND NOT voided)", "person_id", "date_created DESC, person_attribute_id DESC") \
    + """,\npf AS (SELECT person_id, coalesce(f.fosa_id, '0') AS fosa_id FROM fa LEFT JOIN s_location_fosa f ON CAST(f.location_id AS VARCHAR) = fa.value)"""
_SITES = "sites(code, suffix) AS (VALUES ('0001', ''), ('0003', ' (3)'))"


def _per_site(table: str, ids: tuple, person: str, tail: str, **given: str) -> str:
    """A flat table per site, ids as the site's code and the id."""
    cols = [f"sites.code || CAST({given.pop(c)} AS VARCHAR) AS {c}" if c in ids else f"{given.pop(c)} AS {c}" for c, _ in _columns(table)]
    return f"SELECT sites.code AS site_id, {', '.join(cols)}, coalesce(pf.fosa_id, '0') AS fosa_id {tail} LEFT JOIN pf ON pf.person_id = {person} CROSS JOIN sites"


SQL = {
    "o_patient": _with(("patient", "person", "person_name", "patient_identifier", "person_address", "person_attribute", "person_attribute_type", "concept", "concept_name",
                        "location"), _CONCEPTS, _NAMES, _ATTRIBUTES,
                       _best("pi", "(SELECT * FROM s_patient_identifier WHERE NOT voided)", "patient_id", "preferred DESC, date_created DESC, patient_identifier_id DESC"),
                       _best("ad", "(SELECT * FROM s_person_address WHERE NOT voided)", "person_id", "preferred DESC, date_created DESC, person_address_id DESC"))
    + _select("omrs_patient", patient_id=_id("p.patient_id"), patient_uuid="pe.uuid", identifier="pi.identifier", first_name="n.given_name", middle_name="n.middle_name",
              last_name=f"CASE WHEN n.person_id IS NOT NULL THEN {_LASTNAME} END", gender="pe.gender", birthdate="pe.birthdate", phone_number="pa.phone", country="ad.country",
              county_district="ad.county_district", city_village="ad.city_village", dead="pe.dead", death_date="pe.death_date", age_years_at_death=_Y, age_months_at_death=_M,
              cause_of_death="cd.v", mothers_name="pa.mother", health_center="coalesce(l.name, pa.center)", date_created="p.date_created")
    + """ FROM s_patient p JOIN s_person pe ON pe.person_id = p.patient_id AND NOT pe.voided LEFT JOIN pn n ON n.person_id = p.patient_id LEFT JOIN pi ON pi.patient_id = p.patient_id
  LEFT JOIN ad ON ad.person_id = p.patient_id LEFT JOIN pa ON pa.person_id = p.patient_id LEFT JOIN lc cd ON cd.k = pe.cause_of_death
  LEFT JOIN s_location l ON l.location_id = TRY_CAST(pa.center AS BIGINT) WHERE NOT p.voided AND (pa.test IS NULL OR lower(trim(pa.test)) <> 'true')""",
    "o_patient_identifier": _with(("patient", "patient_identifier", "patient_identifier_type", "location"))
    + _select("omrs_patient_identifier", patient_identifier_id=_id("i.patient_identifier_id"), uuid="i.uuid", patient_id=_id("i.patient_id"), type="t.name",
              identifier="i.identifier", location="l.name", date_created="i.date_created")
    + f" FROM s_patient_identifier i LEFT JOIN s_patient_identifier_type t ON t.patient_identifier_type_id = i.identifier_type LEFT JOIN s_location l USING (location_id) WHERE {_IDENT}",
    "o_relationship": _with(("relationship", "relationship_type", "patient", "person", "person_name"), _NAMES,
                            f"sides AS ({_side('person_a', 'person_b', 'a_is_to_b', 'b_is_to_a')} UNION ALL {_side('person_b', 'person_a', 'b_is_to_a', 'a_is_to_b')})")
    + _select("omrs_relationship", relationship_id=_id("relationship_id"), uuid="uuid", patient_id=_id("patient_id"), patient_role="patient_role",
              related_person_role="related_person_role", related_person="related_person", start_date="start_date", date_created="date_created") + " FROM sides",
    "o_encounter_provider": _with(_EP_TABLES, _NAMES, _PROVIDERS, _EP)
    + _select("omrs_encounter_provider", encounter_provider_id=_id("encounter_provider_id"), uuid="uuid", encounter_id=_id("encounter_id"), encounter_uuid="encounter_uuid",
              provider="provider", provider_role="provider_role") + " FROM ep",
    "o_encounter": _with((*_EP_TABLES, "person", "encounter_type", "form", "location", "users"), _NAMES, _PROVIDERS, _EP,
                         _best("one", "ep", "encounter_id", "encounter_provider_id"))
    + _select("omrs_encounter", encounter_id=_id("e.encounter_id"), uuid="e.uuid", patient_id=_id("e.patient_id"), encounter_type="et.name", form="f.name", location="l.name",
              encounter_date="e.encounter_datetime", encounter_time="strftime(e.encounter_datetime, '%H:%M:%S')", provider="one.provider", provider_role="one.provider_role",
              visit_id=_id("e.visit_id"), age_years_at_encounter=_E_Y, age_months_at_encounter=_E_M, date_created="e.date_created", created_by="coalesce(u.username, u.system_id)")
    + """ FROM s_encounter e JOIN s_person pe ON pe.person_id = e.patient_id AND NOT pe.voided LEFT JOIN s_encounter_type et ON et.encounter_type_id = e.encounter_type
  LEFT JOIN s_form f ON f.form_id = e.form_id LEFT JOIN s_location l ON l.location_id = e.location_id LEFT JOIN s_users u ON u.user_id = e.creator
  LEFT JOIN one ON one.encounter_id = e.encounter_id WHERE NOT e.voided""",
    "o_visit": _with(("visit", "visit_type", "location"))
    + _select("omrs_visit", visit_id=_id("v.visit_id"), uuid="v.uuid", patient_id=_id("v.patient_id"), visit_type="t.name", location="l.name", date_started="v.date_started",
              date_stopped="v.date_stopped", date_created="v.date_created")
    + " FROM s_visit v LEFT JOIN s_visit_type t USING (visit_type_id) LEFT JOIN s_location l USING (location_id) WHERE NOT v.voided",
    "o_obs": _with(_OBS_TABLES, _CONCEPTS, _OBS)
    + _select("omrs_obs", obs_id=_id("o.obs_id"), uuid="o.uuid", patient_id=_id("o.person_id"), encounter_id=_id("o.encounter_id"), obs_date="o.obs_datetime",
              obs_time="strftime(o.obs_datetime, '%H:%M:%S')", age_years_at_obs=_OBS_Y.replace("pe.", "o."), age_months_at_obs=_OBS_M.replace("pe.", "o."),
              encounter_type="o.etype", form="o.form", location="o.place", concept="o.question", value_coded="o.answer", value_date="o.value_datetime",
              value_numeric="o.value_numeric", value_text="o.value_text", obs_group_id=_id("o.obs_group_id"), date_created="o.date_created") + " FROM oo o WHERE NOT header",
    "o_obs_group": _with(_OBS_TABLES, _CONCEPTS, _OBS)
    + _select("omrs_obs_group", obs_group_id=_id("o.obs_id"), uuid="o.uuid", patient_id=_id("o.person_id"), encounter_id=_id("o.encounter_id"), obs_group_date="o.obs_datetime",
              obs_group_time="strftime(o.obs_datetime, '%H:%M:%S')", encounter_type="o.etype", location="o.place", concept="o.question", date_created="o.date_created")
    + " FROM oo o WHERE header",
    "o_program_enrollment": _with(("patient_program", "person", "program", "location", "concept", "concept_name"), _CONCEPTS)
    + _select("omrs_program_enrollment", program_enrollment_id=_id("x.patient_program_id"), uuid="x.uuid", patient_id=_id("x.patient_id"), program="q.v",
              enrollment_date="x.date_enrolled", age_years_at_enrollment=_PP_Y, age_months_at_enrollment=_PP_M, location="l.name", completion_date="x.date_completed",
              age_years_at_completion=_PC_Y, age_months_at_completion=_PC_M, outcome="oc.v")
    + """ FROM s_patient_program x JOIN s_person pe ON pe.person_id = x.patient_id AND NOT pe.voided JOIN s_program g USING (program_id) LEFT JOIN lc q ON q.k = g.concept_id
  LEFT JOIN lc oc ON oc.k = x.outcome_concept_id LEFT JOIN s_location l ON l.location_id = x.location_id WHERE NOT x.voided AND x.date_enrolled IS NOT NULL""",
    "l3_person_name": _with(("person", "person_name"), _NAMES)
    + f"SELECT p.uuid, n.given_name AS first_name, n.middle_name, {_LASTNAME} AS last_name FROM s_person p JOIN pn n USING (person_id)",
    "l4_provider_name": _with(("provider", "person_name"), _NAMES, _PROVIDERS) + "SELECT uuid, provider_name FROM pv",
    "l5_concept_by_tag": _with(("concept", "concept_name", "concept_name_tag_map"), _best("b", """(SELECT *, concept_name_id IN (SELECT concept_name_id FROM s_concept_name_tag_map
  WHERE concept_name_tag_id = 4) AS tagged FROM s_concept_name WHERE NOT voided)""", "concept_id", f"({_fold('locale')} = 'en') DESC, tagged DESC, date_created NULLS LAST, concept_name_id"))
    + "SELECT CAST(c.concept_id AS BIGINT) AS source_key, b.name AS target_value FROM s_concept c LEFT JOIN b USING (concept_id)",
    "f23_user": _with(("encounter", "users")) + "SELECT encounter_id, creator, coalesce(username, system_id) AS created_by FROM s_encounter LEFT JOIN s_users ON user_id = creator",
    "x4_patient_facility": _with(("person_attribute", "location_fosa"), _FOSA) + "SELECT * FROM pf",
    "x3_identifiers": _with(("patient", "patient_identifier", "patient_identifier_type", "location", "person_attribute", "location_fosa"), _FOSA, _SITES)
    + _per_site("omrs_patient_identifier", ("patient_identifier_id", "patient_id"), "i.patient_id",
                "FROM (SELECT * FROM s_patient_identifier i WHERE " + _IDENT + ") i LEFT JOIN s_patient_identifier_type t ON t.patient_identifier_type_id = i.identifier_type "
                "LEFT JOIN s_location l USING (location_id)", patient_identifier_id="i.patient_identifier_id", uuid="i.uuid", patient_id="i.patient_id", type="t.name",
                identifier="i.identifier", location="l.name || sites.suffix", date_created="CAST(i.date_created AS DATE)"),
    "x3_visits": _with(("visit", "visit_type", "location", "person_attribute", "location_fosa"), _FOSA, _SITES)
    + _per_site("omrs_visit", ("visit_id", "patient_id"), "v.patient_id", "FROM (SELECT * FROM s_visit WHERE NOT voided) v LEFT JOIN s_visit_type t USING (visit_type_id) "
                "LEFT JOIN s_location l USING (location_id)", visit_id="v.visit_id", uuid="v.uuid", patient_id="v.patient_id", visit_type="t.name", location="l.name || sites.suffix",
                date_started="CAST(v.date_started AS DATE)", date_stopped="CAST(v.date_stopped AS DATE)", date_created="CAST(v.date_created AS DATE)"),
    "x6_encounters": _with(("encounter", "encounter_type", "person", "patient_program", "program", "concept", "concept_name"), _CONCEPTS,
                           f"""co AS (SELECT x.patient_id FROM s_patient_program x JOIN s_person pe ON pe.person_id = x.patient_id AND NOT pe.voided JOIN s_program g USING (program_id)
  JOIN lc ON lc.k = g.concept_id WHERE NOT x.voided AND x.date_enrolled IS NOT NULL AND lower(lc.v) IN ({', '.join(repr(p.lower()) for p in HIV_PROGRAMS)}))""")
    + f"""SELECT {_id('e.encounter_id')} AS encounter_id, {_id('e.patient_id')} AS patient_id, t.name AS encounter_type
  FROM s_encounter e JOIN s_person pe ON pe.person_id = e.patient_id AND NOT pe.voided LEFT JOIN s_encounter_type t ON t.encounter_type_id = e.encounter_type
  WHERE NOT e.voided AND (t.name IS NULL OR lower(t.name) IN ({', '.join(repr(p.lower()) for p in HIV_ENCOUNTER_TYPES)}) OR e.patient_id IN (SELECT patient_id FROM co))""",
}

# ---------------------------------------------------------------- orders and bills
_ORDER_Y, _ORDER_M = _ages("pe.birthdate", "o.start_date")
_USER = "usr AS (SELECT u.user_id, p.uuid FROM s_users u LEFT JOIN s_person p USING (person_id))"
SQL |= {
    "r_location": _with(("location_full",)) + f"""SELECT {_id('location_id')} AS location_id, name, description, address1, CAST(NULL AS VARCHAR) AS address2, CAST(NULL AS VARCHAR) AS address3,
  CAST(NULL AS VARCHAR) AS address4, CAST(NULL AS VARCHAR) AS city_village, CAST(NULL AS VARCHAR) AS state_province, CAST(NULL AS VARCHAR) AS country,
  CAST(NULL AS VARCHAR) AS county_district FROM s_location_full WHERE NOT retired""",
    "r_order": _with(("orders", "person", "orderextension_order", "encounter", "orderextension_order_group", "orderextension_order_set", "drug_order", "drug", "concept",
                      "concept_name", "encounter_type", "location", "users"), _CONCEPTS)
    + f"""SELECT {_id('o.order_id')} AS order_id, o.order_type_id, c1.v AS concept, coalesce(u1.username, u1.system_id) AS orderer, o.instructions, o.start_date,
  CAST(NULL AS DATE) AS auto_expire_date, o.discontinued_date, coalesce(u2.username, u2.system_id) AS discontinued_by, c2.v AS discontinued_reason,
  {_id('o.patient_id')} AS patient_id, o.uuid, CAST(NULL AS VARCHAR) AS discontinued_reason_non_coded, o.urgency, o.date_created, {_id('o.encounter_id')} AS encounter_id,
  et.name AS encounter_type, l.name AS location, {_id('x.group_id')} AS group_id, x.order_index, c3.v AS indication, c4.v AS route, x.administration_instructions,
  d.dose, d.equivalent_daily_dose, d.units, d.frequency, d.prn, d.complex, d.quantity, os.name AS order_set, CAST({_ORDER_Y} AS BIGINT) AS age_years_at_start_date,
  CAST({_ORDER_M} AS BIGINT) AS age_months_at_start_date, dr.name AS drug
  FROM s_orders o JOIN s_person pe ON pe.person_id = o.patient_id AND NOT pe.voided LEFT JOIN s_orderextension_order x USING (order_id)
  LEFT JOIN s_encounter e ON e.encounter_id = o.encounter_id LEFT JOIN s_orderextension_order_group g ON g.id = x.group_id LEFT JOIN s_orderextension_order_set os ON os.id = g.order_set_id
  LEFT JOIN s_drug_order d ON d.order_id = o.order_id LEFT JOIN s_drug dr ON dr.drug_id = d.drug_inventory_id LEFT JOIN lc c1 ON c1.k = o.concept_id
  LEFT JOIN lc c2 ON c2.k = o.discontinued_reason LEFT JOIN lc c3 ON c3.k = x.indication LEFT JOIN lc c4 ON c4.k = x.route
  LEFT JOIN s_encounter_type et ON et.encounter_type_id = e.encounter_type LEFT JOIN s_location l ON l.location_id = e.location_id
  LEFT JOIN s_users u1 ON u1.user_id = o.orderer LEFT JOIN s_users u2 ON u2.user_id = o.discontinued_by WHERE NOT o.voided""",
    "r_order_group": _with(("orders", "orderextension_order", "orderextension_order_group", "orderextension_order_set"),
                           """per AS (SELECT x.group_id, min(o.start_date) AS f, max(o.start_date) AS l, min(o.discontinued_date) AS df, max(o.discontinued_date) AS dl,
  max(o.patient_id) AS patient_id FROM s_orders o JOIN s_orderextension_order x USING (order_id) GROUP BY x.group_id)""")
    + f"""SELECT {_id('g.id')} AS order_group_id, g.uuid, g.group_type, g.cycle_number, g.date_created, s.uuid AS order_set_uuid, s.name AS order_set_name,
  s.description AS order_set_description, CAST(s.indication AS BIGINT) AS indication, per.f AS first_start_date, per.l AS Last_start_date, per.df AS first_discontinued,
  per.dl AS last_discontinued, {_id('per.patient_id')} AS patient_id, per.f + CAST(s.cycle_length AS INTEGER) AS initially_planned_end
  FROM s_orderextension_order_group g JOIN per ON per.group_id = g.id LEFT JOIN s_orderextension_order_set s ON s.id = g.order_set_id
  WHERE NOT g.voided AND per.patient_id IS NOT NULL""",
    "r_bill": _with(("moh_bill_patient_bill", "moh_bill_consommation", "moh_bill_beneficiary", "moh_bill_third_party_bill", "moh_bill_insurance_bill", "users", "person"), _USER)
    + """SELECT b.patient_id, CAST(p.amount + t.amount + i.amount AS DECIMAL(20,2)) AS amount, t.amount AS amount_3rd_part, i.amount AS amount_insurance, p.amount AS amount_patient,
  p.is_paid, c.created_date, CAST(NULL AS VARCHAR) AS creator, usr.uuid AS creator_uuid, p.patient_bill_id
  FROM s_moh_bill_patient_bill p JOIN s_moh_bill_consommation c USING (patient_bill_id) LEFT JOIN s_moh_bill_beneficiary b USING (beneficiary_id)
  LEFT JOIN s_moh_bill_third_party_bill t USING (third_party_bill_id) LEFT JOIN s_moh_bill_insurance_bill i USING (insurance_bill_id) LEFT JOIN usr ON usr.user_id = c.creator
  WHERE NOT p.voided AND c.created_date IS NOT NULL""",
    "r_payment": _with(("moh_bill_payment", "moh_bill_cash_payment", "moh_bill_deposit_payment", "moh_bill_consommation", "moh_bill_beneficiary", "users", "person"), _USER)
    + """SELECT p.bill_payment_id, p.amount_paid, p.date_received, CAST(NULL AS VARCHAR) AS collector, usr.uuid AS collector_uuid,
  (SELECT count(*) FROM s_moh_bill_cash_payment x WHERE x.cash_payment_id = p.bill_payment_id) AS is_cash,
  (SELECT count(*) FROM s_moh_bill_deposit_payment x WHERE x.deposit_payment_id = p.bill_payment_id) AS is_deposit,
  (SELECT max(b.patient_id) FROM s_moh_bill_consommation c JOIN s_moh_bill_beneficiary b USING (beneficiary_id) WHERE c.patient_bill_id = p.patient_bill_id) AS patient_id,
  p.patient_bill_id FROM s_moh_bill_payment p LEFT JOIN usr ON usr.user_id = p.collector WHERE NOT p.voided""",
    "r_refund": _with(("moh_bill_payment_refund", "users", "person"), _USER) + """SELECT bill_payment_id, CAST(NULL AS VARCHAR) AS refunded_by, amount_refunded,
  usr.uuid AS refunded_by_person_uuid FROM s_moh_bill_payment_refund r LEFT JOIN usr ON usr.user_id = r.refunded_by WHERE NOT r.voided""",
    "r_insurance_policy": _with(("moh_bill_insurance_policy", "moh_bill_insurance", "moh_bill_beneficiary", "person", "moh_bill_third_party"))
    + """SELECT b.patient_id, CAST(NULL AS VARCHAR) AS owner, p.coverage_start_date, p.expiration_date, CAST(NULL AS DATE) AS retire_date, CAST(NULL AS VARCHAR) AS retire_reason,
  t.rate AS third_part_rate, i.name AS insurance_company, o.uuid AS owner_uuid FROM s_moh_bill_insurance_policy p LEFT JOIN s_moh_bill_insurance i USING (insurance_id)
  LEFT JOIN s_moh_bill_beneficiary b USING (insurance_policy_id) LEFT JOIN s_person o ON o.person_id = p.owner LEFT JOIN s_moh_bill_third_party t USING (third_party_id)""",
    "r_patient_service": _with(("moh_bill_patient_service_bill", "moh_bill_consommation", "moh_bill_beneficiary", "moh_bill_billable_service", "moh_bill_facility_service_price",
                                "moh_bill_service_category"))
    + """SELECT b.patient_id, s.unit_price AS UNIT_PRICE, s.quantity, s.paid_quantity, CAST(s.created_date AS DATE) AS created_date, CAST(s.is_paid AS BIGINT) AS is_paid,
  f.name AS service_name, c.patient_bill_id, k.name AS category_name FROM s_moh_bill_patient_service_bill s LEFT JOIN s_moh_bill_consommation c USING (consommation_id)
  LEFT JOIN s_moh_bill_beneficiary b USING (beneficiary_id) LEFT JOIN s_moh_bill_billable_service v USING (billable_service_id)
  LEFT JOIN s_moh_bill_facility_service_price f USING (facility_service_price_id) LEFT JOIN s_moh_bill_service_category k USING (service_category_id) WHERE NOT s.voided""",
}

# ---------------------------------------------------------------- Liberia
_EN = _best("en", f"(SELECT * FROM s_concept_name WHERE NOT voided AND {_fold('locale')} = 'en' AND locale_preferred)", "concept_id", "concept_name_id")
_TERM = {"pregnant": (CID["PATIENT PREGNANT"], "CAST(max(value_coded) FILTER ({w}) AS BOOLEAN)"), "phq_9": (CID["Weight"], "max(value_numeric) FILTER ({w})"),
         "return_visit_date": (CID["RETURN VISIT DATE"], "max(value_datetime) FILTER ({w})")}
SQL |= {
    "lb1_mh_encounter": _with(("encounter", "obs", "concept_name", "concept_reference_map"), _EN)
    + f"""SELECT {_id('e.encounter_id')} AS encounter_id, {_id('e.patient_id')} AS patient_id, e.encounter_datetime, e.visit_id,
  {', '.join(f"{x.format(w=f'WHERE o.concept_id = {c}')} AS {n}" for n, (c, x) in _TERM.items())},
  CASE WHEN count(*) FILTER (WHERE o.concept_id = {CID['Type of referral role']} AND en.name = 'DOCTOR') > 0 THEN true END AS referral_role_doctor,
  CAST(NULL AS BOOLEAN) AS referral_role_nurse,
  CASE WHEN count(*) FILTER (WHERE o.concept_id = {CID['Mental health intervention']} AND en.name = 'Psychotherapy') > 0 THEN true END AS intervention_psychotherapy
  FROM s_encounter e JOIN s_obs o USING (encounter_id) LEFT JOIN en ON en.concept_id = o.value_coded
  WHERE e.encounter_type = 2 AND NOT o.voided AND o.concept_id IN (SELECT concept_id FROM s_concept_reference_map)
  GROUP BY e.encounter_id, e.patient_id, e.encounter_datetime, e.visit_id""",
    "lb2_prescriptions": _with(("obs", "concept_name", "encounter", "encounter_type"), _EN)
    + "SELECT h.obs_id AS obs_group_id, e.encounter_id, e.patient_id, e.encounter_type AS encounter_type_id, t.name AS encounter_type, "
    + ", ".join(f"max({'a.name' if what == 'name' else 'm.value_numeric'}) FILTER (WHERE q.name IN ({', '.join(repr(x) for x in names)})) AS {c}" for c, names, what in RX_COLUMNS)
    + f""" FROM s_obs h JOIN s_encounter e USING (encounter_id) JOIN s_encounter_type t ON t.encounter_type_id = e.encounter_type LEFT JOIN s_obs m ON m.obs_group_id = h.obs_id
  LEFT JOIN en q ON q.concept_id = m.concept_id LEFT JOIN en a ON a.concept_id = m.value_coded WHERE h.concept_id = {CID['Prescription construct']}
  GROUP BY h.obs_id, e.encounter_id, e.patient_id, e.encounter_type, t.name""",
    "lb3_program_statistics": _with(("program", "patient_program", "concept_name"), _EN)
    + "SELECT g.name, CAST(g.concept_id AS BIGINT) AS concept_id, count(x.date_enrolled) AS ever_enrolled, "
    + ", ".join(f"count(*) FILTER (WHERE en.name = '{n}') AS {c}" for c, n in OUTCOMES)
    + " FROM s_program g LEFT JOIN s_patient_program x USING (program_id) LEFT JOIN en ON en.concept_id = x.outcome_concept_id GROUP BY g.program_id, g.name, g.concept_id",
    "lb4_program_enrollment": _with(("program", "patient_program", "concept_name", "location"), _EN)
    + """SELECT x.patient_program_id AS program_enrollment_id, x.patient_id, g.name AS program_name, x.date_enrolled, x.date_completed, l.name AS location_name,
  en.name AS outcome_concept_name, x.voided, x.uuid FROM s_patient_program x JOIN s_program g USING (program_id) LEFT JOIN en ON en.concept_id = x.outcome_concept_id
  LEFT JOIN s_location l ON l.location_id = x.location_id""",
}
