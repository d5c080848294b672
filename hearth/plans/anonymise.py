"""De-identified copies (X1, X2) of the flat layer and marts.

Every table is one narrow projection (no shuffle): ids and uuids hashed (F12;
HMAC-SHA256 under a release's ``key``, the form to release; md5 without a key
is the source job's form and can be undone by enumeration), dates coarsened to the first
day of their quarter (F6), ages in months to 3-month buckets (F7), names,
phones, addresses below district, identifiers and free text dropped.  The
identifying-concept blacklist (P8) is a broadcast anti join applied to the
observation table and to every snapshot derived from it.

Release is by allow-list: lookup tables are never released, and a column that
is in neither list (``released_columns``, ``DROP_COLUMNS`` and ``FREE_TEXT``)
stops the copy, so a new column is withheld until someone decides.

Decisions that close leaks of the source job: the visit table's encounter
date and the z-score table's observation date are coarsened too; free text
(``value_text``, ``comments``) is dropped unless ``keep_free_text``; the sex
column carries sex (not age in days).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from .. import operators as O

# Concepts whose observations identify a person (removed before release).
IDENTIFYING_CONCEPTS = [
    "NAME OF NEIGHBOR", "NAME OF SUPPORT PROVIDER", "GUARDIAN PHONE NUMBER", "TELEPHONE NUMBER OF CONTACT",
    "NAME OF REFERRING PERSON", "NAMES AND FIRSTNAMES OF CONTACT", "NAME OF HEALTH CARE PROVIDER", "TELEPHONE NUMBER",
    "GUARDIAN; NAME AND FIRST NAMES", "NAME OR LOCATION OF SPECIALIST", "LAST NAME OF COMMUNITY HEALTH WORKER, REPORTED",
    "FIRST NAMES OF COMMUNITY HEALTH WORKER, REPORTED", "NAME OF DATA COLLECTOR", "TELEPHONE NUMBER TYPE",
    "CELL TELEPHONE", "HOME TELEPHONE", "NEXT OF KIN TELEPHONE", "LASTNAME OF CONTACT", "FIRSTNAMES OF CONTACT",
    "FIRST NAME", "MIDDLE NAME", "LAST NAME", "MOTHER FIRST NAME", "FATHER NAME", "GUARDIAN LAST NAME",
    "SECONDARY TELEPHONE NUMBER", "ACCOMPAGNATEUR PHONE NUMBER", "RWANDAN MOTHERS NAME", "RWANDAN FATHERS NAME",
    "NAME OF DOCTOR", "FIRST NAME OF FATHER", "FIRST NAME OF MOTHER", "CELL PHONE", "GUARDIAN FIRST NAME",
    "Phone not reached", "Telephone number of clinician", "CLINICIAN TELEPHONE", "LAST NAME OF MOTHER",
    "Home visitor Name", "LAST NAME OF FATHER",
]

# Columns that hold an id under another name; a uuid is one kind wherever it stands.
ID_KINDS = {"enrollment_id": "program_enrollment_id", "diagnosis_status_program_enrollment_id": "program_enrollment_id",
            "diagnosis_status_patient_id": "patient_id", "last_art_visit_id": "art_visit_id", "last_eid_visit_id": "eid_visit_id",
            "last_viral_load_test_id": "lab_test_id", "last_viral_load_result_id": "lab_test_id", "group_id": "order_group_id"}

# Columns never released.
DROP_COLUMNS = {"first_name", "middle_name", "last_name", "phone_number", "city_village", "postal_code", "address1",
                "address2", "address3", "address4", "address5", "address6", "latitude", "longitude", "mothers_name",
                "fathers_name", "related_person", "identifier", "provider", "created_by", "orderer",
                "discontinued_by", "creator", "collector", "refunded_by", "owner", "name", "description",
                "instructions", "administration_instructions", "art_number", "eid_number", "pre_art_number",
                "ncd_number", "mother_art_number", "chw", "sample_id", "traditional_authority", "village",
                "mother_art_reg_no", "tb_registration_number", "child_hcc_no", "lab_location", "changed_by", "voided_by",
                "void_reason", "retire_reason", "order_set_description", "patient_name", "provider_name"}
FREE_TEXT = {"value_text", "comments", "discontinued_reason_non_coded"}

# Columns of the marts that may be released (ids hashed, dates coarsened); the flat tables' and forms'
# columns come from their declarations.
MART_COLUMNS = set("""
Last_start_date UNIT_PRICE age_months_at_start_date age_years_at_start_date agedays amount amount_3rd_part amount_insurance
amount_paid amount_patient amount_refunded asthma_classification asthma_followup asthma_initial auto_expire_date
bill_payment_id category_name cc_followup cc_initial clenhei collector_uuid completed_treatment complex concept_id
coverage_start_date created_date creatinine creator_uuid cv_disease cv_risk cycle_number date_changed date_collected
date_completed date_enrolled date_received date_result_entered date_result_received date_stopped_bf date_voided
diabetes_htn_followup diabetes_htn_initial diagnosis diagnosis_date diagnosis_status diagnosis_status_end_date
diagnosis_status_patient_id diagnosis_status_program diagnosis_status_program_enrollment_id diagnosis_status_start_date
diagnosis_status_workflow diastolic_bp discontinued_date discontinued_reason district dose drug encounter_datetime
encounter_type_id end_date_difference enrollment_id epilepsy_followup epilepsy_initial equivalent_daily_dose ever_enrolled
expiration_date first_discontinued first_start_date foot_check frequency fundoscopy group_id group_type hba1c
history_alcohol_use history_drug_use hiv_result hospitalized_since_last_visit indication initially_planned_end
insurance_company intervention_behavioral_activation intervention_family_support intervention_grief_counseling
intervention_hiv_counseling intervention_ipod intervention_parenting_skills intervention_psychoeducation
intervention_psychosocial_counseling intervention_psychotherapy intervention_relaxation intervention_security_plan
intervention_supportive_psychotherapy is_cash is_deposit is_paid lab_test_id last_appt_date last_art_visit_id
last_discontinued last_eid_visit_id last_obs_date last_test_date last_test_result last_viral_load_result_id
last_viral_load_test_id last_visit_date last_vl_date last_vl_exception last_vl_numeric lh line location_id location_name
lost_to_followup mental_health_drug_side_effect mental_health_drugs mental_health_followup mental_health_initial
mental_stable mental_status_exam ncd_visit_id next_appointment_date num_of_prev_regimens num_seizures oedema on_insulin
order_group_id order_id order_index order_set order_set_name order_set_uuid order_type_id outcome_concept_id
outcome_concept_name owner_uuid paid_quantity patient_bill_id patient_refused_treatment phq_9 pregnant previous_test_date
previous_test_result prn program_id program_name proteinuria quantity referral_role_doctor referral_role_nurse
referral_role_sws referred_by_oms referred_by_religious_institution referred_by_self referred_by_teacher
referred_by_traditional_healer referred_by_vhw refunded_by_person_uuid regimen regimen_end_date regimen_init_date
result_coded result_exception result_numeric retire_date return_visit_date route rx_dose_unit rx_drug_frequency
rx_medication rx_medication_duration rx_prescription_quantity rx_time_units sea_received_financial_aid
sea_received_housing_assistance sea_received_nutritional_assistance sea_received_school_assistance
sea_received_transport_assistance sea_recommended_financial_aid sea_recommended_housing_assistance
sea_recommended_nutritional_assistance sea_recommended_school_assistance sea_recommended_transport_assistance
seizure_activity serum_glucose service_name sex start_date_difference suicide_risk systolic_bp test_type third_part_rate
transferred_out units urgency visit_date visit_types visual_acuity voided weight fosa_id site_id
""".split())


def released_columns() -> set[str]:
    """Every column name that may be released, from the flat and form declarations and ``MART_COLUMNS``."""
    from ..schemas import FLAT, struct
    from .forms import FORMS
    flat = {f.name for schema in FLAT.values() for f in struct(schema).fields}
    forms = {c for spec in FORMS.values() for c in (spec.id_col, *(x.name for x in spec.columns), *(d.split()[0] for d in spec.ddl))}
    return (flat | forms | MART_COLUMNS) - DROP_COLUMNS - FREE_TEXT
SNAPSHOT_TABLES = ("rw_last_obs_in_period", "rw_last_vl_include_blanks", "mw_last_obs_in_period")


def _is_id(name: str) -> bool:
    n = name.lower()
    return n.endswith("_id") or n == "id" or n.endswith("uuid") or n == "uuid" or n == "r_id"


def id_kind(column: str) -> str:
    return "uuid" if column.lower().endswith("uuid") else ID_KINDS.get(column, column)


def anonymise(df: DataFrame, salt: str | None = None, keep_dates: bool = False, keep_free_text: bool = False,
              extra_drop=(), keep=(), key: bytes | None = None) -> DataFrame:
    """One table's release form (X1; ``keep_dates`` gives the X2 variant).
    Columns in ``keep`` pass through unchanged (e.g. the facility id in X2)."""
    drop = (set(DROP_COLUMNS) | set(extra_drop) | (set() if keep_free_text else FREE_TEXT)) - set(keep)
    cols = [f.name for f in df.schema.fields]
    ids = [c for c in cols if _is_id(c) and c not in drop and c not in keep]
    dates = [f.name for f in df.schema.fields
             if isinstance(f.dataType, (DateType, TimestampType, TimestampNTZType))]
    # date text columns (e.g. the z-score input's obs_date) are coarsened as dates
    text_dates = [c for c in cols if c.endswith("_date") and c not in dates and c not in ids]
    out = O.anonymise_table(df, id_cols=ids, date_cols=dates, age_month_cols=[c for c in cols if c.startswith("age_months")],
                            drop_cols=[c for c in cols if c in drop], keep_dates=keep_dates, salt=salt, key=key,
                            kinds={c: id_kind(c) for c in ids})
    if not keep_dates:
        for c in text_dates:
            out = out.withColumn(c, F.date_format(F.trunc(F.to_date(F.col(c)), "quarter"), "yyyy-MM-dd"))
    return out


def anonymise_warehouse(tables: dict[str, DataFrame], salt: str | None = None, keep_dates: bool = False,
                        keep_free_text: bool = False, blacklist=IDENTIFYING_CONCEPTS,
                        keep=(), key: bytes | None = None) -> dict[str, DataFrame]:
    """X1/X2 over a dict of tables: identifying observations removed (P8) from
    the observation table and every snapshot, then each table projected.  Lookup
    tables (names of people and places) are left out; an unknown column is an error."""
    out = {}
    known = released_columns() | DROP_COLUMNS | FREE_TEXT | set(keep)
    for name, df in tables.items():
        if name.startswith("lookup_"):
            continue
        unknown = sorted(set(df.columns) - known)
        if unknown:
            raise ValueError(f"{name}: no decision whether these columns may be released: {unknown}")
        x = df
        if (name == "omrs_obs" or name in SNAPSHOT_TABLES) and "concept" in df.columns:
            x = O.drop_concepts(x, "concept", list(blacklist))
        out[name] = anonymise(x, salt=salt, keep_dates=keep_dates, keep_free_text=keep_free_text, keep=keep, key=key)
    return out


def anonymise_unified(tables: dict[str, DataFrame], salt: str | None = None, key: bytes | None = None) -> dict[str, DataFrame]:
    """The unified multi-site copy -- ids hashed, dates kept, facility and
    site columns kept so rows can still be grouped by facility."""
    return anonymise_warehouse(tables, salt=salt, keep_dates=True, keep=("fosa_id", "site_id"), key=key)
