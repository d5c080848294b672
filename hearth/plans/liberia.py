"""Liberia mart (LB1-LB4).

``mh_encounter`` and ``rx_prescriptions`` are conditional-max pivots (A7):
one grouped aggregate per encounter / per prescription group over
observations decoded through the concept reference map (source + code) and
the preferred English concept names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from ..schemas import LIBERIA_OUT, conform

# Mental-health encounter columns as (column, source, code, answer name or value kind).
# A named answer gives TRUE when present; 'name' takes the answer's name, 'numeric' / 'coded' / 'datetime'
# take that value of the observation.
MH_COLUMNS = [
    ("referred_by_teacher", "PIH", "Role of referring person", "Teacher"),
    ("referred_by_traditional_healer", "PIH", "Role of referring person", "TRADITIONAL HEALER"),
    ("referred_by_vhw", "PIH", "Role of referring person", "VILLAGE HEALTH WORKER"),
    ("referred_by_religious_institution", "PIH", "Role of referring person", "Religious institution"),
    ("referred_by_self", "PIH", "Role of referring person", "Self-refer"),
    ("referred_by_oms", "PIH", "Role of referring person", "Other medical service"),
    ("referral_role_doctor", "PIH", "Type of referral role", "DOCTOR"),
    ("referral_role_nurse", "PIH", "Type of referral role", "NURSE"),
    ("referral_role_sws", "PIH", "Type of referral role", "SOCIAL WORKER SERVICE"),
    ("hospitalized_since_last_visit", "PIH", "PATIENT HOSPITALIZED SINCE LAST VISIT", "name"),
    ("phq_9", "CIEL", "165137", "numeric"),
    ("pregnant", "PIH", "PATIENT PREGNANT", "coded"),
    ("history_alcohol_use", "PIH", "HISTORY OF ALCOHOL USE", "name"),
    ("history_drug_use", "PIH", "HISTORY OF ILLEGAL DRUGS", "name"),
    ("intervention_supportive_psychotherapy", "PIH", "Mental health intervention", "Supportive psychotherapy"),
    ("intervention_psychotherapy", "PIH", "Mental health intervention", "Psychotherapy"),
    ("intervention_psychoeducation", "PIH", "Mental health intervention", "Psychoeducation"),
    ("intervention_relaxation", "PIH", "Mental health intervention", "Relaxation"),
    ("intervention_family_support", "PIH", "Mental health intervention", "Family Support"),
    ("intervention_grief_counseling", "PIH", "Mental health intervention", "Grief counseling"),
    ("intervention_parenting_skills", "PIH", "Mental health intervention", "Parenting skills"),
    ("intervention_behavioral_activation", "PIH", "Mental health intervention", "Behavioral activation"),
    ("intervention_security_plan", "PIH", "Mental health intervention", "Security plan"),
    ("intervention_psychosocial_counseling", "PIH", "Mental health intervention", "PSYCHOSOCIAL COUNSELING"),
    ("intervention_hiv_counseling", "PIH", "Mental health intervention", "HIV/AIDS counseling"),
    ("intervention_ipod", "PIH", "Mental health intervention", "Informing patient of diagnosis"),
    ("sea_received_financial_aid", "PIH", "2156", "Financial aid"),
    ("sea_recommended_financial_aid", "PIH", "2157", "Financial aid"),
    ("sea_received_transport_assistance", "PIH", "2156", "Transport assistance"),
    ("sea_recommended_transport_assistance", "PIH", "2157", "Transport assistance"),
    ("sea_received_nutritional_assistance", "PIH", "2156", "Nutritional assistance"),
    ("sea_recommended_nutritional_assistance", "PIH", "2157", "Nutritional assistance"),
    ("sea_received_school_assistance", "PIH", "2156", "School assistance"),
    ("sea_recommended_school_assistance", "PIH", "2157", "School assistance"),
    ("sea_received_housing_assistance", "PIH", "2156", "Housing assistance"),
    ("sea_recommended_housing_assistance", "PIH", "2157", "Housing assistance"),
    ("return_visit_date", "PIH", "RETURN VISIT DATE", "datetime"),
]
MH_ENCOUNTER_TYPE_UUID = "a8584ab8-cc2a-11e5-9956-625662870761"
MH_VALUE_KINDS = {"name": "__answer", "numeric": "value_numeric", "coded": "value_coded", "datetime": "value_datetime"}

# Prescription construct columns as (column, question names, value kind).
RX_CONSTRUCT = "Prescription construct"
RX_COLUMNS = [
    ("rx_medication", ("Mental health medication", "Medication orders"), "name"),
    ("rx_prescription_quantity", ("Quantity of medication prescribed per dose",), "numeric"),
    ("rx_dose_unit", ("Dosing units, coded",), "name"),
    ("rx_drug_frequency", ("HUM Drug frequency",), "name"),
    ("rx_medication_duration", ("Medication duration",), "numeric"),
    ("rx_time_units", ("Time units",), "name"),
]

# Outcome names counted per programme.
OUTCOMES = [("completed_treatment", "Patient completed treatment"), ("transferred_out", "Patient transferred out"),
            ("dead", "Patient died"), ("lost_to_followup", "Lost to followup"),
            ("patient_refused_treatment", "Patient refused treatment")]


def preferred_english_names(src: dict) -> DataFrame:
    """One preferred English name per concept (live names; smallest id on ties)."""
    cn = src["concept_name"].where(~F.coalesce(F.col("voided"), F.lit(False)) & H.ci_eq("locale", "en") &
                                   F.coalesce(F.col("locale_preferred"), F.lit(False)))
    return O.best_per_key(cn, "concept_id", [F.col("concept_name_id").asc()]).select("concept_id", "name")


def _coded_obs(src: dict, voided: bool = False) -> DataFrame:
    """Observations with the name of their coded answer (``voided``: voided ones too)."""
    names = preferred_english_names(src)
    o = src["obs"] if voided else src["obs"].where(~F.coalesce(F.col("voided"), F.lit(False)))
    return o.join(names.select(F.col("concept_id").alias("value_coded"), F.col("name").alias("__answer")),
                  "value_coded", "left")


def mh_encounter(src: dict, encounter_type_uuid: str = MH_ENCOUNTER_TYPE_UUID, prefix: str | None = None) -> DataFrame:
    """LB1: one row per mental-health encounter with 37 columns, each the max of
    a case over the encounter's observations matched by (reference source, code)."""
    terms = (src["concept_reference_map"].join(src["concept_reference_term"], "concept_reference_term_id")
             .join(src["concept_reference_source"].withColumnRenamed("name", "__source"), "concept_source_id")
             .select("concept_id", "__source", F.col("code").alias("__code")))
    et = src["encounter_type_uuid"].where(F.col("uuid") == encounter_type_uuid).select(
        F.col("encounter_type_id").alias("encounter_type"))
    enc = src["encounter"].join(et, "encounter_type", "left_semi").select(
        "encounter_id", "patient_id", "encounter_datetime", "visit_id")
    o = _coded_obs(src).join(enc.select("encounter_id"), "encounter_id", "left_semi").join(terms, "concept_id")
    aggs = []
    for col, source, code, what in MH_COLUMNS:
        cond = (F.col("__source") == source) & (F.col("__code") == code)
        if what in MH_VALUE_KINDS:
            aggs.append(F.max(F.when(cond, F.col(MH_VALUE_KINDS[what]))).alias(col))
        else:
            aggs.append(F.max(F.when(cond & (F.col("__answer") == what), F.lit(True))).alias(col))
    piv = o.groupBy("encounter_id").agg(*aggs)
    out = enc.join(piv, "encounter_id", "inner")
    out = out.withColumn("pregnant", F.col("pregnant").cast("boolean"))
    return out.withColumn("encounter_id", H.prefix_id("encounter_id", prefix)).withColumn(
        "patient_id", H.prefix_id("patient_id", prefix))


def rx_prescriptions(src: dict) -> DataFrame:
    """LB2: one row per prescription obs group: medication, quantity, dose unit,
    frequency, duration and time unit from the group's member observations.
    Voided observations count, as in the source query; a header is an observation
    whose concept has the construct's name in any language."""
    names = preferred_english_names(src)
    construct = src["concept_name"].where(F.col("name") == RX_CONSTRUCT).select("concept_id").distinct()
    headers = src["obs"].join(construct, "concept_id", "left_semi").select(F.col("obs_id").alias("obs_group_id"), "encounter_id")
    members = _coded_obs(src, voided=True).where(F.col("obs_group_id").isNotNull()) \
        .join(names.select("concept_id", F.col("name").alias("__question")), "concept_id")
    aggs = []
    for col, questions, what in RX_COLUMNS:
        cond = F.col("__question").isin(list(questions))
        aggs.append(F.max(F.when(cond, F.col("__answer" if what == "name" else "value_numeric"))).alias(col))
    piv = members.join(headers.select("obs_group_id"), "obs_group_id", "left_semi").groupBy("obs_group_id").agg(*aggs)
    enc = src["encounter"].select("encounter_id", "patient_id", F.col("encounter_type").alias("encounter_type_id"))
    et = src["encounter_type"].select(F.col("encounter_type_id"), F.col("name").alias("encounter_type"))
    out = headers.join(piv, "obs_group_id", "left").join(enc, "encounter_id").join(et, "encounter_type_id")
    return out.select("obs_group_id", "encounter_id", "patient_id", "encounter_type_id", "encounter_type",
                      *[c for c, _, _ in RX_COLUMNS])


def program_statistics(src: dict) -> DataFrame:
    """LB3 (A8): per programme, how many enrollments ever, and per outcome --
    programmes without patients kept with zeros; one name per outcome concept."""
    names = preferred_english_names(src).select(F.col("concept_id").alias("outcome_concept_id"),
                                                F.col("name").alias("__outcome"))
    pp = src["patient_program"].join(names, "outcome_concept_id", "left")
    cases = {"ever_enrolled": F.col("date_enrolled").isNotNull()}
    cases.update({c: F.col("__outcome") == n for c, n in OUTCOMES})
    counts = O.conditional_sums(pp, ["program_id"], cases, all_keys=src["program"])
    return src["program"].select("program_id", "name", "concept_id").join(counts, "program_id").drop("program_id")


def program_enrollment(src: dict) -> DataFrame:
    """LB4: every enrollment (voided included, ids as stored) with programme,
    location and outcome names."""
    names = preferred_english_names(src).select(F.col("concept_id").alias("outcome_concept_id"),
                                                F.col("name").alias("outcome_concept_name"))
    pp = src["patient_program"].join(src["program"].select("program_id", F.col("name").alias("program_name")),
                                     "program_id", "inner")
    pp = pp.join(names, "outcome_concept_id", "left")
    pp = O.decode(pp, src["location"], "location_id", "location_id", "name", "location_name")
    out = pp.select(F.col("patient_program_id").alias("program_enrollment_id"), "patient_id", "program_id",
                    "program_name", "date_enrolled", "date_completed", "location_id", "location_name",
                    "outcome_concept_id", "outcome_concept_name", "voided", "uuid")
    return conform(out, LIBERIA_OUT["program_enrollment"])
