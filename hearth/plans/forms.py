"""Form and visit tables as data (SURVEY Appendix B) and their compiler.

A ``FormSpec`` names the spine encounter types and the columns; ``build_form``
turns it into one observation<->encounter join, one grouped aggregate (plus a
second one keyed also by ``obs_group_id`` for grouped columns) and a left join
from the spine -- never one scan and join per column.  Visit keys are
``(patient_id, visit_date, location)`` with location matched null-safe.

Fixed values: the concept names and encounter-type names below must equal
the source dictionary's names for results to match.  This round carries the
visit tables and the smaller forms; the remaining Appendix B forms are the
same data shape and are added as specs.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import operators as O
from ..functions import ci_in
from ..operators.pivot import PivotColumn as C
from ..schemas import conform
from .forms_data import FORM_TABLES


@dataclass(frozen=True)
class FormSpec:
    table: str
    id_col: str
    types: tuple
    columns: tuple
    grouped: frozenset = frozenset()   # columns keyed also by obs_group_id (+grp)
    untyped: frozenset = frozenset()   # columns scanned without the encounter-type filter (†)
    ddl: tuple = ()                    # output columns "name type" (Appendix C)


FORMS = {name: FormSpec(name, **spec) for name, spec in FORM_TABLES.items()}

NCD_TYPES = ("CHRONIC_CARE_INITIAL", "CHRONIC_CARE_FOLLOWUP", "DIABETES HYPERTENSION INITIAL VISIT",
             "DIABETES HYPERTENSION FOLLOWUP", "ASTHMA_INITIAL", "ASTHMA_FOLLOWUP", "EPILEPSY_INITIAL",
             "EPILEPSY_FOLLOWUP", "MENTAL_HEALTH_INITIAL", "MENTAL_HEALTH_FOLLOWUP")
NCD_FLAGS = {"cc_initial": "CHRONIC_CARE_INITIAL", "cc_followup": "CHRONIC_CARE_FOLLOWUP",
             "diabetes_htn_initial": "DIABETES HYPERTENSION INITIAL VISIT",
             "diabetes_htn_followup": "DIABETES HYPERTENSION FOLLOWUP", "asthma_initial": "ASTHMA_INITIAL",
             "asthma_followup": "ASTHMA_FOLLOWUP", "epilepsy_initial": "EPILEPSY_INITIAL",
             "epilepsy_followup": "EPILEPSY_FOLLOWUP", "mental_health_initial": "MENTAL_HEALTH_INITIAL",
             "mental_health_followup": "MENTAL_HEALTH_FOLLOWUP"}
# value scans over every observation of the visit (no encounter-type filter, †)
NCD_VISIT_COLUMNS = (
    C("next_appointment_date", "Appointment date", "value_date", agg="min"),
    C("asthma_classification", "Asthma classification", "value_coded"),
    C("cv_risk", "Cardiovascular risk score", "value_numeric", agg="max"),
    C("creatinine", "Creatinine", "value_numeric", agg="max"),
    C("diastolic_bp", "Diastolic blood pressure", "value_numeric", agg="max"),
    C("fundoscopy", "Fundoscopy", "value_text"),
    C("hiv_result", "Result of HIV test", "value_coded", agg="max"),
    C("hba1c", "Glycated hemoglobin", "value_numeric", agg="max"),
    C("hospitalized_since_last_visit", ("Patient hospitalized since last visit",
                                        "Hospitalized for mental health since last visit"), "value_coded", agg="max"),
    C("num_seizures", "NUMBER OF SEIZURES", "value_numeric", agg="max"),
    C("on_insulin", "Current drugs used", "value_coded", answer="Insulin", agg="flag"),
    C("proteinuria", "Urine protein", "value_coded", agg="max"),
    C("seizure_activity", "Seizure activity", "value_coded", answer="Seizure since last visit", agg="flag"),
    C("serum_glucose", "Serum glucose", "value_numeric", agg="max"),
    C("suicide_risk", "Suicide risk", "value_coded", agg="max"),
    C("systolic_bp", "Systolic blood pressure", "value_numeric", agg="max"),
    C("visual_acuity", "Visual acuity (text)", "value_text", agg="max"),
)
# value scans over observations of the NCD encounter types only
NCD_TYPED_COLUMNS = (
    C("mental_health_drug_side_effect", "Does patient have adverse effects", "value_coded"),
    C("mental_health_drugs", "Current drugs used", "value_coded", agg="concat", sep=","),
    C("mental_stable", "Stable", "value_coded", agg="max"),
)
# foot check: all three findings recorded in one diabetes/hypertension follow-up encounter
FOOT_CHECK_TYPE = "DIABETES HYPERTENSION FOLLOWUP"
FOOT_CHECKS = ("Neuropathy and Peripheral Vascular Disease", "Deformity of foot", "Foot ulcer or infection")
# mental status exam: 'Normal' when all eight complaints are recorded absent in one follow-up encounter
MENTAL_STATUS_TYPE = "MENTAL_HEALTH_FOLLOWUP"
MENTAL_STATUS_CONCEPT = "Mental health chief complaint absent"
MENTAL_STATUS_ANSWERS = ("Depressive Disorder", "Hypomania", "Disruptive Behavior Disorder", "Abnormal speech",
                         "Delusions", "Hallucinations", "Lack of insight", "Other non-coded")

KEYS = ["patient_id", "visit_date", "location"]


def visit_obs(flat: dict, types: tuple | None = None, with_group: bool = False) -> DataFrame:
    """Observations keyed by their encounter's visit key (one obs<->encounter join).
    With ``types`` only observations of encounters of those types are kept; with
    ``with_group`` each row also carries its parent group's concept."""
    enc = flat["omrs_encounter"].select("encounter_id", F.col("patient_id").alias("__ep"),
                                        F.col("encounter_date").alias("visit_date"),
                                        F.col("location").alias("__eloc"), F.col("encounter_type").alias("__etype"))
    o = flat["omrs_obs"].select("obs_id", "encounter_id", "concept", "value_coded", "value_date", "value_numeric",
                                "value_text", "obs_group_id", "obs_date")
    j = o.join(enc, "encounter_id", "inner").select(
        F.col("__ep").alias("patient_id"), "visit_date", F.col("__eloc").alias("location"),
        F.col("__etype").alias("encounter_type"), "obs_id", "encounter_id", "concept", "value_coded", "value_date",
        "value_numeric", "value_text", "obs_group_id", "obs_date")
    if with_group:
        g = flat["omrs_obs_group"].select("obs_group_id", F.col("concept").alias("group_concept"))
        j = j.join(g, "obs_group_id", "left")
    return j.where(ci_in("encounter_type", types)) if types else j


def spine(flat: dict, types: tuple) -> DataFrame:
    """Distinct visit keys of encounters of the given types."""
    return (flat["omrs_encounter"].where(ci_in("encounter_type", types))
            .select("patient_id", F.col("encounter_date").alias("visit_date"), "location").distinct())


def build_form(flat: dict, spec: FormSpec | str) -> DataFrame:
    """A form table from its spec -- one obs<->encounter join, one aggregate
    for visit-keyed columns and one for group-keyed columns (each column's
    encounter-type test is part of its own condition), then left joins from the
    spine; output conformed to the table's DDL (integer targets rounded)."""
    if isinstance(spec, str):
        spec = FORMS[spec]
    sp = spine(flat, spec.types)
    need_group = any(c.group for c in spec.columns)
    obs = visit_obs(flat, None, with_group=need_group).withColumn("__typed", ci_in("encounter_type", spec.types))
    cols, seen, dups = [], {}, []
    for c in spec.columns:          # a column filled by several scans takes the first scan with a value
        c = c if c.name in spec.untyped else replace(c, require="__typed")
        if c.name in seen:
            seen[c.name] += 1
            alias = f"__{c.name}__{seen[c.name]}"
            dups.append((c.name, alias))
            c = replace(c, name=alias)
        else:
            seen[c.name] = 1
        cols.append(c)
    grouped_names = set(spec.grouped) | {a for n, a in dups if n in spec.grouped}
    plain = [c for c in cols if c.name not in grouped_names]
    grouped = [c for c in cols if c.name in grouped_names]
    out, numbered = sp, sp
    if plain:
        piv = O.form_pivot(obs, KEYS, plain, concept_col="concept", id_col="obs_id")
        out = O.left_join_keys(out, piv, KEYS, null_safe=["location"])
    if grouped:
        g = O.form_pivot(obs.where(F.col("obs_group_id").isNotNull()), KEYS + ["obs_group_id"], grouped,
                         concept_col="concept", id_col="obs_id")
        out = O.left_join_keys(out, g, KEYS, null_safe=["location"])
        numbered = O.left_join_keys(sp, g.select(*KEYS, "obs_group_id"), KEYS, null_safe=["location"])   # without the picks
    for name, alias in dups:
        out = out.withColumn(name, F.coalesce(F.col(name), F.col(alias))).drop(alias)
    order = KEYS + (["obs_group_id"] if grouped else [])
    keyed = O.number_rows(numbered, order, spec.id_col)
    out = O.attach_key(out, keyed, order)
    if spec.ddl:
        return conform(out, ", ".join(spec.ddl))
    return out.select(spec.id_col, *KEYS, *[c.name for c in spec.columns])


def ncd_visits(flat: dict) -> DataFrame:
    """M-VNCD: one row per NCD visit: the visit's encounter types (A11), ten
    type flags (A12), maxima/minima per visit (A16/A17), present-or-null flags
    (A14), the foot check and the mental status exam (A13, all of N findings
    in one encounter, any encounter of the visit)."""
    enc = flat["omrs_encounter"].where(ci_in("encounter_type", NCD_TYPES)).select(
        "patient_id", F.col("encounter_date").alias("visit_date"), "location", "encounter_type")
    types = enc.groupBy(*KEYS).agg(
        F.array_join(F.array_sort(F.collect_set("encounter_type")), ", ").alias("visit_types"),
        *[F.coalesce(F.max(F.lower("encounter_type") == v.lower()), F.lit(False)).alias(k)
          for k, v in NCD_FLAGS.items()])
    obs = visit_obs(flat)
    vals = O.form_pivot(obs, KEYS, list(NCD_VISIT_COLUMNS), concept_col="concept", id_col="obs_id")
    typed = O.form_pivot(visit_obs(flat, NCD_TYPES), KEYS, list(NCD_TYPED_COLUMNS), concept_col="concept",
                         id_col="obs_id")
    foot_obs = obs.where(ci_in("encounter_type", (FOOT_CHECK_TYPE,)))
    feet = (O.all_of_n_present(foot_obs, KEYS + ["encounter_id"], "concept", FOOT_CHECKS, "__ok")
            .groupBy(*KEYS).agg(F.max(F.when(F.col("__ok"), F.lit(True))).alias("foot_check")))
    ms_obs = obs.where(ci_in("encounter_type", (MENTAL_STATUS_TYPE,)) & ci_in("concept", (MENTAL_STATUS_CONCEPT,)))
    ms = (O.all_of_n_present(ms_obs, KEYS + ["encounter_id"], "value_coded", MENTAL_STATUS_ANSWERS, "__ok")
          .groupBy(*KEYS).agg(F.max(F.when(F.col("__ok"), F.lit("Normal"))).alias("mental_status_exam")))
    out = types
    for part in (vals, typed, feet, ms):
        out = O.left_join_keys(out, part, KEYS, null_safe=["location"])
    keyed = O.number_rows(types.select(*KEYS), KEYS, "ncd_visit_id")
    return O.attach_key(out, keyed, KEYS)
