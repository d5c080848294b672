"""Malawi mart (M-PAT, M-V*, M-R*, M-DX, M-LAB*, M-REG, M-LASTOBS, M-LASTLAB,
M-TART, M-TEID, M-FORMS, M-FN) built from the flat layer.

Every "first/last/latest" here is a window with a partial group limit or a
``min_by``/``max_by`` aggregate; the register outcome ("state after a state")
is the bucketed as-of join; form tables are one aggregate each (``forms``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O
from . import forms

# Program / workflow / state / identifier names as stored in the source dictionary.
HIV_PROGRAM = "HIV program"
NCD_PROGRAM = "Chronic care program"
TREATMENT_STATUS = "Treatment status"
NCD_WORKFLOW = "Chronic care treatment status"
ON_ART = "On antiretrovirals"
PRE_ART = "Pre-ART (Continue)"
EXPOSED_CHILD = "Exposed child (continue)"
ARV_NUMBER = "ARV Number"
HCC_NUMBER = "HCC Number"
MOTHER_ART_NUMBER = "Mother ART registration number"
EID_NUMBER = "Exposed Infant Number"
NCD_NUMBER = "Chronic Care Number"
CHW_ROLE = "Community Health Worker"
VIRAL_LOAD = "Viral Load"
HIV_TEST = "HIV test"
TRUE_ANSWER = "True"


def mw_patient(flat: dict) -> DataFrame:
    """M-PAT: patient with district / TA / village and the current community
    health worker (open relationship first, then with a start date, then newest)."""
    rel = flat["omrs_relationship"].where(H.ci_eq("related_person_role", CHW_ROLE))
    chw = O.best_per_key(rel, "patient_id", [F.col("end_date").isNull().desc(), F.col("start_date").isNotNull().desc(),
                                             F.col("date_created").desc(), F.col("relationship_id").desc()]) \
        .select("patient_id", F.col("related_person").alias("chw"))
    p = flat["omrs_patient"]
    return p.join(chw, "patient_id", "left").select(
        "patient_id", "identifier", "first_name", "last_name", "gender", "birthdate", "birthdate_estimated",
        "phone_number", F.col("state_province").alias("district"),
        F.col("county_district").alias("traditional_authority"), F.col("city_village").alias("village"), "chw",
        "dead", "death_date", "patient_uuid")


def number_at_location(flat: dict, id_type: str) -> DataFrame:
    """A2: newest identifier of a type per (patient, location), formatted."""
    ids = flat["omrs_patient_identifier"].where(H.ci_eq("type", id_type))
    best = O.best_per_key(ids, ["patient_id", "location"], [F.col("date_created").desc(),
                                                           F.col("patient_identifier_id").desc()])
    return best.select("patient_id", "location", H.format_identifier("identifier").alias("number"))


def state_episodes(flat: dict, program: str | None, workflow: str | None, state: str | None) -> DataFrame:
    """Register spine: one row per state episode; end = state end else enrollment
    completion; outcome = the enrollment's next state starting on or after the
    episode end (J11) else the enrollment outcome."""
    st = flat["omrs_program_state"]
    en = flat["omrs_program_enrollment"].select("program_enrollment_id", "completion_date", F.col("outcome").alias("__eo"))
    cond = F.lit(True)
    for col, val in (("program", program), ("workflow", workflow), ("state", state)):
        if val is not None:                       # None: any programme / workflow / state
            cond = cond & H.ci_eq(col, val)
    eps = (st.where(cond)
           .join(en, "program_enrollment_id", "inner")
           .select("program_state_id", "program_enrollment_id", "patient_id", "location", "start_date",
                   F.col("end_date").alias("__state_end"), F.coalesce("end_date", "completion_date").alias("end_date"),
                   "__eo"))
    nxt = st.select("program_enrollment_id", F.col("start_date").alias("__ns"), F.col("state").alias("__next_state"),
                    F.col("program_state_id").alias("__nid"))
    j = O.asof_join(eps, nxt, ["program_enrollment_id"], "__state_end", "__ns", ["__next_state"],
                    direction="forward", inclusive=True, tiebreak="__nid", bucket="adaptive")
    return j.withColumn("outcome", F.coalesce("__next_state", "__eo")).drop("__next_state", "__eo", "__state_end")


def _last_visit(visits: DataFrame, id_col: str, out: str) -> DataFrame:
    return O.latest_per_key(visits, "patient_id", "visit_date", id_col).select("patient_id", F.col(id_col).alias(out))


def _lab_date():
    return F.coalesce("date_collected", "date_result_received", "date_result_entered")


def mw_art_register(flat: dict, art_visits: DataFrame, labs: DataFrame) -> DataFrame:
    """M-RART: ART episodes with number at location, last visit, last viral-load
    test and last viral-load result (the last three across all locations)."""
    eps = state_episodes(flat, HIV_PROGRAM, TREATMENT_STATUS, ON_ART)
    num = number_at_location(flat, ARV_NUMBER).withColumnRenamed("number", "art_number")
    vl = labs.where(H.ci_eq("test_type", VIRAL_LOAD)).withColumn("__d", _lab_date())
    last_test = O.latest_per_key(vl, "patient_id", "__d", "lab_test_id").select(
        "patient_id", F.col("lab_test_id").alias("last_viral_load_test_id"))
    last_res = O.latest_per_key(vl.where(F.col("result_numeric").isNotNull() | F.col("result_exception").isNotNull()),
                                "patient_id", "__d", "lab_test_id").select(
        "patient_id", F.col("lab_test_id").alias("last_viral_load_result_id"))
    out = O.left_join_keys(eps, num, ["patient_id", "location"], null_safe=["location"])
    out = out.join(_last_visit(art_visits, "art_visit_id", "last_art_visit_id"), "patient_id", "left") \
        .join(last_test, "patient_id", "left").join(last_res, "patient_id", "left")
    return out.select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "art_number",
                      "start_date", "end_date", "outcome", "last_art_visit_id", "last_viral_load_test_id",
                      "last_viral_load_result_id")


def mw_pre_art_register(flat: dict) -> DataFrame:
    """M-RPRE: pre-ART episodes with the HCC number at the location."""
    eps = state_episodes(flat, HIV_PROGRAM, TREATMENT_STATUS, PRE_ART)
    num = number_at_location(flat, HCC_NUMBER).withColumnRenamed("number", "pre_art_number")
    out = O.left_join_keys(eps, num, ["patient_id", "location"], null_safe=["location"])
    return out.select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location",
                      "pre_art_number", "start_date", "end_date", "outcome")


def mw_eid_register(flat: dict, eid_visits: DataFrame) -> DataFrame:
    """M-REID: exposed-child episodes with EID number, the mother's ART numbers
    as observed on the child (A10, sorted so the text is fixed) and the last EID visit."""
    eps = state_episodes(flat, HIV_PROGRAM, TREATMENT_STATUS, EXPOSED_CHILD)
    num = number_at_location(flat, EID_NUMBER).withColumnRenamed("number", "eid_number")
    mom_nums = flat["omrs_obs"].where(H.ci_eq("concept", MOTHER_ART_NUMBER) & F.col("value_text").isNotNull())
    mom = O.concat_group(mom_nums, ["patient_id"], "value_text", "mother_art_number", sep=",")
    out = O.left_join_keys(eps, num, ["patient_id", "location"], null_safe=["location"])
    out = out.join(mom, "patient_id", "left").join(_last_visit(eid_visits, "eid_visit_id", "last_eid_visit_id"),
                                                   "patient_id", "left")
    return out.select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "eid_number",
                      "mother_art_number", "start_date", "end_date", "outcome", "last_eid_visit_id")


def mw_ncd_register(flat: dict) -> DataFrame:
    """M-RNCD: chronic-care enrollments; outcome only when completed (latest
    state else enrollment outcome); number at location; cardiovascular flag."""
    en = flat["omrs_program_enrollment"].where(H.ci_eq("program", NCD_PROGRAM))
    st = flat["omrs_program_state"].where(H.ci_eq("program", NCD_PROGRAM) & H.ci_eq("workflow", NCD_WORKFLOW))
    latest = O.latest_per_key(st, "program_enrollment_id", "start_date", "program_state_id").select(
        "program_enrollment_id", F.col("state").alias("__state"))
    num = number_at_location(flat, NCD_NUMBER).withColumnRenamed("number", "ncd_number")
    cv = flat["omrs_obs"].where(H.ci_eq("value_coded", "Cardiovascular disease")).select("patient_id").distinct() \
        .withColumn("cv_disease", F.lit(True))
    out = en.join(latest, "program_enrollment_id", "left")
    out = O.left_join_keys(out, num, ["patient_id", "location"], null_safe=["location"]).join(cv, "patient_id", "left")
    return out.select(F.col("program_enrollment_id").alias("enrollment_id"), "patient_id", "location", "ncd_number",
                      F.col("enrollment_date").alias("start_date"), F.col("completion_date").alias("end_date"),
                      F.when(F.col("completion_date").isNotNull(), F.coalesce("__state", "outcome")).alias("outcome"),
                      F.coalesce("cv_disease", F.lit(False)).alias("cv_disease"))


def viral_load_tests(flat: dict) -> DataFrame:
    """M-LABV: one row per (patient, encounter) holding a sample, an LDL flag, a
    below-limit value or a result -- the full outer join of the four streams,
    done as one grouped aggregate over their union of rows."""
    o = flat["omrs_obs"].where(F.col("encounter_id").isNotNull())
    is_sample = H.ci_eq("concept", "Sample taken for Viral Load") & H.ci_eq("value_coded", TRUE_ANSWER)
    is_ldl = H.ci_eq("concept", "Lower than Detection Limit") & H.ci_eq("value_coded", TRUE_ANSWER)
    is_lt = H.ci_eq("concept", "Less than limit")
    is_vl = H.ci_eq("concept", "HIV viral load")
    rows = o.where(is_sample | is_ldl | is_lt | is_vl)
    res = is_ldl | is_lt | is_vl
    g = rows.groupBy("patient_id", "encounter_id").agg(
        F.min("obs_date").alias("date_collected"),
        F.min(F.when(res, F.col("date_created"))).alias("date_result_entered"),
        F.min_by(F.when(is_vl, F.col("value_numeric")), F.when(is_vl, F.col("obs_id"))).alias("result_numeric"),
        F.min_by(F.when(is_lt, H.less_than_text("value_numeric")), F.when(is_lt, F.col("obs_id"))).alias("__lt"),
        F.min_by(F.when(is_ldl, F.col("concept")), F.when(is_ldl, F.col("obs_id"))).alias("__ldl"))
    return g.select("patient_id", "encounter_id", "date_collected", F.lit(VIRAL_LOAD).alias("test_type"),
                    F.lit(None).cast("date").alias("date_result_received"), "date_result_entered",
                    F.lit(None).cast("string").alias("result_coded"), "result_numeric",
                    F.coalesce("__lt", "__ldl").alias("result_exception"), F.lit(None).cast("long").alias("obs_group_id"))


def hiv_tests(flat: dict) -> DataFrame:
    """M-LABH: HIV test results inside an 'HIV Test Construct' group (J16); the
    collection date is the test date in the group else the encounter date, the
    type is the recorded test type else 'HIV test'."""
    grp = flat["omrs_obs_group"]
    o = O.child_in_named_group(flat["omrs_obs"], grp, "obs_group_id", "concept", "HIV Test Construct")
    enc = flat["omrs_encounter"].select("encounter_id", "encounter_date")
    g = o.groupBy("patient_id", "encounter_id", "obs_group_id").agg(
        F.min_by(F.when(H.ci_eq("concept", "Result of HIV test"), F.col("value_coded")),
                 F.when(H.ci_eq("concept", "Result of HIV test"), F.col("obs_id"))).alias("result_coded"),
        F.min(F.when(H.ci_eq("concept", "HIV test date"), F.col("value_date"))).alias("__tdate"),
        F.min(F.when(H.ci_eq("concept", "HIV test type"), F.col("value_coded"))).alias("__ttype"),
        F.min(F.when(H.ci_eq("concept", "Result of HIV test"), F.col("date_created"))).alias("date_result_entered"))
    g = g.join(enc, "encounter_id", "left")
    return g.select("patient_id", "encounter_id", F.coalesce("__tdate", "encounter_date").alias("date_collected"),
                    F.coalesce("__ttype", F.lit(HIV_TEST)).alias("test_type"),
                    F.lit(None).cast("date").alias("date_result_received"), "date_result_entered", "result_coded",
                    F.lit(None).cast("double").alias("result_numeric"),
                    F.lit(None).cast("string").alias("result_exception"), F.col("obs_group_id").cast("long").alias("obs_group_id"))


def mw_lab_tests(flat: dict) -> DataFrame:
    both = viral_load_tests(flat).unionByName(hiv_tests(flat))
    # HIV tests are one row per obs group
    order = ["patient_id", "encounter_id", "test_type", "obs_group_id"]
    keyed = O.number_rows(both.select(*order), order, "lab_test_id")
    return O.attach_key(both, keyed, order).select("lab_test_id", *[c for c in both.columns if c != "obs_group_id"])


def mw_ncd_diagnoses(flat: dict) -> DataFrame:
    """M-DX: earliest diagnosis date per (patient, diagnosis): the diagnosis date
    recorded in the same obs group, else the observation date (A15)."""
    o = flat["omrs_obs"]
    dx = o.where(H.ci_eq("concept", "Chronic care diagnosis") & F.col("value_coded").isNotNull()).select(
        "patient_id", "obs_group_id", F.col("value_coded").alias("diagnosis"), F.col("obs_date").alias("__od"))
    dd = o.where(H.ci_eq("concept", "Diagnosis date")).groupBy("patient_id", "obs_group_id").agg(
        F.min("value_date").alias("__dd"))
    j = O.left_join_keys(dx, dd, ["patient_id", "obs_group_id"], null_safe=["obs_group_id"])
    return j.groupBy("patient_id", "diagnosis").agg(F.min(F.coalesce("__dd", "__od")).alias("diagnosis_date"))


REGIMEN_LINES = [("Malawi Antiretroviral drugs change 1", "Start date 1st line ARV", "0"),
                 ("Malawi Antiretroviral drugs change 2", "Date of starting alternative 1st line ARV regimen", "1"),
                 ("Malawi Antiretroviral drugs change 3", "Date of starting 2nd line ARV regimen", "2")]


def mw_art_regimen(flat: dict) -> DataFrame:
    """M-REG: regimen changes with their start date from a sibling observation of
    the same encounter (J17), tagged with the line (P5), appended (U2)."""
    o = flat["omrs_obs"]
    parts = []
    for reg_concept, date_concept, line in REGIMEN_LINES:
        regs = o.where(H.ci_eq("concept", reg_concept)).select("patient_id", "encounter_id", "value_coded")
        dates = o.where(H.ci_eq("concept", date_concept) & F.col("encounter_id").isNotNull()) \
            .groupBy("encounter_id").agg(F.min("value_date").alias("__d"))
        x = O.sibling_in_encounter(regs, dates, "encounter_id", {"regimen_init_date": "__d"})
        parts.append((x.select("patient_id", F.col("value_coded").alias("regimen"), "regimen_init_date"), line))
    out = O.append_streams(parts, "line")
    return out.select("patient_id", "regimen", "regimen_init_date",
                      F.lit(None).cast("int").alias("num_of_prev_regimens"),
                      F.lit(None).cast("date").alias("regimen_end_date"), "line")


def nth_regimen(regimens: DataFrame, n: int, as_of=None) -> DataFrame:
    """M-FN: the patient's n-th most recent regimen (0 = current) and its start
    (of one day: the later line first, then by name)."""
    r = regimens.where(F.col("regimen_init_date").isNotNull())
    if as_of is not None:
        r = r.where(F.col("regimen_init_date") <= F.lit(as_of).cast("date"))
    order = [F.col("regimen_init_date").desc(), F.col("line").desc(), F.col("regimen").asc_nulls_last()]
    return O.nth_per_key(r, "patient_id", order, n + 1).select("patient_id", "regimen", "regimen_init_date")


def last_obs_in_period(flat: dict, concepts, periods: DataFrame) -> DataFrame:
    """M-LASTOBS (W5): for each patient x selected concept x period end, the
    observations at the latest date on or before the end (ties kept)."""
    o = flat["omrs_obs"].where(H.ci_in("concept", concepts)).select(
        "patient_id", "concept", "obs_date", "encounter_type", "location", "value_coded", "value_date",
        "value_numeric", "value_text", "obs_group_id", "obs_id")
    snap = O.snapshot_latest_per_period(o, ["patient_id", "concept"], "obs_date", periods)
    return snap.select("patient_id", "concept", "end_date", F.col("obs_date").alias("last_obs_date"),
                       "encounter_type", "location", "value_coded", "value_date", "value_numeric", "value_text",
                       "obs_group_id")


def lab_tests_recent_period(cohort: DataFrame, labs: DataFrame, periods: DataFrame) -> DataFrame:
    """M-LASTLAB (W6): every cohort patient x period with the single latest lab
    test on or before the end (tie -> smallest id), nulls when none."""
    lab = labs.withColumn("__d", F.coalesce("date_collected", "date_result_received", "date_result_entered"))
    cols = ["encounter_id", "date_collected", "test_type", "date_result_received", "date_result_entered",
            "result_coded", "result_numeric", "result_exception"]
    snap = O.snapshot_with_blanks(cohort.select("patient_id"), lab, ["patient_id"], "__d", "lab_test_id", periods,
                                  cols)
    return snap.select("lab_test_id", "patient_id", *cols, "end_date")


def art_trace(art_register: DataFrame, art_visits: DataFrame, labs: DataFrame) -> DataFrame:
    """M-TART: open ART episodes with their last visit and appointment and the last viral load."""
    active = art_register.where(F.col("end_date").isNull())
    lv = O.latest_per_key(art_visits, "patient_id", "visit_date", "art_visit_id").select(
        "patient_id", F.col("visit_date").alias("last_visit_date"),
        F.col("next_appointment_date").alias("last_appt_date"))
    vl = labs.where(H.ci_eq("test_type", VIRAL_LOAD)).withColumn("__d", _lab_date())
    lr = O.latest_per_key(vl.where(F.col("result_numeric").isNotNull() | F.col("result_exception").isNotNull()),
                          "patient_id", "__d", "lab_test_id").select(
        "patient_id", F.col("__d").alias("last_vl_date"), F.col("result_numeric").alias("last_vl_numeric"),
        F.col("result_exception").alias("last_vl_exception"))
    return active.join(lv, "patient_id", "left").join(lr, "patient_id", "left")


def eid_trace(eid_register: DataFrame, eid_visits: DataFrame, labs: DataFrame, flat: dict) -> DataFrame:
    """M-TEID: open EID episodes with last visit, first date without
    breastfeeding after the last breastfeeding (A19) and last two HIV test results (J18)."""
    active = eid_register.where(F.col("end_date").isNull())
    lv = O.latest_per_key(eid_visits, "patient_id", "visit_date", "eid_visit_id").select(
        "patient_id", F.col("visit_date").alias("last_visit_date"),
        F.col("next_appointment_date").alias("last_appt_date"))
    bf = eid_visits.where(F.col("breastfeeding_status").isNotNull()).withColumn(
        "__status", F.when(H.ci_eq("breastfeeding_status", "No"), F.lit("No")).otherwise(F.lit("Yes")))
    stopped = O.first_after_last_other(bf, ["patient_id"], "visit_date", "__status", "No", out="date_stopped_bf")
    tests = labs.where(H.ci_eq("test_type", HIV_TEST))
    lvp = O.latest_vs_previous(tests, ["patient_id"], "date_collected", "result_coded", "lab_test_id",
                               last_name="last_test_result", prev_name="previous_test_result",
                               last_date="last_test_date", prev_date="previous_test_date")
    return active.join(lv, "patient_id", "left").join(stopped, "patient_id", "left").join(lvp, "patient_id", "left")


def build_malawi(spark: SparkSession, flat: dict, periods: DataFrame | None = None,
                 selected_concepts=("HIV viral load", "Weight (kg)"), materialize=None) -> dict[str, DataFrame]:
    """The Malawi load (visits before registers; patients before diagnoses and labs).
    Tables read by several later tables are materialised once."""
    from ..session import cut_lineage
    mat = materialize or cut_lineage
    out = {"mw_patient": mw_patient(flat)}
    for name, spec in forms.FORMS.items():
        out[name] = mat(forms.build_form(flat, spec)) if name.endswith("visits") else forms.build_form(flat, spec)
    out["mw_ncd_visits"] = forms.ncd_visits(flat)
    labs = mat(mw_lab_tests(flat))
    out["mw_lab_tests"] = labs
    out["mw_art_register"] = mat(mw_art_register(flat, out["mw_art_visits"], labs))
    out["mw_pre_art_register"] = mw_pre_art_register(flat)
    out["mw_eid_register"] = mat(mw_eid_register(flat, out["mw_eid_visits"]))
    out["mw_ncd_register"] = mw_ncd_register(flat)
    out["mw_ncd_diagnoses"] = mw_ncd_diagnoses(flat)
    out["mw_art_regimen"] = mw_art_regimen(flat)
    out["mw_art_trace"] = art_trace(out["mw_art_register"], out["mw_art_visits"], labs)
    out["mw_eid_trace"] = eid_trace(out["mw_eid_register"], out["mw_eid_visits"], labs, flat)
    if periods is not None:
        out["mw_last_obs_in_period"] = last_obs_in_period(flat, list(selected_concepts), periods)
        cohort = out["mw_art_register"].select("patient_id").distinct()
        out["mw_lab_tests_recent_period"] = lab_tests_recent_period(cohort, labs, periods)
    return out
