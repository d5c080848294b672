"""Malawi reports (RP1-RP10) as functions ``(mart tables, **params) -> DataFrame``.

Each stored procedure's temporary table becomes a DataFrame; each
``INSERT ... SELECT`` becomes one rule DataFrame and the rules are combined
with ``rule_union`` (duplicates kept, as the inserts keep them).  The
per-row stored functions (latest test by date entered, latest visit of a
condition) are windows over the whole lab / visit tables, joined once.

Decisions: where the source reads the session variable ``@endDate`` instead
of the argument, the argument is used; the repeated 12-month rapid-test
insert is built once; "group by patient" arbitrary-row picks mean the latest
row (date, then id).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as H
from .. import operators as O

VIRAL_LOAD = "Viral Load"
DNA_PCR = "HIV DNA polymerase chain reaction"
RAPID = "HIV rapid test, qualitative"


def _d(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x).cast("date")


def active_cohort(register: DataFrame, visits: DataFrame, number_col: str | None, end_date, location=None,
                  visit_id: str = "visit_id") -> DataFrame:
    """RP2-RP4: patients in the register at ``location`` whose episode is open
    after ``end_date``, with last visit on or before it (any location), the
    appointment set at that visit, and days late / days to next (never both)."""
    t = _d(end_date)
    reg = O.active_on(register, "end_date", t, location_col="location", location=location)
    reg = reg.select("patient_id", *([F.col(number_col)] if number_col else [])).distinct()
    v = visits.where(F.col("visit_date") <= t)
    last = O.value_at_latest(v, ["patient_id"], "visit_date", visit_id, ["next_appointment_date"], prefix="__")
    out = reg.join(last, "patient_id", "left")
    appt = F.col("__next_appointment_date")
    return out.select(
        "patient_id", *([F.col(number_col)] if number_col else []),
        F.col("__date").alias("last_visit_date"), H.days_between(t, "__date").alias("last_visit_days"),
        appt.alias("last_appt_date"),
        F.when(appt.isNotNull() & (appt < t), H.days_between(t, appt)).alias("days_late_appt"),
        F.when(appt.isNotNull() & (appt >= t), H.days_between(appt, t)).alias("days_to_next_appt"))


def active_art(mart: dict, end_date, location=None) -> DataFrame:
    return active_cohort(mart["mw_art_register"], mart["mw_art_visits"], "art_number", end_date, location,
                         "art_visit_id")


def active_eid(mart: dict, end_date, location=None) -> DataFrame:
    return active_cohort(mart["mw_eid_register"], mart["mw_eid_visits"], "eid_number", end_date, location,
                         "eid_visit_id")


def active_ncd(mart: dict, end_date, location=None) -> DataFrame:
    return active_cohort(mart["mw_ncd_register"], mart["mw_ncd_visits"], "ncd_number", end_date, location,
                         "ncd_visit_id")


def latest_result(labs: DataFrame, test_type: str, to_date=None, from_date=None, n: int = 0,
                  first: bool = False) -> DataFrame:
    """The n-th latest (or the first) test result of a type per patient by date
    entered, optionally within [from, to] -- the set form of the per-row function."""
    res = labs.where(H.ci_eq("test_type", test_type) & (F.col("result_numeric").isNotNull() |
                                                          F.col("result_coded").isNotNull() |
                                                          F.col("result_exception").isNotNull()))
    if first:
        return O.earliest_per_key(res, "patient_id", "date_result_entered", "lab_test_id",
                                  as_of=_d(to_date) if to_date is not None else None)
    return O.nth_latest(res, "patient_id", "date_result_entered", n, tiebreak="lab_test_id",
                        as_of=_d(to_date) if to_date is not None else None,
                        since=_d(from_date) if from_date is not None else None)


def latest_test_any(labs: DataFrame, types) -> DataFrame:
    """Latest test (result or not) of any of ``types`` per patient by date collected."""
    t = labs.where(H.ci_in("test_type", types))
    return O.latest_per_key(t, "patient_id", "date_collected", "lab_test_id")


def latest_condition_visit(ncd_visits: DataFrame, flags, end_date) -> DataFrame:
    """D3: the latest NCD visit on or before ``end_date`` with any of the flags set."""
    cond = None
    for f in flags:
        cond = F.col(f) if cond is None else cond | F.col(f)
    return O.latest_per_key(ncd_visits.where(F.coalesce(cond, F.lit(False))), "patient_id", "visit_date",
                            "ncd_visit_id", as_of=_d(end_date))


PRIORITY_DIAGNOSES = ["Sickle cell disease", "Chronic kidney disease", "Rheumatic heart disease",
                      "Congestive heart failure"]


def priority_patients(mart: dict, end_date) -> DataFrame:
    """RP5: (patient, priority) from six rules."""
    t = _d(end_date)
    v = mart["mw_ncd_visits"]
    hiv = O.union_distinct([mart["mw_pre_art_register"].where(F.col("start_date") <= t).select("patient_id"),
                            mart["mw_art_register"].where(F.col("start_date") <= t).select("patient_id")])
    asthma = latest_condition_visit(v, ["asthma_initial", "asthma_followup"], t)
    epi = latest_condition_visit(v, ["epilepsy_initial", "epilepsy_followup"], t)
    dx = mart["mw_ncd_diagnoses"].where(H.ci_in("diagnosis", PRIORITY_DIAGNOSES) & (F.col("diagnosis_date") <= t))
    rules = [
        ("HIV", hiv),
        ("BP > 180/110", v.where((F.col("systolic_bp") > 180) & (F.col("diastolic_bp") > 110)).select("patient_id").distinct()),
        ("ON INSULIN", v.where(F.col("on_insulin")).select("patient_id").distinct()),
        ("SEVERE PERSISTENT ASTHMA", asthma.where(H.ci_eq("asthma_classification", "Severe persistent"))
         .select("patient_id").distinct()),
        ("> 5 SEIZURES / MONTH", epi.where(F.col("num_seizures") > 5).select("patient_id").distinct()),
    ]
    out = O.rule_union(rules, ["patient_id"], "priority")
    return out.unionByName(dx.select("patient_id", F.col("diagnosis").alias("priority")).distinct())


def trace_criteria(mart: dict, end_date, location=None, min_wks: int = 2, lab_wks: int = 0,
                   max_wks: int | None = None, phase1_only: bool = False) -> DataFrame:
    """RP6: (patient, criteria) from up to ten rules over the active cohorts."""
    t = _d(end_date)
    art, eid, ncd = active_art(mart, t, location), active_eid(mart, t, location), active_ncd(mart, t, location)
    labs, pat = mart["mw_lab_tests"], mart["mw_patient"].select("patient_id", "birthdate")

    def late(active):
        c = F.col("days_late_appt").isNotNull() & (F.col("days_late_appt") >= min_wks * 7)
        if max_wks is not None:
            c = c & (F.col("days_late_appt") < max_wks * 7)
        return active.where(c)

    vl = latest_result(labs, VIRAL_LOAD, t).select("patient_id", "result_numeric", "date_result_entered")
    art_vl = art.join(vl, "patient_id")
    since = H.days_between(t, "date_result_entered")
    if min_wks == 2:
        high = art_vl.where((since <= 42 + 7 * lab_wks) & (F.col("result_numeric") > 1000))
    else:                                # the result rules are for two and six weeks only
        high = art_vl.where(F.lit(min_wks == 6) & (F.col("result_numeric") > 1000) &
                            (F.col("date_result_entered") > F.col("last_visit_date")))
    pcr_first = latest_result(labs, DNA_PCR, t, first=True).select("patient_id", F.col("lab_test_id").alias("__f"))
    pcr_last = latest_result(labs, DNA_PCR, t).select("patient_id", "lab_test_id", "result_coded",
                                                      "date_result_entered")
    pcr = eid.join(pcr_first, "patient_id").join(pcr_last, "patient_id").where(F.col("__f") == F.col("lab_test_id"))
    if min_wks == 2:
        eid_pos = pcr.where((H.days_between(t, "date_result_entered") <= 42 + 7 * lab_wks) &
                            H.ci_eq("result_coded", "Positive"))
    else:
        eid_pos = pcr.where(F.lit(min_wks == 6) & H.ci_eq("result_coded", "Positive") &
                            (F.col("date_result_entered") > F.col("last_visit_date")))
    rules = [("LATE_ART", late(art)), ("LATE_EID", late(eid)), ("HIGH_VIRAL_LOAD", high),
             ("EID_POSITIVE_6_WK", eid_pos)]
    if min_wks == 2:
        soon = (F.col("days_to_next_appt") >= 28 - 7 * lab_wks) & (F.col("days_to_next_appt") < 28)
        repeat = art_vl.where((F.col("result_numeric") > 1000) & (since >= 84) & (since < 154 + 7 * lab_wks) &
                              (F.col("last_visit_date") > F.col("date_result_entered")) & soon)
        eid_p = eid.join(pat, "patient_id")
        age_days = H.days_between(t, "birthdate")
        any_pcr = latest_test_any(labs, [DNA_PCR]).select("patient_id", F.col("lab_test_id").alias("__pcr"))
        six_wk = eid_p.join(any_pcr, "patient_id", "left").where(
            (age_days >= 42) & (age_days < 365) & F.col("__pcr").isNull() & soon)
        last_any = latest_test_any(labs, [RAPID, DNA_PCR]).select("patient_id", F.col("date_collected").alias("__tc"))
        twelve = F.add_months(F.col("birthdate"), 12)
        e12 = eid_p.join(last_any, "patient_id", "left").where(
            (twelve <= t) & ((F.col("__tc") < twelve) | F.col("__tc").isNull()) & soon)
        stopped = first_date_no_breastfeeding(mart["mw_eid_visits"], t)
        e24 = e12.join(stopped, "patient_id", "left").where(F.col("__tc") < F.col("date_stopped_bf"))
        last_r = latest_result(labs, DNA_PCR, t, n=0).select("patient_id", F.col("result_coded").alias("__l"),
                                                            F.col("date_result_entered").alias("__ld"))
        prev_r = latest_result(labs, DNA_PCR, t, n=1).select("patient_id", F.col("result_coded").alias("__p"))
        neg = eid.join(last_r, "patient_id").join(prev_r, "patient_id").where(
            H.ci_eq("__l", "Negative") & H.ci_eq("__p", "Positive") & (H.days_between(t, "__ld") <= 7 * lab_wks))
        rules += [("REPEAT_VIRAL_LOAD", repeat), ("EID_6_WEEK_TEST", six_wk), ("EID_12_MONTH_TEST", e12),
                  ("EID_24_MONTH_TEST", e24), ("EID_NEGATIVE", neg)]
    if not phase1_only:
        lncd = late(ncd)
        if min_wks != 2:
            pri = priority_patients(mart, t).select("patient_id").distinct()
            lncd = lncd.join(pri, "patient_id", "left_semi") if min_wks == 6 else lncd.where(F.lit(False))
        rules.append(("LATE_NCD", lncd))
    return O.rule_union(rules, ["patient_id"], "criteria")


def first_date_no_breastfeeding(eid_visits: DataFrame, end_date) -> DataFrame:
    """A19 variant: first visit date with breastfeeding 'No' on or after the last
    visit with another answer, up to ``end_date``."""
    bf = eid_visits.where(F.col("breastfeeding_status").isNotNull()).withColumn(
        "__s", F.when(H.ci_eq("breastfeeding_status", "No"), F.lit("No")).otherwise(F.lit("other")))
    return O.first_after_last_other(bf, ["patient_id"], "visit_date", "__s", "No", as_of=_d(end_date),
                                    out="date_stopped_bf")


def appt_alerts(mart: dict, end_date, location=None, *, obs: DataFrame) -> DataFrame:
    """RP7: (patient, alert, action) from the appointment alert rules; ``obs``
    (the flat observations) feeds the HbA1C and creatinine rules."""
    t = _d(end_date)
    art, eid, ncd = active_art(mart, t, location), active_eid(mart, t, location), active_ncd(mart, t, location)
    labs, pat = mart["mw_lab_tests"], mart["mw_patient"].select("patient_id", "birthdate")
    first_reg = O.earliest_per_key(mart["mw_art_register"], "patient_id", "start_date", "enrollment_id").select(
        "patient_id", "start_date")
    last_vl_any = latest_test_any(labs, [VIRAL_LOAD]).select("patient_id", "lab_test_id", "date_collected")
    r = art.join(first_reg, "patient_id").join(last_vl_any, "patient_id", "left")
    since_start = H.days_between(t, "start_date")
    routine = r.where((F.col("lab_test_id").isNull() & (since_start > 182)) |
                      (((since_start % 730) < 90) & (since_start > 182) &
                       ((H.days_between(t, "date_collected") > (since_start % 730) + 90) | F.col("lab_test_id").isNull())))
    vl = latest_result(labs, VIRAL_LOAD, t).select("patient_id", "result_numeric", "date_result_entered")
    high = art.join(vl, "patient_id").where((F.col("result_numeric") > 1000) &
                                           (H.days_between(t, "date_result_entered") <= 91))
    # the latest sample, whether it has a result or not: a patient bled again needs no alert
    by_sample = O.nth_latest(labs.where(H.ci_eq("test_type", VIRAL_LOAD)), "patient_id", "date_collected", 0, "lab_test_id",
                             as_of=t).select("patient_id", F.col("date_collected").alias("__sc"))
    confirm = art.join(vl, "patient_id").join(by_sample, "patient_id").where(
        (F.col("__sc").isNull() | (F.col("__sc") < F.col("date_result_entered"))) & (F.col("result_numeric") > 1000) &
        (F.col("last_visit_date") > F.col("date_result_entered")) & (H.days_between(t, "last_visit_date") > 60))
    rt = latest_result(labs, RAPID, t).select("patient_id", "result_coded")
    eid_rt = eid.join(rt, "patient_id").where(H.ci_eq("result_coded", "Positive"))
    eid_p = eid.join(pat, "patient_id")
    age = H.days_between(t, "birthdate")
    any_pcr = latest_test_any(labs, [DNA_PCR]).select("patient_id", F.col("lab_test_id").alias("__pcr"))
    pcr_due = eid_p.join(any_pcr, "patient_id", "left").where((age >= 42) & (age < 365) & F.col("__pcr").isNull())
    last_any = latest_test_any(labs, [RAPID, DNA_PCR]).select("patient_id", F.col("date_result_entered").alias("__te"))
    e = eid_p.join(last_any, "patient_id", "left")
    test_age = H.days_between("__te", "birthdate")
    rapid_due = e.where((age >= 365) & (age < 731) & ((test_age < 365) | F.col("__te").isNull()))
    consider = e.where((age >= 731) & ((test_age < 731) | F.col("__te").isNull()))
    rules = [(("Due for routine VL", "Needs routine VL"), routine),
             (("High VL", "Do adherence counseling interention"), high),
             (("High VL", "Consider confirmatory VL"), confirm),
             (("EID Positive RT", "Enroll on ART and do DNA-PCR"), eid_rt),
             (("Due for EID DNA-PCR Test", "Refer to HTC for DNA-PCR test"), pcr_due),
             (("Due for EID Rapid Test", "Refer to HTC for rapid test"), rapid_due),
             (("Consider EID RT", "If baby stopped breastfeeding 6w ago, refer to HTC for RT"), consider)]
    dx = mart["mw_ncd_diagnoses"]
    last_obs = lambda concept: O.latest_per_key(obs.where(H.ci_eq("concept", concept)), "patient_id",
                                                "obs_date", "obs_id").select("patient_id", F.col("obs_date").alias("__od"))
    dm = O.latest_per_key(dx.where(H.ci_in("diagnosis", ["Diabetes", "Type 1 diabetes", "Type 2 diabetes"])),
                          "patient_id", "diagnosis_date", "diagnosis")
    a1c = ncd.join(dm.select("patient_id", "diagnosis"), "patient_id").join(last_obs("Glycated hemoglobin"),
                                                                              "patient_id", "left")
    gap = H.days_between(t, "__od")
    a1c = a1c.where((H.ci_eq("diagnosis", "Type 1 diabetes") & ((gap > 90) | F.col("__od").isNull())) |
                    (H.ci_in("diagnosis", ["Diabetes", "Type 2 diabetes"]) & ((gap > 182) | F.col("__od").isNull())))
    dh = dx.where(H.ci_in("diagnosis", ["Diabetes", "Hypertension"])).select("patient_id").distinct()
    cr = ncd.join(dh, "patient_id").join(last_obs("Creatinine"), "patient_id", "left").where(
        (H.days_between(t, "__od") > 365) | F.col("__od").isNull())
    rules += [(("Test for HbA1C", "Refer for fingerstick"), a1c),
              (("Test for Creatinine", "Refer to nurse for creatinine test"), cr)]
    out = None
    for (alert, action), df in rules:
        x = df.select("patient_id", F.lit(alert).alias("alert"), F.lit(action).alias("action"))
        out = x if out is None else out.unionByName(x)
    return out


def _last_appointment(mart: dict, location=None, end_date=None) -> DataFrame:
    """Per patient of the ART, EID or NCD register (at ``location``, open after
    ``end_date``), the latest visit of those registers' visit tables that set an
    appointment (ties: the latest appointment).  A register is reduced to its
    patients first, so a visit meets a patient once, however many episodes there are."""
    parts = []
    for reg, vis in (("mw_art_register", "mw_art_visits"), ("mw_eid_register", "mw_eid_visits"),
                     ("mw_ncd_register", "mw_ncd_visits")):
        r = O.optional_param(mart[reg], "location", location)
        if end_date is not None:
            r = O.active_on(r, "end_date", _d(end_date))
        v = mart[vis].where(F.col("next_appointment_date").isNotNull()).select("patient_id", "visit_date", "next_appointment_date")
        parts.append(v.join(r.select("patient_id").distinct(), "patient_id", "left_semi"))
    return O.best_per_key(parts[0].unionByName(parts[1]).unionByName(parts[2]), "patient_id",
                          [F.col("visit_date").desc(), F.col("next_appointment_date").desc()])


def patients_next_appointment(mart: dict, location=None) -> DataFrame:
    """RP8: per patient enrolled at ``location`` in ART, EID or NCD, the latest
    visit with an appointment and that appointment."""
    return _last_appointment(mart, location).select("patient_id", F.col("visit_date").alias("last_visit_date"),
                                                    F.col("next_appointment_date").alias("last_appt_date"))


def patients_expected(mart: dict, start_date, end_date, location=None, advanced_care: bool = False,
                      states: DataFrame | None = None) -> DataFrame:
    """RP9: active patients whose latest appointment falls in [start, end]; with
    ``advanced_care`` only those whose latest program state is 'In advanced care'
    (patients without any state stay, as in the source)."""
    last = _last_appointment(mart, location, end_date)
    out = last.where((F.col("next_appointment_date") >= _d(start_date)) & (F.col("next_appointment_date") <= _d(end_date)))
    out = out.select("patient_id", F.col("visit_date").alias("last_visit_date"),
                     F.col("next_appointment_date").alias("last_appt_date"))
    if advanced_care:
        if states is None:
            raise ValueError("advanced_care needs the programme states")
        out = O.drop_if_latest_state_not(out, "patient_id", states, "patient_id", "state", "start_date",
                                         "program_state_id", "In advanced care")
    return out


def rpt_identifiers(mart: dict, flat: dict, location=None) -> DataFrame:
    """RP1: per patient, the number at ``location`` and all numbers (distinct,
    sorted, ', ') for ART, EID, pre-ART, NCD and Yendanafe -- a full outer merge
    of the ten per-patient parts (duplicates at one location: max)."""
    def at_loc(df, col, out):
        return O.optional_param(df, "location", location).groupBy("patient_id").agg(F.max(col).alias(out))

    def all_of(df, col, out):
        return O.concat_group(df.where(F.col(col).isNotNull()), ["patient_id"], col, out, sep=", ", distinct=True)

    yen = flat["omrs_patient_identifier"].where(H.ci_eq("type", "Yendanafe Identifier"))
    parts = [at_loc(mart["mw_art_register"], "art_number", "art_number"),
             all_of(mart["mw_art_register"], "art_number", "all_art_numbers"),
             at_loc(mart["mw_eid_register"], "eid_number", "eid_number"),
             all_of(mart["mw_eid_register"], "eid_number", "all_eid_numbers"),
             at_loc(mart["mw_pre_art_register"], "pre_art_number", "pre_art_number"),
             all_of(mart["mw_pre_art_register"], "pre_art_number", "all_pre_art_numbers"),
             at_loc(mart["mw_ncd_register"], "ncd_number", "ncd_number"),
             all_of(mart["mw_ncd_register"], "ncd_number", "all_ncd_numbers"),
             at_loc(yen, "identifier", "yendanafe_number"),
             all_of(yen, "identifier", "all_yendanafe_numbers")]
    return O.upsert_merge(parts, "patient_id")


def ic3_data(mart: dict, flat: dict, end_date, location=None) -> DataFrame:
    """RP10: one row per patient with an ART, NCD or EID number: diagnoses,
    programme starts and current states, last visits and appointments, last
    labs and the last NCD visit findings.  Each source table is read by one
    grouped aggregate of conditional latest/earliest picks; inequalities are
    kept per block (``<=`` for programme visits, ``<`` for NCD findings)."""
    t = _d(end_date)
    cohort = O.union_distinct([
        mart["mw_art_register"].where(F.col("art_number").isNotNull()).select("patient_id"),
        mart["mw_ncd_register"].where(F.col("ncd_number").isNotNull()).select("patient_id"),
        mart["mw_eid_register"].where(F.col("eid_number").isNotNull()).select("patient_id")])
    pat = flat["omrs_patient"].select("patient_id", "birthdate")

    dxs = mart["mw_ncd_diagnoses"].where(F.col("diagnosis_date") < t)
    dx_flags = {"htnDx": ["Hypertension"], "dmDx": ["Diabetes", "Type 1 diabetes", "Type 2 diabetes"],
                "dmDx1": ["Type 1 diabetes"], "dmDx2": ["Type 2 diabetes"], "asthmaDx": ["Asthma"],
                "epilepsyDx": ["Epilepsy"]}
    dx = dxs.groupBy("patient_id").agg(*[F.max(F.when(H.ci_in("diagnosis", v), F.lit("X"))).alias(k)
                                         for k, v in dx_flags.items()])
    cv = mart["mw_ncd_register"].where(F.col("cv_disease")).groupBy("patient_id").agg(
        F.max("cv_disease").alias("cvDisease"))

    st = O.optional_param(flat["omrs_program_state"], "location", location).where(F.col("start_date") <= t)
    hiv, ncdp = H.ci_eq("program", "HIV Program"), H.ci_eq("program", "Chronic Care Program")
    starts = O.picks_per_key(st, ["patient_id"], "start_date", "program_state_id", {
        "art": (hiv & H.ci_eq("state", "On antiretrovirals"),
                {"artStartDate": "start_date", "artStartLocation": "location"}, "min"),
        "ncd": (ncdp & H.ci_eq("state", "On treatment"), {"ncdStartDate": "start_date", "ncdStartLocation": "location"},
                "min"),
        "eid": (hiv & H.ci_eq("state", "Exposed Child (Continue)"),
                {"eidStartDate": "start_date", "eidStartLocation": "location"}, "min")})
    en = flat["omrs_program_enrollment"].select("program_enrollment_id", "enrollment_date",
                                                F.col("completion_date").alias("__comp"),
                                                F.col("program").alias("__eprog"))
    cur = st.join(en, "program_enrollment_id")

    def current(prog, prefix):
        c = O.current_state_at(cur.where(H.ci_eq("__eprog", prog)), ["patient_id"], "start_date", "end_date", t,
                               [F.col("enrollment_date").desc(), F.col("__comp").asc(),
                                F.col("program_state_id").desc()])
        return c.select("patient_id", F.col("start_date").alias(f"{prefix}CurrentStateStart"),
                        F.col("state").alias(f"current{prefix[0].upper()}{prefix[1:]}State"),
                        F.col("location").alias(f"{prefix}CurrentLocation"))

    art_v = O.picks_per_key(mart["mw_art_visits"], ["patient_id"], "visit_date", "art_visit_id", {
        "last": (F.col("visit_date") <= t, {"lastArtVisit": "visit_date", "nextArtAppt": "next_appointment_date"}),
        "reg": ((F.col("visit_date") < t) & F.col("art_drug_regimen").isNotNull(),
                {"lastArtRegimen": "art_drug_regimen"})})
    eid_v = O.picks_per_key(mart["mw_eid_visits"], ["patient_id"], "visit_date", "eid_visit_id", {
        "last": (F.col("visit_date") <= t, {"lastEidVisit": "visit_date", "nextEidAppt": "next_appointment_date"})})
    v = mart["mw_ncd_visits"]
    before = F.col("visit_date") < t
    ncd_v = O.picks_per_key(v, ["patient_id"], "visit_date", "ncd_visit_id", {
        "last": (F.col("visit_date") <= t, {"lastNcdVisit": "visit_date"}),
        "htndm": (before & F.col("diabetes_htn_followup"), {
            "hba1cAtLastVisit": "hba1c", "fingerStickAtLastVisit": "serum_glucose",
            "footCheckAtLastVisit": "foot_check", "systolicBpAtLastVisit": "systolic_bp",
            "diastolicBpAtLastVisit": "diastolic_bp", "visualAcuityAtLastVisit": "visual_acuity",
            "cvRiskAtLastVisit": "cv_risk", "htnDmHospitalizedSinceLastVisit": "hospitalized_since_last_visit",
            "nextHtnDmAppt": "next_appointment_date"}),
        "hba1c": (before & F.col("hba1c").isNotNull(), {"lastHba1c": "hba1c", "lastHba1cVisitDate": "visit_date"}),
        "prot": (before & F.col("proteinuria").isNotNull(),
                 {"lastProteinuria": "proteinuria", "lastProteinuriaDate": "visit_date"}),
        "creat": (before & F.col("creatinine").isNotNull(),
                  {"lastCreatinine": "creatinine", "lastCreatinineDate": "visit_date"}),
        "fundo": (before & F.col("fundoscopy").isNotNull(),
                  {"lastFundoscopy": "fundoscopy", "lastFundoscopyDate": "visit_date"}),
        "epi": (before & F.col("epilepsy_followup"), {
            "seizuresSinceLastVisit": "seizure_activity", "seizures": "num_seizures",
            "epilepsyHospitalizedSinceLastVisit": "hospitalized_since_last_visit",
            "nextEpilepsyAppt": "next_appointment_date"}),
        "seiz": (before & (F.col("num_seizures").isNotNull() | F.col("seizure_activity").isNotNull()),
                 {"lastSeizureActivityRecorded": "visit_date"}),
        "asthma": (before & F.col("asthma_followup"), {
            "lastAsthmaVisitDate": "visit_date", "asthmaClassificationAtLastVisit": "asthma_classification",
            "nextAsthmaAppt": "next_appointment_date"}),
        "mh": (before & F.col("mental_health_followup"), {
            "lastMentalHealthVisitDate": "visit_date", "mentalHospitalizedSinceLastVisit": "hospitalized_since_last_visit",
            "mentalHealthRxSideEffectsAtLastVisit": "mental_health_drug_side_effect",
            "mentalStatusExam": "mental_status_exam", "mentalStableAtLastVisit": "mental_stable",
            "nextMentalHealthAppt": "next_appointment_date"})})
    labs = mart["mw_lab_tests"].withColumn(
        "__rapid_date", F.coalesce("date_collected", "date_result_entered"))
    lab_p = O.picks_per_key(labs, ["patient_id"], "__rapid_date", "lab_test_id", {
        "vl": (H.ci_eq("test_type", VIRAL_LOAD) & (F.col("date_collected") <= t) & F.col("date_collected").isNotNull(),
               {"lastViralLoadTest": "date_collected"}),
        "pcr": (H.ci_eq("test_type", DNA_PCR) & (F.col("date_collected") <= t) & F.col("date_collected").isNotNull(),
                {"lastDnaPcrTest": "date_collected", "lastDnaPcrResult": "result_coded"}),
        "rapid": (H.ci_in("test_type", [RAPID, "HIV test"]) &
                  ((F.col("date_collected") <= t) | (F.col("date_result_entered") < t)),
                  {"lastRapidTest": "__rapid_date", "lastRapidResult": "result_coded"})})
    mother = mart["mw_eid_register"].groupBy("patient_id").agg(F.max("mother_art_number").alias("motherArtNumber"))
    mobs = flat["omrs_obs"].where(H.ci_eq("concept", "Mother HIV Status") & (F.col("obs_date") < t) &
                                  H.ci_eq("encounter_type", "EXPOSED_CHILD_INITIAL"))
    mstat = O.latest_per_key(mobs, "patient_id", "obs_date", "obs_id").select(
        "patient_id", F.col("value_coded").alias("motherEnrollmentHivStatus"))
    mh_enc = flat["omrs_encounter"].where(H.ci_eq("encounter_type", "MENTAL_HEALTH_FOLLOWUP") &
                                          (F.col("encounter_date") < t)).select("encounter_id", "patient_id",
                                                                                "encounter_date")
    mh_vals = flat["omrs_obs"].where(H.ci_in("concept", ["Able to perform daily activities", "Suicide risk"])) \
        .groupBy("encounter_id").agg(
            F.min_by(F.when(H.ci_eq("concept", "Able to perform daily activities"), F.col("value_coded")),
                     F.when(H.ci_eq("concept", "Able to perform daily activities"), F.col("obs_id"))).alias(
                "ablePerformDailyActivitiesAtLastVisit"),
            F.min_by(F.when(H.ci_eq("concept", "Suicide risk"), F.col("value_coded")),
                     F.when(H.ci_eq("concept", "Suicide risk"), F.col("obs_id"))).alias("suicideRiskAtLastVisit"))
    mh_last = O.latest_per_key(mh_enc.join(mh_vals, "encounter_id", "left"), "patient_id", "encounter_date",
                               "encounter_id").select("patient_id", "ablePerformDailyActivitiesAtLastVisit",
                                                      "suicideRiskAtLastVisit")
    out = cohort.join(pat, "patient_id", "left")
    for part in (dx, cv, starts, current("HIV Program", "hiv"), current("Chronic Care Program", "ncd"), art_v, eid_v,
                 ncd_v, lab_p, mother, mstat, mh_last):
        out = out.join(part, "patient_id", "left")
    appts = ["nextHtnDmAppt", "nextAsthmaAppt", "nextEpilepsyAppt", "nextMentalHealthAppt", "nextArtAppt"]
    return out.withColumn("lastIc3Visit", F.greatest("lastArtVisit", "lastNcdVisit")) \
        .withColumn("latestAppt", F.greatest(*appts))
