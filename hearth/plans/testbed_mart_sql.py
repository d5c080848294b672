"""DuckDB oracles of the reports bound in ``testbed_mart``: the shared input
tables as CTEs, the rules written in SQL on their own."""

from __future__ import annotations

from .testbed_mart import HERE, T_REPORT, TABLES

T = f"DATE '{T_REPORT}'"


def _with(tables, *more: str) -> str:
    return "WITH " + ",\n".join([*(f"{n} AS MATERIALIZED ({TABLES[n]})" for n in tables), *more]) + "\n"


def _same(column: str, *texts: str) -> str:
    return f"lower(trim({column})) IN ({', '.join(repr(t.lower()) for t in texts)})"


def _active(kind: str, location: str | None = None) -> str:
    """CTE ``act_<kind>``: patients in the register on the report date with their last visit."""
    place = f" AND {_same('location', location)}" if location else ""
    return f"""act_{kind} AS (SELECT r.patient_id, r.{kind}_number, v.last.d AS last_visit_date, CAST({T} - v.last.d AS INTEGER) AS last_visit_days,
  v.last.a AS last_appt_date, CASE WHEN v.last.a < {T} THEN CAST({T} - v.last.a AS INTEGER) END AS days_late_appt,
  CASE WHEN v.last.a >= {T} THEN CAST(v.last.a - {T} AS INTEGER) END AS days_to_next_appt
  FROM (SELECT DISTINCT patient_id, {kind}_number FROM mw_{kind}_register WHERE (end_date IS NULL OR end_date > {T}){place}) r
  LEFT JOIN (SELECT patient_id, max({{'d': visit_date, 'i': {kind}_visit_id, 'a': next_appointment_date}}) AS last
             FROM mw_{kind}_visits WHERE visit_date <= {T} GROUP BY patient_id) v USING (patient_id))"""


def _labs(name: str, cond: str, date: str, n: int = 1, first: bool = False) -> str:
    way = "ASC" if first else "DESC"
    return f"""{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY {date} {way}, lab_test_id {way}) AS rn
  FROM mw_lab_tests WHERE {date} IS NOT NULL AND ({cond})) WHERE rn = {n})"""


VL, PCR, RAPID = "Viral Load", "HIV DNA polymerase chain reaction", "HIV rapid test, qualitative"
_RESULT = "(result_numeric IS NOT NULL OR result_coded IS NOT NULL OR result_exception IS NOT NULL)"


def _result(name: str, kind: str, n: int = 1, first: bool = False) -> str:
    return _labs(name, f"{_same('test_type', kind)} AND {_RESULT} AND date_result_entered <= {T}", "date_result_entered", n, first)


def _any(name: str, *kinds: str) -> str:
    return _labs(name, _same("test_type", *kinds), "date_collected")


_STOPPED = f"""bf AS (SELECT patient_id, visit_date, {_same('breastfeeding_status', 'No')} AS no FROM mw_eid_visits
  WHERE breastfeeding_status IS NOT NULL AND visit_date <= {T}),
other AS (SELECT patient_id, max(visit_date) AS d FROM bf WHERE NOT no GROUP BY patient_id),
stopped AS (SELECT bf.patient_id, min(bf.visit_date) AS date_stopped_bf FROM bf LEFT JOIN other USING (patient_id)
  WHERE bf.no AND (other.d IS NULL OR bf.visit_date >= other.d) GROUP BY bf.patient_id)"""


def _union(rules: list[tuple[str, str]]) -> str:
    return "\nUNION ALL ".join(f"SELECT patient_id, '{label}' AS criteria FROM {rows}" for label, rows in rules)


_REGISTERS = ("mw_art_register", "mw_eid_register", "mw_ncd_register", "mw_art_visits", "mw_eid_visits", "mw_ncd_visits")
_LATE = "(SELECT * FROM act_{k} WHERE days_late_appt >= {a}{b})"
_SINCE = f"({T} - date_result_entered)"
_SOON = "days_to_next_appt >= 14 AND days_to_next_appt < 28"

_PRIORITY = f"""pri AS (
  SELECT DISTINCT patient_id, 'HIV' AS priority FROM (SELECT patient_id, start_date FROM mw_pre_art_register UNION ALL
    SELECT patient_id, start_date FROM mw_art_register) WHERE start_date <= {T}
  UNION ALL SELECT DISTINCT patient_id, 'BP > 180/110' FROM mw_ncd_visits WHERE systolic_bp > 180 AND diastolic_bp > 110
  UNION ALL SELECT DISTINCT patient_id, 'ON INSULIN' FROM mw_ncd_visits WHERE on_insulin
  UNION ALL SELECT patient_id, 'SEVERE PERSISTENT ASTHMA' FROM (SELECT patient_id, max({{'d': visit_date, 'i': ncd_visit_id, 'c': asthma_classification}}) AS l
    FROM mw_ncd_visits WHERE (asthma_initial OR asthma_followup) AND visit_date <= {T} GROUP BY patient_id) WHERE {_same('l.c', 'Severe persistent')}
  UNION ALL SELECT patient_id, '> 5 SEIZURES / MONTH' FROM (SELECT patient_id, max({{'d': visit_date, 'i': ncd_visit_id, 'n': num_seizures}}) AS l
    FROM mw_ncd_visits WHERE (epilepsy_initial OR epilepsy_followup) AND visit_date <= {T} GROUP BY patient_id) WHERE l.n > 5
  UNION ALL SELECT DISTINCT patient_id, diagnosis FROM mw_ncd_diagnoses WHERE diagnosis_date <= {T} AND
    {_same('diagnosis', 'Sickle cell disease', 'Chronic kidney disease', 'Rheumatic heart disease', 'Congestive heart failure')})"""
_PRIORITY_TABLES = ("mw_pre_art_register", "mw_art_register", "mw_ncd_visits", "mw_ncd_diagnoses")

SQL = {
    "rp2_active_art": _with(("mw_art_register", "mw_art_visits"), _active("art", HERE)) + "SELECT * FROM act_art",
    "rp3_active_eid": _with(("mw_eid_register", "mw_eid_visits"), _active("eid")) + "SELECT * FROM act_eid",
    "rp4_active_ncd": _with(("mw_ncd_register", "mw_ncd_visits"), _active("ncd", HERE)) + "SELECT * FROM act_ncd",
    "rp5_priority": _with(_PRIORITY_TABLES, _PRIORITY) + "SELECT * FROM pri",
    "rp6_trace": _with((*_REGISTERS, "mw_lab_tests", "mw_patient"), _active("art"), _active("eid"), _active("ncd"),
                       _result("vl", VL), _result("pcr1", PCR, first=True), _result("pcr", PCR), _result("prev", PCR, 2),
                       _any("any_pcr", PCR), _any("any_test", PCR, RAPID), _STOPPED,
                       "art_vl AS (SELECT a.*, vl.result_numeric, vl.date_result_entered FROM act_art a JOIN vl USING (patient_id))",
                       f"""kids AS (SELECT e.*, p.birthdate, {T} - p.birthdate AS age, t.date_collected AS tc, c.lab_test_id AS pcr_id,
  CAST(p.birthdate + to_months(12) AS DATE) AS twelve, s.date_stopped_bf FROM act_eid e JOIN mw_patient p USING (patient_id)
  LEFT JOIN any_test t USING (patient_id) LEFT JOIN any_pcr c USING (patient_id) LEFT JOIN stopped s USING (patient_id))""",
                       f"e12 AS (SELECT * FROM kids WHERE twelve <= {T} AND (tc < twelve OR tc IS NULL) AND {_SOON})")
    + _union([
        ("LATE_ART", _LATE.format(k="art", a=14, b="")), ("LATE_EID", _LATE.format(k="eid", a=14, b="")),
        ("HIGH_VIRAL_LOAD", f"(SELECT * FROM art_vl WHERE {_SINCE} <= 56 AND result_numeric > 1000)"),
        ("EID_POSITIVE_6_WK", f"""(SELECT e.patient_id FROM act_eid e JOIN pcr1 USING (patient_id) JOIN pcr USING (patient_id)
            WHERE pcr1.lab_test_id = pcr.lab_test_id AND {T} - pcr.date_result_entered <= 56 AND {_same('pcr.result_coded', 'Positive')})"""),
        ("REPEAT_VIRAL_LOAD", f"(SELECT * FROM art_vl WHERE result_numeric > 1000 AND {_SINCE} >= 84 AND {_SINCE} < 168 AND last_visit_date > date_result_entered AND {_SOON})"),
        ("EID_6_WEEK_TEST", f"(SELECT * FROM kids WHERE age >= 42 AND age < 365 AND pcr_id IS NULL AND {_SOON})"),
        ("EID_12_MONTH_TEST", "e12"), ("EID_24_MONTH_TEST", "(SELECT * FROM e12 WHERE tc < date_stopped_bf)"),
        ("EID_NEGATIVE", f"""(SELECT e.patient_id FROM act_eid e JOIN pcr USING (patient_id) JOIN prev USING (patient_id)
            WHERE {_same('pcr.result_coded', 'Negative')} AND {_same('prev.result_coded', 'Positive')} AND {T} - pcr.date_result_entered <= 14)"""),
        ("LATE_NCD", _LATE.format(k="ncd", a=14, b=""))]),
    "rp6_trace_6wks": _with(dict.fromkeys((*_REGISTERS, *_PRIORITY_TABLES, "mw_lab_tests")), _active("art", HERE), _active("eid", HERE), _active("ncd", HERE),
                            _result("vl", VL), _result("pcr1", PCR, first=True), _result("pcr", PCR), _PRIORITY)
    + _union([
        ("LATE_ART", _LATE.format(k="art", a=42, b=" AND days_late_appt < 84")), ("LATE_EID", _LATE.format(k="eid", a=42, b=" AND days_late_appt < 84")),
        ("HIGH_VIRAL_LOAD", "(SELECT a.patient_id FROM act_art a JOIN vl USING (patient_id) WHERE result_numeric > 1000 AND date_result_entered > last_visit_date)"),
        ("EID_POSITIVE_6_WK", f"""(SELECT e.patient_id FROM act_eid e JOIN pcr1 USING (patient_id) JOIN pcr USING (patient_id)
            WHERE pcr1.lab_test_id = pcr.lab_test_id AND {_same('pcr.result_coded', 'Positive')} AND pcr.date_result_entered > e.last_visit_date)"""),
        ("LATE_NCD", "(SELECT * FROM act_ncd WHERE days_late_appt >= 42 AND days_late_appt < 84 AND patient_id IN (SELECT patient_id FROM pri))")]),
    "rp7_alerts": _with((*_REGISTERS, "mw_lab_tests", "mw_patient", "mw_ncd_diagnoses", "omrs_obs"), _active("art"), _active("eid"), _active("ncd"),
                        _result("vl", VL), _result("rt", RAPID), _any("any_vl", VL), _any("any_pcr", PCR), _any("any_test", PCR, RAPID),
                        _labs("sampled", f"{_same('test_type', VL)} AND date_collected <= {T}", "date_collected"),
                        f"""first AS (SELECT patient_id, CAST({T} - min(start_date) AS INTEGER) AS since FROM mw_art_register GROUP BY patient_id)""",
                        f"""kids AS (SELECT e.patient_id, CAST({T} - p.birthdate AS INTEGER) AS age, t.date_result_entered AS te,
  CAST(t.date_result_entered - p.birthdate AS INTEGER) AS test_age, c.lab_test_id AS pcr_id, t.lab_test_id AS tested
  FROM act_eid e JOIN mw_patient p USING (patient_id) LEFT JOIN any_test t USING (patient_id) LEFT JOIN any_pcr c USING (patient_id))""",
                        """dm AS (SELECT patient_id, (max({'d': diagnosis_date, 'x': diagnosis})).x AS diagnosis FROM mw_ncd_diagnoses
  WHERE diagnosis IN ('Diabetes', 'Type 1 diabetes', 'Type 2 diabetes') GROUP BY patient_id)""",
                        "dh AS (SELECT DISTINCT patient_id FROM mw_ncd_diagnoses WHERE diagnosis IN ('Diabetes', 'Hypertension'))",
                        *[f"{n} AS (SELECT patient_id, CAST({T} - max(obs_date) AS INTEGER) AS gap FROM omrs_obs WHERE concept = '{c}' GROUP BY patient_id)"
                          for n, c in (("a1c", "Glycated hemoglobin"), ("cr", "Creatinine"))],
                        "art_vl AS (SELECT a.*, vl.result_numeric, vl.date_result_entered FROM act_art a JOIN vl USING (patient_id))")
    + "\nUNION ALL ".join(f"SELECT patient_id, '{a}' AS alert, '{b}' AS action FROM ({rows})" for a, b, rows in [
        ("Due for routine VL", "Needs routine VL", f"""SELECT a.patient_id FROM act_art a JOIN first f USING (patient_id) LEFT JOIN any_vl v USING (patient_id)
            WHERE f.since > 182 AND (v.lab_test_id IS NULL OR (f.since % 730 < 90 AND {T} - v.date_collected > f.since % 730 + 90))"""),
        ("High VL", "Do adherence counseling interention", f"SELECT * FROM art_vl WHERE result_numeric > 1000 AND {_SINCE} <= 91"),
        ("High VL", "Consider confirmatory VL", f"""SELECT a.patient_id FROM art_vl a JOIN sampled s USING (patient_id) WHERE s.date_collected < a.date_result_entered
            AND a.result_numeric > 1000 AND a.last_visit_date > a.date_result_entered AND {T} - a.last_visit_date > 60"""),
        ("EID Positive RT", "Enroll on ART and do DNA-PCR", f"SELECT e.patient_id FROM act_eid e JOIN rt USING (patient_id) WHERE {_same('rt.result_coded', 'Positive')}"),
        ("Due for EID DNA-PCR Test", "Refer to HTC for DNA-PCR test", "SELECT * FROM kids WHERE age >= 42 AND age < 365 AND pcr_id IS NULL"),
        ("Due for EID Rapid Test", "Refer to HTC for rapid test", "SELECT * FROM kids WHERE age >= 365 AND age < 731 AND (test_age < 365 OR te IS NULL)"),
        ("Consider EID RT", "If baby stopped breastfeeding 6w ago, refer to HTC for RT", "SELECT * FROM kids WHERE age >= 731 AND (test_age < 731 OR te IS NULL)"),
        ("Test for HbA1C", "Refer for fingerstick", """SELECT n.patient_id FROM act_ncd n JOIN dm USING (patient_id) LEFT JOIN a1c USING (patient_id)
            WHERE gap IS NULL OR gap > CASE WHEN diagnosis = 'Type 1 diabetes' THEN 90 ELSE 182 END"""),
        ("Test for Creatinine", "Refer to nurse for creatinine test",
         "SELECT n.patient_id FROM act_ncd n JOIN dh USING (patient_id) LEFT JOIN cr USING (patient_id) WHERE gap IS NULL OR gap > 365")]),
    "d3_condition_visit": _with(("mw_ncd_visits",)) + f"""SELECT patient_id, ncd_visit_id, visit_date, num_seizures FROM (
  SELECT *, row_number() OVER (PARTITION BY patient_id ORDER BY visit_date DESC, ncd_visit_id DESC) AS rn
  FROM mw_ncd_visits WHERE (epilepsy_initial OR epilepsy_followup) AND visit_date <= {T}) WHERE rn = 1""",
}


def _appointments(where: str) -> str:
    """CTE ``lasta``: each register patient's latest visit with an appointment."""
    parts = " UNION ALL ".join(f"""SELECT patient_id, visit_date, next_appointment_date FROM mw_{k}_visits v
  WHERE next_appointment_date IS NOT NULL AND EXISTS (SELECT 1 FROM mw_{k}_register r WHERE r.patient_id = v.patient_id AND {where})"""
                               for k in ("art", "eid", "ncd"))
    return f"""lasta AS (SELECT patient_id, l.d AS last_visit_date, l.a AS last_appt_date FROM (
  SELECT patient_id, max({{'d': visit_date, 'a': next_appointment_date}}) AS l FROM ({parts}) GROUP BY patient_id))"""


_HERE = _same("r.location", HERE)
SQL |= {
    "rp8_next_appointment": _with(_REGISTERS, _appointments(_HERE)) + "SELECT * FROM lasta",
    "rp9_expected": _with(_REGISTERS, _appointments("(r.end_date IS NULL OR r.end_date > DATE '2001-10-31')"))
    + "SELECT * FROM lasta WHERE last_appt_date BETWEEN DATE '2001-07-01' AND DATE '2001-10-31'",
    "rp9_expected_advanced": _with((*_REGISTERS, "omrs_program_state"), _appointments(f"(r.end_date IS NULL OR r.end_date > DATE '2001-10-31') AND {_HERE}"),
                                   """st AS (SELECT patient_id, (max({'d': start_date, 'i': program_state_id, 's': state})).s AS state
  FROM omrs_program_state GROUP BY patient_id)""")
    + """SELECT lasta.* FROM lasta LEFT JOIN st USING (patient_id) WHERE last_appt_date BETWEEN DATE '2001-04-01' AND DATE '2001-10-31'
  AND (st.state IS NULL OR st.state = 'In advanced care')""",
}


def _numbers(kind: str, table: str, column: str, where: str = "true") -> tuple[str, str]:
    return (f"{kind}_here AS (SELECT patient_id, max({column}) AS {kind}_number FROM {table} WHERE {where} AND {_same('location', HERE)} GROUP BY patient_id)",
            f"{kind}_all AS (SELECT patient_id, string_agg(DISTINCT {column}, ', ' ORDER BY {column}) AS all_{kind}_numbers FROM {table} "
            f"WHERE {where} AND {column} IS NOT NULL GROUP BY patient_id)")


_KINDS = {"art": ("mw_art_register", "art_number"), "eid": ("mw_eid_register", "eid_number"), "pre_art": ("mw_pre_art_register", "pre_art_number"),
          "ncd": ("mw_ncd_register", "ncd_number"), "yendanafe": ("omrs_patient_identifier", "identifier", _same("type", "Yendanafe Identifier"))}
_PARTS = [c for k, v in _KINDS.items() for c in _numbers(k, *v)]
_NAMES = [f"{k}_{w}" for k in _KINDS for w in ("here", "all")]
SQL["rp1_identifiers"] = _with([v[0] for v in _KINDS.values()], *_PARTS,
                               "who AS (" + " UNION ".join(f"SELECT patient_id FROM {n}" for n in _NAMES) + ")") \
    + "SELECT who.patient_id, " + ", ".join(f"{k}_number, all_{k}_numbers" for k in _KINDS) + " FROM who " \
    + " ".join(f"LEFT JOIN {n} USING (patient_id)" for n in _NAMES)


# ---------------------------------------------------------------- RP10

def _pick(name: str, table: str, date: str, key: str, picks: list[tuple[str, dict[str, str], str]]) -> str:
    """CTE of several picks: the values of the latest (earliest) row that meets a condition."""
    cols = []
    for i, (cond, values, how) in enumerate(picks):
        row = ", ".join([f"'d': {date}", f"'i': {key}", *(f"'{a}': {v}" for a, v in values.items())])
        cols += [f"({how}({{{row}}}) FILTER (WHERE ({cond}) AND {date} IS NOT NULL)).{a} AS {a}" for a in values]
    return f"{name} AS (SELECT patient_id, {', '.join(cols)} FROM {table} GROUP BY patient_id)"


def _current(prefix: str, program: str) -> str:
    cap = prefix[0].upper() + prefix[1:]
    return f"""cur_{prefix} AS (SELECT patient_id, start_date AS {prefix}CurrentStateStart, state AS current{cap}State, location AS {prefix}CurrentLocation FROM (
  SELECT s.*, row_number() OVER (PARTITION BY s.patient_id ORDER BY s.start_date DESC, e.enrollment_date DESC, e.completion_date ASC NULLS FIRST,
    s.program_state_id DESC) AS rn FROM omrs_program_state s JOIN omrs_program_enrollment e USING (program_enrollment_id)
  WHERE {_same('e.program', program)} AND s.start_date <= {T} AND (s.end_date IS NULL OR s.end_date > {T})) WHERE rn = 1)"""


_B = f"visit_date < {T}"
_DX = {"htnDx": ["Hypertension"], "dmDx": ["Diabetes", "Type 1 diabetes", "Type 2 diabetes"], "dmDx1": ["Type 1 diabetes"],
       "dmDx2": ["Type 2 diabetes"], "asthmaDx": ["Asthma"], "epilepsyDx": ["Epilepsy"]}
_IC3 = [
    "cohort AS (" + " UNION ".join(f"SELECT patient_id FROM mw_{k}_register WHERE {k}_number IS NOT NULL" for k in ("art", "ncd", "eid")) + ")",
    "dx AS (SELECT patient_id, " + ", ".join(f"max(CASE WHEN {_same('diagnosis', *v)} THEN 'X' END) AS {k}" for k, v in _DX.items())
    + f" FROM mw_ncd_diagnoses WHERE diagnosis_date < {T} GROUP BY patient_id)",
    "cv AS (SELECT patient_id, true AS cvDisease FROM mw_ncd_register WHERE cv_disease GROUP BY patient_id)",
    _pick("starts", f"(SELECT * FROM omrs_program_state WHERE start_date <= {T})", "start_date", "program_state_id", [
        (f"{_same('program', 'HIV Program')} AND {_same('state', 'On antiretrovirals')}", {"artStartDate": "start_date", "artStartLocation": "location"}, "min"),
        (f"{_same('program', 'Chronic Care Program')} AND {_same('state', 'On treatment')}", {"ncdStartDate": "start_date", "ncdStartLocation": "location"}, "min"),
        (f"{_same('program', 'HIV Program')} AND {_same('state', 'Exposed Child (Continue)')}", {"eidStartDate": "start_date", "eidStartLocation": "location"}, "min")]),
    _current("hiv", "HIV Program"), _current("ncd", "Chronic Care Program"),
    _pick("art_v", "mw_art_visits", "visit_date", "art_visit_id", [
        (f"visit_date <= {T}", {"lastArtVisit": "visit_date", "nextArtAppt": "next_appointment_date"}, "max"),
        (f"{_B} AND art_drug_regimen IS NOT NULL", {"lastArtRegimen": "art_drug_regimen"}, "max")]),
    _pick("eid_v", "mw_eid_visits", "visit_date", "eid_visit_id", [
        (f"visit_date <= {T}", {"lastEidVisit": "visit_date", "nextEidAppt": "next_appointment_date"}, "max")]),
    _pick("ncd_v", "mw_ncd_visits", "visit_date", "ncd_visit_id", [
        (f"visit_date <= {T}", {"lastNcdVisit": "visit_date"}, "max"),
        (f"{_B} AND diabetes_htn_followup", {
            "hba1cAtLastVisit": "hba1c", "fingerStickAtLastVisit": "serum_glucose", "footCheckAtLastVisit": "foot_check",
            "systolicBpAtLastVisit": "systolic_bp", "diastolicBpAtLastVisit": "diastolic_bp", "visualAcuityAtLastVisit": "visual_acuity",
            "cvRiskAtLastVisit": "cv_risk", "htnDmHospitalizedSinceLastVisit": "hospitalized_since_last_visit", "nextHtnDmAppt": "next_appointment_date"}, "max"),
        *[(f"{_B} AND {c} IS NOT NULL", {f"last{n}": c, f"last{n}{d}": "visit_date"}, "max")
          for c, n, d in (("hba1c", "Hba1c", "VisitDate"), ("proteinuria", "Proteinuria", "Date"), ("creatinine", "Creatinine", "Date"), ("fundoscopy", "Fundoscopy", "Date"))],
        (f"{_B} AND epilepsy_followup", {"seizuresSinceLastVisit": "seizure_activity", "seizures": "num_seizures",
                                         "epilepsyHospitalizedSinceLastVisit": "hospitalized_since_last_visit", "nextEpilepsyAppt": "next_appointment_date"}, "max"),
        (f"{_B} AND (num_seizures IS NOT NULL OR seizure_activity IS NOT NULL)", {"lastSeizureActivityRecorded": "visit_date"}, "max"),
        (f"{_B} AND asthma_followup", {"lastAsthmaVisitDate": "visit_date", "asthmaClassificationAtLastVisit": "asthma_classification",
                                       "nextAsthmaAppt": "next_appointment_date"}, "max"),
        (f"{_B} AND mental_health_followup", {
            "lastMentalHealthVisitDate": "visit_date", "mentalHospitalizedSinceLastVisit": "hospitalized_since_last_visit",
            "mentalHealthRxSideEffectsAtLastVisit": "mental_health_drug_side_effect", "mentalStatusExam": "mental_status_exam",
            "mentalStableAtLastVisit": "mental_stable", "nextMentalHealthAppt": "next_appointment_date"}, "max")]),
    _pick("lab_p", "(SELECT *, coalesce(date_collected, date_result_entered) AS any_date FROM mw_lab_tests)", "any_date", "lab_test_id", [
        (f"{_same('test_type', VL)} AND date_collected <= {T}", {"lastViralLoadTest": "date_collected"}, "max"),
        (f"{_same('test_type', PCR)} AND date_collected <= {T}", {"lastDnaPcrTest": "date_collected", "lastDnaPcrResult": "result_coded"}, "max"),
        (f"{_same('test_type', RAPID, 'HIV test')} AND (date_collected <= {T} OR date_result_entered < {T})",
         {"lastRapidTest": "any_date", "lastRapidResult": "result_coded"}, "max")]),
    "mother AS (SELECT patient_id, max(mother_art_number) AS motherArtNumber FROM mw_eid_register GROUP BY patient_id)",
    _pick("mstat", "omrs_obs", "obs_date", "obs_id", [
        (f"concept = 'Mother HIV Status' AND obs_date < {T} AND encounter_type = 'EXPOSED_CHILD_INITIAL'", {"motherEnrollmentHivStatus": "value_coded"}, "max")]),
    """mh AS (SELECT encounter_id, (min({'i': obs_id, 'v': value_coded}) FILTER (WHERE concept = 'Able to perform daily activities')).v AS able,
  (min({'i': obs_id, 'v': value_coded}) FILTER (WHERE concept = 'Suicide risk')).v AS risk FROM omrs_obs GROUP BY encounter_id)""",
    f"""mh_last AS (SELECT patient_id, l.a AS ablePerformDailyActivitiesAtLastVisit, l.r AS suicideRiskAtLastVisit FROM (
  SELECT e.patient_id, max({{'d': e.encounter_date, 'i': e.encounter_id, 'a': mh.able, 'r': mh.risk}}) AS l
  FROM omrs_encounter e LEFT JOIN mh USING (encounter_id) WHERE e.encounter_type = 'MENTAL_HEALTH_FOLLOWUP' AND e.encounter_date < {T} GROUP BY e.patient_id))""",
]
SQL["rp10_ic3"] = _with((*_REGISTERS, "mw_patient", "mw_ncd_diagnoses", "mw_lab_tests", "omrs_program_state", "omrs_program_enrollment", "omrs_obs",
                         "omrs_encounter"), *_IC3) \
    + "SELECT *, greatest(lastArtVisit, lastNcdVisit) AS lastIc3Visit, greatest(nextHtnDmAppt, nextAsthmaAppt, nextEpilepsyAppt, nextMentalHealthAppt, " \
      "nextArtAppt) AS latestAppt FROM cohort LEFT JOIN mw_patient USING (patient_id) " \
    + " ".join(f"LEFT JOIN {n} USING (patient_id)" for n in ("dx", "cv", "starts", "cur_hiv", "cur_ncd", "art_v", "eid_v", "ncd_v", "lab_p", "mother", "mstat", "mh_last"))
