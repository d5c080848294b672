"""A flat layer in the mart's vocabulary, derived from the driver's test tables,
and the mart jobs bound to it.

Like ``testbed_mart``, each flat table is one SQL text that Spark and DuckDB
share; here the jobs under test are those from the flat layer to the mart:
form and visit tables, lab histories, registers, diagnoses, regimens,
snapshots, trace tables and the value facts of the star schema.

Role map: encounters = orders, whose type is chosen by the order's number among
all types the forms name; observations = order lines, whose concept is chosen by
part, supplier and line number among the concepts of the encounter's type;
programmes, states and identifiers = customers and orders.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from . import forms, malawi, reports
from . import testbed_mart as M
from .lazy import LazyTables
from ..schemas import FLAT, conform, struct

OTHER = "Some other question"
ANSWERS = ("Yes", "No", "Positive", "negative")

# concepts of a type beyond those its form names: (concept, value kind, answer, group)
MORE = {
    "Viral Load Screening": [("Sample taken for Viral Load", "value_coded", "True", None), ("Lower than Detection Limit", "value_coded", "true", None)],
    "EXPOSED_CHILD_FOLLOWUP": [("Result of HIV test", "value_coded", None, "HIV Test Construct"), ("HIV test date", "value_date", None, "HIV Test Construct"),
                               ("HIV test type", "value_coded", "HIV rapid test, qualitative", "HIV Test Construct")],
    "EXPOSED_CHILD_INITIAL": [("Mother ART registration number", "value_text", None, None)],
    "ART_INITIAL": [(c, "value_coded", None, None) for c, _, _ in malawi.REGIMEN_LINES] + [(d, "value_date", None, None) for _, d, _ in malawi.REGIMEN_LINES],
    "CHRONIC_CARE_INITIAL": [("Chronic care diagnosis", "value_coded", a, "Diagnosis Construct") for a in ("Hypertension", "Asthma", "Cardiovascular disease")]
    + [("Diagnosis date", "value_date", None, "Diagnosis Construct"), ("Weight (kg)", "value_numeric", None, None), ("HIV viral load", "value_numeric", None, None)],
}
MORE |= {t: [*MORE.get(t, []), *[(c, s.value, s.answer, None) for s in (*forms.NCD_VISIT_COLUMNS, *forms.NCD_TYPED_COLUMNS)
                                 for c in (s.concept if isinstance(s.concept, tuple) else (s.concept,))]] for t in forms.NCD_TYPES}


def _vocabulary() -> dict[str, list[tuple]]:
    """Encounter type -> (concept, value kind, answer, group, stands in a group), in listed order."""
    out: dict[str, list[tuple]] = {}
    for spec in forms.FORMS.values():
        for t in spec.types:
            for c in spec.columns:
                for concept in c.concept if isinstance(c.concept, tuple) else (c.concept or OTHER,):
                    out.setdefault(t, []).append((concept, c.value, c.answer, c.group, c.name in spec.grouped))
    for t, rows in MORE.items():
        out.setdefault(t, []).extend((c, kind, answer, group, group is not None) for c, kind, answer, group in rows)
    return {t: list(dict.fromkeys(rows)) for t, rows in out.items()} | {"Other encounter": [(OTHER, "value_numeric", None, None, False)]}


VOCABULARY = _vocabulary()


def _text(value: str | None) -> str:
    return "CAST(NULL AS STRING)" if value is None else "'" + value.replace("'", "''") + "'"


def _vocabulary_sql() -> tuple[str, str]:
    types, rows = [], []
    for i, (t, concepts) in enumerate(VOCABULARY.items()):
        types.append(f"({i}, {_text(t)}, {len(concepts)})")
        groups = list(dict.fromkeys(g for *_, g, _ in concepts if g))
        for k, (concept, kind, answer, group, grouped) in enumerate(concepts):
            rows.append(f"({i}, {k}, {_text(concept)}, '{kind}', {_text(answer)}, {_text(group)}, {1 + groups.index(group) if group else 90 if grouped else 0})")
    return ", ".join(types), ", ".join(rows)


_TYPES, _CONCEPTS = _vocabulary_sql()
_ENC = f"""(SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day, t.i, t.name AS etype, t.m
    FROM orders JOIN (VALUES {_TYPES}) AS t(i, name, m) ON t.i = o_orderkey % {len(VOCABULARY)})"""
# concepts are chosen by part, supplier and line; an observation in a group of its form without a name of its own: one of two groups
_LINES = f"""(SELECT e.*, l.l_linenumber, l.l_quantity, CAST(l.l_shipdate AS DATE) AS ship, l.l_suppkey, v.concept, v.kind, v.answer, v.grp,
    ((l.l_orderkey * 10 + l.l_linenumber) * 100000 + l.l_partkey) * 10000 + l.l_suppkey AS obs_id,
    CASE WHEN v.gno > 0 THEN l.l_orderkey * 100 + v.gno + CASE WHEN v.gno = 90 THEN l.l_linenumber % 2 ELSE 0 END END AS obs_group_id
    FROM lineitem l JOIN {_ENC} e ON e.o_orderkey = l.l_orderkey
    JOIN (VALUES {_CONCEPTS}) AS v(i, k, concept, kind, answer, grp, gno) ON v.i = e.i AND v.k = (l.l_partkey * 7 + l.l_suppkey * 3 + l.l_linenumber) % e.m)"""
_LOC = "CASE WHEN {c} % 5 < 4 THEN 'Clinic ' || CAST({c} % 5 AS STRING) END"
_ANSWER = "CASE l_suppkey % 4 " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ANSWERS)) + " END"
# all findings of one visit: the foot check and the mental status exam
_WHOLE = [(forms.FOOT_CHECK_TYPE, c, "Yes") for c in forms.FOOT_CHECKS] \
    + [(forms.MENTAL_STATUS_TYPE, forms.MENTAL_STATUS_CONCEPT, a) for a in forms.MENTAL_STATUS_ANSWERS]


def _whole_findings() -> str:
    rows = ", ".join(f"({_text(t)}, {i}, {_text(c)}, {_text(a)})" for i, (t, c, a) in enumerate(_WHOLE))
    return f"""SELECT 4000000000000000000 + e.o_orderkey * 100 + w.k, o_custkey, o_orderkey, day, etype, w.concept, w.answer,
    CAST(NULL AS DATE), CAST(NULL AS DOUBLE), CAST(NULL AS STRING), CAST(NULL AS BIGINT), {_LOC.format(c='o_custkey')}
    FROM {_ENC} e JOIN (VALUES {rows}) AS w(t, k, concept, answer) ON w.t = e.etype WHERE w.k % 5 <> e.o_orderkey % 7"""


_STATES = [("HIV program", "Treatment status", s) for s in ("On antiretrovirals", "Pre-ART (Continue)", "Exposed child (continue)", "Patient died")] \
    + [("Chronic care program", "Chronic care treatment status", s) for s in ("On treatment", "Patient defaulted")] \
    + [("Oncology", "Diagnosis", "Breast cancer"), ("Oncology", "Diagnosis Status", "Confirmed"), ("Oncology", "Diagnosis Status", "Suspected")]
_ENROLLED = ["HIV program", "Chronic care program", "Oncology", "PDC PROGRAM"]
_IDENTIFIERS = ["ARV Number", "HCC Number", "Exposed Infant Number", "Chronic Care Number"]

TABLES = {
    "omrs_patient": "SELECT c_custkey AS patient_id, md5(CAST(c_custkey AS STRING)) AS patient_uuid, 'P' || CAST(c_custkey AS STRING) AS identifier, "
                    "c_name AS first_name, CASE WHEN c_custkey % 9 = 0 THEN NULL WHEN c_acctbal > 0 THEN 'F' ELSE 'M' END AS gender, "
                    "DATE '1960-01-01' + CAST(c_custkey * 37 % 12000 AS INT) AS birthdate, c_custkey % 13 = 0 AS dead, "
                    "CASE WHEN c_custkey % 13 = 0 THEN DATE '1999-01-01' + CAST(c_custkey % 600 AS INT) END AS death_date, "
                    "'District ' || CAST(c_nationkey AS STRING) AS state_province FROM customer",
    "omrs_encounter": f"SELECT o_orderkey AS encounter_id, md5('e' || CAST(o_orderkey AS STRING)) AS uuid, o_custkey AS patient_id, etype AS encounter_type, "
                      f"CASE o_orderkey % 4 WHEN 0 THEN 'PDC malnutrition Acute form' WHEN 1 THEN 'Form B' END AS form, {_LOC.format(c='o_custkey')} AS location, "
                      "day AS encounter_date, '10:30:00' AS encounter_time, CAST(o_custkey % 70 AS BIGINT) AS age_years_at_encounter, "
                      f"CAST(o_custkey % 70 * 12 + o_custkey % 12 AS BIGINT) AS age_months_at_encounter FROM {_ENC} x",
    "omrs_obs": f"""SELECT obs_id, o_custkey AS patient_id, o_orderkey AS encounter_id, day AS obs_date, etype AS encounter_type, concept,
        CASE WHEN kind = 'value_coded' THEN coalesce(answer, {_ANSWER}) END AS value_coded, CASE WHEN kind = 'value_date' THEN ship END AS value_date,
        CASE WHEN kind = 'value_numeric' THEN l_quantity + CAST(l_linenumber AS DOUBLE) / 4 END AS value_numeric,
        CASE WHEN kind = 'value_text' THEN 'text ' || CAST(l_suppkey AS STRING) END AS value_text, obs_group_id, {_LOC.format(c='o_custkey')} AS location,
        '11:45:00' AS obs_time, CAST(o_custkey % 70 AS BIGINT) AS age_years_at_obs, CAST(o_custkey % 70 * 12 + o_custkey % 12 AS BIGINT) AS age_months_at_obs,
        ship AS date_created FROM {_LINES} x""",
    "omrs_obs_group": f"SELECT DISTINCT obs_group_id, o_custkey AS patient_id, o_orderkey AS encounter_id, day AS obs_group_date, etype AS encounter_type, "
                      f"coalesce(grp, 'Construct') AS concept FROM {_LINES} x WHERE obs_group_id IS NOT NULL",
    "omrs_program_enrollment": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS program_enrollment_id, md5('pp' || CAST(c_custkey * 10 + {i} AS STRING)) AS uuid, c_custkey AS patient_id, "
        f"'{name}' AS program, DATE '1995-03-01' + CAST(c_custkey * {i + 3} % 900 AS INT) AS enrollment_date, {_LOC.format(c='c_custkey')} AS location, "
        f"CASE WHEN (c_custkey + {i}) % 6 = 0 THEN DATE '1999-01-01' + CAST(c_custkey % 700 AS INT) END AS completion_date, "
        f"CASE WHEN (c_custkey + {i}) % 6 = 0 THEN 'Treatment complete' END AS outcome FROM customer" for i, name in enumerate(_ENROLLED)),
    "omrs_program_state": f"""SELECT o_orderkey AS program_state_id, md5('ps' || CAST(o_orderkey AS STRING)) AS uuid,
        o_custkey * 10 + s.e AS program_enrollment_id, o_custkey AS patient_id, s.program, s.workflow, s.state, CAST(o_orderdate AS DATE) AS start_date,
        CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey * 7 % 400 AS INT) END AS end_date, {_LOC.format(c='o_custkey')} AS location
        FROM orders JOIN (VALUES {', '.join(f"({i}, {_ENROLLED.index(p)}, {_text(p)}, {_text(w)}, {_text(st)})" for i, (p, w, st) in enumerate(_STATES))})
        AS s(i, e, program, workflow, state) ON s.i = o_orderkey % {len(_STATES)}""",
    "omrs_patient_identifier": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS patient_identifier_id, c_custkey AS patient_id, '{t}' AS type, 'Q{i}CH ' || CAST(c_custkey % 997 AS STRING) AS identifier, "
        f"{_LOC.format(c='(c_custkey + ' + str(i // 4) + ')')} AS location, DATE '1996-01-01' + CAST(c_custkey * {i + 1} % 300 AS INT) AS date_created FROM customer "
        f"WHERE c_custkey % {3 + i} <> 0" for i, t in enumerate([*_IDENTIFIERS, *_IDENTIFIERS])),
    "omrs_relationship": " UNION ALL ".join(
        f"SELECT c_custkey * 10 + {i} AS relationship_id, c_custkey AS patient_id, '{role}' AS related_person_role, 'Worker ' || CAST(c_custkey * {i + 3} % 50 AS STRING) "
        f"AS related_person, CASE WHEN c_custkey % 3 <> {i} THEN DATE '1996-01-01' + CAST(c_custkey * {i + 5} % 400 AS INT) END AS start_date, "
        f"CASE WHEN c_custkey % 4 = {i} THEN DATE '1998-01-01' END AS end_date, DATE '1996-01-01' + CAST(c_custkey % 90 AS INT) AS date_created FROM customer "
        f"WHERE c_custkey % 5 <> {i}" for i, role in enumerate(["Community Health Worker", "Guardian", "community health worker"])),
}
_MORE_OBS = f"SELECT *, '12:00:00', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DATE) FROM ({_whole_findings()}) w"
TABLES["omrs_obs"] += f" UNION ALL {_MORE_OBS}"

SOURCES = ("customer", "orders", "lineitem", "events", "nation", "supplier")


def run(spark: SparkSession, sf: str, text: str):
    """A shared SQL text over the test tables in Spark."""
    from .testbed import _t
    used = {}
    for s in SOURCES:
        for word in ("FROM", "JOIN"):
            if f"{word} {s}" in text:
                used[s] = _t(spark, sf, s)
                text = text.replace(f"{word} {s}", f"{word} {{{s}}}")
    return spark.sql(text, **used)


def flat(spark: SparkSession, sf: str) -> LazyTables:
    """The derived flat layer, each table conformed to its declared schema when first read."""
    tables = {name: (lambda _, name=name, text=text: conform(run(spark, sf, text), FLAT[name])) for name, text in TABLES.items()}
    tables |= {name: (lambda _, name=name: spark.createDataFrame([], struct(FLAT[name]))) for name in FLAT if name not in tables}
    tables["lookup_location"] = lambda t: t["omrs_encounter"].select("location").distinct().withColumnRenamed("location", "target_value")
    return LazyTables(tables)


def _form(name):
    def query(spark, sf):
        return forms.build_form(flat(spark, sf), name)
    query.__name__, query.__doc__ = f"m_{name[3:]}", f"M-FORMS: the table {name}."
    return query


def m_ncd_visits(spark, sf):
    """M-VNCD: one row per chronic-care visit."""
    return forms.ncd_visits(flat(spark, sf))


def m_lab_tests(spark, sf):
    """M-LABV and M-LABH: viral loads and HIV tests as one numbered history."""
    return malawi.mw_lab_tests(flat(spark, sf))


def m_patient(spark, sf):
    """M-PAT: patients with their current community health worker."""
    return malawi.mw_patient(flat(spark, sf))


def m_ncd_diagnoses(spark, sf):
    """M-DX: earliest date of each diagnosis."""
    return malawi.mw_ncd_diagnoses(flat(spark, sf))


def m_art_regimen(spark, sf):
    """M-REG: regimens of three lines with their start dates."""
    return malawi.mw_art_regimen(flat(spark, sf))


def m_second_regimen(spark, sf):
    """M-FN: each patient's last but one regimen."""
    return malawi.nth_regimen(malawi.mw_art_regimen(flat(spark, sf)), 1)


def m_art_register(spark, sf):
    """M-RART: ART episodes with number, outcome, last visit and last viral loads."""
    m = M.mart(spark, sf)
    return malawi.mw_art_register(flat(spark, sf), m["mw_art_visits"], m["mw_lab_tests"])


def m_pre_art_register(spark, sf):
    """M-RPRE."""
    return malawi.mw_pre_art_register(flat(spark, sf))


def m_eid_register(spark, sf):
    """M-REID: exposed-child episodes with the mother's numbers and the last visit."""
    return malawi.mw_eid_register(flat(spark, sf), M.mart(spark, sf)["mw_eid_visits"])


def m_ncd_register(spark, sf):
    """M-RNCD."""
    return malawi.mw_ncd_register(flat(spark, sf))


def m_last_obs(spark, sf):
    """M-LASTOBS: latest observations per patient, concept and quarter."""
    from .testbed import _quarters
    return malawi.last_obs_in_period(flat(spark, sf), ["HIV viral load", "Weight (kg)"], _quarters(spark))


def m_recent_lab(spark, sf):
    """M-LASTLAB: the latest lab test of every ART patient per quarter, or blanks."""
    from .testbed import _quarters
    m = M.mart(spark, sf)
    return malawi.lab_tests_recent_period(m["mw_art_register"].select("patient_id").distinct(), m["mw_lab_tests"], _quarters(spark))


def m_art_trace(spark, sf):
    """M-TART: open ART episodes with last visit, appointment and viral load."""
    m = M.mart(spark, sf)
    return malawi.art_trace(m["mw_art_register"], m["mw_art_visits"], m["mw_lab_tests"])


def m_eid_trace(spark, sf):
    """M-TEID: open exposed-child episodes with breastfeeding and last two tests."""
    m = M.mart(spark, sf)
    return malawi.eid_trace(m["mw_eid_register"], m["mw_eid_visits"], m["mw_lab_tests"], {})


def _star(name):
    def query(spark, sf):
        from .star import build_star
        return build_star(spark, flat(spark, sf))[name]
    query.__name__, query.__doc__ = f"star_{name}", f"The star schema's {name} over the derived flat layer."
    return query


def r_onc_diagnosis(spark, sf):
    """R-ONC: oncology diagnoses with the status in force at their start."""
    from .rwanda import rw_onc_diagnosis
    return rw_onc_diagnosis(flat(spark, sf)).select("program_state_id", "program_enrollment_id", "patient_id", "state", "start_date", "diagnosis_status",
                                                    "diagnosis_status_start_date", "start_date_difference", "end_date_difference")


def r_pdc_program(spark, sf):
    """R-PDC: the enrollments with the derived malnutrition programme."""
    from .rwanda import rw_pdc_malnutrition_program
    return rw_pdc_malnutrition_program(flat(spark, sf))[1]


def r_pdc_zscore_input(spark, sf):
    """R-ZIN: weight and height of a day, sex code and age in days."""
    from .rwanda import pdc_z_score_input
    return pdc_z_score_input(flat(spark, sf))


# weights and heights for the growth input: children of PDC PROGRAM, several a day
TABLES["omrs_obs"] += """ UNION ALL SELECT 5000000000000000000 + ((l_orderkey * 10 + l_linenumber) * 100000 + l_partkey) * 10000 + l_suppkey, o_custkey, o_orderkey,
    CAST(o_orderdate AS DATE), 'Growth', CASE WHEN l_partkey % 2 = 0 THEN 'WEIGHT (KG)' ELSE 'Height (cm)' END, CAST(NULL AS STRING), CAST(NULL AS DATE),
    CASE WHEN l_linenumber <> 4 THEN l_quantity + CAST(l_linenumber AS DOUBLE) / 2 END, CAST(NULL AS STRING), CAST(NULL AS BIGINT), 'Clinic 1', '12:00:00', CAST(NULL AS BIGINT),
    CAST(NULL AS BIGINT), CAST(NULL AS DATE) FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE o_custkey % 4 = 1 AND l_partkey % 9 < 5
    UNION ALL SELECT 6000000000000000000 + o_orderkey, o_custkey, o_orderkey, CAST(o_orderdate AS DATE), 'Growth', 'Cured (malnutrition)', 'Yes', CAST(NULL AS DATE),
    CAST(NULL AS DOUBLE), CAST(NULL AS STRING), CAST(NULL AS BIGINT), 'Clinic 1', '12:00:00', CAST(NULL AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS DATE)
    FROM orders WHERE o_orderkey % 8 = 0"""

STAR = ("fact_patient_coded_value", "fact_patient_date_value", "dim_patient", "dim_coded_question", "dim_coded_value", "dim_date_question")
QUERIES = {f.__name__: f for f in (*map(_form, forms.FORMS), m_ncd_visits, m_lab_tests, m_patient, m_ncd_diagnoses, m_art_regimen, m_second_regimen,
                                   m_art_register, m_pre_art_register, m_eid_register, m_ncd_register, m_last_obs, m_recent_lab, m_art_trace, m_eid_trace,
                                   *map(_star, STAR), r_onc_diagnosis, r_pdc_program, r_pdc_zscore_input)}
