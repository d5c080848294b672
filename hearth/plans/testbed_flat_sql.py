"""DuckDB oracles of the mart jobs bound in ``testbed_flat``."""

from __future__ import annotations

from . import forms
from . import testbed_mart as M
from .malawi import REGIMEN_LINES
from .schema_sql import duck_type
from .testbed_flat import TABLES
from .testbed_sql import QUARTERS

KEYS = "patient_id, visit_date, location"
_ORDER = "patient_id NULLS FIRST, visit_date NULLS FIRST, location NULLS FIRST"


def _with(tables, *more: str) -> str:
    both = TABLES | {k: v for k, v in M.TABLES.items() if k.startswith("mw_")}
    return "WITH " + ",\n".join([*(f"{n} AS MATERIALIZED ({both[n]})" for n in tables), *more]) + "\n"


def _in(column: str, texts) -> str:
    texts = (texts,) if isinstance(texts, str) else texts
    return f"lower(trim({column})) IN ({', '.join(chr(39) + t.lower().replace(chr(39), chr(39) * 2) + chr(39) for t in texts)})"


def _first(cond: str, value: str, by: str = "obs_id") -> str:
    """The value of the row with the least ``by`` that meets the condition (null if its value is null)."""
    return f"(min({{'i': {by}, 'v': {value}}}) FILTER (WHERE {cond})).v"


# observations with their encounter's visit key and their group's concept
_V = """v AS MATERIALIZED (SELECT e.patient_id, e.encounter_date AS visit_date, e.location, e.encounter_type, o.obs_id, o.encounter_id, o.concept,
  o.value_coded, o.value_date, o.value_numeric, o.value_text, o.obs_group_id, g.concept AS group_concept
  FROM omrs_obs o JOIN omrs_encounter e USING (encounter_id) LEFT JOIN omrs_obs_group g USING (obs_group_id))"""
_BASE = ("omrs_encounter", "omrs_obs", "omrs_obs_group")
_SAME_VISIT = "s.patient_id = {a}.patient_id AND s.visit_date = {a}.visit_date AND s.location IS NOT DISTINCT FROM {a}.location"


def _column(spec, c) -> str:
    cond = ["true" if c.name in spec.untyped else _in("encounter_type", spec.types)]
    if c.concept is not None:
        cond.append(_in("concept", c.concept))
    if c.answer is not None:
        cond.append(_in(c.value, c.answer))
    if c.group is not None:
        cond.append(_in("group_concept", c.group))
    return _first(" AND ".join(cond), c.value)


def _form(spec) -> str:
    """A form table: picks per visit (and per observation group), numbered, in the declared types."""
    parts: dict[str, list[str]] = {}
    picks: dict[bool, list[str]] = {False: [], True: []}
    concepts: dict[bool, list] = {False: [], True: []}
    for i, c in enumerate(spec.columns):
        grouped = c.name in spec.grouped
        picks[grouped].append(f"{_column(spec, c)} AS c{i}")
        concepts[grouped].append(c.concept)
        parts.setdefault(c.name, []).append(f"c{i}")

    def scanned(grouped):
        if None in concepts[grouped]:
            return "true"
        return _in("concept", list(dict.fromkeys(x for c in concepts[grouped] for x in (c if isinstance(c, tuple) else (c,)))))
    ctes = [_V, f"s AS (SELECT DISTINCT patient_id, encounter_date AS visit_date, location FROM omrs_encounter WHERE {_in('encounter_type', spec.types)})"]
    joins, order = "FROM s", _ORDER.replace("patient_id", "s.patient_id").replace("visit_date", "s.visit_date").replace("location", "s.location")
    if picks[False]:
        ctes.append(f"p AS (SELECT {KEYS}, {', '.join(picks[False])} FROM v GROUP BY {KEYS})")
        joins += f" LEFT JOIN p ON {_SAME_VISIT.format(a='p')}"
    if picks[True]:
        ctes.append(f"g AS (SELECT {KEYS}, obs_group_id, {', '.join(picks[True])} FROM v WHERE obs_group_id IS NOT NULL AND {scanned(True)} "
                    f"GROUP BY {KEYS}, obs_group_id)")
        joins += f" LEFT JOIN g ON {_SAME_VISIT.format(a='g')}"
        order += ", g.obs_group_id NULLS FIRST"
    out = []
    for d in spec.ddl:
        name, kind = d.split(None, 1)
        kind, kinds = duck_type(kind), {c.value for c in spec.columns if c.name == name}
        if name == spec.id_col:
            out.append(f"row_number() OVER (ORDER BY {order}) AS {name}")
        elif name in ("patient_id", "visit_date", "location"):
            out.append(f"s.{name}")
        else:
            value = f"coalesce({', '.join(parts[name])})"
            value = f"round({value})" if kind in ("BIGINT", "INTEGER") and kinds == {"value_numeric"} else value
            out.append(f"CAST({value} AS {kind}) AS {name}")
    return _with(_BASE, *ctes) + f"SELECT {', '.join(out)} {joins}"


def _ncd() -> str:
    def pick(c):
        cond = _in("concept", c.concept) + (f" AND {_in(c.value, c.answer)}" if c.answer else "")
        return {"first": _first(cond, c.value), "min": f"min({c.value}) FILTER (WHERE {cond})", "max": f"max({c.value}) FILTER (WHERE {cond})",
                "flag": f"CASE WHEN count(*) FILTER (WHERE {cond}) > 0 THEN true END",
                "concat": f"string_agg({c.value}, '{c.sep}' ORDER BY {c.value}) FILTER (WHERE {cond})"}[c.agg] + f" AS {c.name}"
    ctes = [_V,
            f"""s AS (SELECT patient_id, encounter_date AS visit_date, location, string_agg(DISTINCT encounter_type, ', ' ORDER BY encounter_type) AS visit_types,
  {', '.join(f"bool_or({_in('encounter_type', t)}) AS {k}" for k, t in forms.NCD_FLAGS.items())}
  FROM omrs_encounter WHERE {_in('encounter_type', forms.NCD_TYPES)} GROUP BY patient_id, encounter_date, location)""",
            f"a AS (SELECT {KEYS}, {', '.join(map(pick, forms.NCD_VISIT_COLUMNS))} FROM v GROUP BY {KEYS})",
            f"b AS (SELECT {KEYS}, {', '.join(map(pick, forms.NCD_TYPED_COLUMNS))} FROM v WHERE {_in('encounter_type', forms.NCD_TYPES)} GROUP BY {KEYS})",
            f"""f AS (SELECT {KEYS}, true AS foot_check FROM (SELECT {KEYS}, encounter_id FROM v WHERE {_in('encounter_type', forms.FOOT_CHECK_TYPE)}
  AND {_in('concept', forms.FOOT_CHECKS)} GROUP BY {KEYS}, encounter_id HAVING count(DISTINCT lower(concept)) = 3) GROUP BY {KEYS})""",
            f"""m AS (SELECT {KEYS}, 'Normal' AS mental_status_exam FROM (SELECT {KEYS}, encounter_id FROM v WHERE {_in('encounter_type', forms.MENTAL_STATUS_TYPE)}
  AND {_in('concept', forms.MENTAL_STATUS_CONCEPT)} AND {_in('value_coded', forms.MENTAL_STATUS_ANSWERS)} GROUP BY {KEYS}, encounter_id
  HAVING count(DISTINCT lower(value_coded)) = 8) GROUP BY {KEYS})"""]
    cols = [*[c.name for c in (*forms.NCD_VISIT_COLUMNS, *forms.NCD_TYPED_COLUMNS)], "foot_check", "mental_status_exam"]
    order = ", ".join(f"s.{k} NULLS FIRST" for k in ("patient_id", "visit_date", "location"))
    return _with(_BASE, *ctes) + f"SELECT s.*, {', '.join(cols)}, row_number() OVER (ORDER BY {order}) AS ncd_visit_id FROM s " \
        + " ".join(f"LEFT JOIN {a} ON {_SAME_VISIT.format(a=a)}" for a in "abfm")


def _latest(name: str, table: str, key: str, order: str, n: int = 1) -> str:
    return f"{name} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {table}) WHERE rn = {n})"


_RES = f"({_in('concept', 'Lower than Detection Limit')} AND {_in('value_coded', 'True')} OR {_in('concept', ('Less than limit', 'HIV viral load'))})"
_LABS = f"""vl AS (SELECT patient_id, encounter_id, min(obs_date) AS date_collected, 'Viral Load' AS test_type,
  min(date_created) FILTER (WHERE {_RES}) AS date_result_entered, CAST(NULL AS VARCHAR) AS result_coded,
  {_first(_in('concept', 'HIV viral load'), 'value_numeric')} AS result_numeric,
  coalesce({_first(_in('concept', 'Less than limit'),
                   "'<' || CASE WHEN value_numeric = floor(value_numeric) THEN CAST(CAST(value_numeric AS BIGINT) AS VARCHAR) ELSE CAST(value_numeric AS VARCHAR) END")},
    {_first(_in('concept', 'Lower than Detection Limit') + ' AND ' + _in('value_coded', 'True'), 'concept')}) AS result_exception, CAST(NULL AS BIGINT) AS obs_group_id
  FROM omrs_obs WHERE encounter_id IS NOT NULL AND ({_RES} OR {_in('concept', 'Sample taken for Viral Load')} AND {_in('value_coded', 'True')})
  GROUP BY patient_id, encounter_id),
hg AS (SELECT o.patient_id, o.encounter_id, o.obs_group_id, {_first(_in('o.concept', 'Result of HIV test'), 'o.value_coded', 'o.obs_id')} AS result_coded,
  min(o.value_date) FILTER (WHERE {_in('o.concept', 'HIV test date')}) AS tdate, min(o.value_coded) FILTER (WHERE {_in('o.concept', 'HIV test type')}) AS ttype,
  min(o.date_created) FILTER (WHERE {_in('o.concept', 'Result of HIV test')}) AS entered
  FROM omrs_obs o JOIN omrs_obs_group g ON g.obs_group_id = o.obs_group_id AND {_in('g.concept', 'HIV Test Construct')}
  GROUP BY o.patient_id, o.encounter_id, o.obs_group_id),
lt AS (SELECT * FROM vl UNION ALL SELECT hg.patient_id, hg.encounter_id, coalesce(tdate, e.encounter_date), coalesce(ttype, 'HIV test'), entered, result_coded,
  CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), obs_group_id FROM hg LEFT JOIN omrs_encounter e USING (encounter_id))"""

_FORMATTED = "upper(substr(identifier, 1, 4)) || '-' || CASE WHEN length(substr(identifier, 6)) < 4 THEN lpad(substr(identifier, 6), 4, '0') ELSE substr(identifier, 6) END"


def _episodes(program: str, workflow: str, state: str) -> str:
    """CTE ``eps``: state episodes with their end and outcome."""
    return f"""eps AS (SELECT s.program_state_id, s.program_enrollment_id, s.patient_id, s.location, s.start_date, coalesce(s.end_date, e.completion_date) AS end_date,
  coalesce((SELECT (min({{'d': n.start_date, 'i': n.program_state_id, 's': n.state}})).s FROM omrs_program_state n
    WHERE n.program_enrollment_id = s.program_enrollment_id AND n.start_date >= s.end_date), e.outcome) AS outcome
  FROM omrs_program_state s JOIN omrs_program_enrollment e USING (program_enrollment_id)
  WHERE {_in('s.program', program)} AND {_in('s.workflow', workflow)} AND {_in('s.state', state)})"""


def _number(kind: str) -> str:
    """CTE ``num``: the newest identifier of a type per patient and location."""
    return f"""num AS (SELECT patient_id, location, {_FORMATTED} AS number FROM (SELECT *, row_number() OVER (PARTITION BY patient_id, location
  ORDER BY date_created DESC, patient_identifier_id DESC) AS rn FROM omrs_patient_identifier WHERE {_in('type', kind)}) WHERE rn = 1)"""


_AT = "LEFT JOIN num ON num.patient_id = {a}.patient_id AND num.location IS NOT DISTINCT FROM {a}.location"
_VLS = f"""mvl AS (SELECT *, coalesce(date_collected, date_result_received, date_result_entered) AS d FROM mw_lab_tests
  WHERE {_in('test_type', 'Viral Load')} AND coalesce(date_collected, date_result_received, date_result_entered) IS NOT NULL),
mvr AS (SELECT * FROM mvl WHERE result_numeric IS NOT NULL OR result_exception IS NOT NULL)"""
_EPISODE = ("omrs_program_state", "omrs_program_enrollment", "omrs_patient_identifier")
_REGIMENS = "reg AS (" + " UNION ALL ".join(
    f"""SELECT r.patient_id, r.value_coded AS regimen, d.day AS regimen_init_date, CAST(NULL AS INTEGER) AS num_of_prev_regimens, CAST(NULL AS DATE) AS regimen_end_date,
  '{line}' AS line FROM omrs_obs r LEFT JOIN (SELECT encounter_id, min(value_date) AS day FROM omrs_obs WHERE {_in('concept', dated)} AND encounter_id IS NOT NULL
  GROUP BY encounter_id) d USING (encounter_id) WHERE {_in('r.concept', concept)}""" for concept, dated, line in REGIMEN_LINES) + ")"

SQL = {f"m_{name[3:]}": _form(spec) for name, spec in forms.FORMS.items()}
SQL |= {
    "m_ncd_visits": _ncd(),
    "m_lab_tests": _with(_BASE, _LABS) + """SELECT row_number() OVER (ORDER BY patient_id NULLS FIRST, encounter_id NULLS FIRST, test_type, obs_group_id NULLS FIRST) AS lab_test_id,
  patient_id, encounter_id, date_collected, test_type, CAST(NULL AS DATE) AS date_result_received, date_result_entered, result_coded, result_numeric, result_exception FROM lt""",
    "m_patient": _with(("omrs_patient", "omrs_relationship"), f"""chw AS (SELECT * FROM (SELECT patient_id, related_person, row_number() OVER (PARTITION BY patient_id
  ORDER BY end_date IS NULL DESC, start_date IS NOT NULL DESC, date_created DESC, relationship_id DESC) AS rn FROM omrs_relationship
  WHERE {_in('related_person_role', 'Community Health Worker')}) WHERE rn = 1)""")
    + """SELECT p.patient_id, identifier, first_name, CAST(NULL AS VARCHAR) AS last_name, gender, birthdate, CAST(NULL AS BOOLEAN) AS birthdate_estimated,
  CAST(NULL AS VARCHAR) AS phone_number, state_province AS district, CAST(NULL AS VARCHAR) AS traditional_authority, CAST(NULL AS VARCHAR) AS village,
  related_person AS chw, dead, death_date, patient_uuid FROM omrs_patient p LEFT JOIN chw USING (patient_id)""",
    "m_ncd_diagnoses": _with(("omrs_obs",), f"""dd AS (SELECT patient_id, obs_group_id, min(value_date) AS d FROM omrs_obs WHERE {_in('concept', 'Diagnosis date')}
  GROUP BY patient_id, obs_group_id)""") + f"""SELECT o.patient_id, o.value_coded AS diagnosis, min(coalesce(dd.d, o.obs_date)) AS diagnosis_date
  FROM omrs_obs o LEFT JOIN dd ON dd.patient_id = o.patient_id AND dd.obs_group_id IS NOT DISTINCT FROM o.obs_group_id
  WHERE {_in('o.concept', 'Chronic care diagnosis')} AND o.value_coded IS NOT NULL GROUP BY o.patient_id, o.value_coded""",
    "m_art_regimen": _with(("omrs_obs",), _REGIMENS) + "SELECT * FROM reg",
    "m_second_regimen": _with(("omrs_obs",), _REGIMENS) + """SELECT patient_id, regimen, regimen_init_date FROM (SELECT *, row_number() OVER (PARTITION BY patient_id
  ORDER BY regimen_init_date DESC, line DESC, regimen NULLS LAST) AS rn FROM reg WHERE regimen_init_date IS NOT NULL) WHERE rn = 2""",
    "m_art_register": _with((*_EPISODE, "mw_art_visits", "mw_lab_tests"), _episodes("HIV program", "Treatment status", "On antiretrovirals"), _number("ARV Number"), _VLS,
                            _latest("lv", "mw_art_visits", "patient_id", "visit_date DESC, art_visit_id DESC"),
                            _latest("lt", "mvl", "patient_id", "d DESC, lab_test_id DESC"), _latest("lr", "mvr", "patient_id", "d DESC, lab_test_id DESC"))
    + f"""SELECT eps.program_enrollment_id AS enrollment_id, eps.patient_id, eps.location, num.number AS art_number, eps.start_date, eps.end_date, eps.outcome,
  lv.art_visit_id AS last_art_visit_id, lt.lab_test_id AS last_viral_load_test_id, lr.lab_test_id AS last_viral_load_result_id
  FROM eps {_AT.format(a='eps')} LEFT JOIN lv ON lv.patient_id = eps.patient_id LEFT JOIN lt ON lt.patient_id = eps.patient_id LEFT JOIN lr ON lr.patient_id = eps.patient_id""",
    "m_pre_art_register": _with(_EPISODE, _episodes("HIV program", "Treatment status", "Pre-ART (Continue)"), _number("HCC Number"))
    + f"""SELECT eps.program_enrollment_id AS enrollment_id, eps.patient_id, eps.location, num.number AS pre_art_number, eps.start_date, eps.end_date, eps.outcome
  FROM eps {_AT.format(a='eps')}""",
    "m_eid_register": _with((*_EPISODE, "omrs_obs", "mw_eid_visits"), _episodes("HIV program", "Treatment status", "Exposed child (continue)"), _number("Exposed Infant Number"),
                            _latest("lv", "mw_eid_visits", "patient_id", "visit_date DESC, eid_visit_id DESC"),
                            f"""mom AS (SELECT patient_id, string_agg(value_text, ',' ORDER BY value_text) AS t FROM omrs_obs
  WHERE {_in('concept', 'Mother ART registration number')} AND value_text IS NOT NULL GROUP BY patient_id)""")
    + f"""SELECT eps.program_enrollment_id AS enrollment_id, eps.patient_id, eps.location, num.number AS eid_number, mom.t AS mother_art_number, eps.start_date, eps.end_date,
  eps.outcome, lv.eid_visit_id AS last_eid_visit_id FROM eps {_AT.format(a='eps')} LEFT JOIN mom ON mom.patient_id = eps.patient_id LEFT JOIN lv ON lv.patient_id = eps.patient_id""",
    "m_ncd_register": _with((*_EPISODE, "omrs_obs"), _number("Chronic Care Number"), f"st AS (SELECT * FROM omrs_program_state WHERE {_in('program', 'Chronic care program')} "
                            f"AND {_in('workflow', 'Chronic care treatment status')})", _latest("ls", "st", "program_enrollment_id", "start_date DESC, program_state_id DESC"),
                            f"cv AS (SELECT DISTINCT patient_id FROM omrs_obs WHERE {_in('value_coded', 'Cardiovascular disease')})")
    + f"""SELECT e.program_enrollment_id AS enrollment_id, e.patient_id, e.location, num.number AS ncd_number, e.enrollment_date AS start_date, e.completion_date AS end_date,
  CASE WHEN e.completion_date IS NOT NULL THEN coalesce(ls.state, e.outcome) END AS outcome, cv.patient_id IS NOT NULL AS cv_disease
  FROM omrs_program_enrollment e {_AT.format(a='e')} LEFT JOIN ls ON ls.program_enrollment_id = e.program_enrollment_id LEFT JOIN cv ON cv.patient_id = e.patient_id
  WHERE {_in('e.program', 'Chronic care program')}""",
    "m_last_obs": _with(("omrs_obs",), QUARTERS, f"""o AS MATERIALIZED (SELECT *, greatest(CAST(date_trunc('quarter', obs_date) + to_months(3) AS DATE) - 1,
  (SELECT min(end_date) FROM q)) AS own FROM omrs_obs WHERE {_in('concept', ('HIV viral load', 'Weight (kg)'))})""",
                        "l AS (SELECT patient_id, concept, own, max(obs_date) AS last FROM o GROUP BY patient_id, concept, own)",
                        "n AS (SELECT *, lead(own) OVER (PARTITION BY patient_id, concept ORDER BY own) AS nxt FROM l)")
    + """SELECT o.patient_id, o.concept, q.end_date, o.obs_date AS last_obs_date, o.encounter_type, o.location, o.value_coded, o.value_date, o.value_numeric, o.value_text,
  o.obs_group_id FROM n JOIN o ON o.patient_id = n.patient_id AND o.concept = n.concept AND o.own = n.own AND o.obs_date = n.last
  JOIN q ON q.end_date >= n.own AND (n.nxt IS NULL OR q.end_date < n.nxt)""",
    "m_recent_lab": _with(("mw_art_register", "mw_lab_tests"), QUARTERS, """l AS (SELECT *, coalesce(date_collected, date_result_received, date_result_entered) AS d FROM mw_lab_tests)""")
    + """SELECT lab_test_id, patient_id, encounter_id, date_collected, test_type, date_result_received, date_result_entered, result_coded, result_numeric, result_exception, end_date
  FROM (SELECT c.patient_id, q.end_date, l.* EXCLUDE (patient_id), row_number() OVER (PARTITION BY c.patient_id, q.end_date ORDER BY l.d DESC NULLS LAST, l.lab_test_id) AS rn
    FROM (SELECT DISTINCT patient_id FROM mw_art_register) c CROSS JOIN q LEFT JOIN l ON l.patient_id = c.patient_id AND l.d <= q.end_date) WHERE rn = 1""",
    "m_art_trace": _with(("mw_art_register", "mw_art_visits", "mw_lab_tests"), _VLS, _latest("lv", "mw_art_visits", "patient_id", "visit_date DESC, art_visit_id DESC"),
                         _latest("lr", "mvr", "patient_id", "d DESC, lab_test_id DESC"))
    + """SELECT r.*, lv.visit_date AS last_visit_date, lv.next_appointment_date AS last_appt_date, lr.d AS last_vl_date, lr.result_numeric AS last_vl_numeric,
  lr.result_exception AS last_vl_exception FROM mw_art_register r LEFT JOIN lv USING (patient_id) LEFT JOIN lr USING (patient_id) WHERE r.end_date IS NULL""",
    "m_eid_trace": _with(("mw_eid_register", "mw_eid_visits", "mw_lab_tests"), _latest("lv", "mw_eid_visits", "patient_id", "visit_date DESC, eid_visit_id DESC"),
                         f"bf AS (SELECT patient_id, visit_date, {_in('breastfeeding_status', 'No')} AS no FROM mw_eid_visits WHERE breastfeeding_status IS NOT NULL)",
                         """st AS (SELECT bf.patient_id, min(visit_date) AS date_stopped_bf FROM bf LEFT JOIN (SELECT patient_id, max(visit_date) AS d FROM bf WHERE NOT no
  GROUP BY patient_id) o USING (patient_id) WHERE no AND (o.d IS NULL OR visit_date >= o.d) GROUP BY bf.patient_id)""",
                         f"ht AS (SELECT * FROM mw_lab_tests WHERE {_in('test_type', 'HIV test')} AND date_collected IS NOT NULL)",
                         _latest("t1", "ht", "patient_id", "date_collected DESC, lab_test_id DESC"), _latest("t2", "ht", "patient_id", "date_collected DESC, lab_test_id DESC", 2))
    + """SELECT r.*, lv.visit_date AS last_visit_date, lv.next_appointment_date AS last_appt_date, st.date_stopped_bf, t1.result_coded AS last_test_result,
  t2.result_coded AS previous_test_result, t1.date_collected AS last_test_date, t2.date_collected AS previous_test_date FROM mw_eid_register r
  LEFT JOIN lv USING (patient_id) LEFT JOIN st USING (patient_id) LEFT JOIN t1 USING (patient_id) LEFT JOIN t2 USING (patient_id) WHERE r.end_date IS NULL""",
}


# ---------------------------------------------------------------- star schema

def _name_dim(name: str, key: str, of: str) -> str:
    return f"""{name} AS (SELECT row_number() OVER (ORDER BY name) AS {key}, name FROM (SELECT min(name) AS name FROM ({of}) WHERE name IS NOT NULL GROUP BY lower(trim(name))))"""


_FLAT5 = ("omrs_patient", "omrs_encounter", "omrs_obs", "omrs_program_enrollment", "omrs_program_state")
_DATES = "dim_date AS (SELECT row_number() OVER (ORDER BY full_date NULLS FIRST) AS date_id, full_date FROM (" + " UNION ".join(
    f"SELECT {c} AS full_date FROM {t}" for t, c in (("omrs_patient", "birthdate"), ("omrs_patient", "death_date"), ("omrs_program_enrollment", "enrollment_date"),
                                                     ("omrs_program_enrollment", "completion_date"), ("omrs_program_state", "start_date"), ("omrs_program_state", "end_date"),
                                                     ("omrs_encounter", "encounter_date"), ("omrs_obs", "obs_date"), ("omrs_obs", "value_date"))) + "))"
_TIMES = "dim_time AS (SELECT row_number() OVER (ORDER BY t NULLS FIRST) AS time_id, t FROM (SELECT encounter_time AS t FROM omrs_encounter UNION SELECT obs_time FROM omrs_obs))"
_AGES = """dim_age AS (SELECT row_number() OVER (ORDER BY y NULLS FIRST, m) AS age_id, y, m FROM (SELECT age_years_at_encounter AS y, age_months_at_encounter AS m FROM omrs_encounter
  WHERE age_months_at_encounter IS NOT NULL UNION SELECT age_years_at_obs, age_months_at_obs FROM omrs_obs WHERE age_months_at_obs IS NOT NULL))"""
_NAMES = {"dim_coded_question": ("coded_question_id", "SELECT concept AS name FROM omrs_obs WHERE value_coded IS NOT NULL"),
          "dim_coded_value": ("coded_value_id", "SELECT value_coded AS name FROM omrs_obs WHERE value_coded IS NOT NULL"),
          "dim_date_question": ("date_question_id", "SELECT concept AS name FROM omrs_obs WHERE value_date IS NOT NULL"),
          "dim_location": ("location_id", "SELECT location AS name FROM omrs_encounter"),
          "dim_encounter_type": ("encounter_type_id", "SELECT encounter_type AS name FROM omrs_encounter")}


def _value_fact(question: str, key: str, value_col: str, value_dim: str | None, extra: str) -> str:
    names = [question, "dim_location", "dim_encounter_type", *([value_dim] if value_dim else [])]
    ctes = [_DATES, _TIMES, _AGES, *[_name_dim(n, *_NAMES[n]) for n in names]]
    by = lambda d, c, how="LEFT": f"{how} JOIN {d} ON lower(trim({d}.name)) = lower(trim(o.{c}))"
    return _with(_FLAT5, *ctes) + f"""SELECT o.patient_id, CAST(CASE lower(trim(p.gender)) WHEN 'm' THEN 1 WHEN 'f' THEN 2 END AS BIGINT) AS gender_id, a.age_id, d.date_id,
  t.time_id, dim_location.location_id, CAST(NULL AS BIGINT) AS program_id, dim_encounter_type.encounter_type_id, {question}.{key}, {extra}
  FROM omrs_obs o JOIN omrs_patient p USING (patient_id) LEFT JOIN dim_age a ON a.y = o.age_years_at_obs AND a.m = o.age_months_at_obs
  LEFT JOIN dim_date d ON d.full_date = o.obs_date LEFT JOIN dim_time t ON t.t = o.obs_time {by('dim_location', 'location')} {by('dim_encounter_type', 'encounter_type')}
  {by(question, 'concept', '')} {by(value_dim, value_col, '') if value_dim else ''} WHERE o.{value_col} IS NOT NULL"""


SQL |= {f"star_{n}": _with(("omrs_obs",), _name_dim(n, *_NAMES[n])) + f"SELECT {_NAMES[n][0]}, name FROM {n}"
        for n in ("dim_coded_question", "dim_coded_value", "dim_date_question")}
SQL |= {
    "star_fact_patient_coded_value": _value_fact("dim_coded_question", "coded_question_id", "value_coded", "dim_coded_value", "dim_coded_value.coded_value_id"),
    "star_fact_patient_date_value": _value_fact("dim_date_question", "date_question_id", "value_date", None, "o.value_date AS date_value"),
    "star_dim_patient": _with(_FLAT5, _DATES) + """SELECT patient_id, patient_uuid, gender, birthdate, b.date_id AS birthdate_id, dead, death_date, d.date_id AS death_date_id
  FROM omrs_patient LEFT JOIN dim_date b ON b.full_date = birthdate LEFT JOIN dim_date d ON d.full_date = death_date""",
    "r_onc_diagnosis": _with(("omrs_program_state",)) + f"""SELECT s.program_state_id, s.program_enrollment_id, s.patient_id, s.state, s.start_date, l.s AS diagnosis_status,
  l.d AS diagnosis_status_start_date, CAST(s.start_date - l.d AS DOUBLE) AS start_date_difference, CAST(s.end_date - l.e AS DOUBLE) AS end_date_difference
  FROM (SELECT *, (SELECT max({{'d': n.start_date, 'i': n.program_state_id, 's': n.state, 'e': n.end_date}}) FROM omrs_program_state n
    WHERE n.program_enrollment_id = x.program_enrollment_id AND {_in('n.program', 'Oncology')} AND {_in('n.workflow', 'Diagnosis Status')} AND n.start_date <= x.start_date) AS l
    FROM omrs_program_state x WHERE {_in('x.program', 'Oncology')} AND {_in('x.workflow', 'Diagnosis')}) s""",
    "r_pdc_program": _with(("omrs_program_enrollment", "omrs_encounter", "omrs_obs"), f"f AS (SELECT * FROM omrs_encounter WHERE {_in('form', 'PDC malnutrition Acute form')})",
                           _latest("e", "f", "patient_id", "encounter_date, encounter_id"),
                           f"c AS (SELECT patient_id, min(obs_date) AS d FROM omrs_obs WHERE {_in('concept', 'Cured (malnutrition)')} GROUP BY patient_id)")
    + """SELECT program_enrollment_id, uuid, patient_id, program, enrollment_date, CAST(NULL AS BIGINT) AS age_years_at_enrollment, CAST(NULL AS BIGINT) AS age_months_at_enrollment,
  location, completion_date, CAST(NULL AS BIGINT) AS age_years_at_completion, CAST(NULL AS BIGINT) AS age_months_at_completion, outcome FROM omrs_program_enrollment
UNION ALL SELECT 9989999 + row_number() OVER (ORDER BY e.patient_id), 'derived-pdc-malnutrition-' || CAST(e.patient_id AS VARCHAR), e.patient_id, 'PDC malnutrition', e.encounter_date,
  e.age_years_at_encounter, e.age_months_at_encounter, e.location, c.d, NULL, NULL, NULL FROM e LEFT JOIN c USING (patient_id)""",
    "r_pdc_zscore_input": _with(("omrs_program_enrollment", "omrs_patient", "omrs_obs"), f"""k AS (SELECT patient_id, obs_date,
  {_first(_in('concept', 'WEIGHT (KG)') + ' AND value_numeric IS NOT NULL', 'value_numeric')} AS weight,
  {_first(_in('concept', 'HEIGHT (CM)') + ' AND value_numeric IS NOT NULL', 'value_numeric')} AS h FROM omrs_obs
  WHERE patient_id IN (SELECT patient_id FROM omrs_program_enrollment WHERE {_in('program', 'PDC PROGRAM')}) GROUP BY patient_id, obs_date)""")
    + """SELECT k.patient_id, strftime(obs_date, '%Y-%m-%d') AS obs_date, 0 AS oedema, 'l' AS lh, weight, CAST(round(h) AS INTEGER) AS clenhei,
  CASE lower(trim(gender)) WHEN 'm' THEN 1 WHEN 'f' THEN 2 END AS sex, CAST(obs_date - birthdate AS INTEGER) AS agedays
  FROM k LEFT JOIN omrs_patient p USING (patient_id) WHERE weight IS NOT NULL AND h IS NOT NULL""",
}
