import datetime as dt

from hearth.plans import liberia as LB
from hearth.schemas import LIBERIA_SOURCE, SOURCE, struct

T = dt.datetime
D = dt.date


def _src(spark):
    schemas = {**SOURCE, **LIBERIA_SOURCE}
    names = {1: "Role of referring person q", 2: "Teacher", 3: "PHQ-9 score", 4: "Prescription construct",
             5: "Medication orders", 6: "Fluoxetine", 7: "Medication duration", 8: "Patient died",
             9: "Mental health program", 10: "Patient pregnant q", 11: "Yes"}
    rows = {
        "concept_name": [(i, i, n, "en", True, "FULLY_SPECIFIED", False, None) for i, n in names.items()]
                        + [(100, 2, "Enseignant", "fr", True, "FULLY_SPECIFIED", False, None)],
        "concept_reference_source": [(1, "PIH"), (2, "CIEL")],
        "concept_reference_term": [(1, "Role of referring person", 1), (2, "165137", 2), (3, "PATIENT PREGNANT", 1)],
        "concept_reference_map": [(1, 1), (3, 2), (10, 3)],
        "encounter_type_uuid": [(7, "Mental health", LB.MH_ENCOUNTER_TYPE_UUID), (8, "Other", "x")],
        "encounter_type": [(7, "Mental health"), (8, "Other")],
        "encounter": [(1, "e1", 50, 7, None, 1, 9, T(2020, 1, 1), 1, False, T(2020, 1, 1)),
                      (2, "e2", 51, 8, None, 1, None, T(2020, 1, 2), 1, False, T(2020, 1, 2))],
        "obs": [(1, "o1", 50, 1, 1, T(2020, 1, 1), None, 2, None, None, None, None, None, False, T(2020, 1, 1)),
                (2, "o2", 50, 1, 3, T(2020, 1, 1), None, None, None, 14.0, None, None, None, False, T(2020, 1, 1)),
                (3, "o3", 50, 1, 10, T(2020, 1, 1), None, 11, None, None, None, None, None, False, T(2020, 1, 1)),
                (4, "o4", 50, 1, 4, T(2020, 1, 1), None, None, None, None, None, None, None, False, T(2020, 1, 1)),
                (5, "o5", 50, 1, 5, T(2020, 1, 1), 4, 6, None, None, None, None, None, False, T(2020, 1, 1)),
                (6, "o6", 50, 1, 7, T(2020, 1, 1), 4, None, None, 30.0, None, None, None, False, T(2020, 1, 1)),
                (7, "o7", 51, 2, 1, T(2020, 1, 2), None, 2, None, None, None, None, None, False, T(2020, 1, 2))],
        "program": [(1, 9, "Mental health program"), (2, 9, "Empty program")],
        "patient_program": [(1, "pp1", 50, 1, D(2020, 1, 1), D(2020, 6, 1), 1, 8, False),
                            (2, "pp2", 51, 1, D(2020, 2, 1), None, None, None, True)],
        "location": [(1, "Harper")],
    }
    return {k: spark.createDataFrame(v, struct(schemas[k])) for k, v in rows.items()}


def test_mh_encounter(spark):
    out = LB.mh_encounter(_src(spark)).collect()
    assert len(out) == 1
    r = out[0]
    assert r["encounter_id"] == 1 and r["referred_by_teacher"] is True and r["referred_by_self"] is None
    assert r["phq_9"] == 14.0 and r["pregnant"] is True


def test_rx_and_programs(spark):
    src = _src(spark)
    rx = LB.rx_prescriptions(src).collect()
    assert [(r["obs_group_id"], r["rx_medication"], r["rx_medication_duration"], r["encounter_type"]) for r in rx] == [
        (4, "Fluoxetine", 30.0, "Mental health")]
    st = {r["name"]: r for r in LB.program_statistics(src).collect()}
    assert (st["Mental health program"]["ever_enrolled"], st["Mental health program"]["dead"]) == (2, 1)
    assert st["Empty program"]["ever_enrolled"] == 0
    pe = {r["program_enrollment_id"]: r for r in LB.program_enrollment(src).collect()}
    assert pe[1]["outcome_concept_name"] == "Patient died" and pe[1]["location_name"] == "Harper"
    assert pe[2]["voided"] is True
