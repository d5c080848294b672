"""A hand-made EMR source of ~10 patients covering the edge cases listed in
FIXTURES.md §2 (voided rows, null birthdate, test patient, preferred names,
obs groups, obs without encounter, coded-by-drug answers, open enrollments,
consecutive states sharing a start date, identifiers needing formatting,
two providers on one encounter, viral loads of every kind, 29 February)."""

from __future__ import annotations

import datetime as dt

from hearth.schemas import SOURCE, struct

D = dt.date
T = dt.datetime

# concept id -> name (all fully specified, English)
CONCEPTS = {
    1: "HIV program", 2: "Chronic care program", 3: "Treatment status", 4: "On antiretrovirals",
    5: "Patient died", 6: "Patient transferred out", 7: "Pre-ART (continue)", 8: "Weight (kg)",
    9: "Appointment date", 10: "HIV viral load", 11: "Lower than Detection Limit", 12: "Sample taken for Viral Load",
    13: "Malawi Antiretroviral drugs received", 14: "Result of HIV test", 15: "Positive", 16: "Negative",
    17: "Systolic blood pressure", 18: "Diastolic blood pressure", 19: "Viral Load Screening construct",
    20: "Tuberculosis", 21: "True", 22: "Reason for testing (coded)", 23: "Routine", 24: "Chronic care diagnosis",
    25: "Hypertension", 26: "Diagnosis date", 27: "Less than limit", 28: "HIV Test Construct",
    29: "Insulin", 30: "Current drugs used", 31: "Exposed child (continue)", 32: "Chronic care treatment status",
    33: "Mother HIV Status", 34: "Breast feeding", 35: "Reason for no result", 36: "EID program",
    37: "Location of laboratory", 38: "Viral Load Sample ID", 39: "Patient transferred in",
}
# a second, non-preferred name that must not win
EXTRA_NAMES = [(1001, 1, "Programme VIH", "fr", True, "FULLY_SPECIFIED"),
               (1002, 8, "Weight", "en", True, "SHORT")]


def build(spark) -> dict:
    rows: dict[str, list] = {k: [] for k in SOURCE}
    created = T(2015, 1, 1)

    rows["concept"] = [(cid,) for cid in CONCEPTS]
    rows["concept_name"] = [(cid, cid, name, "en", False, "FULLY_SPECIFIED", False, created)
                            for cid, name in CONCEPTS.items()]
    rows["concept_name"] += [(i, c, n, loc, pref, typ, False, created) for i, c, n, loc, pref, typ in EXTRA_NAMES]
    rows["location"] = [(1, "Neno District Hospital"), (2, "Lisungwi Health Center"), (3, "Matandani")]
    rows["drug"] = [(1, "TDF/3TC/EFV"), (2, "Insulin lente")]
    rows["form"] = [(1, "ART form")]
    rows["encounter_type"] = [(1, "ART_INITIAL"), (2, "ART_FOLLOWUP"), (3, "Viral Load Screening"),
                              (4, "CHRONIC_CARE_FOLLOWUP"), (5, "EXPOSED_CHILD_FOLLOWUP"), (6, "PART_FOLLOWUP")]
    rows["encounter_role"] = [(1, "Clinician"), (2, "Nurse")]
    rows["visit_type"] = [(1, "Outpatient")]
    rows["patient_identifier_type"] = [(1, "ARV Number"), (2, "Chronic Care Number"), (3, "Exposed Infant Number")]
    rows["users"] = [(1, "admin", "1-1", None), (2, None, "2-2", None)]
    rows["person_attribute_type"] = [(1, "Cell Phone Number", None), (2, "Mother's Name", None),
                                     (3, "Health Center", "Location"), (4, "Test Patient", None)]
    rows["relationship_type"] = [(1, "Parent", "Child"), (2, "Guardian", None)]
    rows["program"] = [(1, 1, "HIV program"), (2, 2, "Chronic care program"), (3, 36, "EID program")]
    rows["program_workflow"] = [(1, 3), (2, 32), (3, 3)]
    rows["program_workflow_state"] = [(1, 1, 4), (2, 1, 5), (3, 1, 6), (4, 1, 7), (5, 2, 4), (6, 3, 31),
                                      (7, 1, 39)]

    # persons 1..12 ; patients 1..10 ; 11, 12 are non-patient persons (mother, provider)
    persons = [
        (1, "uuid-p1", "M", D(1980, 2, 29), False, False, None, None, False),
        (2, "uuid-p2", "F", D(1990, 5, 10), False, True, D(2019, 6, 1), 20, False),   # dead
        (3, "uuid-p3", "F", None, None, False, None, None, False),                     # null birthdate
        (4, "uuid-p4", "M", D(1975, 1, 1), False, False, None, None, True),            # voided person
        (5, "uuid-p5", "f", D(2018, 3, 15), True, False, None, None, False),           # child
        (6, "uuid-p6", "M", D(1960, 7, 7), False, False, None, None, False),           # test patient
        (7, "uuid-p7", "F", D(1985, 12, 31), False, False, None, None, False),         # test flag null
        (8, "uuid-p8", "M", D(1970, 6, 15), False, False, None, None, False),
        (9, "uuid-p9", "F", D(1995, 9, 9), False, False, None, None, False),           # no name
        (10, "uuid-p10", "M", D(2000, 1, 1), False, False, None, None, False),
        (11, "uuid-p11", "F", D(1988, 4, 4), False, False, None, None, False),         # mother, not a patient
        (12, "uuid-p12", "M", D(1970, 1, 1), False, False, None, None, False),         # provider person
    ]
    rows["person"] = [p + (created,) for p in persons]
    rows["patient"] = [(i, False, created) for i in range(1, 11)]
    rows["person_name"] = [
        (1, 1, "John", None, None, "Banda", None, None, False, False, T(2015, 1, 1)),
        (2, 1, "Johnny", "K", "van", "Banda", "Phiri", None, True, False, T(2014, 1, 1)),   # preferred wins
        (3, 2, "Mary", None, None, "Tembo", None, None, True, False, T(2015, 1, 1)),
        (4, 2, "Maria", None, None, "Tembo", None, None, True, False, T(2016, 1, 1)),       # newer preferred
        (5, 3, "Grace", None, None, "Mbewe", None, None, False, False, T(2015, 1, 1)),
        (6, 5, "Baby", None, None, "Mbewe", None, None, False, False, T(2018, 3, 20)),
        (7, 6, "Test", None, None, "Patient", None, None, False, False, T(2015, 1, 1)),
        (8, 7, "Ruth", None, None, "Zulu", None, None, False, False, T(2015, 1, 1)),
        (9, 8, "Peter", None, None, "Moyo", None, None, False, False, T(2015, 1, 1)),
        (10, 10, "Sam", None, None, "Phiri", None, None, False, False, T(2015, 1, 1)),
        (11, 11, "Alice", None, None, "Mbewe", None, None, False, False, T(2015, 1, 1)),
        (12, 12, "Doctor", None, None, "Who", None, None, False, False, T(2015, 1, 1)),
        (13, 8, "Voided", None, None, "Name", None, None, True, True, T(2020, 1, 1)),
    ]
    rows["person_address"] = [
        (1, 1, "Malawi", None, "Southern", "Neno", "Chifunga", None, None, None, None, None, None, None, None,
         True, False, created),
        (2, 1, "Malawi", None, "Central", "Lilongwe", "Area 25", None, None, None, None, None, None, None, None,
         False, False, T(2020, 1, 1)),
    ]
    rows["person_attribute"] = [
        (1, 1, 1, "0999111222", False, T(2015, 1, 1)), (2, 1, 1, "0888333444", False, T(2017, 1, 1)),  # two phones
        (3, 5, 2, "Alice Mbewe", False, created), (4, 1, 3, "2", False, created),
        (5, 6, 4, "true", False, created), (6, 7, 4, None, False, created), (7, 8, 4, "false", False, created),
    ]
    rows["patient_identifier"] = [
        (1, "pi-1", 1, "NNO 12", 1, 1, True, False, T(2015, 1, 1)),
        (2, "pi-2", 1, "NNO 12345", 1, 1, False, False, T(2016, 1, 1)),   # two of one type at one location
        (3, "pi-3", 2, "NNO 12A", 1, 2, True, False, created),
        (4, "pi-4", 8, "NNO CCC 7", 2, 1, True, False, created),
        (5, "pi-5", 5, "NNO EID 3", 3, 1, True, False, created),
        (6, "pi-6", 3, "", 1, 1, True, False, created),                   # blank identifier
        (7, "pi-7", 10, "NNO 99", 1, None, True, False, created),          # null location
    ]
    rows["relationship"] = [
        (1, "rel-1", 11, 5, 1, D(2018, 3, 15), None, False, created),     # mother (non-patient) -> child
        (2, "rel-2", 2, 3, 2, None, None, False, created),                # both sides patients
        (3, "rel-3", 4, 1, 1, None, None, False, created),                # voided person side
    ]
    rows["provider"] = [(1, "prov-1", 12, None, "P001"), (2, "prov-2", None, "Nurse Joy", "P002"),
                        (3, "prov-3", None, None, "P003")]

    enc = []
    obs = []
    eid = [0]
    oid = [0]

    def e(pid, etype, when, loc, visit=None, voided=False):
        eid[0] += 1
        enc.append((eid[0], f"enc-{eid[0]}", pid, etype, 1, loc, visit, when, 1, voided, when))
        return eid[0]

    def o(pid, e_id, cid, when, coded=None, drug=None, num=None, date=None, text=None, group=None, voided=False):
        oid[0] += 1
        obs.append((oid[0], f"obs-{oid[0]}", pid, e_id, cid, when, group, coded, drug, num, date, text, None,
                    voided, when))
        return oid[0]

    # patient 1: ART initial + followups, appointments, viral loads
    t1 = T(2018, 1, 10, 9, 30)
    e1 = e(1, 1, t1, 1, visit=1)
    o(1, e1, 8, t1, num=60.0)
    o(1, e1, 9, t1, date=T(2018, 2, 10))
    o(1, e1, 13, t1, drug=1)                                                   # coded by drug
    t2 = T(2018, 2, 10, 10, 0)
    e2 = e(1, 2, t2, 1)
    o(1, e2, 8, t2, num=61.5)
    o(1, e2, 9, t2, date=T(2018, 5, 10))
    o(1, e2, 13, t2, coded=20)                                                  # coded by concept
    t3 = T(2018, 4, 1, 8, 0)
    e3 = e(1, 3, t3, 1)
    g1 = o(1, e3, 19, t3)                                                        # group header
    o(1, e3, 12, t3, coded=21, group=g1)
    o(1, e3, 10, t3, num=1500.0, group=g1)                                       # detected
    o(1, e3, 22, t3, coded=23, group=g1)
    t4 = T(2019, 4, 2, 8, 0)
    e4 = e(1, 3, t4, 1)
    g2 = o(1, e4, 19, t4)
    o(1, e4, 12, t4, coded=21, group=g2)
    o(1, e4, 11, t4, coded=21, group=g2)                                         # LDL flag
    t5 = T(2019, 10, 2, 8, 0)
    e5 = e(1, 3, t5, 1)
    g3 = o(1, e5, 19, t5)
    o(1, e5, 12, t5, coded=21, group=g3)
    o(1, e5, 27, t5, num=40.0, group=g3)                                         # below limit
    t5b = T(2020, 2, 2, 8, 0)
    e5b = e(1, 3, t5b, 1)
    g4 = o(1, e5b, 19, t5b)
    o(1, e5b, 12, t5b, coded=21, group=g4)                                       # sample without result
    # two encounters same patient/date/location, different types
    t6 = T(2019, 6, 30, 9, 0)
    e6a = e(1, 2, t6, 1)
    e6b = e(1, 4, t6, 1)
    o(1, e6a, 9, t6, date=T(2019, 9, 30))
    o(1, e6b, 17, t6, num=185.0)
    o(1, e6b, 18, t6, num=115.0)
    # voided encounter of a live person
    e(1, 2, T(2019, 8, 1), 1, voided=True)

    # patient 2: dead, HIV then transferred, HIV test with positive result
    t7 = T(2017, 3, 3, 11, 0)
    e7 = e(2, 1, t7, 2)
    g5 = o(2, e7, 28, t7)
    o(2, e7, 14, t7, coded=15, group=g5)
    o(2, e7, 9, t7, date=T(2017, 4, 3))
    # patient 3: null birthdate, followup with null location, obs without encounter
    t8 = T(2018, 7, 7, 7, 0)
    e8 = e(3, 2, t8, None)
    o(3, e8, 9, t8, date=T(2018, 8, 7))
    o(3, None, 8, T(2018, 7, 8), num=55.0)                                        # obs without encounter
    # patient 5: exposed child
    t9 = T(2018, 5, 1, 9, 0)
    e9 = e(5, 5, t9, 1)
    o(5, e9, 34, t9, coded=21)
    o(5, e9, 33, t9, coded=15)
    o(5, e9, 9, t9, date=T(2018, 6, 1))
    # patient 8: chronic care, hypertension, insulin
    t10 = T(2019, 1, 5, 9, 0)
    e10 = e(8, 4, t10, 1)
    o(8, e10, 17, t10, num=190.0)
    o(8, e10, 18, t10, num=100.0)
    g6 = o(8, e10, 24, t10)
    o(8, e10, 24, t10, coded=25, group=g6)
    o(8, e10, 26, t10, date=T(2018, 12, 1), group=g6)
    o(8, e10, 30, t10, coded=29)
    o(8, e10, 9, t10, date=T(2019, 2, 5))
    # patient 10: visit on the report end date
    t11 = T(2019, 12, 31, 9, 0)
    e11 = e(10, 2, t11, 1)
    o(10, e11, 9, t11, date=T(2020, 1, 31))
    # voided obs
    o(10, e11, 8, t11, num=99.0, voided=True)
    rows["encounter"] = enc
    rows["obs"] = obs
    rows["encounter_provider"] = [(1, "ep-1", 1, 2, 2, False), (2, "ep-2", 1, 1, 1, False), (3, "ep-3", 2, 3, 1, False),
                                  (4, "ep-4", 2, 1, 1, True)]
    rows["visit"] = [(1, "visit-1", 1, 1, 1, T(2018, 1, 10, 9), T(2018, 1, 10, 12), False, created),
                     (2, "visit-2", 3, 1, None, T(2018, 7, 7, 7), None, False, created)]

    rows["patient_program"] = [
        (1, "pp-1", 1, 1, D(2018, 1, 10), None, 1, None, False),              # HIV, open
        (2, "pp-2", 2, 1, D(2017, 3, 3), D(2019, 6, 1), 2, 5, False),         # HIV, completed (died)
        (3, "pp-3", 3, 1, None, None, 1, None, False),                        # no enrollment date
        (4, "pp-4", 8, 2, D(2019, 1, 5), None, 1, None, False),               # chronic care
        (5, "pp-5", 5, 1, D(2018, 5, 1), None, 1, None, False),               # exposed child in HIV program
        (6, "pp-6", 7, 1, D(2016, 1, 1), None, 2, None, False),               # HIV pre-ART only
        (7, "pp-7", 10, 1, D(2019, 12, 31), None, 1, None, False),
    ]
    rows["patient_state"] = [
        (1, "ps-1", 1, 1, D(2018, 1, 10), None, False),
        (2, "ps-2", 2, 4, D(2017, 3, 3), D(2017, 6, 1), False),
        (3, "ps-3", 2, 1, D(2017, 6, 1), D(2018, 1, 1), False),
        (4, "ps-4", 2, 3, D(2018, 1, 1), D(2019, 6, 1), False),               # three consecutive
        (5, "ps-5", 2, 2, D(2019, 6, 1), None, False),                        # shares start with completion
        (6, "ps-6", 4, 5, D(2019, 1, 5), None, False),
        (7, "ps-7", 5, 6, D(2018, 5, 1), None, False),
        (8, "ps-8", 6, 4, D(2016, 1, 1), None, False),
        (9, "ps-9", 7, 1, D(2019, 12, 31), None, False),
        (10, "ps-10", 1, 7, D(2018, 1, 10), D(2018, 1, 10), True),            # voided
    ]
    return {k: spark.createDataFrame(v, struct(SOURCE[k])) for k, v in rows.items()}
