import datetime as dt

import pytest

from hearth.plans import reports as R
from hearth.plans.flat import build_flat
from hearth.plans.malawi import build_malawi

from .emr_fixture import build

D = dt.date
END = "2019-12-31"
NENO = "Neno District Hospital"


@pytest.fixture(scope="module")
def env(spark):
    flat = {k: v.cache() for k, v in build_flat(build(spark)).items()}
    return flat, {k: v.cache() for k, v in build_malawi(spark, flat).items()}


def test_active_art(env):
    _, m = env
    rows = {r["patient_id"]: r for r in R.active_art(m, END, NENO).collect()}
    assert set(rows) == {1, 10}
    assert rows[1]["last_visit_date"] == D(2019, 6, 30) and rows[1]["last_appt_date"] == D(2019, 9, 30)
    assert rows[1]["days_late_appt"] == 92 and rows[1]["days_to_next_appt"] is None
    assert rows[10]["last_visit_days"] == 0 and rows[10]["days_to_next_appt"] == 31
    for r in rows.values():
        assert r["days_late_appt"] is None or r["days_to_next_appt"] is None


def test_trace_and_priority(env):
    flat, m = env
    tc = {(r["patient_id"], r["criteria"]) for r in R.trace_criteria(m, END, NENO, min_wks=2).collect()}
    assert (1, "LATE_ART") in tc and (10, "LATE_ART") not in tc
    assert not any(c == "HIGH_VIRAL_LOAD" for _, c in tc)
    pri = {(r["patient_id"], r["priority"]) for r in R.priority_patients(m, END).collect()}
    assert {(1, "HIV"), (2, "HIV"), (1, "BP > 180/110"), (8, "ON INSULIN")} <= pri
    assert (8, "BP > 180/110") not in pri
    six = R.trace_criteria(m, END, NENO, min_wks=6).collect()
    assert {r["criteria"] for r in six} <= {"LATE_ART", "LATE_EID", "HIGH_VIRAL_LOAD", "EID_POSITIVE_6_WK", "LATE_NCD"}


def test_alerts(env):
    flat, m = env
    al = {(r["patient_id"], r["alert"]) for r in R.appt_alerts(m, END, NENO, obs=flat["omrs_obs"]).collect()}
    # patient 1 started ART 2018-01-10 (720 days before the end): 720 % 730 >= 90, no routine VL due
    assert (1, "Due for routine VL") not in al
    # 1471 days after the start (11 days past the 4-year mark), last sample 2020-02-02: due;
    # patient 10 has never been tested and started 751 days before: due
    al2 = {(r["patient_id"], r["alert"]) for r in R.appt_alerts(m, "2022-01-20", NENO, obs=flat["omrs_obs"]).collect()}
    assert {(1, "Due for routine VL"), (10, "Due for routine VL")} <= al2


def test_appointments_and_identifiers(env):
    flat, m = env
    nxt = {r["patient_id"]: (r["last_visit_date"], r["last_appt_date"])
           for r in R.patients_next_appointment(m, NENO).collect()}
    assert nxt[1] == (D(2019, 6, 30), D(2019, 9, 30)) and nxt[5] == (D(2018, 5, 1), D(2018, 6, 1))
    assert nxt[8] == (D(2019, 1, 5), D(2019, 2, 5)) and nxt[10] == (D(2019, 12, 31), D(2020, 1, 31))
    exp = [r["patient_id"] for r in R.patients_expected(m, "2019-09-01", END, NENO).collect()]
    assert exp == [1]
    ids = {r["patient_id"]: r for r in R.rpt_identifiers(m, flat, NENO).collect()}
    assert ids[1]["art_number"] == "NNO-12345" and ids[1]["all_art_numbers"] == "NNO-12345"
    assert ids[2]["art_number"] is None and ids[2]["all_art_numbers"] == "NNO-012A"
    assert ids[8]["ncd_number"] == "NNO-CCC-0007"


def test_ic3(env):
    flat, m = env
    rows = {r["patient_id"]: r for r in R.ic3_data(m, flat, END).collect()}
    assert set(rows) == {1, 2, 5, 8}        # 10's ARV number has no location, so no number on the register
    p1 = rows[1]
    assert p1["artStartDate"] == D(2018, 1, 10) and p1["currentHivState"] == "On antiretrovirals"
    assert p1["lastArtVisit"] == D(2019, 6, 30) and p1["nextArtAppt"] == D(2019, 9, 30)
    assert p1["lastArtRegimen"] == "Tuberculosis"          # latest regimen recorded before the end date
    assert p1["lastViralLoadTest"] == D(2019, 10, 2)
    assert p1["latestAppt"] == D(2019, 9, 30) and p1["lastIc3Visit"] == D(2019, 6, 30)
    assert rows[8]["cvDisease"] is None and rows[8]["lastNcdVisit"] == D(2019, 1, 5)
    assert rows[2]["currentHivState"] == "Patient died"
