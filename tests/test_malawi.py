import datetime as dt
from decimal import Decimal

import pytest

from hearth import operators as O
from hearth.plans.flat import build_flat
from hearth.plans.malawi import build_malawi, nth_regimen

from .emr_fixture import build

D = dt.date


@pytest.fixture(scope="module")
def mw(spark):
    flat = {k: v.cache() for k, v in build_flat(build(spark)).items()}
    periods = O.quarter_periods(spark, "2018-01-01", "2019-12-31")
    return flat, {k: v.cache() for k, v in build_malawi(spark, flat, periods).items()}


def test_visit_tables_one_row_per_visit(mw):
    _, m = mw
    for t, idc in [("mw_art_visits", "art_visit_id"), ("mw_eid_visits", "eid_visit_id"),
                   ("mw_ncd_visits", "ncd_visit_id")]:
        df = m[t]
        assert df.count() == df.select("patient_id", "visit_date", "location").distinct().count(), t
        assert df.select(idc).distinct().count() == df.count()
    art = {(r["patient_id"], r["visit_date"]): r for r in m["mw_art_visits"].collect()}
    assert art[(1, D(2018, 1, 10))]["art_drug_regimen"] == "TDF/3TC/EFV"
    assert art[(1, D(2018, 1, 10))]["next_appointment_date"] == D(2018, 2, 10)
    # the appointment is recorded on the ART followup, the BP on the chronic-care encounter of the same day
    assert art[(1, D(2019, 6, 30))]["next_appointment_date"] == D(2019, 9, 30)
    assert art[(3, D(2018, 7, 7))]["location"] is None          # null location kept as a visit key


def test_ncd_visits(mw):
    _, m = mw
    v = {r["patient_id"]: r for r in m["mw_ncd_visits"].where("patient_id = 8").collect()}[8]
    assert v["systolic_bp"] == 190.0 and v["on_insulin"] is True and v["cc_followup"] is True
    assert v["visit_types"] == "CHRONIC_CARE_FOLLOWUP" and v["next_appointment_date"] == D(2019, 2, 5)


def test_viral_load_form_grouped(mw):
    _, m = mw
    rows = m["mw_art_viral_load"].where("patient_id = 1").orderBy("visit_date").collect()
    assert [r["viral_load_result"] for r in rows] == [1500, None, None, None]
    assert [r["less_than_limit"] for r in rows] == [None, None, 40, None]
    assert rows[1]["ldl"] == "True" and rows[3]["bled"] == "True"


def test_labs(mw):
    _, m = mw
    labs = m["mw_lab_tests"].where("patient_id = 1 and test_type = 'Viral Load'").orderBy("date_collected").collect()
    assert [(r["result_numeric"], r["result_exception"]) for r in labs] == [
        (1500.0, None), (None, "Lower than Detection Limit"), (None, "<40"), (None, None)]
    hiv = m["mw_lab_tests"].where("test_type = 'HIV test'").collect()
    assert [(r["patient_id"], r["result_coded"], r["date_collected"]) for r in hiv] == [(2, "Positive", D(2017, 3, 3))]


def test_registers(mw):
    _, m = mw
    art = {(r["patient_id"], r["start_date"]): r for r in m["mw_art_register"].collect()}
    p1 = art[(1, D(2018, 1, 10))]
    assert p1["art_number"] == "NNO-12345" and p1["end_date"] is None and p1["outcome"] is None
    assert p1["last_art_visit_id"] is not None and p1["last_viral_load_result_id"] is not None
    p2 = art[(2, D(2017, 6, 1))]
    # the next state starting on the episode end is 'Patient transferred out'
    assert p2["end_date"] == D(2018, 1, 1) and p2["outcome"] == "Patient transferred out"
    assert p2["art_number"] == "NNO-012A"
    pre = m["mw_pre_art_register"].collect()
    assert {(r["patient_id"], r["outcome"]) for r in pre} == {(2, "On antiretrovirals"), (7, None)}
    ncd = m["mw_ncd_register"].collect()
    assert [(r["patient_id"], r["ncd_number"], r["outcome"]) for r in ncd] == [(8, "NNO-CCC-0007", None)]
    eid = m["mw_eid_register"].collect()
    assert [(r["patient_id"], r["eid_number"]) for r in eid] == [(5, "NNO-EID-0003")]


def test_snapshots_and_diagnoses(mw):
    _, m = mw
    last = m["mw_last_obs_in_period"].where("patient_id = 1 and concept = 'HIV viral load'").collect()
    assert {(r["end_date"], r["value_numeric"]) for r in last} >= {(D(2018, 6, 30), 1500.0), (D(2019, 12, 31), 1500.0)}
    assert all(r["last_obs_date"] <= r["end_date"] for r in m["mw_last_obs_in_period"].collect())
    rp = m["mw_lab_tests_recent_period"]
    assert rp.count() == m["mw_art_register"].select("patient_id").distinct().count() * 8
    dx = m["mw_ncd_diagnoses"].collect()
    assert [(r["patient_id"], r["diagnosis"], r["diagnosis_date"]) for r in dx] == [(8, "Hypertension", D(2018, 12, 1))]


def test_regimen_helpers(spark, mw):
    _, m = mw
    assert m["mw_art_regimen"].count() == 0
    regs = spark.createDataFrame([(1, "A", D(2018, 1, 1), "0"), (1, "B", D(2019, 1, 1), "2")],
                                 "patient_id long, regimen string, regimen_init_date date, line string")
    assert [r["regimen"] for r in nth_regimen(regs, 0).collect()] == ["B"]
    assert [r["regimen"] for r in nth_regimen(regs, 1).collect()] == ["A"]


def test_every_form_table_builds_with_its_ddl(spark, mw):
    from hearth.plans import forms
    from hearth.schemas import struct
    flat, _ = mw
    for name, spec in forms.FORMS.items():
        df = forms.build_form(flat, spec)
        assert df.schema == struct(", ".join(spec.ddl)), name
        keys = ["patient_id", "visit_date", "location"]
        n = df.count()
        assert n == df.select(spec.id_col).distinct().count(), name
        if not spec.grouped:
            assert n == df.select(*keys).distinct().count(), name
    fu = forms.build_form(flat, "mw_art_followup").where("patient_id = 1").orderBy("visit_date").collect()
    assert [r["next_appointment_date"] for r in fu] == [D(2018, 5, 10), D(2019, 9, 30)]
    assert fu[0]["weight"] == Decimal("61.50")
