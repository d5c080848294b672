import datetime as dt
from decimal import Decimal

from hearth import operators as O
from hearth.plans import rwanda as RW
from hearth.schemas import FLAT, RWANDA_SOURCE, SOURCE, conform, struct

D = dt.date
T = dt.datetime


def _flat(spark, name, rows, cols):
    return conform(spark.createDataFrame(rows, cols), FLAT[name])


def test_onc_diagnosis_pairs_status_in_force(spark):
    st = _flat(spark, "omrs_program_state", [
        (1, "u1", 10, 5, "Oncology", "Diagnosis", "Breast cancer", D(2020, 1, 10), None),
        (2, "u2", 10, 5, "Oncology", "Diagnosis Status", "Suspected", D(2020, 1, 1), D(2020, 2, 1)),
        (3, "u3", 10, 5, "Oncology", "Diagnosis Status", "Confirmed", D(2020, 2, 1), None),
        (4, "u4", 11, 6, "Oncology", "Diagnosis", "Lymphoma", D(2020, 3, 1), D(2020, 4, 1))],
        "program_state_id long, uuid string, program_enrollment_id long, patient_id long, program string, "
        "workflow string, state string, start_date date, end_date date")
    out = {r["program_state_id"]: r for r in RW.rw_onc_diagnosis({"omrs_program_state": st}).collect()}
    assert set(out) == {1, 4}
    assert out[1]["diagnosis_status"] == "Suspected" and out[1]["start_date_difference"] == 9.0
    assert out[4]["diagnosis_status"] is None


def test_snapshots_pdc_and_zscore(spark):
    obs = _flat(spark, "omrs_obs", [
        (1, 1, "HIV VIRAL LOAD", D(2020, 1, 5), 500.0), (2, 1, "HIV VIRAL LOAD", D(2020, 1, 5), 700.0),
        (3, 1, "HIV VIRAL LOAD", D(2020, 5, 5), 40.0), (4, 2, "WEIGHT (KG)", D(2020, 1, 1), 9.5),
        (5, 2, "HEIGHT (CM)", D(2020, 1, 1), 75.5), (6, 2, "WEIGHT (KG)", D(2020, 2, 1), 10.0),
        (7, 2, "Cured (malnutrition)", D(2020, 6, 1), None)],
        "obs_id long, patient_id long, concept string, obs_date date, value_numeric double")
    pe = _flat(spark, "omrs_program_enrollment", [
        (1, 1, "HIV Program", D(2019, 1, 1), None), (2, 2, "PDC PROGRAM", D(2020, 1, 1), "u2"),
        (9990001, 3, "old", D(2019, 1, 1), RW.PDC_UUID + "3")],       # derived by an earlier run
        "program_enrollment_id long, patient_id long, program string, enrollment_date date, uuid string")
    pat = _flat(spark, "omrs_patient", [(1, "M", D(1990, 1, 1)), (2, "f", D(2019, 1, 1)), (3, "F", None)],
                "patient_id long, gender string, birthdate date")
    enc = _flat(spark, "omrs_encounter", [
        (1, 2, D(2020, 1, 1), "PDC malnutrition Acute form", "Clinic A"),
        (2, 2, D(2019, 12, 1), "PDC malnutrition Growth Failure form", "Clinic B")],
        "encounter_id long, patient_id long, encounter_date date, form string, location string")
    flat = {"omrs_obs": obs, "omrs_program_enrollment": pe, "omrs_patient": pat, "omrs_encounter": enc}
    periods = O.quarter_periods(spark, "2020-01-01", "2020-06-30")
    lobs = RW.rw_last_obs_in_period(flat, ["HIV VIRAL LOAD"], periods).collect()
    assert sorted((r["end_date"], r["obs_id"]) for r in lobs) == [(D(2020, 3, 31), 1), (D(2020, 3, 31), 2),
                                                                 (D(2020, 6, 30), 3)]
    lvl = sorted((r["end_date"], r["obs_id"]) for r in RW.rw_last_vl_include_blanks(flat, periods).collect())
    assert lvl == [(D(2020, 3, 31), 1), (D(2020, 6, 30), 3)]
    rows, table = RW.rw_pdc_malnutrition_program(flat)
    r = rows.collect()
    assert [(x["program_enrollment_id"], x["patient_id"], x["enrollment_date"], x["location"], x["completion_date"])
            for x in r] == [(9990000, 2, D(2019, 12, 1), "Clinic B", D(2020, 6, 1))]
    assert {x["program_enrollment_id"] for x in table.collect()} == {1, 2, 9990000}
    z = RW.pdc_z_score_input(flat).collect()
    assert [(x["patient_id"], x["obs_date"], x["weight"], x["clenhei"], x["sex"], x["agedays"]) for x in z] == [
        (2, "2020-01-01", 9.5, 76, 2, 365)]


def _src(spark, rows: dict):
    schemas = {**SOURCE, **RWANDA_SOURCE}
    return {k: spark.createDataFrame(v, struct(schemas[k])) for k, v in rows.items()}


def test_billing(spark):
    m = Decimal
    src = _src(spark, {
        "moh_bill_patient_bill": [(1, m("10.00"), 1, False), (2, m("5.00"), 0, False), (3, m("1.00"), 0, True)],
        "moh_bill_consommation": [(1, 1, 1, 1, 1, 1, T(2020, 1, 1)), (2, 2, 1, None, 1, 1, T(2020, 1, 2))],
        "moh_bill_beneficiary": [(1, 42, 7)],
        "moh_bill_third_party_bill": [(1, m("2.50"))],
        "moh_bill_insurance_bill": [(1, m("7.50"))],
        "moh_bill_payment": [(10, 1, m("10.00"), T(2020, 1, 3), 1, False), (11, 2, m("5.00"), T(2020, 1, 4), 1, False)],
        "moh_bill_cash_payment": [(10,)], "moh_bill_deposit_payment": [(11,)],
        "moh_bill_payment_refund": [(10, 1, m("1.00"), False)],
        "users": [(1, "admin", None, 9)], "person": [(9, "uuid-9", "M", None, None, None, None, None, False, None)],
        "moh_bill_insurance_policy": [(7, 1, 9, 1, D(2020, 1, 1), None, None, None)],
        "moh_bill_insurance": [(1, "RAMA")], "moh_bill_third_party": [(1, m("0.10"))],
    })
    bills = {r["patient_bill_id"]: r for r in RW.rw_bill(src).collect()}
    assert set(bills) == {1, 2}
    assert bills[1]["amount"] == m("20.00") and bills[2]["amount"] is None     # null third-party part
    assert bills[1]["creator_uuid"] == "uuid-9" and bills[1]["patient_id"] == 42
    pays = {r["bill_payment_id"]: r for r in RW.rw_payment(src).collect()}
    assert (pays[10]["is_cash"], pays[10]["is_deposit"], pays[10]["patient_id"]) == (1, 0, 42)
    assert (pays[11]["is_cash"], pays[11]["is_deposit"]) == (0, 1)
    assert RW.rw_refund(src).collect()[0]["refunded_by_person_uuid"] == "uuid-9"
    ins = RW.rw_insurance_policy(src).collect()[0]
    assert (ins["patient_id"], ins["insurance_company"], ins["owner_uuid"]) == (42, "RAMA", "uuid-9")


def test_order_groups_and_remap(spark):
    src = _src(spark, {
        "orders": [(1, 1, 5, 1, None, D(2020, 1, 1), None, D(2020, 2, 1), None, None, 3, "o1", None, None,
                    D(2020, 1, 1), None, False),
                   (2, 1, 5, 1, None, D(2020, 1, 8), None, None, None, None, 3, "o2", None, None, D(2020, 1, 1),
                    None, False)],
        "orderextension_order": [(1, 100, 1, None, None, None), (2, 100, 2, None, None, None)],
        "orderextension_order_group": [(100, "g1", "CYCLE", 1, 50, D(2020, 1, 1), False)],
        "orderextension_order_set": [(50, "s1", "Chemo A", "desc", None, 21)],
    })
    g = RW.rw_order_group(src).collect()[0]
    assert (g["first_start_date"], g["Last_start_date"], g["last_discontinued"], g["initially_planned_end"],
            g["patient_id"]) == (D(2020, 1, 1), D(2020, 1, 8), D(2020, 2, 1), D(2020, 1, 22), 3)
    enc = spark.createDataFrame([(1, "ADULT INITIAL"), (2, "other")], "encounter_id long, encounter_type string")
    m = spark.createDataFrame([("adult initial", "ADULTINITIAL")], "source string, target string")
    out = sorted(tuple(r) for r in RW.remap_values(enc, "encounter_type", m, "source", "target").collect())
    assert out == [(1, "ADULTINITIAL"), (2, "other")]
