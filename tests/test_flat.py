import datetime as dt

import pytest

from hearth.plans.flat import FlatConfig, build_flat

from .emr_fixture import build

D = dt.date


@pytest.fixture(scope="module")
def flat(spark):
    src = build(spark)
    return {k: v.cache() for k, v in build_flat(src).items()}


def by(df, key):
    return {r[key]: r for r in df.collect()}


def test_lookups(flat):
    c = by(flat["lookup_concept"], "source_key")
    assert c[1]["target_value"] == "HIV program"            # fully specified English beats the French name
    assert c[8]["target_value"] == "Weight (kg)"            # fully specified beats a short name
    pn = by(flat["lookup_provider_name"], "uuid")
    assert pn["prov-1"]["provider_name"] == "Doctor Who"
    assert pn["prov-2"]["provider_name"] == "Nurse Joy"
    assert pn["prov-3"]["provider_name"] == "P003"
    u = by(flat["lookup_user"], "source_key")
    assert u[2]["target_value"] == "2-2"


def test_patient(flat):
    p = by(flat["omrs_patient"], "patient_id")
    assert 4 not in p                       # voided person
    assert 6 not in p                       # test patient
    assert 7 in p                           # null test flag kept
    assert p[1]["first_name"] == "Johnny" and p[1]["last_name"] == "van Banda Phiri"
    assert p[2]["first_name"] == "Maria"
    assert p[9]["first_name"] is None       # no name row
    assert p[1]["phone_number"] == "0888333444"
    assert p[1]["health_center"] == "Lisungwi Health Center"
    assert p[1]["identifier"] == "NNO 12"   # preferred identifier
    assert p[1]["state_province"] == "Southern"
    assert p[2]["age_years_at_death"] == 29 and p[2]["cause_of_death"] == "Tuberculosis"
    assert p[5]["mothers_name"] == "Alice Mbewe"
    assert p[3]["age_years_at_death"] is None


def test_identifiers_relationships(flat):
    ids = flat["omrs_patient_identifier"].collect()
    assert {r["identifier"] for r in ids} == {"NNO 12", "NNO 12345", "NNO 12A", "NNO CCC 7", "NNO EID 3", "NNO 99"}
    rel = sorted((r["patient_id"], r["patient_role"], r["related_person_role"], r["related_person"])
                 for r in flat["omrs_relationship"].collect())
    assert rel == [(2, "Guardian", None, "Grace Mbewe"), (5, "Child", "Parent", "Alice Mbewe")]


def test_encounters_and_obs(flat):
    e = by(flat["omrs_encounter"], "encounter_id")
    assert e[1]["provider"] == "Nurse Joy"          # smallest encounter-provider id wins
    assert e[1]["encounter_time"] == "09:30:00" and e[1]["age_years_at_encounter"] == 37
    assert all(r["encounter_type"] != "x" for r in e.values())
    assert 9 not in e                                # the voided encounter of a live person
    obs = flat["omrs_obs"].collect()
    groups = flat["omrs_obs_group"].collect()
    assert {g["concept"] for g in groups} == {"Viral Load Screening construct", "HIV Test Construct",
                                              "Chronic care diagnosis"}
    assert not any(o["value_numeric"] == 99.0 for o in obs)           # voided obs
    coded = {o["value_coded"] for o in obs if o["concept"] == "Malawi Antiretroviral drugs received"}
    assert coded == {"TDF/3TC/EFV", "Tuberculosis"}
    no_enc = [o for o in obs if o["encounter_id"] is None]
    assert len(no_enc) == 1 and no_enc[0]["encounter_type"] is None


def test_programs(flat):
    en = by(flat["omrs_program_enrollment"], "program_enrollment_id")
    assert 3 not in en                                 # no enrollment date
    assert en[2]["outcome"] == "Patient died" and en[2]["completion_date"] == D(2019, 6, 1)
    st = flat["omrs_program_state"].collect()
    assert len(st) == 9                                # voided state dropped
    assert {r["workflow"] for r in st} >= {"Treatment status", "Chronic care treatment status"}


def test_prefix(spark):
    src = build(spark)
    out = build_flat(src, FlatConfig(prefix="10"))
    ids = {r["patient_id"] for r in out["omrs_patient"].collect()}
    assert 101 in ids and 1010 in ids
