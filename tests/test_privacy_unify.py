import datetime as dt

import pytest

from hearth.plans import unify as U
from hearth.plans.anonymise import anonymise_warehouse
from hearth.plans.flat import build_flat

from .emr_fixture import build

D = dt.date


@pytest.fixture(scope="module")
def flat(spark):
    return {k: v.cache() for k, v in build_flat(build(spark)).items() if k.startswith("omrs_")}


def test_anonymised_copy_has_no_direct_identifiers(spark, flat):
    anon = anonymise_warehouse(flat)
    p = anon["omrs_patient"]
    assert not ({"first_name", "last_name", "phone_number", "identifier", "mothers_name"} & set(p.columns))
    raw_ids = {str(r["patient_id"]) for r in flat["omrs_patient"].collect()}
    rows = p.collect()
    assert all(r["patient_id"] not in raw_ids and len(r["patient_id"]) == 32 for r in rows)
    assert all(r["birthdate"] is None or r["birthdate"].day == 1 and r["birthdate"].month in (1, 4, 7, 10)
               for r in rows)
    ages = [r["age_months_at_encounter"] for r in anon["omrs_encounter"].collect() if r["age_months_at_encounter"]]
    assert ages and all((a - 1) % 3 == 0 for a in ages)
    assert "value_text" not in anon["omrs_obs"].columns
    salted = anonymise_warehouse(flat, salt="s3cret")["omrs_patient"].collect()
    assert all(len(r["patient_id"]) == 64 for r in salted)


def test_blacklist_applies_to_obs(spark):
    obs = spark.createDataFrame([(1, "TELEPHONE NUMBER", D(2020, 5, 5)), (2, "Weight", D(2020, 5, 5))],
                                "obs_id long, concept string, obs_date date")
    out = anonymise_warehouse({"omrs_obs": obs})["omrs_obs"].collect()
    assert [r["concept"] for r in out] == ["Weight"] and out[0]["obs_date"] == D(2020, 4, 1)


def test_unify_two_sites_and_retain_cohort(spark, flat):
    lf = spark.createDataFrame([(2, 777)], "location_id long, fosa_id long")
    attrs = spark.createDataFrame([(1, 1, 7, "2", False, dt.datetime(2020, 1, 1)),
                                   (2, 1, 7, "9", False, dt.datetime(2019, 1, 1))],
                                  "person_attribute_id long, person_id long, person_attribute_type_id long, "
                                  "value string, voided boolean, date_created timestamp_ntz")
    pf = U.patient_fosa(attrs, lf)
    assert [tuple(r) for r in pf.collect()] == [(1, "777")]
    a = U.tag_site(flat, "a0001x", pf)
    b = U.tag_site(flat, "b0002x")
    uni = U.unify_sites({"a0001x": a, "b0002x": b})
    pats = uni["omrs_patient"].collect()
    assert len(pats) == 2 * flat["omrs_patient"].count()
    assert {r["patient_id"] for r in pats if r["site_id"] == "a0001x"} >= {"00011"}
    assert len({r["patient_id"] for r in pats}) == len(pats)            # ids stay unique across sites
    kept = U.retain_hiv_cohort(flat, programs=["HIV program"], encounter_types=["ART_INITIAL"])
    assert {r["patient_id"] for r in kept["omrs_patient"].collect()} == {1, 2, 5, 7, 10}
    enc = kept["omrs_encounter"].collect()
    assert all(r["patient_id"] in (1, 2, 5, 7, 10) or r["encounter_type"] in ("ART_INITIAL", None) for r in enc)
    assert {r["patient_id"] for r in enc} == {1, 2, 5, 10}               # 3 and 8: outside the cohort, other types
    pairs = U.patient_facility_pairs(uni["omrs_encounter"]).collect()
    assert ("00011", "777") in {(r["patient_id"], r["fosa_id"]) for r in pairs}


def test_replica_copy(spark, flat):
    import tempfile

    from hearth.plans.replica import write_replica
    root = tempfile.mkdtemp(prefix="hearth-replica-")
    paths = write_replica(flat, root)
    assert len(paths) == 10
    obs = spark.read.parquet(f"{root}/omrs_obs")
    assert not {"form", "value_text", "comments"} & set(obs.columns)
    assert dict(obs.dtypes)["obs_date"] == "timestamp_ntz"
    assert "form" in spark.read.parquet(f"{root}/omrs_encounter").columns
    assert obs.count() == flat["omrs_obs"].count()


def test_unified_copy_keeps_facility_and_dates(spark, flat):
    from hearth.plans.anonymise import anonymise_unified
    uni = U.unify_sites({"a0001x": U.tag_site(flat, "a0001x")})
    enc = anonymise_unified(uni)["omrs_encounter"]
    r = enc.where("fosa_id = '0001'").first()
    assert r is not None and r["site_id"] == "a0001x" and len(r["encounter_id"]) == 32
    raw = {x["encounter_date"] for x in uni["omrs_encounter"].collect()}
    assert {x["encounter_date"] for x in enc.collect()} == raw      # dates kept in X2
