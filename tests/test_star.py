import pytest

from hearth.plans.flat import build_flat
from hearth.plans.star import build_star

from .emr_fixture import build


@pytest.fixture(scope="module")
def star(spark):
    flat = {k: v.cache() for k, v in build_flat(build(spark)).items()}
    return flat, {k: v.cache() for k, v in build_star(spark, flat).items()}


def test_dims_have_one_row_per_key(star):
    _, s = star
    for name, key in [("dim_date", "full_date"), ("dim_time", "full_time"), ("dim_location", "name"),
                      ("dim_coded_question", "name"), ("dim_patient", "patient_id")]:
        df = s[name]
        assert df.count() == df.select(key).distinct().count(), name
    ids = [r["date_id"] for r in s["dim_date"].orderBy("date_id").collect()]
    assert ids == list(range(1, len(ids) + 1))
    first = s["dim_date"].orderBy("date_id").first()
    assert first["full_date"] is None          # the null date is a row of its own, numbered first


def test_facts_refer_to_dims(star):
    flat, s = star
    ev = s["fact_patient_event"]
    by_event = {r["event_id"]: r["count"] for r in ev.groupBy("event_id").count().collect()}
    n_enc = flat["omrs_encounter"].where("encounter_date is not null").count()
    assert by_event[3] == n_enc
    assert by_event[5] == 1                    # one death
    assert ev.where("event_id = 3 and time_id is null").count() == 0
    assert ev.where("event_id in (4, 5) and program_id is not null").count() == 0
    coded = s["fact_patient_coded_value"]
    assert coded.count() <= flat["omrs_obs"].where("value_coded is not null").count()
    assert coded.join(s["dim_coded_value"], "coded_value_id", "left_anti").count() == 0
    num = s["fact_patient_numeric_value"]
    assert num.count() == flat["omrs_obs"].where("value_numeric is not null").count()
    assert s["fact_patient_date_value"].where("date_value is null").count() == 0
