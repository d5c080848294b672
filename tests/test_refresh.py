import os
import tempfile

import pytest
from pyspark.sql import functions as F

from hearth.plans.anonymise import anonymise_warehouse
from hearth.refresh import refresh
from hearth.schemas import LIBERIA_SOURCE, RWANDA_SOURCE, SOURCE

from .emr_fixture import build


def test_refresh_writes_every_layer(spark):
    root = tempfile.mkdtemp(prefix="hearth-refresh-")
    src_dir, out = os.path.join(root, "src"), os.path.join(root, "out")
    for name, df in build(spark).items():
        df.write.parquet(os.path.join(src_dir, name))
    absent = tuple(set(SOURCE) - set(os.listdir(src_dir)))
    with pytest.raises(Exception, match="(?i)path"):
        refresh(spark, src_dir + "-missing", out, "none")
    # a path with a scheme is read like any other
    res = refresh(spark, "file://" + src_dir, out, "malawi", periods_from="2018-01-01", periods_to="2019-12-31", anonymise=True,
                  optional=absent, release_key=b"a secret")
    for name, df in res["anonymised"].items():
        assert not name.startswith("lookup_") and not set(df.columns) & {"village", "traditional_authority", "provider_name", "chw"}
    with pytest.raises(ValueError, match="no decision"):
        anonymise_warehouse({"mw_patient": res["mart"]["mw_patient"].withColumn("nickname", F.lit("x"))})
    assert os.path.exists(os.path.join(out, "flat", "omrs_obs"))
    assert os.path.exists(os.path.join(out, "star", "fact_patient_event"))
    assert os.path.exists(os.path.join(out, "mart", "mw_art_register"))
    assert res["mart"]["mw_art_register"].count() == 3
    assert res["flat"]["omrs_patient"].count() == 8
    assert "first_name" not in res["anonymised"]["omrs_patient"].columns


def test_refresh_rwanda_and_liberia_paths(spark):
    root = tempfile.mkdtemp(prefix="hearth-refresh-rl-")
    src_dir = os.path.join(root, "src")
    for name, df in build(spark).items():
        df.write.parquet(os.path.join(src_dir, name))
    absent = tuple({*SOURCE, *RWANDA_SOURCE, *LIBERIA_SOURCE} - set(os.listdir(src_dir)))
    rw = refresh(spark, src_dir, os.path.join(root, "rw"), "rwanda", periods_from="2018-01-01", periods_to="2019-12-31",
                 optional=absent)
    assert set(rw["mart"]) >= {"rw_order", "rw_bill", "rw_onc_diagnosis", "rw_calculated_visit",
                               "rw_last_vl_include_blanks"}
    assert rw["mart"]["rw_calculated_visit"].count() > 0
    assert rw["mart"]["rw_program_enrollment"].columns == rw["flat"]["omrs_program_enrollment"].columns
    lb = refresh(spark, src_dir, os.path.join(root, "lb"), "liberia", optional=absent)
    assert set(lb["mart"]) == {"mh_encounter", "rx_prescriptions", "program_statistics", "program_enrollment"}
    assert lb["mart"]["program_enrollment"].count() == 7


def test_a_second_site_is_added_by_prefix(spark):
    root = tempfile.mkdtemp(prefix="hearth-refresh-sites-")
    src_dir, out = os.path.join(root, "src"), os.path.join(root, "out")
    for name, df in build(spark).items():
        df.write.parquet(os.path.join(src_dir, name))
    absent = tuple(set(SOURCE) - set(os.listdir(src_dir)))
    one = refresh(spark, src_dir, out, "none", prefix="10", optional=absent)["flat"]["omrs_patient"].count()
    two = refresh(spark, src_dir, out, "none", prefix="11", optional=absent, append=True)
    ids = [str(r["patient_id"]) for r in two["flat"]["omrs_patient"].collect()]
    assert len(set(ids)) == len(ids) == 2 * one and {i[:2] for i in ids} == {"10", "11"}
    for bad in ("11", "123", None):
        with pytest.raises(ValueError):
            refresh(spark, src_dir, out, "none", prefix=bad, optional=absent, append=True)
