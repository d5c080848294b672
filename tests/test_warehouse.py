"""Repeatable site loads, many sites by one plan, clustered tables, release keys."""

import datetime as dt
import hashlib
import hmac
import os

import pytest
from pyspark.sql import functions as F

from hearth import functions as H
from hearth import refresh as R
from hearth.plans import unify as U
from hearth.plans.anonymise import anonymise_warehouse
from hearth.plans.flat import FlatConfig, build_flat
from hearth.schemas import FLAT, SOURCE, struct
from hearth.sources import register_year_views, year_slice
from hearth.sources import sites as S
from hearth.sources import warehouse as W

from .conftest import rows
from .emr_fixture import build


@pytest.fixture(scope="module")
def source(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("source"))
    for name, df in build(spark).items():
        df.write.parquet(os.path.join(root, name))
    return root, tuple(set(SOURCE) - set(os.listdir(root)))


def _counts(spark, out):
    return {n: W.read_warehouse_table(spark, out, "flat", n, struct(FLAT[n])).count() for n in FLAT}


def test_a_load_that_died_is_unseen_and_is_run_again(spark, source, tmp_path, monkeypatch):
    src, absent = source
    clean, out = str(tmp_path / "clean"), str(tmp_path / "out")
    for prefix, append in (("10", False), ("11", True)):
        R.refresh(spark, src, clean, "none", prefix=prefix, optional=absent, append=append)
    R.refresh(spark, src, out, "none", prefix="10", optional=absent)
    before = _counts(spark, out)

    import hearth.plans.star as star

    def dies(*a, **k):
        raise RuntimeError("lost")
    # after the flat layer is written
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(star, "build_star", dies)
        R.refresh(spark, src, out, "none", prefix="11", optional=absent, append=True)
    assert W.loaded_sites(spark, out) == ["10"] and _counts(spark, out) == before
    # in the middle of the flat layer
    real, done = W.write_site_table, []

    def sometimes(*a, **k):
        done.append(a)
        return dies() if len(done) == 4 else real(*a, **k)
    with monkeypatch.context() as m, pytest.raises(RuntimeError, match="lost"):
        m.setattr(W, "write_site_table", sometimes)
        R.refresh(spark, src, out, "none", prefix="11", optional=absent, append=True)
    assert _counts(spark, out) == before
    R.refresh(spark, src, out, "none", prefix="11", optional=absent, append=True)
    assert W.loaded_sites(spark, out) == ["10", "11"] and _counts(spark, out) == _counts(spark, clean)
    assert {n: 2 * c for n, c in before.items()} == _counts(spark, out)


def test_a_site_loaded_again_leaves_no_old_years(spark, tmp_path):
    path, schema = str(tmp_path / "t"), struct("id long, d date")
    both = spark.createDataFrame([(1, dt.date(2019, 5, 1)), (2, dt.date(2020, 5, 1)), (3, None)], schema)
    W.write_site_table(both, path, "10", "d")
    W.write_site_table(both, path, "11", "d")
    W.write_site_table(both.where("id = 2"), path, "10", "d")
    read = W.read_site_table(spark, path, schema, ["10", "11", "12"], True)
    assert rows(read, "id") == [(1,), (2,), (2,), (3,)]
    assert W.read_site_table(spark, path, schema, ["12"], True).count() == 0
    one = year_slice(W.read_site_table(spark, path, schema, ["10", "11"], True, keep_year=True), "d", 2020, "year")
    assert rows(one, "id") == [(2,), (2,)] and one.columns == ["id", "d"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan.replace("PartitionFilters: [(year", "PartitionFilters: [isnotnull(year")


def test_sites_need_their_own_prefix_or_replace(spark, tmp_path):
    out = str(tmp_path)
    assert W.begin_load(spark, out, "a", "10", False) == []
    W.finish_load(spark, out, "a", "10")
    for bad in ("10", "123", None):
        with pytest.raises(ValueError):
            W.begin_load(spark, out, "a", bad, True)
    assert W.begin_load(spark, out, "b", "11", True) == ["10"]
    assert W.loaded_sites(spark, out) == ["10"]
    assert W.begin_load(spark, out, "a", "10", True, replace=True) == []
    assert W.loaded_sites(spark, out) == []          # being replaced: not read
    W.finish_load(spark, out, "a", "10")
    W.begin_load(spark, out, "a", None, False)       # a rebuild starts over
    assert W.loaded_sites(spark, out) == []


def test_clustered_tables_join_without_exchange_and_prune_years(spark, source, tmp_path):
    flat = build_flat({k: spark.read.schema(struct(v)).parquet(os.path.join(source[0], k)) if k not in source[1]
                       else spark.createDataFrame([], struct(v)) for k, v in SOURCE.items()}, FlatConfig())
    o = W.write_clustered(flat["omrs_obs"], "t_obs", str(tmp_path / "obs"), "patient_id", 4, "obs_date")
    p = W.write_clustered(flat["omrs_patient"], "t_patient", str(tmp_path / "patient"), "patient_id", 4)
    before = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
              if spark.conf.get(c, None)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = o.join(p.select("patient_id", "gender"), "patient_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
        assert joined.count() == flat["omrs_obs"].join(flat["omrs_patient"], "patient_id").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for c, v in before.items():
            spark.conf.set(c, v)
    year = [r[0] for r in o.select("year").distinct().collect() if r[0]][0]
    names = register_year_views(o, "obs_date", [year], "t_obs_of", "year")
    view = spark.table(names[0])
    plan = view._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and f"(year#" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert view.count() == flat["omrs_obs"].where(F.year("obs_date") == year).count() > 0
    # another session declares the written copy
    again = W.open_clustered(spark, "t_obs_again", str(tmp_path / "obs"), struct(FLAT["omrs_obs"]), "patient_id", 4, True)
    assert again.count() == o.count()


def test_marts_over_clustered_tables_are_the_same(spark, source, tmp_path):
    from hearth.plans import forms, malawi
    src, absent = source
    flat = R.refresh(spark, src, str(tmp_path / "a"), "none", optional=absent)["flat"]
    other = R.clustered(spark, flat, str(tmp_path / "b"), 2)
    for mart in (malawi.mw_patient, malawi.mw_ncd_register, lambda f: forms.build_form(f, "mw_art_visits")):
        assert rows(mart(flat)) == rows(mart(other))


# ---------------------------------------------------------------- many sites

@pytest.fixture(scope="module")
def sites(spark, tmp_path_factory):
    """Two sites with the same ids, one of them without relationships, and a third that is only listed."""
    root = str(tmp_path_factory.mktemp("sites"))
    tables = build(spark)
    for site in ("a0001", "a0003"):
        for name in SOURCE:
            df = tables[name] if name in tables else spark.createDataFrame([], struct(SOURCE[name]))
            if site == "a0003" and name == "relationship":
                continue
            if site == "a0003" and name == "location":
                df = df.withColumn("name", F.concat(F.col("name"), F.lit(" three")))
            df.write.parquet(os.path.join(root, site, name))
    return root, ["a0001", "a0002", "a0003"]


def test_all_sites_by_one_plan(spark, sites):
    root, listed = sites
    with pytest.raises(FileNotFoundError, match="relationship"):
        U.unified(spark, root, listed)["omrs_relationship"]
    uni = U.unified(spark, root, listed, optional=("relationship",))
    src = build(spark)
    one = build_flat({k: src.get(k, spark.createDataFrame([], struct(v))) for k, v in SOURCE.items()}, FlatConfig())
    for name in ("omrs_patient", "omrs_patient_identifier", "omrs_encounter", "omrs_obs", "omrs_obs_group", "omrs_program_state",
                 "omrs_encounter_provider", "omrs_visit", "omrs_program_enrollment"):
        got, ids = uni[name], U.ID_COLUMNS[name]
        for code in ("0001", "0003"):
            mine = got.where(F.col("site_id") == code)
            want = one[name]
            for c in ids:
                want = want.withColumn(c, H.prefix_id_text(c, code))
            if code == "0003":
                for c in ("location", "health_center"):
                    if c in want.columns:
                        named = [r[0] for r in src["location"].select("name").collect()]
                        want = want.withColumn(c, F.when(F.col(c).isin(named), F.concat(F.col(c), F.lit(" three"))).otherwise(F.col(c)))
            cols = want.columns
            key = lambda r: tuple((x is not None, str(x)) for x in r)
            assert sorted(map(tuple, mine.select(*cols).collect()), key=key) == sorted(map(tuple, want.collect()), key=key), (name, code)
    assert {r["site_id"] for r in uni["omrs_relationship"].select("site_id").distinct().collect()} == {"0001"}
    assert {r["fosa_id"] for r in uni["omrs_patient"].select("fosa_id").distinct().collect()} == {"0"}


def test_the_plan_does_not_grow_with_the_sites(spark, sites, tmp_path):
    root, listed = sites
    size = lambda s: len(U.unified(spark, root, s, optional=("relationship",))["omrs_encounter"]
                         ._jdf.queryExecution().optimizedPlan().toString().splitlines())
    assert size(["a0001"]) == size(listed)


def test_facility_of_the_persons_site(spark, tmp_path):
    root = str(tmp_path)
    attrs = struct(SOURCE["person_attribute"])
    when = dt.datetime(2020, 1, 1)
    data = {"a0001": ([(1, 5, 7, "2", False, when), (2, 6, 7, "x", False, when), (3, 8, 7, "2", True, when)], [(2, "77")]),
            "a0003": ([(1, 5, 7, "2", False, when), (2, 5, 7, "3", False, dt.datetime(2019, 1, 1)), (3, 9, 8, "2", False, when)], [(2, "99"), (3, "98")])}
    for site, (rows_, fosa) in data.items():
        spark.createDataFrame(rows_, attrs).write.parquet(f"{root}/{site}/person_attribute")
        spark.createDataFrame(fosa, "location_id long, fosa_id string").write.parquet(f"{root}/{site}/location_fosa")
    src = S.read_all_sites(spark, root, ["a0001", "a0003"], ["person_attribute", "location_fosa"])
    pf = U.patient_fosa(src["person_attribute"], src["location_fosa"], by_site=True)
    got = {(r["person_id"] // S.ID_SPAN, r["person_id"] % S.ID_SPAN): r["fosa_id"] for r in pf.collect()}
    assert got == {(1, 5): "77", (1, 6): "0", (3, 5): "99"}


def test_ids_beyond_the_span_and_odd_sites_are_errors(spark, tmp_path):
    df = spark.createDataFrame([(S.ID_SPAN, 1)], "visit_type_id long, __site long")
    with pytest.raises(Exception, match="span"):
        S.keyed_to_site(df).collect()
    with pytest.raises(ValueError):
        S.site_code("0406")
    with pytest.raises(FileNotFoundError):
        S.read_all_sites(spark, str(tmp_path), ["a0001"], ["visit"])


def test_the_multi_site_command(spark, sites, tmp_path):
    root, listed = sites
    with open(tmp_path / "list.csv", "w") as f:
        f.write("openmrs.db.name\n" + "\n".join(listed) + "\n")
    with open(tmp_path / "key", "w") as f:
        f.write("one secret\n")
    out = str(tmp_path / "out")
    R.main(["--source", root, "--out", out, "--sites", str(tmp_path / "list.csv"), "--optional-tables", "relationship",
            "--anonymise", "--release-key-file", str(tmp_path / "key")])
    assert spark.read.parquet(out + "/unified/omrs_patient").count() == 16
    assert spark.read.parquet(out + "/unified/patient_facility").columns == ["patient_id", "fosa_id"]
    assert spark.read.parquet(out + "/cohort/omrs_patient").count() <= 16
    released = spark.read.parquet(out + "/anonymised/omrs_patient")
    assert "first_name" not in released.columns and {"site_id", "fosa_id"} <= set(released.columns)


# ---------------------------------------------------------------- release keys

def test_keyed_hashes(spark):
    df = spark.createDataFrame([(12,), (None,)], "id long")
    for key in (b"k", b"x" * 100):
        got = [r[0] for r in df.select(H.keyed_hash("id", key, "patient_id")).collect()]
        assert got == [hmac.new(key, b"patient_id:12", hashlib.sha256).hexdigest(), None]
    with pytest.raises(ValueError):
        H.keyed_hash("id", b"", "patient_id")


def test_an_id_hashes_alike_in_all_tables_of_a_release_only(spark):
    enrolled = spark.createDataFrame([(7, 7)], "program_enrollment_id long, patient_id long")
    register = spark.createDataFrame([(7, 7)], "enrollment_id long, patient_id long")
    a = {k: v.first() for k, v in anonymise_warehouse({"e": enrolled, "r": register}, key=b"one").items()}
    b = anonymise_warehouse({"e": enrolled}, key=b"two")["e"].first()
    assert a["e"]["patient_id"] == a["r"]["patient_id"] and a["e"]["program_enrollment_id"] == a["r"]["enrollment_id"]
    assert a["e"]["patient_id"] != a["e"]["program_enrollment_id"] and a["e"]["patient_id"] != b["patient_id"]


def test_no_release_without_a_key(spark, source, tmp_path):
    with pytest.raises(ValueError, match="key"):
        R.refresh(spark, source[0], str(tmp_path / "o"), "none", optional=source[1], anonymise=True)
    assert not os.path.exists(tmp_path / "o")


def test_periods_and_names_from_files(spark, tmp_path):
    with open(tmp_path / "p.csv", "w") as f:
        f.write("start_date,end_date,zero\n2020-04-01,2020-06-30,0\n2020-01-01,2020-03-31,0\n")
    with open(tmp_path / "c.csv", "w") as f:
        f.write("concept\nWeight (kg)\nHIV viral load\n")
    assert [tuple(r) for r in R.read_periods(spark, str(tmp_path / "p.csv")).collect()] == [
        (0, dt.date(2020, 1, 1), dt.date(2020, 3, 31)), (1, dt.date(2020, 4, 1), dt.date(2020, 6, 30))]
    assert R.read_names(spark, str(tmp_path / "c.csv")) == ["Weight (kg)", "HIV viral load"]
