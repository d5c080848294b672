import datetime as dt
import os
import tempfile

from hearth import operators as O
from hearth import sources as S
from hearth.plans.flat import lookup_concept_by_tag
from hearth.schemas import SOURCE, struct

D = dt.date


def test_read_csv_periods_and_value_map(spark):
    d = tempfile.mkdtemp(prefix="hearth-csv-")
    p = os.path.join(d, "periods.csv")
    with open(p, "w") as fh:
        fh.write("Year,Quarter,Yearquarter,Start_Date,end_Date,zero\n2016,1,2016Q1,1/1/2016,3/31/2016,0\n"
                 "2016,2,2016Q2,4/1/2016,6/30/2016,0\n")
    periods = S.read_csv(spark, p, struct("year int, quarter int, yearquarter string, start_date date, "
                                          "end_date date, zero int"))
    assert [tuple(r) for r in periods.collect()] == [(2016, 1, "2016Q1", D(2016, 1, 1), D(2016, 3, 31), 0),
                                                     (2016, 2, "2016Q2", D(2016, 4, 1), D(2016, 6, 30), 0)]
    m = os.path.join(d, "programs.csv")
    with open(m, "w") as fh:
        fh.write("East_program_name,north_program_name\n'HIV PROGRAM','HIV Program'\n")
    vm = S.read_csv(spark, m, struct("source string, target string"), strip_quotes=["source", "target"])
    assert [tuple(r) for r in vm.collect()] == [("HIV PROGRAM", "HIV Program")]


def test_ids_audit_year_views_and_writes(spark):
    assert len({r["site"] for r in S.generate_ids(spark, 9998, 1, 6, "a", 4).collect()}) == 6     # wider ids keep their digits
    ids = [r["site"] for r in S.generate_ids(spark, 1, 1, 3, "a", 4).collect()]
    assert ids == ["a0001", "a0002", "a0003"]
    row = S.import_audit_row(spark, "10", "db1", "first load").collect()[0]
    assert row["id_prefix"] == "10" and row["import_date"] is not None
    enc = spark.createDataFrame([(1, D(2018, 12, 31)), (2, D(2019, 1, 1)), (3, D(2019, 12, 31)), (4, D(2020, 1, 1))],
                                "encounter_id long, encounter_date date")
    names = S.register_year_views(enc, "encounter_date", [2019], "omrs_encounter")
    assert names == ["omrs_encounter_2019"]
    assert sorted(r[0] for r in spark.sql("select encounter_id from omrs_encounter_2019").collect()) == [2, 3]
    out = os.path.join(tempfile.mkdtemp(prefix="hearth-write-"), "t")
    S.overwrite_table(enc, out, columns=["encounter_id"])
    S.append_table(enc.select("encounter_id"), out)
    assert spark.read.parquet(out).count() == 8
    S.overwrite_table(enc, out)
    assert spark.read.parquet(out).count() == 4


def test_sink_order_and_tagged_concept_names(spark):
    df = spark.createDataFrame([("b",), ("A",), ("a",), ("C",)], "name string")
    assert [r[0].lower() for r in O.sink_order(df, ["name"]).collect()] == ["a", "a", "b", "c"]
    rows = {
        "concept": [(1,), (2,)],
        "concept_name": [(1, 1, "Old en", "en", False, "SHORT", False, dt.datetime(2010, 1, 1)),
                         (2, 1, "Tagged en", "en", False, "SHORT", False, dt.datetime(2012, 1, 1)),
                         (3, 1, "fr", "fr", True, "FULLY_SPECIFIED", False, dt.datetime(2009, 1, 1)),
                         (4, 2, "only fr", "fr", True, "FULLY_SPECIFIED", False, None)],
        "concept_name_tag_map": [(2, 4), (2, 7), (3, 4)],
    }
    src = {k: spark.createDataFrame(v, struct(SOURCE[k])) for k, v in rows.items()}
    got = {r["source_key"]: r["target_value"] for r in lookup_concept_by_tag(src).collect()}
    assert got == {1: "Tagged en", 2: "only fr"}


def test_import_metadata_row(spark):
    from hearth.plans.rwanda import rw_import_metadata
    r = rw_import_metadata(spark, "host", "db1", 10, "load").collect()[0]
    assert (r["source_host"], r["source_db"], r["warehouse_prefix"], r["import_comment"]) == ("host", "db1", 10, "load")
    assert r["import_date"] is not None
