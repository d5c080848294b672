import datetime as dt

from pyspark.sql import functions as F

from hearth import functions as H

from .conftest import rows


def test_full_months_follow_day_of_month(spark):
    d = dt.date
    df = spark.createDataFrame([(1, d(1999, 10, 31), d(2000, 6, 30)), (2, d(2000, 1, 31), d(2000, 2, 29)),
                                (3, d(2000, 2, 29), d(2001, 2, 28)), (4, d(2001, 2, 28), d(1996, 6, 29)),
                                (5, None, d(2000, 1, 1))], "k int, a date, b date")
    out = df.select("k", H.full_months_between("a", "b").alias("m"), H.full_years_between("a", "b").alias("y"))
    assert rows(out) == [(1, 7, 0), (2, 0, 0), (3, 11, 0), (4, -55, -4), (5, None, None)]


def test_format_identifier(spark):
    df = spark.createDataFrame([("ABC 12",), ("ABC 12345",), ("ABC 12A",), (None,), ("",), ("X -5 7",)], "i string")
    out = [r[0] for r in df.select(H.format_identifier("i")).collect()]
    assert out == ["ABC-0012", "ABC-12345", "ABC-012A", None, "", "X-00-5-0007"]


def test_prefix_and_hash(spark):
    df = spark.createDataFrame([(12,), (None,)], "id long")
    out = df.select(H.prefix_id("id", "10").alias("p"), H.hash_id("id").alias("h")).collect()
    assert out[0]["p"] == 1012 and out[1]["p"] is None
    assert out[0]["h"] == "c20ad4d76fe97759aa27a0c99bff6710"


def test_case_insensitive_literals(spark):
    df = spark.createDataFrame([("HIV program",), ("HIV Program ",), ("TB",)], "p string")
    assert df.where(H.ci_eq("p", "hiv PROGRAM")).count() == 2
    assert df.where(H.ci_in("p", ["tb", "x"])).count() == 1


def test_quarter_and_bucket(spark):
    df = spark.createDataFrame([(dt.date(2016, 8, 17), 1), (dt.date(2016, 12, 31), 5), (dt.date(2016, 1, 1), 12)],
                               "d date, m int")
    out = df.select(H.quarter_start("d").alias("q"), H.quarter_end("d").alias("e"),
                    H.three_month_bucket("m").alias("b")).collect()
    assert [(r.q, r.e, r.b) for r in out] == [
        (dt.date(2016, 7, 1), dt.date(2016, 9, 30), 1), (dt.date(2016, 10, 1), dt.date(2016, 12, 31), 4),
        (dt.date(2016, 1, 1), dt.date(2016, 3, 31), 10)]


def test_less_than_text_and_fallback(spark):
    df = spark.createDataFrame([(40.0, None, "p"), (39.5, "  ", None), (None, None, None)], "n double, a string, b string")
    out = df.select(H.less_than_text("n").alias("t"), H.name_fallback("a", "b").alias("f")).collect()
    assert [(r.t, r.f) for r in out] == [("<40", "p"), ("<39.5", "Unknown"), (None, "Unknown")]


def test_gender_and_visit_key(spark):
    df = spark.createDataFrame([("m", 5, dt.date(2020, 2, 29)), ("F", 6, dt.date(2020, 3, 1)), ("x", 7, None)],
                               "g string, p long, d date")
    out = df.select(H.gender_code("g").alias("c"), H.visit_key("p", "d").alias("k")).collect()
    assert [(r.c, r.k) for r in out] == [(1, "5-2020-02-29"), (2, "6-2020-03-01"), (None, "7")]
    assert df.select(F.lit(1)).count() == 3


def test_packed_uuid_comes_back_as_it_was(spark):
    import uuid
    some = uuid.UUID(int=0x0123456789ABCDEF0011223344556677)
    texts = [str(some), some.hex, str(some).upper(), some.hex.upper(), "", None, "1296AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA", "a-b", "0" * 31, "-" * 36,
             "01234567-89abcdef-0011-2233-445566778899", "é" * 32]
    df = spark.createDataFrame([(t,) for t in texts], "u string").select("u", H.packed_uuid("u").alias("p"))
    got = df.select("u", H.unpacked_uuid("p").alias("v"), F.length("p.bits").alias("n")).collect()
    assert [r["v"] for r in got] == texts and [r["n"] for r in got][:3] == [16, 16, None]
